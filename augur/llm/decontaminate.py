"""Benchmark decontamination against a broadcast set of test n-grams.

Texts are lower-cased (A-Z only) and cut into words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A benchmark item's windows are its
``size`` consecutive words; an item of fewer words, but not none, is one
window. The set of windows (hash, words, item ids) is broadcast while its
measured size is below ``max_broadcast`` bytes, otherwise joined by shuffle.
Every window of every training text is looked up by hash, hits are verified
word by word, and all words inside an occurrence count as hit.

All of it is DataFrame code. A text's windows are generated, hashed and
probed in one pass over the scan; only hits and one row per text are shuffled.

Null and empty texts have no words and are never contaminated; so are all when
the benchmark is empty or has no words. Items without an id mark hits but
aren't counted as items; repeated items count once. Texts are judged by
content, so repeated rows each get the same verdict and need no unique id.
Columns of the input are kept by ``remove_contaminated``; added names win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augur.llm.scratch import stored

SIZE = 13
PARTS = 20  # a text is contaminated if at least one in so many of its words is hit
MAX_BROADCAST = 64 << 20
MAX_REMOVED = 1 << 20  # digests of removed texts broadcast up to this many
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Array of a text's normalised words (null text: empty)."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def test_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(n, hash, window, items): the distinct windows of the benchmark, their
    word count and the ids (as strings) of the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).filter(
        F.size("w") > 0
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return (
        items.select("item", "w", F.explode(starts).alias("at"))
        .select("item", F.slice("w", F.col("at"), size).alias("window"))
        .groupBy("window")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select(F.size("window").alias("n"), F.xxhash64("window").alias("hash"), "window", "items")
    )


test_windows.__test__ = False  # not a test, whatever pytest thinks of its name


def find_hits(docs: DataFrame, windows: DataFrame, lengths: list[int], broadcast: bool) -> DataFrame:
    """One row per occurrence of a window in a text, and one row per document
    with null ``start``: (d1, d2, n_words, start, n, items)."""
    words = docs.select(
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("d1"),
        F.xxhash64(F.lit(7), F.coalesce("text", F.lit(""))).alias("d2"),
        words_of(F.col("text")).alias("w"),
    )
    # place 0 is the document's own row; then every start, for every window length
    k = len(lengths)
    places = words.select(
        "d1", "d2", "w", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("w") * k)).alias("p")
    )
    start = F.expr(f"cast((p - 1) div {k} as int)") if k > 1 else F.col("p") - 1
    if k > 1:
        n = F.element_at(F.array(*(F.lit(x) for x in lengths)), F.pmod(F.col("p") - 1, F.lit(k)) + 1)
    else:
        n = F.lit(lengths[0] if lengths else SIZE)
    here = F.slice("w", F.greatest(F.col("start") + 1, F.lit(1)), F.col("len"))  # place 0 has no window
    scanned = (
        places.select("d1", "d2", "w", "n_words", "p", start.alias("start"), n.alias("len"))
        .filter((F.col("p") == 0) | (F.col("start") + F.col("len") <= F.col("n_words")))
        .withColumn("h", F.when(F.col("p") > 0, F.xxhash64(here)))
    )
    right = F.broadcast(windows) if broadcast else windows
    if not broadcast:  # the shuffle carries a window, not its text's words
        scanned = scanned.withColumn("w", F.when(F.col("p") > 0, here))
        same = F.col("w") == F.col("window")
    else:
        same = here == F.col("window")
    return (
        scanned.join(right, (F.col("h") == F.col("hash")) & (F.col("len") == F.col("n")) & same, "left")
        .filter((F.col("p") == 0) | F.col("n").isNotNull())
        .select("d1", "d2", "n_words", F.when(F.col("p") > 0, F.col("start")).alias("start"), "n", "items")
    )


def judge(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SIZE,
    parts: int = PARTS,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """Verdict per distinct text: (d1, d2, copies, n_words, n_hit, n_items,
    items, spans, contaminated); ``spans`` are the hit words [start, end)."""
    windows = test_windows(benchmark, size)
    # bytes of the broadcast set, measured: words, ids and about 64 bytes of overhead for each array entry
    weight = F.sum(
        F.lit(64)
        + F.aggregate("window", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 64)
        + F.aggregate("items", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 64)
    )
    found = windows.agg(weight.alias("bytes"), F.collect_set("n").alias("lengths")).first()
    lengths = sorted(found["lengths"])  # at most `size` numbers
    hits = find_hits(docs, windows, lengths, (found["bytes"] or 0) <= max_broadcast)
    per_text = Window.partitionBy("d1", "d2")
    # an occurrence once, however many copies of the text there are
    occurrence = hits.groupBy("d1", "d2", "n_words", "start", "n", "items").agg(F.count(F.lit(1)).alias("copies"))
    ends = F.col("start") + F.col("n")
    before = F.max(ends).over(per_text.orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1))
    marked = occurrence.withColumn("reach", before)
    new = F.greatest(F.lit(0), ends - F.greatest("start", F.coalesce("reach", F.lit(0))))
    return (
        marked.groupBy("d1", "d2", "n_words")
        .agg(
            F.max(F.when(F.col("start").isNull(), F.col("copies"))).alias("copies"),
            F.coalesce(F.sum(F.when(F.col("start").isNotNull(), new)), F.lit(0)).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            F.array_sort(F.collect_list(F.when(new > 0, F.struct((ends - new).alias("start"), ends.alias("end"))))).alias("spans"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("n_words", F.col("n_words").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words")))
    )


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SIZE,
    parts: int = PARTS,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``docs`` without its contaminated rows, all columns."""
    bad = judge(docs, benchmark, size, parts, max_broadcast).filter("contaminated").select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2")
    )
    bad = stored(bad, "contaminated")
    if bad.count() <= MAX_REMOVED:  # counted: the texts stay where they are, 16 bytes a removed text travel
        bad = F.broadcast(bad)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"_d1": F.xxhash64(text), "_d2": F.xxhash64(F.lit(7), text)})
    return keyed.join(bad, ["_d1", "_d2"], "left_anti").select(docs.columns)


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents`` and ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    verdicts = judge(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # written, so the join can split the copies of one text
    verdicts = stored(verdicts.select("d1", "d2", "n_words", "n_hit", "n_items", "items", "contaminated"), "verdicts")
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select("doc_id", F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(7), text).alias("d2"))
    return ids.join(verdicts, ["d1", "d2"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
