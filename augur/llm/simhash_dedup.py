"""SimHash near-duplicates through pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42)
of a text's ``shingle``-word shingles. Fingerprints link at ``distance`` or
fewer differing bits, and linked documents form groups.

The comparison works on distinct fingerprints, so copies cost nothing:

1. Candidate groups. Two fingerprints within ``distance`` bits agree on at
   least two of ``distance`` + 2 blocks of bits; a fingerprint goes to one group per pair
   of blocks. A group of over ``max_group`` fingerprints is split again the
   same way over its remaining free bits. What is still larger (thousands of
   fingerprints that nearly agree everywhere) is cut into parts of about
   ``max_group`` / 2 and compared part by part, each pair of parts in a
   group of its own. So every group fits a task and no pair is lost.
2. Inside a group, every fingerprint's Hamming distances to ``PIVOTS`` fixed
   reference fingerprints are tabulated. The group is sorted by the first
   distance; by the triangle inequality a pair whose distances to any pivot
   differ by more than ``distance`` can't link. The sorted sweep ends at the
   first pivot's bound, the greatest difference over all pivots discards the
   rest, and survivors are verified by counting differing bits.
3. A group emits a star per connected set of its fingerprints, never all
   pairs; connected components join the stars of all groups.

Null and empty texts have no words, fingerprint zero, and link like any other.
A null doc_id never is the id of a group unless all of the group's are null.
Repeated rows are copies. Only doc_id and text are read; ``keep_one`` returns
all columns of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.components import components
from augur.llm.scratch import few_files, stored
from augur.llm.words import mix, slices

SHINGLE = 4
DISTANCE = 4
SEED = 42
MAX_GROUP = 4096
MAX_BROADCAST = 1 << 20  # keys of removed rows broadcast up to this many (16 bytes each)
PIVOTS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # fixed reference fingerprints
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BITS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(sizes + 1) - 1
    size = min(shingle, len(words))
    n = len(words) - size + 1
    start = (end - sizes)[:n].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    stop = end[size - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(view[a:b], SEED) for a, b in zip(start[at : at + (1 << 16)], stop[at : at + (1 << 16)], strict=True)], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in part["text"].cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [*(part[c] for c in part.schema.names if c != "text"), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))],
                names=[*(c for c in part.schema.names if c != "text"), "fp"],
            )

    return run


def finer_masks(mask: int, blocks: int) -> list[int]:
    """``mask`` with two more of ``blocks`` parts of its free bits, each way."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(np.array(free, dtype=np.int64), blocks)]
    return sorted({mask | a | b for a, b in combinations(parts, 2)} - {mask})


def _spread(blocks: int):
    """(fp, mask) -> its groups one level finer."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            masks = batch["mask"].to_numpy().view(np.uint64)
            for mask in np.unique(masks):
                own = fps[masks == mask]
                first = np.bitwise_count(own ^ PIVOTS[0]).astype(np.int16)
                for finer in finer_masks(int(mask), blocks):
                    m = np.uint64(finer)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), pa.array(np.full(len(own), m).view(np.int64)), pa.array((own & m).view(np.int64)), pa.array(first)],
                        names=["fp", "mask", "agreed", "pivot"],
                    )

    return spread


def linked_in_groups(group: np.ndarray, fps: np.ndarray, first: np.ndarray, distance: int) -> np.ndarray:
    """Rows sorted by group and distance to the first pivot -> for each row, a
    row of its connected set within the group (the same for the whole set)."""
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    label = np.arange(len(fps))
    at, lag = label, 1
    while True:
        at = at[at + lag < len(fps)]
        at = at[(group[at + lag] == group[at]) & (first[at + lag] - first[at] <= distance)]
        if not len(at):
            return label
        a, b = at, at + lag
        near = np.abs(table[a] - table[b]).max(axis=1) <= distance
        a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= distance
        a, b = a[near], b[near]
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(label, up := label[label]):
                label = up
        lag += 1


def _links(distance: int):
    """Groups in order -> edges of a star per connected set."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def star(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            fps, first, *keys = rows
            new = np.zeros(len(fps), dtype=bool)
            for key in keys:
                new[1:] |= key[1:] != key[:-1]
            label = linked_in_groups(np.cumsum(new), fps.view(np.uint64), first, distance)
            far = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays([pa.array(fps[far]), pa.array(fps[label[far]])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch[c].to_numpy() for c in ("fp", "pivot", *GROUP))
            held = rows if held is None else tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            other = np.zeros(len(held[0]), dtype=bool)
            for key in held[2:]:
                other |= key != key[-1]
            last = len(other) - int(np.argmax(other[::-1])) if other.any() else 0
            if last:
                yield star(tuple(x[:last] for x in held))
                held = tuple(x[last:].copy() for x in held)
        if held is not None:
            yield star(held)

    return links


GROUP = ("mask", "agreed", "pair")


def links(fps: DataFrame, distance: int = DISTANCE, max_group: int = MAX_GROUP) -> DataFrame:
    """Distinct fingerprints ``fp`` -> edges (u, v) whose connected components
    are those of all links of at most ``distance`` bits."""
    if not 0 <= distance <= 30 or max_group < 2:
        raise ValueError("need 0 <= distance <= 30 and max_group >= 2")

    def spread(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows of finer groups, and the groups among them that are too large."""
        rows = rows.mapInArrow(_spread(distance + 2), "fp long, mask long, agreed long, pivot short")
        counts = rows.groupBy("mask", "agreed").agg(F.count(F.lit(1)).alias("n"))
        large = stored(counts.filter(F.col("n") > max_group), "groups")
        return rows, None if large.isEmpty() else large

    def compared(rows: DataFrame) -> DataFrame:
        return (
            rows.select("fp", "pivot", *GROUP)
            .repartition(*GROUP)
            .sortWithinPartitions(*GROUP, "pivot")
            .mapInArrow(_links(distance), "u long, v long")
        )

    whole = F.lit(0).cast("long").alias("pair")
    rows, large = spread(fps.select("fp", F.lit(0).cast("long").alias("mask")))
    if large is None:
        return compared(rows.select("*", whole))
    found = compared(rows.join(large, ["mask", "agreed"], "left_anti").select("*", whole))
    n = large.agg(F.sum("n")).first()[0]
    dense = stored(rows.join(large, ["mask", "agreed"], "left_semi").select("fp", "mask").distinct(), "dense", n)
    rows, large = spread(dense)
    if large is None:
        return found.unionByName(compared(rows.select("*", whole)))
    found = found.unionByName(compared(rows.join(large, ["mask", "agreed"], "left_anti").select("*", whole)))
    parts = F.ceil(2 * F.col("n") / max_group).cast("long")
    cut = rows.join(large, ["mask", "agreed"]).select("fp", "mask", "agreed", "pivot", parts.alias("parts"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    return found.unionByName(compared(cut.select("fp", "mask", "agreed", "pivot", pair.alias("pair"))))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, max_group: int = MAX_GROUP
) -> DataFrame:
    """(doc_id, r1, r2, fingerprint, component_id, component), one row per
    document: r1, r2 identify the row's doc_id and text, ``component`` its
    group. Only ``doc_id`` and ``text`` are read."""
    rows = docs.select("doc_id", "text", *_row_keys())
    prints = stored(
        rows.mapInArrow(
            _fingerprints(shingle), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, r1 long, r2 long, fp long"
        ),
        "fingerprints",
    )
    n = prints.count()
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes", n)
    joined = components(links(nodes.select("fp"), distance, max_group))
    classes = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    # written, so the join below can split a component that many fingerprints have
    classes = stored(classes, "classes", n)
    names = stored(classes.groupBy("component").agg(F.min("least").alias("component_id")), "names", n)
    named = classes.join(names, "component").select("fp", "component_id", "component")
    found = prints.join(named, "fp").select(
        "doc_id", "r1", "r2", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component"
    )
    return few_files(found, n)


def _row_keys() -> list:
    """Two 64-bit hashes of doc_id and text: rows that agree in both are repeated rows."""
    return [F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(7), "doc_id", "text").alias("r2")]


def keep_one(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    max_group: int = MAX_GROUP,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """One row of ``docs`` for each group, all columns: the one whose doc_id is
    the group's ``component_id``. If several rows have that doc_id, the least
    by row key stays; of equal rows, any one."""
    groups = stored(near_duplicates(docs, shingle, distance, max_group).drop("fingerprint"), "near_duplicates")
    n = groups.count()
    keep = (
        groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min(F.struct("r1", "r2")).alias("row"))
        .select(F.col("row.r1").alias("_r1"), F.col("row.r2").alias("_r2"))
    )
    keep = stored(keep, "keep", n)
    r1, r2 = _row_keys()
    keyed = docs.select("*", r1.alias("_r1"), r2.alias("_r2"))
    rows = groups.groupBy(F.col("r1").alias("_r1"), F.col("r2").alias("_r2")).agg(F.count(F.lit(1)).alias("_n"))
    gone = stored(rows.join(keep, ["_r1", "_r2"], "left_anti").select("_r1", "_r2"), "gone", n)
    repeated = rows.filter("_n > 1").join(keep, ["_r1", "_r2"], "left_semi")
    if gone.count() <= max_broadcast and repeated.isEmpty():
        # counted: texts stay where they are, and only keys (16 bytes each) travel
        return keyed.join(F.broadcast(gone), ["_r1", "_r2"], "left_anti").select(docs.columns)
    # the semi-join leaves the rows dealt by their key, so repeated rows go without another shuffle
    return keyed.join(keep, ["_r1", "_r2"], "left_semi").dropDuplicates(["_r1", "_r2"]).select(docs.columns)


def op3_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
