"""Incremental loads: new extracts merged into the model, all tables in one version.

The reference only rebuilds in full and lists incremental appends as future
work. ``load`` merges a batch of raw forecasts, demographics and tags, so that
after any sequence of loads the five model tables equal those of one full
build over all extracts, up to the surrogate keys' values:

* dimensions: every attribute of a forecaster or question is a MAX or an OR
  over its raw rows, so the batch's value is merged with the stored one. Rows
  that change by it are rewritten under their old key, with the bucket
  folders that hold them; unseen ids get keys after the current maximum.
* ``dim_date`` and the tag bridge: days and pairs that aren't there are added.
* fact: rows with a new natural key (forecaster, question, time) are appended
  with keys after the current maximum. Where a row with that key is there, the
  smaller one in the order of ``dedup_forecasts`` survives, as in a full build; a
  replaced row keeps its key, and its date folder is rewritten.
* forecasts of people who aren't registered, and tags of questions without a
  forecast, wait in ``pending_forecasts`` and ``pending_tags`` as raw rows; every load tries them again.

Only the batch, the buckets of its ids and the date folders of its forecasts
are read and written (and the bridge's and calendar's key columns). A load ends
with one commit record (``sources/store.py``): stopped anywhere, it leaves the version before.
Of two loads at once the later fails with ``Conflict`` and ``load`` runs it again on the
new version, so keys never repeat. The same batch again changes nothing.

What a load did to the fact is kept as a table of its own (``fact_changes``:
rows with +1 and, for replaced ones, -1), from which the gold layer is refreshed.

``stream_forecasts`` feeds ``load`` from a Structured Streaming file source. The
stream keeps no state and has no watermark: however late a row is, the merge decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from augur.functions.dates import date_parts
from augur.operators.keys import dense_key
from augur.plans import model as M
from augur.session import concurrently, stored
from augur.sources.schemas import RAW_DEMOGRAPHICS, RAW_FORECASTS, RAW_QUESTION_TAGS
from augur.sources.store import Conflict, Entry, Snapshot, Store

TRIES = 5  # loads that find their version taken are run again
CHANGES = "fact_changes"
CHANGED_FORECASTERS = "changed_forecasters"


def _same(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _values(df: DataFrame, column: str) -> list:
    """Distinct values of a column of buckets or dates: as many as folders at most."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _in(column: str, values: Sequence) -> Column:
    """Membership, NULL included; prunes the folders of a partition column."""
    known = [v for v in values if v is not None]
    among = F.col(column).isin(known) if known else F.lit(False)
    return among | F.col(column).isNull() if None in values else among


def _upsert(now: Snapshot, name: str, key: str, sk: str, news: DataFrame, attributes: Sequence[str], registers: Column) -> tuple[Entry, DataFrame | None]:
    """Merge ``news`` (a row per id: ``key`` and attributes) into a dimension.
    Attributes become the greater of old and new (NULL is less than all, TRUE greater than FALSE);
    an unseen id is added where ``registers`` holds. Returns the new entry and the
    changed rows (all columns and the bucket; None where there are none)."""
    entry, buckets = now.entries[name], now.properties["buckets"]
    news = stored(news.withColumn(M.BUCKET, M.bucket_of(key, buckets)), f"news_{name}")
    touched = _values(news, M.BUCKET)
    if not touched:
        return entry, None
    old = now.read(name, with_hidden=True).where(_in(M.BUCKET, touched))
    merged = {a: F.greatest(f"o.{a}", f"n.{a}") for a in attributes}
    differs = reduce(or_, [~F.col(f"o.{a}").eqNullSafe(m) for a, m in merged.items()])
    joined = news.alias("n").join(old.alias("o"), F.col(f"n.{key}").eqNullSafe(F.col(f"o.{key}")), "left")
    is_new = F.col(f"o.{sk}").isNull()
    changes = joined.where(F.when(is_new, registers).otherwise(differs)).select(
        F.col(f"o.{sk}").alias(sk), F.col(f"n.{key}").alias(key), *[m.alias(a) for a, m in merged.items()], F.col(f"n.{M.BUCKET}").alias(M.BUCKET)
    )
    changes = stored(changes, f"changes_{name}")
    rewritten = _values(changes, M.BUCKET)
    if not rewritten:
        return entry, None
    # unseen ids are numbered from the row count on (keys are dense 1..N), in id order
    added = dense_key(changes.where(F.col(sk).isNull()).drop(sk), [key], sk)
    added = added.withColumn(sk, F.col(sk) + F.lit(entry.rows))
    changed = changes.where(F.col(sk).isNotNull()).unionByName(added)
    kept = now.read(name, with_hidden=True).where(_in(M.BUCKET, rewritten)).alias("o")
    kept = kept.join(changes.select(key).alias("c"), _same("o", "c", [key]), "left_anti")
    rows = kept.unionByName(changed.select(*kept.columns))
    part = M.write_table(now.store, name, rows, buckets)
    return entry.without(M.BUCKET, rewritten).plus(part, entry.rows + added.count()), changed


def _people(now: Snapshot, forecasts: DataFrame, demographics: DataFrame) -> tuple[Entry, DataFrame | None]:
    """Merged forecasters, and those that changed."""
    profiles = M.forecaster_profiles(demographics).withColumn("_registers", F.lit(True))
    names = M.forecaster_names(forecasts).where("forecaster_id is not null")
    news = names.join(profiles, "forecaster_id", "full")
    news = news.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("is_active", "has_complete_profile", "_registers")})
    return _upsert(now, "dim_forecasters", "forecaster_id", "forecaster_sk", news, M.FORECASTER_ATTRIBUTES, F.col("n._registers"))


def _questions(now: Snapshot, forecasts: DataFrame) -> Entry:
    return _upsert(now, "dim_questions", "question_id", "question_sk", M.question_texts(forecasts), ["question_text"], F.lit(True))[0]


def _days(now: Snapshot, forecasts: DataFrame) -> Entry:
    entry = now.entries["dim_date"]
    days = M.typed_forecasts(forecasts).select(F.col("forecast_timestamp").cast("date").alias("date_day")).distinct().alias("n")
    unseen = stored(days.join(now.read("dim_date").alias("o"), _same("n", "o", ["date_day"]), "left_anti"), "new_days")
    if unseen.isEmpty():
        return entry
    return entry.plus(M.write_table(now.store, "dim_date", unseen.select("date_day", *date_parts(F.col("date_day"))), now.properties["buckets"]))


def _bridge(now: Snapshot, tags: DataFrame, questions: DataFrame) -> Entry:
    entry = now.entries["bridge_question_tags"]
    pairs = M.bridge_question_tags(tags, questions).alias("n")
    unseen = stored(pairs.join(now.read("bridge_question_tags").alias("o"), _same("n", "o", ["question_sk", "tag"]), "left_anti"), "new_tags")
    if unseen.isEmpty():
        return entry
    return entry.plus(M.write_table(now.store, "bridge_question_tags", unseen, now.properties["buckets"]))


def _fact(now: Snapshot, forecasts: DataFrame, forecasters: DataFrame, questions: DataFrame) -> tuple[Entry, DataFrame, int]:
    """The fact with the batch, the rows that changed (columns of the fact, and
    ``sign``: 1 for a row that is there now, -1 for one that was replaced), and
    how many are new."""
    entry, key = now.entries["fct_forecasts"], ["forecaster_sk", "question_sk", "forecast_timestamp"]
    batch = stored(M.fact_rows(forecasts, forecasters, questions).withColumn("date_day", F.col("forecast_timestamp").cast("date")), "batch_rows")
    days = _values(batch, "date_day")
    c, o = batch.alias("c"), now.read("fct_forecasts").where(_in("date_day", days)).alias("o")
    old = [F.col(f"o.{n}").alias(f"_old_{n}") for n in ("forecast_sk", "prediction", "rationale", "question_text_snapshot")]
    met = stored(c.join(o, _same("c", "o", [*key, "date_day"]), "left").select("c.*", *old), "met_rows")
    added = dense_key(met.where("_old_forecast_sk is null"), M.FACT_ORDER, "forecast_sk")
    added = M.fact_columns(added.withColumn("forecast_sk", F.col("forecast_sk") + F.lit(entry.rows)))
    was = F.struct(*[F.col(f"_old_{o}").alias(v) for o, v in zip(("prediction", "question_text_snapshot", "rationale"), M.FORECAST_VALUES, strict=True)])
    smaller = met.where(F.col("_old_forecast_sk").isNotNull() & (F.struct(*M.FORECAST_VALUES) < was))
    replacing = M.fact_columns(smaller.withColumn("forecast_sk", F.col("_old_forecast_sk")))
    replaced = smaller.select(
        F.col("_old_forecast_sk").alias("forecast_sk"), *key, F.col("_old_prediction").alias("prediction"),
        F.col("_old_rationale").alias("rationale"), F.col("_old_question_text_snapshot").alias("question_text_snapshot"), "date_day",
    )
    plus = lambda df, sign: df.withColumn("sign", F.lit(sign))
    changes = stored(plus(added, 1).unionByName(plus(replacing, 1)).unionByName(plus(replaced, -1)), "fact_changes")
    rewritten = _values(changes.where("sign < 0"), "date_day")
    rows = changes.where("sign > 0").drop("sign")
    if rewritten:
        gone = changes.where("sign < 0").select("forecast_sk")
        rows = rows.unionByName(now.read("fct_forecasts").where(_in("date_day", rewritten)).join(gone, "forecast_sk", "left_anti"))
    n_added = added.count()
    if not n_added and not rewritten:
        return entry, changes, 0
    part = M.write_table(now.store, "fct_forecasts", rows, now.properties["buckets"])
    return entry.without("date_day", rewritten).plus(part, entry.rows + n_added), changes, n_added


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _load(
    store: Store, forecasts: DataFrame | None, demographics: DataFrame | None, tags: DataFrame | None, assertions, lenient: bool
) -> dict[str, int]:
    spark, now = store.spark, store.snapshot()
    if not now.version:
        raise ValueError(f"no model at {store.root}: build one first")
    buckets, entries = now.properties["buckets"], dict(now.entries)
    forecasts = _empty(spark, RAW_FORECASTS) if forecasts is None else forecasts
    demographics = _empty(spark, RAW_DEMOGRAPHICS) if demographics is None else demographics
    tags = _empty(spark, RAW_QUESTION_TAGS) if tags is None else tags
    bad = None
    if lenient:
        given = {"raw_forecasts_export": forecasts, "raw_forecaster_demographics": demographics, "raw_question_tags": tags}
        good, bad = M.split_all(given)
        forecasts, demographics, tags = good.values()
    batch = stored(forecasts.unionByName(now.read("pending_forecasts").select(*forecasts.columns)), "batch")
    all_tags = stored(tags.select("question_id", "tag").unionByName(now.read("pending_tags")), "batch_tags")

    # tables that don't need each other's keys are merged by concurrent jobs
    done = concurrently(
        {
            "dim_forecasters": lambda: _people(now, batch, demographics),
            "dim_questions": lambda: _questions(now, batch),
            "dim_date": lambda: _days(now, batch),
        }
    )
    entries["dim_forecasters"], changed = done.pop("dim_forecasters")
    entries |= done
    buckets_of = _values(stored(batch.select(M.bucket_of("forecaster_id", buckets).alias("b")).distinct(), "person_buckets"), "b")
    forecasters = store.read("dim_forecasters", entries["dim_forecasters"], with_hidden=True).where(_in(M.BUCKET, buckets_of))
    questions = store.read("dim_questions", entries["dim_questions"])
    done = concurrently(
        {
            "bridge_question_tags": lambda: _bridge(now, all_tags, questions),
            "fct_forecasts": lambda: _fact(now, batch, forecasters, questions),
            "pending_forecasts": lambda: M.write_table(store, "pending_forecasts", M.unregistered(batch, forecasters), buckets),
            "pending_tags": lambda: M.write_table(store, "pending_tags", M.untied(all_tags, questions), buckets),
        }
    )
    entries["fct_forecasts"], changes, added = done.pop("fct_forecasts")
    entries |= done

    same = [t for t in entries if entries[t].folders == now.entries.get(t, Entry(None)).folders]
    if bad is not None:
        part = store.write("quarantine", bad)
        entries["quarantine"] = entries["quarantine"].plus(part) if "quarantine" in entries else part
    moved = set(entries) - set(same) - {"pending_forecasts", "pending_tags"}
    waiting = any(entries[t].profile != now.entries[t].profile for t in ("pending_forecasts", "pending_tags"))
    n_changed = 0 if changed is None else changed.count()
    if moved or waiting:
        who = store.read("dim_forecasters", entries["dim_forecasters"], with_hidden=True).where(_in(M.BUCKET, buckets_of))
        change_rows = changes.join(who.select("forecaster_sk", M.BUCKET), "forecaster_sk").join(questions.select("question_sk", "question_id"), "question_sk")
        change_rows = change_rows.select("forecaster_sk", "question_id", "prediction", "forecast_timestamp", "sign", F.col(M.BUCKET).alias("bucket"))
        logs = {CHANGES: change_rows}
        if n_changed:
            logs[CHANGED_FORECASTERS] = changed.select("forecaster_sk", F.col(M.BUCKET).alias("bucket"))
        for name, rows in logs.items():
            part = store.write(name, rows.withColumn("version", F.lit(now.version + 1)), "version")
            entries[name] = entries[name].plus(part) if name in entries else part
        store.commit(now.version, entries, now.properties, assertions)
    replaced = changes.where("sign < 0").count()
    return {"appended": added, "replaced": replaced, "forecasters": n_changed, "waiting": entries["pending_forecasts"].rows}


def load(
    spark: SparkSession,
    model_dir: str,
    forecasts: DataFrame | None = None,
    demographics: DataFrame | None = None,
    tags: DataFrame | None = None,
    assertions=None,
    lenient: bool = False,
) -> dict[str, int]:
    """Merge raw extracts (all-text schemas) into the model; returns how many fact
    rows were appended and replaced, how many forecasters are new or changed, and
    how many forecasts wait for their forecaster. ``lenient`` appends rows that don't
    parse or cast to ``quarantine`` instead of stopping."""
    store = Store(spark, model_dir)
    for left in reversed(range(TRIES)):
        try:
            return _load(store, forecasts, demographics, tags, assertions, lenient)
        except Conflict:  # another load came first: merge with what it published
            if not left:
                raise
    raise AssertionError


def append_forecasts(
    spark: SparkSession, new_raw: DataFrame, model_dir: str, new_demographics: DataFrame | None = None, new_tags: DataFrame | None = None
) -> int:
    """``load``, returning the number of appended fact rows."""
    return load(spark, model_dir, new_raw, new_demographics, new_tags)["appended"]


def extend_forecasters(spark: SparkSession, new_demographics: DataFrame, model_dir: str) -> int:
    """Register people or update their attributes; returns how many rows of
    ``dim_forecasters`` are new or changed. Their waiting forecasts are loaded with them."""
    return load(spark, model_dir, demographics=new_demographics)["forecasters"]


def retry_pending(spark: SparkSession, model_dir: str) -> int:
    """Load the waiting forecasts of people registered meanwhile."""
    return load(spark, model_dir)["appended"]


def stream_forecasts(
    spark: SparkSession, source_dir: str, model_dir: str, checkpoint_dir: str
) -> StreamingQuery:
    """Load every CSV extract that lands in ``source_dir`` (available-now
    trigger: process what is there, then stop), waiting rows first."""
    retry_pending(spark, model_dir)
    stream = (
        spark.readStream.schema(RAW_FORECASTS)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(source_dir)
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        load(spark, model_dir, batch)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
