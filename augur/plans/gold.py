"""Gold layer: every mart computed from the model, written, and kept up to date.

Mergeable state, the only tables made from the fact:

pair_table      a row for each (forecaster, question); a folder per bucket of forecasters
question_cells  profile cells per question; a folder per bucket of questions
latest_cells    profile cells of the latest predictions per (question, type), by bucket of forecasters

From them: the per-person marts (``BY_PERSON``, a folder per bucket), the small
marts, which add up cells, and the dashboard roll-ups, which read written marts only.

``build_gold`` computes all of it. ``refresh_gold`` merges what loads did to the
model since: it reads their changed fact rows and forecasters (kept by
``streaming/incremental.py``), adds them to the state of the buckets they are
in, replaces those buckets' folders, and adds up the small marts anew from the
cells. The fact itself is read only for pairs in which a row was replaced: extremes
can't be taken back out of a state. The result equals ``build_gold``.

All tables of a version are published together (``sources/store.py``), with the
version of the model that they belong to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augur.plans import derived, marts
from augur.plans.model import BUCKET, MODEL_TABLES, bucket_of, mart_inputs
from augur.session import concurrently, stored
from augur.sources.store import Entry, Snapshot, Store
from augur.streaming.incremental import CHANGED_FORECASTERS, CHANGES

# The reference's three forecaster types and the column
# prefixes of its calibration mart, and the pair its hypothesis compares.
TYPES = (("sf", "superforecaster"), ("expert", "expert"), ("public", "public"))
TIGHTER = ("sf", "public")

STATE = ("pair_table", "question_cells", "latest_cells")
BY_PERSON = ("latest_forecasts", "belief_revision", "belief_revision_chrono", "engagement")


class _Gold:
    """One refresh: the tables written so far, over those of the version before."""

    def __init__(self, store: Store, model: Snapshot, entries: Mapping[str, Entry], types, tighter):
        self.store, self.model, self.entries = store, model, dict(entries)
        self.types, self.tighter, self.buckets = types, tighter, model.properties["buckets"]
        self.questions = model.read("dim_questions")
        self.read_model = {t: model.read(t, with_hidden=t == "dim_forecasters") for t in MODEL_TABLES}

    def read(self, name: str, with_bucket: bool = False) -> DataFrame:
        return self.store.read(name, self.entries[name], with_bucket)

    def write(self, jobs: Mapping[str, DataFrame], replaced: Sequence[int] | None = None) -> None:
        """Write tables. Those with a bucket column get a folder per bucket, in
        place of the ``replaced`` buckets' (None: of all)."""
        def one(name, df):
            bucketed = BUCKET in df.columns
            part = self.store.write(name, df, BUCKET if bucketed else None, hidden=bucketed)
            if bucketed and replaced is not None and name in self.entries:
                part = self.entries[name].without(BUCKET, replaced).plus(part)
            return part

        self.entries |= concurrently({n: lambda n=n, df=df: one(n, df) for n, df in jobs.items()})

    def people(self, touched: Sequence[int] | None) -> DataFrame:
        """Forecasters as the marts read them, with their bucket."""
        _, forecasters = mart_inputs({**self.read_model, "dim_forecasters": self.read_model["dim_forecasters"]})
        buckets = self.read_model["dim_forecasters"].select("forecaster_sk", BUCKET)
        if touched is not None:
            buckets = buckets.where(F.col(BUCKET).isin(list(touched)))
        return forecasters.join(buckets, "forecaster_sk")

    def person_marts(self, touched: Sequence[int] | None) -> None:
        """The tables that have a folder per bucket of forecasters."""
        pairs, people = self.read("pair_table", with_bucket=True), stored(self.people(touched), "people")
        if touched is not None:
            pairs = pairs.where(F.col(BUCKET).isin(list(touched)))
        dims, bucket = people.drop(BUCKET), people.select("forecaster_sk", BUCKET)
        pairs = pairs.drop(BUCKET)
        latest = marts.latest_forecasts(pairs)
        with_bucket = lambda df: df.join(bucket, "forecaster_sk")
        typed = with_bucket(marts.latest_with_type(pairs, dims, latest))
        self.write(
            {
                "latest_forecasts": with_bucket(latest),
                "belief_revision": with_bucket(marts.belief_revision(pairs, dims)),
                "belief_revision_chrono": with_bucket(marts.belief_revision_chrono(pairs, dims)),
                "engagement": with_bucket(marts.engagement(pairs, dims)),
                "latest_cells": marts.profile_cells(typed, [BUCKET, *marts.LATEST_KEY], "prediction", "forecaster_sk"),
            },
            touched,
        )

    def small_marts(self) -> None:
        """Marts that add up cells, then the roll-ups of written marts."""
        cells, latest = self.read("question_cells"), marts.merge_cells(self.read("latest_cells"), marts.LATEST_KEY)
        _, forecasters = mart_inputs(self.read_model)
        self.write(
            {
                "question_summary": marts.question_summary(cells, questions=self.questions),
                "type_comparison": marts.type_comparison(latest, forecasters),
                "type_counts": marts.type_counts(latest, forecasters),
                "calibration_spread": marts.calibration_spread(latest, forecasters, self.types, "stddev"),
                "calibration_long": marts.calibration_long(latest, forecasters, [t for _, t in self.types]),
                "coverage_gaps": derived.coverage_gaps(cells, forecasters),
            }
        )
        summary, eng, rev = self.read("question_summary"), self.read("engagement"), self.read("belief_revision")
        prefixes = tuple(p for p, _ in self.types)
        self.write(
            {
                "kpi_header": derived.kpi_header(summary, eng, rev),
                "question_extremes": derived.question_extremes(summary),
                "revision_counts": derived.revision_counts(rev),
                "hypothesis_check": derived.hypothesis_check(self.read("calibration_spread"), prefixes, self.tighter, "stddev"),
                "top_forecaster": derived.top_forecaster(eng),
            }
        )

    def publish(self, base: int) -> dict[str, int]:
        self.store.commit(base, self.entries, {"model": self.model.version, "build": self.model.properties["build"]})
        return {t: e.rows for t, e in self.entries.items()}


def _with_bucket(pairs: DataFrame, gold: _Gold) -> DataFrame:
    return pairs.join(gold.read_model["dim_forecasters"].select("forecaster_sk", BUCKET), "forecaster_sk")


def build_gold(
    spark: SparkSession,
    model_dir: str,
    gold_dir: str,
    types: Sequence[tuple[str, str]] = TYPES,
    tighter: tuple[str, str] = TIGHTER,
) -> dict[str, int]:
    """All of the gold layer from the model's newest version. Returns observed
    row counts per table."""
    store = Store(spark, gold_dir)
    base = store.version()
    gold = _Gold(store, Store(spark, model_dir).snapshot(), {}, types, tighter)
    fact, _ = mart_inputs(gold.read_model)
    cells = marts.question_cells(fact)
    gold.write(
        {
            "pair_table": _with_bucket(marts.pair_table(fact), gold),
            "question_cells": cells.withColumn(BUCKET, bucket_of("question_id", gold.buckets)),
        }
    )
    gold.person_marts(None)
    gold.small_marts()
    return gold.publish(base)


def refresh_gold(
    spark: SparkSession,
    model_dir: str,
    gold_dir: str,
    types: Sequence[tuple[str, str]] = TYPES,
    tighter: tuple[str, str] = TIGHTER,
) -> dict[str, int]:
    """Bring the gold layer to the model's newest version: from the loads since,
    or in full where there is none yet or the model was built anew."""
    store, model = Store(spark, gold_dir), Store(spark, model_dir).snapshot()
    before = store.snapshot()
    if not before.version or before.properties["build"] != model.properties["build"]:
        return build_gold(spark, model_dir, gold_dir, types, tighter)
    gold = _Gold(store, model, before.entries, types, tighter)
    if before.properties["model"] == model.version:
        return {t: e.rows for t, e in gold.entries.items()}
    since = F.col("version") > before.properties["model"]
    log = lambda name: model.read(name).where(since)
    changes = stored(log(CHANGES), "changes")
    people = log(CHANGED_FORECASTERS).select("bucket") if CHANGED_FORECASTERS in model.entries else changes.select("bucket").limit(0)
    touched = sorted(r[0] for r in changes.select("bucket").union(people).distinct().collect())  # buckets

    # question cells: the histogram takes signed counts, words only grow (a replaced row's forecaster stays)
    signed = changes.withColumn("one", F.col("sign").cast("long"))
    delta = marts.profile_cells(signed, ["question_id"], "prediction", "forecaster_sk", weight="one")
    delta = stored(delta.withColumn(BUCKET, bucket_of("question_id", gold.buckets)), "delta_cells")
    asked = sorted(r[0] for r in delta.select(BUCKET).distinct().collect())
    old = gold.read("question_cells", with_bucket=True).where(F.col(BUCKET).isin(asked))
    cells = marts.merge_cells(old.unionByName(delta), [BUCKET, "question_id"])
    cells = cells.where((F.col("kind") == marts.MEMBER) | (F.col("n") != 0))

    # pairs: new rows merge with the state; pairs with a replaced row are made again from the fact
    redone = stored(changes.where("sign < 0").select(*marts.FACT_KEY).distinct(), "redone_pairs")
    added = changes.join(redone, marts.FACT_KEY, "left_anti")
    state = gold.read("pair_table", with_bucket=True).where(F.col(BUCKET).isin(touched))
    fresh = marts.pair_table(added).join(changes.select("forecaster_sk", F.col("bucket").alias(BUCKET)).distinct(), "forecaster_sk")
    kept = state.join(redone, marts.FACT_KEY, "left_anti")
    pairs = marts.merge_pairs(kept.unionByName(fresh.select(*kept.columns)), [BUCKET])
    if not redone.isEmpty():
        fact, _ = mart_inputs(gold.read_model)
        again = marts.pair_table(fact.join(redone, marts.FACT_KEY, "left_semi"))
        pairs = pairs.unionByName(_with_bucket(again, gold).select(*pairs.columns))
    gold.write({"pair_table": pairs}, touched)
    gold.write({"question_cells": cells}, asked)
    gold.person_marts(touched)
    gold.small_marts()
    return gold.publish(before.version)


def gold_table(spark: SparkSession, gold_dir: str, name: str, version: int | None = None) -> DataFrame:
    return Store(spark, gold_dir).snapshot(version).read(name)


def register_views(spark: SparkSession, model_dir: str, gold_dir: str | None = None) -> list[str]:
    """Register the model tables (and the gold tables, when built) as
    temporary views, so SQL users can query them by name with ``spark.sql``.
    The views stay at the versions that are the newest now."""
    names = []
    for folder, tables in ((model_dir, MODEL_TABLES), (gold_dir, None)):
        if folder:
            snapshot = Store(spark, folder).snapshot()
            for t in tables or snapshot.tables():
                snapshot.read(t).createOrReplaceTempView(t)
                names.append(t)
    return names
