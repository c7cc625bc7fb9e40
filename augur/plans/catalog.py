"""Named queries over the driver tables (FIXTURES.md part B).

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
Where the driver tables lack a defect class the reference repairs, the query
runs the detector/repair on a real column that has it (e.g. exact copies in
``documents``, blank fragments after splitting texts on '.', case variants
among the words of all texts) instead of injecting made-up defects.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augur.functions import clean, labels
from augur.functions.text import text_digest
from augur.operators.hot_join import hot_join
from augur.operators.keys import dense_key
from augur.operators.median import exact_median
from augur.operators.sequence import sequence_number
from augur.plans import derived, marts, model, quality
from augur.session import scratch_path, stored
from augur.sources import csv as csv_src
from augur.sources import clustered, schemas, sinks
from augur.sources.tables import (
    PROSE_STATUS,
    forecaster_profiles,
    forecasters,
    forecasts,
    raw_demographics,
    raw_forecasts,
    read_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the driver mapping: the forecaster types compared side by
# side (all five, with column prefixes), the vocabulary repair and accepted
# set, and the separator inside customer names.
CATEGORIES = [("a", "BUILDING"), ("b", "MACHINERY"), ("c", "FURNITURE"), ("d", "AUTOMOBILE"), ("e", "HOUSEHOLD")]
SLICE_TYPE = "BUILDING"
SEGMENT_VOCAB = {"MACHINERY": "MACHINES"}
ACCEPTED_SEGMENTS = ["BUILDING", "MACHINERY"]
NAME_SEP = "#"


def _fact(spark, d):
    return forecasts(spark, d)


def _unchecked(spark, d):
    """Fact for marts that inner-join the forecaster dimension after
    aggregating (see ``forecasts``)."""
    return forecasts(spark, d, checked=False)


def _dims(spark, d):
    return forecasters(spark, d)


# ---------------------------------------------------------------- marts

def _question_cells(spark, d):
    return marts.question_cells(_unchecked(spark, d), _dims(spark, d))


def q_question_summary(spark, d):
    # the driver's question texts are a function of the id; a model has dim_questions
    return marts.question_summary(_question_cells(spark, d), questions=F.upper("question_id"))


def q_latest_forecast(spark, d):
    latest = marts.latest_forecasts(_unchecked(spark, d), known=_dims(spark, d))
    return latest.select("forecaster_sk", "question_id", "prediction")


def q_update_sequence(spark, d):
    f = _fact(spark, d).select("forecaster_sk", "question_id", "forecast_timestamp")
    return sequence_number(f, marts.FACT_KEY, [marts.TS], "update_number")


def q_type_comparison(spark, d):
    return marts.type_comparison(_unchecked(spark, d), _dims(spark, d))


def q_type_slice(spark, d):
    return marts.type_slice(_unchecked(spark, d), _dims(spark, d), SLICE_TYPE)


def q_belief_revision(spark, d):
    return marts.belief_revision(_unchecked(spark, d), _dims(spark, d))


def q_type_counts(spark, d):
    return marts.type_counts(_unchecked(spark, d), _dims(spark, d))


def q_belief_revision_windowed(spark, d):
    return marts.numbered_revision(_unchecked(spark, d), _dims(spark, d))


def q_calibration_unpivot(spark, d):
    spread = marts.calibration_spread(_unchecked(spark, d), _dims(spark, d), CATEGORIES)
    return marts.calibration_unpivot(spread, CATEGORIES)


def q_belief_revision_chrono(spark, d):
    return marts.belief_revision_chrono(_unchecked(spark, d), _dims(spark, d))


def q_calibration_spread(spark, d):
    return marts.calibration_spread(_unchecked(spark, d), _dims(spark, d), CATEGORIES)


def q_calibration_long(spark, d):
    return marts.calibration_long(_unchecked(spark, d), _dims(spark, d), [c for _, c in CATEGORIES])


def q_engagement(spark, d):
    return marts.engagement(_unchecked(spark, d), _dims(spark, d)).drop("years")


def q_engagement_profile(spark, d):
    eng = marts.engagement(_unchecked(spark, d), forecaster_profiles(spark, d))
    return eng.drop("min_prediction", "max_prediction")


def q_median_wide_domain(spark, d):
    """A5 on a wide value domain with hot groups: exact median price per
    return flag over all of lineitem (three flags, about a third each)."""
    li = read_table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    m = exact_median(li, ["l_returnflag"], "l_extendedprice", "median_price")
    return m.select("l_returnflag", F.round("median_price", 3).alias("median_price"))


# ---------------------------------------------------------------- derived

def q_revision_counts(spark, d):
    return derived.revision_counts(marts.belief_revision(_unchecked(spark, d), _dims(spark, d)))


def q_revision_label(spark, d):
    rev = marts.belief_revision(_unchecked(spark, d), _dims(spark, d))
    return derived.revision_label(rev, NAME_SEP)


def q_hypothesis_check(spark, d):
    spread = marts.calibration_spread(_unchecked(spark, d), _dims(spark, d), CATEGORIES)
    return derived.hypothesis_check(spread, tuple(p for p, _ in CATEGORIES), ("a", "b"))


def q_experience_vs_avg(spark, d):
    return derived.experience_vs_avg(marts.engagement(_unchecked(spark, d), _dims(spark, d)), NAME_SEP)


def q_top_forecaster(spark, d):
    return derived.top_forecaster(marts.engagement(_unchecked(spark, d), _dims(spark, d)))


def q_top_forecaster_history(spark, d):
    """The most active forecaster's forecasts, from a table clustered by forecaster."""
    path = scratch_path(spark, "clustered_forecasts")
    fact = _unchecked(spark, d).select("forecaster_sk", "question_id", "prediction", "forecast_timestamp")
    clustered.write_clustered(fact, path, ["forecaster_sk", "question_id"], tie=["forecast_timestamp"])
    top = q_top_forecaster(spark, d).first()
    if top is None:
        return fact.where(F.lit(False))
    return clustered.read_clustered(spark, path, top["forecaster_sk"])


def q_consensus_distance(spark, d):
    """Every forecast against its question's median; a few questions hold all rows."""
    consensus = q_question_summary(spark, d).select("question_id", "median_prediction")
    fact = _fact(spark, d).select("forecaster_sk", "question_id", "prediction", "forecast_timestamp")
    return hot_join(fact, consensus, ["question_id"]).withColumn(
        "distance", F.round(F.col("prediction") - F.col("median_prediction"), 1)
    )


def _summary(spark, d):
    return q_question_summary(spark, d)


def q_question_extremes(spark, d):
    return derived.question_extremes(_summary(spark, d))


def q_question_label(spark, d):
    return derived.question_label(_summary(spark, d))


def q_kpi_header(spark, d):
    """All three marts come from written pairs and cells."""
    dims = _dims(spark, d)
    pairs = stored(marts.pair_table(_unchecked(spark, d), dims), "pair_table")
    cells = stored(_question_cells(spark, d), "question_cells")
    summary = marts.question_summary(cells, questions=F.upper("question_id"))
    return derived.kpi_header(summary, marts.engagement(pairs, dims), marts.belief_revision(pairs, dims))


def q_coverage_gaps(spark, d):
    cells = stored(_question_cells(spark, d), "question_cells")
    return derived.coverage_gaps(cells, _dims(spark, d))


def q_missing_pairs(spark, d):
    """Registered forecasters that a question lacks, by name."""
    cells = stored(_question_cells(spark, d), "question_cells")
    return derived.missing_pairs(cells, _dims(spark, d), registered=True)


def q_ordered_types(spark, d):
    return derived.ordered_types(q_type_comparison(spark, d))


def q_presentation_projection(spark, d):
    return derived.presentation_projection(_summary(spark, d))


def q_display_types(spark, d):
    return derived.display(q_type_comparison(spark, d), derived.TYPE_TABLE)


def q_display_revisions(spark, d):
    return derived.display(q_belief_revision(spark, d), derived.REVISION_TABLE)


def q_display_calibration(spark, d):
    return derived.calibration_table(q_calibration_spread(spark, d), {p: t.title() for p, t in CATEGORIES})


def q_display_profiles(spark, d):
    return derived.display(q_engagement_profile(spark, d), derived.PROFILE_TABLE)


def q_ordered_summary(spark, d):
    return derived.ordered_summary(_summary(spark, d))


def q_ordered_engagement(spark, d):
    return derived.ordered_engagement(q_engagement(spark, d))


def q_ordered_revisions(spark, d):
    return derived.ordered_revisions(q_belief_revision(spark, d))


def q_ascending_medians(spark, d):
    return derived.ascending(q_question_label(spark, d).join(_summary(spark, d).select("question_id", "median_prediction"), "question_id"), "median_prediction", "question_id")


def q_ascending_revisions(spark, d):
    return derived.ascending(q_belief_revision(spark, d), "net_revision", "forecaster_sk", "question_id")


def q_ascending_engagement(spark, d):
    return derived.ascending(q_engagement(spark, d), "total_submissions", "forecaster_sk")


def q_name_labels(spark, d):
    """F18 on real names with leading blanks and tabs around their parts."""
    p = read_table(spark, d, "part")
    padded = F.concat(F.lit(" \t"), F.translate("p_name", " ", "\t"), F.lit(" "))
    return p.select("p_partkey", labels.first_word(padded).alias("first"), labels.first_word(F.col("p_name")).alias("plain"))


# ---------------------------------------------------------------- model build

def _active_users(spark, d):
    return read_table(spark, d, "events").select(F.col("user_id").alias("c_custkey")).distinct()


def q_is_active_flag(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey")
    act = _active_users(spark, d).withColumn("is_active", F.lit(True))
    return c.join(act, "c_custkey", "left").select(
        "c_custkey", F.coalesce("is_active", F.lit(False)).alias("is_active")
    )


def _dim_forecasters(spark, d):
    return model.dim_forecasters(raw_forecasts(spark, d), raw_demographics(spark, d), SEGMENT_VOCAB)


def q_dim_forecasters(spark, d):
    return _dim_forecasters(spark, d)


def q_dim_questions(spark, d):
    return model.dim_questions(raw_forecasts(spark, d))


def _dim_date(spark, d):
    days = read_table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    return model.dim_date(days, "ts")


def q_dim_date(spark, d):
    return _dim_date(spark, d)


def _supplier_keys(spark, d):
    return dense_key(read_table(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"], "sk")


def q_bridge_tags(spark, d):
    """Suppliers as questions, the brands of their parts as tags. The
    (supplier, part) pairs are distinct before the parts' text joins."""
    li = read_table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    part = read_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag"))
    tags = li.join(part, "l_partkey").select(F.col("l_suppkey").alias("question_id"), "tag")
    questions = _supplier_keys(spark, d).select(F.col("s_suppkey").alias("question_id"), F.col("sk").alias("question_sk"))
    return model.bridge_question_tags(tags, questions)


def q_fct_build(spark, d):
    forecasters_, questions = _dim_forecasters(spark, d), q_dim_questions(spark, d)
    return model.fct_forecasts(raw_forecasts(spark, d), forecasters_, questions)


def q_surrogate_key_fact(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return dense_key(o, ["o_orderdate", "o_orderkey"], "sk").select("o_orderkey", "sk")


def q_surrogate_key_dim(spark, d):
    return _supplier_keys(spark, d)


def q_dedup_rows(spark, d):
    """Survivor per distinct text: the smallest doc_id. Grouped on the text
    digest, so texts never cross the network."""
    docs = read_table(spark, d, "documents")
    return docs.groupBy(text_digest("text").alias("_h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


def _fragments(spark, d):
    """Sentence fragments of every document (split on '.'), position 0-based.
    The piece after a final '.' is empty or blank: a real blank-text defect."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", r"\.")).alias("pos", "frag"))


def q_blank_to_null(spark, d):
    return _fragments(spark, d).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), clean.blank_to_null("frag").alias("v")
    )


def q_normalize_vocab(spark, d):
    c = read_table(spark, d, "customer")
    return c.select("c_custkey", clean.normalize_vocab("c_mktsegment", SEGMENT_VOCAB).alias("seg"))


def q_profile_flag(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id")
    labels = read_table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", clean.is_complete("quality", "toxic").alias("complete")
    )


def q_typed_cast(spark, d):
    o = read_table(spark, d, "orders")
    text_ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        "o_orderkey",
        clean.typed_int(F.col("o_custkey").cast("string"), bits=64).alias("i"),
        clean.typed_timestamp(text_ts).alias("t"),
        clean.typed_date(text_ts).alias("d"),
    )


def _mixed_dates(spark, d):
    o = read_table(spark, d, "orders")
    t = F.when(
        F.col("o_orderstatus") == PROSE_STATUS, F.date_format("o_orderdate", "MMMM dd, yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", t.alias("t"))


def q_parse_mixed_dates(spark, d):
    return _mixed_dates(spark, d).select("o_orderkey", clean.parse_mixed_dates("t").alias("d"))


def q_partial_dates(spark, d):
    """F9 guards: an order's date cut to its year or month isn't a date, one
    with slashes is, by order status."""
    o = read_table(spark, d, "orders")
    layouts = {"F": "yyyy", "O": "yyyy-MM", "P": "yyyy/MM/dd"}
    text = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.date_format("o_orderdate", f)) for k, f in layouts.items()])
    return o.select("o_orderkey", text.alias("t")).select(
        "o_orderkey", clean.parse_mixed_dates("t").alias("d"), clean.unparsable_iso_date("t").alias("bad")
    )


# ---------------------------------------------------------------- data quality

def _doc_rows(spark, d):
    """documents with the text replaced by its digest (row identity kept)."""
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", text_digest("text").alias("text_h"), "lang", "source")


def q_dq_exact_duplicates(spark, d):
    return quality.exact_duplicates(_doc_rows(spark, d), ["text_h", "lang", "source"], "doc_id").select(
        "first_doc_id", "lang", "source", "copies"
    )


def q_dq_conflicting_duplicates(spark, d):
    """Texts carried by rows that differ in their other attributes."""
    rows = _doc_rows(spark, d).select("doc_id", "text_h", "lang", "source")
    c = quality.conflicting_duplicates(rows, ["text_h"], "doc_id")
    return c.select("first_doc_id", "copies", "versions")


def q_dq_blank_or_null(spark, d):
    return quality.blank_or_null_counts(_fragments(spark, d), "frag")


def q_dq_null_profile(spark, d):
    docs = read_table(spark, d, "documents")
    return quality.blank_or_null_profile(docs, ["text", "lang", "source"])


def q_dq_date_format(spark, d):
    return quality.date_format_issues(_mixed_dates(spark, d), "t")


def q_dq_vocab(spark, d):
    return quality.vocab_violations(read_table(spark, d, "customer"), "c_mktsegment", ACCEPTED_SEGMENTS)


def q_dq_orphans(spark, d):
    return quality.orphans(
        read_table(spark, d, "customer").select("c_custkey"),
        read_table(spark, d, "events"),
        "c_custkey",
        "user_id",
    )


def _words(spark, d):
    docs = read_table(spark, d, "documents").select("text")
    return docs.select(F.explode(F.split("text", r"\s+")).alias("w")).where(F.col("w") != "")


def q_dq_case_variants(spark, d):
    return quality.case_variants(_words(spark, d), "w")


def q_dq_duplicate_pairs(spark, d):
    return quality.duplicate_pairs(read_table(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


def q_dq_reconciliation(spark, d):
    return quality.reconciliation(_doc_rows(spark, d), F.count_distinct("text_h"))


def q_dq_model_reconciliation(spark, d):
    """Raw extracts against the built model: events vs fact rows, lineitem
    (supplier, part) rows vs bridge pairs."""
    return quality.model_reconciliation(
        raw_forecasts(spark, d), q_fct_build(spark, d),
        read_table(spark, d, "lineitem"), q_bridge_tags(spark, d),
    )


def q_dq_issue_register(spark, d):
    """Documents are read twice: once for copies, conflicts and blanks (one
    aggregate on digest, language and source), once for their words."""
    cust = read_table(spark, d, "customer")
    blanks = F.size(F.filter(F.split("text", r"\."), lambda x: F.trim(x) == "")).cast("long")
    docs = read_table(spark, d, "documents").select(text_digest("text").alias("text_h"), "lang", "source", blanks.alias("blanks"))
    versions = docs.groupBy("text_h", "lang", "source").agg(F.count(F.lit(1)).alias("copies"), F.sum("blanks").alias("blanks"))
    texts = versions.groupBy("text_h").agg(
        F.sum(F.col("copies") - 1).alias("copies"),
        F.count(F.lit(1)).alias("versions"),
        F.sum("blanks").alias("blanks"),
    )
    found = texts.agg(
        F.sum("copies").alias("copies"), F.count_if(F.col("versions") > 1).alias("conflicts"), F.sum("blanks").alias("blanks")
    )
    documents = quality.issues(
        found,
        [
            ("copies", "high", "documents", "*", "exact duplicate rows", "keep one row per group"),
            ("conflicts", "high", "documents", "text", "same text, different attributes", "pick a survivor by a total order"),
            ("blanks", "medium", "documents", "text", "blank text standing for NULL", "NULLIF(TRIM(x), '')"),
        ],
    )
    issues = [
        documents,
        quality.issue(_mixed_dates(spark, d), F.count_if(clean.unparsable_iso_date("t")), "medium",
                      "orders", "o_orderdate", "mixed date formats", "COALESCE of typed parses"),
        quality.issue(quality.vocab_violations(cust, "c_mktsegment", ACCEPTED_SEGMENTS), F.sum("n"),
                      "low", "customer", "c_mktsegment", "no controlled vocabulary", "map variants"),
        quality.issue(q_dq_orphans(spark, d), F.count(F.lit(1)), "low", "customer", "c_custkey",
                      "registered but never active", "keep, flag is_active"),
        quality.issue(quality.case_variants(_words(spark, d), "w"), F.count(F.lit(1)), "low",
                      "documents", "text", "case variants of one value", "LOWER(TRIM(x))"),
        quality.issue(q_dq_duplicate_pairs(spark, d), F.count(F.lit(1)), "low", "lineitem",
                      "l_returnflag", "duplicate pairs after normalising", "DISTINCT after normalising"),
    ]
    return quality.issue_register(issues)


# ---------------------------------------------------------------- sources / sinks

def _csv_copy(spark, d, table, name):
    """Write a driver table as a headed CSV extract into the shared scratch
    folder; return its path."""
    path = scratch_path(spark, name)
    read_table(spark, d, table).write.mode("overwrite").option("header", True).csv(path)
    return path


def q_scan_csv_strings(spark, d):
    path = _csv_copy(spark, d, "customer", "csv_customer")
    schema = schemas.all_strings("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return csv_src.scan_csv_strings(spark, path, schema)


def q_scan_csv_quoted(spark, d):
    """Cells with commas (prose dates) are quoted, and empty cells
    (the date of open orders) become NULL."""
    o = _mixed_dates(spark, d).join(read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    path = scratch_path(spark, "csv_orders")
    cells = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("t")).alias("o_date"), "o_orderpriority")
    cells.write.mode("overwrite").option("header", True).csv(path)
    return csv_src.scan_csv_strings(spark, path, schemas.all_strings("o_orderkey", "o_date", "o_orderpriority"))


# Raw extracts written from driver tables for the multi-source load.
RAW_EXTRACTS = {"customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
                "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
                "supplier": "s_suppkey s_name s_nationkey s_acctbal"}


def q_load_raw(spark, d):
    paths = {t: _csv_copy(spark, d, t, f"raw_{t}") for t in RAW_EXTRACTS}
    raw = csv_src.load_raw(spark, paths, {t: schemas.all_strings(*c.split()) for t, c in RAW_EXTRACTS.items()})
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
             for t, df in raw.items()]
    return reduce(DataFrame.unionByName, parts)


def q_load_audit(spark, d):
    counts = {}
    for t in ("customer", "orders", "supplier"):
        path = scratch_path(spark, f"audit_{t}")
        counts[t] = sinks.write_with_audit(read_table(spark, d, t), path, t)
    return sinks.audit_frame(spark, counts).withColumnRenamed("table", "table_name")


def q_materialize_table(spark, d):
    path = scratch_path(spark, "dim_date")
    sinks.materialize_table(_dim_date(spark, d), path, sort_within=["date_day"])
    return spark.read.parquet(path)


def q_mart_export_json(spark, d):
    mart = _summary(spark, d)
    path = scratch_path(spark, "question_summary_json")
    sinks.export_json(mart, path)
    return spark.read.schema(mart.schema).json(path)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
