"""Operators over documents against plain versions, defined cases included."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from augur.llm import decontaminate, mixing, pii, quality_rules, simhash_dedup, substring_dedup
from augur.llm.components import components

from . import brute
from .conftest import clashing


@pytest.mark.parametrize("max_group", [32_768, 3])
def test_substring_dedup(docs, texts, same, max_group):
    found = substring_dedup.remove_repeats(docs, max_group=max_group)
    expected = brute.repeats(texts)
    assert sum(r[2] for r in expected) > 500
    same(found.withColumn("sha", F.sha2("kept_text", 256)), expected, ["doc_id", "n_words", "n_removed", "sha"])
    for row in found.collect():
        assert sum(s["end"] - s["start"] for s in row["removed"]) == row["n_removed"]


def test_substring_dedup_small_window(docs, texts, same):
    found = substring_dedup.remove_repeats(docs, window=5, gram=2)
    same(found.withColumn("sha", F.sha2("kept_text", 256)), brute.repeats(texts, 5), ["doc_id", "n_words", "n_removed", "sha"])


def test_substring_dedup_clashes_and_empty(docs, empty):
    found = substring_dedup.remove_repeats(clashing(docs))
    assert found.count() == docs.count()
    row = found.filter("doc_id = 0").first()
    assert row["gram"] == "own gram" and row["copies"] == "own copies" and isinstance(row["n_words"], int)
    assert substring_dedup.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(docs, window=5, gram=8)


@pytest.mark.parametrize("max_group", [4096, 2])
def test_simhash(docs, texts, same, max_group):
    found = simhash_dedup.near_duplicates(docs, max_group=max_group)
    same(found, brute.simhash(texts), ["doc_id", "fingerprint", "component_id"])


def test_simhash_wide_distance(docs, texts, same):
    found = simhash_dedup.near_duplicates(docs, shingle=2, distance=10, max_group=16)
    expected = []
    names = {t: brute.fingerprint(t, 2) for _, t in texts}
    fps = sorted(set(names.values()))
    group = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 10 and group[a] < group[b]:
                    group[b], changed = group[a], True
    least = {}
    for i, t in texts:
        if i is not None:
            g = group[names[t]]
            least[g] = min(i, least.get(g, i))
    expected = [(i, f"{names[t]:016x}", least.get(group[names[t]])) for i, t in texts]
    same(found, expected, ["doc_id", "fingerprint", "component_id"])


def test_simhash_dense_group_keeps_all_links(spark, same):
    """Many fingerprints close to one another: groups must be split, no link lost."""
    import random

    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(300)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, max_group=8)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    up = {f: f for f in signed}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 4:
                up[root(signed[i])] = root(signed[j])
    groups, expected = {}, {}
    for f in signed:
        groups.setdefault(found.get(f, f), set()).add(f)
        expected.setdefault(root(f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_keep_one(docs, texts, spark, empty):
    kept = simhash_dedup.keep_one(clashing(docs))
    expected = {c for i, _, c in brute.simhash(texts)}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(c for c in expected if c is not None)
    assert kept.columns == clashing(docs).columns
    assert simhash_dedup.keep_one(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e"), (None, "q r s t u v"), (None, "q r s t u v")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash_dedup.keep_one(nameless).collect()) == ["a b c d e", "q r s t u v"]


@pytest.mark.parametrize("repeated", [False, True])
def test_keep_one_with_and_without_a_broadcast(docs, same, repeated):
    rows = docs.select("doc_id", "text")
    rows = rows if repeated else rows.dropDuplicates()
    few, many = simhash_dedup.keep_one(rows), simhash_dedup.keep_one(rows, max_broadcast=0)
    same(few, [tuple(r) for r in many.collect()])
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) is not repeated


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (200, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert {k: v for k, v in found.items() if k != v} == {**{i: 0 for i in range(1, 41)}, 100: 90}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


BENCH = [
    (7, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
    (8, "Short ITEM here"),
    (10, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (10, "alone"),
    (11, None),
    (12, " . , "),
    (None, "nameless item words"),
]


@pytest.fixture(scope="session")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def contaminated_rows(texts):
    more = [
        (300, "x y " + BENCH[0][1].upper().replace(" ", "--") + " z"),
        (301, "aa short item here bb nameless; item words cc"),
        (302, " ".join(["pad"] * 200) + " alone " + " ".join(["pad"] * 200)),
        (303, "alone"),
        (303, "alone"),
        (304, "one two three"),
    ]
    return [*texts, *more]


@pytest.mark.parametrize("max_broadcast", [64 << 20, 0])
def test_decontamination(spark, texts, bench, same, max_broadcast):
    rows = contaminated_rows(texts)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    verdicts = decontaminate.judge(docs, bench, max_broadcast=max_broadcast)
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("d1"), F.xxhash64(F.lit(7), F.coalesce("text", F.lit(""))).alias("d2"))
    found = keyed.join(verdicts, ["d1", "d2"]).withColumn("sha", F.sha2(F.array_join("items", ","), 256))
    expected = brute.contamination(rows, BENCH)
    assert any(r[-1] for r in expected)
    same(found, expected, ["doc_id", "n_words", "n_hit", "n_items", "sha", "contaminated"])
    spans = found.filter("n_hit > 0").select("n_hit", "spans").collect()
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in spans)


def test_remove_contaminated(spark, docs, bench, empty):
    kept = decontaminate.remove_contaminated(clashing(docs), bench)
    assert kept.count() == docs.count() and kept.columns == clashing(docs).columns
    bad = spark.createDataFrame([(1, "alone", "x"), (2, "clean text", "y"), (3, None, "z")], "doc_id long, text string, d1 string")
    assert sorted(r["doc_id"] for r in decontaminate.remove_contaminated(bad, bench).collect()) == [2, 3]
    none = bench.filter("item_id = 99")
    assert decontaminate.remove_contaminated(docs, none).count() == docs.count()
    assert decontaminate.judge(empty, bench).count() == 0


def test_base_rules(docs, texts, same, spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    found = quality_rules.judge_quality(clashing(docs), labels)
    same(found, brute.base_rules(texts), ["doc_id", *quality_rules.MEASURES, "base_failed"])
    assert found.first()["fp"] == "own fp"
    assert found.filter("base_failed and kept").count() == 0


def test_viterbi_is_the_best_path():
    import itertools
    import random

    rng = random.Random(1)
    for n in range(1, 7):
        scores = [[rng.uniform(-2, 2), rng.uniform(-2, 2)] for _ in range(n)]
        moves = [[rng.uniform(-2, 2) for _ in range(2)] for _ in range(2)]
        worth = lambda p: sum(scores[i][s] for i, s in enumerate(p)) + sum(moves[a][b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=n), key=worth)
        assert worth(quality_rules.viterbi(scores, moves)) == pytest.approx(worth(best))
    assert quality_rules.viterbi([], moves) == []
    assert quality_rules.viterbi([[0.0, 0.0]] * 3, [[0.0, 0.0]] * 2) == [1, 1, 1]


def test_line_field_on_labelled_documents(spark):
    """Held out: labelled documents that weren't in the training sample."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = labels.filter("quality is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(500).select("doc_id")
    judged = quality_rules.judge_quality(docs.select("doc_id", "text"), labels, sample=500)
    held = judged.join(labels.join(ids, "doc_id", "left_anti"), "doc_id").filter("not base_failed")
    right = held.groupBy("quality").agg(F.avg((F.col("kept") == (F.col("quality") > 0)).cast("int")).alias("right")).collect()
    assert {r["quality"]: r["right"] for r in right}[1] > 0.99
    assert {r["quality"]: r["right"] for r in right}[0] > 0.9


def test_without_labels_all_is_content(docs, spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality_rules.judge_quality(docs, none)
    assert judged.filter("not base_failed and not kept").count() == 0
    assert quality_rules.judge_quality(empty, none).count() == 0


def test_fingerprint_matches_definition():
    for text in ["", "a", "A b C", "a b c d e f g a b c d", "é ß 中文 x y"]:
        assert simhash_dedup.fingerprint(text.encode()) == brute.fingerprint(text)
    assert hashlib.sha256(b"").hexdigest() == brute.sha("")


def test_expected_counts_are_those_of_all_paths():
    """Forward-backward against the sum over every state sequence."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    seqs = [rng.integers(0, 3, size=(n, len(quality_rules.RANGES))) for n in (1, 3, 4)]
    seqs = [(s + quality_rules.BASE[:-1]).clip(max=quality_rules.N_FEATURES - 1).astype(np.int16) for s in seqs]
    weights, moves = rng.normal(size=(quality_rules.N_FEATURES, 2)), rng.normal(size=(2, 2))
    found, joint = quality_rules.Batch(seqs, [0, 1, 1], np.array([0.5, 2.0])).expected(weights, moves)
    exp_found, exp_joint = np.zeros_like(found), np.zeros((2, 2))
    for seq, weight in zip(seqs, (0.5, 2.0, 2.0), strict=True):
        score = weights[seq].sum(axis=1)
        paths = list(itertools.product((0, 1), repeat=len(seq)))
        mass = np.exp([sum(score[i, s] for i, s in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p)) for p in paths])
        for p, w in zip(paths, mass / mass.sum() * weight, strict=True):
            for i, s in enumerate(p):
                np.add.at(exp_found, (seq[i], s), w)
            for a, b in itertools.pairwise(p):
                exp_joint[a, b] += w
    assert np.allclose(found, exp_found) and np.allclose(joint, exp_joint)


def test_small_tables_go_to_few_files(spark, docs):
    """However many shuffle partitions there are: a file starts processes beside the executor (chmod), so hundreds
    of tiny ones a table cost more than the rows."""
    tables = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "tables")
    earlier = set(tables.glob("*"))
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    named = spark.createDataFrame([(i, f"w{i}@example{i % 7}.org, 10.0.{i}.7") for i in range(80)], "doc_id long, text string")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert simhash_dedup.keep_one(docs).count() > 60
        pii.redrawn(named)
        assert mixing.mix(docs).rdd.getNumPartitions() <= docs.rdd.getNumPartitions() + 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files: dict[str, set[int]] = {}
    for path in set(tables.glob("*")) - earlier:
        files.setdefault(path.name.rsplit("-", 1)[0], set()).add(len(list(path.glob("part-*.parquet"))))
    assert max(files["entities"]) > 1  # not counted beforehand
    for name in ("nodes", "least", "classes", "names", "near_duplicates", "keep", "gone", "surrogates", "good", "pending"):
        assert files[name] == {1}, name
