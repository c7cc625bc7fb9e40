"""Vector codes and whitening against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from augur.llm import vector_codes, whitening

from .conftest import clashing

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) and the codebooks' digest, in Python integers."""
    from fractions import Fraction

    kept = [(i, [int(Fraction(float(c)) * 256 // 1) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    cut = [[v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0], kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, x: min((apart(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for k, m in members.items():
                books[p][k] = [sum(col) // len(m) for col in zip(*m, strict=True)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    totals = {}
    for (_, _, lab), f in zip(kept, found, strict=True):
        totals[lab] = totals.get(lab, 0) + sum(d for d, _ in f)
    out = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), totals[lab]) for (i, _, lab), f in zip(kept, found, strict=True)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vectors(n, dim, seed=1, step=0.01):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 0.2) / step) * step for _ in range(dim)], rng.choice([0, 1, None])) for i in range(n)]
    same = [0.25] * dim  # a third of all rows
    rows += [(n + i, same, 7) for i in range(n // 2)]
    rows += [rows[3], rows[3], (None, rows[5][1], 2), (10_000, None, 1), (10_001, [float("nan")] * dim, 1)]
    rows += [(10_002, [float("inf")] + [0.0] * (dim - 1), 1), (10_003, [None] + [0.0] * (dim - 1), 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "dim", "step"), [(150, 32, 0.01), (300, 16, 0.2), (20, 64, 0.01), (200, 48, 1.0)])
def test_codes_match_a_plain_version(spark, same, n, dim, step):
    rows = vectors(n, dim, step=step)
    # coarse steps and duplicate entries make many ties
    df = clashing(spark.createDataFrame([(a, np.array(b, dtype=object).tolist() if b else b, c) for a, b, c in rows], VECTORS).repartition(4))
    floats = [(a, None if b is None else [None if x is None else float(np.float32(x)) for x in b], c) for a, b, c in rows]
    expected, digest = plain_codes(floats)
    codes, books = vector_codes.encode(df)
    assert books.digest() == digest
    found = vector_codes.with_totals(vector_codes.stored(codes, "codes"), "label", "error", "label_error")
    same(found.select("vec_id", "code", "error", "label_error"), expected)


def test_salted_totals_equal_broadcast_ones(spark, same):
    rows = spark.createDataFrame([(i, None if i % 3 else 1 + i % 2, i) for i in range(500)], "vec_id long, label int, error long")
    expected = vector_codes.with_totals(rows, "label", "error", "t").collect()
    same(vector_codes.with_totals(rows, "label", "error", "t", max_broadcast=0, salts=5), [tuple(r) for r in expected])


@pytest.mark.parametrize("scale", [1, 1e6])
def test_orchard_search_equals_all_distances(scale):
    rng = np.random.default_rng(3)
    for width, size in [(1, 40), (4, 64), (8, 200), (2, 1)]:
        entries = np.floor(rng.normal(0, 6 * scale, (3, size, width))).astype(np.int64)
        entries[:, size // 2 :] = entries[:, : size - size // 2]  # equal entries: the lower index wins
        x = np.floor(rng.normal(0, 6 * scale, (500, 3, width))).astype(np.int64)
        codes, apart = vector_codes.Codebooks(entries).search(x)
        away = ((x[:, :, None] - entries[None]) ** 2).sum(axis=3)
        assert (codes == away.argmin(axis=2)).all() and (apart == away.min(axis=2)).all()


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(10**7 + 3 * i), -1.0e7] * 8, 0) for i in range(80)]
    expected, digest = plain_codes(rows)
    codes, books = vector_codes.encode(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert books.digest() == digest
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in codes.collect()) == [e[:3] for e in expected]


def test_code_cases(spark, tmp_path):
    empty = spark.createDataFrame([], VECTORS)
    empty.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = vector_codes.op11_vector_codes(spark, str(tmp_path))
    assert found.count() == 0 and found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    nulls = spark.createDataFrame([(1, None, 1), (2, [None] * 16, 1)], VECTORS)
    assert vector_codes.encode(nulls)[0].count() == 0
    with pytest.raises(ValueError):
        vector_codes.encode(spark.createDataFrame([(1, [0.5] * 10, 1)], VECTORS))
    mixed = spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], VECTORS)
    with pytest.raises(Exception, match="components"):
        vector_codes.encode(mixed)[0].collect()


# -- whitening ----------------------------------------------------------------


def plain_whitening(kept, components=32):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in kept], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return x, (n * x - s) ** 2, values[order], centred @ axes[:, order] / np.sqrt(values[order]), values.sum()


def test_whitening_matches_a_plain_version(spark, tmp_path):
    rows = vectors(300, 40)
    floats = [(a, None if b is None else [None if x is None else float(np.float32(x)) for x in b], c) for a, b, c in rows]
    clashing(spark.createDataFrame(floats, VECTORS)).withColumn("component", F.lit("own")).repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op13_embedding_whitening(spark, str(tmp_path)).toPandas()
    kept = [r for r in floats if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    x, squares, values, plain, trace = plain_whitening([r[1] for r in kept])
    assert len(found) == 32 * len(kept) and set(found.n) == {len(kept)} and set(found.component) == set(range(1, 33))
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    explained = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values / trace, rtol=1e-9) and (np.diff(explained) <= 0).all()
    at = {r[0]: k for k, r in enumerate(kept)}
    once = found.drop_duplicates(["vec_id", "component"])
    wide = once.pivot(index="vec_id", columns="component", values="whitened")
    place = [at[None if i != i else i] for i in wide.index.to_numpy()]
    sign = np.sign((wide.to_numpy() * plain[place]).sum(axis=0))
    assert np.allclose(wide.to_numpy() * sign, plain[place], atol=1e-8)
    deviation = once[once.component == 1].set_index("vec_id").deviation
    assert [int(v) for v in deviation.to_numpy()] == [int(squares[at[None if i != i else i]].sum()) for i in deviation.index]
    # rows of equal vectors have equal values, repeated rows stay
    assert (found[found.vec_id == rows[3][0]].shape[0] % 32) == 0


def test_factor_and_rotations_keep_small_eigenvalues():
    rng = np.random.default_rng(5)
    graded = np.diag(10.0 ** -np.arange(12)) @ (np.eye(12) + 0.1 * rng.normal(size=(12, 12)))
    c = graded @ graded.T
    factor = whitening.pivoted_cholesky(c)
    assert factor.shape == (12, 12) and np.allclose(factor @ factor.T, c, rtol=1e-12, atol=0)
    values, axes = whitening.one_sided_jacobi(factor)
    exact = np.linalg.svd(graded, compute_uv=False) ** 2
    assert np.allclose(values[:6], exact[:6], rtol=1e-9)
    assert np.allclose(axes.T @ axes, np.eye(12), atol=1e-12)
    # diagonal, graded over 24 powers of ten: every eigenvalue to full relative accuracy
    d = 10.0 ** -np.arange(0, 24, 2)
    assert np.allclose(whitening.one_sided_jacobi(whitening.pivoted_cholesky(np.diag(d)))[0], d, rtol=1e-14)


def test_dependent_dimensions_give_fewer_components(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        a, b = rng.randrange(-50, 50), rng.randrange(-50, 50)
        rows.append((i, [a / 64, b / 64, (a + b) / 64, 1.0, a / 64], 0))
    df, fitted = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert len(fitted.values) == 2 and {len(r["whitened"]) for r in df.collect()} == {2}
    assert fitted.explained.sum() == pytest.approx(1) and whitening.identity_error(df.sparkSession.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), fitted) < 1e-10


def test_products_and_deviations_beyond_64_bits():
    x = np.array([[1 << 40, -(1 << 40)], [3, 5]], dtype=np.int64)
    assert (whitening.exact_products(x) == x.astype(object).T @ x.astype(object)).all()
    small = np.arange(-50, 50, dtype=np.int64).reshape(50, 2)
    assert (whitening.exact_products(small) == small.T @ small).all()
    fitted = whitening.Scatter(10**9, [5 * 10**8 + 1, 3], np.array([0, 0]), [[1, 0], [0, 1]])
    w = whitening.Whitener(fitted, np.ones(1), np.ones((2, 1)), np.ones(1))
    rows = np.array([[7, -9], [0, 100]], dtype=np.int64)
    assert w.deviations(rows) == [sum((10**9 * int(v) - s) ** 2 for v, s in zip(r, fitted.sums, strict=True)) for r in rows]


def test_whitening_cases(spark, tmp_path):
    spark.createDataFrame([], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op13_embedding_whitening(spark, str(tmp_path))
    assert found.count() == 0 and found.columns[:4] == ["vec_id", "component", "n", "deviation"]
    one, fitted = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], 1), (2, None, 0)], VECTORS))
    assert one.count() == 0 and fitted.fitted.n == 1
    with pytest.raises(Exception, match="entries"):
        whitening.whiten(spark.createDataFrame([(1, [0.5] * 2, 1), (2, [0.5] * 3, 1)], VECTORS))
