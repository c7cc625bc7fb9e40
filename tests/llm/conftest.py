import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def rows():
    """Documents with copies, shared passages, nulls, blanks, repeated rows and long texts."""
    rng = random.Random(5)
    out = []
    passage = words(rng, 60)
    for i in range(60):
        w = words(rng, rng.randrange(1, 160))
        if i % 4 == 0:
            at = rng.randrange(len(w) + 1)
            w = w[:at] + passage[rng.randrange(20) :] + w[at:]
        out.append((i, rng.choice([" ", "  ", "\n", " \t"]).join(w)))
    out += [(100, out[3][1]), (101, out[3][1]), (102, out[8][1] + " tail"), (102, out[8][1] + " tail")]
    out += [(103, None), (104, ""), (105, " \n\t "), (103, None), (None, out[5][1]), (None, None)]
    out += [(106, "same " * 300), (107, " ".join(words(rng, 30_000, 5000))), (108, "x" * 50_000), (109, "été ÀÉÎ ß 中文 字 \x00 z")]
    return [(i, t, ["en", "fr", None][k % 3], f"src{k % 4}" if k % 5 else None, len(t or "")) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ordered(found):
    return sorted(found, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


@pytest.fixture(scope="session")
def same():
    def check(df, expected, columns=None):
        df = df.select(*columns) if columns else df
        assert ordered(map(tuple, df.collect())) == ordered(map(tuple, expected))

    return check


def clashing(df):
    """Extra columns named as the operators' own."""
    names = ("n_words", "d1", "copies", "removed", "kept", "fp", "gram", "component_id", "contaminated", "entities", "lang_pred", "domain", "n_tokens", "r1", "host")
    return df.withColumns({c: F.lit(f"own {c}") for c in names})
