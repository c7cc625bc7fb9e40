"""Mixing, url reputation, tool calls, registry and pipeline."""

import json
import os
import random
import subprocess
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from augur.llm import mixing, tool_calls, url_reputation

from . import brute
from .conftest import clashing, ordered

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# -- mixing -------------------------------------------------------------------


def shared(given, children):
    """(weight, room) -> shares: raise the level until the budget is spent."""
    out, open_ = {}, dict(children)
    while open_:
        level = (given - sum(out.values())) / sum(w for w, _ in open_.values())
        full = {k: r for k, (w, r) in open_.items() if r / w <= level}
        if not full:
            return out | {k: int(level * w // 1) for k, (w, _) in open_.items()}
        # fill in order, as each changes the level of the rest
        k = min(full, key=lambda c: (open_[c][1] / open_[c][0], c))
        out[k] = open_.pop(k)[1]
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 500)), min_size=1, max_size=9), st.integers(0, 2000))
def test_share_out(spark, children, budget):
    room = sum(r for _, r in children)
    budget = min(budget, room)
    rows = [(f"c{i}", w, r, budget) for i, (w, r) in enumerate(children)]
    df = spark.createDataFrame(rows, "c string, weight long, room long, given long").coalesce(1)
    found = {r["c"]: r["budget"] for r in mixing.share_out(df, [], "c").collect()}
    assert found == shared(budget, {c: (w, r) for c, w, r, _ in rows})
    assert budget - len(rows) < sum(found.values()) <= budget and all(found[c] <= r for c, _, r, _ in rows)


def expected_mix(rows, budget, epochs, seed):
    import hashlib

    tree = {}
    for doc_id, domain, lang, source, n in rows:
        if n:
            tree.setdefault(domain, {}).setdefault(lang, {}).setdefault(source, []).append((doc_id, n))
    tokens = lambda t: sum(map(tokens, t.values())) if isinstance(t, dict) else sum(n for _, n in t)
    weights = mixing.WEIGHTS
    out = []
    whole = tokens(tree) if tree else 0
    for domain, d_given in shared(min(budget(whole), whole * epochs), {k: (weights["domain"].get(k, 1), tokens(t) * epochs) for k, t in tree.items()}).items():
        for lang, l_given in shared(d_given, {k: (weights["language"].get(k, 1), tokens(t) * epochs) for k, t in tree[domain].items()}).items():
            for source, given in shared(l_given, {k: (weights["origin"].get(k, 1), tokens(t) * epochs) for k, t in tree[domain][lang].items()}).items():
                leaf = tree[domain][lang][source]
                full, rest = divmod(given, tokens(leaf))
                at = 0
                for doc_id, n in sorted(leaf, key=lambda x: hashlib.md5(f"{seed}-{full}-{x[0]}".encode()).hexdigest()):
                    at += n
                    if full + (at <= rest):
                        out.append((doc_id, domain, lang, source, n, full + (at <= rest)))
    return out


@pytest.mark.parametrize("share", [0.05, 0.6, 1.0, 1.7, 5.0])
def test_mix_matches_a_plain_version(spark, same, share):
    rng = random.Random(8)
    rows = [(i, " ".join(["t"] * rng.choice([0, 1, 3, 20, 400])), rng.choice(["en", "en", "de", None]), rng.choice(["src0", "src1", "src2", "src3", None])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    flat = docs.select("doc_id", F.coalesce(mixing.domain_of(F.col("source")), F.lit("?")), F.coalesce("lang", F.lit("?")), F.coalesce("source", F.lit("?")), mixing.tokens_of(F.col("text"))).collect()
    found = mixing.mix(docs, budget=F.col("tokens") * share, seed="s")
    same(found, expected_mix([tuple(r) for r in flat], lambda t: int(t * share // 1), mixing.EPOCHS, "s"), ["doc_id", *mixing.ADDED])


def test_mix_cases(docs, empty):
    found = mixing.mix(clashing(docs), budget=F.lit(10**9))
    tokens = docs.filter(mixing.tokens_of(F.col("text")) > 0)
    assert found.count() == tokens.count() and {r["copies"] for r in found.collect()} == {2}
    assert found.first()["host"] == "own host"
    assert mixing.mix(empty).count() == 0
    joined = mixing.mix(docs, budget=F.lit(10**9), max_broadcast=0)
    assert joined.count() == found.count()
    only = mixing.mix(docs, weights={"origin": {"src1": 0, "src2": 0, "src3": 0, "?": 0}}, budget=F.col("tokens"))
    assert {r["origin"] for r in only.collect()} == {"src0"}


# -- urls ---------------------------------------------------------------------

URLS = [
    "https://www.Example.com/en/1?x", "http://a.example.com/en/2#t", "http://example.com/de/3", "http://q.net/es/1", "http://q.net/en/1",
    "http://com/", "http://com", "http://acom/x", "no scheme", "", None, "ftp://u:p@h.co.uk:81/a//b?c://d", "x://y?z/a", "x://#", "a\nb://c.org/p\nq?r",
    "http://q.net/es/1",
]


def test_host_path_and_rules(spark):
    import re

    pages = clashing(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string"))
    none = pages.select("url", F.lit(None).cast("boolean").alias("bad"))
    found = url_reputation.judge_urls(pages, none)
    assert found.count() == len(URLS) and found.first()["d1"] == "own d1"
    for row in found.collect():
        url = URLS[row["page_id"]] or ""
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
        host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m.group(1)), m.group(2)) if m else ("", "")
        fits = [(len(r), r, v) for v, r in url_reputation.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == (max(fits)[1] if fits else None)
        assert row["verdict"] == (max(fits)[2] if fits else "allow")
    assert url_reputation.judge_urls(pages.limit(0), none.limit(0)).count() == 0
    assert url_reputation.judge_urls(pages, none, rules=()).filter("rule is not null").count() == 0


def test_shrinkage_orders_hosts(spark):
    rows = [("http://bad.x.org/1", True)] * 40 + [("http://few.x.org/1", True)] * 1 + [("http://good.y.org/1", False)] * 60 + [("http://mid.y.org/", False)] * 3
    outcomes = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(u,) for u in ["http://bad.x.org/", "http://few.x.org/", "http://new.x.org/", "http://good.y.org/", "http://new.y.org/"]], "url string")
    rate = {r["host"]: r for r in url_reputation.judge_urls(pages, outcomes, rules=()).collect()}
    assert rate["bad.x.org"]["bad_rate"] > rate["few.x.org"]["bad_rate"] > rate["new.y.org"]["bad_rate"] > rate["good.y.org"]["bad_rate"]
    assert rate["new.x.org"]["bad_rate"] > rate["new.y.org"]["bad_rate"]
    assert rate["bad.x.org"]["verdict"] == "block" and rate["good.y.org"]["verdict"] == "allow"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_agrees(spark, sf):
    from augur.llm.queries import ORACLE_SQL, QUERIES

    folder = f"/root/testdata/{sf}"
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        found = QUERIES[name](spark, folder)
        cursor = db.execute(sql)
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(found.columns), name
        assert ordered(map(tuple, found.select(*columns).collect())) == ordered(cursor.fetchall()), name


# -- tool calls ---------------------------------------------------------------

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"


def lines(spark, calls, results=()):
    found = tool_calls.link_calls(
        spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), "conv_id long, call_id string, turn long, content string"), tool_calls.CHAT_SCHEMAS
    )
    return [r.asDict() | {"line": json.loads(r["json"])} for r in found.orderBy("conv_id", "position").collect()]


def test_links_order_and_validation(spark):
    good = '{"message":"x","turn":1.0}'
    calls = [
        (1, "a", 0, "reply", good, ["b"]), (1, "b", 5, "reply", '{"turn":-1,"message":""}', []), (1, "c", 1, "reply", "{}", ["d"]),
        (1, "d", 2, "nope", "[1]", ["c"]), (1, "e", 3, "reply", good, ["zz", "a"]), (None, "f", 3, "reply", good, None),
        (1, None, 3, "reply", "NaN", []), (1, "a", 0, "reply", good, ["b"]), (2, "a", 0, "configure", '{"instructions":"i","more":1}', []),
    ]
    found = lines(spark, calls, [(1, "a", 9, "ra"), (1, "a", 8, "rb"), (1, "x", 8, "rx"), (None, "a", 1, "n"), (2, "a", 1, None)])
    one = {r["call_id"]: r for r in found if r["conv_id"] == 1}
    order = [r["call_id"] for r in found if r["conv_id"] == 1]
    assert order.index("b") < order.index("a") < order.index("e") < order.index("c") < order.index("d")
    assert one["a"]["valid"] and one["a"]["line"]["result"] == "ra" and one["a"]["line"]["results"] == 2
    assert one["a"]["line"]["arguments"] == {"message": "x", "turn": 1}
    assert one["b"]["errors"] == ["message: too short", "turn: under 0"] and one["b"]["status"] == "open"
    assert "cycle" in one["c"]["errors"] and "unknown tool" in one["d"]["errors"] and one["x"]["status"] == "orphan"
    assert one["e"]["errors"] == ["unknown dependency"] and one[None]["errors"] == ["arguments: not JSON"]
    assert sorted(r["position"] for r in found if r["conv_id"] == 1) == list(range(1, 8))
    assert [r["errors"] for r in found if r["conv_id"] == 2] == [["arguments: unknown more"]]
    assert sum(r["conv_id"] is None for r in found) == 2
    assert lines(spark, []) == []


def test_no_turn_is_lost(spark, tmp_path):
    turns = [
        (1, 0, "user", "q1"), (1, 0, "user", "q2"), (1, 0, "user", "q2"), (1, 1, "assistant", "a1"), (1, 1, "assistant", "a2"), (1, 1, "assistant", "a2"),
        (1, 1, "assistant", None), (1, 2, "tool", "t1"), (1, 2, None, "n1"), (1, 3, "assistant", "a3"), (None, 0, "tool", "t2"),
    ]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = [r.asDict() | {"line": json.loads(r["json"])} for r in tool_calls.op5_tool_call_linking(spark, str(tmp_path)).collect()]
    asked = sorted((r["status"], r["name"], r["line"]["arguments"]["message"]) for r in found if r["name"] not in (None,))
    assert asked == [("duplicate", "reply", "q2"), ("linked", "reply", "q1"), ("open", "tool", "t1"), ("open", "tool", "t2")]
    assert sorted((r["status"], str(r["line"].get("result")), r["line"]["results"]) for r in found if "results" in r["line"]) == [
        ("duplicate", "None", 1), ("duplicate", "a2", 2), ("linked", "a1", 4), ("orphan", "a3", 1),
    ]
    assert [r["line"]["arguments"]["message"] for r in found if r["status"] == "open" and r["name"] is None] == ["n1"]
    assert all(r["errors"] and not r["valid"] for r in found if r["status"] == "duplicate")
    assert sorted(r["position"] for r in found if r["conv_id"] == 1) == list(range(1, 8))


def test_canonical_json():
    assert tool_calls.canonical({"b": 1.0, "a": [True, None, 0.5, "é\n"], "\U0001f600": 1, "\ufb33": 2}) == '{"a":[true,null,0.5,"é\\n"],"b":1,"\U0001f600":1,"\ufb33":2}'
    assert tool_calls.checked("reply", '{"message": NaN}', tool_calls.CHAT_SCHEMAS)[1] == ["arguments: not JSON"]
    assert tool_calls.violations(True, {"type": "integer"}) == ["arguments: not integer"]
    assert tool_calls.violations([1, "x"], {"items": {"type": "number"}}) == ["[1]: not number"]


def test_conversations(spark):
    folder = "/root/testdata/sf0.001"
    messages = spark.read.parquet(f"{folder}/conversations.parquet")
    found = tool_calls.op5_tool_call_linking(spark, folder).collect()
    roles = {(r["conv_id"], r["turn"]): r for r in messages.collect()}
    asked = [k for k, r in roles.items() if r["role"] in ("user", "system")]
    answered = {k for k in asked if (k[0], k[1] + 1) in roles and roles[k[0], k[1] + 1]["role"] == "assistant"}
    assert sum(r["status"] == "linked" for r in found) == len(answered)
    assert sum(r["status"] != "orphan" for r in found) == len(asked)


# -- pipeline and packaging ---------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline
    from augur.llm import pii, quality_rules

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, folder).cache()
        seen[name] = (before, [tuple(r) for r in docs.select("doc_id", "text").collect()])
        assert set(start) <= set(docs.columns) and (docs.columns == start or name == "mixing sources")
    before, after = seen["quality rules"]
    failed = {r[0] for r in brute.base_rules(before) if r[-1]}
    assert not failed & {i for i, _ in after}
    judged = quality_rules.judge_quality(spark.createDataFrame(before, "doc_id long, text string"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert sorted(i for i, _ in after) == sorted(r["doc_id"] for r in judged.filter("kept").collect())
    before, after = seen["SimHash near-dedup"]
    assert sorted(i for i, _ in after) == sorted({r[2] for r in brute.simhash(before)})
    before, after = seen["benchmark decontamination"]
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(i for i, _ in after) == sorted(r[0] for r in brute.contamination(before, bench) if not r[-1])
    before, after = seen["PII"]
    assert dict(after) == {i: pii.replace(t, pii.KEY, lambda *_: 0)[0] for i, t in before}
    before, after = seen["mixing sources"]
    assert set(after) <= set(before)
    whole = corpus_pipeline.run(spark, folder)
    assert ordered((r["doc_id"], r["text"]) for r in whole.collect()) == ordered(after)


def test_rest_works_without_this_subpackage(tmp_path):
    """With llm/, its tests and the pipeline gone, the entry still imports."""
    import shutil

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'question_summary' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
    full = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' in q and sum(k.startswith('op') for k in q) == 13"
    subprocess.run([sys.executable, "-c", full], cwd=ROOT, check=True, env={**os.environ, "PYTHONPATH": ROOT})
