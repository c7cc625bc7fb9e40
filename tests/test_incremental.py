"""After any sequence of loads the model equals one build over all extracts,
up to keys, and the refreshed gold layer equals one built anew."""

import random

import pytest

from augur.plans import model as M
from augur.plans.gold import build_gold, gold_table, refresh_gold
from augur.sources.schemas import RAW_DEMOGRAPHICS, RAW_FORECASTS, RAW_QUESTION_TAGS
from augur.sources.store import AssertionFailed, Conflict, Store
from augur.streaming import incremental
from augur.streaming.incremental import append_forecasts, load

SCHEMAS = {"raw_forecasts_export": RAW_FORECASTS, "raw_forecaster_demographics": RAW_DEMOGRAPHICS, "raw_question_tags": RAW_QUESTION_TAGS}


def forecast(who, question, time, prediction, name="N", kind="expert", text="text", why="because"):
    return dict(forecaster_id=who, forecaster_name=name, forecaster_type=kind, question_id=question, question_text=text,
                forecast_timestamp=time, prediction=prediction, rationale=why)


def person(who, years="3", education="PhD", joined="2020-01-02"):
    return dict(forecaster_id=who, years_forecasting_experience=years, education_level=education, country="X", affiliation="Y", joined_date=joined)


def frames(spark, extract):
    return [
        spark.createDataFrame([tuple(r.get(c) for c in s.names) for r in extract.get(name, [])], s)
        for name, s in SCHEMAS.items()
    ]


def build(spark, tmp_path, name, *extracts):
    """A full build over extracts; returns the model's folder."""
    paths = {}
    for i, table in enumerate(SCHEMAS):
        paths[table] = str(tmp_path / f"{name}_{table}")
        for k, extract in enumerate(extracts):
            df = frames(spark, extract)[i]
            df.coalesce(1).write.option("header", True).option("escape", '"').mode("overwrite" if not k else "append").csv(paths[table])
    out = str(tmp_path / name)
    M.build(spark, paths, out, buckets=4)
    return out


def content(spark, out):
    """All five tables by natural ids."""
    t = {n: [r.asDict() for r in df.collect()] for n, df in M.tables(spark, out).items()}
    people = {r["forecaster_sk"]: r["forecaster_id"] for r in t["dim_forecasters"]}
    asked = {r["question_sk"]: r["question_id"] for r in t["dim_questions"]}
    for table, key in (("dim_forecasters", "forecaster_sk"), ("dim_questions", "question_sk"), ("fct_forecasts", "forecast_sk")):
        assert sorted(r[key] for r in t[table]) == list(range(1, len(t[table]) + 1)), table  # keys stay dense
    for rows in t.values():
        for r in rows:
            if "forecaster_sk" in r:
                r["forecaster_sk"] = people[r["forecaster_sk"]]
            if "question_sk" in r:
                r["question_sk"] = asked[r["question_sk"]]
            r.pop("forecast_sk", None)
    return {n: sorted(map(repr, rows)) for n, rows in t.items()}


FIRST = {
    "raw_forecasts_export": [
        forecast("F1", "Q1", "2024-01-01 10:00:00", "50", kind="expert"),
        forecast("F1", "Q1", "2024-01-05 10:00:00", "60"),
        forecast("F2", "Q1", "2024-01-01 11:00:00", "30", kind="public"),
        forecast("F2", "Q2", "2024-01-02 11:00:00", "35", kind="public"),
        forecast("F3", "Q2", "2024-01-03 00:00:00", "70", kind="superforecaster"),
        forecast("F9", "Q1", "2024-01-03 00:00:00", "10"),  # not registered yet
    ],
    "raw_forecaster_demographics": [person("F1"), person("F2", education="Bachelor"), person("F3"), person("F4", education="")],
    "raw_question_tags": [dict(question_id="Q1", tag=" Energy"), dict(question_id="Q3", tag="later")],
}
LOADS = [
    {  # a conflict that the new row wins, one that it loses, a new day, a new question (with a tag that waited)
        "raw_forecasts_export": [
            forecast("F1", "Q1", "2024-01-05 10:00:00", "20", why="revised"),
            forecast("F2", "Q1", "2024-01-01 11:00:00", "90", kind="public"),
            forecast("F1", "Q3", "2024-02-01 09:00:00", "44", name="Zoe", text="three"),
            forecast("F4", "Q2", "2024-01-02 12:00:00", "15", kind="expert"),
            forecast("F4", "Q2", None, "16", kind="expert"),
        ],
    },
    {  # the person is registered, another's profile completed; no forecasts
        "raw_forecaster_demographics": [person("F9", joined="March 5, 2023"), person("F4", years="12", education="Masters")],
        "raw_question_tags": [dict(question_id="Q2", tag="new"), dict(question_id="Q1", tag="energy ")],
    },
    {  # a changed type and text; the greatest prediction of a pair is replaced; a third of all rows for one pair
        "raw_forecasts_export": [
            forecast("F2", "Q2", "2024-03-02 11:00:00", "35", kind="superforecaster", text="z text"),
            forecast("F3", "Q2", "2024-01-03 00:00:00", "5", kind="superforecaster", why=" "),
            *[forecast("F3", "Q3", f"2024-04-01 00:{m:02d}:00", str(m)) for m in range(12)],
            *[forecast("F3", "Q3", f"2024-04-01 00:{m:02d}:00", str(m)) for m in range(12)],
        ],
    },
]


def gold_content(spark, gold, model):
    """Marts by natural ids; keys differ between models, so person rows are named."""
    snapshot = Store(spark, gold).snapshot()
    ids = {r[0]: r[1] for r in M.table(spark, model, "dim_forecasters").select("forecaster_sk", "forecaster_id").collect()}
    out = {}
    for t in snapshot.tables():
        if t in ("question_cells", "latest_cells", "top_forecaster"):
            continue  # words hold keys; top_forecaster breaks ties by key
        rows = [r.asDict() for r in snapshot.read(t).collect()]
        for r in rows:
            if "forecaster_sk" in r:
                r["forecaster_sk"] = ids[r["forecaster_sk"]]
        out[t] = sorted(map(repr, rows))
    return out


def test_loads_equal_a_build_and_refreshed_gold_equals_built_gold(spark, tmp_path):
    out, gold = build(spark, tmp_path, "model", FIRST), str(tmp_path / "gold")
    build_gold(spark, out, gold)
    results = []
    for k, extract in enumerate(LOADS):
        results.append(load(spark, out, *frames(spark, extract)))
        if k != 1:  # one refresh covers two loads
            refresh_gold(spark, out, gold)
            fresh = str(tmp_path / f"fresh{k}")
            build_gold(spark, out, fresh)
            got, anew = gold_content(spark, gold, out), gold_content(spark, fresh, out)
            assert got.keys() == anew.keys()
            for t in anew:
                assert got[t] == anew[t], t
            for t in ("question_cells", "latest_cells"):  # one model: same keys
                norm = lambda g, t=t: sorted(map(repr, gold_table(spark, g, t).collect()))
                assert norm(gold) == norm(fresh), t
    assert [r["replaced"] for r in results] == [1, 0, 1] and [r["waiting"] for r in results] == [1, 0, 0]
    assert results[0]["appended"] == 3 and results[1]["appended"] == 1 and results[2]["appended"] == 13
    whole = build(spark, tmp_path, "whole", FIRST, *LOADS)
    got, expected = content(spark, out), content(spark, whole)
    for table in expected:
        assert got[table] == expected[table], table
    whole_gold = str(tmp_path / "whole_gold")
    build_gold(spark, whole, whole_gold)
    assert gold_content(spark, gold, out) == gold_content(spark, whole_gold, whole)
    # again: nothing new is published
    version = Store(spark, out).version()
    for extract in LOADS:
        assert load(spark, out, *frames(spark, extract))["appended"] == 0
    assert Store(spark, out).version() == version and content(spark, out) == expected
    assert refresh_gold(spark, out, gold)["question_summary"] == 3


@pytest.mark.parametrize("seed", [1])
def test_random_loads_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    people, asked = [f"F{i}" for i in range(6)], ["Q1", "Q2", "Q3"]

    def extract():
        rows = [
            forecast(rng.choice(people), rng.choice(asked), rng.choice(["2024-01-01 00:00:00", "2024-01-01", "2024-01-02 05:00:00", None]), str(rng.randrange(5)),
                     name=rng.choice("AB"), kind=rng.choice(["expert", "public"]), text=rng.choice("xy"), why=rng.choice(["", "w", None]))
            for _ in range(12)
        ]
        return {
            "raw_forecasts_export": rows,
            "raw_forecaster_demographics": [person(rng.choice(people), years=str(rng.randrange(20)), education=rng.choice([None, "PhD"])) for _ in range(2)],
            "raw_question_tags": [dict(question_id=rng.choice([*asked, "Q9"]), tag=rng.choice(["a", "A ", "b"])) for _ in range(2)],
        }

    extracts = [extract() for _ in range(3)]
    out = build(spark, tmp_path, "model", extracts[0])
    for e in extracts[1:]:
        load(spark, out, *frames(spark, e))
    assert content(spark, out) == content(spark, build(spark, tmp_path, "whole", *extracts))


def test_a_load_that_another_overtakes_is_run_again(spark, tmp_path, monkeypatch):
    out = build(spark, tmp_path, "model", FIRST)
    mine, other = frames(spark, LOADS[0])[0], frames(spark, LOADS[2])[0]
    commit, calls = Store.commit, []

    def overtaken(self, base, *args):
        calls.append(base)
        if len(calls) == 1:
            load(spark, out, other)  # another load publishes first
        return commit(self, base, *args)

    monkeypatch.setattr(Store, "commit", overtaken)
    append_forecasts(spark, mine, out)
    assert calls[0] == 1 and Store(spark, out).version() == 3
    monkeypatch.undo()
    assert content(spark, out)["fct_forecasts"] == content(spark, build(spark, tmp_path, "whole", FIRST, LOADS[2], LOADS[0]))["fct_forecasts"]


def test_a_load_killed_before_its_record_changes_nothing(spark, tmp_path, monkeypatch):
    out = build(spark, tmp_path, "model", FIRST)
    before = content(spark, out)
    monkeypatch.setattr(Store, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(spark, out, *frames(spark, LOADS[0]))
    monkeypatch.undo()
    assert content(spark, out) == before and Store(spark, out).version() == 1
    with pytest.raises(AssertionFailed):
        load(spark, out, *frames(spark, LOADS[0]), assertions={"no NULL times": lambda t: not t["fct_forecasts"].profile["nulls"]["forecast_timestamp"]})
    assert content(spark, out) == before
    assert Store(spark, out).vacuum() > 0 and content(spark, out) == before
    monkeypatch.setattr(incremental, "TRIES", 1)
    monkeypatch.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(Conflict("taken")))
    with pytest.raises(Conflict):
        load(spark, out, *frames(spark, LOADS[0]))


def test_a_load_reads_only_the_dates_and_buckets_it_touches(spark, tmp_path):
    out = build(spark, tmp_path, "model", FIRST)
    store = Store(spark, out)
    before = store.snapshot().entries
    load(spark, out, frames(spark, {"raw_forecasts_export": [forecast("F1", "Q1", "2024-06-01 00:00:00", "9")]})[0])
    after = store.snapshot().entries
    # the dimension rows didn't change, one date folder came, none was replaced
    assert after["dim_forecasters"].folders == before["dim_forecasters"].folders
    assert set(before["fct_forecasts"].folders) < set(after["fct_forecasts"].folders)
    assert len(after["fct_forecasts"].folders) == len(before["fct_forecasts"].folders) + 1
