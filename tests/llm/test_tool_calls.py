"""Tool-call linking against plain Python: levels, order, status and lines."""

import json
import random

from augur.llm import tool_calls
from llm.test_tables import CALLS, lines

RESULTS = "conv_id long, call_id string, turn long, content string"


def plain_levels(depends: dict) -> dict:
    """Levels by peeling: {call: [calls it needs]} -> {call: level, -1 in or behind a cycle}."""
    needs = {c: {d for d in on if d in depends} for c, on in depends.items()}
    found, level = {}, 0
    while True:
        ready = [c for c, on in needs.items() if c not in found and all(d in found for d in on)]
        if not ready:
            return {c: found.get(c, -1) for c in depends}
        found |= dict.fromkeys(ready, level)
        level += 1


def plain_lines(conv: int, calls: list, results: list) -> list:
    """(position, call_id, status, valid, json) of one conversation whose calls have one content an identifier."""
    by_id = {c[1]: c for c in calls}
    level = plain_levels({k: c[5] for k, c in by_id.items()})
    given: dict = {}
    for _, call_id, turn, content in results:
        given.setdefault(call_id, []).append((content, turn))
    entries = []
    for k in by_id.keys() | given.keys():
        turn = by_id[k][2] if k in by_id else min(t for _, t in given[k])
        entries.append(((level.get(k, 0) < 0, level.get(k, 0), turn, k), k))
    out = []
    for position, (_, k) in enumerate(sorted(entries), 1):
        status = "orphan" if k not in by_id else "linked" if k in given else "open"
        line = {"conversation": str(conv), "id": k, "position": position, "status": status}
        faults = []
        if k in by_id:
            _, _, _, name, arguments, on = by_id[k]
            value, faults = tool_calls.checked(name, arguments, tool_calls.CHAT_SCHEMAS)
            faults = faults + ["cycle"] * (level[k] == -1) + ["unknown dependency"] * any(d not in by_id for d in on)
            line |= {"name": name, "arguments": value, "depends_on": sorted(on), "errors": faults}
        if k in given:
            line |= {"result": min(c for c, _ in given[k]), "results": len(given[k])}
        out.append((position, k, status, status == "linked" and not faults, tool_calls.canonical(line)))
    return out


def test_lines_equal_the_plain_version(spark):
    rnd = random.Random(5)
    ids = [f"c{i}" for i in range(60)]
    arguments = ['{"message":"x","turn":1}', '{"message":"","turn":2}', "{}", "[", '{"turn":1e3,"message":"é"}']
    calls, results = [], []
    for conv in (1, 2, 3):
        for i, k in enumerate(ids[:45]):
            earlier = ids[:45] if conv == 1 else ids[:i]
            on = rnd.sample(earlier, min(len(earlier), rnd.choice([0, 1, 1] if conv == 1 else [0, 1, 1, 2, 3])))
            calls.append((conv, k, rnd.randrange(20), rnd.choice(["reply", "reply", "nope"]), rnd.choice(arguments), on + ["zz"] * (rnd.random() < 0.1)))
        results += [(conv, rnd.choice(ids), rnd.randrange(20), f"r{rnd.randrange(9)}") for _ in range(50)]
    calls += [(1, k, 3, "reply", arguments[0], [on]) for k, on in [("c50", "c51"), ("c51", "c50"), ("c52", "c51")]]
    found = lines(spark, calls + calls[:5], results)
    for conv in (1, 2, 3):
        mine = [(r["position"], r["call_id"], r["status"], r["valid"], r["json"]) for r in found if r["conv_id"] == conv]
        assert mine == plain_lines(conv, [c for c in calls if c[0] == conv], [r for r in results if r[0] == conv])
    assert any("cycle" in r["errors"] for r in found)


def levels_of(spark, *graphs: dict) -> list[dict]:
    rows = [(str(g), k, on) for g, depends in enumerate(graphs) for k, on in depends.items()]
    found: list[dict] = [{} for _ in graphs]
    for r in tool_calls.levels(spark.createDataFrame(rows, "conv string, call_id string, depends_on array<string>")).collect():
        found[int(r["conv"])][r["call_id"]] = r["level"]
    return found


def test_levels_of_shapes(spark):
    rnd = random.Random(7)
    graphs = [
        {"a": ["a"], "b": ["a"], "c": []},  # needs itself
        {"a": ["c"], "b": ["a"], "c": ["b"], "d": ["c", "e"], "e": []},  # three round, and behind them
        {x: [y for y in "abcd" if y != x] for x in "abcd"} | {"e": ["a", "f"], "f": []},  # all need all
        {"a": [], "b": ["a"], "c": ["a"], "d": ["b", "c"], "e": ["d", "a"], "f": ["e", "b"], "g": ["f", "e", "a"]},  # diamonds
        {"r": [], **{f"x{i}": ["r", f"x{i - 1}"] if i else ["r"] for i in range(40)}},  # each also needs the first
        *[{f"n{i}": rnd.sample([f"n{j}" for j in range(i)], min(i, rnd.randrange(4))) for i in range(40)} for _ in range(20)],
        *[{f"n{i}": rnd.sample([f"n{j}" for j in range(25)], rnd.choice([0, 1, 1, 2])) for i in range(25)} for _ in range(20)],
    ]
    assert levels_of(spark, *graphs) == [plain_levels(g) for g in graphs]


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    keep = tool_calls.stored
    monkeypatch.setattr(tool_calls, "stored", lambda df, name: rounds.append(name) or keep(df, name))
    [found] = levels_of(spark, {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(10_000)})
    assert found == {f"c{i}": i for i in range(10_000)}
    assert rounds.count("edges") < 20


def test_long_texts_and_clashing_columns(spark):
    text = "x" * 3_000_000
    calls = spark.createDataFrame([(1, "a", 0, "reply", json.dumps({"message": text, "turn": 1}), [], 7, True, "n")], CALLS + ", level int, moved boolean, `to` string")
    results = spark.createDataFrame([(1, "a", 1, text, "linked", 3)], RESULTS + ", status string, n_results int")
    [row] = tool_calls.link_calls(calls, results, tool_calls.CHAT_SCHEMAS).collect()
    assert row["valid"] and json.loads(row["json"])["result"] == text and row["position"] == 1
