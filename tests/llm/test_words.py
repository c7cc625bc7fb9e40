import random
import re

import numpy as np
import pytest
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from augur.llm import quality_rules, substring_dedup
from augur.llm.words import Words, find_words, gram_hashes, same_spans, slices, span_hashes

from . import brute

TEXTS = st.lists(st.none() | st.text(alphabet="ab é\n\t\x0b中\U0001f600", max_size=40), max_size=12)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_spans_are_the_words(texts):
    words = find_words(pa.array(texts, pa.string()))
    hashes, seen = words.hashes(), {}
    for r, text in enumerate(texts):
        own = range(words.row[r], words.row[r + 1])
        found = [bytes(words.data[words.start[i] : words.end[i]]).decode() for i in own]
        assert found == re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i, word in zip(own, found, strict=True):
            assert seen.setdefault(word, hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen)


def test_grams_depend_on_order():
    h = gram_hashes(np.array([1, 2, 2, 1, 2], dtype=np.uint64), 2)
    assert h[0] == h[3] and h[0] != h[2]


def test_slices_keep_every_row_and_isolate_long_texts():
    texts = ["a" * 10, None, "b" * 500, "", "c" * 20, "d" * 90]
    parts = list(slices([pa.record_batch({"text": pa.array(texts)})], "text", 100))
    assert [t for p in parts for t in p["text"].to_pylist()] == texts
    assert all(sum(len(t or "") for t in p["text"].to_pylist()) <= 100 or len(p["text"].to_pylist()[0] or "") == 500 and p.num_rows <= 2 or p.num_rows == 1 for p in parts)
    assert list(slices([pa.record_batch({"text": pa.array([], pa.string())})], "text")) == []


def thue_morse(flip=False, n=1024):
    """Two such words have equal polynomial hashes modulo 2**64, for any odd base."""
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def test_hashes_follow_bytes_and_lengths():
    rng = random.Random(4)
    spans = {bytes(rng.choices(b"ab\x00\xff", k=rng.randrange(1, 140))) for _ in range(3000)} | {b"a" * n for n in range(1, 200)}
    spans |= {b"\x00" * n for n in range(1, 200)} | {thue_morse().encode(), thue_morse(True).encode()}
    spans = sorted(spans)
    data = np.frombuffer(b"".join(spans), dtype=np.uint8)
    end = np.cumsum([len(s) for s in spans])
    start = end - [len(s) for s in spans]
    hashes = span_hashes(data, start, end)
    assert len(set(hashes.tolist())) == len(spans)
    assert hashes.tolist() == [int(span_hashes(np.frombuffer(b"xy" + s, dtype=np.uint8), np.array([2]), np.array([2 + len(s)]))[0]) for s in spans]
    other = np.array(rng.choices(range(len(spans)), k=len(spans)))
    assert same_spans(data, (start, end), (start[other], end[other])).tolist() == [a == b for a, b in enumerate(other.tolist())]
    twice = np.concatenate([data, data])
    assert same_spans(twice, (start, end), (start + len(data), end + len(data))).all()


def colliding(rows):
    return pa.array([t for _, t in rows], pa.string())


def lines_of(rows):
    m = quality_rules.Lines(find_words(colliding(rows)))
    return list(zip(m.total.tolist(), m.dup_lines.tolist(), m.repeats.tolist(), strict=True))


CASES = [
    (0, f"{thue_morse()}\n{thue_morse(True)}\n{thue_morse()}"),
    (1, " ".join([thue_morse(), *"bcdef", thue_morse(True), *"bcdef"])),
    (2, "a b c d e\na b c d e\nx\n a b c d e\nx\n\n"),
    (3, None),
    (4, " ".join("abcabd"[i % 6] for i in range(60))),
]


@pytest.mark.parametrize("hashed", [True, False])
def test_repeats_are_decided_by_bytes(monkeypatch, hashed):
    """With the hashes as they are, and with all hashes equal."""
    if not hashed:
        monkeypatch.setattr(quality_rules, "span_hashes", lambda data, start, end: np.zeros(len(start), dtype=np.uint64))
        monkeypatch.setattr(Words, "hashes", lambda self: np.zeros(len(self.start), dtype=np.uint64))
    expected = [(r[1], r[4], r[5]) for r in brute.base_rules(CASES)]
    assert lines_of(CASES) == expected


@pytest.mark.parametrize("hashed", [True, False])
def test_trees_are_decided_by_bytes(hashed):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab") for _ in range(30)) for _ in range(40)]
    texts += [" ".join(["p"] * 5 + [w] + ["q"] * 5) for w in (thue_morse(), thue_morse(True), thue_morse(), "z")]
    words = find_words(pa.array(texts))
    window = 9
    at = np.flatnonzero(np.arange(len(words.start)) + window <= words.last)
    hashes = words.hashes() if hashed else np.zeros(len(words.start), dtype=np.uint64)
    found = substring_dedup.shared_at_depth(np.zeros(len(at), dtype=np.uint64), at, hashes, words, window)
    content = [words.bytes_of(int(a), window) for a in at]
    assert sorted(found.tolist()) == [i for i, c in enumerate(content) if content.count(c) > 1]


def test_words_of_equal_polynomial_hash_are_different_words(spark):
    """35-word windows that differ in one such word aren't repeats."""
    rest = [f"w{i}" for i in range(36)]
    texts = [" ".join([*rest[:17], thue_morse(flip), *rest[17:]]) for flip in (False, True)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    found = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs.union(docs.limit(1))).collect()]
    assert sorted(found) == [(0, 37, 37), (0, 37, 37), (1, 37, 0)]
