"""Quality rules: line labels from a linear-chain conditional random field.

Base counts come first (``MEASURES``); a text of fewer than ``min_words`` words, or with
over ``max_repeat`` percent of its words in 5-word windows found twice or more
in the text, fails them. Then Viterbi decoding labels each line with a word as
content or boilerplate, and a text whose content lines hold less than
``min_content`` of its words is rejected.

The field has two states. A line's features are indicators of its measures'
ranges (share of symbols, capitals, digits, bars, exclamation marks and
repeated neighbours, number and length of words, last character, whether it
repeats an earlier line); weights of features and transitions are trained by
maximum likelihood (forward-backward gradients) on up to ``sample`` whole labelled
documents with up to ``max_lines`` lines together, the labelled ids with the least
hashes. Lines of documents labelled 1 are the content examples,
lines of those labelled 0 the boilerplate examples. Prediction reads the text alone.

Null and empty texts have no words and fail the base rules. Labels that are null
don't count; a document with several labels has the least. Without examples
of both kinds every line is content. Repeated rows are judged one by one.
All columns of the input are kept; one with the name of an added column is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.llm.words import MULT, Words, find_words, gram_hashes, mix, same_spans, slices, span_hashes

MIN_WORDS = 10
MAX_REPEAT = 20
REPEAT_WINDOW = 5
MIN_CONTENT = 0.5
SAMPLE = 2000
MAX_LINES = 400_000
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*MEASURES, "base_failed", "content_share", "kept")

# upper ends of the ranges of each line measure; the last range is open
RANGES = {
    "symbols": (0.0, 0.02, 0.05, 0.15),
    "capitals": (0.1, 0.3, 0.6),
    "digits": (0.0, 0.05, 0.2),
    "bars": (0.0, 0.02, 0.06),
    "exclamations": (0.0, 0.03, 0.1),
    "neighbours": (0.0, 0.1, 0.3),
    "words": (3, 9, 24),
    "letters": (3, 6, 9),
    "closed": (0,),
    "seen": (0,),
}
WIDTHS = [len(r) + 1 for r in RANGES.values()]
BASE = np.r_[0, np.cumsum(WIDTHS)]
N_FEATURES = int(BASE[-1])


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


IS = {
    "symbol": _table(SYMBOLS),
    "capital": _table(bytes(range(65, 91))),
    "letter": _table(bytes(range(65, 91)) + bytes(range(97, 123))),
    "digit": _table(bytes(range(48, 58))),
    "bar": _table(b"|"),
    "exclamation": _table(b"!"),
}


def _counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[end] - sums[start]


def _twice(group: np.ndarray, hashes: np.ndarray, equal, content) -> tuple[np.ndarray, np.ndarray]:
    """Whether an item occurs more than once in its group, and whether it did
    before. Equal hashes propose; ``equal(i, j)`` compares items' bytes, and a group in
    which they differ under one hash is counted by ``content(i)``, the bytes."""
    keys = mix(group.astype(np.uint64) * MULT + hashes)
    order = np.argsort(keys, kind="stable")
    next_, last = order[1:], order[:-1]
    met = np.flatnonzero((keys[next_] == keys[last]) & (group[next_] == group[last]) & (hashes[next_] == hashes[last]))
    holds = equal(next_[met], last[met])
    any_, before = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    any_[next_[met]] = before[next_[met]] = True
    any_[last[met]] = True
    for g in np.unique(group[next_[met[~holds]]]).tolist():
        seen: dict = {}
        own = np.flatnonzero(group == g)
        any_[own] = before[own] = False
        for i in own.tolist():
            first = seen.setdefault(content(i), i)
            if first != i:
                any_[first] = any_[i] = before[i] = True
    return any_, before


class Lines:
    """Lines with a word of a slice, their features, and the texts' measures."""

    def __init__(self, words: Words):
        data, at, rows = words.data, words.at, len(words.at) - 1
        breaks = np.flatnonzero(data == 10)
        start = np.r_[at[:-1], breaks + 1]
        row = np.r_[np.arange(rows), np.searchsorted(at, breaks, side="right") - 1]
        order = np.lexsort((start, row))
        start, row = start[order], row[order]
        end = at[row + 1].copy()
        inner = np.flatnonzero(row[1:] == row[:-1])
        end[inner] = start[inner + 1] - 1
        first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
        # a line without words may touch the next row's first word
        full = np.flatnonzero(last > first)
        self.start, self.end, self.row = start[full], end[full], row[full]
        first, last = first[full], last[full]
        self.n_words = last - first
        self.of = np.searchsorted(self.row, np.arange(rows + 1))
        hashes = words.hashes()
        _, self.seen = _twice(
            self.row,
            span_hashes(data, self.start, self.end),
            lambda i, j: same_spans(data, (self.start[i], self.end[i]), (self.start[j], self.end[j])),
            lambda i: data[self.start[i] : self.end[i]].tobytes(),
        )
        self._measure(words, hashes)
        self._describe(data, hashes, first, last, words)

    def _measure(self, words: Words, hashes: np.ndarray) -> None:
        rows = len(words.at) - 1
        follows = np.r_[0, np.cumsum((words.data & 0xC0) == 0x80)]
        code_points = np.r_[0, np.cumsum((words.end - words.start) - (follows[words.end] - follows[words.start]))]
        self.total = np.diff(words.row)
        self.word_chars = code_points[words.row[1:]] - code_points[words.row[:-1]]
        self.symbols = _counts(IS["symbol"][words.data], words.at[:-1], words.at[1:])
        self.dup_lines = np.bincount(self.row[self.seen], minlength=rows)
        owner = np.repeat(np.arange(rows), self.total)
        whole = np.flatnonzero(np.arange(len(hashes)) + REPEAT_WINDOW <= words.last)
        twice, _ = _twice(
            owner[whole],
            gram_hashes(hashes, REPEAT_WINDOW)[whole],
            lambda i, j: words.same_runs(whole[i], whole[j], REPEAT_WINDOW),
            lambda i: words.bytes_of(int(whole[i]), REPEAT_WINDOW),
        )
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(cover, whole[twice], 1)
        np.add.at(cover, whole[twice] + REPEAT_WINDOW, -1)
        self.repeats = np.bincount(owner[np.cumsum(cover)[:-1] > 0], minlength=rows)

    def _describe(self, data: np.ndarray, hashes: np.ndarray, first: np.ndarray, last: np.ndarray, words: Words) -> None:
        size = np.maximum(self.end - self.start, 1)
        share = lambda kind, of: _counts(IS[kind][data], self.start, self.end) / np.maximum(of, 1)
        again = np.zeros(len(hashes), dtype=bool)
        again[1:] = hashes[1:] == hashes[:-1]
        again[first] = False
        lengths = np.r_[0, np.cumsum(words.end - words.start)]
        closing = data[words.end[last - 1] - 1] if len(last) else data[:0]
        values = {
            "symbols": share("symbol", size),
            "capitals": share("capital", _counts(IS["letter"][data], self.start, self.end)),
            "digits": share("digit", size),
            "bars": share("bar", size),
            "exclamations": share("exclamation", size),
            "neighbours": _counts(again, first, last) / np.maximum(self.n_words, 1),
            "words": self.n_words,
            "letters": (lengths[last] - lengths[first]) / np.maximum(self.n_words, 1),
            "closed": np.isin(closing, list(b".!?")),
            "seen": self.seen,
        }
        self.features = np.stack(
            [np.searchsorted(RANGES[k], values[k], side="left") + BASE[i] for i, k in enumerate(RANGES)], axis=1
        ).astype(np.int16)


def viterbi(scores: list[list[float]], moves: list[list[float]]) -> list[int]:
    """Best state sequence of a two-state chain; equal scores give content (1)."""
    if not scores:
        return []
    a, b = scores[0]
    back = []
    for x, y in scores[1:]:
        to0, from1 = a + moves[0][0], b + moves[1][0]
        to1, stay1 = a + moves[0][1], b + moves[1][1]
        back.append((int(from1 >= to0), int(stay1 >= to1)))
        a, b = max(to0, from1) + x, max(to1, stay1) + y
    state = int(b >= a)
    path = [state]
    for step in reversed(back):
        state = step[state]
        path.append(state)
    return path[::-1]


class Batch:
    """Sequences of similar length, padded; all lines of one have its state."""

    def __init__(self, sequences: list[np.ndarray], states: list[int], weight: np.ndarray):
        n, steps = len(sequences), max(map(len, sequences))
        self.feats = np.full((n, steps, len(RANGES)), N_FEATURES, dtype=np.int64)  # the extra row of weights stays 0
        self.real = np.zeros((n, steps), dtype=bool)
        for i, seq in enumerate(sequences):
            self.feats[i, : len(seq)], self.real[i, : len(seq)] = seq, True
        self.pairs = self.real[:, 1:] & self.real[:, :-1]
        state = np.array(states)
        self.weight = weight[state]
        truth = np.zeros((n, 2))
        truth[np.arange(n), state] = self.weight
        self.seen, self.moved = np.zeros((N_FEATURES + 1, 2)), np.zeros((2, 2))
        np.add.at(self.seen, self.feats[self.real], truth[np.nonzero(self.real)[0]][:, None, :])
        np.add.at(self.moved, (state, state), self.pairs.sum(axis=1) * self.weight)

    def expected(self, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected features and moves under the model (forward-backward)."""
        score = np.vstack([weights, np.zeros((1, 2))])[self.feats].sum(axis=2)
        steps = score.shape[1]
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for k in range(1, steps):
            step = np.logaddexp(ahead[:, k - 1, :1] + moves[0], ahead[:, k - 1, 1:] + moves[1]) + score[:, k]
            ahead[:, k] = np.where(self.real[:, k, None], step, ahead[:, k - 1])
        for k in range(steps - 2, -1, -1):
            nxt = behind[:, k + 1] + score[:, k + 1]
            step = np.logaddexp(nxt[:, :1] + moves[:, 0], nxt[:, 1:] + moves[:, 1])
            behind[:, k] = np.where(self.real[:, k + 1, None], step, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        prob = np.exp(ahead + behind - total[:, None, None]) * self.weight[:, None, None]
        found = np.zeros((N_FEATURES + 1, 2))
        np.add.at(found, self.feats[self.real], prob[self.real][:, None, :])
        joint = ahead[:, :-1, :, None] + moves + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
        joint = np.exp(np.where(self.pairs[:, :, None, None], joint, -np.inf)) * self.weight[:, None, None, None]
        return found, joint.sum(axis=(0, 1))


def train(sequences: list[np.ndarray], states: list[int], rounds: int = 150, rate: float = 0.2, ridge: float = 1e-3):
    """Weights (features x 2) and moves (2 x 2) of the field: gradient ascent
    on the likelihood of line labels, all lines of a sequence having one state.
    Both labels weigh the same, however many lines each has."""
    weights, moves = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    if len(set(states)) < 2:
        return weights, moves
    lines = np.zeros(2)
    np.add.at(lines, states, [len(s) for s in sequences])
    alike: dict[int, list[int]] = {}
    for i, seq in enumerate(sequences):
        alike.setdefault(len(seq).bit_length(), []).append(i)
    weight = lines.sum() / (2 * lines)
    batches = [Batch([sequences[i] for i in own], [states[i] for i in own], weight) for _, own in sorted(alike.items())]
    seen, moved = sum(b.seen for b in batches), sum(b.moved for b in batches)
    m = [np.zeros_like(weights), np.zeros_like(moves)]
    v = [np.zeros_like(weights), np.zeros_like(moves)]
    for t in range(1, rounds + 1):
        found = [b.expected(weights, moves) for b in batches]
        slopes = [
            (seen - sum(f for f, _ in found))[:N_FEATURES] / lines.sum() - ridge * weights,
            (moved - sum(j for _, j in found)) / lines.sum() - ridge * moves,
        ]
        for i, (value, slope) in enumerate(zip((weights, moves), slopes, strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * slope
            v[i] = 0.999 * v[i] + 0.001 * slope**2
            value += rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return weights, moves


def _line_features():
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lines = Lines(find_words(part["text"]))
            codes = [lines.features[a:b].tobytes() for a, b in zip(lines.of[:-1], lines.of[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["quality"], pa.array(np.diff(lines.of)), pa.array(codes, pa.binary())], names=["doc_id", "quality", "n_lines", "lines"]
            )

    return features


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_lines: int = MAX_LINES):
    """Trains the field on whole labelled documents: up to ``sample`` of them,
    in the order of their ids' hashes, while their lines together are at most ``max_lines`` (a
    document that would exceed it is left out). The driver gets those lines' features."""
    chosen = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("long").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = stored(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers
        .mapInArrow(_line_features(), f"doc_id {id_type}, quality long, n_lines long, lines binary")
        .dropDuplicates(["doc_id", "quality", "n_lines", "lines"]),
        "lines",
    )
    # one row for a repeated doc_id; then the running number of lines, over `sample` rows
    least = found.groupBy("doc_id", "quality").agg(F.min(F.struct("n_lines", "lines")).alias("row"))
    in_turn = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fits = found.select("doc_id", "n_lines").groupBy("doc_id").agg(F.min("n_lines").alias("n_lines"))
    fits = fits.filter(F.col("n_lines") <= max_lines).withColumn("until", F.sum("n_lines").over(in_turn)).filter(F.col("until") <= max_lines)
    rows = least.join(F.broadcast(fits.select("doc_id")), "doc_id").select("doc_id", "quality", "row.lines").orderBy("doc_id").collect()
    sequences, states = [], []
    for row in rows:
        lines = np.frombuffer(row["lines"], dtype=np.int16).reshape(-1, len(RANGES))
        if len(lines):
            sequences.append(lines)
            states.append(int(row["quality"] > 0))
    return train(sequences, states)


def _judge(model, min_words: int, max_repeat: int, min_content: float):
    weights, moves = model
    moves = moves.tolist()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lines = Lines(find_words(part["text"]))
            scores = weights[lines.features].sum(axis=1)
            total = lines.total
            failed = (total < min_words) | (100 * lines.repeats > max_repeat * total)
            share = np.zeros(len(total))
            for r, (a, b) in enumerate(zip(lines.of[:-1].tolist(), lines.of[1:].tolist(), strict=True)):
                if b > a:
                    path = np.array(viterbi(scores[a:b].tolist(), moves))
                    share[r] = float((path * lines.n_words[a:b]).sum()) / float(total[r])
            carried = [c for c in part.schema.names if c not in ADDED]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part[c] for c in carried),
                    *(pa.array(x.astype(np.int64)) for x in (total, lines.word_chars, lines.symbols, lines.dup_lines, lines.repeats)),
                    pa.array(failed),
                    pa.array(share),
                    pa.array(~failed & (share >= min_content)),
                ],
                names=[*carried, *ADDED],
            )

    return judge


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeat: int = MAX_REPEAT,
    min_content: float = MIN_CONTENT,
    sample: int = SAMPLE,
    max_lines: int = MAX_LINES,
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``content_share`` and
    ``kept``. ``labels`` has doc_id and quality (0 or 1)."""
    model = fit(docs, labels, sample, max_lines)
    rest = docs.select([c for c in docs.columns if c not in ADDED])
    fields = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in rest.columns)
    added = ", ".join(f"{c} long" for c in MEASURES)
    return rest.mapInArrow(
        _judge(model, min_words, max_repeat, min_content),
        f"{fields}, {added}, base_failed boolean, content_share double, kept boolean",
    )


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.drop("text")
