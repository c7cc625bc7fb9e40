"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary is that of a byte-fallback BPE model of the sentencepiece library. A
text becomes pre-tokens that no merge can cross (a run of word marks and what follows
up to the next one; each line break alone). The different pre-tokens of a batch are held as one ragged
numpy array of symbols. In every round, each sequence's lowest-rank pair (the
leftmost of equals) is merged, all sequences at once; a sequence with no
mergeable pair is done, and its surviving symbols are its tokens (a character
outside the vocabulary counts its UTF-8 bytes). Counts of frequent pre-tokens are remembered
for the rest of a task. Sequences of over ``LONG`` symbols, which would need that
many rounds, go through the same merges with a heap.

Null texts count as empty: 0 bytes, 0 tokens. Texts are whole, however long.
Repeated rows are counted one by one. Columns of the input are kept; one with
the name of an added column is replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.words import slices

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
LONG = 256
REMEMBERED = 400_000
MARK = "▁"
ADDED = ("n_bytes", "n_tokens", "over_limit")
NO_RANK = np.iinfo(np.int64).max >> 32
SPLIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


@dataclass
class Merges:
    """Symbol ids of characters, and the pairs that merge."""

    ids: dict[str, int]  # of single characters
    cost: np.ndarray  # tokens that a symbol left alone counts
    pairs: np.ndarray  # left * len(cost) + right, in order
    rank: np.ndarray
    made: np.ndarray


def load_merges(path: str) -> Merges:
    """Reads the model on the driver; executors get the tables with the job."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece holds a word mark inside: pre-tokens would not be independent")
    symbols = {s: i for i, s in enumerate(dict.fromkeys([*pieces, *sorted({c for p in pieces for c in p})]))}
    order = {score: i for i, score in enumerate(sorted(set(pieces.values()), reverse=True))}
    found = {}
    for piece, score in pieces.items():
        for cut in range(1, len(piece)):
            left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
            if left is not None and right is not None:
                found[left * len(symbols) + right] = (order[score], symbols[piece])
    keys = sorted(found)
    return Merges(
        {s: i for s, i in symbols.items() if len(s) == 1},
        np.array([1 if s in pieces else len(s.encode()) for s in symbols], dtype=np.int64),
        np.array(keys, dtype=np.int64),
        np.array([found[k][0] for k in keys], dtype=np.int64),
        np.array([found[k][1] for k in keys], dtype=np.int64),
    )


def _ranks(m: Merges, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.where((left < 0) | (right < 0), -1, left * len(m.cost) + right)
    at = np.minimum(np.searchsorted(m.pairs, key), len(m.pairs) - 1)
    hit = m.pairs[at] == key
    return np.where(hit, m.rank[at], NO_RANK), m.made[at]


def _merge_long(m: Merges, symbols: list[int]) -> int:
    """Tokens of one long sequence (unknown characters are < 0: minus their bytes)."""
    table = dict(zip(m.pairs.tolist(), zip(m.rank.tolist(), m.made.tolist(), strict=True), strict=True))
    n, size = len(symbols), len(m.cost)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else -1
        if i >= 0 and j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
            found = table.get(symbols[i] * size + symbols[j])
            if found:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j < 0 or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], alive[j], after[i] = made, False, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return sum(-s if s < 0 else int(m.cost[s]) for s, a in zip(symbols, alive, strict=True) if a)


def count_tokens(m: Merges, tokens: list[str]) -> list[int]:
    """Number of vocabulary tokens of each pre-token."""
    counts = np.zeros(len(tokens), dtype=np.int64)
    ids = m.ids
    flat: list[int] = []
    lengths, owner = [], []
    for k, token in enumerate(tokens):
        symbols = [ids[c] if c in ids else -len(c.encode("utf-8", "surrogatepass")) for c in token]
        if len(symbols) > LONG:
            counts[k] = _merge_long(m, symbols)
        else:
            flat.extend(symbols)
            lengths.append(len(symbols))
            owner.append(k)
    if not lengths:
        return counts.tolist()
    symbol = np.array(flat, dtype=np.int64)
    sequence = np.repeat(np.array(owner, dtype=np.int64), lengths)
    rank = np.full(len(symbol), NO_RANK, dtype=np.int64)
    made = np.zeros(len(symbol), dtype=np.int64)
    inner = np.flatnonzero(sequence[1:] == sequence[:-1])
    rank[inner], made[inner] = _ranks(m, symbol[inner], symbol[inner + 1])
    while len(symbol):
        n = len(symbol)
        first = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
        # the lowest rank of each sequence, leftmost of equals
        low = np.minimum.reduceat(rank << 32 | np.arange(n), first)
        done = low >> 32 == NO_RANK
        size = np.diff(np.r_[first, n])
        if done.any():
            over = np.repeat(done, size)
            left = symbol[over]
            np.add.at(counts, sequence[over], np.where(left < 0, -left, m.cost[np.maximum(left, 0)]))
        place = low[~done] & 0xFFFFFFFF
        symbol[place] = made[place]
        keep = ~np.repeat(done, size)
        keep[place + 1] = False
        now = np.cumsum(keep) - 1
        place = now[place]
        symbol, sequence, rank, made = symbol[keep], sequence[keep], rank[keep], made[keep]
        n = len(symbol)
        for at in (place - 1, place):  # only pairs beside a merge have changed
            at = at[(at >= 0)]
            joined = (at + 1 < n) & (sequence[np.minimum(at + 1, n - 1)] == sequence[at]) if n else at < 0
            rank[at[~joined]] = NO_RANK
            at = at[joined]
            rank[at], made[at] = _ranks(m, symbol[at], symbol[at + 1])
    return counts.tolist()


def pre_tokens(text: str) -> list[str]:
    return SPLIT.findall((MARK + text).replace(" ", MARK)) if text else []


def _count(m: Merges, limit: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for part in slices(batches, "text"):
            texts = [t or "" for t in part["text"].to_pylist()]
            cut = [pre_tokens(t) for t in texts]
            new = list(set().union(*cut).difference(known))
            if len(known) + len(new) > REMEMBERED:
                known = {}
                new = list(set().union(*cut))
            known.update(zip(new, count_tokens(m, new), strict=True))
            totals = [sum(map(known.__getitem__, c)) for c in cut]
            carried = [c for c in part.schema.names if c not in ADDED]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part[c] for c in carried),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([t > limit for t in totals], pa.bool_()),
                ],
                names=[*carried, *ADDED],
            )

    return count


def with_token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with n_bytes, n_tokens and
    over_limit (n_tokens > ``limit``), for the model file at ``path``."""
    rest = docs.select([c for c in docs.columns if c not in ADDED])
    fields = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in rest.columns)
    return rest.mapInArrow(_count(load_merges(path), limit), f"{fields}, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text"))
    return with_token_counts(docs, public_tokenizers.path(MODEL)).drop("text")
