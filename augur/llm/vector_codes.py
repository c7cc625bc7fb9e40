"""Vector code compression: product codes whose nearest entry is found by Orchard search.

A vector is cut into equal parts; each part position has a codebook of at most
``entries`` integer vectors. A part's code is its nearest entry (squared
Euclidean distance, ties to the lower index). Codebooks start as the parts of
the rows with the smallest ids and are moved to their members' means in a
fixed number of rounds.

The nearest entry is found by Orchard search. For every entry the other
entries are kept in a list sorted by their distance from it. A search starts
at a guess, walks the list of the best entry so far, skips entries that it
has marked as visited, and jumps to the start of a better entry's list as
soon as it meets one. It stops where the listed distance exceeds twice the
current distance: by the triangle inequality no later entry of the list can
be nearer, nor as near. Distances are squared integers, so the bound is
``gap > 4 * current`` and exact. All parts of a slice of rows search at once,
one list place a step, in numpy arrays that shrink as searches end.

Spark deals the rows: a round is a scan that emits one row of sums for each
part and entry in a task, added up by a grouped sum. Only codebooks
(parts x entries vectors) reach the driver.

Cases. Rows whose vector is null or has a null, NaN or infinite component are
dropped. Ids and labels may be null: a null id comes after all others when the
first entries are chosen and is returned as null; null labels form one group.
Equal ids are ordered by their vectors, repeated rows stay rows. With fewer
rows than ``entries`` the codebook has as many entries as there are rows. An
empty table, or one without any whole vector, gives no rows. A vector whose
length differs from the others' raises ValueError, as does a length that
``parts`` doesn't divide. Components too large for 64-bit distances take the
same search over Python integers. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.llm.vectors import finite

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
ROWS = 1024  # vectors searched at once
SAFE = 1 << 28  # components up to this have distances that fit 64 bits
MAX_LABELS = 1 << 20  # label totals broadcast up to this many rows (16 bytes each)
SALTS = 64


def whole_numbers(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, a row a vector; Python integers
    where a component exceeds 64-bit arithmetic."""
    other = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (other != dim).any():
        raise ValueError(f"vectors of {dim} and {other[other != dim][0]} components")
    x = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(len(vectors), dim)
    if x.size and np.abs(x).max() >= SAFE:
        whole = np.empty(x.shape, dtype=object)
        whole[...] = [[int(v) for v in row] for row in x.tolist()]
        return whole
    return x.astype(np.int64)


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared length of each row."""
    return (x * x).sum(axis=1) if x.dtype == object else np.einsum("ij,ij->i", x, x)


class Codebooks:
    """Entries by (part, entry, component), and the sorted lists of each."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.size, width = entries.shape
        gaps = ((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(axis=3)
        rows = self.parts * self.size
        self.near = np.argsort(gaps, axis=2, kind="stable").reshape(rows, self.size)
        self.gaps = np.take_along_axis(gaps.reshape(rows, self.size), self.near, axis=1)
        self.flat = entries.reshape(rows, width)
        # first guesses: the entry whose component sum is nearest
        sums = entries.sum(axis=2)
        self.by_sum = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.by_sum, axis=1)

    def wide(self) -> bool:
        return self.entries.dtype == object

    def guess(self, x: np.ndarray) -> np.ndarray:
        """A starting entry for each vector and part of ``x`` (row, part, component)."""
        out = np.zeros(x.shape[:2], dtype=np.int64)
        for p in range(self.parts):
            total = x[:, p].sum(axis=1)
            right = np.minimum(np.searchsorted(self.sums[p], total), self.size - 1)
            left = np.maximum(right - 1, 0)
            closer = np.abs(self.sums[p][left] - total) < np.abs(self.sums[p][right] - total)
            out[:, p] = self.by_sum[p][np.where(closer, left, right)]
        return out

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance for each (row, part) of ``x``."""
        n = len(x) * self.parts
        lanes = x.reshape(n, -1)
        base = np.tile(np.arange(self.parts, dtype=np.int64) * self.size, len(x))
        best = self.guess(x).reshape(n)
        apart = _squares(lanes - self.flat[base + best])
        seen = np.zeros((n, self.size), dtype=bool)
        seen[np.arange(n), best] = True
        place = np.zeros(n, dtype=np.int64)
        going = np.arange(n)
        while len(going):
            going = going[place[going] < self.size]
            at, step = base[going] + best[going], place[going]
            ahead = ~(self.gaps[at, step] > 4 * apart[going]).astype(bool)
            going, at, step = going[ahead], at[ahead], step[ahead]
            entry = self.near[at, step]
            place[going] += 1
            fresh = ~seen[going, entry]
            lane, entry = going[fresh], entry[fresh]
            seen[lane, entry] = True
            away = _squares(lanes[lane] - self.flat[base[lane] + entry])
            here = apart[lane]
            better = (away < here) | ((away == here) & (entry < best[lane]))
            better = better.astype(bool)
            lane, entry = lane[better], entry[better]
            best[lane], apart[lane], place[lane] = entry, away[better], 0
        return best.reshape(len(x), self.parts), apart.reshape(len(x), self.parts)

    def assign(self, vectors: pa.Array, dim: int, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, integer parts, codes, distances) of slices of ``vectors``."""
        for first in range(0, len(vectors), ROWS):
            x = whole_numbers(vectors.slice(first, ROWS), dim, scale)
            if self.wide():
                x = x.astype(object)
            x = x.reshape(len(x), self.parts, dim // self.parts)
            yield first, x, *self.search(x)

    def digest(self) -> str:
        """SHA-256 of all components in order, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.reshape(-1)).encode()).hexdigest()


def _sums(books: Codebooks, dim: int, scale: int):
    """Scan of a round: per part and entry of a task, the members and their sums."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, width = books.parts * books.size, dim // books.parts
        counts, sums = np.zeros(rows, dtype=np.int64), np.zeros((rows, width), dtype=object)
        for batch in batches:
            for _, x, codes, _ in books.assign(batch.column(0), dim, scale):
                at = (codes + np.arange(books.parts) * books.size).reshape(-1)
                counts += np.bincount(at, minlength=rows)
                part = np.zeros((rows, width), dtype=x.dtype)
                np.add.at(part, at, x.reshape(len(at), width))
                sums += part
        used = np.flatnonzero(counts)
        cells = np.repeat(used * width, width) + np.tile(np.arange(width), len(used))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cells),
                pa.array(np.repeat(counts[used], width)),
                pa.array([int(v) for v in sums[used].reshape(-1)], type=pa.decimal128(38, 0)),
            ],
            names=["cell", "members", "total"],
        )

    return scan


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of ``vectors`` (vec_id, embedding; whole vectors only), or
    None where there are no rows."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()  # `entries` rows
    if not first:
        return None
    dim = len(first[0]["embedding"])
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    start = whole_numbers(pa.array([r["embedding"] for r in first], type=pa.list_(pa.float64())), dim, scale)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, dim // parts).transpose(1, 0, 2)))
    for _ in range(rounds):
        found = (
            vectors.select("embedding")
            .mapInArrow(_sums(books, dim, scale), "cell long, members long, total decimal(38,0)")
            .groupBy("cell")
            .agg(F.sum("members").alias("members"), F.sum("total").alias("total"))
            .collect()  # a row for each component of a codebook at most
        )
        moved = books.entries.copy().reshape(-1)
        if any(abs(int(r["total"])) >= SAFE * int(r["members"]) for r in found):
            moved = moved.astype(object)
        for r in found:
            moved[r["cell"]] = int(r["total"]) // int(r["members"])
        books = Codebooks(moved.reshape(books.entries.shape))
    return books


def _codes(books: Codebooks, dim: int, scale: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x, codes, apart in books.assign(batch.column("embedding"), dim, scale):
                rows = batch.slice(first, len(x))
                text = codes.astype(np.uint8).tobytes().hex()
                step = 2 * books.parts
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id"),
                        rows.column("label"),
                        pa.array([text[i : i + step] for i in range(0, len(text), step)], type=pa.string()),
                        pa.array([int(v) for v in apart.sum(axis=1)], type=pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return scan


def with_totals(rows: DataFrame, key: str, value: str, name: str, max_broadcast: int = MAX_LABELS, salts: int = SALTS) -> DataFrame:
    """``rows`` (written before) with the sum of ``value`` over equal ``key``,
    nulls together. The sums are counted first: up to ``max_broadcast`` they
    are broadcast, beyond that each is copied to ``salts`` parts of its key, so
    a key with a third of the rows is joined by ``salts`` tasks."""
    totals = stored(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name)), "totals")
    if totals.count() <= max_broadcast:
        return rows.join(F.broadcast(totals), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    totals = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_salt"))
    return salted.join(totals, same, "left").drop("_key", "_part", "_salt")


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """Codes of ``vectors`` (vec_id, embedding, label): vec_id, label, code
    (two hex digits a part) and error, and the codebooks they refer to."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    vectors = vectors.select("vec_id", "embedding", "label").filter(finite())
    books = fit(vectors, parts, entries, rounds, scale)
    kind = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    dim = books.parts * books.entries.shape[2]
    return vectors.mapInArrow(_codes(books, dim, scale), schema), books


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``embeddings``."""
    codes, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = with_totals(stored(codes, "vector_codes"), "label", "error", "label_error")
    digest = books.digest() if books else hashlib.sha256(b"").hexdigest()
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
