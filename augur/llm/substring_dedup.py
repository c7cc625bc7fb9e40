"""Substring deduplication by prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one document. Every word covered
by a window whose word sequence also starts anywhere else (same document
included) is removed; windows are judged on the input.

The suffixes of all texts (one starts at each word) fall into groups by a
variable-length prefix: from the suffix's first word to the end of the
``gram``-word gram with the least hash inside the suffix's first window. Equal
windows have the same least gram at the same distance, so they share a group,
and a group's suffixes are the starts left of one common gram.

1. Scan: the grams that end some window's prefix (about one in 14 places).
   A gram that occurs once ends no repeated prefix; its suffixes are dropped
   before any text moves.
2. Groups of up to ``max_group`` gram places get, per place, the words from
   the first suffix to the end of the last one's window, and one task builds
   their trees top-down: edges of 8, 8, 8, ... words split a node's
   suffixes, nodes with one suffix are leaves and dropped, and the nodes
   still shared at depth ``window`` are the deep internal nodes. Their suffixes
   are compared word by word before they count as repeats.
3. In larger groups (a passage on a third of all documents) the prefix is
   lengthened to the whole window: a suffix is then one 128-bit key, counted
   with map-side combining, so no task holds the group.

Exact copies are one text with a count: identical texts are collapsed before
step 2, whatever their number, and each window of a copied text repeats.

Null and empty texts and texts of fewer than ``window`` words lose nothing.
Rows need no unique id: repeated rows count as copies and each gets its own
output row. Columns of the input are kept unless they have the name of an
added one (``n_words``, ``n_removed``, ``kept_text``, ``removed``), which then
takes its place.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.llm.words import MULT, Words, find_words, gram_hashes, mix, slices

WINDOW = 35
GRAM = 8
MAX_GROUP = 32_768  # gram places in one task: about 2 million words
EDGE = 8
ADDED = ("n_words", "n_removed", "kept_text", "removed")


def least_grams(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, the place of each one's least gram (leftmost of
    equals) and the hash of the gram at every word."""
    grams = gram_hashes(hashes, gram)
    starts = np.flatnonzero(np.arange(len(hashes)) + window <= words.last)
    if not len(starts):
        return starts, starts, grams
    span = window - gram + 1
    best = np.arange(len(grams))
    width = 1
    while width < span:  # best[i]: place of the least gram among i .. i + width - 1
        step = min(width, span - width)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        width += step
    return starts, best[starts], grams


def _runs(places: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal neighbours."""
    return np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else places


def _scan(window: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = find_words(part["text"])
            starts, least, grams = least_grams(words, words.hashes(), window, gram)
            places = least[_runs(least)]
            rows = np.searchsorted(words.row, places, side="right") - 1
            keys = grams[places].view(np.int64)
            order = np.lexsort((keys, rows))  # one row for each gram of a text
            rows, keys = rows[order], keys[order]
            new = np.r_[True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])][: len(rows)]
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[first]),
                    part["d1"].take(pa.array(rows[first])),
                    part["d2"].take(pa.array(rows[first])),
                    pa.array(np.diff(np.r_[first, len(rows)]).astype(np.int64)),
                ],
                names=["gram", "d1", "d2", "places"],
            )

    return scan


def _suffixes(window: int, gram: int):
    """Per place of a repeated gram: the words its suffixes need; per suffix
    of a hot gram: the key of its whole window."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = find_words(part["text"])
            starts, least, grams = least_grams(words, words.hashes(), window, gram)
            first = _runs(least)
            n_starts = np.diff(np.r_[first, len(least)])
            wanted = part["grams"]
            flat, offsets = wanted.flatten(), np.diff(wanted.offsets.to_numpy())
            keys = flat.field("gram").to_numpy(zero_copy_only=False)
            hot = flat.field("hot").to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(part)), offsets)
            by_row = np.searchsorted(words.row, least[first], side="right") - 1
            place_keys = grams[least[first]].view(np.int64)
            known = {(r, k): h for r, k, h in zip(owner.tolist(), keys.tolist(), hot.tolist(), strict=True)}
            data, begin, end = words.data.tobytes(), words.start, words.end
            out_key, out_row, out_at, out_n, out_text, out_hot = [], [], [], [], [], []
            for i, (r, k) in enumerate(zip(by_row.tolist(), place_keys.tolist(), strict=True)):
                is_hot = known.get((r, k))
                if is_hot is None:
                    continue
                s, n = int(starts[first[i]]), int(n_starts[i])
                if is_hot:
                    tokens = [data[a:b] for a, b in zip(begin[s : s + n + window - 1], end[s : s + n + window - 1], strict=True)]
                    for j in range(n):
                        out_key.append(k)
                        out_row.append(r)
                        out_at.append(s + j - int(words.row[r]))
                        out_n.append(1)
                        out_text.append(hashlib.blake2b(b" ".join(tokens[j : j + window]), digest_size=16).digest())
                        out_hot.append(True)
                else:
                    out_key.append(k)
                    out_row.append(r)
                    out_at.append(s - int(words.row[r]))
                    out_n.append(n)
                    out_text.append(data[begin[s] : end[s + n + window - 2]])
                    out_hot.append(False)
            rows = pa.array(out_row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_key, pa.int64()),
                    part["d1"].take(rows),
                    part["d2"].take(rows),
                    pa.array(out_at, pa.int64()),
                    pa.array(out_n, pa.int32()),
                    pa.array(out_text, pa.binary()),
                    pa.array(out_hot, pa.bool_()),
                ],
                names=["gram", "d1", "d2", "at", "n", "content", "hot"],
            )

    return suffixes


def shared_at_depth(node: np.ndarray, at: np.ndarray, hashes: np.ndarray, words: Words, window: int) -> np.ndarray:
    """Top-down trees over the suffixes from the words ``at`` on, of the groups
    ``node``: which suffixes reach depth ``window`` in company."""
    alive = np.arange(len(node))
    node = node.astype(np.uint64)
    edges = gram_hashes(hashes, EDGE)
    depth = 0
    while depth < window and len(alive):
        step = min(EDGE, window - depth)
        edge = edges if step == EDGE else gram_hashes(hashes, step)
        node = mix_pair(node, edge[at[alive] + depth])
        order = np.argsort(node, kind="stable")
        ranked = node[order]
        same = np.r_[False, ranked[1:] == ranked[:-1]]
        company = order[same | np.r_[same[1:], False]]
        alive, node = alive[company], node[company]
        depth += step
    if not len(alive):
        return alive
    # hashes propose, bytes decide: word by word against the node's first suffix (a
    # node's suffixes are neighbours now)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(node)]))
    equal = words.same_runs(at[alive], at[alive[first[number]]], window)
    shared = np.ones(len(alive), dtype=bool)
    for n in np.unique(number[~equal]).tolist():  # different words of one hash: by their bytes
        own = np.flatnonzero(number == n)
        content = [words.bytes_of(int(at[alive[i]]), window) for i in own.tolist()]
        times = Counter(content)
        shared[own] = [times[c] > 1 for c in content]
    return alive[shared]


def mix_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * MULT + b)


def _trees(window: int):
    """Suffixes sorted by group -> per place, a bit for each repeated suffix."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def build(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            words = find_words(pc.cast(table["content"].combine_chunks(), pa.string()))
            n = table["n"].to_numpy()
            place = np.repeat(np.arange(len(n)), n)
            shift = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
            shared = shared_at_depth(table["gram"].to_numpy()[place].view(np.uint64), words.row[place] + shift, words.hashes(), words, window)
            bits = np.zeros(len(n), dtype=np.int64)
            np.bitwise_or.at(bits, place[shared], np.int64(1) << shift[shared])
            found = np.flatnonzero(bits)
            kept = table.select(["d1", "d2", "at"]).take(pa.array(found)).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [*(kept[c].combine_chunks() if kept.num_rows else pa.array([], pa.int64()) for c in ("d1", "d2", "at")), pa.array(bits[found])],
                names=["d1", "d2", "at", "bits"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = held["gram"].to_numpy()
            last = len(keys) - int(np.argmax((keys != keys[-1])[::-1])) if keys[0] != keys[-1] else 0
            if last and held.nbytes > 1 << 20:
                yield build(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield build(held)

    return trees


def _cut(window: int):
    """Applies the repeated starts of each row's text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, copies = part["text"], part["copies"].to_pylist()
            words = find_words(texts)
            n_words = np.diff(words.row)
            covered = np.zeros(len(words.start) + 1, dtype=np.int64)
            for r, hits in enumerate(part["hits"].to_pylist()):
                if copies[r] > 1 and n_words[r] >= window:
                    covered[words.row[r]] += 1
                    covered[words.row[r + 1]] -= 1
                    continue
                for hit in hits or ():
                    at, bits = words.row[r] + hit["at"], hit["bits"]
                    while bits:
                        low = (bits & -bits).bit_length() - 1
                        covered[at + low] += 1
                        covered[at + low + window] -= 1
                        bits &= bits - 1
            gone = np.cumsum(covered)[:-1] > 0
            removed, kept, spans = [], [], []
            data = words.data.tobytes()
            for r in range(len(part)):
                a, b = words.row[r], words.row[r + 1]
                off = gone[a:b]
                removed.append(int(off.sum()))
                keep = np.flatnonzero(~off) + a
                kept.append(b" ".join([data[x:y] for x, y in zip(words.start[keep].tolist(), words.end[keep].tolist(), strict=True)]).decode())
                edge = np.flatnonzero(np.diff(np.r_[0, off.astype(np.int8), 0]))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)])
            carried = [c for c in part.schema.names if c not in ("text", "d1", "d2", "copies", "hits", *ADDED)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part[c] for c in carried),
                    texts,
                    pa.array(n_words.astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                names=[*carried, "text", *ADDED],
            )

    return cut


def repeated_starts(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """(d1, d2, at, bits): in the text with this digest, window at + i repeats
    for each set bit i. ``texts`` has ``text``, ``d1``, ``d2``, one row a document."""
    if not 0 < gram <= window <= gram + 60:
        raise ValueError("need 0 < gram <= window <= gram + 60")
    places = texts.mapInArrow(_scan(window, gram), "gram long, d1 long, d2 long, places long")
    groups = places.groupBy("gram").agg(F.sum("places").alias("n")).filter("n > 1")
    wanted = (
        places.select("gram", "d1", "d2")
        .join(groups, "gram")
        .groupBy("d1", "d2")
        .agg(F.collect_set(F.struct("gram", (F.col("n") > max_group).alias("hot"))).alias("grams"))
    )
    # one row a text, combined before the shuffle, so copies don't meet in one task
    distinct = texts.select("d1", "d2", "text").dropDuplicates(["d1", "d2"])
    suffixes = distinct.join(wanted, ["d1", "d2"]).mapInArrow(
        _suffixes(window, gram),
        "gram long, d1 long, d2 long, at long, n int, content binary, hot boolean",
    )
    trees = (
        suffixes.filter("not hot")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_trees(window), "d1 long, d2 long, at long, bits long")
    )
    whole = suffixes.filter("hot").select("content", "d1", "d2", "at")
    nodes = whole.groupBy("content").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("content")
    single = whole.join(nodes, "content", "left_semi").select("d1", "d2", "at", F.lit(1).cast("long").alias("bits"))
    return trees.unionByName(single)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_group: int = MAX_GROUP) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``n_words``,
    ``n_removed``, ``kept_text`` (kept words joined by one space) and
    ``removed`` (word spans [start, end)). See the module's docstring."""
    carried = [c for c in docs.columns if c not in ADDED and c != "text"]
    hidden = {c: f"_c{i}" for i, c in enumerate(carried)}
    text = F.coalesce(F.col("text"), F.lit(""))
    # two 64-bit hashes from different seeds; null and empty are one text without words
    base = docs.select(
        *(F.col(f"`{c}`").alias(hidden[c]) for c in carried),
        F.col("text"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(7), text).alias("d2"),
    )
    copies = base.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"))
    hits = (
        repeated_starts(base, window, gram, max_group)
        .groupBy("d1", "d2")
        .agg(F.collect_list(F.struct("at", "bits")).alias("hits"))
    )
    # written, so the join can split the copies of one text
    changes = stored(copies.join(hits, ["d1", "d2"], "left").filter("copies > 1 or hits is not null"), "changes")
    joined = base.join(changes, ["d1", "d2"], "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
    fields = ", ".join(f"`{hidden[c]}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    cut = joined.mapInArrow(
        _cut(window),
        f"{fields}{', ' if fields else ''}text string, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>",
    )
    order = [c for c in docs.columns if c not in ADDED]
    return cut.select(*(F.col(hidden.get(c, c)).alias(c) for c in order), *ADDED)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )
