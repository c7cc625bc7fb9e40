"""Plain single-process versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, shingle=4):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    size = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, distance=4):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    names = list({f for _, f in prints})
    up = {f: f for f in names}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for a in names:
        for b in names:
            if a < b and (a ^ b).bit_count() <= distance:
                up[root(b)] = root(a)
    least = {}
    for i, f in prints:
        r = root(f)
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in prints]


def contamination(docs, bench, size=13):
    windows = {}
    for item, text in bench:
        w = PLAIN.findall(lower(text))
        for s in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[s : s + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w = PLAIN.findall(lower(text))
        hit, items = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    items |= found
        names = sorted(str(x) for x in items if x is not None)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def base_rules(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for i, text in rows:
        text = text or ""
        words = WORD.findall(text)
        seen, again = set(), 0
        for line in text.split("\n"):
            again += line in seen and bool(WORD.search(line))
            seen.add(line)
        grams = Counter(tuple(words[s : s + 5]) for s in range(len(words) - 4))
        cover = {s + k for s in range(len(words) - 4) if grams[tuple(words[s : s + 5])] > 1 for k in range(5)}
        failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
        out.append((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(cover), failed))
    return out


def repeats(rows, window=35):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    cut = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[s : s + window]) for _, w in cut for s in range(len(w) - window + 1))
    out = []
    for i, w in cut:
        gone = {s + k for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for k in range(window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out
