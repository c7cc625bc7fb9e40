"""Personal data: detected entities get keyed, type-consistent surrogates.

Detected are e-mail addresses, phone numbers, payment cards (Luhn), IPv4
addresses, US social security numbers, IBANs (mod 97), secrets (access keys,
values after ``password=`` and the like) and person names (after a title, or a
known first name before a capitalised word; Latin, Greek and Cyrillic script;
then every bare occurrence of these name parts in the same text, capitalised
or in capitals, but not inflected or in small letters). A given name that isn't listed is one
entity whatever its title; only the ending follows the gender that the text's titles tell.

An entity is its canonical form (digits of a number, lower-case address or
name part), so mentions in other formats corefer. Its surrogate is a keyed
permutation of all canonical forms of the same type and shape (a Feistel network with cycle walking,
so two entities of one shape can't meet) and is written in the mention's own
format: punctuation, case, script, kind of digit, country digit, card and IBAN check digits,
private or public address range, hexadecimal or alphanumeric secrets. First
names become the next of the same gender and script in a keyed order, other name parts
pronounceable words of the same script (there two may meet; the check settles it).

Collisions are checked over the whole corpus: no surrogate may be the surrogate of
another entity or any entity that really occurs (first names from the lists,
which follow each other in a keyed order, excepted). Entities that collide are drawn again, round by
round, until none does; from round ``MAX_ROUNDS`` on a surrogate is longer than
its entity, by one character or syllable more each round (an IPv4 address
becomes an IPv6 one), so a full or tiny space runs out of collisions and never stops the job.
Those few with a round over 0 travel with the job
while they are at most ``max_redrawn``, and are joined to their documents beyond.
A value after a keyword that is a mask (no letter or digit, at most two
different characters inside its brackets) is no entity.

Null texts stay null, texts without entities stay as they are, byte for byte.
Repeated rows get equal texts. All columns of the input are kept, ``text``
changed; ``entities`` (type, start, end in code points of the new text) and ``n_entities`` replace columns of those names.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.llm.scratch import stored
from augur.llm.words import slices

KEY = b"replace with a secret of your own"
MAX_REDRAWN = 100_000
MAX_ROUNDS = 16
ADDED = ("entities", "n_entities")

# First names by script and gender, titles by gender.
FIRST = {
    ("latin", "m"): "james john robert michael william david richard joseph thomas charles hans peter klaus jean pierre luc carlos juan miguel paul".split(),
    ("latin", "f"): "mary patricia jennifer linda elizabeth barbara susan jessica sarah karen anna petra ingrid marie claire sophie carmen lucia elena julia".split(),
    ("cyrillic", "m"): "иван алексей дмитрий сергей андрей михаил николай павел".split(),
    ("cyrillic", "f"): "анна мария елена ольга наталья татьяна ирина светлана".split(),
    ("greek", "m"): "γιώργος δημήτρης νίκος κώστας γιάννης παναγιώτης".split(),
    ("greek", "f"): "μαρία ελένη κατερίνα βασιλική σοφία γεωργία".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Monsieur": "m",
          "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Господин": "m", "Госпожа": "f",
          "Κύριος": "m", "Κυρία": "f"}
SYLLABLES = {
    "latin": ("bdfgklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
    "greek": ("βγδζθκλμνπρστφ", "αειοω"),
}
GENDER_OF = {name: (script, gender) for (script, gender), names in FIRST.items() for name in names}

NAME = r"[A-ZÀ-ÖØ-ÞΑ-ΩΆ-ΏА-ЯЁ][a-zß-öø-ÿα-ωά-ώа-яё]+"
FOUND: list[tuple[str, re.Pattern, tuple[str, ...]]] = [  # type, pattern, strings of which it needs one ("0": any digit)
    ("email", re.compile(r"(?<![\w.%+-])([A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,})(?![A-Za-z0-9])"), ("@",)),
    ("secret", re.compile(r"(?<!\w)((?:AKIA|ASIA)[0-9A-Z]{16})(?!\w)"), ("IA",)),
    ("secret", re.compile(r"(?<!\w)(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?([^\s\"',;]{6,})"), ("=", ":")),
    ("iban", re.compile(r"(?<!\w)([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"), ("0",)),
    ("card", re.compile(r"(?<![\w.+-])(\d(?:[ -]?\d){12,18})(?![\w-])"), ("0",)),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])"), ("0",)),
    ("phone", re.compile(r"(?<![\w+])(\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"), ("0",)),
    ("ip", re.compile(r"(?<![\w.])((?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d))(?!\w|\.\d)"), ("0",)),
    ("name", re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.? ({NAME}(?: {NAME}){{0,2}})|((?i:{'|'.join(GENDER_OF)}) {NAME}))(?!\w)"), (" ",)),
]
DIGIT = re.compile(r"\d")
OTHER_DIGIT = re.compile(r"[^\D0-9]")


def luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return "greek" if name.startswith("GREEK") else "cyrillic" if name.startswith("CYRILLIC") else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions (start, end, type, canonical form) in order, none overlapping;
    where two types claim a place, the one named first in FOUND has it."""
    return [mention[:4] for mention in find_gendered(text)]


def find_gendered(text: str) -> list[tuple[int, int, str, str, str]]:
    """As ``find``, with the gender that the text's titles give a given name ("n": none)."""
    starts: list[int] = []
    spans: list[tuple[int, int, str, str]] = []

    def take(start: int, end: int, what: str, canonical: str) -> bool:
        i = bisect.bisect_left(starts, start)
        free = (i == 0 or spans[i - 1][1] <= start) and (i == len(starts) or end <= starts[i])
        if free:
            starts.insert(i, start)
            spans.insert(i, (start, end, what, canonical))
        return free

    parts: dict[str, tuple[str, str]] = {}  # a name part as written -> its type and canonical form
    genders: dict[str, str] = {}
    digit = DIGIT.search(text) is not None
    # digits of other scripts are read as ASCII ones in numbers; places stay the same
    ascii_digits = OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m.group())), text) if digit and not text.isascii() else text
    for kind, pattern, need in FOUND:
        if not (digit if need == ("0",) else any(n in text for n in need)):
            continue
        for match in pattern.finditer(ascii_digits if need == ("0",) else text):
            group = 1 if match.group(1) is not None else 2
            for start, end, what, canonical in _canonical(kind, match.group(group), match.start(group), match):
                if take(start, end, what, canonical) and kind == "name":
                    written_as = text[start:end]
                    for form in (written_as[:1].upper() + written_as[1:], written_as.upper()):
                        parts.setdefault(form, (what, canonical))
                    gender = _title_gender(match)
                    if what.startswith("given") and gender != "n":
                        genders.setdefault(canonical, gender)
    for form, (what, canonical) in parts.items():  # bare occurrences of the text's names
        at = text.find(form)
        while at >= 0:
            end = at + len(form)
            if not (at and _in_word(text[at - 1]) or end < len(text) and _in_word(text[end])):
                take(at, end, what, canonical)
            at = text.find(form, end)
    return [(*s, genders.get(s[3], "n") if s[2].startswith("given") else "n") for s in spans]


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _title_gender(match: re.Match) -> str:
    return TITLES.get(match.group(0).split(" ")[0].rstrip("."), "n") if match.group(1) is not None else "n"


def _canonical(kind: str, mention: str, at: int, match: re.Match) -> Iterator[tuple[int, int, str, str]]:
    end = at + len(mention)
    if kind == "email":
        yield at, end, kind, mention.lower()
    elif kind == "card":
        digits = re.sub("[ -]", "", mention)
        if luhn(digits[:-1]) == int(digits[-1]) and digits.strip("0"):
            yield at, end, kind, digits
    elif kind == "iban":
        plain = mention.replace(" ", "")
        if iban_check(plain[:2], plain[4:]) == plain[2:4]:
            yield at, end, kind, plain
    elif kind == "phone":
        digits = re.sub(r"\D", "", mention)
        if 7 <= len(digits) <= 15:
            yield at, end, kind, ("+" if mention[0] == "+" else "") + digits
    elif kind == "name":
        gender = _title_gender(match)
        parts = mention.split(" ")
        for i, part in enumerate(parts):
            word = part.lower()
            if word in GENDER_OF and (i < len(parts) - 1 or len(parts) == 1 and gender != "n"):
                what = f"first {GENDER_OF[word][0]} {GENDER_OF[word][1]}"
            elif len(parts) > 1 and i == 0:
                what = f"given {script_of(word)}"
            else:
                what = f"family {script_of(word)}"
            yield at, at + len(part), what, word
            at += len(part) + 1
    elif kind != "secret" or not is_mask(mention):
        yield at, end, kind, mention


def is_mask(value: str) -> bool:
    """Whether a secret has been blanked out already, as in ``[********]``."""
    return not any(c.isalnum() for c in value) and len(set(value.strip("[](){}<>"))) <= 2


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size)."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, n_bytes = (1 << half) - 1, (half + 7) // 8
    prefix = key + b"\0" + tweak.encode("utf-8", "surrogatepass") + b"\0"
    while True:
        left, right = value >> half, value & mask
        for r in range(6):
            noise = hashlib.shake_128(prefix + bytes([r]) + right.to_bytes(n_bytes, "big")).digest(n_bytes)
            left, right = right, left ^ (int.from_bytes(noise, "big") & mask)
        value = left << half | right
        if value < size:
            return value


LETTERS, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
SYMBOLS = "!#$%&()*+-./:<=>?@[\\]^_`{|}~"  # those that a secret can hold


def reshaped(text: str, alphabets: list[str], key: bytes, tweak: str) -> str:
    """``text`` with each character replaced by one of its alphabet (empty:
    kept); distinct texts of one shape stay distinct."""
    value, size = 0, 1
    for c, alphabet in zip(text, alphabets, strict=True):
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    value = permuted(value, size, key, tweak + "|" + "".join(a[:1] or c for c, a in zip(text, alphabets, strict=True)))
    out = []
    for c, alphabet in zip(reversed(text), reversed(alphabets), strict=True):
        if alphabet:
            value, place = divmod(value, len(alphabet))
            c = alphabet[place]
        out.append(c)
    return "".join(reversed(out))


@functools.lru_cache(4096)
def _alphabet(c: str) -> str:
    """The class of a letter, digit or symbol outside ASCII: its own ten digits, or
    the characters of its general category in its 256 code points; others have none."""
    kind, block = unicodedata.category(c), ord(c) & ~0xFF
    if kind == "Nd":
        return "".join(chr(ord(c) - unicodedata.decimal(c) + i) for i in range(10))
    return "".join(x for x in map(chr, range(max(block, 0x80), block + 0x100)) if unicodedata.category(x) == kind) if kind[0] in "LNSP" else ""


def _by_class(text: str) -> list[str]:
    """Alphabets of the characters; symbols have one only where there is nothing else."""
    known = (LETTERS, LETTERS.upper(), DIGITS) if any(c.isalnum() for c in text) else (SYMBOLS,)
    return [next((a for a in known if c in a), _alphabet(c) if c > "\x7f" and (known[0] == SYMBOLS or c.isalnum()) else "") for c in text]


def _address_class(value: int) -> int:
    first = value >> 24
    if first == 10 or value >> 20 == 0xAC1 or value >> 16 == 0xC0A8:
        return 1
    return 2 if first in (0, 127) or first >= 224 else 0


def surrogate(kind: str, canonical: str, key: bytes, draw: int = 0) -> str:
    """Canonical form of the entity that stands for this one; longer from draw MAX_ROUNDS on."""
    tweak = f"{kind}|{draw}"
    more = max(0, draw - MAX_ROUNDS + 1)
    if kind == "email":
        keep = len(canonical) - canonical.rindex(".")  # the top-level domain stays
        body = "a" * more + canonical[:-keep]
        return reshaped(body, _by_class(body), key, tweak) + canonical[-keep:]
    if kind == "card":
        body = canonical[:-1] + "0" * more
        body = body[0] + reshaped(body[1:], [DIGITS] * (len(body) - 1), key, tweak + body[0])
        return body + str(luhn(body))
    if kind == "iban":
        account = canonical[4:] + "0" * more
        account = reshaped(account, _by_class(account), key, tweak + canonical[:2])
        return canonical[:2] + iban_check(canonical[:2], account) + account
    if kind == "phone":
        keep = 2 if canonical[0] == "+" else 0
        digits = canonical[keep:] + "0" * more
        return canonical[:keep] + reshaped(digits, [DIGITS] * len(digits), key, tweak + canonical[:keep])
    if kind == "ssn":
        canonical += "0" * more
        return reshaped(canonical, _by_class(canonical), key, tweak)
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, canonical.split("."))), "big")
        own = _address_class(value)
        if more:  # one to one, and no IPv4 address: never collides
            value = permuted(value, 1 << 32, key, tweak)
            return f"{'fd00' if own == 1 else '2001:db8'}::{value >> 16:x}:{value & 0xFFFF:x}"
        while True:
            value = permuted(value, 1 << 32, key, tweak)
            if _address_class(value) == own:
                return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "secret":
        if canonical[:4] in ("AKIA", "ASIA") and len(canonical) == 20:
            return canonical[:4] + reshaped(canonical[4:] + "A" * more, [LETTERS.upper() + DIGITS] * (16 + more), key, tweak + canonical[:4])
        hexadecimal = all(c in HEX for c in canonical)
        canonical += ("0" if hexadecimal else "a") * more
        return reshaped(canonical, [HEX] * len(canonical) if hexadecimal else _by_class(canonical), key, tweak)
    if kind.startswith("first"):
        return _first_names(kind, key)[canonical]
    return _pronounceable(canonical, kind.split(" ")[1], key, tweak, more)


@functools.lru_cache(64)
def _first_names(kind: str, key: bytes) -> dict[str, str]:
    """Each listed name's surrogate: the next in a keyed order, so no name stays, none meet,
    and a known pair tells nothing of the others."""
    _, script, gender = kind.split(" ")
    order = sorted(FIRST[script, gender], key=lambda n: hashlib.blake2b(f"{kind}|{n}".encode(), key=hashlib.sha256(key).digest()).digest())
    return dict(zip(order, [*order[1:], order[0]], strict=True))


def _pronounceable(word: str, script: str, key: bytes, tweak: str, more: int = 0) -> str:
    """A word of the script, with ``more`` syllables than usual."""
    value = int.from_bytes(word.encode("utf-8", "surrogatepass"), "big")
    consonants, vowels = SYLLABLES[script]
    base = len(consonants) * len(vowels)
    # letters of a script carry under 5 bits each where they name few words, 16 at most in UTF-8
    size, count = 1, 0
    room = max(base**2, min(256 ** len(word.encode("utf-8", "surrogatepass")), base ** (len(word) + 1)))
    while size < room:
        size, count = size * base, count + 1
    usual = 2 * count
    usual = usual // 2 if count > 6 else usual
    size, count = size * base**more, count + more
    value = permuted(value % size, size, key, f"{tweak}|{count}")
    out = ""
    for _ in range(count):
        value, place = divmod(value, base)
        out += consonants[place // len(vowels)] + vowels[place % len(vowels)]
    return out[: usual + 2 * more]


def _in_digits_of(mention: str, new: str) -> str:
    """``new`` with the mention's kind of digit at each of its places (the last kind beyond)."""
    zeros = [ord(c) - unicodedata.decimal(c) for c in mention if c.isdecimal()]
    places = itertools.count()
    return "".join(chr(zeros[min(next(places), len(zeros) - 1)] + int(c)) if c.isdecimal() else c for c in new)


def written(mention: str, kind: str, canonical: str, new: str, gender: str = "n") -> str:
    """The surrogate in the mention's format; a woman's given name ends in a."""
    if kind in ("card", "phone", "iban", "ssn", "ip"):
        if kind in ("card", "phone", "iban"):
            plain = iter(new.lstrip("+"))
            new = "".join(next(plain) if c.isalnum() else c for c in mention) + "".join(plain)
        return new if mention.isascii() else _in_digits_of(mention, new)
    if kind == "email":
        more = len(new) - len(mention)
        return new[:more] + "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new[more:], strict=True))
    if kind.split(" ")[0] in ("first", "given", "family"):
        if gender == "f":
            new = new[:-1] + {"cyrillic": "а", "greek": "α"}.get(kind.split(" ")[1], "a")
        return new.upper() if len(mention) > 1 and mention.isupper() else new[:1].upper() + new[1:]
    return new


def replace(text: str, key: bytes, draw_of: Callable[[str, str], int]) -> tuple[str, list[dict]]:
    """The text with surrogates, and where they are."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, canonical, gender in find_gendered(text):
        new = written(text[start:end], kind, canonical, surrogate(kind, canonical, key, draw_of(kind, canonical)), gender)
        out += [text[at:start], new]
        size += start - at
        spans.append({"type": kind, "start": size, "end": size + len(new)})
        size += len(new)
        at = end
    return "".join([*out, text[at:]]) if spans else text, spans


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        found = sorted({(kind, canonical) for t in part["text"].to_pylist() if t for _, _, kind, canonical in find(t)})
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.string()), pa.array([c for _, c in found], pa.string())], names=["type", "entity"]
        )


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        found = [(r, k, c) for r, t in enumerate(part["text"].to_pylist()) if t for k, c in sorted({x[2:] for x in find(t)})]
        rows = pa.array([r for r, _, _ in found], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [part["t1"].take(rows), part["t2"].take(rows), pa.array([k for _, k, _ in found], pa.string()), pa.array([c for _, _, c in found], pa.string())],
            names=["t1", "t2", "type", "entity"],
        )


def _draw(key: bytes, draw: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(k, e, key, draw) for k, e in zip(batch["type"].to_pylist(), batch["entity"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["type"], batch["entity"], pa.array(new, pa.string())], names=["type", "entity", "new"])

    return run


def _stem(column: str) -> Column:
    """What of a surrogate or entity must not meet: a given name up to the letter that gender may change."""
    return F.expr(f"if(type like 'given %', substring({column}, 1, char_length({column}) - 1), {column})")


def redrawn(docs: DataFrame, key: bytes = KEY) -> DataFrame | None:
    """(type, entity, draw) of the entities whose first surrogate collides;
    None if there are none. Surrogates grow from round ``MAX_ROUNDS`` on, past the
    length of any that is taken, so the rounds end."""
    entities = stored(docs.select("text").mapInArrow(_entities, "type string, entity string").distinct(), "entities")
    entities = entities.filter("type not like 'first %'")
    n = entities.count()
    pending, taken, drawn = entities, None, None
    for draw in itertools.count():
        made = stored(pending.mapInArrow(_draw(key, draw), "type string, entity string, new string").withColumn("new", _stem("new")), "surrogates", n)
        real = entities.select("type", _stem("entity").alias("new"))
        used = real if taken is None else real.unionByName(taken)
        first = made.groupBy("type", "new").agg(F.min("entity").alias("entity"))  # of several that meet, one keeps it
        good = stored(first.join(used, ["type", "new"], "left_anti"), "good", n)  # so plans don't nest
        pending = stored(made.join(good, ["type", "new", "entity"], "left_anti").select("type", "entity"), "pending", n)
        if draw:
            now = good.select("type", "entity", F.lit(draw).alias("draw"))
            drawn = now if drawn is None else drawn.unionByName(now)
        if pending.isEmpty():
            return drawn
        taken = good.select("type", "new") if taken is None else taken.unionByName(good.select("type", "new"))


def _apply(key: bytes, known: dict[tuple[str, str], int], own: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches, "text"):
            draws = part["draws"].to_pylist() if own else None
            texts, spans = [], []
            for r, text in enumerate(part["text"].to_pylist()):
                if text is None:
                    texts.append(None)
                    spans.append([])
                    continue
                rounds = {(d["type"], d["entity"]): d["draw"] for d in draws[r] or ()} if own else known
                new, where = replace(text, key, lambda k, c, rounds=rounds: rounds.get((k, c), 0))
                texts.append(new)
                spans.append(where)
            names = [c for c in part.schema.names if c not in ("draws", "t1", "t2")]
            columns = [pa.array(texts, pa.string()) if c == "text" else part[c] for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spans, kind), pa.array([len(s) for s in spans], pa.int64())], names=[*names, *ADDED]
            )

    return run


def replace_personal_data(docs: DataFrame, key: bytes = KEY, max_redrawn: int = MAX_REDRAWN) -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``entities`` and ``n_entities``."""
    rest = docs.select([c for c in docs.columns if c not in ADDED])
    schema = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in rest.columns)
    schema += ", entities array<struct<type:string,start:int,end:int>>, n_entities long"
    again = redrawn(rest, key)
    rows = [] if again is None else again.limit(max_redrawn + 1).collect()
    if len(rows) <= max_redrawn:
        return rest.mapInArrow(_apply(key, {(r["type"], r["entity"]): r["draw"] for r in rows}, own=False), schema)
    keyed = rest.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(7), "text")})
    draws = (
        keyed.select("t1", "t2", "text")
        .mapInArrow(_mentions, "t1 long, t2 long, type string, entity string")
        .join(again, ["type", "entity"])
        .distinct()
        .groupBy("t1", "t2")
        .agg(F.collect_list(F.struct("type", "entity", "draw")).alias("draws"))
    )
    return keyed.join(draws, ["t1", "t2"], "left").mapInArrow(_apply(key, {}, own=True), schema)


def op6_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents`` with surrogates."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_personal_data(docs).select("doc_id", "n_entities", "text")
