"""PII surrogates: detected entities get keyed replacements of the same type, format, script and gender.

Digits and letters are replaced by a keyed permutation of all strings of the same shape (a generalised
Feistel network over mixed radices: a digit for a digit, a vowel for a vowel, a letter for a letter of
its script, case kept): into the network, a keyed step along its range, and back out. Such a permutation
has no fixed point, so no value stands for itself; it has no collisions, so different entities stay
different, and it depends on key and value alone, so one entity gets one surrogate in every document,
without a table of entities and so at any scale. Given names are permuted within the list of their gender
and script. The collision check in each document counts, as `n_clashes`, entities that share a surrogate with
another one (none can, by construction) and surrogates that are also another detected value of the
document (which is itself replaced; a matter of chance where a format has few values).

The key is a secret of the caller and has no default: who has it can reverse the surrogates.

Detected: e-mail addresses, phone numbers, card numbers (Luhn validity kept), IPv4 addresses, social
security numbers, IBANs, and names after a title or of a known given name with a capitalised surname.

Defined results: null text stays null with no entities; empty text stays empty; repeated rows give equal
rows; an empty table gives an empty result; extra columns are ignored by `surrogate_digest`.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEMALE = "Mary Anna Emma Julia Laura Sarah Linda Susan Karen Nancy Lisa Betty Helen Sandra Donna Carol Ruth Sharon Michelle Alice Sophie Claire Camille Juliette Chloe Heidi Greta Ingrid Ursula Monika Lucia Carmen Isabel Elena Marta Pilar".split()
MALE = "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Steven Paul Andrew Kevin Brian George Pierre Jacques Antoine Olivier Mathieu Hans Klaus Dieter Jürgen Stefan Carlos Miguel Javier Pablo Diego Fernando".split()
FEMALE_CYRILLIC = "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split()
MALE_CYRILLIC = "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай Владимир Павел".split()
POOLS = {"f": FEMALE, "m": MALE, "fc": FEMALE_CYRILLIC, "mc": MALE_CYRILLIC}
_POOL_OF = {n: k for k, names in POOLS.items() for n in names}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Prof": ""}
_GIVEN = "|".join(sorted(_POOL_OF, key=len, reverse=True))
_CAP = r"[^\W\d_a-zà-öø-ÿа-я][^\W\d_A-ZÀ-ÖØ-ÞА-Я]+"
_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)")
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CARD = re.compile(r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d])")
PHONE = re.compile(r"(?<![\w.])\+\d{1,3}[ .|*#$%&!-]{1,8}\(\d{2,4}\)[ .|*#$%&!-]{1,8}\d{3}-\d{4}(?!\w)|(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}(?:[ .-]\d{2,4}){1,3}(?!\w)|(?<![\w.])\+\d{8,15}(?!\w)|(?<![\w.-])\d{3}-\d{4}(?![\w-])")
NAME = re.compile(rf"\b(?:({'|'.join(TITLES)})\.?[ ])((?:{_CAP})(?:[ ](?:{_CAP})){{0,2}})|\b({_GIVEN})[ ]({_CAP})")
PATTERNS = (("ip", IPV4), ("ssn", SSN), ("iban", IBAN), ("card", CARD), ("phone", PHONE))
#: Characters that are permuted as one number.
CHAIN = 64
KINDS = ("email", "ip", "ssn", "iban", "card", "phone", "name")

_SETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöüåæøœ", "ßñçý", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αεηιουω", "βγδζθκλμνξπρστφχψ"]
_SETS += [s.upper() for s in _SETS if s != "ßñçý"]
_SETS += ["0123456789", "".join(map(chr, range(0x4E00, 0x9FA6))), "".join(map(chr, range(0x3041, 0x3097))), "".join(map(chr, range(0x30A1, 0x30FB))), "".join(map(chr, range(0xAC00, 0xD7A4))), "".join(map(chr, range(0x627, 0x64B))), "".join(map(chr, range(0x5D0, 0x5EB))), "".join(map(chr, range(0x915, 0x93A)))]
_SET_OF = {c: k for k, s in enumerate(_SETS) for c in s}
_PLACE = {c: i for s in _SETS for i, c in enumerate(s)}


def _noise(key: bytes, tweak: str, i: int, value: int, below: int) -> int:
    d = hmac.digest(key, f"{tweak}|{i}|{value:x}".encode(), hashlib.sha256)
    while len(d) * 8 < below.bit_length() + 64:
        d += hashlib.sha256(d).digest()
    return int.from_bytes(d, "big") % below


def permute(text: str, key: bytes, tweak: str) -> str:
    """The keyed permutation without fixed points of strings of text's shape; characters of no set stay.

    Strings of more than CHAIN characters go piece by piece, each under what the text before it was: the
    whole stays a permutation, and its work is linear."""
    shape = "".join(f"{_SET_OF[c]}," if c in _SET_OF else c for c in text)
    if len(text) <= CHAIN:
        return _piece(text, key, tweak + shape)
    seen = hashlib.sha256(f"{tweak}{shape}".encode("utf-8", "surrogatepass"))
    out = []
    for k in range(0, len(text), CHAIN):
        out.append(_piece(text[k : k + CHAIN], key, seen.hexdigest()))
        seen.update(text[k : k + CHAIN].encode("utf-8", "surrogatepass"))
    return "".join(out)


def _piece(text: str, key: bytes, tweak: str) -> str:
    at = [i for i, c in enumerate(text) if c in _SET_OF]
    if not at:
        return text
    sizes = [len(_SETS[_SET_OF[text[i]]]) for i in at]
    half = len(at) // 2
    a = b = 1
    x = y = 0
    for k, i in enumerate(at):
        if k < half:
            x, a = x * sizes[k] + _PLACE[text[i]], a * sizes[k]
        else:
            y, b = y * sizes[k] + _PLACE[text[i]], b * sizes[k]
    x, y = _moved(x, y, a, b, key, tweak)
    out = list(text)
    for k in range(len(at) - 1, -1, -1):
        s = _SETS[_SET_OF[text[at[k]]]]
        if k < half:
            x, d = divmod(x, sizes[k])
        else:
            y, d = divmod(y, sizes[k])
        out[at[k]] = s[d]
    return "".join(out)


def _moved(x: int, y: int, a: int, b: int, key: bytes, tweak: str) -> tuple[int, int]:
    """(x, y) of Z_a x Z_b through the network, a keyed step of 1 to a*b - 1 along the whole range, and back."""
    for r in range(6):
        if r % 2:
            x = (x + _noise(key, tweak, r, y, a)) % a
        else:
            y = (y + _noise(key, tweak, r, x, b)) % b
    if a * b > 1:
        x, y = divmod((x * b + y + 1 + _noise(key, tweak, 6, 0, a * b - 1)) % (a * b), b)
    for r in range(5, -1, -1):
        if r % 2:
            x = (x - _noise(key, tweak, r, y, a)) % a
        else:
            y = (y - _noise(key, tweak, r, x, b)) % b
    return x, y


def _luhn(digits: str) -> int:
    """The sum that a valid number has at 0, modulo 10."""
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _surrogate(kind: str, value: str, key: bytes) -> str:
    if kind == "card":
        digits = [i for i, c in enumerate(value) if c.isdigit()]
        was = _luhn("".join(value[i] for i in digits))
        new = list(permute(value[: digits[-1]], key, "card") + value[digits[-1] :])
        for d in "0123456789":
            new[digits[-1]] = d
            if _luhn("".join(new[i] for i in digits)) == was:
                break
        return "".join(new)
    if kind == "ip":
        return ".".join(map(str, _octets([int(p) for p in value.split(".")], key)))
    if kind == "phone" and value.startswith("+"):
        m = re.match(r"\+\d{1,3}(?=\D)", value)
        keep = m.end() if m else 2
        return value[:keep] + permute(value[keep:], key, "phone")
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        keep = 2 if len(labels) > 2 and labels[-2] == "example" else 1
        mine = permute(".".join(labels[:-keep]), key, "domain")
        return f"{permute(local, key, 'local')}@{mine}.{'.'.join(labels[-keep:]) if keep == 2 else labels[-1] + '.example'}"
    if kind == "iban":
        return value[:2] + permute(value[2:], key, "iban")
    if kind == "name":
        return " ".join(_name(w, key) for w in value.split(" "))
    return permute(value, key, kind)


def _octets(p: list[int], key: bytes) -> list[int]:
    x, y = _moved(p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, key, "ip")
    return [x >> 8, x & 255, y >> 8, y & 255]


def _name(word: str, key: bytes) -> str:
    pool = POOLS.get(_POOL_OF.get(word, ""))
    if pool:  # a cyclic shift of the pool in keyed order: a permutation without fixed points
        order = sorted(pool, key=lambda n: hmac.digest(key, n.encode(), hashlib.sha256))
        step = 1 + _noise(key, "given", 0, 0, len(pool) - 1)
        return order[(order.index(word) + step) % len(pool)]
    new = permute(word, key, "name")
    while new in _POOL_OF:  # given names are permuted among themselves
        new = permute(new, key, "name")
    return new


def _emails(text: str) -> list[tuple[int, int]]:
    """Addresses, found from their @: the word characters before it and the domain after it. What one @ reads
    ends at the next, so the work is linear in the text."""
    out: list[tuple[int, int]] = []
    after, at = 0, text.find("@")
    while at >= 0:
        nxt = text.find("@", at + 1)
        start = at
        while start > after and (text[start - 1] in "_.+%-" or text[start - 1].isalnum()):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        after = m.end() if m else at + 1
        at = nxt
    return out


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost first, not overlapping; the earlier pattern wins."""
    found = [(a, b, -1, "email") for a, b in _emails(text)]
    if re.search(r"\d", text):
        for order, (kind, pattern) in enumerate(PATTERNS):
            found += [(m.start(), m.end(), order, kind) for m in pattern.finditer(text)]
    for m in NAME.finditer(text):
        found.append((m.start(2), m.end(2), 9, "name") if m[2] else (m.start(3), m.end(4), 9, "name"))
    taken: list[tuple[int, int, str]] = []
    for a, b, _, kind in sorted(found, key=lambda f: (f[2], f[0])):
        k = bisect(taken, (a,))
        if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b):
            taken.insert(k, (a, b, kind))
    return taken


def replace(text: str, key: bytes) -> tuple[str, list[tuple[str, str]], int]:
    """(text with surrogates, (kind, surrogate) of each entity in order, surrogates that are another's value)."""
    found = entities(text)
    if not found:
        return text, [], 0
    given = {(kind, text[a:b]): "" for a, b, kind in found}
    for kind, value in given:
        given[kind, value] = _surrogate(kind, value, key)
    shared = len(given) - len({(k, s) for (k, _), s in given.items()})
    real = {value for _, value in given}
    out, last, said = [], 0, []
    for a, b, kind in found:
        new = given[kind, text[a:b]]
        out += [text[last:a], new]
        said.append((kind, new))
        last = b
    return "".join(out) + text[last:], said, shared + sum(s in real for s in given.values())


SCHEMA = "doc_id long, text string, n_entities long, kinds string, surrogates array<string>, n_clashes long"


def surrogate_digest(docs: DataFrame, key: bytes) -> DataFrame:
    """A row for each row of docs (doc_id, text); see SCHEMA. kinds: kind:count, comma-joined."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for t in batch.column(1):
                t = t.as_py()
                new, said, clashes = (None, [], 0) if t is None else replace(t, key)
                counts = [(k, sum(s[0] == k for s in said)) for k in KINDS]
                rows.append((new, len(said), ",".join(f"{k}:{n}" for k, n in counts if n), [s[1] for s in said], clashes))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
