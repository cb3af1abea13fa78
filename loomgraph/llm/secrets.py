"""Secret scans: three base patterns, and a token-efficiency test for random strings.

A random string takes more tokens of a byte-pair vocabulary for its length than text does. Runs of 16 or
more of `[A-Za-z0-9+/_=-]` that hold a letter are encoded with a tiktoken vocabulary; those with
under RATIO characters a token are reported as `random`, unless they are a known digest form (32, 40, 56, 64, 96 or 128
hexadecimal digits), a UUID, a number, a path or an identifier made of words. If a run isn't reported, its segments between
`/`, `=`, `_` and `-` are tested alike. Base spans always stay.

Texts are read whole, one at a time. Defined results: a null or empty text has no spans (base_sha256 is
that of the empty string); repeated rows give equal rows; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RATIO, LEAST = 2.0, 16
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_WORDS = re.compile(r"(?:[/_=+-]++|[A-Z]{3,}+|[A-Z]?[a-z]{3,}+|\d++)++\Z")
_LETTER = re.compile(r"[A-Za-z]")
SEGMENT = re.compile(rf"[A-Za-z0-9+]{{{LEAST},}}")
KINDS = ("assign", "access", "hex")
_encoders: dict[str, object] = {}


def encoder(path: str):
    """The tiktoken encoding of a vocabulary file, loaded once by worker."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def known_form(run: str) -> bool:
    """Digests and identifiers, which are no secrets."""
    if _DIGEST.match(run) and len(run) in (32, 40, 56, 64, 96, 128):
        return True
    return bool(_UUID.match(run) or _WORDS.match(run))


def random_spans(text: str, bpe, ratio: float = RATIO) -> list[tuple[int, int, str]]:
    def is_random(run):
        return _LETTER.search(run) and not known_form(run) and len(run) < ratio * len(bpe.encode_ordinary(run))

    out = []
    for m in CANDIDATE.finditer(text):
        if is_random(m[0]):
            out.append((m.start(), m.end(), "random"))
        elif not known_form(m[0]):
            out += [(s.start(), s.end(), "random") for s in SEGMENT.finditer(text, m.start(), m.end()) if s[0] != m[0] and is_random(s[0])]
    return out


def _written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan_text(text: str | None, bpe, ratio: float = RATIO) -> tuple:
    text = text or ""
    base = base_spans(text)
    more = random_spans(text, bpe, ratio)
    every = sorted(base + more, key=lambda s: (s[0], (*KINDS, "random").index(s[2])))
    counts = [sum(s[2] == k for s in base) for k in KINDS]
    return (*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(every), len(more))


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """A row for each row of docs (doc_id, text); see SCHEMA. spans: kind:start:end, in code points."""

    def run(batches):
        import pyarrow as pa

        bpe = encoder(vocabulary)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            rows = [scan_text(t.as_py(), bpe, ratio) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
