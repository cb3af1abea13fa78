"""Decoding of broken glyph maps: texts whose characters are codes of a font, shifted or substituted.

Spans are (doc, font, page, at, text). What is broken, how much of a span is words, and whether a decoded
span is better than it was are column expressions and joins with the document's lexicon, one row a word.
Only the table of a font is solved in Python, one (doc, font) group at a time, from its distinct words.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: which fonts and spans are decoded follows from exactly these ---
SHIFTS = range(-96, 129)
SHIFT_COVERAGE = 0.20
PRINTABLE = range(32, 127)
FONT_CHARACTERS = 500
VOTING_WORDS = 4000
UNKNOWN_CODES = 2
CANDIDATES = 40
ISOMORPHIC_CANDIDATES = 25
DOMINANCE, VOTES, ROUNDS = 1.4, 3.0, 10
CONFIDENCE, CONFIDENCE_WORDS = 0.50, 100
SPAN_GAIN = 0.20
BEFORE_SPACE, STARTS_WORD, SEEN = 0.85, 0.05, 30
# --- end of the fixed values ---

WORD = re.compile(r"[^\W\d_]{3,}")
BROKEN = r"[\x00-\x08\x0b\x0c\x0e-\x1f]|�|\(cid:\s?\d+\)"


def is_broken(text: Column) -> Column:
    """Control bytes, replacement characters or literal character ids."""
    return F.coalesce(text, F.lit("")).rlike(BROKEN)


def marks(text: Column) -> Column:
    """How many marks of broken decoding a text has: the cheap test before the costly pass."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(BROKEN))


def _space(c: str) -> bool:
    """Whether a character is white space and no code: below U+0020 everything may be a glyph."""
    return c >= " " and c.isspace()


def _coverage(text: str, lexicon: set[str]) -> float:
    """Share of the characters that lie in known words."""
    return sum(len(w) for w in WORD.findall(text) if w.lower() in lexicon) / len(text) if text else 0.0


def best_shift(text: str, lexicon: set[str]) -> tuple[float, int]:
    codes = {c for c in text if not _space(c)}
    scored = []
    for k in SHIFTS:
        if k:
            moved = text.translate({ord(c): chr(ord(c) + k) for c in codes if 0 < ord(c) + k < 0x1000})
            scored.append((_coverage(moved, lexicon), -len(scored), k))
    best = max(scored)
    return best[0], best[2]


class Solver:
    """The table of one font (code -> text), grown by votes of its words against a lexicon."""

    def __init__(self, texts: Iterable[str], lexicon: set[str]):
        self.texts = list(texts)
        self.lexicon = lexicon
        self.table: dict[str, str] = {}
        self.by_shape: dict[tuple, list[str]] = defaultdict(list)
        self.by_length: dict[int, list[str]] = defaultdict(list)
        for w in sorted(lexicon):
            self.by_shape[self.shape(w)].append(w)
            self.by_length[len(w)].append(w)

    @staticmethod
    def shape(word: str) -> tuple[int, ...]:
        """Where each letter first occurs: what a word and its cipher share."""
        return tuple(map(word.index, word))

    def separator(self) -> str | None:
        """The code of the space: the most frequent one that isn't known to be something else."""
        for c, _ in Counter("".join(self.texts)).most_common():
            if self.table.get(c, " ").isspace():
                return c
        return None

    def punctuation(self, gap: str | None) -> set[str]:
        """Codes that stand before a space and hardly ever start a word: marks, not letters."""
        n, closes, opens = Counter(), Counter(), Counter()
        cuts = lambda c: c is None or c == gap or _space(c)
        for t in self.texts:
            for before, c, after in zip([None, *t], t, [*t[1:], None], strict=False):
                if not cuts(c):
                    n[c] += 1
                    closes[c] += cuts(after)
                    opens[c] += cuts(before)
        return {c for c, k in n.items() if c not in self.table and k >= SEEN and closes[c] >= BEFORE_SPACE * k and opens[c] <= STARTS_WORD * k}

    def words(self, gap: str | None) -> Counter:
        """Cipher words of three or more codes, cut at what is known to be no letter."""
        ends = {gap} | {c for c, v in self.table.items() if not v.isalpha()}
        found: Counter = Counter()
        for t in self.texts:
            bare = "".join(" " if c in ends or _space(c) else c for c in t)
            found.update(w for w in bare.split(" ") if len(w) >= 3)
        return found

    def isomorphic_votes(self, words: Counter):
        for w, n in words.most_common(VOTING_WORDS):
            like = self.by_shape.get(self.shape(w), ())
            if 0 < len(like) <= ISOMORPHIC_CANDIDATES:
                for x in like:
                    yield from ((c, letter, n / len(like)) for c, letter in zip(w, x, strict=True))

    def fits(self, word: str, sizes: dict[str, int], candidate: str) -> dict[str, str] | None:
        """What the unknown codes stand for if the cipher word is this candidate, or None if it can't be."""
        at, said = 0, {}
        for c in word:
            want = self.table.get(c)
            piece = candidate[at : at + (len(want) if want is not None else sizes[c])]
            if want is not None and want.lower() != piece or want is None and said.setdefault(c, piece) != piece:
                return None
            at += len(piece)
        return said if at == len(candidate) else None

    def lexicon_votes(self, words: Counter):
        """Words with one or two unknown codes; a code may be one letter or two (a ligature)."""
        for w, n in words.most_common(VOTING_WORDS):
            unknown = [c for c in dict.fromkeys(w) if c not in self.table]
            if not 0 < len(unknown) <= UNKNOWN_CODES:
                continue
            fixed = sum(len(self.table[c]) for c in w if c in self.table)
            hits: list[dict[str, str]] = []
            for k in range(2 ** len(unknown)):
                sizes = {c: 1 + (k >> i & 1) for i, c in enumerate(unknown)}
                length = fixed + sum(sizes[c] for c in w if c in sizes)
                hits += [f for x in self.by_length.get(length, ()) if (f := self.fits(w, sizes, x)) is not None]
                if len(hits) > CANDIDATES:
                    break
            if 0 < len(hits) <= CANDIDATES:
                for f in hits:
                    yield from ((c, letters, n / len(hits)) for c, letters in f.items())

    def elect(self, votes) -> int:
        """Codes whose first choice has votes enough and is well ahead of the second enter the table."""
        count: dict[str, Counter] = defaultdict(Counter)
        for c, letters, weight in votes:
            count[c][letters] += weight
        new = {}
        for c, k in count.items():
            (first, most), *rest = sorted(k.items(), key=lambda x: (-x[1], x[0]))[:2]
            if c not in self.table and most >= VOTES and most >= DOMINANCE * (rest[0][1] if rest else 0):
                new[c] = first
        self.table |= new
        return len(new)

    def decode(self, text: str) -> str:
        return "".join(self.table.get(c, c) for c in text)

    def solve(self) -> dict:
        """method, shift, confidence, words; the table stays in the solver."""
        whole = " ".join(self.texts)
        score, k = best_shift(whole, self.lexicon)
        method, shift = ("shift", k) if score >= SHIFT_COVERAGE else ("substitution", None)
        if shift is not None:
            self.table = {c: chr(ord(c) + k) for c in set(whole) if not _space(c) and ord(c) + k in PRINTABLE}
        gap = self.separator()
        if gap is not None:
            self.table.setdefault(gap, " ")
        self.table |= dict.fromkeys(self.punctuation(gap), " ")
        if not any(v.isalpha() for v in self.table.values()):
            self.elect(self.isomorphic_votes(self.words(gap)))
        for _ in range(ROUNDS):
            if not self.elect(self.lexicon_votes(self.words(gap))):
                break
        said = [w.lower() for w in WORD.findall(self.decode(whole))]
        known = sum(w in self.lexicon for w in said)
        return {"method": method, "shift": shift, "confidence": round(known / len(said), 3) if said else 0.0, "words": len(said)}


TABLE = "doc {key}, font string, method string, shift int, confidence double, words int, codes map<string,string>"


def lexicon(spans: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """doc, word: of the sound spans of each document, and the common words (word) that every document gets."""
    sound = spans.filter(~is_broken(F.col("text")))
    own = sound.select("doc", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word")).distinct()
    if common is None:
        return own
    return own.union(spans.select("doc").distinct().join(F.broadcast(common.select("word")))).distinct()


def font_tables(spans: DataFrame, words: DataFrame) -> DataFrame:
    """One row for each font with broken text enough: see TABLE. Fonts below the confidence have a null map."""
    key = spans.schema["doc"].dataType.simpleString()
    broken = spans.filter(is_broken(F.col("text")))
    enough = broken.groupBy("doc", "font").agg(F.sum(F.length("text")).alias("n")).filter(F.col("n") >= FONT_CHARACTERS)
    texts = broken.join(enough.select("doc", "font"), ["doc", "font"], "left_semi").select("doc", "font", "page", "at", "text")
    needed = words.join(texts.select("doc").distinct(), "doc", "left_semi").select(F.col("doc").alias("_doc"), F.col("word").alias("word"))

    def one(spans_of, words_of):
        import pandas as pd

        known, rows = set(words_of["word"]), []
        for font, part in spans_of.sort_values(["page", "at"], kind="stable").groupby("font"):
            s = Solver(part["text"], known)
            told = s.solve()
            fine = told["confidence"] >= CONFIDENCE and told["words"] >= CONFIDENCE_WORDS
            rows.append((part["doc"].iloc[0], font, told["method"], told["shift"], told["confidence"], told["words"], s.table if fine else None))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in TABLE.split(", ")]).astype({"shift": "Int64"})

    return texts.groupBy("doc").cogroup(needed.groupBy("_doc")).applyInPandas(one, TABLE.format(key=key))


def _covered(spans: DataFrame, text: str, words: DataFrame, name: str) -> DataFrame:
    """doc, page, at, name: the share of text that lies in known words."""
    w = spans.select("doc", "page", "at", F.length(text).alias("n"), F.explode_outer(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word"))
    hit = w.join(words.withColumn("known", F.lit(True)), ["doc", "word"], "left")
    return hit.groupBy("doc", "page", "at").agg((F.coalesce(F.sum(F.when(F.col("known"), F.length("word"))), F.lit(0)) / F.greatest(F.max("n"), F.lit(1))).alias(name))


def decode(spans: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """spans with text decoded where its font was solved and the span gains by it, and decoded (boolean)."""
    words = lexicon(spans, common)
    tables = font_tables(spans, words).filter("codes is not null").select("doc", "font", "codes")
    tried = spans.filter(is_broken(F.col("text"))).join(tables, ["doc", "font"])
    new = F.array_join(F.transform(F.split("text", ""), lambda c: F.coalesce(F.try_element_at("codes", c), c)), "")
    tried = tried.select("doc", "page", "at", "text", new.alias("new"))
    gain = _covered(tried, "new", words, "after").join(_covered(tried, "text", words, "before"), ["doc", "page", "at"])
    better = tried.select("doc", "page", "at", "new").join(gain.filter(F.col("after") > F.col("before") + SPAN_GAIN), ["doc", "page", "at"])
    out = spans.join(better.select("doc", "page", "at", "new"), ["doc", "page", "at"], "left")
    return out.withColumn("decoded", F.col("new").isNotNull()).withColumn("text", F.coalesce("new", "text")).drop("new")
