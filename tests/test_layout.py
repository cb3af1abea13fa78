"""Spaced letters, lists of references, glyph decoding."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from loomgraph.operators import glyphs, layout

LETTER = "[A-ZÁÉÍÓÚÑa-záéíóúñ]"


def test_spaced_letters_close_up(spark):
    cases = {"PA R T E 3 : A M E T R O P Í A S": "PARTE 3 : AMETROPÍAS", "B Á S I C O": "BÁSICO", "Capítulo 2. Fisiopatología y mecanismos": "Capítulo 2. Fisiopatología y mecanismos", "a b": "a b", "": ""}
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choices(["a", "B", " ", " ", "word", "1", "é"], k=14))
        out, at = "", 0
        for m in re.finditer(f"(?:{LETTER} ){{2,}}{LETTER}", text):
            glued = (m.start() > 0 and bool(re.match(LETTER, text[m.start() - 1]))) + (m.end() < len(text) and bool(re.match(LETTER, text[m.end()])))
            out += text[at : m.start()] + (m[0].replace(" ", "") if len(m[0].replace(" ", "")) - glued >= 2 else m[0])
            at = m.end()
        cases[text] = out + text[at:]
    rows = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    got = {r["t"]: r["d"] for r in rows.select("t", layout.despace(F.col("t")).alias("d")).collect()}
    assert got == {**cases, None: None}


def test_lists_of_references_take_their_heading_and_their_trailing_lines(spark):
    cite = "x CIT y CIT"
    text = ["body", "Referencias", "", "Author A.", *[cite] * 4, "", "DOI 1", "DOI 2", "after"]
    rows = [(1, "\n".join(text)), (2, "\n".join(["Referencias", "a", "b", "c", *[cite] * 5])), (3, "\n".join([cite] * 3)), (4, "\n".join([*[cite] * 4, "DOI 9"]))]
    runs = layout.reference_runs(spark.createDataFrame(rows, "doc_id long, text string"), "CIT", "^Referencias$", "^DOI")
    assert {tuple(r) for r in runs.collect()} == {(1, 1, 7), (2, 4, 8), (4, 0, 4)}
    rows = [(1, "\n".join(["Referencias", *[cite] * 4, "DOI 1", "DOI 2", "after", "DOI 3"]))]
    runs = layout.reference_runs(spark.createDataFrame(rows, "doc_id long, text string"), "CIT", "^Referencias$", "^DOI")
    assert {tuple(r) for r in runs.collect()} == {(1, 0, 6)}


WORDS = "river water valley stone bridge winter summer market village people letter answer number season corner garden window yellow silver simple little middle bottle travel follow before during always certain another between through history company country morning evening weather journey captain teacher student".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_a_shifted_font_is_decoded_and_sound_spans_stay(spark):
    rng = random.Random(3)
    sound = [(1, "F1", 1, i, prose(rng, 60)) for i in range(20)]
    plain = [prose(rng, 12) for _ in range(30)]
    shift = lambda t: "".join(c if c == " " else chr(ord(c) - 93) for c in t)
    broken = [(1, "F2", 2, i, shift(t)) for i, t in enumerate(plain)]
    few = [(1, "F3", 3, 0, shift("too little of it"))]
    out = glyphs.decode(spark.createDataFrame(sound + broken + few, "doc long, font string, page int, at int, text string")).collect()
    got = {(r["page"], r["at"]): (r["text"], r["decoded"]) for r in out}
    assert all(got[1, i] == (t, False) for _, _, _, i, t in sound)
    assert sum((got[2, i][0].lower(), got[2, i][1]) == (t, True) for i, t in enumerate(plain)) >= 28
    assert got[3, 0][1] is False and len(out) == 51


def test_a_substituted_font_is_solved_by_votes():
    rng = random.Random(5)
    letters = sorted(set("".join(WORDS)))
    codes = dict(zip(letters, [chr(c) for c in rng.sample(range(1, 31), len(letters))], strict=True))
    codes[" "] = "\x1f"
    texts = [prose(rng, 40) for _ in range(40)]
    s = glyphs.Solver(["".join(codes[c] for c in t) for t in texts], set(WORDS))
    told = s.solve()
    assert told["method"] == "substitution" and told["confidence"] >= 0.9
    right = [a == b for t in texts for a, b in zip(t.split(), s.decode("".join(codes[c] for c in t)).split(), strict=True)]
    assert sum(right) >= 0.9 * len(right)
    empty = glyphs.Solver(["\x01\x02"], set())
    assert empty.solve()["confidence"] == 0.0
