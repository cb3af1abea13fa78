"""Hierarchical language identification: the language family first, then one-versus-one linear support
vector machines between the related languages within it.

Texts are lower-cased, everything but letters in the ASCII range becomes a space, and the 1- to 3-byte
grams of the whole UTF-8 text are counted in hashed buckets; the count vector has unit length. Machines
are trained from at most SAMPLE documents of each language (the lowest hashes of doc_id,
so a rerun picks the same), each also seen as two short excerpts, so that short texts are learned too.
Every language with a labelled document is learned. A language that FAMILIES doesn't list belongs to the
family of the script that most of its sample is written in. One machine is fitted for each pair of
families and of languages within one, on the executors if there are more than a few; more than MACHINES
of them (32 KB each, broadcast) are refused with an error. Predictions read the text alone, on the executors, in pieces, with memory bounded by PIECE.

Defined results: null text, or text without a letter: `und`, score 0. Without a labelled document
everything is `und`. A null doc_id is not held out and not learned from. Repeated rows are predicted
alike; an empty table gives an empty result; extra columns stay where the operator carries them.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import fresh, materialise, small_side


#: Documents of a language that the machines are trained on, at most.
SAMPLE = 300
#: Machines that are broadcast, at most: 256 MB. Beyond it training fails and says so; nothing is left out.
MACHINES = 8192
#: Machines that the driver fits itself.
HERE = 24
BUCKETS = 1 << 13
PIECE = 1 << 19
COST, EPOCHS = 10.0, 20
UNDETERMINED = "und"
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi ur bn pa gu mr ne si",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
    "celtic": "ga cy br gd",
    "baltic": "lt lv",
    "austronesian": "id ms tl jv",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_CLEAN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family(lang: str, script: str = "") -> str:
    """The family of a language tag; of an unlisted one, that of its script."""
    code = lang.strip().lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, f"script:{script}")


def script_of(text: str) -> str:
    """The script of most of the first letters of each word: the first word of their Unicode names."""
    names = Counter(unicodedata.name(w[0], "").split(" ")[0] for w in text.split() if w[0].isalpha())
    return max(sorted(names), key=names.get, default="")


def gram_counts(text: str) -> np.ndarray:
    """Counts of the text's hashed 1- to 3-byte grams."""
    out = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass").translate(_CLEAN), np.uint8)
    for at in range(0, len(raw), PIECE):
        b = np.empty(min(PIECE + 2, len(raw) - at) + 1, np.uint32)
        b[:-1] = raw[at : at + PIECE + 2]
        b[-1] = 32
        n = min(PIECE, len(raw) - at)
        one = b[:n]
        two = one << 8 | b[1 : n + 1]
        grams = [one + np.uint32(0x1000000), two + np.uint32(0x2000000)]
        if len(b) > 2:
            k = min(n, len(b) - 2)
            grams.append(two[:k] << 8 | b[2 : k + 2])
        for g in grams:
            out += np.bincount((g * np.uint32(2654435761)) >> np.uint32(32 - 13), minlength=BUCKETS)
    return out


def vector(text: str) -> np.ndarray:
    x = np.sqrt(gram_counts(text).astype(np.float32))
    norm = float(np.sqrt((x * x).sum()))
    return x / norm if norm else x


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def excerpts(text: str, seed: int) -> list[str]:
    """The text and two short runs of its words, at places that the seed gives."""
    words = text.split()
    out = [text]
    for k, width in enumerate((3, 12)):
        if len(words) > width:
            at = (seed * (2 * k + 1)) % (len(words) - width)
            out.append(" ".join(words[at : at + width]))
    return out


def fit_pair(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by dual coordinate descent. x: (buckets, values) of each row; y: +1 or -1."""
    w, bias, alpha = np.zeros(BUCKETS, np.float32), 0.0, np.zeros(len(y))
    diag = np.array([float(v @ v) for _, v in x]) + 1 + 0.5 / COST
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            at, v = x[i]
            grad = y[i] * (float(w[at] @ v) + bias) - 1 + alpha[i] * 0.5 / COST
            new = max(alpha[i] - grad / diag[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += np.float32(step) * v
                bias += step
                alpha[i] = new
    return w, bias


class OneVersusOne:
    """Votes of the machines of all pairs of classes; ties go to the larger sum of margins."""

    def __init__(self, labels: list[str], only: list[int]):
        """only: the rows of the sample that these classes are told apart on; labels of all rows."""
        self.classes = sorted({labels[i] for i in only})
        self.pairs = list(combinations(range(len(self.classes)), 2))
        rows: dict[str, list[int]] = {c: [] for c in self.classes}
        for i in only:
            rows[labels[i]].append(i)
        self.jobs = [(rows[self.classes[a]], rows[self.classes[b]]) for a, b in self.pairs]

    def hold(self, fits: list[tuple[np.ndarray, float]]) -> None:
        self.w = np.stack([w for w, _ in fits]) if fits else np.zeros((0, BUCKETS), np.float32)
        self.bias = np.array([b for _, b in fits])
        del self.jobs

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        margins = self.w @ x + self.bias
        votes, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), m in zip(self.pairs, margins, strict=True):
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        best = max(range(len(self.classes)), key=lambda k: (votes[k], sums[k], -k))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs, margins, strict=True) if best in (a, b)]
        return self.classes[best], float(1 / (1 + np.exp(-4 * min(own)))) if own else 1.0


def fit_job(x: list, job: tuple[list[int], list[int]]) -> tuple[np.ndarray, float]:
    at = sorted(job[0] + job[1])
    first = set(job[0])
    return fit_pair([x[i] for i in at], np.array([1.0 if i in first else -1.0 for i in at]))


def fit_all(spark: SparkSession | None, x: list, jobs: list) -> list[tuple[np.ndarray, float]]:
    """The machine of each job, in order; many of them are fitted by tasks that read the sample from a broadcast."""
    if spark is None or len(jobs) <= HERE:
        return [fit_job(x, j) for j in jobs]
    held = spark.sparkContext.broadcast((x, jobs))

    def run(batches):
        import pyarrow as pa

        sample, todo = held.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                w, bias = fit_job(sample, todo[k])
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([w.tobytes()]), pa.array([float(bias)])], names=["k", "w", "bias"])

    rows = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "k long, w binary, bias double").collect()
    held.unpersist()
    return [(np.frombuffer(r["w"], np.float32), r["bias"]) for r in sorted(rows, key=lambda r: r["k"])]


class LanguageModel:
    def __init__(self, x: list, langs: list[str], scripts: list[str] | None = None, spark: SparkSession | None = None, machines: int = MACHINES):
        seen: dict[str, Counter] = {}
        for lang, script in zip(langs, scripts or [""] * len(langs), strict=True):
            seen.setdefault(lang, Counter())[script] += 1
        main = {lang: max(sorted(c), key=c.get) for lang, c in seen.items()}
        kin = [family(c, main[c]) for c in langs]
        self.families = OneVersusOne(kin, list(range(len(kin)))) if langs else None
        self.within = {f: OneVersusOne(langs, [i for i, k in enumerate(kin) if k == f]) for f in sorted(set(kin))}
        every = [m for m in (self.families, *self.within.values()) if m]
        jobs = [j for m in every for j in m.jobs]
        if len(jobs) > machines:
            raise ValueError(f"{len(seen)} languages need {len(jobs)} machines, more than {machines}")
        fits = iter(fit_all(spark, x, jobs))
        for m in every:
            m.hold([next(fits) for _ in m.jobs])

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or self.families is None or not has_letter(text):
            return UNDETERMINED, 0.0
        x = vector(text)
        kin, sure = self.families.predict(x)
        lang, surer = self.within[kin].predict(x)
        return lang, min(sure, surer)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from docs (doc_id, text, lang): those with a lang and a doc_id that aren't held out."""
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    per = materialise(known.groupBy(F.col("lang").alias("_lang")).agg(F.least(F.lit(1 << 40), (F.lit(float((1 << 40) * (2 * sample + 50))) / F.count("*")).cast("long")).alias("_most")))
    spin = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 40))
    few = known.withColumn("spin", spin).join(small_side(per), F.col("lang") == F.col("_lang")).filter("spin <= _most")
    few = few.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("spin", "doc_id", F.xxhash64("text")))).filter(F.col("at") <= sample)

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            for text, lang, spin in zip(*(batch.column(i) for i in range(3)), strict=True):
                text = text.as_py()
                if not has_letter(text):
                    continue
                xs = [vector(t) for t in excerpts(text, spin.as_py()) if has_letter(t)]
                at = [np.flatnonzero(x) for x in xs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()] * len(xs)), pa.array([script_of(text)] * len(xs)), pa.array([spin.as_py()] * len(xs)), pa.array([a.astype(np.uint16).tobytes() for a in at]), pa.array([x[a].tobytes() for x, a in zip(xs, at, strict=True)])],
                    names=["lang", "script", "spin", "at", "x"],
                )

    rows = few.select("text", "lang", "spin").mapInArrow(features, "lang string, script string, spin long, at binary, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["spin"], bytes(r["at"]), bytes(r["x"])))
    x = [(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["x"], np.float32)) for r in rows]
    return LanguageModel(x, [r["lang"] for r in rows], [r["script"] for r in rows], docs.sparkSession)


def _predictor(model, text_at: int, rejects: bool, names: list[str]):
    def run(batches):
        import pyarrow as pa

        m = model.value
        for batch in batches:
            out = [m.predict(t.as_py()) for t in batch.column(text_at)]
            cols = [*batch.columns, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())]
            got = pa.RecordBatch.from_arrays(cols, names=names)
            yield got.filter(pa.array([o[0] != UNDETERMINED for o in out])) if rejects else got

    return run


def predict(docs: DataFrame, model: LanguageModel, pred: str = "lang_pred", score: str = "score", rejects: bool = False) -> DataFrame:
    """docs with two columns added. rejects: leave out what is undetermined."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(_predictor(shared, docs.columns.index("text"), rejects, schema.names), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text, lang)."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text"))
    return predict(rows, train(docs)).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without the rows whose language can't be told; a null lang is filled with the prediction."""
    pred, score = fresh(docs, "lang_pred", "lang_score")
    out = predict(docs, train(docs), pred, score, rejects=True)
    return out.withColumn("lang", F.coalesce("lang", pred)).drop(pred, score)
