"""Language identification by sparse multinomial logistic regression.

Features are character n-grams (1 to 3 letters, case folded, everything that is
no letter counts as one gap), hashed to 2**14 places; a document's vector holds
(1 + log count) * idf, scaled to length one.

* *idf* counts every training document (a partial sum per task, then one
  aggregate over the 2**14 places).
* *Fit*: FTRL-proximal with L1 and L2 penalties, on a bounded sample: at
  most ``per_language`` training documents of each language, the first by MD5 of
  the doc_id, and at most ``SAMPLE_ROWS`` of all; the ``LANGUAGES`` most frequent
  languages are learned (ties by name).  The vectors of the sample are all the driver gets.
* *Calibration*: a fifth of the sample stays out of the fit and sets the
  temperature that minimises its log loss.

Training documents have a lang and a doc_id whose crc32 (as text) mod 4 is not 2;
a prediction reads the text alone.

Rules: null or letterless text is ``und`` with score 0; so is every text where
nothing can be learned; a null doc_id is held out; rows that repeat a doc_id are
predicted each, and the sample takes one text of a doc_id and language (the least);
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.tables import written
from tidemark.llm.words import mix

PLACES = 1 << 14
ORDERS = 3
SLICE_CHARS = 1 << 20
PER_LANGUAGE = 250
LANGUAGES = 512
SAMPLE_ROWS = 20_000          # also the bound of the broadcast sample ids
_U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(texts: list[str]):
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def feature_counts(texts: list[str]):
    """For each text its (places ascending, counts), both empty without letters."""
    for a, b in _slices(texts):
        some = [t.replace("\0", " ").lower() + " " for t in texts[a:b]]      # each text ends in its own gap
        codes = np.frombuffer("\0".join(some).encode("utf-32-le", "replace"), np.uint32)
        doc = np.cumsum(codes == 0) if len(some) > 1 else np.zeros(len(codes), np.int64)
        letter = _letters()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]                       # one gap after each run of letters
        codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
        doc = doc[keep]
        grams, h = [], np.zeros(len(codes), np.uint64)
        for k in range(ORDERS):
            n = max(len(codes) - k, 0)
            h = h[:n] * _U(0x100000001B3) + codes[k:] + _U(1)
            inside = doc[:n] == doc[k:]
            grams.append(((mix(h + _U(k)) & _U(PLACES - 1)).astype(np.int64)[inside], doc[:n][inside]))
        cuts = [np.searchsorted(d, np.arange(b - a + 1)) for _, d in grams]
        for i in range(b - a):
            own = np.concatenate([g[c[i]:c[i + 1]] for (g, _), c in zip(grams, cuts)])
            counts = np.bincount(own, minlength=PLACES) if any(map(str.isalpha, some[i])) else np.zeros(PLACES, np.int64)
            at = np.flatnonzero(counts)
            yield at, counts[at]


def vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _texts(batch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _document_counts(batches):
    df, n = np.zeros(PLACES, np.int64), 0
    for batch in batches:
        for at, _ in feature_counts(_texts(batch)):
            df[at] += 1
            n += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["place", "n"])


def _vectors(batches):
    for batch in batches:
        got = list(feature_counts(_texts(batch)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("turn"), pa.array([a for a, _ in got], pa.list_(pa.int64())), pa.array([c for _, c in got], pa.list_(pa.int64()))],
            names=["lang", "turn", "places", "counts"])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray       # (places, languages)
    bias: np.ndarray
    temperature: float

    def logits(self, at, counts) -> np.ndarray:
        return vector(at, counts, self.idf) @ self.weights[at] + self.bias

    def predict(self, at, counts) -> tuple[str, float]:
        if not len(at) or not self.languages:
            return "und", 0.0
        p = _softmax(self.logits(at, counts) / self.temperature)
        i = int(np.argmax(p))
        return self.languages[i], float(p[i])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.5, epochs: int = 6) -> Model:
    """FTRL-proximal over ``rows`` (language, places, counts), every fifth row kept for the temperature."""
    languages = sorted({r[0] for r in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    data = [(number[lang], at, vector(at, c, idf)) for lang, at, c in rows if len(at)]
    train = [r for i, r in enumerate(data) if i % 5] or data
    held = [r for i, r in enumerate(data) if not i % 5] or data
    k = len(languages)
    z, n = np.zeros((PLACES + 1, k)), np.zeros((PLACES + 1, k))          # the last row is the bias, unpenalised by L1

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - np.where(np.asarray(i) == PLACES, 0.0, l1)[:, None], 0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs if k else 0):
        for y, at, x in train:
            i, v = np.append(at, PLACES), np.append(x, 1.0)
            w = weights(i)
            p = _softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(PLACES + 1))
    model = Model(languages, idf, w[:-1].astype(np.float32), w[-1].astype(np.float32), 1.0)
    scores = [(y, vector_logits) for y, at, x in held for vector_logits in [x @ model.weights[at] + model.bias]]

    def loss(t):
        return -sum(np.log(max(_softmax(s / t)[y], 1e-300)) for y, s in scores)

    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    model.temperature = float(min(grid, key=loss)) if scores else 1.0
    return model


def _in_sample(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & ~F.col("held_out"))


def _read(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return docs.withColumn("held_out", F.coalesce(held, F.lit(True)))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the training documents of ``docs`` (doc_id, text, lang)."""
    train = _in_sample(_read(docs))
    sums = train.select("text").mapInArrow(_document_counts, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df, total = np.zeros(PLACES), 0
    for r in sums.collect():                               # at most 2**14 + 1 rows
        if r["place"] < 0:
            total = r["n"]
        else:
            df[r["place"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1
    langs = [r["lang"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    train = train.where(F.col("lang").isin(langs))
    most = max(1, min(per_language, SAMPLE_ROWS // max(len(langs), 1)))
    # row_number <= k plans as a partial limit per task: a frequent language is cut before the exchange
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = written(train.select("lang", "doc_id", F.md5(F.col("doc_id").cast("string")).alias("order"))
                     .withColumn("turn", turn).where(F.col("turn") <= most).select("lang", "doc_id", "turn"), "sample")
    side = F.broadcast(chosen.groupBy("lang", "doc_id").agg(F.min("turn").alias("turn")))     # SAMPLE_ROWS rows at most
    rows = train.join(side, ["lang", "doc_id"]).groupBy("lang", "doc_id", "turn").agg(F.min("text").alias("text")).select("lang", "turn", "text") \
        .mapInArrow(_vectors, "lang string, turn int, places array<long>, counts array<long>").collect()
    rows.sort(key=lambda r: (r["turn"], r["lang"], r["places"]))
    return fit([(r["lang"], np.array(r["places"], np.int64), np.array(r["counts"], np.int64)) for r in rows], idf)


def _predict(model: Model, keep: list[str]):
    def run(batches):
        for batch in batches:
            got = [model.predict(at, c) for at, c in feature_counts(_texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    return run


def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text, ...) with lang_pred and score; all columns stay, one named like an output is replaced."""
    docs = docs.drop(*[c for c in ("lang_pred", "score") if c in docs.columns]).withColumn("text", F.col("text").cast("string"))
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(_predict(model, docs.columns), schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang)."""
    model = learn(docs, per_language)
    return _read(docs).select("doc_id", "held_out", "text") \
        .mapInArrow(_predict(model, ["doc_id", "held_out"]), "doc_id long, held_out boolean, lang_pred string, score double")
