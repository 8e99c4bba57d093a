"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the character n-grams (1 to 3 characters) of the lower-cased text, ASCII other than
letters counting as space, hashed into BUCKETS; a document is its counts times the inverse
document frequency, at length 1.  Weights are learned by follow-the-regularised-leader
with elastic-net penalties, which leaves most of them at zero; then one temperature is fitted on
rows kept back, so that scores are probabilities.

Document frequencies are counted over all learnable rows.  The weights are fitted on a bounded
sample: the rows of smallest id hash, about PER_LANGUAGE of a language and at most SAMPLE_DOCS in all.  Where
the languages together would exceed that, the larger ones get an equal share of it and the smaller ones all
they have, so none is starved.  The SAMPLE_DOCS / 2 most frequent languages can be learned.  A
fifth of the sample fits the temperature.  Rows whose crc32(doc_id as text) mod 4 is 2 are held out
of all this; rows without an id or a language are not learned from.  Language, source and
id are no inputs of a prediction.

Null texts and texts without a letter are `und` with score 0, as is everything if there
is nothing to learn from.  Whole texts are read.  Repeated rows are counted and predicted each.
Other columns, whatever their names, are carried along by `identify`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.arrays import summed_arrays
from snapfold.llm.words import chunks

BUCKETS = 1 << 16
PER_LANGUAGE = 600
SAMPLE_DOCS = 12_000
UNKNOWN = "und"
ORDERS = (1, 2, 3)

_KEYS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
_FOLD = np.arange(0x80, dtype=np.uint32)
_FOLD[[c for c in range(0x80) if not chr(c).isalpha()]] = 0x20
_letter = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _letter.finditer(text))


def text_features(texts: list[str]) -> Iterator[np.ndarray]:
    """Of each text the counts of its n-grams by bucket."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    plain = codes < 0x80
    codes[plain] = _FOLD[codes[plain]]
    hashes = []
    for order in ORDERS:
        size = max(0, len(codes) - order + 1)
        h = np.full(size, order, dtype=np.uint32)
        for k in range(order):
            h = (h ^ codes[k : k + size]) * _KEYS[k]
            h ^= h >> np.uint32(15)
        hashes.append(((h * np.uint32(2654435769)) >> np.uint32(16)).astype(np.int64))
    at = 0
    for text in lowered:
        end = at + len(text)
        own = [h[at : max(at, end - order + 1)] for order, h in zip(ORDERS, hashes, strict=True)]
        yield np.bincount(np.concatenate(own), minlength=BUCKETS)
        at = end


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the document's vector, of length 1 unless it is empty."""
    at = np.flatnonzero(counts)
    values = counts[at] * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""

    def count(part: pa.RecordBatch, total: np.ndarray) -> None:
        for counts in text_features(part.column("text").to_pylist()):
            total[:-1] += counts > 0
            total[-1] += 1

    total = summed_arrays(texts, count, BUCKETS + 1)
    return total[:-1], int(total[-1])


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = 1.0, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.02, epochs: int = 4, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x classes) and biases by follow-the-regularised-leader, elastic net."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, values, label = examples[i]
            at, values = np.append(at, BUCKETS), np.append(values, 1.0)  # the bias
            zi, ni = z[at], n[at]
            w = weights(zi, ni, l1)
            gradient = softmax(values @ w)
            gradient[label] -= 1.0
            g = values[:, None] * gradient
            squared = ni + g * g
            z[at] = zi + g - (np.sqrt(squared) - np.sqrt(ni)) / alpha * w
            n[at] = squared
    w = weights(z, n, l1)
    return w[:-1], w[-1]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def quotas(sizes: dict[str, int], per_language: int, sample_docs: int) -> dict[str, int]:
    """How many rows to draw of each language: the least of its size, `per_language`, and a level at which all fit."""
    out, left = {}, sample_docs
    for at, (name, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[name] = min(size, per_language, max(1, left // (len(sizes) - at)))
        left -= out[name]
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [t if t is not None and self.languages and has_letter(t) else "" for t in texts]
        names, scores = [], []
        for text, counts in zip(known, text_features(known), strict=True):
            if not text:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            at, values = tf_idf(counts, self.idf)
            p = softmax((values @ self.weights[at] + self.bias) / self.temperature)
            names.append(self.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Learn from the rows of `docs` (doc_id, text, lang) that are not held out."""
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
             .limit(max(1, sample_docs // 2)).collect()}
    frequencies, total = document_frequencies(rows.select("text"))
    idf = np.log((1.0 + total) / (1.0 + frequencies)) + 1.0
    if not sizes:
        return LanguageModel((), idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    # A row is drawn if its hash falls below its language's share.  Chance may draw a few more than the
    # bound; the limit takes them from all languages alike, by their place within the share.
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    quota = quotas(sizes, per_language, sample_docs)
    share = F.create_map(*[F.lit(x) for name, size in sizes.items() for x in (name, quota[name] / size)])[F.col("lang")]
    drawn = rows.select("doc_id", "text", "lang", place.alias("place")).where(F.col("place") < share)
    drawn = drawn.orderBy(F.col("place") / share, "doc_id", "text", "lang").limit(sample_docs).select("text", "lang", "place")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = [tf_idf(c, idf) for c in text_features(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("place"),
                     pa.array([a.astype("<u2").tobytes() for a, _ in found], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                    names=["lang", "place", "at", "values"],
                )

    sample = drawn.mapInArrow(vectors, "lang string, place double, at binary, values binary").collect()
    sample.sort(key=lambda r: (r["place"], r["lang"], bytes(r["at"]), bytes(r["values"])))
    languages = tuple(sorted({r["lang"] for r in sample}))
    number = {name: i for i, name in enumerate(languages)}
    examples = [
        (np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float), number[r["lang"]])
        for r in sample
    ]
    kept_back, used = examples[::5], [x for i, x in enumerate(examples) if i % 5] or examples
    weights, bias = ftrl(used, len(languages))
    logits = np.array([v @ weights[a] + bias for a, v, _ in kept_back])
    labels = np.array([label for _, _, label in kept_back])
    return LanguageModel(languages, idf, weights, bias, fit_temperature(logits, labels))


def identify(docs: DataFrame, model: LanguageModel, name: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the predicted language and its score; columns of those names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages, whatever the table's size
    others = [c for c in docs.columns if c not in (name, score)]
    rows = docs.select(*[f"`{c}`" for c in others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                names, scores = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, name, score],
                )

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*rows.schema.fields]).add(name, StringType()).add(score, DoubleType())
    return rows.mapInArrow(run, schema)
