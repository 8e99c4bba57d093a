"""Quality classifier: a convolutional network over bytes, in NumPy.

A text is its UTF-8 bytes, cut into chunks of CHUNK bytes that overlap by at least WIDTH - 1, so that every
window of WIDTH bytes lies in one; the last chunk is padded.  Every byte has a learned vector of EMBED
numbers; FILTERS learned filters look at windows of WIDTH bytes, STRIDE apart.  Of each filter the
largest response in a chunk counts (max-pooling).  The mean and the maximum of these over all chunks of
the text go into one logistic unit, whose output is the probability of label 1.

`fit` learns from at most PER_CLASS labelled rows of each label, those of smallest id hash, and of each of
them from at most TRAIN_CHUNKS chunks spread over the text; the logistic unit's constant is then
moved to the labels' share among all learnable rows.  Rows whose crc32(doc_id as text) mod 4 is 2 are held
out; rows without an id or a label are not learned from.  A row with several labels counts with each.  With
labels of one kind only, or none, scores are that label's (0.5).

`scored` reads whole texts.  Null and empty texts are one chunk of padding.  Repeated rows are scored each.
Columns of `docs` are carried along; `score` and `predicted` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.words import chunks, text_bytes

CHUNK, WIDTH, STRIDE = 512, 12, 2
EMBED, FILTERS = 4, 24
STEP = CHUNK - WIDTH - STRIDE
PAD = 256
PER_CLASS = 1000
TRAIN_CHUNKS = 6
EPOCHS, RATE, BATCH = 12, 0.01, 32
THRESHOLD = 0.7
TOGETHER = 512  # chunks that go through the filters at a time


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunk_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all chunks of texts of the given lengths: the text, and the first byte within it."""
    counts = 1 + np.maximum(0, -(-(lengths - CHUNK) // STEP))
    text = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return text, first * STEP


def cut(data: np.ndarray, offsets: np.ndarray, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The bytes of chunks, padded."""
    at = (offsets[text] + start)[:, None] + np.arange(CHUNK)
    inside = at < offsets[text + 1][:, None]
    if not len(data):
        return np.full(at.shape, PAD, dtype=np.int16)
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(PAD))


@dataclass
class Network:
    """The learned numbers."""

    vectors: np.ndarray  # of each byte value, and of padding (zeros)
    filters: np.ndarray
    bias: np.ndarray
    of_mean: np.ndarray
    of_most: np.ndarray
    constant: float

    @classmethod
    def fresh(cls, seed: int = 20260113) -> Network:
        draw = np.random.default_rng(seed)
        vectors = draw.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32)
        vectors[PAD] = 0
        filters = draw.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32)
        none = np.zeros(FILTERS, np.float32)
        return cls(vectors, filters, none.copy(), draw.normal(0, 0.3, FILTERS).astype(np.float32),
                   draw.normal(0, 0.3, FILTERS).astype(np.float32), 0.0)

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """(chunk, place, WIDTH * EMBED): the vectors under every filter place."""
        embedded = self.vectors[rows].reshape(len(rows), CHUNK * EMBED)
        return np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]

    def responses(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each chunk and filter the largest response and its place."""
        seen = self.windows(rows)
        all_places = np.ascontiguousarray(seen).reshape(-1, WIDTH * EMBED) @ self.filters
        all_places = all_places.reshape(len(rows), -1, FILTERS)
        place = all_places.argmax(axis=1)
        most = np.take_along_axis(all_places, place[:, None], axis=1)[:, 0]
        return most + self.bias, place

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The largest responses alone, none below zero."""
        seen = np.ascontiguousarray(self.windows(rows)).reshape(-1, WIDTH * EMBED) @ self.filters
        return np.maximum(0, seen.reshape(len(rows), -1, FILTERS).max(axis=1) + self.bias)

    def logits(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        return mean @ self.of_mean + most @ self.of_most + self.constant

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text, all its bytes read."""
        data, offsets = text_bytes(texts)
        text, start = chunk_starts(np.diff(offsets))
        total = np.zeros((len(texts), FILTERS), dtype=np.float64)
        most = np.zeros((len(texts), FILTERS), dtype=np.float32)
        for at in range(0, len(text), TOGETHER):
            own = text[at : at + TOGETHER]
            found = self.pooled(cut(data, offsets, own, start[at : at + TOGETHER]))
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total[own[first]] += np.add.reduceat(found, first, axis=0)
            most[own[first]] = np.maximum(most[own[first]], np.maximum.reduceat(found, first, axis=0))
        mean = total / np.bincount(text, minlength=len(texts))[:, None]
        return 1 / (1 + np.exp(-np.clip(self.logits(mean, most.astype(np.float64)), -60, 60)))


class _Adam:
    def __init__(self, values: list[np.ndarray], rate: float):
        self.values, self.rate, self.step = values, rate, 0
        self.mean = [np.zeros_like(v) for v in values]
        self.square = [np.zeros_like(v) for v in values]

    def take(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for value, mean, square, slope in zip(self.values, self.mean, self.square, slopes, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            way = mean / (1 - 0.9**self.step) / (np.sqrt(square / (1 - 0.999**self.step)) + 1e-8)
            value -= (self.rate * way).astype(value.dtype)


def train(rows: np.ndarray, text: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> Network:
    """A network for chunks `rows` of texts numbered `text` (ascending, without gaps) with 0/1 `labels`."""
    net = Network.fresh()
    constant = np.zeros(1, np.float32)
    adam = _Adam([net.vectors, net.filters, net.bias, net.of_mean, net.of_most, constant], rate)
    draw = np.random.default_rng(7)
    begins = np.searchsorted(text, np.arange(len(labels) + 1))
    weights = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            picks = [np.arange(begins[i], begins[i + 1]) for i in chosen]
            counts = np.array([len(p) for p in picks])
            own = rows[np.concatenate(picks)]
            doc = np.repeat(np.arange(len(chosen)), counts)
            first = np.cumsum(counts) - counts
            most, place = net.responses(own)
            seen = np.maximum(0, most)
            mean = np.add.reduceat(seen, first, axis=0) / counts[:, None]
            top = np.maximum.reduceat(seen, first, axis=0)
            p = 1 / (1 + np.exp(-np.clip(mean @ net.of_mean + top @ net.of_most + constant[0], -30, 30)))
            miss = ((p - labels[chosen]) * weights[chosen] / len(chosen)).astype(np.float32)
            # The maximum over chunks is shared by the chunks that reach it.
            reach = (seen == top[doc]) & (seen > 0)
            ties = np.maximum(1, np.add.reduceat(reach, first, axis=0, dtype=np.float32))
            slope = miss[doc][:, None] * (net.of_mean / counts[doc][:, None] + net.of_most * reach / ties[doc])
            slope = (slope * (most > 0)).astype(np.float32)
            under = np.take_along_axis(net.windows(own), place[:, :, None], axis=1)
            of_filters = np.einsum("bfk,bf->kf", under, slope)
            bytes_under = np.take_along_axis(own, (place[:, :, None] * STRIDE + np.arange(WIDTH)).reshape(len(own), -1), axis=1)
            back = net.filters.reshape(WIDTH, EMBED, FILTERS).transpose(2, 0, 1)[None] * slope[:, :, None, None]
            flat, back = bytes_under.ravel(), back.reshape(-1, EMBED)
            of_vectors = np.stack([np.bincount(flat, back[:, e], PAD + 1) for e in range(EMBED)], axis=1)
            of_vectors[PAD] = 0
            adam.take([of_vectors.astype(np.float32), of_filters, slope.sum(axis=0), miss @ mean, miss @ top,
                       np.array([miss.sum()], np.float32)])
    net.constant = float(constant[0])
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> tuple[list, dict[int, int]]:
    """(label, chunks) of the rows to learn from, and how many learnable rows each label has."""
    known = labels.select("doc_id", F.col(f"`{label}`").cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("doc_id")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    hashed = known.withColumn("place", F.xxhash64("doc_id"))
    ids = None
    for value in sorted(counts):
        part = hashed.where(F.col("label") == value).orderBy("place", "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    if ids is None:
        return [], counts
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "label")), "doc_id")  # 2 * per_class rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                data, offsets = text_bytes(part.column("text"))
                lengths = np.diff(offsets)
                text, start = chunk_starts(lengths)
                begins = np.searchsorted(text, np.arange(part.num_rows + 1))
                out = []
                for i in range(part.num_rows):
                    n = begins[i + 1] - begins[i]
                    picks = begins[i] + np.unique(np.linspace(0, n - 1, min(n, TRAIN_CHUNKS)).astype(np.int64))
                    out.append(cut(data, offsets, text[picks], start[picks]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(out, pa.binary())], names=["doc_id", "label", "chunks"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = chosen.select("doc_id", "label", "text").mapInArrow(run, f"doc_id {id_type}, label int, chunks binary")
    rows = sorted(found.collect(), key=lambda r: (r["doc_id"], r["label"], bytes(r["chunks"])))
    return [(r["label"], bytes(r["chunks"])) for r in rows], counts


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Network:
    rows, counts = sample(docs, labels, label, per_class)
    found = np.array([y for y, _ in rows], dtype=np.int64)
    if len(set(found.tolist())) < 2:
        net = Network.fresh()
        net.of_mean[:] = net.of_most[:] = 0
        net.constant = 0.0 if not len(found) else (30.0 if found[0] else -30.0)
        return net
    cut_rows = [np.frombuffer(c, dtype=np.int16).reshape(-1, CHUNK) for _, c in rows]
    text = np.repeat(np.arange(len(rows)), [len(c) for c in cut_rows])
    net = train(np.concatenate(cut_rows), text, found)
    net.constant += float(np.log(counts[1] / counts[0]))
    return net


def scored(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with `score` and `predicted` (1 where the score reaches the threshold)."""
    known = docs.sparkSession.sparkContext.broadcast(net)  # some thousand numbers
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                found = known.value.scores(part.column("text"))
                columns = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    rows = docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, StructType([*kept, StructField("score", DoubleType())]))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
