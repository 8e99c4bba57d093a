"""The byte network: coverage of texts, gradients, edge cases, and held-out accuracy."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapfold.llm import convnet

from .fixtures import ROWS, clashing, documents


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_every_window_lies_in_a_chunk():
    for n in [0, 1, 5, 511, 512, 513, 1009, 1010, 1011, 5000]:
        text, start = convnet.chunk_starts(np.array([n]))
        covered = set()
        for s in start:
            covered |= set(range(s, min(n, s + convnet.CHUNK)))
            assert s % convnet.STRIDE == 0
        assert covered == set(range(n)) and set(text) == {0}
        gaps = np.diff(start)
        assert (convnet.CHUNK - gaps >= convnet.WIDTH - 1).all()


def test_scores_do_not_depend_on_how_texts_are_dealt():
    net = convnet.Network.fresh()
    texts = ["", "a", "x" * 3000, "word " * 2000, "ß" * 700]
    together = net.scores(pa.array(texts))
    alone = np.concatenate([net.scores(pa.array([t])) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    # The end of a long text counts.
    assert net.scores(pa.array(["a" * 9000 + "#*#*#*#*#*#*#*"]))[0] != pytest.approx(net.scores(pa.array(["a" * 9014]))[0], abs=1e-9)


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    rows = draw.integers(0, 256, (6, convnet.CHUNK)).astype(np.int16)
    text, found = np.array([0, 0, 1, 2, 2, 2]), np.array([1, 0, 1])

    def loss(net):
        pooled = net.pooled(rows).astype(np.float64)
        z = np.array([net.logits(pooled[text == i].mean(0), pooled[text == i].max(0)) for i in range(3)])
        p = 1 / (1 + np.exp(-z))
        weights = np.where(found == 1, 0.5 / 2, 0.5) * 3
        return -(weights * (found * np.log(p) + (1 - found) * np.log(1 - p))).mean()

    net = convnet.Network.fresh()
    caught = {}

    class Catch(convnet._Adam):
        def take(self, slopes):
            caught.update(zip(("vectors", "filters", "bias", "of_mean", "of_most", "constant"), slopes))

    adam = convnet._Adam
    convnet._Adam = Catch
    try:
        convnet.train(rows, text, found, epochs=1)
    finally:
        convnet._Adam = adam
    for name, index in (("filters", (5, 3)), ("filters", (20, 7)), ("of_mean", (2,)), ("of_most", (4,)), ("bias", (1,)), ("vectors", (65, 1))):
        step = 1e-3
        values = getattr(net, name)
        values[index] += step
        up = loss(net)
        values[index] -= 2 * step
        down = loss(net)
        values[index] += step
        assert caught[name][index] == pytest.approx((up - down) / (2 * step), rel=0.1, abs=2e-4)


def test_hostile_tables(spark):
    net = convnet.Network.fresh()
    docs = clashing(documents(spark, ROWS + ROWS[:3]))
    out = convnet.scored(docs, net)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    found = out.collect()
    assert len(found) == len(ROWS) + 3
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[2] == by_id[3] and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.7) for r in found)
    assert convnet.scored(documents(spark, []), net).count() == 0


def test_labels_of_one_kind_and_none(spark):
    docs = documents(spark)
    for rows, score in ([], 0.5), ([(0, 1, 0), (1, 1, 0), (5, 1, 0)], 1.0), ([(0, 0, 0), (1, 0, 0), (None, 1, 0), (4, None, 0)], 0.0):
        found = convnet.scored(docs, convnet.fit(docs, labels(spark, rows))).collect()
        assert {round(r.score, 6) for r in found} == {score}


def test_held_out_rows_and_labels_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    changed = known.withColumn("quality", F.when(convnet.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, _ = convnet.sample(docs, known, per_class=10)
    b, _ = convnet.sample(docs, changed, per_class=10)
    assert a == b


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = convnet.fit(docs.select("doc_id", "text"), known)
    found = convnet.scored(docs.select("doc_id", "text"), net).where(convnet.held_out(F.col("doc_id")))
    rows = found.join(known, "doc_id").select("quality", "predicted").collect()
    right = sum(r.quality == r.predicted for r in rows) / len(rows)
    caught = [r.predicted == 0 for r in rows if r.quality == 0]
    kept = [r.predicted == 1 for r in rows if r.quality == 1]
    assert right >= 0.93 and sum(kept) >= 0.95 * len(kept) and sum(caught) >= 0.7 * len(caught)
