"""Line dedup and source mixing against plain Python."""

import hashlib
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from snapfold.llm import linededup, mixing
from tests.llm.fixtures import ROWS, clashing, documents, words

WHITE = " \t\n\x0b\f\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_dedup(rows):
    holder = {}
    key = lambda line: line.strip(WHITE).translate(LOWER)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holder[key(line)] = min(doc, holder.get(key(line), doc))
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if holder.get(key(x), doc) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


MANY = [(i, "\n".join([f"common line number {i % 3}", f"own line of {i}", f"Pair line {i // 2}   ", "short", "common line for all"]),
         "en", "a", 1) for i in range(100, 160)]


@pytest.mark.parametrize("batches,fan", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(spark, batches, fan):
    rows = ROWS + MANY
    got = linededup.dedup_lines(clashing(documents(spark, rows)), batches=batches, fan=fan)
    assert set(documents(spark).columns) < set(got.columns)
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in got.collect()}
    assert found == plain_dedup([r[:2] for r in rows])


def test_line_dedup_of_odd_tables(spark):
    assert linededup.dedup_lines(documents(spark, [])).collect() == []
    rows = [(None, "a line of some length", None, None, None), (1, "a line of some length", None, None, None),
            (1, "a line of some length", None, None, None), (2, "a line of some length\nx", None, None, None)]
    got = sorted((str(r.doc_id), r.text) for r in linededup.dedup_lines(documents(spark, rows)).collect())
    line = "a line of some length"
    assert got == [("1", line), ("1", line), ("2", "x"), ("None", line)]


def test_runs_compact_and_remember(spark):
    runs = linededup.LineRuns(spark, fan=2)
    seen = set()
    for at in range(5):
        rows = [(at * 10 + i, f"line {i} of batch {at}\nline {i} of every batch", None, None, None) for i in range(3)]
        keys = linededup.line_keys(documents(spark, rows)).cache()
        gone = {tuple(r) for r in runs.add(keys).collect()}
        assert gone == ({(at * 10 + i, 1) for i in range(3)} if at else set())
        seen.add(sum(spark.table(r).count() for r in runs.runs()))
        assert all(len(level) < 2 for level in runs.levels)
    assert len(runs.runs()) == 2 and max(seen) == 3 + 15  # 5 batches: one run of 4, one of 1
    assert runs.add(linededup.line_keys(documents(spark, []))).collect() == []
    runs.close()


def test_runs_are_joined_without_shuffling_them(spark):
    runs = linededup.LineRuns(spark, fan=2)
    keys = linededup.line_keys(documents(spark)).cache()
    runs.add(keys)
    joined = keys.select("h1", "h2").repartition(runs.buckets, "h1", "h2").join(
        spark.table(runs.runs()[0]).hint("merge"), ["h1", "h2"], "left_anti"
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    runs.close()


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
        if not free:
            return target


@pytest.mark.parametrize("sizes", [[20, 19, 18, 17], [5], [1, 100, 1, 100, 1, 100], [0, 0, 7], [50, 3, 3, 900, 2, 2, 2], [9] * 12])
def test_targets(spark, sizes):
    names = [f"s{i:02}" for i in range(len(sizes) - 1)] + [None]
    rows = [(i, "w " * n, "en", s, 1) for i, (s, n) in enumerate(zip(names, sizes, strict=True))]
    frame = documents(spark, rows).withColumn("size", F.size(F.split("text", " ")) - 1)
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(plain_targets(dict(zip(names, map(float, sizes), strict=True))))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes))


@pytest.mark.parametrize("slot_rows", [1, 5, 2000])
def test_mixing(spark, slot_rows):
    rows = ROWS + [(i, "word " * (i % 17), "en", "src%d" % (i % 5 if i % 3 else 0), 1) for i in range(200, 400)]
    got = mixing.mixed_amounts(clashing(documents(spark, rows)), slot_rows=slot_rows).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target, taken = plain_targets(sizes), defaultdict(int)
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    for r in got:
        assert r["size"] == len(words(dict((x[0], x[1]) for x in rows)[r.doc_id]))
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixed_amounts(documents(spark, rows), slot_rows=9).collect()))


@pytest.mark.parametrize("range_rows", [3, 10**6])
def test_ranges_of_the_queue_do_not_change_the_mix(spark, range_rows):
    rows = [(i, "word " * (1 + i % 23), "en", "src%d" % (i % 4), 1) for i in range(150)] + [(900, "long " * 5000, "en", "src1", 1)]
    got = mixing.mixed_amounts(documents(spark, rows), range_rows=range_rows, slot_rows=7).collect()
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[r.source] - r.target) <= 1 for r in got)
    queue = mixing.fair_queue(documents(spark, rows), range_rows=range_rows).collect()
    # Everything before time 1 is given whole, nothing behind it.
    assert all(r.taken == r["size"] for r in queue if r.finish < 1) and not any(r.taken for r in queue if r.finish > 1)


def test_the_queue_is_sorted_by_range(spark, monkeypatch):
    plans = []

    def kept(rows, name):
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return rows

    monkeypatch.setattr(mixing, "staged", kept)
    mixing.mixed_amounts(documents(spark), range_rows=3)
    assert "rangepartitioning(finish" in dict(plans)["mixing-queue"]


def test_repeated_rows_are_documents_of_their_own(spark):
    rows = [(1, "a b c d", "en", "s", 1)] * 3 + [(2, "a b c d e f", "en", "t", 1)]
    got = sorted((r.doc_id, r["size"], r.taken) for r in mixing.mixed_amounts(documents(spark, rows)).collect())
    assert [g[:2] for g in got] == [(1, 4)] * 3 + [(2, 6)]
    assert all(taken <= 2 * size for _, size, taken in got) and sum(g[2] for g in got) == 27
    assert got == sorted((r.doc_id, r["size"], r.taken) for r in mixing.mixed_amounts(documents(spark, rows)).collect())


def test_mixture_serves_whole_documents_in_order(spark):
    rows = [(i, "word " * 10, "en", "a" if i < 30 else "b", 1) for i in range(60)]
    docs = clashing(documents(spark, rows))
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns
    served = [r.source for r in mix.collect()]
    # a: 5/7 of 90 documents is above twice its 30, so 60; b: the remaining 30.
    assert served.count("a") == 60 and served.count("b") == 30
    for at in range(9, 90, 9):  # proportions hold at any moment
        assert abs(served[:at].count("a") - at * 2 / 3) <= 2


def test_mixing_of_odd_tables(spark):
    assert mixing.mixed_amounts(documents(spark, [])).collect() == []
    nothing = [(1, None, None, None, None), (2, "", None, "a", None)]
    assert {(r.doc_id, r.taken, r.target) for r in mixing.mixed_amounts(documents(spark, nothing)).collect()} == {
        (1, 0, 0.0), (2, 0, 0.0)
    }
    assert mixing.mixture(documents(spark, [])).collect() == []


def test_the_shuffle_key_is_fixed(spark):
    key = mixing.shuffle_key(F.lit(5).cast("long"), F.lit(1), 7)
    assert spark.range(1).select(key).first()[0] == hashlib.md5(b"7:1:5").hexdigest()
