"""The pipeline against a brute-force version, and its place in the driver's contract."""

import random
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from snapfold.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect
from tests.llm.fixtures import words
from tests.llm.test_duplicates import plain_classes
from tests.llm.test_lines_mixing import plain_dedup, plain_targets
from tests.llm.test_tokens import check_pieces

ROOT = Path(corpus_pipeline.__file__).parent


def small_corpus():
    rng = random.Random(4)
    english, german = "the of and to in that it was for on with as his they".split(), "der die und das nicht ein ist von sich mit dem auf".split()
    rows = []
    for i in range(120):
        lang, vocabulary = ("en", english) if i % 3 else ("de", german)
        text = "\n".join(" ".join(rng.choice(vocabulary) + rng.choice(["", "er", "ing" if lang == "en" else "ung"]) for _ in range(rng.randint(5, 40))) for _ in range(3))
        rows.append([i, text, lang, f"s{i % 4}", len(text)])
    rows[50][1] = rows[7][1]  # an exact copy
    rows[8][1] = " ".join(rng.choice(english) + str(i) for i in range(60))
    rows[60][1] = rows[8][1] + " with"  # a near copy, of one line
    rows[70][1] = "A line that two of them have\n" + rows[70][1]
    rows[71][1] += "\n a line that TWO of them have "
    rows[80][1], rows[81][1], rows[82][1] = None, "", "1234 5678 !!"
    return [tuple(r) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(small_corpus(), SCHEMA).repartition(2).write.parquet(str(folder / "documents.parquet"))
    docs, out = spark.read.parquet(str(folder / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, docs.columns, [tuple(r) for r in docs.collect()] if name != "packing" else docs.collect()))
    return folder, out


def test_stages(spark, stages):
    _, out = stages
    rows = {r[0]: r for r in small_corpus()}
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [name for name, _, _ in out] == [name for name, _ in corpus_pipeline.STAGES]
    assert all(c == columns for _, c, _ in out[:-1])
    # Language: what has no letter goes, nothing else.
    assert sorted(out[0][2]) == sorted(r for r in rows.values() if r[0] not in (80, 81, 82))
    # Lines.
    want = plain_dedup([r[:2] for r in out[0][2]])
    assert {r[0]: r[1] for r in out[1][2]} == {d: text for d, (_, _, text) in want.items()}
    assert all(r[4] == len(r[1]) for r in out[1][2])
    # Near duplicates.
    classes = plain_classes(out[1][2], 5, 80)
    assert sorted(out[2][2]) == sorted(r for r in out[1][2] if classes[r[0]][1] == r[0])
    assert next(r[1] for r in out[1][2] if r[0] == 50) == "" and 60 not in {r[0] for r in out[2][2]}
    # Mixing: whole documents, each at most twice, sources within half a document of their targets.
    before, after, largest = defaultdict(int), defaultdict(int), 0
    for r in out[2][2]:
        before[r[3]] += len(words(r[1]))
        largest = max(largest, len(words(r[1])))
    times = defaultdict(int)
    for r in out[3][2]:
        assert r in set(out[2][2])
        times[r[0]] += 1
        after[r[3]] += len(words(r[1]))
    assert max(times.values()) <= 2
    for source, target in plain_targets(before).items():
        assert abs(after[source] - target) <= largest / 2 + 1
    # Packing: every copy's ids lie in pieces, gapless.
    total = defaultdict(int)
    for p in out[4][2]:
        total[p.doc_id] += p.length
    distinct = [r for r in {r[0]: r for r in out[3][2]}.values()]
    sizes = {p.doc_id: p.doc_tokens for p in out[4][2]}
    assert {r[0]: times[r[0]] * sizes[r[0]] for r in distinct} == dict(total)
    offsets = defaultdict(list)
    for p in out[4][2]:
        offsets[p.sequence_id].append((p.offset, p.length))
    for parts in offsets.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()]


def test_packing_stage_on_single_documents(spark, stages):
    rows = [r for r in {r[0]: r for r in stages[1][2][2]}.values()]
    docs = spark.createDataFrame(rows, SCHEMA)
    check_pieces(corpus_pipeline.sequence_packing(spark, docs, "").collect(), rows, 2048)


def test_run_applies_all_stages(spark, stages):
    folder, out = stages
    assert corpus_pipeline.run(spark, str(folder)).count() == len(out[4][2])
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.collect() == [] and docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").collect() == []


def test_one_query_per_operator():
    for n in range(1, 11):
        assert len([q for q in queries() if q.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None


def test_nothing_else_imports_the_package():
    code = (
        "import sys; sys.path.insert(0, sys.argv[1]); sys.modules['snapfold.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) > 30"
    )
    subprocess.run([sys.executable, "-c", code, str(ROOT)], check=True)
