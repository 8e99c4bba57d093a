"""The manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from snapfold.llm import merkle
from snapfold.llm.textcols import lower_ascii

from .fixtures import ROWS, clashing, documents

MANY = [(i, f"Text {i}", "aa", "s", i) for i in range(1, 1301)]
FEW = [(5000 + i, f"T{i}", "zz", None, None) for i in range(9)] + [(6000, "X", "Ω", "s", 1), (6001, None, None, None, None)]
TIED = [(7, "b", "aa", "s", 1), (7, "a", "aa", "s", 1), (7, "a", "aa", "s", 1), (None, "n", "aa", "s", 1)]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(doc_id, text, lang, source, n_chars):
    return h(*map(value, (doc_id, source, lang, n_chars, text)))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The last node, and of every node its path: the runs it lies in and its place in each."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for path, i in zip(paths, at):
            path.append((runs[i // 8], i % 8))
        at = [i // 8 for i in at]
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def expected(rows):
    found = {}
    for row in rows:
        found.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    languages = sorted(found, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: climb([r[2] for r in sorted(found[x], key=lambda r: r[:3])]) for x in languages}
    root, tops = climb([trees[x][0] for x in languages])
    out = []
    for x, top in zip(languages, tops):
        subroot, paths = trees[x]
        for (_, _, own, row), path in zip(sorted(found[x], key=lambda r: r[:3]), paths, strict=True):
            way = path + top
            proof = h(*(d for run, at in way for i, d in enumerate(run) if i != at))
            node = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                node = leaf(row[0], lowered(row[1]), *row[2:])
            for run, at in way:
                node = h(*run[:at], node, *run[at + 1 :])
            out.append((row[0], own, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def proofs(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    manifest = merkle.build(docs, {"text": F.when(tampered, lower_ascii(F.col("text")))})
    return manifest, sorted((tuple(r) for r in merkle.prove(manifest).collect()), key=repr)


@pytest.mark.parametrize("rows", [MANY + FEW + TIED, ROWS, FEW[9:10]], ids=["many", "hostile", "one"])
def test_proofs_equal_a_plain_tree(spark, rows):
    _, found = proofs(documents(spark, rows))
    assert found == expected(rows)


def test_tampering_shows_and_only_there(spark):
    _, found = proofs(documents(spark, MANY))
    for doc_id, *_, verified in found:
        assert verified == (zlib.crc32(str(doc_id).encode()) % 3 != 0)


def test_paths_do_not_depend_on_how_they_are_joined(spark, monkeypatch):
    rows = MANY + FEW
    monkeypatch.setattr(merkle, "BROADCAST_PATHS", 0)
    monkeypatch.setattr(merkle, "BROADCAST_RUNS", 0)
    assert proofs(clashing(documents(spark, rows)))[1] == expected(rows)


def test_records_are_addressed_by_content(spark):
    manifest, _ = proofs(documents(spark, MANY + FEW))
    store = {r.digest: r.children for r in manifest.records().collect()}
    assert all(h(*children) == digest and len(children) <= 8 for digest, children in store.items())
    seen, level = 0, [manifest.root()]
    while level:
        level = [c for d in level for c in store.get(d, [])]
        seen += sum(c not in store for c in level)
    assert seen == len(MANY + FEW)


def test_empty_table(spark):
    manifest, found = proofs(documents(spark, []))
    assert found == [] and manifest.root() is None
