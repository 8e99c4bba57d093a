"""Encoding, packing and token files against the tokenizers library used plainly."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from snapfold.llm import encoding, packing, tokenfiles
from snapfold.llm.queries import tokenizer_path
from tests.llm.fixtures import ROWS, clashing, documents

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def plain_ids(name, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def hostile_texts():
    rng = random.Random(3)
    alphabet = list("ab Z\t\n\r'.-9<|>") + [
        "  ", " ", " ", " ", "　", "\x1c", "\x85", "é", "é", "́", "ß", "Σ", "中", "😀",
        "'s", "'LL", "<|endoftext|>", "  <|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|> ", "İ", " ",
    ]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]


@pytest.mark.parametrize("name", FILES)
def test_units_encode_like_whole_texts(name):
    texts = [r[1] for r in ROWS] + hostile_texts()
    got = encoding.encode_documents(pa.array(texts, pa.string()), tokenizer_path(name), 1)
    for text, ids, want in zip(texts, got, plain_ids(name, texts), strict=True):
        assert ids.tolist() == [*want, 1], repr(text)


def test_a_full_memory_starts_again(monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 10)
    path = tokenizer_path(FILES[0])
    own = encoding.Encoder(path)
    texts = [f"some words number {i} of text{i}" for i in range(30)]
    for _ in range(2):
        for at in range(0, 30, 3):
            ids, offsets = own.encode(pa.array(texts[at : at + 3]))
            want = plain_ids(FILES[0], texts[at : at + 3])
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want


def test_unknown_files_are_encoded_whole(tmp_path):
    copy = tmp_path / "other.json"
    copy.write_bytes(open(tokenizer_path(FILES[1]), "rb").read())
    texts = ["Some text, here", None, ""]
    ids, offsets = encoding.Encoder(str(copy)).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == plain_ids(FILES[1], texts)


def check_pieces(pieces, rows, length, name=FILES[0]):
    want = {r[0]: [*ids, 1] for r, ids in zip(rows, plain_ids(name, [r[1] for r in rows]), strict=True)}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = want[p.doc_id]
        assert p.doc_tokens == len(ids) and p.length > 0
        assert p.ids_crc32 == crc(ids[p.start : p.start + p.length])
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length, p.sequence_length))
    for doc, ids in want.items():
        at = 0
        for start, n in sorted(by_doc[doc]):
            assert start == at
            at += n
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at
            at += n
        assert at == parts[0][2] <= length and (at == length or at & (at - 1) == 0)  # no padding at all


def test_packing(spark):
    docs = clashing(documents(spark))
    path = tokenizer_path(FILES[0])
    pieces = packing.pack(docs, path, length=256, block_tokens=5000).collect()
    check_pieces(pieces, ROWS, 256)
    check_pieces(packing.pack(documents(spark), path).collect(), ROWS, 2048)
    assert packing.pack(docs.limit(0), path).collect() == []


def test_packing_balances_cost():
    sizes = sorted(np.random.default_rng(1).integers(1, 900, 400).tolist(), reverse=True)
    pieces, total, cost = packing.assign(sizes)
    assert sum(total) == sum(sizes) and sum(p[2] for p in pieces) == sum(sizes)
    full = [c for c, t in zip(cost, total, strict=True) if t == packing.LENGTH]
    in_order = []  # the same documents, simply one after another
    at, used = 0, 0.0
    for n in sizes:
        while n:
            k = min(n, packing.LENGTH - at)
            used += k + k * k / 1024
            at, n = at + k, n - k
            if at == packing.LENGTH:
                in_order.append(used)
                at, used = 0, 0.0
    assert np.std(full) < np.std(in_order) / 2


@pytest.mark.parametrize("tokens", [0, 1, 2047, 2048, 2049, 3 * 2048 + 1000])
def test_capacities(tokens):
    assert sum(packing.capacities(tokens)) == tokens


def read_back(dataset):
    return sorted(dataset_row for dataset_row in map(tuple, tokenfiles.read_tokens(dataset).collect()))


@pytest.mark.parametrize("name", FILES)
def test_token_files(spark, tmp_path, name):
    docs = clashing(documents(spark))
    dataset = tokenfiles.write_tokens(docs, tokenizer_path(name), str(tmp_path / "t"), shards=3)
    want, at = [], 0
    for row, ids in zip(ROWS, plain_ids(name, [r[1] for r in ROWS]), strict=True):
        ids = [*ids, 1]
        want.append((row[0], at, len(ids), crc(ids)))
        at += len(ids)
    assert read_back(dataset) == want
    # One document on its own, by the index.
    shard = tokenfiles.Shard(dataset.shards.orderBy("shard").first()["path"])
    row = shard.index["doc_id"].to_pylist().index(1)
    assert shard.ids(row).tolist() == [*plain_ids(name, [ROWS[1][1]])[0], 1]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith(".shard") and not p.name.endswith(".crc")]


def test_token_files_of_odd_tables(spark, tmp_path):
    path = tokenizer_path(FILES[1])
    empty = tokenfiles.write_tokens(documents(spark, []), path, str(tmp_path / "e"), shards=2)
    assert read_back(empty) == []
    rows = [(None, "a b", None, None, None), (3, "c", None, None, None), (3, "c", None, None, None), (3, None, None, None, None)]
    odd = tokenfiles.read_tokens(tokenfiles.write_tokens(documents(spark, rows), path, str(tmp_path / "o"), shards=2))
    got = odd.orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 3, 3, 3]
    assert [r.n_tokens for r in got] == [3, 1, 2, 2]


def test_a_changed_dictionary_is_noticed(spark, tmp_path):
    dataset = tokenfiles.write_tokens(documents(spark), tokenizer_path(FILES[1]), str(tmp_path / "d"), shards=1)
    (tmp_path / "d" / f"{dataset.dictionary}.dict").write_bytes(b"other")
    with pytest.raises(ValueError, match="dictionary"):
        tokenfiles.Shard(dataset.shards.first()["path"])


def test_unfinished_shards_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(tokenfiles.MAGIC + bytes(40))
    with pytest.raises(ValueError, match="unfinished"):
        tokenfiles.Shard(str(tmp_path / "x"))
