"""Jaccard join, components and substring dedup against brute force."""

import hashlib
import random
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from snapfold.llm import jaccard, substrings
from snapfold.llm.components import components
from snapfold.llm.words import split_words
from tests.llm.fixtures import ROWS, clashing, documents, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def near_copies(seed=1, groups=6, members=12, size=60, edits=2, first=1000):
    """Groups of texts with a few words changed, plus chains whose ends don't link."""
    rng = random.Random(seed)
    rows, at = [], first
    common = [f"c{i}" for i in range(30)]
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(size)] + common
        chain = list(base)
        for m in range(members):
            text = list(base) if g % 2 else chain
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(size)] = f"e{g}x{m}x{rng.randrange(9)}"
            rows.append((at, " ".join(text).title() if m % 3 == 0 else " ".join(text), "en", "a", 1))
            at += 1
    rng.shuffle(rows)
    return rows


def plain_classes(rows, size, percent):
    sets, found = {}, {}
    for r in rows:
        w = words((r[1] or "").translate(LOWER))
        sets[r[0]] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    for i in ids:
        found[i] = (len(sets[i]), root(i))
    return found


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 50)])
def test_similar_documents(spark, size, percent):
    rows = ROWS + near_copies() + [(20, "A b", None, None, None), (21, "a B", None, None, None), (22, "a b c", None, None, None)]
    got = jaccard.similar_documents(clashing(documents(spark, rows)), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows, size, percent)


@pytest.mark.parametrize("change", [{"OPEN_PAIRS": 0}, {"PIVOT_ROUNDS": 0}, {"BLOCK": 3, "BROADCAST_IDS": 0}, {"LONGEST_MATCH": 1}, {"VERIFY_COST": 1000.0}])
def test_no_setting_changes_the_result(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = near_copies(seed=2, groups=4, members=9, size=40, edits=3)
    got = jaccard.similar_documents(documents(spark, rows), 3, 70).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_classes(rows, 3, 70)


def test_similar_documents_of_odd_tables(spark):
    assert jaccard.similar_documents(documents(spark, [])).collect() == []
    rows = [(None, "a b", None, None, None), (1, "a b", None, None, None), (1, "a b", None, None, None), (2, None, None, None, None), (5, "A b", None, None, None)]
    got = sorted(jaccard.similar_documents(documents(spark, rows)).collect(), key=str)
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None] == [(1, 1, 1), (1, 1, 1), (2, 0, 2), (5, 1, 1)]


def test_longer_prefixes_ask_for_more_matches():
    rare = np.ones(40)
    assert jaccard.lengthen(rare, 10, 6) == 1  # nothing shared: no reason to look further
    assert jaccard.lengthen(np.full(40, 1000.0), 10, 6) > 1  # costly lists: ask for more
    assert jaccard.lengthen(np.full(40, 1000.0), 10, 2) <= 2


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (95, 100), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 90, 95: 90, 90: 90}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- substrings --------------------------------------------------------------


def plain_removed(rows, window):
    texts = {r[0]: words(r[1]) for r in rows}
    first = {}
    for doc in sorted(texts):
        w = texts[doc]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    out = {}
    for doc, w in texts.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out[doc] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def shuffled_passages(seed, docs=40, alphabet=6, length=120):
    """Texts of few different words, so that windows repeat in every way."""
    rng = random.Random(seed)
    parts = [[f"p{k}x{i % (k + 2)}" for i in range(rng.randint(5, 40))] for k in range(alphabet)]
    rows = []
    for d in range(docs):
        text = []
        while len(text) < length:
            text += rng.choice(parts)[rng.randint(0, 4) :]
        rows.append((d * 3 - 10, " \n".join(text), "en", "a", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window,gram,shard_words", [(50, 10, 200_000), (50, 10, 300), (12, 4, 100), (8, 8, 200_000), (5, 1, 50)])
def test_substring_dedup(spark, window, gram, shard_words):
    rows = [r for r in ROWS] + [(r[0] + 500, *r[1:]) for r in near_copies(groups=2, members=5)] + [(r[0] + 3000, *r[1:]) for r in shuffled_passages(window)]
    got = substrings.remove_repeats(clashing(documents(spark, rows)), window, gram, shard_words).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text or "") for r in got} == plain_removed(rows, window)
    assert all((r.text is None) == (r.doc_id == 2) for r in got)


def test_substring_dedup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BROADCAST_SPANS", 0)
    rows = shuffled_passages(3)
    got = substrings.remove_repeats(documents(spark, rows), 10, 3).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text or "") for r in got} == plain_removed(rows, 10)


def test_substring_dedup_of_odd_tables(spark):
    assert substrings.remove_repeats(documents(spark, [])).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, None, None, None), (4, text, None, None, None), (4, text, None, None, None), (9, text, None, None, None)]
    got = sorted((str(r.doc_id), r.n_removed) for r in substrings.remove_repeats(documents(spark, rows)).collect())
    assert got == [("4", 0), ("4", 0), ("9", 60), ("None", 0)]


@pytest.mark.parametrize("seed", range(6))
def test_automaton_knows_the_smallest_document(seed):
    rng = random.Random(seed)
    texts = [[rng.randrange(3) for _ in range(rng.randint(0, 40))] for _ in range(6)]
    automaton = substrings.SuffixAutomaton()
    for doc, text in enumerate(texts):
        automaton.add(text, doc)
    for query in [*texts, [rng.randrange(4) for _ in range(60)]]:
        for window in (1, 3, 5):
            want = [
                next((d for d, t in enumerate(texts) if any(t[j : j + window] == query[i : i + window] for j in range(len(t) - window + 1))), -1)
                for i in range(len(query) - window + 1)
            ]
            assert automaton.windows(query, window) == want


def test_every_window_holds_an_anchor_and_equal_windows_equal_ones():
    rng = random.Random(5)
    texts = [" ".join(f"v{rng.randrange(4)}" for _ in range(rng.randint(0, 90))) for _ in range(50)]
    texts += ["same " * 300, "one two " * 150]
    found = split_words(pa.array(texts))
    at, hashes = substrings.anchors_of(found, 12, 4)
    grams = dict(zip(*(x.tolist() for x in found.grams(4)), strict=True))
    by_text = np.searchsorted(found.first, at, "right") - 1
    for i, text in enumerate(texts):
        own = {int(p): int(h) for p, h in zip(at[by_text == i], hashes[by_text == i], strict=True)}
        first = int(found.first[i])
        for start in range(first, first + len(text.split()) - 11):
            least = min(grams[p] for p in range(start, start + 9))
            assert least in {own.get(p) for p in range(start, start + 9)}
    # A text of one repeated word has few.
    assert (by_text == 50).sum() < 300 / 4


def test_words_are_cut_like_the_pattern_says():
    rng = random.Random(9)
    texts = ["".join(rng.choices("ab \t\n\r\x0b\x0c\x1c 　é😀", k=rng.randint(0, 30))) for _ in range(300)] + [None, "", "x"]
    found = split_words(pa.array(texts)[3:])
    for i, text in enumerate(texts[3:]):
        cut = [found.data[s:e].tobytes().decode() for s, e in zip(found.starts[found.first[i] : found.first[i + 1]], found.ends[found.first[i] : found.first[i + 1]], strict=True)]
        assert cut == words(text)
    by_word = {}
    for s, e, h in zip(found.starts, found.ends, found.hashes, strict=True):
        assert by_word.setdefault(found.data[s:e].tobytes(), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_hash_of_kept_text(spark):
    text = "a  b\n c"
    got = substrings.remove_repeats(documents(spark, [(1, text, None, None, None)])).select(F.sha2("text", 256)).first()[0]
    assert got == hashlib.sha256(b"a b c").hexdigest()
