"""Phrase mining against plain counting of every phrase."""

import random
import re
from collections import Counter

import pytest

from snapfold.llm import phrases

from .fixtures import ROWS, clashing, documents


def texts(n=160, seed=3):
    draw = random.Random(seed)
    stock = ["new york", "New  York city", "of the", "é à", "ß ẞ", "a b c d", "a b c d e", "x", "y", "the", "🙂 🙂"]
    rows = []
    for i in range(n):
        parts = [draw.choice(stock) for _ in range(draw.randint(0, 30))]
        text = "".join(p + draw.choice([" ", "\t ", ", ", ".\n", " ", " ", "\x0b", "\x1c", "\x00"]) for p in parts)
        rows.append((i, draw.choice([text, text, text, None]) if i % 9 else "", draw.choice(["en", "en", "fr", None, ""]), "s", 1))
    return rows


def expected(rows, least, covered, top):
    out = []
    languages = sorted({r[2] if r[2] is not None else "und" for r in rows})
    for lang in languages:
        f, n = Counter(), 0
        for r in rows:
            if (r[2] if r[2] is not None else "und") != lang:
                continue
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for k in range(1, 5):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in found.items():
            longer = [c for q, c in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * c >= covered * a for c in longer):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


@pytest.mark.parametrize("least, covered, top", [(3, 80, 2000), (2, 100, 5), (30, 50, 2000)])
def test_equal_plain_counting(spark, least, covered, top):
    rows = texts() + [(None, *r[1:]) for r in ROWS] + ROWS
    found = phrases.collocations(documents(spark, rows), least, covered, top).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows, least, covered, top))


def test_counters_decide_nothing(spark, monkeypatch):
    rows = texts(60)
    want = sorted(expected(rows, 3, 80, 2000))
    assert want
    docs = clashing(documents(spark, rows))
    for counters, held in ((16, 10), (1 << 20, 1)):
        monkeypatch.setattr(phrases, "counter_number", lambda _, n=counters: n)
        monkeypatch.setattr(phrases, "HELD_PHRASES", held)
        assert sorted(map(tuple, phrases.collocations(docs, 3).collect())) == want


def test_a_common_pair_and_a_very_long_text(spark):
    rows = [(i, "very common " * 300, "en", "s", 1) for i in range(20)] + [(99, "one two three " * 20000, "en", "s", 1)]
    found = phrases.collocations(documents(spark, rows)).collect()
    assert sorted(map(tuple, found)) == sorted(expected(rows, 30, 80, 2000))


def test_no_words(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    assert phrases.collocations(documents(spark, [(1, None, "en", "s", 1), (2, " .\t", None, "s", 1)])).collect() == []


def test_cuts_are_exact_and_ties_go_to_the_shortest_first_part():
    assert phrases.lowest_cut(30, [30, 40], [40, 30]) == (2000000 * 30 // 70, 30, 40)
    huge = 3 * 10**18
    assert phrases.lowest_cut(huge, [huge], [huge + 1]) == (2000000 * huge // (2 * huge + 1), huge, huge + 1)
