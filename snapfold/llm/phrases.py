"""Phrase collocations by an external stream layout: sorted count streams, merged in lockstep.

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and these into words
`[^\\x20\\x09]+`.  f(phrase) counts the contiguous occurrences within pieces, per language (null: `und`).
Candidates are phrases of 2 to LONGEST words with f >= `least`.  For a cut of a candidate into
a first part and a rest, the score is floor(2000000 * f / (f(first) + f(rest))); the lowest cut counts, ties
go to the shortest first part.  A candidate goes if a longer candidate that contains its words one after
another has 100 * f(longer) >= `covered` * f.

Counting.  No part of a candidate is rarer than the candidate, so only phrases with f >= `least`
matter.  Two passes over the texts fill saturating counters of hashed phrases, first of words and
pairs, then of longer phrases whose pairs all pass.  A counter below `least` proves a phrase to be
rare; the others are counted exactly.  The counters' number follows the size of the table (up to
MOST_COUNTERS); they decide how much is counted, never what comes out.  A task counts in arrays and hands
on sorted, compressed runs of phrases and counts, dealt by first word; a run's reader adds up equal phrases.

Streams.  The counts are kept as one stream in prefix order (by first word, second word ...) and
one in suffix order (by last word, last but one ...).  In prefix order the prefixes of a phrase are the
phrases still open when it arrives: one walk gives f of every first part and the largest count of an
extension to the right.  In suffix order it gives f of every rest and the extensions to the left.  An
extension by several words is no more frequent than the one-word extension in it, so those decide.  No
table of phrases is looked up: a walk holds LONGEST phrases.

Numbers are exact.  Null and empty texts have no words.  Rows without an id count, repeated rows count each.
A language without candidates gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.jaccard import lowered
from snapfold.llm.staging import staged
from snapfold.llm.words import _BYTE_KEYS, _range_sums, chunks, mixed, text_bytes

LONGEST = 4
LEAST = 30
COVERED = 80
TOP = 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"
BYTES_PER_COUNTER = 64
LEAST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 27
HELD_PHRASES = 600_000  # a task hands on its counts when it holds so many
PARTS = 16

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_APART = _BREAKS.copy()
_APART[[0x20, 0x09]] = True


@dataclass
class Pieces:
    """Words of some texts in one language: byte ranges, hashes, and the number of the piece each is in."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray

    def phrases(self, size: int, language: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words and hashes of all runs of `size` words within a piece."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(self.piece[: n - size + 1] == self.piece[size - 1 :])
        own = np.uint64(language * (2 * size + 1) % 2**64)
        return at, mixed(_range_sums(self.hashes, at, at + size) + own)


def split_pieces(texts: pa.Array) -> Pieces:
    data, offsets = text_bytes(lowered(texts))
    apart = _APART[data]
    begins = ~apart
    closes = begins.copy()
    begins[1:] &= apart[:-1]
    closes[:-1] &= apart[1:]
    # Where a text ends its last word does, and the next text begins a piece.
    borders = np.unique(offsets)
    inner = borders[(borders > 0) & (borders < len(data))]
    begins[inner] |= ~apart[inner]
    closes[inner - 1] |= ~apart[inner - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    breaks = _BREAKS[data].astype(np.int64)
    breaks[inner] += 1
    piece = np.cumsum(breaks)[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    return Pieces(data, starts, ends, _range_sums(_BYTE_KEYS[data], starts, ends), piece)


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Pieces]]:
    """Language, its hash and the pieces of bounded chunks of rows."""
    for batch in batches:
        for part in chunks(batch):
            languages = part.column("lang").cast(pa.string()).fill_null(NO_LANGUAGE)
            for language in pc.unique(languages).to_pylist():
                texts = part.column("text").filter(pc.equal(languages, language))
                raw = np.frombuffer(language.encode(), dtype=np.uint8)
                key = int(_range_sums(_BYTE_KEYS[raw], np.zeros(1, np.int64), np.array([len(raw)]))[0])
                yield language, key, split_pieces(texts)


@dataclass(frozen=True)
class Filter:
    """Saturated counters of words (a quarter of them) and pairs, and of longer phrases."""

    size: int
    least: int
    short: np.ndarray
    long: np.ndarray | None = None

    def slots(self, hashes: np.ndarray, size: int) -> np.ndarray:
        words = self.size // 4
        if size == 1:
            return (hashes % np.uint64(words)).astype(np.int64)
        if size == 2:
            return words + (hashes % np.uint64(self.size - words)).astype(np.int64)
        return (hashes % np.uint64(self.size)).astype(np.int64)

    def frequent(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Which phrases of so many words may have `least` occurrences."""
        counters = self.short if size <= 2 else self.long
        return counters[self.slots(hashes, size)] >= self.least

    def with_pairs(self, pieces: Pieces, language: int) -> np.ndarray:
        """Of each word whether the pair that begins with it passes."""
        at, hashes = pieces.phrases(2, language)
        passing = np.zeros(len(pieces.hashes) + LONGEST, dtype=bool)
        passing[at] = self.frequent(hashes, 2)
        return passing


def _add(total: np.ndarray, slots: np.ndarray, most: int) -> None:
    found, counts = np.unique(slots, return_counts=True)
    total[found] = np.minimum(most, total[found].astype(np.int64) + counts).astype(np.uint8)


def _counters(docs: DataFrame, size: int, least: int, count) -> np.ndarray:
    """Saturating sums of the arrays that tasks fill by `count(language hash, pieces, array)`.

    A task sends on one array of a byte per counter, compressed; PARTS tasks put those together.
    """
    schema = "part int, total binary"

    def pack(part: int, total: np.ndarray) -> pa.RecordBatch:
        packed = pa.compress(total.tobytes(), codec="zstd", asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "total"])

    def into(total: np.ndarray, packed: bytes) -> None:
        more = np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), dtype=np.uint8)
        np.minimum(least, total.astype(np.uint16) + more, out=total, casting="unsafe")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.uint8)
        for _, key, pieces in by_language(batches):
            count(key, pieces, total)
        if total.any():
            yield pack(TaskContext.get().partitionId() % PARTS, total)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.uint8)
        for batch in batches:
            for value in batch.column("total"):
                into(total, value.as_py())
        if total.any():
            yield pack(0, total)

    total = np.zeros(size, dtype=np.uint8)
    for row in docs.mapInArrow(own, schema).repartition(PARTS, "part").mapInArrow(together, schema).toLocalIterator():
        into(total, bytes(row.total))
    return total


def counter_number(docs: DataFrame) -> int:
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = 1 << math.ceil(math.log2(max(1, n_bytes / BYTES_PER_COUNTER)))
    return min(MOST_COUNTERS, max(LEAST_COUNTERS, wanted))


def frequent_filter(docs: DataFrame, least: int) -> Filter:
    if not 1 <= least <= 255:
        raise ValueError("the least count must be from 1 to 255, which counters hold")
    size = counter_number(docs)
    empty = Filter(size, least, np.zeros(0, np.uint8))

    def count_short(language: int, pieces: Pieces, total: np.ndarray) -> None:
        for n in (1, 2):
            _add(total, empty.slots(pieces.phrases(n, language)[1], n), least)

    short = Filter(size, least, _counters(docs, size, least, count_short))
    known = docs.sparkSession.sparkContext.broadcast(short)  # one byte a counter

    def count_long(language: int, pieces: Pieces, total: np.ndarray) -> None:
        pairs = known.value.with_pairs(pieces, language)
        for n in range(3, LONGEST + 1):
            at, hashes = pieces.phrases(n, language)
            inner = np.logical_and.reduce([pairs[at + i] for i in range(n - 1)])
            _add(total, empty.slots(hashes[inner], n), least)

    return Filter(size, least, short.short, _counters(docs, size, least, count_long))


def gathered(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the given ranges one after another."""
    before = np.cumsum(lengths) - lengths
    return data[np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))]


class _Counts:
    """Counts of the phrases of one language by hash, with their words joined by single spaces."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray, bucket: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> None:
        self.parts.append((hashes, counts, bucket, lengths, data))
        self.rows += len(hashes)

    def combine(self) -> None:
        if len(self.parts) < 2:
            return
        hashes, counts, bucket, lengths, data = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        found, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.zeros(len(found), dtype=np.int64)
        np.add.at(total, which, counts)
        begins = np.cumsum(lengths) - lengths
        data = gathered(data, begins[at], lengths[at])
        self.clear()
        self.add(found, total, bucket[at], lengths[at], data)

    def runs(self) -> Iterator[tuple[int, bytes]]:
        """Bucket and packed run, sorted by phrase, of all that is held."""
        self.combine()
        if not self.rows:
            return
        _, counts, bucket, lengths, data = self.parts[0]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        texts = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        order = pc.sort_indices(pa.table({"bucket": bucket, "phrase": texts}), [("bucket", "ascending"), ("phrase", "ascending")])
        order = order.to_numpy()
        counts, bucket, lengths, begins = counts[order], bucket[order], lengths[order], offsets[:-1][order]
        borders = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for x, y in zip(borders, np.append(borders[1:], len(bucket))):
            yield int(bucket[x]), packed_run(counts[x:y], lengths[x:y], gathered(data, begins[x:y], lengths[x:y]))


def packed_run(counts: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> bytes:
    raw = np.array([len(counts)], "<i8").tobytes() + counts.astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + data.tobytes()
    return np.array([len(raw)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked_run(packed: bytes) -> pa.Table:
    size = int(np.frombuffer(packed, "<i8", 1)[0])
    raw = pa.decompress(packed[8:], size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    counts, lengths = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    texts = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[8 + 16 * n :])])
    return pa.table({"phrase": texts, "f": pa.array(counts)})


def runs_of(docs: DataFrame, filters: Filter, buckets: int) -> DataFrame:
    """(lang, bucket, run): a task's counts of phrases that may be frequent, as sorted runs by the hash of the
    first word; bucket -1 has the number of words."""
    known = docs.sparkSession.sparkContext.broadcast(filters)  # one byte a counter
    names = ["lang", "bucket", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Counts] = {}
        words: dict[str, int] = {}

        def out(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.binary()), strict=True)], names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            for language, counts in held.items():
                rows = [(language, *r) for r in counts.runs()]
                if rows:
                    yield out(rows)
                counts.clear()

        for language, key, pieces in by_language(batches):
            own = held.setdefault(language, _Counts(buckets))
            words[language] = words.get(language, 0) + len(pieces.hashes)
            filters = known.value
            pairs = filters.with_pairs(pieces, key)
            sizes = pieces.ends - pieces.starts
            # The words one after another, a space between any two.
            begins = np.cumsum(sizes + 1) - sizes - 1
            data = np.full(int(begins[-1] + sizes[-1]) if len(sizes) else 0, 0x20, dtype=np.uint8)
            data[gathered(np.arange(len(data)), begins, sizes)] = gathered(pieces.data, pieces.starts, sizes)
            for n in range(1, LONGEST + 1):
                at, hashes = pieces.phrases(n, key)
                keep = filters.frequent(hashes, n)
                if n > 2:
                    keep &= np.logical_and.reduce([pairs[at + i] for i in range(n - 1)])
                found, first, counts = np.unique(hashes[keep], return_index=True, return_counts=True)
                first = at[keep][first]
                last = first + n - 1
                lengths = begins[last] + sizes[last] - begins[first]
                bucket = (mixed(pieces.hashes[first]) % np.uint64(buckets)).astype(np.int32)
                own.add(found, counts, bucket, lengths, gathered(data, begins[first], lengths))
            if sum(len(c.parts) for c in held.values()) >= 64:
                for counts in held.values():
                    counts.combine()
                if sum(c.rows for c in held.values()) >= HELD_PHRASES:
                    yield from flush()
        yield from flush()
        totals = [(x, -1, packed_run(np.array([n]), np.array([0]), np.zeros(0, np.uint8))) for x, n in words.items()]
        if totals:
            yield out(totals)

    return docs.mapInArrow(run, "lang string, bucket int, run binary")


def merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) from the runs: counts of equal phrases added up, bucket by bucket; rare ones go."""

    def add_up(tables: list[pa.Table]) -> pa.Table:
        total = pa.concat_tables(tables).group_by("phrase").aggregate([("f", "sum")])
        return total.select(["phrase", "f_sum"]).rename_columns(["phrase", "f"])

    def close(key: tuple[str, int], tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        total = add_up(tables)
        if key[1] >= 0:
            total = total.filter(pc.greater_equal(total["f"], least))
        for batch in total.combine_chunks().to_batches(max_chunksize=65536):
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(key[0], batch.num_rows), batch.column("phrase").cast(pa.string()), batch.column("f")],
                names=["lang", "phrase", "f"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tables, rows = None, [], 0
        for batch in batches:
            for language, bucket, packed in zip(*(batch.column(c) for c in ("lang", "bucket", "run")), strict=True):
                own = language.as_py(), bucket.as_py()
                if own != key:
                    if key is not None:
                        yield from close(key, tables)
                    key, tables, rows = own, [], 0
                tables.append(unpacked_run(packed.as_buffer().to_pybytes()))
                rows += tables[-1].num_rows
                if rows >= 2 * HELD_PHRASES:
                    tables = [add_up(tables)]
                    rows = tables[0].num_rows // 2  # what stays may be much: add up again when it has doubled
        if key is not None:
            yield from close(key, tables)

    dealt = runs.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return dealt.mapInArrow(run, "lang string, phrase string, f long")


def counted(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): all phrases of 1 to LONGEST words with f >= least, and (lang, '', number of words)."""
    docs = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged(runs_of(docs, frequent_filter(docs, least), buckets), least)


class _Walk:
    """One walk along a sorted stream: the open phrases, each containing the one before at its end of reading.

    `continues(long, short)`: whether `short` is the part of `long` that is read first.
    """

    def __init__(self, continues):
        self.continues = continues
        self.language = None
        self.open: list[dict] = []

    def take(self, row: dict) -> list[dict]:
        """Enters a phrase; returns those that are closed by it, with the largest count of an extension."""
        closed = []
        while self.open and (self.language != row["lang"] or not self.continues(row["phrase"], self.open[-1]["phrase"])):
            closed.append(self.open.pop())
        self.language = row["lang"]
        row["parts"] = [r["f"] for r in self.open]
        if self.open:
            self.open[-1]["extension"] = max(self.open[-1]["extension"], row["f"])
        row["extension"] = 0
        self.open.append(row)
        return closed


def _begins(long: str, short: str) -> bool:
    return long.startswith(short + " ")


def _ends(long: str, short: str) -> bool:
    return long.endswith(" " + short)


def _walk(batches: Iterator[pa.RecordBatch], continues) -> Iterator[list[dict]]:
    walk = _Walk(continues)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            closed = []
            for row in batch.slice(at, 4096).to_pylist():
                closed += walk.take(row)
            yield closed
    yield walk.open[::-1]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lowest_cut(a: int, firsts: list[int], rests: list[int]) -> tuple[int, int, int]:
    """(score, l, r) of the cut with the lowest score; `firsts[k]`, `rests[k]`: counts for a first part of k + 1 words."""
    cuts = [(SCALE * a // (x + y), k) for k, (x, y) in enumerate(zip(firsts, rests, strict=True))]
    score, k = min(cuts)
    return score, firsts[k], rests[k]


def prefix_stream(counts: DataFrame) -> DataFrame:
    """The counts with those of their prefixes (shortest first) and of their best extension to the right."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()), ("firsts", pa.list_(pa.int64())), ("extension", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for closed in _walk(batches, _begins):
            yield _batch([(r["lang"], r["phrase"], r["f"], r["parts"], r["extension"]) for r in closed], schema)

    words = F.split("phrase", " ")
    rows = counts.where("phrase <> ''").withColumn("words", words).withColumn("end", F.col("words")[0])
    rows = rows.repartitionByRange("lang", "end").sortWithinPartitions("lang", "words").select("lang", "phrase", "f")
    return rows.mapInArrow(run, "lang string, phrase string, f long, firsts array<bigint>, extension long")


def candidates(prefixes: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that stay, by a walk in suffix order."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *((c, pa.int64()) for c in ("a", "l", "r", "score"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for closed in _walk(batches, _ends):
            out = []
            for r in closed:
                if not r["firsts"] or 100 * max(r["extension"], r["right"]) >= covered * r["f"]:
                    continue
                # Rests come shortest first; the first parts' rests, longest first.
                score, first, rest = lowest_cut(r["f"], r["firsts"], r["parts"][::-1])
                out.append((r["lang"], r["phrase"], r["f"], first, rest, score))
            yield _batch(out, schema)

    words = F.reverse(F.split("phrase", " "))
    rows = prefixes.withColumn("words", words).withColumn("end", F.col("words")[0]).withColumnRenamed("extension", "right")
    rows = rows.repartitionByRange("lang", "end").sortWithinPartitions("lang", "words").select("lang", "phrase", "f", "firsts", "right")
    return rows.mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long")


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first `top` phrases by score, then count,
    both descending, then phrase by bytes."""
    counts = staged(counted(docs, least), "phrase-counts")
    prefixes = staged(prefix_stream(counts), "phrase-prefixes")
    words = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(prefixes, covered).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
