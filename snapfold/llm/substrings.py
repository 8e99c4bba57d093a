"""Substring dedup: words in long passages that a smaller doc_id also has are removed.

A window is `window` consecutive words of one document.  A word goes if a window covers it whose word
sequence also starts in a document with a smaller doc_id.  Windows are judged on the input.

Passages are found with suffix automata of reference shards:

1. Anchors.  Of any window - gram + 1 consecutive grams the one of smallest hash is an anchor, so every
   window holds one, and equal windows hold equal ones.  Anchors of two or more documents are shared;
   `first` is the smallest doc_id that has one.
2. Segments.  A document's words around its shared anchors with the same `first`, as far as windows
   holding them reach, are its segments for that `first`.  So equal windows of different documents
   lie in segments for the same `first`.  Equal segments are one, with its smallest doc_id.
3. Reference shards.  The distinct segments for a `first` are its reference, cut into shards of about
   SHARD_WORDS words.  A task holds the suffix automaton of one shard at a time, whose states know the
   smallest doc_id they occur in, and streams the segments for that `first` through it: the matching
   statistic at a word is the longest suffix read so far that the shard holds.  Where it
   reaches `window`, the state of the last `window` words names the smallest doc_id.
4. A document loses the maximal spans of its segments' windows whose smallest doc_id is below its own.

Broadcasting every shard to every document would cost shards times corpus.  Here each shard
goes only to what shares an anchor with it; a `first` with many segments has many
shards, on many tasks, each of bounded size.

Words are runs of `[^\\x20\\x09-\\x0D]`, unchanged, told apart by 64-bit hashes.  Null, empty and short texts
lose nothing.  Rows without a doc_id lose nothing and remove nothing.  Rows with the same doc_id don't
remove from each other.  Other columns are carried along by `remove_repeats`.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from snapfold.llm.staging import staged
from snapfold.llm.words import Words, chunks, split_words

WINDOW = 50
GRAM = 10
SHARD_WORDS = 200_000
BROADCAST_SPANS = 300_000


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """choose (np.minimum or np.maximum) over every run of `width` values."""
    done = 1
    while 2 * done <= width:
        values = choose(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return choose(values[: len(values) - rest], values[rest:]) if rest else values


def thinned(at: np.ndarray, hashes: np.ndarray, texts: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the anchors to keep, where a text has many of one hash close together.

    One between two others at most `width` apart is in no window without them.
    """
    kept = np.lexsort((at, hashes, texts))
    idle, odd = 0, 1
    while idle < 2 and len(kept) > 2:
        p, h, t = at[kept], hashes[kept], texts[kept]
        same = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        drop = np.zeros(len(kept), dtype=bool)
        drop[1:-1] = same[:-1] & same[1:] & (p[2:] - p[:-2] <= width)
        drop[odd::2] = False  # never two neighbours at once
        idle = 0 if drop.any() else idle + 1
        kept, odd = kept[~drop], 1 - odd
    return np.sort(kept)


def anchors_of(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and hashes of the anchors of all texts.

    Every window holds one with the least hash of its grams.
    """
    at, hashes = words.grams(gram)
    width = window - gram + 1
    if len(at) < width:
        return at[:0], hashes[:0]
    least = sliding(hashes, width, np.minimum)
    whole = at[width - 1 :] - at[: len(at) - width + 1] == width - 1  # all grams in one text
    # A text's last gram and the next text's first are `gram` words apart, never neighbours.
    least[~whole] = 0
    padded = np.concatenate([np.zeros(width - 1, least.dtype), least, np.zeros(width - 1, least.dtype)])
    chosen = (sliding(padded, width, np.maximum) == hashes) & (hashes != 0)
    at, hashes = at[chosen], hashes[chosen]
    kept = thinned(at, hashes, np.searchsorted(words.first, at, "right"), width)
    return at[kept], hashes[kept]


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor, doc, pos (first word of the anchor in its document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = split_words(part.column("text"))
                at, hashes = anchors_of(words, window, gram)
                text = np.searchsorted(words.first, at, "right") - 1
                doc = part.column("doc_id").to_numpy()[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(doc, pa.int64()), pa.array((at - words.first[text]).astype(np.int32))],
                    names=["anchor", "doc", "pos"],
                )

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "anchor long, doc long, pos int")


def segments(docs: DataFrame, shared: DataFrame, window: int, gram: int) -> DataFrame:
    """first, digest, doc, start, n, words (64-bit hashes): the segments of all documents."""
    before, after = window - gram, window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = split_words(part.column("text"))
                out: dict[str, list] = {k: [] for k in ("first", "digest", "doc", "start", "n", "words")}
                for i, (doc, places) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("places"), strict=True)):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    held = places.values.flatten()
                    pos, first = held[0].to_numpy().astype(np.int64), held[1].to_numpy()
                    order = np.lexsort((pos, first))
                    pos, first = pos[order], first[order]
                    low, high = np.maximum(pos - before, 0), np.minimum(pos + after, len(own))
                    new = np.append(True, (first[1:] != first[:-1]) | (low[1:] > high[:-1]))
                    begins = np.flatnonzero(new)
                    ends = np.append(begins[1:], len(pos)) - 1
                    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
                        piece = own[low[b] : high[e]].tobytes()
                        out["first"].append(int(first[b]))
                        out["digest"].append(hashlib.blake2b(piece, digest_size=16).digest())
                        out["doc"].append(doc)
                        out["start"].append(int(low[b]))
                        out["n"].append(int(high[e] - low[b]))
                        out["words"].append(piece)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    # The texts are the larger side: hashing the places leaves them unsorted.
    texts = docs.select("doc_id", "text").join(shared.hint("shuffle_hash"), docs["doc_id"] == F.col("doc"))
    return texts.select("doc_id", "text", "places").mapInArrow(
        run, "first long, digest binary, doc long, start long, n long, words binary"
    )


class SuffixAutomaton:
    """Of several word sequences, added in ascending order of their documents."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first: list[int] = [-1]  # smallest document a state occurs in

    def _state(self, length: int, doc: int, link: int = -1, after: dict[int, int] | None = None) -> int:
        self.next.append(dict(after) if after else {})
        self.link.append(link)
        self.length.append(length)
        self.first.append(doc)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of `target` no longer than `state` and `word`, as a state of its own."""
        copy = self._state(self.length[state] + 1, self.first[target], self.link[target], self.next[target])
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def add(self, words: list[int], doc: int) -> None:
        steps, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            known = steps[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, word, known)
                continue
            new = self._state(length[last] + 1, doc)
            state = last
            while state >= 0 and word not in steps[state]:
                steps[state][word] = new
                state = link[state]
            if state < 0:
                link[new] = 0
            else:
                known = steps[state][word]
                link[new] = known if length[known] == length[state] + 1 else self._split(state, word, known)
            last = new

    def windows(self, words: list[int], window: int) -> list[int]:
        """For each start of a window the smallest document that has it, or -1."""
        steps, link, length, first = self.next, self.link, self.length, self.first
        out = []
        state = matched = 0
        for at, word in enumerate(words, 1):
            while state and word not in steps[state]:
                state = link[state]
                matched = length[state]
            after = steps[state].get(word)
            if after is None:
                matched = 0
            else:
                state, matched = after, matched + 1
                # Only the last `window` words matter.
                while length[link[state]] >= window:
                    state = link[state]
                matched = min(matched, length[state])
            if at >= window:
                out.append(first[state] if matched >= window else -1)
        return out


def matches(distinct: DataFrame, window: int, shard_words: int) -> DataFrame:
    """first, digest, runs: of each segment, runs [from, to) of window starts that a smallest document `holder` has.

    `distinct`: first, digest, doc (smallest), n, words.
    """
    sizes = distinct.groupBy("first").agg(
        F.ceil(F.sum("n") / F.lit(shard_words)).alias("shards"), F.count("*").alias("segments")
    )
    # A segment on its own is held by its documents only, the smallest of which it knows.
    several = distinct.join(sizes.where("segments > 1"), "first")
    dealt = (
        several.withColumn("home", F.pmod(F.xxhash64("digest"), F.col("shards")))
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
        .select("first", "shard", (F.col("home") != F.col("shard")).cast("int").alias("guest"), "doc", "digest", "words")
    )
    ordered = dealt.repartition("first", "shard").sortWithinPartitions("first", "shard", "guest", "doc", "digest")
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64()), ("holder", pa.int64())]))

    def runs_of(found: np.ndarray, docs: list[int]) -> list[dict]:
        """Runs of windows with the same holder, who comes as a number in `docs` or -1."""
        borders = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        ends = np.append(borders[1:], len(found))
        return [
            {"from": b, "to": e, "holder": docs[h]}
            for b, e, h in zip(borders.tolist(), ends.tolist(), found[borders].tolist(), strict=True) if h >= 0
        ]

    def emit(key, found: list[tuple[bytes, list[dict]]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(found), pa.int64()), pa.array([d for d, _ in found], pa.binary()),
             pa.array([r for _, r in found], span)],
            names=["first", "digest", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton, numbers, docs, waiting = None, None, {}, [], []

        def stream(digest: bytes, words: list[int]) -> tuple[bytes, list[dict]]:
            return digest, runs_of(np.array(automaton.windows(words, window), dtype=np.int64), docs)

        for batch in batches:
            for first, shard, guest, doc, digest, raw in zip(*(batch.column(c) for c in range(6)), strict=True):
                now = first.as_py(), shard.as_py()
                if now != key:
                    if waiting:  # the reference is whole: stream what it is made of
                        yield emit(key, [stream(*x) for x in waiting])
                    key, automaton, numbers, docs, waiting = now, SuffixAutomaton(), {}, [], []
                words = np.frombuffer(raw.as_buffer(), dtype=np.int64).tolist()
                if guest.as_py():
                    if waiting:
                        yield emit(key, [stream(*x) for x in waiting])
                        waiting = []
                    yield emit(key, [stream(digest.as_py(), words)])
                else:
                    # Documents by number, in ascending order; their ids may be negative.
                    if not docs or docs[-1] != doc.as_py():
                        docs.append(doc.as_py())
                    automaton.add(words, len(docs) - 1)
                    waiting.append((digest.as_py(), words))
        if waiting:
            yield emit(key, [stream(*x) for x in waiting])

    found = ordered.mapInArrow(run, "first long, digest binary, runs array<struct<from: long, to: long, holder: long>>")
    alone = distinct.join(sizes.where("segments = 1"), "first").where(F.col("n") >= window).select(
        "first", "digest",
        F.array(F.struct(F.lit(0).cast("long").alias("from"), (F.col("n") - (window - 1)).alias("to"), F.col("doc").alias("holder"))).alias("runs"),
    )
    return found.unionByName(alone)


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc, spans: of documents that lose words, the word ranges [from, to), not yet united."""
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":
        raise TypeError("doc_id must be a bigint")
    found = staged(anchors(docs, window, gram), "anchors")
    holders = found.groupBy("anchor").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    places = found.join(holders.select("anchor", "first"), "anchor").groupBy("doc").agg(
        F.collect_list(F.struct("pos", "first")).alias("places")
    )
    cut = staged(segments(docs, places, window, gram), "segments")
    distinct = staged(
        cut.groupBy("first", "digest").agg(F.min("doc").alias("doc"), F.max("n").alias("n"), F.min_by("words", "doc").alias("words")),
        "distinct-segments",
    )
    held = staged(matches(distinct, window, shard_words), "matches")
    spans = (
        cut.select("first", "digest", "doc", "start").join(held, ["first", "digest"])
        .select("doc", "start", F.explode("runs").alias("run")).where(F.col("run.holder") < F.col("doc"))
        .select("doc", F.struct(
            (F.col("start") + F.col("run.from")).alias("from"), (F.col("start") + F.col("run.to") + (window - 1)).alias("to")
        ).alias("span"))
    )
    return staged(spans.groupBy("doc").agg(F.collect_set("span").alias("spans")), "spans")


def _kept(words: Words, gone: np.ndarray) -> list[bytes]:
    """Of each text its kept words, joined by one space."""
    starts, sizes = words.starts[~gone], (words.ends - words.starts)[~gone]
    upto = np.cumsum(sizes + 1)  # each word and the space after it
    out = np.full(int(upto[-1]) if len(upto) else 0, 0x20, dtype=np.uint8)
    shift = np.repeat(upto - sizes - 1, sizes)  # where the word goes
    within = np.arange(len(shift)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[shift + within] = words.data[np.repeat(starts, sizes) + within]
    first = np.concatenate([[0], np.cumsum(~gone)])[words.first]
    at = np.concatenate([[0], upto])[first]
    raw = out.tobytes()
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """`docs` with `text` as its kept words joined by one space, n_words (before) and n_removed.

    Where `docs` has columns of the last two names they are replaced.  Null text stays null.
    """
    spans = repeated_spans(docs, window, gram, shard_words)
    many = spans.agg(F.sum(F.size("spans")).alias("n")).first()["n"] or 0
    others = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    renamed = spans.select(F.col("doc").alias("__doc"), F.col("spans").alias("__spans"))
    side = F.broadcast(renamed) if many <= BROADCAST_SPANS else renamed.hint("shuffle_hash")
    rows = docs.select(*[f"`{c}`" for c in others]).join(side, F.col("doc_id") == F.col("__doc"), "left").drop("__doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = split_words(part.column("text"))
                lists = part.column("__spans")
                sizes = lists.value_lengths().fill_null(0).to_numpy()
                low, high = (x.to_numpy() for x in lists.drop_null().flatten().flatten())
                first = np.repeat(words.first[:-1], sizes)
                edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
                np.add.at(edge, first + low, 1)
                np.add.at(edge, first + high, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
                texts = pa.array(_kept(words, gone), pa.binary()).cast(pa.string())
                texts = pa.compute.if_else(part.column("text").is_valid(), texts, pa.scalar(None, pa.string()))
                columns = {c: part.column(c) for c in others} | {"text": texts}
                columns |= {"n_words": pa.array(words.counts(), pa.int64()), "n_removed": pa.array(removed, pa.int64())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    import pyarrow.compute  # noqa: F401

    schema = StructType([f for f in rows.schema.fields if f.name in others])
    schema["text"].dataType = StringType()
    schema = schema.add("n_words", LongType()).add("n_removed", LongType())
    return rows.mapInArrow(run, schema)
