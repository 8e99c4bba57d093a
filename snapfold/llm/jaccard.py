"""Similarity join on word n-grams with adaptive multi-match prefixes.

A document is the set of its distinct n-word shingles.  Two documents link if
100 * |intersection| >= percent * |union|.  The result is one row per document with the
smallest id it is connected with by links.

Shingles have one order, rare ones first (`Order`).  Of two linked documents with sets of x and
y shingles the overlap is at least ceil(t * x) and ceil(t * y).  So for any m they share at
least m of their first x - ceil(t * x) + m and y - ceil(t * y) + m shingles.  Each document
chooses its own m: every step lengthens the prefix by one shingle, whose documents have to be
looked at, and lets fewer candidates through to verification (`lengthen`).  A pair is verified if it
shares as many prefix shingles as the smaller of its two numbers.

1. Counts of shingles, hashed into COUNTERS counters, over all documents give the order and the
   costs.  It may be rough: any order finds all links.
2. Documents with equal sets are one: the smallest id stands for them (`representatives`).
3. Prefix shingles that two or more documents have, with the smallest of these, make the
   table of lists.
4. Documents are verified against the first documents of their lists.  Links found make
   components; what is in one component needs no further look.  So a large group of near copies
   costs its size, not its square.  While lists still hold many pairs of different components and
   that helps, other documents are made first (`PIVOT_ROUNDS` times at most).
5. All pairs of different components that are left, by the multi-match rule, if what they share in
   their prefixes leaves room for the overlap they need (`may_link`).  Bitmaps of the prefixes
   and of the whole sets bound what two documents can share (`most_shared`, `sets_may_link`), so few pairs
   that cannot link are made.

Verification is exact on 64-bit shingle hashes; it moves the sets of the documents that are in
pairs, to blocks of at most about BLOCK members of one first document.

Words are runs of `[^\\x20\\x09-\\x0D]`, A-Z lower-cased.  A text with fewer words than a shingle
is one shingle.  Null texts and texts without words are empty and linked with nothing.
Rows without a doc_id are left out of links: they come back with their size and no component.
Rows with the same doc_id come back each; their links hold for the id.  Other columns are
ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.arrays import summed_arrays
from snapfold.llm.components import components
from snapfold.llm.staging import staged
from snapfold.llm.words import _range_sums, chunks, split_words

COUNTERS = 1 << 20
LONGEST_MATCH = 6
VERIFY_COST = 20.0  # of a candidate, in lookups of a list entry
BLOCK = 256
FIRSTS = 2  # first documents that a document is verified against in a round
PIVOT_ROUNDS = 4
OPEN_PAIRS = 100  # pairs per list entry that step 5 takes on without a further round of 4
WORDS = 4  # of 64 bits, in the bitmap of a document's open entries
SKETCH = [f"sketch{w}" for w in range(8)]  # of 64 bits each, the bitmap of a document's whole set
BROADCAST_IDS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z to a-z."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    data = texts.buffers()[2]
    if data is None:
        return texts
    low = _LOWER[np.frombuffer(data, dtype=np.uint8)]
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, texts.buffers()[1], pa.py_buffer(low)], offset=texts.offset)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Of each text its distinct shingles' hashes, ascending."""
    words = split_words(lowered(texts))
    at, hashes = words.grams(size)
    cuts = np.searchsorted(at, words.first)
    counts = words.counts()
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if b > a:
            out.append(np.unique(hashes[a:b]))
        elif counts[i]:
            one = words.first[i : i + 1], words.first[i + 1 : i + 2]
            # The length marks it off from shingles of full size.
            out.append(_range_sums(words.hashes, *one) ^ np.uint64(counts[i]))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def needed(size: int, percent: int) -> int:
    """Least overlap with any linked document."""
    return -(-percent * size // 100)


@dataclass(frozen=True)
class Order:
    """Counts of shingles by counter: rough document frequencies, and what chance adds to them."""

    counts: np.ndarray
    chance: float

    @classmethod
    def of(cls, docs: DataFrame, size: int) -> Order:
        def count(part: pa.RecordBatch, total: np.ndarray) -> None:
            found = shingle_sets(part.column("text"), size)
            if found:
                total += np.bincount((np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)

        counts = summed_arrays(docs.select("text"), count, COUNTERS)
        return cls(counts, float(counts.mean()))

    def frequencies(self, shingles: np.ndarray) -> np.ndarray:
        return 1.0 + np.maximum(0.0, self.counts[(shingles % np.uint64(COUNTERS)).astype(np.int64)] - self.chance)

    def sort(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles, rare ones first, and their frequencies.  Levels are wider than chance."""
        frequency = self.frequencies(shingles)
        level = np.log2(1 + frequency / (8 + 4 * np.sqrt(self.chance))).astype(np.int64)
        order = np.lexsort((shingles, level))
        return shingles[order], frequency[order]


def lengthen(frequencies: np.ndarray, shortest: int, most: int) -> int:
    """The number of matches to ask for, from 1 to `most`; `shortest` is the prefix for one.

    With m matches, lists of S entries in all are looked at, and at most S / m documents of
    them can have m matches.
    """
    best, cost = 1, np.inf
    for m in range(1, most + 1):
        entries = float(frequencies[: shortest + m - 1].sum() - (shortest + m - 1))
        now = entries + (shortest + m - 1) + VERIFY_COST * entries / m
        if now < cost:
            best, cost = m, now
    return best


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the shingles in each of 64 * len(SKETCH) bits."""
    bits = 64 * len(SKETCH)
    places = ((shingles >> np.uint64(40)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) % 2 == 1).view(np.int64)


def prefixes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n, digest (of the set), matches, prefix (shingle hashes, 8 bytes each), SKETCH."""
    order = docs.sparkSession.sparkContext.broadcast(Order.of(docs, size))  # COUNTERS numbers
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets = shingle_sets(part.column("text"), size)
                matches, tokens = [], []
                for own in sets:
                    if not len(own):
                        matches.append(0)
                        tokens.append(b"")
                        continue
                    ranked, frequencies = order.value.sort(own)
                    least = needed(len(own), percent)
                    m = lengthen(frequencies, len(own) - least + 1, min(LONGEST_MATCH, least))
                    matches.append(m)
                    tokens.append(ranked[: len(own) - least + m].tobytes())
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                sketches = np.array([sketch(s) for s in sets], dtype=np.int64).reshape(-1, len(SKETCH))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(matches, pa.int32()), pa.array(tokens, pa.binary()), *(pa.array(x) for x in sketches.T)],
                    names=["doc_id", "n", "digest", "matches", "prefix", *SKETCH],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n long, digest binary, matches int, prefix binary, " + ", ".join(f"{s} long" for s in SKETCH)
    )


def representatives(documents: DataFrame) -> DataFrame:
    """Of documents with equal sets the one of smallest id; with the columns of `prefixes`."""
    one = F.min_by(F.struct("n", "matches", "prefix", *SKETCH), "doc_id").alias("of")
    found = documents.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), one)
    return found.select("doc_id", "digest", "of.*")


LISTS = "token long, doc long, n long, matches int, first long, first_n long, first_matches int"


def lists(represented: DataFrame) -> DataFrame:
    """Entries of the prefix lists that two or more documents share, and the first document of each."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                tokens = [np.frombuffer(x.as_py(), dtype=np.int64) for x in part.column("prefix")]
                sizes = [len(t) for t in tokens]
                columns = [np.repeat(part.column(c).to_numpy(), sizes) for c in ("doc_id", "n", "matches")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.concatenate(tokens), *columns)], names=["token", "doc", "n", "matches"]
                )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by token: drop lists of one, note the first of the others."""
        held = None  # last row of the batch before, with what is known of its list
        for batch in batches:
            if not batch.num_rows:
                continue
            token, doc, n, matches = (batch.column(c).to_numpy() for c in ("token", "doc", "n", "matches"))
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            firsts = np.repeat(starts, np.diff(np.append(starts, len(token))))
            first, first_n, first_matches = doc[firsts], n[firsts], matches[firsts]
            again = firsts != np.arange(len(token))
            if held is not None:
                if held[0] == token[0]:  # the list goes on
                    end = starts[1] if len(starts) > 1 else len(token)
                    first = np.append(np.full(end, held[4]), first[end:])
                    first_n = np.append(np.full(end, held[5]), first_n[end:])
                    first_matches = np.append(np.full(end, held[6]), first_matches[end:])
                    again = again | (np.arange(len(token)) < end)
                if held[0] == token[0] or held[7]:
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(held[:7], kinds, strict=True)], names=names)
            several = again | np.append(again[1:], False)
            keep = np.flatnonzero(several[:-1])
            if len(keep):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep], t) for x, t in zip((token, doc, n, matches, first, first_n, first_matches), kinds, strict=True)],
                    names=names,
                )
            held = (token[-1], doc[-1], n[-1], matches[-1], first[-1], first_n[-1], first_matches[-1], bool(again[-1]))
        if held is not None and held[7]:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(held[:7], kinds, strict=True)], names=names)

    names = ["token", "doc", "n", "matches", "first", "first_n", "first_matches"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    entries = represented.select("doc_id", "n", "matches", "prefix").mapInArrow(unfold, "token long, doc long, n long, matches int")
    return entries.repartition("token").sortWithinPartitions("token", "doc").mapInArrow(shared, LISTS)


def sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc, items): the sets of the documents with the given ids."""
    few = ids.count() <= BROADCAST_IDS
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                items = [s.tobytes() for s in shingle_sets(part.column("text"), size)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(items, pa.binary())], names=["doc", "items"])

    return chosen.mapInArrow(run, "doc long, items binary")


def linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets link.

    Only documents in pairs have their sets computed.  A set `a` meets its `b`s in blocks of
    about BLOCK, so an `a` with many of them is dealt to many tasks.
    """
    pairs = staged(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = sets_of(docs, staged(ids, "pair-ids"), size).dropDuplicates(["doc"])
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    dealt = pairs.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    dealt = dealt.alias("p")
    members = dealt.join(sets, F.col("b") == F.col("doc")).select("a", "block", F.lit(1).alias("role"), "b", "items")
    heads = (
        blocks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        .join(sets, F.col("a") == F.col("doc"))
        .select("a", "block", F.lit(0).alias("role"), F.col("a").alias("b"), "items")
    )
    rows = heads.unionByName(members).repartition("a", "block").sortWithinPartitions("a", "block", "role")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            found_a, found_b = [], []
            for a, role, b, items in zip(*(batch.column(c) for c in ("a", "role", "b", "items")), strict=True):
                own = np.frombuffer(items.as_buffer(), dtype=np.uint64)
                if role.as_py() == 0:
                    head = own.copy()
                    continue
                at = np.searchsorted(head, own)
                at[at == len(head)] = 0
                common = int((head[at] == own).sum())
                if 100 * common >= percent * (len(head) + len(own) - common):
                    found_a.append(a.as_py())
                    found_b.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(verify, "a long, b long")


def fits(percent: int):
    """Sizes that linked sets can have."""
    low, high = F.least("n", "other_n"), F.greatest("n", "other_n")
    return 100 * low >= percent * high


def may_link(percent: int, shared: Column | None = None) -> Column:
    """Whether sets that share at most `shared` prefix shingles can link.

    A common shingle outside both prefixes lies behind the prefix that ends first, so the overlap is
    at most `shared` and what is behind one of the prefixes.
    """

    most = (F.col("shared") if shared is None else shared) + most_behind(percent)
    return (100 + percent) * most >= percent * (F.col("n") + F.col("other_n"))


def most_behind(percent: int) -> Column:
    """What two sets can share behind their prefixes."""

    def behind(n: str, matches: str) -> Column:
        return F.floor((F.col(n) * percent + 99) / 100) - F.col(matches)

    return F.greatest(behind("n", "matches"), behind("other_n", "other_matches"))


def least_shared(percent: int) -> Column:
    """The prefix shingles that two sets have to share at least."""
    overlap = F.floor((percent * (F.col("n") + F.col("other_n")) + 99 + percent) / (100 + percent))
    return F.greatest(F.least("matches", "other_matches"), overlap - most_behind(percent))


def first_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): of every document the FIRSTS first documents it shares most lists with.

    A first document may share further lists, in which another is the first.  So pairs that could
    link may be left out here; step 5 finds them.
    """
    shared = (
        entries.where("doc <> first")
        .withColumnRenamed("first_n", "other_n").withColumnRenamed("first_matches", "other_matches")
        .where(fits(percent))
        .groupBy("doc", "first", "n", "matches", "other_n", "other_matches").agg(F.sum("weight").alias("shared"))
        .where(may_link(percent))
    )
    best = Window.partitionBy("doc").orderBy(F.desc("shared"), "first")
    return shared.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= FIRSTS).select(
        F.col("first").alias("a"), F.col("doc").alias("b")
    )


def most_shared() -> Column:
    """What two documents can share at most in open lists.

    Shingles of both cancel out in the sum of their bitmaps, so each bit left there is a shingle that only
    one has: they share at most half of what remains of their entries.
    """
    apart = sum((F.bit_count(F.col(f"bits{w}").bitwiseXOR(F.col(f"other_bits{w}"))) for w in range(WORDS)), F.lit(0))
    return F.least("entries", "other_entries", F.floor((F.col("entries") + F.col("other_entries") - apart) / 2))


def sets_may_link(percent: int) -> Column:
    """Whether whole sets can link: each bit left in the sum of their bitmaps is a shingle that only one has."""
    apart = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"other_{s}"))) for s in SKETCH), F.lit(0))
    both = F.col("n") + F.col("other_n")
    return F.coalesce((100 + percent) * (both - apart) >= 2 * percent * both, F.lit(True))


def with_sketches(entries: DataFrame, represented: DataFrame) -> DataFrame:
    """The entries with SKETCH, null where an id stands for several sets of one size."""
    several = F.count("*") > 1
    sketches = represented.groupBy(F.col("doc_id").alias("doc"), "n", "matches").agg(
        *[F.when(~several, F.first(s)).alias(s) for s in SKETCH]
    )
    return entries.join(sketches, ["doc", "n", "matches"])


def open_lists(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries with their components, of lists that hold two components or more.

    Lists of the same documents, as groups of copies have many, are one, `weight` tells of how many shingles.
    """
    named = entries.join(labels, F.col("doc") == F.col("id"), "left").select(
        "token", "doc", "n", "matches", F.coalesce("component", "doc").alias("component")
    )
    # Sums of 32 bits: what a list holds, whatever the order, in 96 bits and its length.
    held = [F.sum(F.xxhash64(F.lit(i), "doc", "n", "matches").bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"held{i}") for i in range(3)]
    several = (
        named.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("length"), *held)
        .where("low < high")
    )
    bit = F.expr("shiftleft(1L, cast(shiftright(token, 40) & 63 AS int))")
    word = F.expr(f"pmod(shiftright(token, 46), {WORDS})")
    none = F.lit(0).cast("long")
    bits = [f"bits{w}" for w in range(WORDS)]
    alike = several.groupBy("length", "held0", "held1", "held2").agg(
        F.min("token").alias("token"), F.count("*").alias("weight"),
        *[F.bit_xor(F.when(word == w, bit).otherwise(none)).alias(b) for w, b in enumerate(bits)],
    ).select("token", "weight", *bits)
    # `entries`: in how many open lists a document is, which bounds what it shares with any other.
    # `ahead`: of how many shingles its lists are from this one on, this one included.
    # `bits`: the parity of its shingles there in each of 64 * WORDS bits.
    own = Window.partitionBy("doc")
    return named.join(alike, "token").select(
        "token", "doc", "n", "matches", "component", "weight",
        F.sum("weight").over(own).alias("entries"),
        F.sum("weight").over(own.orderBy(F.desc("token"))).alias("ahead"),
        *[F.bit_xor(b).over(own).alias(b) for b in bits],
    )


def pivots(entries: DataFrame, round_number: int) -> DataFrame:
    """The open lists with another first document each."""
    draw = F.min(F.struct(F.xxhash64("doc", F.lit(round_number)).alias("h"), "doc", "n", "matches", "component")).alias("pivot")
    chosen = entries.groupBy("token").agg(draw)
    return entries.join(chosen, "token").where("component <> pivot.component").select(
        "token", "doc", "n", "matches", "weight",
        F.col("pivot.doc").alias("first"), F.col("pivot.n").alias("first_n"), F.col("pivot.matches").alias("first_matches"),
    )


def open_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of different components that share as many prefix shingles as they must.

    Two documents that share `least_shared` or more have, at their first common lists, that many shingles
    ahead.  So they are paired at the first lists only, until they have as many matches as they ask for.
    """
    bits = [f"bits{w}" for w in range(WORDS)]
    both = ["n", "matches", "component", "entries", "ahead", *bits, *SKETCH]
    left = entries.select("token", F.col("doc").alias("a"), "weight", *both)
    right = entries.select("token", F.col("doc").alias("b"), *[F.col(c).alias(f"other_{c}") for c in both])
    least, asked = least_shared(percent), F.least("matches", "other_matches")
    possible = (
        fits(percent) & (F.least("ahead", "other_ahead") > least - asked) & (most_shared() >= least) & sets_may_link(percent)
    )
    pairs = left.join(right, "token").where((F.col("a") < F.col("b")) & (F.col("component") != F.col("other_component")) & possible)
    counted = pairs.groupBy("a", "b", "n", "matches", "other_n", "other_matches").agg(F.sum("weight").alias("shared"))
    return counted.where(F.col("shared") >= asked).select("a", "b")


def _pair_count(entries: DataFrame) -> tuple[int, int]:
    """Number of entries of open lists, and of pairs of different components in them."""
    by_component = entries.groupBy("token", "component").agg(F.count("*").alias("c"))
    by_list = by_component.groupBy("token").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    row = by_list.agg(F.sum("s").alias("entries"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs")).first()
    return int(row["entries"] or 0), int(row["pairs"] or 0)


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: of every row of `docs`."""
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":
        raise TypeError("doc_id must be a bigint")
    documents = staged(prefixes(docs, size, percent), "prefixes")
    represented = staged(representatives(documents), "representatives")
    entries = staged(lists(represented), "lists")
    links = staged(linked(first_pairs(entries.withColumn("weight", F.lit(1)), percent), docs, size, percent), "linked")
    labels = components(links)
    before = None
    for round_number in range(PIVOT_ROUNDS + 1):
        left = staged(open_lists(entries, labels), "open")
        count, pairs = _pair_count(left)
        if not pairs:
            break
        # A round that leaves more than half of the pairs shows that they are no near copies.
        idle = before is not None and 2 * pairs > before
        last = pairs <= OPEN_PAIRS * count or round_number == PIVOT_ROUNDS or idle
        before = pairs
        candidates = open_pairs(with_sketches(left, represented), percent) if last else first_pairs(pivots(left, round_number), percent)
        links = links.unionByName(staged(linked(candidates, docs, size, percent), "linked"))
        labels = components(links)
        if last:
            break
    classes = represented.select("digest", F.col("doc_id").alias("representative")).join(
        labels, F.col("representative") == F.col("id"), "left"
    ).select("digest", F.coalesce("component", "representative").alias("component"))
    # The smallest id of a component is a representative: it is the smallest of its equals.
    return documents.join(classes, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )
