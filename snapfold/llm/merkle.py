"""Merkle manifest of a dataset: one digest for the whole, and a proof for every row.

A row is a leaf: the SHA-256 of its values, each `-` if null, else its UTF-8 byte count, `:` and
the value.  In every group (a language) the leaves ascend by id; every FAN consecutive nodes, the last
run fewer, become the SHA-256 of their hex digests, until one remains: the group's subroot.
Subroots, ordered by group (null first, then by bytes), come to the root in the same way.

Nodes live in a content-addressed store of digest-to-children records.  Records are kept
together by blocks, the subtrees of FAN ** LEVELS members, so that a task holds the
records of one block and never a whole tree.

* `build` numbers the leaves (a range sort, counts per range and group, their running sums) and
  builds the blocks; the digests of blocks are the members of the blocks above, until a
  group has one block.
* `prove` answers one request per leaf.  A request goes down from the root: the digits of its
  rank to base FAN choose a child in every record, and the children not chosen are
  collected; this path segment is reversed, and the segments of the blocks above follow it.  All
  requests below a block share its path from the root, which is found once.

Rows without an id come first.  Equal ids are ordered by digest; rows equal throughout are
leaves each.  Null and empty texts are different leaves.  Columns other than the named ones
are ignored.  An empty table has no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.staging import staged

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
#: Paths of up to so many blocks (about 2 kB each) are broadcast; beyond that they are shuffled.
BROADCAST_PATHS = 20_000
#: So many runs of a group in one range are broadcast to number the leaves; beyond that likewise.
BROADCAST_RUNS = 200_000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

BLOCKS = (
    "grp bigint, block bigint, digest binary, ids array<bigint>, members array<binary>, others array<binary>, "
    "records array<struct<digest: binary, children: array<binary>>>"
)
PATHS = "grp bigint, block bigint, subroot binary, siblings array<string>, digits array<int>"
PROOFS = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values with their byte counts, as 32 bytes."""

    def sized(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*map(sized, values)), 256))


def digest_of(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def runs_up(members: list[bytes], levels: int | None) -> tuple[bytes, list[tuple[bytes, list[bytes]]]]:
    """The digest of the members after so many levels (None: until one remains), and the records made."""
    records, done = [], 0
    while done < levels if levels is not None else len(members) > 1:
        parents = []
        for at in range(0, len(members), FAN):
            children = members[at : at + FAN]
            parents.append(digest_of(children))
            records.append((parents[-1], children))
        members, done = parents, done + 1
    return members[0], records


def depth_of(n: int, whole: bool) -> int:
    """Levels of records in a block of n members; `whole`: it is a tree of its own."""
    if not whole:
        return LEVELS
    depth = 0
    while FAN**depth < n:
        depth += 1
    return depth


def descend(store: dict[bytes, list[bytes]], top: bytes, index: int, depth: int) -> tuple[bytes, list[str], list[int]]:
    """From `top` by the digits of `index`: the member reached, and per level, the lowest first, the hex
    digests of the children not chosen and the digit."""
    node, siblings, digits = top, [], []
    for level in range(depth - 1, -1, -1):
        children = store[node]
        digit = index // FAN**level % FAN
        siblings.append("".join(c.hex() for at, c in enumerate(children) if at != digit))
        digits.append(digit)
        node = children[digit]
    return node, siblings[::-1], digits[::-1]


def fold(leaf: bytes, siblings: list[str], digits: list[int]) -> bytes:
    """The root that a leaf and a path come to."""
    node = leaf
    for others, digit in zip(siblings, digits, strict=True):
        at = 64 * digit
        node = hashlib.sha256((others[:at] + node.hex() + others[at:]).encode()).digest()
    return node


@dataclass(frozen=True)
class Manifest:
    """Blocks of the groups' trees and of the tree of subroots, the lowest level first."""

    groups: list[DataFrame]
    top: list[DataFrame]
    languages: DataFrame

    def records(self) -> DataFrame:
        """The store: digest and children (hex) of every node that has children."""
        found = None
        for blocks in [*self.groups, *self.top]:
            part = blocks.select(F.explode("records").alias("r")).select(
                F.lower(F.hex("r.digest")).alias("digest"), F.transform("r.children", lambda c: F.lower(F.hex(c))).alias("children")
            )
            found = part if found is None else found.unionByName(part)
        return found.distinct()

    def root(self) -> str | None:
        row = self.top[-1].select(F.lower(F.hex("digest")).alias("root")).first()
        return row and row["root"]


def _blocks(members: DataFrame) -> DataFrame:
    """(grp, rank, size, id, member, other) -> BLOCKS; `size` is the number of members of the group."""
    dealt = members.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("long"))
    rows = dealt.repartition("grp", "block").sortWithinPartitions("grp", "block", "rank")
    names = ["grp", "block", "digest", "ids", "members", "others", "records"]
    record = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(record)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        key, size, ids, found, others = None, 0, [], [], []

        def close() -> None:
            if key is not None:
                digest, records = runs_up(found, None if size <= BLOCK else LEVELS)
                made.append((*key, digest, ids, found, others, [{"digest": d, "children": c} for d, c in records]))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=names
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("grp", "block", "size", "id", "member", "other")]
            for grp, block, n, own, member, other in zip(*columns, strict=True):
                if (grp, block) != key:
                    close()
                    key, size, ids, found, others = (grp, block), n, [], [], []
                    if len(made) >= 64:
                        yield out()
                        made.clear()
                ids.append(own)
                found.append(member)
                others.append(other)
        close()
        if made:
            yield out()

    return rows.select("grp", "block", "size", "id", "member", "other").mapInArrow(build, BLOCKS)


def _tree(members: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks level by level, and (grp, digest) of every tree."""
    levels, finished = [], None
    while True:
        blocks = staged(_blocks(members), name)
        levels.append(blocks)
        counted = blocks.select("grp", "block", "digest").join(
            blocks.groupBy("grp").agg(F.count("*").alias("size")), "grp"
        )
        done = counted.where("size = 1").select("grp", "digest")
        finished = done if finished is None else finished.unionByName(done)
        left = counted.where("size > 1")
        if not left.limit(1).count():
            return levels, staged(finished, f"{name}-roots")
        nothing = F.lit(None)
        members = left.select(
            "grp", F.col("block").alias("rank"), "size", nothing.cast("long").alias("id"),
            F.col("digest").alias("member"), nothing.cast("binary").alias("other"),
        )


def _bounded(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, id, member, other) -> (grp, rank, size, id, member, other), and the groups (grp, lang).

    Ranges of (lang, id) are sorted and written; the number of rows of a group in earlier ranges
    is what a range adds to its own count.  No window runs over the rows themselves.
    """
    at = F.monotonically_increasing_id()
    ordered = staged(
        leaves.repartitionByRange(F.col("lang").asc_nulls_first(), F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("lang").asc_nulls_first(), F.col("id").asc_nulls_first(), "member")
        .select("*", F.shiftright(at, 33).alias("part"), at.alias("at")),
        "merkle-ordered",
    )
    runs = ordered.groupBy("part", "lang").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    languages = staged(
        runs.select("lang").distinct().select(
            "lang", (F.row_number().over(Window.orderBy(F.col("lang").asc_nulls_first())) - 1).cast("long").alias("grp")
        ),
        "merkle-groups",
    )
    earlier = Window.partitionBy("grp").orderBy("part")
    runs = runs.withColumnRenamed("lang", "run_lang").join(languages, F.col("run_lang").eqNullSafe(F.col("lang"))).select(
        F.col("part").alias("run_part"), "run_lang", "grp",
        (F.sum("n").over(earlier) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("grp")).alias("size"),
    )
    runs = _bounded(staged(runs, "merkle-runs"), BROADCAST_RUNS)
    same = (F.col("part") == F.col("run_part")) & F.col("lang").eqNullSafe(F.col("run_lang"))
    found = ordered.join(runs, same).select(
        "grp", (F.col("at") + F.col("shift")).alias("rank"), "size", "id", "member", "other"
    )
    return found, languages


def build(docs: DataFrame, altered: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS,
          group: str = "lang", order: str = "doc_id") -> Manifest:
    """The manifest of the named columns of all rows.

    `altered` replaces columns in a second digest of the rows, kept beside the leaf: what
    `prove` checks against the manifest.  Null values of it mean that the row is as it was.
    """
    changed = {c: F.coalesce(v, F.col(f"`{c}`")) for c, v in (altered or {}).items()}
    touched = F.lit(False)
    for value in (altered or {}).values():
        touched = touched | value.isNotNull()
    other = leaf_digest([changed.get(c, F.col(f"`{c}`")) for c in columns])
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("lang"), F.col(f"`{order}`").cast("long").alias("id"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("member"), F.when(touched, other).alias("other"),
    )
    members, languages = numbered(staged(leaves, "merkle-leaves"))
    groups, subroots = _tree(members, "merkle-blocks")
    n = languages.count()
    nothing = F.lit(None)
    tops = subroots.select(
        F.lit(0).cast("long").alias("grp"), F.col("grp").alias("rank"), F.lit(n).cast("long").alias("size"),
        nothing.cast("long").alias("id"), F.col("digest").alias("member"), nothing.cast("binary").alias("other"),
    )
    top, _ = _tree(tops, "merkle-top")
    return Manifest(groups, top, languages)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks one by one, so that a batch of them is never unfolded as a whole."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _paths(blocks: DataFrame, above: DataFrame, of_groups: bool) -> DataFrame:
    """The paths from the root of all members of the blocks, given those of the blocks themselves.

    `of_groups`: the members are subroots, and their paths are those of the groups' highest blocks.
    """
    names = [f.name for f in above.schema]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            store = {r["digest"]: r["children"] for r in row["records"]}
            depth = depth_of(len(row["members"]), row["whole"])
            made = []
            for index in range(len(row["members"])):
                member, siblings, digits = descend(store, row["digest"], index, depth)
                at = row["block"] * BLOCK + index
                path = siblings + row["siblings"], digits + row["digits"]
                made.append((at, 0, member, *path) if of_groups else (row["grp"], at, row["subroot"], *path))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    return _with_paths(blocks, above).mapInArrow(run, PATHS)


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks next to their own paths; `whole`: the block is the only one of its group."""
    counts = blocks.groupBy("grp").agg((F.count("*") == 1).alias("whole"))
    return blocks.join(_bounded(above.join(counts, "grp"), BROADCAST_PATHS), ["grp", "block"])


def prove(manifest: Manifest) -> DataFrame:
    """PROOFS of every leaf: the digest of the siblings on its path, the lowest first, and the root that the
    altered leaf (the leaf, where nothing was altered) comes to with them."""
    root = manifest.root()
    spark = manifest.languages.sparkSession
    if root is None:
        return spark.createDataFrame([], PROOFS)
    above = spark.createDataFrame([(0, 0, None, [], [])], PATHS)
    for at, blocks in reversed(list(enumerate(manifest.top))):
        above = staged(_paths(blocks, above, of_groups=at == 0), "merkle-paths")
    for at, blocks in reversed(list(enumerate(manifest.groups))):
        if at:
            # Trees that end below this level have their paths from above already.
            lower = staged(_paths(blocks, above, of_groups=False), "merkle-paths")
            high = blocks.select("grp").distinct()
            above = staged(lower.unionByName(above.join(high, "grp", "left_anti")), "merkle-paths")
    names = [f.split()[0] for f in PROOFS.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            store = {r["digest"]: r["children"] for r in row["records"]}
            depth = depth_of(len(row["members"]), row["whole"])
            high, subroot = "".join(row["siblings"]), row["subroot"].hex()
            made = []
            for index, (own, other) in enumerate(zip(row["ids"], row["others"], strict=True)):
                leaf, siblings, digits = descend(store, row["digest"], index, depth)
                proof = hashlib.sha256(("".join(siblings) + high).encode()).hexdigest()
                folded = fold(other or leaf, siblings + row["siblings"], digits + row["digits"]).hex()
                made.append((own, leaf.hex(), subroot, root, proof, folded, folded == root))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    return _with_paths(manifest.groups[0], above).mapInArrow(run, PROOFS)
