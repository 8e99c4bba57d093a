"""Line deduplication against levelled sorted runs of line hashes.

`LineRuns` remembers the lines seen so far as sorted runs of 128-bit hashes, bucketed and
sorted by hash in the shared folder.  `add` takes the next batch of documents: its lines
are merge-anti-joined with every run, which tells the lines that earlier batches
hold; of the new ones the smallest doc_id of the batch keeps its lines; the new hashes
become a run at level 0.  When a level holds `fan` runs they are compacted into one run
of the next level, so there are few runs to join at any time, and a hash is rewritten once
per level.  Runs are bucketed on the hash: joining them shuffles the batch only.

Batches must come in ascending doc_id order; then what stays is the first holder overall.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased.
Keys of at least `min_chars` code points count.  Null and empty texts are one empty line,
whose key is too short.  Lines repeated inside the first holder stay.  Rows with the
same doc_id count as one holder.  An empty batch changes nothing.  Other columns are
carried along, whatever their names.

Everything is DataFrame expressions.  A key that a third of all documents hold is reduced
map-side to one row per task before it is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm.staging import new_folder, staged
from snapfold.llm.textcols import lower_ascii, stripped

MIN_CHARS = 10
BATCHES = 4
FAN = 2


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, line (from 0), h1, h2: the lines long enough to count, by 128-bit hash."""
    key = lower_ascii(stripped(F.col("__line")))
    return (
        docs.select("doc_id", F.posexplode(lines(F.col("text"))).alias("line", "__line"))
        .select("doc_id", "line", key.alias("__key"))
        .where(F.char_length("__key") >= min_chars)
        .select("doc_id", "line", F.xxhash64("__key").alias("h1"), F.xxhash64(F.lit(1), "__key").alias("h2"))
    )


class LineRuns:
    """The runs of one corpus.  The folder belongs to this object; one writer at a time."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None, fan: int = FAN):
        self.spark = spark
        self.folder = folder or new_folder(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fan = fan
        self.levels: list[list[str]] = []

    def runs(self) -> list[str]:
        """Catalog tables of all runs, the largest first."""
        return [run for level in reversed(self.levels) for run in level]

    def _write(self, hashes: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        (
            hashes.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        )
        self.levels[level].append(name)

    def _compact(self) -> None:
        at = 0
        while at < len(self.levels):
            if len(self.levels[at]) >= self.fan:
                old, self.levels[at] = self.levels[at], []
                merged = self.spark.table(old[0])
                for run in old[1:]:
                    merged = merged.unionAll(self.spark.table(run))
                self._write(merged, at + 1)
                for run in old:
                    self.spark.sql(f"DROP TABLE {run}")
            at += 1

    def add(self, keys: DataFrame) -> DataFrame:
        """Remember the batch; returns (doc_id, line) of the lines of the batch that are to go.

        `keys`: what `line_keys` gives, as a written table, for it is read twice.
        """
        holders = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        fresh = holders.repartition(self.buckets, "h1", "h2")
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run).hint("merge"), ["h1", "h2"], "left_anti")
        fresh = staged(fresh, "line-fresh")
        # Keys that only one document of the corpus so far holds need no further look.
        only = fresh.where("first = last").select("h1", "h2")
        shared = fresh.where("first < last").select("h1", "h2", "first")
        seen = holders.join(fresh.select("h1", "h2"), ["h1", "h2"], "left_anti").select(
            "h1", "h2", F.lit(None).cast(holders.schema["first"].dataType).alias("first")
        )
        losing = shared.unionByName(seen)
        dropped = (
            keys.join(losing, ["h1", "h2"])
            .where(F.col("first").isNull() | (F.col("doc_id") > F.col("first")))
            .select("doc_id", "line")
        )
        dropped = staged(dropped, "line-dropped")
        self._write(only.unionByName(shared.select("h1", "h2")), 0)
        self._compact()
        return dropped

    def close(self) -> None:
        """Forget the runs."""
        for run in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        self.levels = []


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Doc_ids that cut the table into batches of about equal size."""
    found = docs.select(
        F.percentile_approx("doc_id", F.array(*[F.lit(i / batches) for i in range(1, batches)]), F.lit(1000)).alias("at")
    ).first()["at"]
    return sorted(set(found or []))


def repeated_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS, fan: int = FAN) -> DataFrame:
    """(doc_id, line) of all lines that go, by adding the table batch by batch."""
    spark = docs.sparkSession
    bounds = batch_bounds(docs, batches)
    number = sum((F.when(F.col("doc_id") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    keys = line_keys(docs.where("doc_id IS NOT NULL"), min_chars).withColumn("batch", number)
    folder = new_folder(spark, "line-keys")
    keys.write.partitionBy("batch").option("compression", "zstd").parquet(folder)
    written = spark.read.schema(keys.schema).parquet(folder)
    runs = LineRuns(spark, fan=fan)
    gone = None
    for at in range(len(bounds) + 1):
        dropped = runs.add(written.where(F.col("batch") == at).drop("batch"))
        gone = dropped if gone is None else gone.unionByName(dropped)
    runs.close()
    return gone


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with `text` freed of repeated lines, plus n_lines and n_dropped.

    Where `docs` has columns of those names they are replaced.  Rows without a
    doc_id keep all their lines.
    """
    gone = repeated_lines(docs, **options).groupBy("doc_id").agg(F.collect_set("line").alias("__gone"))
    gone = gone.select(F.col("doc_id").alias("__doc"), "__gone")
    parts = lines(F.col("text"))
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The list of lines to go is small beside the texts: hashed, so the texts need no sort.
    rows = docs.select(*[f"`{c}`" for c in others]).join(
        gone.hint("shuffle_hash"), F.col("doc_id") == F.col("__doc"), "left"
    )
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("__gone", i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    return rows.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in others],
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
