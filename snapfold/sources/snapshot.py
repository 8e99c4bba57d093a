"""Snapshot CSV scan: quoted multi-line fields, all columns as text."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from snapfold import schemas
from snapfold.operators.conform import normalise_nulls
from snapfold.session import scratch_dir
from snapfold.sources import records as record_tasks

# Executors get the task code with the plan; the package need not be installed there.
cloudpickle.register_pickle_by_value(record_tasks)

_CSV = {"quote": '"', "escape": '"', "lineSep": "\n"}
_SURPLUS = "_surplus"

# Longest record; a longer one is taken for a lost quote, wherever it lies.
MAX_RECORD = 128 * 1024 * 1024

# What is known of up to this many splits (about 100 bytes each) is broadcast.
MAX_BROADCAST_SPLITS = 500_000

# Splits of a file are summed up in blocks of about so many, and then the blocks.
BLOCK_SPLITS = 256

# A task takes as many whole splits as make up this much text, where cores are busy all the same.
TASK_BYTES = 32 * 1024 * 1024

# Tables of pieces are read back in splits of at least this size.
LEAST_READ_BYTES = 4 * 1024 * 1024

_OPEN_QUOTE = "snapshot file that ends inside quotes (a quote is missing?)"
_TOO_LONG = "snapshot record too long (a quote is missing?)"

_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40}


def read_snapshot(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = schemas.SNAPSHOT_COLUMNS,
    na_tokens: tuple[str, ...] = schemas.NA_TOKENS,
) -> DataFrame:
    """The named columns of a snapshot file, folder, glob or list of them, as text.

    Columns are found by header name; others are ignored.  Short rows are filled
    with NULL.  Lines end in LF or CRLF, also within one file; line ends inside quotes
    are kept as they are.  The load aborts, whatever the size of a file and
    wherever it is cut, on surplus values, on a file with another header, on a quote that
    is not closed at the end of its file, on quotes inside unquoted fields that put
    lines together, and on records of more than MAX_RECORD characters.

    A file with multi-line fields cannot be cut at just any line break.  Files are
    read in splits all the same, and their records put together: the text is read here,
    once, into a table in the scratch folder, of which the result is a view.
    """
    return scan_snapshot(spark, path, columns, na_tokens)[0]


def scan_snapshot(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = schemas.SNAPSHOT_COLUMNS,
    na_tokens: tuple[str, ...] = schemas.NA_TOKENS,
) -> tuple[DataFrame, str]:
    """``read_snapshot``, and the folder that may be deleted when its rows have been taken."""
    paths = [path] if isinstance(path, str) else list(path)
    try:
        header = spark.read.options(**_CSV, header=True, multiLine=True).csv(paths).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"snapshot not found: {', '.join(paths)}") from error
        raise
    header = [name.rstrip("\r") for name in header]
    absent = [c for c in columns if c not in header]
    if absent:
        raise ValueError(f"snapshot has no column {', '.join(absent)}")
    folder = scratch_dir(spark, f"snapshot-{uuid.uuid4().hex[:12]}")
    rows = _read_in_splits(spark, paths, header, folder)
    return normalise_nulls(rows.select(*columns), na_tokens), folder


def _split_bytes(spark: SparkSession) -> int:
    """The input split size that is set, in bytes."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    number = size.rstrip("bkmgt")
    return int(number) << _UNITS[size[len(number) :]]


def _text_schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def _require(condition: Column, value: Column, message: str) -> Column:
    """``value``; a row where ``condition`` does not hold aborts the load."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def _several_splits(lines: DataFrame) -> DataFrame:
    """The same splits, each in one piece and in order, in tasks of TASK_BYTES instead of one for each.

    A task has its price (a Python worker's turn, a file of pieces that every later step opens), which
    small splits would pay once each.  At least three tasks per core remain.
    """
    spark = lines.sparkSession
    n_splits = lines.rdd.getNumPartitions()
    by_size = -(-n_splits * _split_bytes(spark) // TASK_BYTES)
    n_tasks = max(by_size, 3 * spark.sparkContext.defaultParallelism)
    return lines.coalesce(n_tasks) if n_tasks < n_splits else lines


def _line_breaks(text: Column) -> Column:
    # In bytes, which a text knows the number of; characters would be counted anew.
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))


def _without_last_cr(text: Column) -> Column:
    cut = F.substring(text, F.lit(1), F.length(text) - 1)
    return F.when(F.endswith(text, F.lit("\r")), cut).otherwise(text)


def _read_back(spark: SparkSession, schema, folder: str) -> DataFrame:
    """A table written here, in file splits that do not follow those set for the text."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", f"{max(_split_bytes(spark), LEAST_READ_BYTES)}b")
    rows = own.read.schema(schema).parquet(folder)
    nothing = ", ".join(f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in rows.dtypes)
    # A union belongs to the session of its first part, which is empty and planned away.
    return spark.sql(f"SELECT {nothing} WHERE false").unionByName(rows)


def start_states(splits: DataFrame, block_bytes: int) -> DataFrame:
    """(file, start, quotes, made, sent) -> the same with ``inside``: whether a split begins inside quotes.

    A line starts a record iff an even number of quotes precedes it in its file.  The quotes
    before a split are those of earlier splits in its block, and those of earlier blocks of the
    file: no task sees all splits of a file.  A file that ends inside quotes aborts.
    """
    odd = (F.col("quotes") % 2).alias("odd")
    dealt = splits.select("*", odd, F.floor(F.col("start") / block_bytes).alias("block"))
    inner = Window.partitionBy("file", "block").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("file", "block").agg(F.sum("odd").alias("in_block"))
    blocks = blocks.select(
        "file",
        "block",
        F.coalesce(F.sum("in_block").over(outer), F.lit(0)).alias("before"),
        F.sum("in_block").over(Window.partitionBy("file")).alias("in_file"),
    )
    inside = (F.coalesce(F.sum("odd").over(inner), F.lit(0)) + F.col("before")) % 2 == 1
    closed = F.when(F.col("in_file") % 2 == 0, inside).otherwise(
        F.raise_error(F.lit(_OPEN_QUOTE)).cast("boolean")
    )
    return dealt.join(blocks, ["file", "block"]).select(*splits.columns, closed.alias("inside"))


def join_fragments(fragments: DataFrame, block_bytes: int) -> DataFrame:
    """(file, start, head, is_header, fragment) -> the records (is_header, text) they make.

    A fragment that is no head begins a record; the heads after it continue it.  Where
    that is in another block of the file, the earlier blocks' last beginning tells.
    """
    begun = F.when(~F.col("head"), F.col("start"))
    dealt = fragments.select("*", begun.alias("begun"), F.floor(F.col("start") / block_bytes).alias("block"))
    inner = Window.partitionBy("file", "block").orderBy("start", F.desc("head"))
    outer = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("file", "block").agg(F.max("begun").alias("last"))
    blocks = blocks.select("file", "block", F.max("last").over(outer).alias("earlier"))
    # Starts ascend along a file, so the greatest beginning so far is the last.
    here = F.max("begun").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    along_record = Window.partitionBy("file", "record").orderBy("start")
    return (
        dealt.withColumn("here", here)
        .join(blocks, ["file", "block"])
        .withColumn("record", F.coalesce("here", "earlier"))
        .withColumn("length", F.sum(F.length("fragment")).over(along_record))
        .withColumn("fragment", _require(F.col("length") <= MAX_RECORD, F.col("fragment"), _TOO_LONG))
        .groupBy("file", "record")
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "fragment"))).alias("parts"),
            F.max("is_header").alias("is_header"),
        )
        .select("is_header", F.array_join(F.col("parts.fragment"), "\n").alias("text"))
    )


def _read_in_splits(spark: SparkSession, paths: list[str], header: list[str], folder: str) -> DataFrame:
    """Records of quoted CSV, put together from lines read in independent splits.

    One pass over the text puts the lines of every split together, in file order and without
    a shuffle, for the state that the split seems to begin in (for both while that is
    open), and counts quotes.  The counts tell the true states.  Splits followed in the wrong
    state are read again; that takes quotes in unquoted fields.  The one record that
    neighbouring splits may share is put together afterwards: at most two fragments per split.
    """
    split = ["file", "start"]
    lines = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )
    block_bytes = BLOCK_SPLITS * _split_bytes(spark)
    dealt = _several_splits(lines.select(*split, "line"))
    dealt.mapInArrow(record_tasks.assemble, record_tasks.PIECES).write.parquet(f"{folder}/pieces")
    pieces = _read_back(spark, record_tasks.PIECES, f"{folder}/pieces")

    seen = Observation()
    splits = pieces.where(F.col("quotes").isNotNull()).select(*split, "quotes", "made", "sent")
    own = F.when(F.col("inside"), 2).otherwise(1)
    wrong = F.col("made").bitwiseAND(own) == 0
    doubtful = wrong | (F.col("sent") != own) & (F.col("sent") != 0)
    states = start_states(splits, block_bytes).select(*split, "inside", wrong.alias("wrong"), doubtful.alias("doubtful"))
    states.observe(seen, F.count_if("doubtful").alias("doubtful"), F.count_if("wrong").alias("wrong")).write.parquet(
        f"{folder}/states"
    )
    states = _read_back(spark, states.schema, f"{folder}/states")
    n_doubtful, n_wrong = (seen.get[name] for name in ("doubtful", "wrong"))

    def known(rows: DataFrame, n: int) -> DataFrame:
        return F.broadcast(rows) if n <= MAX_BROADCAST_SPLITS else rows

    chosen = pieces.where(F.col("quotes").isNull())
    if n_doubtful:
        # All other splits were followed in one state, the true one.
        told = states.where("doubtful").select(*split, F.when(~F.col("wrong"), F.col("inside").cast("int")).alias("state"), "doubtful")
        chosen = chosen.join(known(told, n_doubtful), split, "left").where(
            F.col("doubtful").isNull() | (F.col("variant") == F.col("state"))
        )
    chosen = chosen.select(*split, "is_header", "text", "head", "fragment")
    if n_wrong:
        located = lines.join(known(states.where("wrong").select(*split, "inside"), n_wrong), split)
        if n_wrong > MAX_BROADCAST_SPLITS:
            located = located.repartition(*split).sortWithinPartitions(*split, "pos")
        again = located.select(*split, "inside", "line").mapInArrow(record_tasks.assemble, record_tasks.PIECES)
        chosen = chosen.unionByName(again.where(F.col("quotes").isNull()).select(*chosen.columns))
    shared = join_fragments(
        chosen.where(F.col("fragment").isNotNull()).select(*split, "head", "is_header", "fragment"), block_bytes
    )
    records = chosen.where(F.col("text").isNotNull()).select("is_header", "text").unionByName(shared)

    parsed = records.withColumn("text", _without_last_cr(F.col("text"))).select(
        "is_header",
        F.from_csv("text", _text_schema([*header, _SURPLUS]), _CSV).alias("row"),
        (F.col("text") == "").alias("is_blank"),
        ((F.octet_length("text") <= MAX_RECORD) | (F.length("text") <= MAX_RECORD)).alias("is_short"),
        _line_breaks(F.col("text")).alias("line_breaks"),
    )
    same_header = F.to_json("row") == F.to_json(
        F.struct(*[F.lit(name).alias(name) for name in header])
    )
    # A quote inside an unquoted field puts lines together that do not belong together;
    # what follows the first of them would be lost.
    values = F.concat_ws("", *[F.col("row")[c] for c in header])
    is_record = (F.col("line_breaks") == 0) | (F.col("line_breaks") == _line_breaks(values))
    rows_type = parsed.select(F.array("row")).schema[0].dataType
    none = F.array().cast(rows_type)

    def refuse(message: str) -> Column:
        return F.raise_error(F.lit(message)).cast(rows_type)

    # The checks decide how many rows there are, so no choice of columns prunes them away.
    checked = (
        F.when(F.col("is_blank"), none)
        .when(~F.col("is_short"), refuse(_TOO_LONG))
        .when(F.col("is_header") & same_header, none)
        .when(F.col("is_header"), refuse("snapshot files with different headers"))
        .when(F.col("row")[_SURPLUS].isNotNull(), refuse("snapshot row with too many fields"))
        .when(~is_record, refuse("snapshot with unquoted quotes (a quote is missing?)"))
        .otherwise(F.array("row"))
    )
    return parsed.select(F.inline(checked)).select(*[f"`{c}`" for c in header])
