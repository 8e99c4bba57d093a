"""Token-id files: every document compressed on its own against one shared dictionary.

A dataset is a folder of shard files in ascending doc_id order and one zstandard dictionary,
`<sha256>.dict`, trained on serialized id arrays of a bounded sample of documents (SAMPLE_DOCS).  A shard:

    magic (8 bytes)
    one zstandard frame per document: its ids, end id last, little-endian
    index: Arrow IPC stream of doc_id, offset, length (bytes), n_tokens, one row per document,
        with the dictionary's hash and the id width in the schema's metadata
    length of the index (8 bytes, little-endian), magic

The index is small, so one short document costs a read of the index and of its frame.
Frames are decompressed only with the dictionary whose hash the shard names.

Writing: documents are range-partitioned by doc_id (only that column decides), sorted
in their partition and encoded and written by the task that holds them; ids are never
shuffled.  A task writes to a name of its own attempt and then renames, so a task that runs
again leaves the same shard.

Null and empty texts are the end id alone.  Null doc_ids come first.  Rows with the same
doc_id are documents of their own, ordered by text.  An empty table makes an empty dataset.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapfold.llm.encoding import encode_documents
from snapfold.llm.staging import new_folder, staged
from snapfold.llm.words import chunks

MAGIC = b"TOKENS01"
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1000  # documents the dictionary is trained on
SAMPLE_IDS = 4096  # ids of one training item; longer documents are several
LEVEL = 3


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if ":/" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def _id_type(tokenizer: str, end_id: int) -> str:
    from snapfold.llm.encoding import encoder

    return "<u2" if max(end_id, encoder(tokenizer).library.get_vocab_size() - 1) < 1 << 16 else "<u4"


def train_dictionary(items: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; too few items to train on are the dictionary themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, items).as_bytes()
    except zstandard.ZstdError:
        return b"".join(items)[:size]


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def sample_items(docs: DataFrame, tokenizer: str, end_id: int, id_type: str, most: int = SAMPLE_DOCS) -> list[bytes]:
    """Serialized ids of documents drawn by a hash of their ids, at most `most` of them.

    The share that is drawn follows from the number of rows, so no task sorts or collects more
    texts than are drawn.
    """

    def serialize(batches):
        for batch in batches:
            for part in chunks(batch):
                ids = encode_documents(part.column("text"), tokenizer, end_id)
                items = [x[at : at + SAMPLE_IDS].astype(id_type).tobytes() for x in ids for at in range(0, len(x), SAMPLE_IDS)]
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.binary())], names=["item"])

    rows = docs.count()
    share = 1.0 if rows <= most else 0.9 * most / rows
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    chosen = docs.select("doc_id", "text").where(drawn).orderBy("doc_id", "text").limit(most).select("text")
    return sorted(bytes(r.item) for r in chosen.mapInArrow(serialize, "item binary").collect())


@dataclass(frozen=True)
class TokenDataset:
    """A written dataset: its folder, the dictionary's hash, and the table of its shards."""

    folder: str
    dictionary: str
    shards: DataFrame  # shard, path, n_docs, n_tokens, start (ids of all shards before it)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1,
                 shards: int | None = None, sample_docs: int = SAMPLE_DOCS) -> TokenDataset:
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    id_type = _id_type(tokenizer, end_id)
    dictionary = train_dictionary(sample_items(docs, tokenizer, end_id, id_type, sample_docs))
    name = hashlib.sha256(dictionary).hexdigest()
    fs, root = _place(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{name}.dict") as out:
        out.write(dictionary)
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(docs.schema["doc_id"].dataType)
    facts = {"dictionary": name, "ids": id_type}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        task = TaskContext.get()
        shard = task.partitionId()
        fs, root = _place(folder)
        final, own = f"{root}/shard-{shard:07d}", f"{root}/.shard-{shard:07d}-{task.taskAttemptId()}"
        zip_one = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
        rows: dict[str, list] = {"doc_id": [], "offset": [], "length": [], "n_tokens": []}
        at = len(MAGIC)
        with fs.open_output_stream(own) as out:
            out.write(MAGIC)
            for batch in batches:
                for part in chunks(batch):
                    for ids in encode_documents(part.column("text"), tokenizer, end_id):
                        frame = zip_one(ids.astype(id_type).tobytes())
                        out.write(frame)
                        rows["offset"].append(at)
                        rows["length"].append(len(frame))
                        rows["n_tokens"].append(len(ids))
                        at += len(frame)
                    rows["doc_id"].extend(part.column("doc_id").to_pylist())
            kinds = (arrow_id, pa.int64(), pa.int64(), pa.int64())
            index = pa.table([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))
            index = index.replace_schema_metadata(facts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, index.schema) as writer:
                writer.write_table(index)
            tail = sink.getvalue().to_pybytes()
            out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
        fs.move(own, final)
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "path": f"{folder}/shard-{shard:07d}", "n_docs": len(rows["n_tokens"]),
            "n_tokens": sum(rows["n_tokens"]),
        }])

    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    written = staged(ordered.mapInArrow(write, "shard bigint, path string, n_docs bigint, n_tokens bigint"), "shards")
    # One row per shard file.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards_table = written.where("n_docs > 0").withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    )
    return TokenDataset(folder, name, shards_table)


class Shard:
    """Reads one shard file; `ids(row)` reads one document by its row in the index."""

    def __init__(self, path: str):
        import zstandard

        fs, place = _place(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a token shard, or an unfinished one: {path}")
        length = int.from_bytes(tail[:8], "little")
        self.index = pa.ipc.open_stream(self.file.read_at(length, size - 16 - length)).read_all()
        facts = {k.decode(): v.decode() for k, v in self.index.schema.metadata.items()}
        self.id_type = facts["ids"]
        with fs.open_input_stream(f"{place.rpartition('/')[0]}/{facts['dictionary']}.dict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).hexdigest() != facts["dictionary"]:
            raise ValueError(f"the dictionary of {path} was changed")
        self.unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
        self.offsets = self.index["offset"].to_numpy()
        self.lengths = self.index["length"].to_numpy()

    def ids(self, row: int) -> np.ndarray:
        frame = self.file.read_at(int(self.lengths[row]), int(self.offsets[row]))
        return np.frombuffer(self.unzip(frame), dtype=self.id_type)


def read_tokens(dataset: TokenDataset) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""
    kind = pa.int64()
    spark: SparkSession = dataset.shards.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, start = Shard(row["path"]), row["start"]
                for at in range(0, row["n_docs"], 4096):
                    part = shard.index.slice(at, 4096)
                    crc, sizes = [], []
                    for i in range(at, at + part.num_rows):
                        ids = shard.ids(i)
                        sizes.append(len(ids))
                        crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    upto = start + np.cumsum(sizes)
                    doc_ids = part["doc_id"].combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, pa.array(upto - sizes, kind), pa.array(sizes, kind), pa.array(crc, kind)],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    start = int(upto[-1])

    # One small row per file, dealt out so that files are read in parallel.
    shards = dataset.shards.select("shard", "path", "n_docs", "start")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(tasks, "shard").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
