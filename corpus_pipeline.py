"""The training-data pipeline over `documents`: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
back as the next stage's docs.  All but the last return the columns of `documents`.

1. language_id     documents without a letter, or in none of the learned languages, go
2. line_dedup      lines that a document of smaller id has go
3. near_duplicates one document of each group of similar ones stays, that of smallest id
4. source_mixing   documents are taken, or repeated, by their sources' target weights
5. packing         token ids packed into sequences; returns the pieces

Line dedup changes texts and so n_chars.  Tables without rows, null and empty texts pass through
as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.llm import jaccard, language, linededup, mixing, packing
from snapfold.llm.queries import tokenizer_path
from snapfold.llm.staging import new_folder

#: Below this probability of the best language a document is in none of them.
LEAST_SCORE = 0.4
#: Up to so many ids of removed documents are broadcast; beyond that they are joined by a shuffle.
BROADCAST_IDS = 500_000


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars as the text now is."""
    size = F.char_length("text").cast("long").alias("n_chars")
    return docs.select(*[size if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs, language.fit(docs), "__language", "__score")
    known = (F.col("__language") != language.UNKNOWN) & (F.col("__score") >= LEAST_SCORE)
    return found.where(known).select(*[f"`{c}`" for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(linededup.dedup_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = jaccard.similar_documents(docs, size=5, percent=80)
    gone = classes.where("component_id <> doc_id").select("doc_id").distinct()
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("packing", sequence_packing),
]

#: Language models and tokenizers have no SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
