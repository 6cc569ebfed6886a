"""The training-data pipeline: toxic texts go, one text of each group of near
copies stays, repeated passages are cut, the rest is packed into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each as Parquet into the shared folder and hands the reread table to
the next. All stages but the last return the columns of ``documents``. Rows
without doc_id pass the near-copy and passage stages as they are; rows of one
doc_id are one document, of which one row stays; null texts stay null until
they are packed as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringside.llm.chaining import cut_passages, repeated_passages
from ringside.llm.jaccard import jaccard_components
from ringside.llm.packing import pack_documents
from ringside.llm.queries import tokenizer_path
from ringside.llm.storage import stored
from ringside.llm.toxicity import fit, keep_ordinary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_ordinary(docs, fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that links join, the one of the smallest doc_id."""
    groups = jaccard_components(docs)
    others = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__copy")).distinct()
    kept = docs.join(others, docs["doc_id"].cast("long") == F.col("__copy"), "left_anti")
    again = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    known = kept.where("doc_id is not null").withColumn("__again", again).where("__again = 1").drop("__again")
    return known.unionByName(kept.where("doc_id is null"))  # these are not brought together


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller doc_id holds."""
    out = cut_passages(docs, stored(repeated_passages(docs), "passages"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 1024 tokens."""
    packed = pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the fitted toxicity model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
