"""Shared-folder storage for intermediate tables.

Intermediate results are written as Parquet under the folder that the session
names in ``spark.checkpoint.dir``, which the driver and all executors share.
A table written there cuts the lineage and survives the loss of executors.
Only where the setting is absent and all of Spark is one process (tests, a
laptop) a temporary folder is made.
"""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _FALLBACK:
            _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="ringside-")
        named = _FALLBACK[app]
    return named.rstrip("/")


#: Rows of an Arrow batch between Spark and Python workers: texts are long, and both sides hold a batch or two.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send small batches to Python workers, unless it asks for a size of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def write_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet into a fresh folder of the shared dir; return its path."""
    path = f"{shared_dir(df.sparkSession)}/ringside-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again (lineage is cut)."""
    spark, schema = df.sparkSession, df.schema
    return spark.read.schema(schema).parquet(write_table(df, name))


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Tables:
    """The intermediate tables of one operator: all but the result are deleted when that is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read again (lineage is cut)."""
        schema = df.schema
        self.paths.append(write_table(df, name))
        return self.spark.read.schema(schema).parquet(self.paths[-1])

    def release(self) -> None:
        """Let Spark delete the shuffle files of plans that nothing refers to any more: what they gave is stored."""
        self.spark._jvm.System.gc()

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` stored, the other tables gone."""
        out = stored(df, name)
        self.drop()
        return out

    def drop(self) -> None:
        """Delete the tables stored so far."""
        for path in self.paths:
            drop_table(self.spark, path)
        self.paths = []


#: log2 of the bits of an id filter: 4 MB, whatever the number of ids.
FILTER_BITS = 25


def _slot(column):
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def filter_words(ids: DataFrame, column: str) -> DataFrame:
    """The set words ``(w, b)`` of a bitmap of every id of ``column``: at most 2**19 rows, whatever the number of ids."""
    slot = _slot(F.col(column))
    return (
        ids.where(F.col(column).isNotNull())
        .select(F.shiftright(slot, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), {1 << FILTER_BITS}) & 63 as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
    )


def split_by_ids(rows: DataFrame, key, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` (a long) may be among the ids of ``filter_words``, and those whose key is certainly not.

    The words are broadcast, being of bounded number. Rows without key are
    certainly not among them. The columns stay.
    """
    own = "__filter"
    while any(c.lower().startswith(own) for c in rows.columns):
        own += "_"
    w, b, slot = f"{own}w", f"{own}b", f"{own}slot"
    marked = rows.withColumn(slot, F.when(key.isNotNull(), _slot(key)))
    marked = marked.join(F.broadcast(words.select(F.col("w").alias(w), F.col("b").alias(b))), F.shiftright(slot, 6) == F.col(w), "left")
    bit = F.expr(f"coalesce(shiftright({b}, cast({slot} & 63 as int)) & 1L, 0L)")
    return tuple(marked.where(bit == v).drop(w, b, slot) for v in (1, 0))


def id_filter(ids: DataFrame, column: str):
    """Broadcast a bitmap of fixed size that holds every id of ``column``.

    Returns ``(broadcast, slot_column)``: a row whose slot bit is unset is
    certainly not among the ids; one whose bit is set may be. The bitmap is
    put together by an aggregate of at most 2**19 words, so neither the
    driver nor the broadcast grows with the data; a fuller bitmap only lets
    more rows through to the exact join that follows.
    """
    words = filter_words(ids, column).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    table[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(table), _slot


def may_hold(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots are set in a bitmap of ``id_filter``."""
    return ((table[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
