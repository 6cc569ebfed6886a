"""Incremental refresh: new files of standings are validated and merged as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import gate, is_valid
from ..operators.windows import keep_first

KEYS = ("sport", "year", "quarter", "category", "dog", "score")


def refresh(spark: SparkSession, incoming: str, schema: str, table: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Take up all files not yet seen, then stop: valid rows go to ``table``, others to ``rejected``.

    Rows are JSON with ``src_seq``; of rows of one key the first stays, over
    all batches. A batch writes its own partitions (``batch=``), so one that is
    tried again replaces what it wrote. The checkpoint makes a rerun take up
    only what is new.
    """

    def earlier(path: str, number: int) -> DataFrame | None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return None
        return spark.read.parquet(path).where(F.col("batch") != number).select(*KEYS)

    def batch(rows: DataFrame, number: int) -> None:
        first = keep_first(rows, KEYS, ["src_seq"]).withColumn("batch", F.lit(number))
        for part, path in zip(gate(first, is_valid(*(F.col(c) for c in ("sport", "year", "dog", "owner", "score", "score2")))), (table, rejected)):
            old = earlier(path, number)
            if old is not None:
                same = [F.col(f"n.{k}").cast("string").eqNullSafe(F.col(f"o.{k}").cast("string")) for k in KEYS]
                part = part.alias("n").join(old.alias("o"), same, "left_anti")
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "sport", "year").parquet(path)

    stream = spark.readStream.schema(schema).json(incoming)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
