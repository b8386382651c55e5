"""Files that keep arriving: each drop is filtered and appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caretlake.operators import discovery as D


def ingest_drops(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, cfg: D.FilterConfig = D.FilterConfig()):
    """Decide all new Parquet drops of ``source`` and append the decisions to ``target``, partitioned by epoch.

    Runs until everything that is there now has been read (availableNow). A repeated epoch overwrites its own folder, so
    that a retry writes nothing twice. Duplicates are found within a drop; across drops use operators/incremental.py.
    """

    def one(df: DataFrame, epoch: int) -> None:
        D.decide(df, cfg).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    stream = spark.readStream.schema(schema).parquet(source)
    q = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
