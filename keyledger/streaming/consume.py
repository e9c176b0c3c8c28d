"""Consumer of the outbox (A11, J8): a file stream that reads each delivered run
once.

The checkpoint remembers which files were read, and the output is a file sink
whose log names the files of finished batches, so a run stopped at any point is
taken up where it was and no message is delivered twice.  ``availableNow`` reads
what is there and stops, as a scheduled job does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

MESSAGE = T.StructType([T.StructField("body", T.StringType()), T.StructField("run", T.StringType())])


def outbox_stream(spark: SparkSession, outbox: str, files_per_batch: int = 1000) -> DataFrame:
    """``run``, ``id`` of every id in the messages, as they are delivered."""
    messages = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).json(outbox)
    ids = F.from_json("body", T.ArrayType(T.StringType()))
    return messages.select("run", F.explode(ids).alias("id"))


def start_consumer(spark: SparkSession, outbox: str, out_dir: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Append the ids of what was delivered since the last run to ``out_dir`` and stop."""
    return (outbox_stream(spark, outbox, files_per_batch).writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def consume(spark: SparkSession, outbox: str, out_dir: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    query = start_consumer(spark, outbox, out_dir, checkpoint, files_per_batch)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_consumed(spark: SparkSession, out_dir: str) -> DataFrame:
    """``run``, ``id``: what finished batches have written."""
    return spark.read.parquet(out_dir)
