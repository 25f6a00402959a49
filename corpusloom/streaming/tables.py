"""Streaming reads of stored tables, and draining a stream into one or into a table of batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import scratch_path
from corpusloom.sources.catalog import is_file

FILES_PER_TRIGGER = 1000


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Files of a folder as they arrive; ``max_files`` bounds what one trigger takes in.

    A stream reads folders, so for a table that is one file the folder is filtered by its name.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if is_file(spark, path):
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path)


class RowsLeft(RuntimeError):
    """A drained stream whose state is not empty at the end of its input."""


def drain(stream: DataFrame, name: str = "drained", end: Callable[[], None] | None = None) -> DataFrame:
    """Run the stream over everything that is there now and return the rows it put out.

    Progress and rows go to the shared folder, so the run resumes after a failure and puts out each row once.

    ``end`` adds the end of the input (``end_of_input``) to what the stream reads. It is called when all that was there
    is worked off, so no row can come behind it whatever the order of the files, and a second run takes it in. All
    states must have ended then: if one still holds rows, that is an error and not a loss.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def run(before: int = 0) -> int:
        """The rows of all states after a run; as many as before it if there was nothing to do."""
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-progress")
        query = writer.trigger(availableNow=True).start(path)
        query.awaitTermination()
        told = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
        return sum(operator["numRowsTotal"] for operator in told[-1]) if told else before

    held = run()
    if end is not None:
        end()
        left = run(held)
        if left:
            raise RowsLeft(f"{left} states of {name} have not ended")
    return spark.read.schema(stream.schema).parquet(path)


BATCH = "batch_id"


def write_batches(
    stream: DataFrame, path: str, progress: str, change: Callable[[DataFrame], DataFrame] | None = None, written: Callable[[int], None] | None = None
) -> None:
    """Work off what is there now, one folder ``batch_id=N`` of ``path`` per batch.

    Writing a batch replaces what an earlier try of the same batch has left, whole or in part. So a run that is lost between
    the write and the commit of its progress writes the same rows to the same place again, and each row is there once.
    ``change`` may be any batch operation, also such that streams don't have (a sort, a rank); ``written`` is called with
    the batch's number behind each write, for what has to follow it. ``progress`` belongs to ``path``: use both or neither again.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = change(batch) if change else batch
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={number}")
        if written:
            written(number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches and their number as ``batch_id``. ``schema`` is that of the written rows."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)
    return df.withColumn(BATCH, F.col(BATCH).cast("long"))
