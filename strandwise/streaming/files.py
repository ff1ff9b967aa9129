"""Files as they arrive: a batch of files at a time, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandwise import schema as S
from strandwise.operators.order import with_coordinates
from strandwise.plans.modes import process_files
from strandwise.sources.files import scratch_scope
from strandwise.sources.text import read_lines

BATCH_FILES = 64


def stream_lines(spark: SparkSession, path: str, files: int = BATCH_FILES) -> DataFrame:
    """(file, line) of new files, `files` at most in a micro-batch; lines of a file come in one batch."""
    reader = spark.readStream.schema("value string").option("lineSep", "\n").option("maxFilesPerTrigger", files).format("text")
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def running_counts(lines: DataFrame) -> DataFrame:
    """Reads and bytes by reference name over all files so far."""
    rows = with_coordinates(lines, headers_first=True).where("valid")
    return rows.groupBy("rname").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes"))


MANIFEST = "batch long, file string, name string, n_lines long"


def batches_done(spark: SparkSession, path: str) -> DataFrame:
    """(batch, file, name, n_lines) of all batches that have been written to a folder of outputs."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/_batches/*") if _exists(spark, f"{path}/_batches") else spark.createDataFrame([], MANIFEST)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def process_batch(batch: DataFrame, number: int, path: str, mode: str, policy: str = S.COMPAT) -> None:
    """Process the files of a micro-batch (file) and write their outputs and, last, the batch's manifest.

    A batch with a manifest has been written whole and is left alone. One that died before it is done again: its files,
    which the stream's checkpoint fixes for the number, give outputs of the same names, which take the old ones' places."""
    spark = batch.sparkSession
    manifest = f"{path}/_batches/{number:09d}"
    if _exists(spark, f"{manifest}/_SUCCESS"):
        return
    names = [r.file for r in batch.select("file").distinct().collect()]  # BATCH_FILES of them
    if names:
        with scratch_scope(spark):
            done = process_files(read_lines(spark, names), path, mode, policy, "append")
            done.select(F.lit(number).cast("long").alias("batch"), "file", "name", "n_lines").coalesce(1).write.mode("overwrite").parquet(manifest)


def process_stream(spark: SparkSession, source: str, path: str, mode: str, checkpoint: str, files: int = BATCH_FILES, policy: str = S.COMPAT) -> StreamingQuery:
    """Sort, mark or do both to files as they arrive in `source`, `files` at a time; each ends up in `path` once.

    The query stops when all files that are there have been processed; started again, it goes on with new ones."""
    batches = stream_lines(spark, source, files).writeStream.option("checkpointLocation", checkpoint)
    return batches.trigger(availableNow=True).foreachBatch(lambda batch, number: process_batch(batch, number, path, mode, policy)).start()
