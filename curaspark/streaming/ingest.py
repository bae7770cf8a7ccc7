"""New source files as a stream: each batch runs through the batch plan. An extension; the sources themselves are batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def fasta_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """name, seq, arrived of the records in FASTA files as they come into a folder."""
    lines = spark.readStream.option("lineSep", "\n>").option("maxFilesPerTrigger", files_per_batch).text(folder)
    body = F.regexp_replace("value", "^>", "")
    head = F.substring_index(body, "\n", 1)
    rest = F.when(F.contains(body, F.lit("\n")), F.substr(body, F.length(head) + 2)).otherwise("")
    return lines.filter(F.trim("value") != "").select(F.trim(F.regexp_replace(head, "\r", "")).alias("name"), F.regexp_replace(rest, r"\s", "").alias("seq"), F.current_timestamp().alias("arrived"))


def new_names(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """The stream without headers that came before within the delay; the watermark bounds what is remembered."""
    return stream.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["name"])


def start(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False):
    """Run `batch` on every micro-batch; with `once` until all files that are there are done. A batch may come again after a failure, so it must overwrite by its number."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


