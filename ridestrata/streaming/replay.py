"""Incremental replay of the CSV archive: each landed file is loaded once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridestrata.schemas import TRIPS_RAW
from ridestrata.sources.archive import typed_trips, with_month


def landed_files(spark: SparkSession, root: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the trips in the files of ``{root}/{year}/{month}``, with year and month."""
    raw = (
        spark.readStream.schema(TRIPS_RAW)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(f"{root.rstrip('/')}/*/*")
    )
    located = typed_trips(raw.select("*", F.col("_metadata.file_path").alias("path")))
    return with_month(located).drop("path")


def append_new(stream: DataFrame, table: str, progress: str, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append what is new in the stream to the table folder, partitioned by ``by``, and stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", progress)
    return (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start(table)


def replay_new_files(
    spark: SparkSession, root: str, table: str, progress: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Append the files of ``{root}/{year}/{month}`` that earlier calls have not
    loaded to the table folder, partitioned by year and month, and stop.

    ``progress`` is the folder that remembers what is loaded; both folders must
    be shared by all executors.
    """
    return append_new(landed_files(spark, root, files_per_batch), table, progress, ("year", "month"))
