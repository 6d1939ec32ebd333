"""Landed files made from trips, for the queries that read files."""

from collections.abc import Iterator
from io import BytesIO
from zipfile import ZIP_DEFLATED, ZipFile

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridestrata.operators.stored import scratch_path
from ridestrata.sources.archive import month_folder


def as_text(trips: DataFrame) -> DataFrame:
    return trips.select(*[F.col(name).cast("string") for name in trips.columns])


def zipped(trips: DataFrame) -> DataFrame:
    """(path, content): one zip with one CSV file per batch of trips."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = BytesIO()
            with ZipFile(packed, "w", ZIP_DEFLATED) as archive:
                archive.writestr("trips.csv", batch.to_csv(index=False))
            yield pd.DataFrame({"path": ["trips.zip"], "content": [packed.getvalue()]})

    return as_text(trips).mapInPandas(pack, "path string, content binary")


def landed_zips(trips: DataFrame, months: dict[tuple[int, int], str]) -> str:
    """Write the trips of each condition into zips in the folder of its month, one per
    task, with a CSV member per batch; returns the folder of all months."""
    root = scratch_path(trips.sparkSession, "landed-zips")
    for (year, month), rows in months.items():
        folder = month_folder(root, year, month)

        def pack(batches: Iterator[pd.DataFrame], folder: str = folder) -> Iterator[pd.DataFrame]:
            named = "://" in folder or folder.startswith("file:")
            system, place = fs.FileSystem.from_uri(folder) if named else (fs.LocalFileSystem(), folder)
            archive = None
            for number, batch in enumerate(batches):
                if archive is None:
                    system.create_dir(place, recursive=True)
                    file = system.open_output_stream(f"{place}/part-{TaskContext.get().partitionId()}.zip")
                    archive = ZipFile(file, "w", ZIP_DEFLATED)
                archive.writestr(f"trips-{number}.csv", batch.to_csv(index=False))
                yield pd.DataFrame({"n": [len(batch)]})
            if archive is not None:
                archive.close()
                file.close()

        as_text(trips.where(rows)).mapInPandas(pack, "n long").agg(F.sum("n")).collect()
    return root


def _write_csv(trips: DataFrame, path: str) -> None:
    writer = as_text(trips).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def landed_csv(trips: DataFrame) -> str:
    """Write trips as CSV files; returns their folder."""
    path = scratch_path(trips.sparkSession, "landed")
    _write_csv(trips, path)
    return path


def write_month(trips: DataFrame, root: str, month: tuple[int, int]) -> None:
    """Write trips into the CSV folder of a month."""
    _write_csv(trips, month_folder(root, *month))


def landed_months(trips: DataFrame, months: dict[tuple[int, int], str]) -> str:
    """Write the trips of each condition into the CSV folder of its month; returns
    the folder of all months."""
    root = scratch_path(trips.sparkSession, "landed")
    for month, rows in months.items():
        write_month(trips.where(rows), root, month)
    return root


def landed_malformed(trips: DataFrame) -> str:
    """CSV files with records that cannot be read, by the second of their start: a field
    too few (7) or too many (11), a latitude that is no number (13 and 19), a start that is
    no time (17 and 19)."""
    second = F.second(F.col("started_at").cast("timestamp_ntz"))
    texts = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in trips.columns}
    texts["start_lat"] = F.when(second.isin(13, 19), "north").otherwise(texts["start_lat"])
    texts["started_at"] = F.when(second.isin(17, 19), "yesterday").otherwise(texts["started_at"])
    whole, short = F.concat_ws(",", *texts.values()), F.concat_ws(",", *list(texts.values())[:-1])
    record = F.when(second == 7, short).when(second == 11, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    header = ",".join(trips.columns)

    def headed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [header]})
        yield from batches

    path = scratch_path(trips.sparkSession, "malformed")
    lines = trips.select(record.alias("value")).mapInPandas(headed, "value string")
    # Lines as they are: no character of theirs parts or quotes a field.
    whole_lines = {"sep": "\x01", "quote": "\0", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines.write.options(**whole_lines).csv(path)
    return path

