"""Monthly trip archives: addressing, zip extraction and CSV scans.

The archive is one folder per month, ``{root}/{year}/{month}``, that holds a
zip or its extracted CSV files. Files are landed by other means; a rebuild or a
backfill reads any number of months in one job.
"""

import json
import zipfile
from collections.abc import Callable, Iterable, Iterator
from io import BytesIO

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ridestrata.functions.scalars import two_digits
from ridestrata.schemas import TRIPS, TRIPS_RAW

# Texts that a CSV reader of the data-science world takes as missing.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_BLOCK_BYTES = 4 * 1024 * 1024
_MONTH_FOLDER = r"^(\d{4}/\d{2})/"  #: of a path's last three parts

RECORD = "_record"
_AS_WRITTEN = {"escape": '"', "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
TIMES = ("started_at", "ended_at")
WITH_RECORD = T.StructType([*TRIPS_RAW.fields, T.StructField(RECORD, T.StringType())])
UNZIPPED = T.StructType([T.StructField("path", T.StringType()), *WITH_RECORD.fields])


def month_key(year, month):
    """(2024, 3) and ("2024", "3") to "202403"; of columns the same as a column."""
    if isinstance(year, Column):
        return F.concat(year.cast("int").cast("string"), two_digits(month.cast("int")))
    return f"{int(year)}{int(month):02d}"


def month_folder(root: str, year: int | str, month: int | str) -> str:
    return f"{root.rstrip('/')}/{int(year)}/{int(month):02d}"


def archive_name(year: int | str, month: int | str, feed: str, extension: str = "zip") -> str:
    """File name of one month of a feed, ``{YYYYMM}-{feed}.{extension}``."""
    return f"{month_key(year, month)}-{feed}.{extension}"


def with_month(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``year`` and ``month`` as the file's folders name them. One short text is searched
    for both."""
    found = F.regexp_extract(F.substring_index(path, "/", -3), _MONTH_FOLDER, 1)
    return df.withColumns({"year": F.substring(found, 1, 4).cast("int"), "month": F.substring(found, 6, 2).cast("int")})


def typed_trips(raw: DataFrame) -> DataFrame:
    """Missing texts to NULL and numbers cast; other columns pass through. Text
    that is neither missing nor a number is an error."""

    def typed(field: T.StructField):
        text = F.col(field.name)
        given = F.when(~text.isin(*MISSING_TEXTS), text)
        return given.cast(field.dataType).alias(field.name)

    extra = [name for name in raw.columns if name not in TRIPS.names]
    return raw.select(*[typed(field) for field in TRIPS], *extra)


def readable_trips(raw: DataFrame, times: tuple[str, ...] = TIMES) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable) of raw text rows with ``_record``, the text of a record that has
    not as many fields as the schema, else NULL.

    ``rows`` are typed trips. ``unreadable`` has (record, reasons) and the other columns of
    ``raw``: the record as text, rebuilt as CSV if its fields could be told apart, and why
    it is kept out: ``fields``, or ``number_<column>`` and ``time_<column>`` for text that
    is neither missing nor a number or a time."""
    extra = [name for name in raw.columns if name not in (*TRIPS.names, RECORD)]
    wrong = []
    for field in TRIPS:
        text = F.col(field.name)
        if field.dataType == T.DoubleType():
            given = F.when(~text.isin(*MISSING_TEXTS), text)
            wrong.append(F.when(given.isNotNull() & given.try_cast("double").isNull(), F.lit(f"number_{field.name}")))
        elif field.name in times:
            given = F.when(~text.isin(*MISSING_TEXTS), text)
            wrong.append(F.when(given.isNotNull() & given.try_cast("timestamp_ntz").isNull(), F.lit(f"time_{field.name}")))
    reasons = F.when(F.col(RECORD).isNotNull(), F.array(F.lit("fields"))).otherwise(F.array_compact(F.array(*wrong)))
    judged = raw.withColumn("_reasons", reasons)
    record = F.coalesce(F.col(RECORD), F.to_csv(F.struct(*TRIPS.names), _AS_WRITTEN))
    rows = typed_trips(judged.where(F.size("_reasons") == 0).drop("_reasons", RECORD))
    unreadable = judged.where(F.size("_reasons") > 0)
    return rows, unreadable.select(record.alias("record"), F.col("_reasons").alias("reasons"), *extra)


def unzip_trips(archives: DataFrame) -> DataFrame:
    """Typed rows of all CSV members of zip files given as (path, content). A record with
    another number of fields is an error."""
    return typed_trips(unzip_text(archives).drop(RECORD))


def _member_blocks(keep_unreadable: bool) -> Callable[[zipfile.ZipFile, str, str], Iterator[pa.RecordBatch]]:
    """A function that streams a CSV member of an open zip as text columns, found by their
    names, block by block. Nested, so that workers get it by value and need no copy of
    this package."""
    names = TRIPS_RAW.names
    block_bytes, record_name = _BLOCK_BYTES, RECORD

    def blocks(archive: zipfile.ZipFile, path: str, member: str) -> Iterator[pa.RecordBatch]:
        unreadable: list[str] = []

        def skip(row: csv.InvalidRow) -> str:
            unreadable.append(row.text)
            return "skip" if keep_unreadable else "error"

        def kept() -> pa.RecordBatch:
            texts = [unreadable.pop() for _ in range(len(unreadable))]
            empty = [pa.nulls(len(texts), pa.string()) for _ in names]
            columns = [pa.array([path] * len(texts), pa.string()), *empty, pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["path", *names, record_name])

        reader = csv.open_csv(
            pa.PythonFile(archive.open(member), mode="r"),
            read_options=csv.ReadOptions(block_size=block_bytes),
            parse_options=csv.ParseOptions(newlines_in_values=True, invalid_row_handler=skip),
            convert_options=csv.ConvertOptions(
                column_types={name: pa.string() for name in names}, strings_can_be_null=False
            ),
        )
        if sorted(reader.schema.names) != sorted(names):
            raise ValueError(f"{member} in {path} has columns {reader.schema.names}")
        for block in reader:
            paths = pa.array([path] * block.num_rows, pa.string())
            records = pa.nulls(block.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [paths, *block.select(names).columns, records], names=["path", *names, record_name]
            )
            if unreadable:
                yield kept()
        if unreadable:
            yield kept()

    return blocks


def _csv_members() -> Callable[[zipfile.ZipFile, str], list[str]]:
    def members(archive: zipfile.ZipFile, path: str) -> list[str]:
        found = [
            member
            for member in archive.namelist()
            if member.lower().endswith(".csv") and not member.startswith("__MACOSX/")
        ]
        if not found:
            raise ValueError(f"no CSV file in {path}")
        return found

    return members


def unzip_text(archives: DataFrame, keep_unreadable: bool = False) -> DataFrame:
    """Text rows of all CSV members of zip files given as (path, content), with the text
    of unreadable records in ``_record`` if they are kept.

    One zip is opened by one task; its rows leave the task block by block. A zip without a
    CSV member, or a member with other columns than the schema's, is an error.
    """
    blocks, members = _member_blocks(keep_unreadable), _csv_members()

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                archive = zipfile.ZipFile(BytesIO(content.as_py()))
                for member in members(archive, path.as_py()):
                    yield from blocks(archive, path.as_py(), member)

    return archives.select("path", "content").mapInArrow(unzip, UNZIPPED)


def _zip_source(keep_unreadable: bool) -> type[DataSource]:
    """A data source of the CSV members of zip files, one partition for each."""
    blocks, members = _member_blocks(keep_unreadable), _csv_members()

    def opened(uri: str):
        """The file system and the path in it."""
        if "://" not in uri and not uri.startswith("file:"):
            return fs.LocalFileSystem(), uri
        return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))

    class Members(DataSourceReader):
        def __init__(self, folders: list[str]):
            self.folders = folders

        def partitions(self) -> list[InputPartition]:
            found = []
            for folder in self.folders:
                system, root = opened(folder)
                for file in sorted(system.get_file_info(fs.FileSelector(root)), key=lambda info: info.path):
                    if not file.is_file or not file.path.endswith(".zip"):
                        continue
                    with system.open_input_file(file.path) as source, zipfile.ZipFile(source) as archive:
                        found += [InputPartition((folder, file.path, name)) for name in members(archive, file.path)]
            return found

        def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
            if partition is None:  # Spark's only partition where none was found
                return
            folder, path, member = partition.value
            with opened(folder)[0].open_input_file(path) as source, zipfile.ZipFile(source) as archive:
                yield from blocks(archive, path, member)

    class ZipMembers(DataSource):
        @classmethod
        def name(cls) -> str:
            return "trip_zips_readable" if keep_unreadable else "trip_zips"

        def schema(self) -> T.StructType:
            return unzipped

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Members(json.loads(self.options["folders"]))

    unzipped = UNZIPPED
    return ZipMembers


def zip_text(spark: SparkSession, folders: Iterable[str], keep_unreadable: bool = False) -> DataFrame:
    """``unzip_text`` of the zip files in folders, without holding a file: each CSV member
    is one partition, whose task reads and unpacks it block by block, so a zip may have any
    size. The driver reads the directories of the zips alone. A folder without zips gives
    no rows."""
    source = _zip_source(keep_unreadable)
    spark.dataSource.register(source)
    wanted = [folder.rstrip("/") for folder in folders]
    return spark.read.format(source.name()).option("folders", json.dumps(wanted)).load()


def require_files(spark: SparkSession, folders: Iterable[str], pattern: str) -> None:
    """Raise unless every month folder holds a file of this pattern."""
    wanted = list(folders)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(wanted)
    found = {tuple(row) for row in with_month(files.select("path")).select("year", "month").distinct().collect()}
    empty = [f for f in wanted if tuple(map(int, f.rstrip("/").split("/")[-2:])) not in found]
    if empty:
        raise FileNotFoundError(f"no {pattern} in {', '.join(empty)}")


def _zip_rows(
    spark: SparkSession, folders: Iterable[str], keep_unreadable: bool, streamed: bool
) -> DataFrame:
    if streamed:
        return zip_text(spark, folders, keep_unreadable)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(list(folders))
    return unzip_text(files, keep_unreadable)


def read_trip_archives(
    spark: SparkSession, folders: Iterable[str], streamed: bool = True
) -> DataFrame:
    """Trips of the zip files in month folders, with ``year`` and ``month``. Zips are
    streamed by Arrow's file systems; with ``streamed=False`` Spark reads each as one
    value, on any file system that Spark knows, but of less than 2 GB."""
    rows = typed_trips(_zip_rows(spark, folders, False, streamed).drop(RECORD))
    return with_month(rows).drop("path")


def _scan_csv(
    spark: SparkSession, paths: Iterable[str], newlines_in_values: bool, keep_unreadable: bool = False
) -> DataFrame:
    return (
        spark.read.schema(WITH_RECORD if keep_unreadable else TRIPS_RAW)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if keep_unreadable else "FAILFAST")
        .option("columnNameOfCorruptRecord", RECORD)
        # A scan of some columns alone would not count the fields of a record.
        .option("columnPruning", not keep_unreadable)
        .option("multiLine", newlines_in_values)
        .option("pathGlobFilter", "*.csv")
        .csv(list(paths))
    )


def read_trip_csv(
    spark: SparkSession, paths: Iterable[str], newlines_in_values: bool = False
) -> DataFrame:
    """Trips of extracted CSV files. Large files are split among tasks, unless
    quoted values may hold line breaks. A file whose header differs from the
    schema, or a line with another number of fields, is an error."""
    return typed_trips(_scan_csv(spark, paths, newlines_in_values))


def read_trip_csv_months(
    spark: SparkSession, folders: Iterable[str], newlines_in_values: bool = False
) -> DataFrame:
    """Trips of the CSV files in month folders, with ``year`` and ``month``."""
    raw = _scan_csv(spark, folders, newlines_in_values)
    located = typed_trips(raw.select("*", F.col("_metadata.file_path").alias("path")))
    return with_month(located).drop("path")


def read_readable_csv(
    spark: SparkSession, paths: Iterable[str], newlines_in_values: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``read_trip_csv`` that survives malformed records: (rows, unreadable)."""
    return readable_trips(_scan_csv(spark, paths, newlines_in_values, keep_unreadable=True))


def read_readable_months(
    spark: SparkSession,
    folders: Iterable[str],
    zipped: bool = True,
    newlines_in_values: bool = False,
    streamed: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable) of month folders, both with ``year`` and ``month``, the latter
    with the ``path`` of its file."""
    if zipped:
        raw = _zip_rows(spark, folders, True, streamed)
    else:
        raw = _scan_csv(spark, folders, newlines_in_values, keep_unreadable=True)
        raw = raw.select("*", F.col("_metadata.file_path").alias("path"))
    rows, unreadable = readable_trips(raw)
    return with_month(rows).drop("path"), with_month(unreadable)
