"""The raw zone: hourly gzip archives in `archive_date=.../archive_hour=..` folders."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repo_pulse.functions import instants
from repo_pulse.session import scoped_conf

# Where the public archive is served, and the folder of the raw zone.
BASE_URL = "https://data.gharchive.org"
ZONE = "gharchive"

NAIVE_HOUR = "archive_hour must be timezone-aware"
UNALIGNED_HOUR = "archive_hour must be aligned to a full UTC hour"

_LINES = "value string, archive_date date, archive_hour int"
# Bytes unpacked at a time while an archive is checked.
UNPACKED = 1 << 20


def hours(spark: SparkSession, from_date: date, to_date: date) -> DataFrame:
    """Every UTC hour of the dates from `from_date` to `to_date`, both included."""
    bounds = spark.sql(
        "SELECT CAST(:start AS DATE) AS first, CAST(:stop AS DATE) AS last",
        args={"start": from_date, "stop": to_date},
    )
    return hours_between(bounds)


def hours_between(bounds: DataFrame) -> DataFrame:
    """Every UTC hour of the dates from `first` to `last` of each row, both included."""
    days = F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))
    day = bounds.select(F.explode(days).alias("activity_date"))
    start = F.col("activity_date").cast("timestamp")
    hour = F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return day.select("activity_date", F.explode(hour).alias("hour"))


def normalize_hour(df: DataFrame, text: str = "hour_text") -> DataFrame:
    """ISO 8601 hours to UTC instants in `hour`, with the reason in `error` where refused."""
    instant = instants.parse_instant(F.col(text))
    why = instants.instant_error(F.col(text))
    error = F.when(
        instant.isNull(), F.when(why == instants.NAIVE, F.lit(NAIVE_HOUR)).otherwise(why)
    ).when(F.date_trunc("hour", instant) != instant, F.lit(UNALIGNED_HOUR))
    return df.withColumns({"hour": F.when(error.isNull(), instant), "error": error})


def file_name(hour: Column) -> Column:
    """`2025-01-02-3.json.gz`: the hour is not padded."""
    return F.concat(F.date_format(hour, "yyyy-MM-dd-H"), F.lit(".json.gz"))


def folder(hour: Column) -> Column:
    """`archive_date=2025-01-02/archive_hour=03`: the hour is padded."""
    return F.date_format(hour, "'archive_date='yyyy-MM-dd'/archive_hour='HH")


def coordinates(df: DataFrame, hour: str = "hour") -> DataFrame:
    """Add the source file name, the download URL and the path under the raw root."""
    at = F.col(hour)
    return df.withColumns(
        {
            "source_file": file_name(at),
            "url": F.concat(F.lit(f"{BASE_URL}/"), file_name(at)),
            "path": F.concat_ws("/", F.lit(ZONE), folder(at), file_name(at)),
        }
    )


def zone(raw_root: str) -> str:
    return f"{raw_root.rstrip('/')}/{ZONE}"


_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_INVENTORY = (
    "path string, modificationTime timestamp, source_file string, length bigint, "
    "archive_date date, hour timestamp"
)


def inventory(
    spark: SparkSession, raw_root: str, dates: Sequence[date] | None = None
) -> DataFrame:
    """Archives that have landed: `path, modificationTime, source_file, length, archive_date,
    hour`.

    Only the listing is read, never file content; with `dates`, only the folders of those
    dates are listed. Unfinished downloads do not end in `.gz`.
    """
    reader = (
        spark.read.format("binaryFile")
        .schema(f"{_FILES}, archive_date date, archive_hour int")
        .option("pathGlobFilter", "*.gz")
        .option("basePath", zone(raw_root))
    )
    try:
        files = reader.load(_folders(raw_root, dates))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _INVENTORY)
    return _inventoried(files)


def described(files: DataFrame) -> DataFrame:
    """The inventory's columns of files (`path, modificationTime, length`) that lie in the raw
    zone, from their paths."""
    folder_of = lambda key: F.regexp_extract("path", f"{key}=([^/]+)/[^/]+$", 1)
    day = F.regexp_extract("path", "archive_date=([^/]+)/archive_hour=[^/]+/[^/]+$", 1)
    placed = files.withColumns(
        {"archive_date": day.cast("date"), "archive_hour": folder_of("archive_hour").cast("int")}
    )
    return _inventoried(placed)


def _inventoried(files: DataFrame) -> DataFrame:
    return files.select(
        "path",
        "modificationTime",
        F.element_at(F.split("path", "/"), -1).alias("source_file"),
        "length",
        "archive_date",
        _folder_hour().alias("hour"),
    )


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The inventory of archives given by path."""
    return described(spark.read.format("binaryFile").schema(_FILES).load(list(paths)))


def _folders(raw_root: str, dates: Sequence[date] | None) -> str:
    root = zone(raw_root)
    if dates is not None:
        root += "/archive_date={" + ",".join(day.isoformat() for day in dates) + "}"
    return root


def _listed_in(files: DataFrame, manifest: DataFrame, skip: Sequence[str]) -> DataFrame:
    """The rows of files that a manifest lists, with all columns of both.

    One number tells date and hour of a folder, so that Spark leaves out every folder without a
    listed file; the list is short enough to be broadcast (see `lakehouse.LOAD_SOURCES`), so rows
    stay where they are read. Files named in `skip` are not opened.
    """
    if skip:
        files = files.where(~F.col("_metadata.file_name").isin(*skip))
    place = F.unix_date("archive_date") * 24 + F.col("archive_hour")
    named = files.withColumns({"source_file": F.col("_metadata.file_name"), "place": place})
    listed = manifest.select("source_file", place.cast("int").alias("place"))
    return named.join(F.broadcast(listed), ["place", "source_file"])


def read_planned(
    spark: SparkSession,
    raw_root: str,
    manifest: DataFrame,
    dates: Sequence[date],
    skip: Sequence[str] = (),
) -> DataFrame:
    """Lines of the archives in a manifest, which lie under the given dates; `source_line_number`
    is a row id here. Broken files that lie beside them are named in `skip`.

    One pass, without a shuffle, however the archives are packed into tasks: a gzip file is never
    split, so the ids of its lines are consecutive, and a line's number is its id less the file's
    first one, plus 1.
    """
    reader = spark.read.schema(_LINES).option("pathGlobFilter", "*.gz")
    lines = reader.option("basePath", zone(raw_root)).text(_folders(raw_root, dates))
    return _listed_in(lines, manifest, skip).select(
        "value",
        _folder_hour().alias("archive_hour"),
        "source_file",
        F.monotonically_increasing_id().alias("source_line_number"),
    )


def unreadable(
    spark: SparkSession, raw_root: str, manifest: DataFrame, dates: Sequence[date]
) -> DataFrame:
    """The rows (`source_file`) of a manifest whose archives are no complete gzip files.

    All are unpacked once, on the executors, one file at a time.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                if not _is_gzip(batch.column("content")[row].as_buffer()):
                    yield batch.select(["source_file"]).slice(row, 1)

    files = (
        spark.read.format("binaryFile")
        .schema(f"{_FILES}, archive_date date, archive_hour int")
        .option("pathGlobFilter", "*.gz")
        .option("basePath", zone(raw_root))
        .load(_folders(raw_root, dates))
    )
    listed = _listed_in(files, manifest, ()).select("source_file", "content")
    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        # Kept, so that the files are unpacked under this setting and no second time.
        found = listed.mapInArrow(check, "source_file string").persist()
        found.count()
    return found


def _is_gzip(content: pa.Buffer) -> bool:
    """Whether the bytes are nothing but whole gzip members (none: an empty file)."""
    rest = memoryview(content)
    while len(rest):
        member = zlib.decompressobj(wbits=31)
        try:
            while not member.eof and len(rest):
                part, rest = rest[:UNPACKED], rest[UNPACKED:]
                while part and not member.eof:
                    member.decompress(part, UNPACKED)
                    part = member.unconsumed_tail
        except zlib.error:
            return False
        if not member.eof:
            return False
        rest = memoryview(content)[len(content) - len(rest) - len(member.unused_data) :]
    return True


def landing(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected hours with the number and size of their landed archives (none: not landed).

    An hour may be delivered as several gzip files: a gzip file is read by one task, so a very
    large hour is better split.
    """
    present = landed.groupBy("hour").agg(
        F.count(F.lit(1)).alias("archive_count"), F.sum("length").alias("byte_count")
    )
    return expected.join(present, "hour", "left").select(
        *expected.columns,
        F.col("archive_count").isNotNull().alias("landed"),
        F.coalesce("archive_count", F.lit(0)).alias("archive_count"),
        F.coalesce("byte_count", F.lit(0)).alias("byte_count"),
    )


def _folder_hour() -> Column:
    return F.timestamp_add("HOUR", F.col("archive_hour"), F.col("archive_date").cast("timestamp"))


def _lines(spark: SparkSession, raw_root: str, paths: Sequence[str] | None) -> DataFrame:
    """Text lines of gzip archives, blank lines included, with file and hour."""
    reader = spark.read.schema(_LINES).option("pathGlobFilter", "*.gz")
    reader = reader.option("basePath", zone(raw_root))
    return reader.text(zone(raw_root) if paths is None else list(paths))


def read_archives(
    spark: SparkSession, raw_root: str, paths: Sequence[str] | None = None
) -> DataFrame:
    """Lines with `archive_hour, source_file, source_line_number` (from 1, blanks counted).

    A gzip file is never split, so a file's lines have consecutive row ids in one task and
    the line number is the id minus the file's first id. Only one number per file crosses the
    network, never a line: a window over the file would shuffle and sort the whole text. The
    price is a second, parse-free pass; a load avoids even that, see `read_planned`.
    """
    lines = _lines(spark, raw_root, paths).select(
        "value",
        _folder_hour().alias("archive_hour"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    first = lines.groupBy("file_path").agg(F.min("row_id").alias("first_row_id"))
    return lines.join(first, "file_path").select(
        "value",
        "archive_hour",
        "source_file",
        (F.col("row_id") - F.col("first_row_id") + 1).alias("source_line_number"),
    )
