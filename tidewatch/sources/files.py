"""Events in files: JSON lines, and tables replayed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.parse import parse


def read_json_events(spark: SparkSession, path: str) -> DataFrame:
    """Parsed events of JSON-lines files (see ``parse``)."""
    return parse(spark.read.text(path))


def stream_json_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream of arriving files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse(reader.text(path))


def replay_table(
    spark: SparkSession, folder: str, name: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table as a stream of its files, oldest first. ``name`` picks one file of the folder."""
    pattern = name or "*.parquet"
    reader = spark.readStream.schema(spark.read.parquet(f"{folder}/{pattern}").schema)
    reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


FILE_ROWS = 100_000  # of an arrival that go to one file, about
FEW_FILES = 4  # of an arrival, at least


def arrival_files(rows: int, arrivals: int) -> int:
    """The files to put each of so many arrivals of ``rows`` rows down in: tasks that write and read them have about
    ``FILE_ROWS`` rows, so that more rows go to more tasks."""
    return max(FEW_FILES, -(-rows // (arrivals * FILE_ROWS)))


def write_arrivals(rows: DataFrame, arrival: str, path: str, numbers: range, files: int = FEW_FILES) -> None:
    """Put ``rows`` down in the order they arrive: those of each number of the column ``arrival`` in a folder of
    ``files`` files, one folder after the other."""
    for number in numbers:
        some = rows.where(F.col(arrival) == number).drop(arrival)
        # Dealing rows out in turn leaves no file empty, but sorts them first. Where there are many, their hash does.
        some = some.repartition(files) if files <= FEW_FILES else some.repartition(files, *some.columns)
        some.write.mode("overwrite").parquet(f"{path}/arrival-{number}")


def replay_arrivals(spark: SparkSession, path: str, schema: T.StructType, files: int = FEW_FILES) -> DataFrame:
    """The stream of what ``write_arrivals`` has put down, a number per trigger. Numbers need so many rows that none of
    their files is empty."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path}/arrival-*")
