"""Reading raw events, and the tables that the steps of a run hand on."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("ts", T.LongType()),
    ]
)


def read_json_events(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with the event schema given, so the input is read once.

    A line that cannot be parsed has no user and is dropped by cleaning; with
    ``keep_corrupt`` its text is in ``_corrupt_record``.
    """
    schema = T.StructType(list(EVENT_SCHEMA.fields))
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def observe_lines(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """``lines`` (read with ``keep_corrupt``) and what the first action over them counts
    on the way: ``lines`` and ``bad_lines``, those that could not be parsed."""
    seen = Observation("lines")
    counted = lines.observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count(F.col(CORRUPT)).alias("bad_lines")
    )
    return counted, seen


def infer_json_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with every column found in the data, at the cost of a second read."""
    return spark.read.json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(table: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path`` and read it back.

    The new files are written next to it and take its place when all of them are there,
    so ``table`` may be read from ``path`` itself, and a job that fails leaves the old
    table as it was. Taking the place is two renames of folders: readers should not
    start in between, and the swap is no transaction on a store without renames. Staged
    folders have a leading dot, which Spark's readers skip.
    """
    spark = table.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    mark = uuid4().hex
    staged, old = (
        jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{kind}-{mark}") for kind in ("staged", "old")
    )
    try:
        table.write.parquet(staged.toString())
        replaced = files.exists(target)
        if replaced and not files.rename(target, old):
            raise OSError(f"cannot move the old table away from {path}")
        if not files.rename(staged, target):
            if replaced:
                files.rename(old, target)
            raise OSError(f"cannot move the new table to {path}")
        if replaced:
            files.delete(old, True)
    finally:
        if files.exists(staged):
            files.delete(staged, True)
    return spark.read.parquet(path)


def name_table(table: DataFrame, name: str) -> DataFrame:
    """Make a table known to SQL and return it as read by that name."""
    table.createOrReplaceTempView(name)
    return table.sparkSession.table(name)
