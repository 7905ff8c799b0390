"""Daily frames as JSON records, one folder per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from epochloom.functions.time import day_text


def write_records(daily: DataFrame, path: str) -> None:
    """One JSON-lines file, newest day first, NULLs written out.

    The frame is daily, so one file is small; `repartition` leaves earlier stages parallel.
    """
    (
        daily.withColumn("date", day_text(F.col("date")))
        .repartition(1)
        .sortWithinPartitions(F.desc("date"))
        .write.mode("overwrite")
        .json(path, ignoreNullFields=False)
    )


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read JSON lines written above, or files holding one array of records."""
    return spark.read.schema(schema).option("multiLine", False).json(path)


def read_record_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)
