"""CSV masters and samples, and tables that may not exist yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt import schemas

SAMPLE_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSSS"


def read_machine_master(spark: SparkSession, path: str) -> DataFrame:
    """Asset master; the text ``NULL`` means null."""
    return (
        spark.read.schema(schemas.MACHINE_MASTER)
        .option("header", True)
        .option("nullValue", "NULL")
        .csv(path)
    )


def read_bms_sample(spark: SparkSession, path: str) -> DataFrame:
    """Climate sample: readings are a quoted JSON object; its members stay text until cast."""
    rows = spark.read.schema(schemas.SAMPLE_BMS).option("header", True).option("escape", '"').csv(path)
    return rows.withColumn("timebucket", F.to_timestamp("timebucket", SAMPLE_TIME)).withColumn(
        "value", F.from_json("value", "map<string,string>")
    )


def read_ems_sample(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.SAMPLE_EMS).option("header", True).csv(path)
    return rows.withColumn("timebucket", F.to_timestamp("timebucket", SAMPLE_TIME))

NOTHING_THERE = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
    """What ``read`` returns, or an empty frame of ``schema`` where the source is missing or empty."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in NOTHING_THERE:
            return empty(spark, schema)
        raise


def erp_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Landed business table with its change columns; empty while nothing was captured."""
    schema = f"{schemas.ERP_TABLES[name]}, {schemas.CHANGE_COLUMNS}"
    return or_empty(
        spark, lambda: spark.read.option("mergeSchema", True).parquet(f"{folder}/{name}"), schema
    )


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [status.getPath().toString() for status in found]


def numbered_folders(spark: SparkSession, pattern: str) -> dict[int, str]:
    """Folders named ``<name>=<number>`` that match ``pattern``, by number."""
    return {int(p.rstrip("/").rsplit("=", 1)[1]): p for p in folders(spark, pattern)}


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
