"""Sources, sinks and catalogue."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, name: str, sf_dir: str | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """A1: a whole table by name: parquet under ``sf_dir``, JDBC (``fmt='jdbc'`` plus
    url/partitionColumn/lowerBound/upperBound/numPartitions options), or the catalog."""
    if fmt == "jdbc":
        reader = spark.read.format("jdbc").option("dbtable", name)
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load()
    if sf_dir is None:
        return spark.table(name)
    return spark.read.format(fmt).options(**options).load(table_path(sf_dir, name))


def jdbc_options_from_env(prefix: str = "TABULARK_DB_") -> dict:
    """Connection settings from the environment (no default password)."""
    keys = {"URL": "url", "USER": "user", "PASSWORD": "password", "DRIVER": "driver"}
    return {v: os.environ[prefix + k] for k, v in keys.items() if prefix + k in os.environ}


def register_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for n in names:
        read_table(spark, n, sf_dir).createOrReplaceTempView(n)


def run_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """A2: SQL text to a frame; values are bound with ``args`` (named ``:markers``),
    never formatted into the text."""
    return spark.sql(sql, args=args or None)


def list_tables(spark: SparkSession) -> list[str]:
    """A3: table and view names visible to the session."""
    return sorted(t.name for t in spark.catalog.listTables())


def read_csv_latin1(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A4: latin-1 CSV with a header. Give ``schema`` on a cluster; without it the
    types are inferred (one extra pass)."""
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_activity_csv(spark, base_path: str, filename: str = "Full_vle_train.csv", schema=None):
    return read_csv_latin1(spark, f"{base_path.rstrip('/')}/{filename}", schema)


def read_assessment_csv(spark, base_path: str, filename: str = "Full_assess_train.csv", schema=None):
    return read_csv_latin1(spark, f"{base_path.rstrip('/')}/{filename}", schema)


def write_table(df: DataFrame, name_or_path: str, if_exists: str = "replace", fmt: str = "parquet",
                **options) -> None:
    """A5: frame to a table; ``replace`` / ``append`` / ``fail`` like the reference."""
    mode = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}[if_exists]
    if fmt == "jdbc":
        w = df.write.format("jdbc").mode(mode).option("dbtable", name_or_path)
        for k, v in options.items():
            w = w.option(k, v)
        w.save()
    elif fmt == "table":
        df.write.mode(mode).saveAsTable(name_or_path)
    else:
        df.write.mode(mode).format(fmt).options(**options).save(name_or_path)


def write_report_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    """A report-sized frame as one CSV file with a header; row-level output takes
    ``one_file=False`` and is written by all tasks."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """A Spark ML model, or any model of ``ml.models`` with its scaling and encoders."""
    from ..ml.models import Fitted, save_fitted
    if isinstance(model, Fitted):
        save_fitted(model, path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str, spark=None):
    """What ``save_model`` wrote."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import SparkSession

    from ..ml.models import is_fitted, load_fitted
    spark = spark or SparkSession.active()
    return load_fitted(spark, path) if is_fitted(spark, path) else PipelineModel.load(path)
