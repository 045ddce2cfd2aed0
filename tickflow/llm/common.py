"""Expressions and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import scratch_path

#: Word separators: the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs of other characters than SPACE; null text has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table below the shared checkpoint folder and reads it back.

    Cuts the lineage, fixes row ids and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` that also removes the shuffle files of the run: without it they stay until the driver collects its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return materialize(df, name)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote, when nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
