"""Inputs and helpers of the tests of this folder."""

from pathlib import Path

from tickflow.session import scratch_path

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(15_000)) + "\n" + "again and again\n" * 300


def on_disk(spark):
    """Bytes of shuffle files and of tables below the checkpoint folder."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    blocks = sum(files.apply(i).length() for i in range(files.size()))
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    return blocks + sum(f.stat().st_size for f in root.rglob("*") if f.is_file())
