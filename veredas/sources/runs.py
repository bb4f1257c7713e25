"""Run folders: one partition per run date, written over as a whole, and their history."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_run(df: DataFrame, root: str, artifact: str, run_date: str) -> None:
    """Replaces one run's partition of an artifact; the other runs stay."""
    rows = df.drop("run_date").withColumn("run_date", F.lit(run_date))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(f"{root}/{artifact}")


def read_artifact(spark: SparkSession, root: str, artifact: str) -> DataFrame | None:
    """All runs of an artifact; None if it was never written."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(f"{root}/{artifact}").withColumn("run_date", F.col("run_date").cast("string"))
    except AnalysisException:
        return None


def run_dates(spark: SparkSession, root: str, artifact: str, window: int | None = 14) -> list[str]:
    """The last ``window`` run dates (all without one), in order: from the names of the partitions alone, no file is read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{artifact}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = (found.getPath().getName() for found in files.listStatus(path) if found.isDirectory())
    dates = sorted(unquote(n.removeprefix("run_date=")) for n in names if n.startswith("run_date="))
    return dates if window is None else dates[-window:]


def latest_before(spark: SparkSession, root: str, artifact: str, run_date: str) -> DataFrame | None:
    """The newest run before ``run_date``; only its partition is read."""
    earlier = [d for d in run_dates(spark, root, artifact, None) if d < run_date]
    rows = read_artifact(spark, root, artifact) if earlier else None
    return rows.where(F.col("run_date") == earlier[-1]) if rows is not None else None


def write_json_lines(df: DataFrame, path: str) -> None:
    """Rows as JSON with keys in order, nulls kept, one document a line."""
    ordered = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(ordered.alias("value")).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, root: str, artifacts: list[str], run_date: str) -> DataFrame:
    """(artifact, run_date, rows, columns): what a run has written."""
    found = None
    for name in artifacts:
        rows = read_artifact(spark, root, name)
        width = 0 if rows is None else len(rows.columns) - 1
        one = spark.range(1).select(F.lit(0).cast("long").alias("rows")) if rows is None else rows.where(F.col("run_date") == run_date).agg(F.count("*").alias("rows"))
        one = one.select(F.lit(name).alias("artifact"), F.lit(run_date).alias("run_date"), "rows", F.lit(width).alias("columns"))
        found = one if found is None else found.unionByName(one)
    return found
