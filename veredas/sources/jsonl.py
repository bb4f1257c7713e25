"""JSON lines that may hold malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): the lines that parse, by ``schema``, and the others as text."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", options)
    raw = spark.read.text(path).where("trim(value) <> ''").select("value", parsed.alias("r"))
    return raw.where("r._corrupt_record is null").select("r.*").drop("_corrupt_record"), raw.where("r._corrupt_record is not null").select("value")


def with_status(rows: DataFrame, column: str, *, allow: list[str] | None = None, deny: list[str] | None = None) -> DataFrame:
    """Rows whose status is in ``allow``, or not in ``deny``; a null status passes a deny list only."""
    status = F.lower(F.trim(F.col(column)))
    if allow is not None:
        return rows.where(status.isin(allow))
    return rows.where(status.isNull() | ~status.isin(deny or []))


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, for versioned override tables."""
    whole = F.struct(F.col(order).alias("o"), F.struct(*rows.columns).alias("row"))
    return rows.groupBy(F.col(key).alias("_k")).agg(F.max(whole).alias("w")).select("w.row.*")
