"""Writers: partitioned tables, warehouse relations, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from routeline.operators.bronze import stamp


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def write_silver(df: DataFrame, path: str, partition_by: str, fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``, so a rerun of a day leaves one copy.

    The rebalance hint groups rows by partition value, joins small values into one task and
    splits a value that holds most of the rows over many.
    """
    (df.hint("rebalance", partition_by).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).save(path))


def materialize(name: str, df: DataFrame, kind: str, root: str | None = None,
                as_of: str | None = None, stamp_column: str = "dbt_loaded_at") -> DataFrame:
    """Publish a model as a temporary view, or as a table folder below ``root`` with its view.
    Tables carry a load time."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError("kind must be view or table")
    path = f"{root}/{name}"
    stamp(df, stamp_column, as_of).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored


def write_with_manifest(datasets: dict[str, DataFrame], root: str) -> DataFrame:
    """Write each dataset to a folder below ``root``; one row per dataset with its rows and columns.

    The rows are counted by an observation of the write itself, so nothing is read back. A task that is done
    again because an executor was lost is observed once.
    """
    written = []
    for name, df in datasets.items():
        seen = Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/{name}")
        written.append((name, seen.get["rows"], list(df.columns)))
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame(written, "dataset string, rows long, columns array<string>")


def write_report(report: DataFrame, path: str) -> None:
    """Append one JSON document per report row."""
    report.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def read_reports(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
