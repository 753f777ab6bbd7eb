"""Sinks: dataset, predictions and side-table folders with their records."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

RECORD = "record.json"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_record(spark: SparkSession, folder: str, record: dict[str, Any]) -> None:
    """A small JSON file beside the data, on whatever file system the data is on."""
    fs, p = _fs_path(spark, f"{folder}/{RECORD}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(record, sort_keys=True, indent=1).encode()))
    finally:
        out.close()


def read_record(spark: SparkSession, folder: str) -> dict[str, Any]:
    lines = spark.read.text(f"{folder}/{RECORD}", wholetext=True).first()
    return json.loads(lines[0])


def write_dataset(df: DataFrame, folder: str, partition: str | None = None) -> None:
    """Snappy parquet; refuses to write over an existing dataset.

    With ``partition``, one folder per value of that column (a split bucket, say),
    so a slice by it reads only the folders it needs. Rows are dealt by the column
    first, large values over several files.
    """
    dealt = df.hint("rebalance", partition) if partition else df
    writer = dealt.write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{folder}/data")


def write_predictions(predictions: DataFrame, folder: str, key: list[str], label: str = "") -> dict[str, Any]:
    """Key columns and ``y_pred`` with a manifest holding the row count."""
    missing = [c for c in (*key, "y_pred") if c not in predictions.columns]
    if missing:
        raise ValueError(f"predictions lack {missing}")
    spark = predictions.sparkSession
    predictions.select(*key, predictions["y_pred"].cast("double").alias("y_pred")).write.mode(
        "errorifexists").parquet(f"{folder}/data")
    manifest = {"key": key, "label": label, "row_count": spark.read.parquet(f"{folder}/data").count()}
    write_record(spark, folder, manifest)
    return manifest


def load_predictions(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, Any]]:
    manifest = read_record(spark, folder)
    df = spark.read.parquet(f"{folder}/data")
    if set(df.columns) != {*manifest["key"], "y_pred"}:
        raise ValueError(f"prediction columns {df.columns} do not match the manifest")
    return df, manifest


def write_side_table(df: DataFrame, folder: str, record: dict[str, Any]) -> str:
    """External evaluation rows or an augmentation: data first, record last.

    A folder with a record is complete and reused; data without its record is a
    broken write and is an error; otherwise the table is written.
    """
    spark = df.sparkSession
    done, started = exists(spark, f"{folder}/{RECORD}"), exists(spark, f"{folder}/data")
    if done:
        if not exists(spark, f"{folder}/data/_SUCCESS"):
            raise ValueError(f"{folder}: record without complete data")
        return "reused"
    if started:
        raise ValueError(f"{folder}: data without a record, an earlier write broke off")
    df.write.mode("errorifexists").parquet(f"{folder}/data")
    write_record(spark, folder, record)
    return "written"


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    spark.read.option("header", True).option("inferSchema", True).csv(csv_path).write.mode("overwrite").parquet(
        parquet_path)
    return spark.read.parquet(parquet_path)
