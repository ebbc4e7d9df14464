"""CSV with and without header, read leniently and in parallel; CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import archives


def csv_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with a header line and a known schema."""
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of text files; long files are split."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def csv_autoheader(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files of which some have a header: lines whose first field holds a letter are dropped. All columns are text."""
    lines = text_lines(spark, path).filter(F.length(F.trim("line")) > 0).filter(~archives.is_header(F.col("line")))
    parts = F.split("line", ",")
    return lines.select("file", *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def lenient_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their ``line``): a value that doesn't fit its type rejects its own line only."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.csv(path, header=True, schema=full, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=False)
    return rows.filter("_bad is null").drop("_bad"), rows.filter("_bad is not null").withColumnRenamed("_bad", "line")


def write_csv(df: DataFrame, path: str, header: bool = True, overwrite: bool = False) -> None:
    df.write.option("header", header).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").mode("overwrite" if overwrite else "errorifexists").csv(path)


def raw_snapshot(df: DataFrame, root: str, run: str, columns: list[str]) -> str:
    """Write a batch as it came, before any verdict, under its run id."""
    path = f"{root}/run_id={run}"
    write_csv(df.select(*columns), path)
    return path
