"""CSV and parquet files in a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators.materialise import overwrite_table
from tidemark.operators.quality import load_schema


def read_headerless_csv(
    spark: SparkSession, path: str, schema: StructType | str, partitions: int | None = None
) -> DataFrame:
    """CSV (plain or gzip) without header; columns by position.

    A gzip file is one task however large it is, so a few big files should be spread out:
    ``partitions`` adds a round-robin exchange after the scan.
    """
    df = spark.read.schema(schema).csv(path)
    return df.repartition(partitions) if partitions else df


def load_directory(spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.csv.gz") -> DataFrame:
    """Bulk load: files of a directory whose name fits ``pattern``, first line of each skipped.

    Columns go by position, whatever the header line says.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def load_seed(spark: SparkSession, path: str, schema: StructType | str, view: str | None = None) -> DataFrame:
    """A small CSV with header and known types, optionally published as a view."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_inferred_csv(
    spark: SparkSession, path: str, table: str | None = None, table_path: str | None = None
) -> DataFrame:
    """A CSV whose types are guessed by a pass over the data; for files of seed size.

    The words ``None`` and ``none`` stay text: only an empty field is null.  With ``table``
    the result is stored under that name and read back from there.
    """
    df = spark.read.option("header", True).option("inferSchema", True).option("nullValue", "").csv(path)
    if table is None:
        return df
    return overwrite_table(df, table, path=table_path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``operators.materialise.checkpoint_frame`` wrote, under its stored schema."""
    return spark.read.schema(load_schema(spark, f"{path}/schema")).parquet(f"{path}/data")
