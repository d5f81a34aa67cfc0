"""File scans and sinks (S1-S7): CSV with explicit schemas, Parquet, JSON."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.session import intermediate_path
from cartwise.sources import schemas


def read_csv(spark: SparkSession, path: str, schema=None, timestamp_format: str | None = None) -> DataFrame:
    """CSV with a header. A declared schema skips the inference pass."""
    reader = spark.read.option("header", True)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out: str | None = None,
    required: Sequence[str] = (),
    header: bool = True,
    timestamp_format: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scan CSV once into good rows and rejects (S1-S3): ``(good, rejects)``, which add up to the input.

    ``good`` has the declared columns. A row is rejected when a field does not parse as its type, when it has too few or
    too many fields (``reason`` ``malformed``), or when a ``required`` column is empty (``missing <column>``, the first one).
    ``rejects(file, reason, record)`` keeps the record as it stands in the file, or, for a missing value, written again from its fields.

    Both are parts of one Parquet table written to ``out`` (default: an intermediate), so the text is parsed once however
    often either is read. All columns are parsed whatever is read later, so a row's fate does not depend on the query.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").option("columnPruning", False)
    again = {}
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
        again = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    df = reader.schema(T.StructType([*schema.fields, T.StructField("_record", T.StringType())])).csv(path)
    reason = F.when(F.col("_record").isNotNull(), F.lit("malformed"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"missing {c}"))
    text = F.coalesce("_record", F.to_csv(F.struct(*schema.fieldNames()), again))
    tagged = df.select(*schema.fieldNames(), F.col("_metadata.file_path").alias("_file"), reason.alias("_reason"), F.when(reason.isNotNull(), text).alias("_record"))
    out = out or intermediate_path(spark)
    # a plain column, not a folder: rows are written as they are parsed, none is held to be sorted
    tagged.withColumn("_rejected", reason.isNotNull()).write.mode("overwrite").parquet(out)
    table = spark.read.schema(T.StructType([*tagged.schema.fields, T.StructField("_rejected", T.BooleanType())])).parquet(out)
    good = table.where(~F.col("_rejected")).select(*schema.fieldNames())
    return good, table.where("_rejected").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record"))


def read_grocery_csv(spark: SparkSession, data_path: str, table: str) -> DataFrame:
    """One of the grocery CSV files (``orders``, ``order_products__prior`` ...) by name."""
    return read_csv(spark, os.path.join(data_path, f"{table}.csv"), schemas.CSV_TABLES[table])


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned transaction file with a parsed ``transaction_date`` (S3)."""
    return read_csv(spark, path, schemas.TRANSACTIONS, timestamp_format="yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]")


def read_parquet(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Parquet scan. ``partitions`` (off by default) deals the rows out round-robin, for a table stored
    as a single split."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table (S4, S6): parquet by default, ``csv`` with a header, or ``json``."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a table written by ``write_table`` (S5, S7). A missing path raises FileNotFoundError."""
    try:
        if fmt == "csv":
            return read_csv(spark, path, schema)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.json(path) if fmt == "json" else reader.parquet(path)
    except Exception as exc:  # AnalysisException [PATH_NOT_FOUND]
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(f"no table at {path}; train and save it first") from exc
        raise
