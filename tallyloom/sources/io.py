"""Scans with provenance tags, named sheets, and table / file sinks."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tag(df: DataFrame, value: str, column: str = "type") -> DataFrame:
    """Put a constant provenance column in front of the relation."""
    return df.select(F.lit(value).alias(column), "*")


def scan_table(spark: SparkSession, table: str, tag_value: str | None = None) -> DataFrame:
    df = spark.table(table)
    return tag(df, tag_value) if tag_value is not None else df


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             corrupt_column: str | None = None) -> DataFrame:
    """CSV with a declared schema; fields that do not parse are NULL.

    With `corrupt_column`, lines that do not fit are kept with their text in it. Spark parses only the columns a query
    reads, and a column that is not read cannot tell a bad line, so the text column is tied to all the others.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if not corrupt_column:
        return reader.schema(schema).csv(path, header=header)
    full = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    df = reader.option("columnNameOfCorruptRecord", corrupt_column).schema(full).csv(path, header=header)
    every_column = F.hash(*schema.names) >= F.lit(-2**31)  # true for any row, but needs all columns
    return df.withColumn(corrupt_column, F.when(every_column, F.col(corrupt_column)))


def register_sheets(spark: SparkSession, sheets: dict[str, str], schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """Register one Parquet or CSV path per sheet as temporary views that can be queried together."""
    for name, path in sheets.items():
        if path.rstrip("/").endswith(".csv"):
            if not schemas or name not in schemas:
                raise ValueError(f"sheet {name}: a CSV sheet needs a declared schema")
            df = scan_csv(spark, path, schemas[name])
        else:
            df = spark.read.parquet(path)
        df.createOrReplaceTempView(name)
    return list(sheets)


def save_table(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Parquet table in the catalog; with a path the files stay there instead of in the warehouse."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=header)


def flatten_rules(rules: DataFrame) -> DataFrame:
    """Array columns of a rule set as comma-joined text, so that it fits a flat file."""
    arrays = [f.name for f in rules.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return rules.select(*[
        F.concat_ws(",", F.array_sort(c)).alias(c) if c in arrays else F.col(c) for c in rules.columns
    ])


def save_rules(rules: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    flat = flatten_rules(rules)
    if fmt == "csv":
        save_csv(flat, path, header=True, mode=mode)
    else:
        flat.write.mode(mode).format(fmt).save(path)


def publish(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project and rename for a dashboard: {source column: published name}."""
    missing = [c for c in names if c.lower() not in {d.lower() for d in df.columns}]
    if missing:
        warnings.warn(f"columns not in the relation: {missing}", stacklevel=2)
    return df.select(*[F.col(src).alias(dst) for src, dst in names.items() if src not in missing])
