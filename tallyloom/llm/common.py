"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further or clashing columns of a caller cannot interfere."""
    return df.select(*[df[n] for n in names])


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that is no column of the frame (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, nameless, text): a null id as 0 with a mark, since whole numbers with nulls reach pandas as doubles."""
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("doc_id"), docs["doc_id"].isNull().alias("nameless"), docs["text"].alias("text"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def sha256_of(parts: Column) -> Column:
    """Lowercase hex digest of an array of strings joined by commas."""
    return F.sha2(F.concat_ws(",", parts), 256)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
