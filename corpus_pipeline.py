"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of documents.
Further columns of a caller's table, whatever their names, are left out at the door of every stage and change nothing; an empty table gives
an empty result of every stage; texts are judged whole, however long. What nulls, blanks and repeated rows mean stands with each stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, linededup, minhash, mixing, toxicity
from tallyloom.llm.common import DOCUMENT, table
from tallyloom.runtime import ship_package, stage


def drop_toxic(spark, docs, sf_dir):
    """Documents that the ordinal model, fitted on `labels`, does not reject.

    A null or wordless text holds no evidence and stays; rows that repeat a doc_id are judged each by its text; without labels of both kinds all stay.
    """
    ship_package(spark)
    return toxicity.drop_toxic(docs.select(DOCUMENT), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark, docs, sf_dir):
    """Texts without lines that repeat an earlier line, within edits that grow with its length; n_chars follows the text.

    Empty lines, null texts and rows without doc_id stay as they are; a document that loses every line goes; rows that repeat a doc_id are one document
    and lose the same lines.
    """
    ship_package(spark)
    kept = linededup.drop_repeated_lines(docs.select(*DOCUMENT, F.length("text").alias("was")))
    changed = F.col("was") != F.length("text")
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(DOCUMENT)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of every group that shares four fifths of its five-word shingles: the one with the smallest id.

    Null, empty and blank texts, and rows without doc_id, are no one's copies and stay; rows that repeat a doc_id stay or go together.
    """
    ship_package(spark)
    return minhash.drop_near_duplicates(docs.select(DOCUMENT))


def drop_contaminated(spark, docs, sf_dir):
    """Documents of which less than a twentieth of the words stand in benchmark passages.

    A null or wordless text has no hits and stays; rows that repeat a doc_id stay or go together; an empty benchmark leaves all.
    """
    ship_package(spark)
    return decontaminate.remove_documents(docs.select(DOCUMENT), table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """The mix of four fifths of the tokens by domain, language and source, with the epoch and the leading tokens to take.

    Texts without tokens never enter the mix; a null language or source is a branch of its own; rows that repeat a doc_id count each.
    """
    ship_package(spark)
    return mixing.mixed(docs.select(DOCUMENT), mixing.production_levels(), mixing.PRODUCTION_WEIGHTS, mixing.production_budget(), mixing.PRODUCTION_EPOCHS)


STAGES = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("mixing", mix_sources),
]
# The fitted toxicity model cannot be said in SQL; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else stage(docs)
    return docs
