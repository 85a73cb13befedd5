"""Registry of named queries, each with the survey entries it covers and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.runtime import on_store, ship_package, stages_dropped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, list[str]] = {}
MODULE_OF: dict[str, str] = {}


class Tables:
    """Attribute access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(ids: str, sql: str | None = None):
    """Register a function of Tables under its own name."""

    def wrap(fn):
        name = fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        COVERS[name] = ids.split()
        MODULE_OF[name] = fn.__module__.rsplit(".", 1)[-1]
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


def once(fn):
    """Keep what a costly step over one folder has given for the queries that share it, for as long as the session has stages."""
    held: dict = {}

    def run(t: Tables):
        key = (t.spark.sparkContext.applicationId, t.folder, listing(t), stages_dropped(t.spark))
        if key not in held:
            held.clear()
            held[key] = fn(t)
        return held[key]

    return run


def listing(t: Tables) -> tuple:
    """Names, sizes and times of what lies in the folder, so that nothing is kept beyond a change of its tables."""
    where, store = on_store(t.spark, t.folder)
    files, found = store.listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def by_folder(fn):
    """Keep a small result (not a DataFrame) of a costly fit over the files of one folder."""
    held: dict = {}

    def run(t: Tables):
        key = (t.spark.sparkContext.applicationId, t.folder, listing(t))
        if key not in held:
            held[key] = fn(t)
        return held[key]

    return run
