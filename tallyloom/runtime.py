"""Session factory, lineage cutting and ordered running totals shared by the operators."""

from __future__ import annotations

import os
import uuid
import zipfile
from contextlib import contextmanager

from pyspark import SparkFiles, StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of a side that may be broadcast once its size has been checked or is bounded by construction.
BROADCAST_ROWS = 100_000


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that it need not be installed on them."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.join(SparkFiles.getRootDirectory(), "package")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for top, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster. Where none is set it is one below the warehouse, unless that is a local folder of a machine of a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_stages"


# Folders written by this process, per application, until they are dropped.
_WRITTEN: dict[str, set[str]] = {}


_DROPPED: dict[str, int] = {}


def stages_dropped(spark: SparkSession) -> int:
    """How often the stages of this session have been dropped: what was kept before is gone."""
    return _DROPPED.get(spark.sparkContext.applicationId, 0)


def on_store(spark: SparkSession, path: str):
    """(path, file system) as Spark's readers see them."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_stages(spark: SparkSession) -> None:
    """Delete all folders that this session has written: call it once a result has been read. What is left goes with the session."""
    app = spark.sparkContext.applicationId
    held = _WRITTEN.pop(app, set())
    _DROPPED[app] = stages_dropped(spark) + 1
    for path in held:
        where, store = on_store(spark, path)
        store.delete(where, True)


def stage(df: DataFrame) -> DataFrame:
    """Cut lineage through a written table: computed once, and readable after executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(staged: DataFrame) -> None:
    """Delete the folder of one written table that nothing will read any more."""
    spark = staged.sparkSession
    held = _WRITTEN.get(spark.sparkContext.applicationId, set())
    names = {f.rsplit("/", 2)[-2] for f in staged.inputFiles()}
    for path in [p for p in held if p.rsplit("/", 1)[-1] in names]:
        held.discard(path)
        where, store = on_store(spark, path)
        store.delete(where, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Written once, and broadcast if a count shows that it is small; otherwise left to an ordinary join."""
    kept = stage(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


@contextmanager
def persisted(df: DataFrame):
    """Keep an intermediate that several actions read, and let it go afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    where, store = on_store(spark, path)
    store.deleteOnExit(where)
    return path


# What one task takes of a scan that `spread` deals anew: rows, and bytes of its files.
SPREAD_ROWS = 10_000
SPREAD_BYTES = 16 << 20


def spread(scan: DataFrame, *keys: str, rows: int = SPREAD_ROWS) -> DataFrame:
    """Give row-heavy work on a scan at least one task per core, and tasks of bounded size however few files the table comes in.

    Only a scan of fewer files than cores is repartitioned; a table of more files is left alone.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = scan.inputFiles()
    # A file of a scan gives at least one split; only when there are fewer files than cores can it have too few.
    if len(files) >= cores:
        return scan
    size = sum(store.getFileStatus(where).getLen() for where, store in (on_store(spark, f) for f in files))
    return scan.repartition(max(cores, -(-scan.count() // rows), -(-size // SPREAD_BYTES)), *keys)


def running_totals(df: DataFrame, order_by: list, sums: dict[str, str]) -> DataFrame:
    """Inclusive running total of each source column in global order, without a single-partition window.

    Rows are range-partitioned by the order (which should end in a unique tiebreak, so that equal leading
    keys still split over tasks) and written once; one total per slice then gives every slice its offset.
    """
    spark = df.sparkSession
    # No explicit number: small neighbouring ranges may be merged at run time, which keeps their order.
    placed = stage(df.repartitionByRange(*order_by).withColumn("_slice", F.spark_partition_id()))
    totals = placed.groupBy("_slice").agg(*[F.sum(src).alias(out) for out, src in sums.items()])
    # One row per shuffle partition: bounded by configuration, not by the data.
    per_slice = sorted(totals.collect(), key=lambda r: r["_slice"])
    running = {out: 0 for out in sums}
    offsets = []
    for row in per_slice:
        offsets.append((row["_slice"], *[running[out] for out in sums]))
        running = {out: running[out] + (row[out] or 0) for out in sums}
    types = dict(totals.dtypes)
    schema = "_slice int, " + ", ".join(f"_off_{out} {types[out]}" for out in sums)
    offset_df = spark.createDataFrame(offsets, schema)
    window = Window.partitionBy("_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    out_df = placed.join(F.broadcast(offset_df), "_slice")
    out_df = out_df.withColumns(
        {out: F.coalesce(F.sum(src).over(window), F.lit(0)) + F.col(f"_off_{out}") for out, src in sums.items()}
    )
    return out_df.drop("_slice", *[f"_off_{out}" for out in sums])


def global_row_number(df: DataFrame, order_by: list, name: str = "row_no") -> DataFrame:
    """1-based position of every row in a stated total order."""
    return running_totals(df.withColumn("_one", F.lit(1).cast("long")), order_by, {name: "_one"}).drop("_one")


def key_hash(*cols) -> "F.Column":
    """Partition-independent integer in [0, 2^32) from the MD5 of the key text."""
    text = F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_hash(*cols) -> "F.Column":
    """The key hash scaled to [0, 1)."""
    return key_hash(*cols) / F.lit(4294967296.0)


def hot_split_join(facts: DataFrame, keyed: DataFrame, on: list[str], weight: str, share: float = 0.001,
                   hot_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of facts to a materialised table with one row per key, where `weight` counts the fact rows per key.

    If no key has more than `hot_rows` fact rows, an ordinary join cannot overload a task. Otherwise keys holding
    more than `share` of all fact rows (so at most 1/share of them) are broadcast and the rest shuffled, which keeps
    a hot key out of any single task and loses no row. A table of more than `hot_rows` keys is never broadcast, however small its file.
    """
    stats = keyed.agg(F.sum(weight).alias("total"), F.max(weight).alias("top"), F.count(F.lit(1)).alias("keys")).first()
    shuffled = (lambda side: side.hint("merge")) if stats["keys"] > hot_rows else (lambda side: side)
    if (stats["top"] or 0) <= hot_rows:
        return facts.join(shuffled(keyed), on=on)
    lookup = keyed.withColumn("_hot", F.col(weight) > F.lit(max(stats["total"] * share, 1.0)))
    hot = lookup.filter("_hot").drop("_hot")
    cold = lookup.filter("NOT _hot").drop("_hot")
    payload = [c for c in keyed.columns if c not in on]
    marked = facts.join(F.broadcast(hot.select(*on, F.struct(*payload).alias("_pay"))), on, "left")
    hot_part = marked.filter(F.col("_pay").isNotNull())
    hot_part = hot_part.select(*facts.columns, *[F.col(f"_pay.{c}").alias(c) for c in payload])
    cold_part = marked.filter(F.col("_pay").isNull()).drop("_pay").join(shuffled(cold), on=on)
    return hot_part.unionByName(cold_part.select(*hot_part.columns))
