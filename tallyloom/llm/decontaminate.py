"""Benchmark decontamination with a broadcast set of normalised n-grams, in DataFrame operations only.

A window is n consecutive words of a benchmark item (the whole item if it has fewer). Each window is filed under its
longest word. One pass over the documents explodes their words, looks each word up in the broadcast windows and compares the
window with the words around it; only true hits leave the task. A blank word put before every document always matches,
so documents without hits come through the same pass.

Defined results: null or wordless text has no words, no hits and is not contaminated; an empty benchmark hits nothing; items
without words have no window; rows that repeat a doc_id count as one document in `judge` and are kept or dropped together; further columns stay as
they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import columns, lower_ascii, sha256_of, unused

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Windows per broadcast block: about 30 MB. A larger benchmark is answered in several blocks.
BLOCK_WINDOWS = 100_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(anchor, back, len, gram, items): every distinct window, its longest word and that word's offset."""
    items = columns(benchmark, "item_id", "text").select("item_id", words_of(F.col("text")).alias("w")).filter("size(w) > 0")
    items = items.withColumn("len", F.least(F.size("w"), F.lit(n)))
    starts = items.select("item_id", "w", "len", F.explode(F.expr("sequence(1, size(w) - len + 1)")).alias("s"))
    grams = starts.select("item_id", "len", F.slice("w", F.col("s"), F.col("len")).alias("g"))
    longest = F.expr("array_max(transform(g, (x, i) -> struct(length(x) AS size, -i AS minus, x AS word)))")
    grams = grams.select("item_id", "len", F.array_join("g", " ").alias("gram"), longest.alias("a"))
    return grams.groupBy(F.col("a.word").alias("anchor"), (-F.col("a.minus")).alias("back"), "len", "gram").agg(
        F.collect_set("item_id").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(doc_id, n_words, s, e, items): every window occurrence by word positions from 1, and one row with null s per document."""
    known = windows(benchmark, n).persist()
    try:
        blocks = max(1, -(-known.count() // BLOCK_WINDOWS))
        known = known.sparkSession.createDataFrame(known.collect(), known.schema) if blocks == 1 else known
    finally:
        known.unpersist()
    blank = known.sparkSession.range(1).select(
        F.lit("").alias("anchor"), F.lit(0).alias("back"), F.lit(0).alias("len"), F.lit("").alias("gram"),
        F.lit(None).cast(known.schema["items"].dataType).alias("items"))
    words = columns(docs, "doc_id", "text").select("doc_id", words_of(F.col("text")).alias("w"))
    placed = words.select("doc_id", "w", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("pos", "anchor"))
    found = None
    for b in range(blocks):
        part = known if blocks == 1 else known.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b)
        part = part.unionByName(blank) if b == 0 else part
        s, stop = F.expr("pos - back"), F.expr("pos - back + len - 1")
        same = F.array_join(F.slice("w", F.greatest(s, F.lit(1)), F.col("len")), " ") == F.col("gram")
        at = placed.join(F.broadcast(part), "anchor").filter((F.col("len") == 0) | ((s >= 1) & (stop <= F.col("n_words")) & same))
        real = F.col("len") > 0
        at = at.select("doc_id", "n_words", F.when(real, s).alias("s"), F.when(real, stop).alias("e"), "items")
        found = at if found is None else found.unionByName(at)
    return found


def judge(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """One row per doc_id: word, hit-word and item counts, the hit spans, and whether 1/share of the words or more are hit."""
    found = hits(docs, benchmark, n).groupBy("doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", "e")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.expr("""aggregate(spans, struct(0L AS n, 0 AS upto), (a, x) -> struct(
        a.n + greatest(0, x.e - greatest(x.s - 1, a.upto)) AS n, greatest(a.upto, x.e) AS upto)).n""")
    out = found.withColumn("n_hit", covered.cast("long"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha256_of(names).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans")


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The rows whose document is not contaminated, all columns untouched."""
    name = unused(docs, "_bad")
    bad = judge(docs, benchmark, n, share).filter("contaminated").select(F.col("doc_id").alias(name))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """All rows; words inside a window occurrence are cut out of `text`, what stands between words stays."""
    key, spans, word, gap = (unused(docs, c) for c in ("_id", "_spans", "_w", "_g"))
    at = judge(docs, benchmark, n).filter("n_hit > 0").select(F.col("doc_id").alias(key), F.col("spans").alias(spans))
    joined = docs.join(at, docs["doc_id"].eqNullSafe(F.col(key)), "left")
    # Words before lower-casing, and what stands around them.
    words = F.array_remove(F.split(F.col("text"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), "")
    joined = joined.withColumn(word, F.when(F.col(spans).isNotNull(), words)).withColumn(
        gap, F.when(F.col(spans).isNotNull(), F.split(F.col("text"), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)))
    kept = F.expr(f"""array_join(transform({gap}, (g, i) -> concat(
        g, if(i >= size({word}) OR exists({spans}, x -> i + 1 >= x.s AND i + 1 <= x.e), '', {word}[i]))), '')""")
    return joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(kept)).drop(key, spans, word, gap)
