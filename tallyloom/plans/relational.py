"""Queries over scans, projections, filters, joins, sorts, samples and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import scalar as S
from tallyloom.operators import clean, joins, reshape, sampling
from tallyloom.operators.profile import pearson_pairs, top_groups
from tallyloom.plans.common import money_mean, money_mean_sql, views
from tallyloom.plans.registry import query
from tallyloom.sources import io

# 32-bit key hash in DuckDB, equal to runtime.key_hash of the key and the salt.
HASH = "('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{salt}')), 1, 8))::BIGINT"


def duck_hash(key: str, salt: str) -> str:
    return HASH.format(key=key, salt=salt)


@query("J01 L01 L02", """
    SELECT p_brand, count(DISTINCT l_orderkey) AS n_orders
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand ORDER BY n_orders DESC, p_brand LIMIT 10""")
def top_brands_by_orders(t):
    """Brands by the number of distinct orders that contain them."""
    pairs = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_orderkey").distinct()
    return top_groups(pairs, "p_brand", 10, "n_orders")


@query("J01", """
    SELECT o_orderkey, c_name, o_totalprice, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey""")
def joined_projection(t):
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_name", "o_totalprice", "c_acctbal").orderBy(F.desc("o_totalprice"), "o_orderkey"))


@query("J02", f"""
    SELECT {money_mean_sql('c_acctbal')} AS avg_balance, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice < 250000""")
def avg_balance_filtered_join(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).filter("o_totalprice < 250000")
    return joined.agg(money_mean("c_acctbal").alias("avg_balance"), F.count(F.lit(1)).alias("n"))


@query("J03", """
    WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS spend
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
         k AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem)
    SELECT k.*, n_lines, spend FROM k LEFT JOIN r USING (l_orderkey, l_partkey, l_suppkey)""")
def left_join_three_keys(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("spend"))
    return joins.enrich(t.lineitem.select(*keys, "l_linenumber").distinct(), returned, keys)


_AUDIT = """
    SELECT '{name}' AS pair,
           count(*) FILTER (l IS NOT NULL AND r IS NULL) AS left_only,
           count(*) FILTER (r IS NOT NULL AND l IS NULL) AS right_only,
           count(*) FILTER (l IS NOT NULL AND r IS NOT NULL) AS matched,
           count(*) FILTER (coalesce(l, 0) > 1) AS left_repeated,
           count(*) FILTER (coalesce(r, 0) > 1) AS right_repeated,
           CAST(sum(coalesce(l * r, 0)) AS BIGINT) AS joined_rows
    FROM (SELECT {a} AS k, count(*) AS l FROM {left} GROUP BY 1)
    FULL JOIN (SELECT {b} AS k, count(*) AS r FROM {right} GROUP BY 1) USING (k)"""


@query("J04", " UNION ALL ".join([
    _AUDIT.format(name="orders-lineitem", a="o_orderkey", left="orders", b="l_orderkey", right="lineitem"),
    _AUDIT.format(name="orders-customer", a="o_custkey", left="orders", b="c_custkey", right="customer"),
    _AUDIT.format(name="documents-labels", a="doc_id", left="documents", b="doc_id", right="labels")]))
def join_key_audit(t):
    pairs = {
        "orders-lineitem": (t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k"))),
        "orders-customer": (t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))),
        "documents-labels": (t.documents.select(F.col("doc_id").alias("k")), t.labels.select(F.col("doc_id").alias("k"))),
    }
    return reshape.union_by_name(*[io.tag(joins.key_audit(a, b, ["k"]), name, "pair") for name, (a, b) in pairs.items()])


@query("J05", """
    SELECT c_custkey, c_acctbal, n_orders, c_mktsegment
    FROM customer JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1) USING (c_custkey)""")
def column_bind(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return joins.bind_columns([t.customer.select("c_custkey", "c_acctbal"), counts,
                               t.customer.select("c_custkey", "c_mktsegment")], "c_custkey")


@query("S01 P01", "SELECT 'documents' AS type, doc_id, lang, source, n_chars FROM documents")
def tagged_scan(t):
    return io.tag(t.documents.select("doc_id", "lang", "source", "n_chars"), "documents")


@query("S07", """
    SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang""")
def temp_view_sql(t):
    with views(t.spark, documents_cleaned=t.documents):
        return t.spark.sql("SELECT lang, count(*) AS n, sum(n_chars) AS chars FROM documents_cleaned GROUP BY lang")


@query("S09", """
    SELECT lang AS Category, source AS Origin, quality AS Useful, n_chars AS Length
    FROM documents LEFT JOIN labels USING (doc_id)""")
def published_documents(t):
    joined = t.documents.join(t.labels, on="doc_id", how="left")
    return io.publish(joined, {"lang": "Category", "source": "Origin", "quality": "Useful", "n_chars": "Length"})


@query("P02", "SELECT p_partkey, p_brand, p_size FROM part")
def drop_list_projection(t):
    return clean.drop_list(t.part, ["p_name", "p_type", "p_retailprice"])


@query("P02", "SELECT s_suppkey, s_acctbal FROM supplier")
def keep_list_projection(t):
    return clean.keep(t.supplier, ["s_suppkey", "s_acctbal"])


@query("P03", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def positional_slice(t):
    return clean.slice_columns(t.orders, 0, 3, without=(2,))


@query("P04", "SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def renamed_columns(t):
    return t.customer.withColumnsRenamed({"c_acctbal": "balance", "c_mktsegment": "segment"}).select(
        "c_custkey", "balance", "segment")


@query("P05", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def equality_filter(t):
    return t.orders.filter("o_orderstatus = 'F'").filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", "o_totalprice")


@query("P06", """
    SELECT count(*) AS kept, count(*) FILTER (quality IS NULL) AS still_null,
           (SELECT count(*) FROM documents) - count(*) AS removed
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL""")
def not_null_filter(t):
    joined = t.documents.select("doc_id").join(t.labels, on="doc_id", how="left")
    present = F.col("quality").isNotNull()
    return joined.agg(F.count_if(present).alias("kept"), F.count_if(present & F.col("quality").isNull()).alias("still_null"),
                      F.count_if(~present).alias("removed"))


@query("P07 C10", """
    SELECT event_id,
           CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN 0 END AS outcome,
           CASE WHEN event_type IN ('purchase', 'error') THEN 0 ELSE 1 END AS outcome_unknown,
           CASE WHEN value > 50 THEN 1 ELSE 0 END AS high
    FROM events""")
def conditional_columns(t):
    return t.events.select(
        "event_id", S.truth_code("event_type", "purchase", "error").alias("outcome"),
        S.truth_unknown("event_type", "purchase", "error").alias("outcome_unknown"),
        S.flag(F.col("value") > 50).alias("high"))


@query("P08", """
    SELECT event_id, CASE WHEN hour(ts) BETWEEN 8 AND 10 THEN 1 ELSE 0 END AS rush_morning,
           CASE WHEN hour(ts) BETWEEN 16 AND 18 THEN 1 ELSE 0 END AS rush_evening,
           CASE WHEN hour(ts) BETWEEN 8 AND 10 OR hour(ts) BETWEEN 16 AND 18 THEN 1 ELSE 0 END AS rush
    FROM events""")
def range_flags(t):
    flags = t.events.select("event_id", S.flag(F.hour("ts").between(8, 10)).alias("rush_morning"),
                            S.flag(F.hour("ts").between(16, 18)).alias("rush_evening"))
    return flags.withColumn("rush", S.any_flag("rush_morning", "rush_evening"))


@query("P09 U03", """
    SELECT crisis, count(*) AS n FROM (
        SELECT CASE WHEN year(o_orderdate) IN (1993, 1996, 1999) THEN 1 WHEN year(o_orderdate) IN (1994, 2000) THEN 2
               ELSE 0 END AS crisis FROM orders) GROUP BY crisis""")
def membership_codes(t):
    return t.orders.select(S.code_by_members(F.year("o_orderdate"), {1: [1993, 1996, 1999], 2: [1994, 2000]}).alias("crisis")
                           ).groupBy("crisis").agg(F.count(F.lit(1)).alias("n"))


@query("P10", """
    SELECT p_type, count(*) AS n FROM part WHERE p_type NOT IN ('PROMO', 'SMALL') GROUP BY p_type""")
def negated_membership(t):
    return t.part.filter(~F.col("p_type").isin("PROMO", "SMALL")).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query("P11 C04 C05", r"""
    SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
           coalesce(TRY_CAST(props AS INTEGER), 0) AS bad_text,
           CAST(replace('$' || CAST(regexp_extract(props, '([0-9]+)', 1) AS VARCHAR), '$', '') AS DOUBLE) AS price,
           CASE WHEN length(regexp_extract(props, '([0-9]+)', 1)) >= 2 THEN regexp_extract(props, '([0-9]+)', 1)
                ELSE lpad(regexp_extract(props, '([0-9]+)', 1), 2, '0') END AS padded
    FROM events""")
def lenient_cast_fill(t):
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    return t.events.select("event_id", S.lenient(digits, "int", 0).alias("k"), S.lenient("props", "int", 0).alias("bad_text"),
                           S.money(F.concat(F.lit("$"), digits)).alias("price"), S.pad_left(digits, 2).alias("padded"))


@query("P12", """
    SELECT doc_id, coalesce(lang, 'NULLS') AS lang, coalesce(quality, 0) AS quality, toxic
    FROM (SELECT doc_id, nullif(lang, 'de') AS lang FROM documents) LEFT JOIN labels USING (doc_id)""")
def typed_null_fill(t):
    gaps = t.documents.select("doc_id", F.nullif("lang", F.lit("de")).alias("lang")).join(t.labels, on="doc_id", how="left")
    return gaps.na.fill("NULLS").na.fill(0, subset=["quality"])


@query("P13", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price
    FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0 GROUP BY l_returnflag""")
def sentinel_rows_dropped(t):
    cols = t.lineitem.select("l_returnflag", "l_extendedprice", "l_discount", "l_tax")
    return clean.sentinels_out(cols, ["l_discount", "l_tax"], 0.0).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("P14", """
    SELECT c_custkey, c_name || ' ' || nullif(c_mktsegment, 'BUILDING') AS strict,
           c_name || ' ' || coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS blank FROM customer""")
def combined_text(t):
    gap = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", S.joined_text("c_name", gap).alias("strict"),
                             S.joined_text("c_name", gap, null_policy="blank").alias("blank"))


@query("P15 C07", """
    SELECT c_custkey, round(abs(c_acctbal) + abs(n), 4) AS abs_sum,
           round(CASE WHEN c_acctbal + n <> 0 THEN n / (c_acctbal + n) END, 8) AS ratio,
           round(ln(abs(c_acctbal) + 1), 8) AS log_balance, round(exp(-n / 10.0), 8) AS decay
    FROM (SELECT c_custkey, c_acctbal, coalesce(n, 0) AS n FROM customer LEFT JOIN
          (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey))""")
def row_arithmetic(t):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = t.customer.join(counts, on="c_custkey", how="left").na.fill(0, subset=["n"])
    bal, n = F.col("c_acctbal"), F.col("n")
    return rows.select("c_custkey", F.round(F.abs(bal) + F.abs(n), 4).alias("abs_sum"),
                       F.round(S.ratio(n, bal + n), 8).alias("ratio"),
                       F.round(F.ln(F.abs(bal) + 1), 8).alias("log_balance"), F.round(F.exp(-n / 10.0), 8).alias("decay"))


@query("P16", """
    SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem
    WHERE l_discount + l_tax <> 0 AND l_discount / (l_discount + l_tax) < 0.5""")
def ratio_filter_safe(t):
    share = t.lineitem.select("l_extendedprice", S.ratio("l_discount", F.col("l_discount") + F.col("l_tax")).alias("share"))
    return share.filter("share < 0.5").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("P17", """
    SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS status_F, CAST(o_orderstatus = 'O' AS INTEGER) AS status_O,
           CAST(o_orderstatus = 'P' AS INTEGER) AS status_P FROM orders""")
def dummy_columns(t):
    return t.orders.select("o_orderkey", *[
        c.alias(name) for name, c in S.dummies("o_orderstatus", ["F", "O", "P"], "status").items()])


@query("P18", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_orderkey", "l_suppkey").distinct()


@query("P19", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_by_key(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return clean.first_per_key(t.lineitem.select(*cols), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("P20", """
    SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS rows_removed
    FROM documents""")
def dedup_audit(t):
    return clean.dedup_audit(t.documents.select(F.md5("text").alias("digest")), ["digest"])


@query("P21", """
    WITH f AS (SELECT l_quantity AS quantity, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS net,
                      l_tax AS tax FROM lineitem)
    SELECT a, b, r FROM (
        SELECT 'quantity' AS a, 'price' AS b, round(corr(quantity, price), 6) AS r FROM f
        UNION ALL SELECT 'quantity', 'net', round(corr(quantity, net), 6) FROM f
        UNION ALL SELECT 'quantity', 'tax', round(corr(quantity, tax), 6) FROM f
        UNION ALL SELECT 'price', 'net', round(corr(price, net), 6) FROM f
        UNION ALL SELECT 'price', 'tax', round(corr(price, tax), 6) FROM f
        UNION ALL SELECT 'net', 'tax', round(corr(net, tax), 6) FROM f) WHERE abs(r) > 0.9""")
def correlated_columns(t):
    f = t.lineitem.select(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                          (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), F.col("l_tax").alias("tax"))
    pairs = pearson_pairs(f, ["quantity", "price", "net", "tax"]).withColumn("r", F.round("r", 6))
    return clean.correlated_pairs(pairs, 0.9)


@query("P21", """
    SELECT round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price, round(sum(l_tax), 2) AS tax
    FROM lineitem""")
def pruned_columns_totals(t):
    f = t.lineitem.select(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
                          (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), F.col("l_tax").alias("tax"))
    kept, _ = clean.prune_correlated(f, pearson_pairs(f, f.columns), 0.9)
    return kept.agg(*[F.round(F.sum(c), 2).alias(c) for c in kept.columns])


@query("L01", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def global_sort(t):
    return t.supplier.select("s_suppkey", "s_name", "s_acctbal").orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey")


@query("L02", """
    SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 15""")
def top_users(t):
    return top_groups(t.events, "user_id", 15)


@query("L03", """
    (SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20)
    UNION ALL
    (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice NULLS LAST, o_orderkey LIMIT 20)""")
def first_last_rows(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    top = rows.orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(20)
    bottom = rows.orderBy(F.asc_nulls_last("o_totalprice"), "o_orderkey").limit(20)
    return reshape.union_by_name(io.tag(top, "top", "side"), io.tag(bottom, "bottom", "side"))


@query("L04", """
    SELECT CASE WHEN rn <= 0.75 * n THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
           round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
    GROUP BY 1""")
def positional_split(t):
    from tallyloom.runtime import global_row_number, stage
    ranked = stage(global_row_number(t.orders.select("o_orderdate", "o_orderkey", "o_totalprice"),
                                     ["o_orderdate", "o_orderkey"], "rn"))
    n = ranked.count()
    side = F.when(F.col("rn") <= 0.75 * n, "train").otherwise("test").alias("part")
    return ranked.groupBy(side).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                                    F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("L05", f"""
    SELECT doc_id, lang FROM documents WHERE {duck_hash('doc_id', 's4')} / 4294967296.0 < 0.4""")
def hash_sample(t):
    return sampling.hash_sample(t.documents.select("doc_id", "lang"), "doc_id", 0.4, "s4")


@query("L05")
def bernoulli_sample(t):
    return sampling.bernoulli(t.documents.select("doc_id", "lang"), 0.4, 4)


@query("L06", f"""
    SELECT doc_id, quality FROM labels
    WHERE quality <> 1 OR {duck_hash('doc_id', 'down')} / 4294967296.0 < 0.23""")
def downsample_majority(t):
    return sampling.downsample_class(t.labels.select("doc_id", "quality"), "quality", 1, "doc_id", 0.23, "down")


@query("L07", f"""
    SELECT CASE WHEN {duck_hash('o_orderkey', 'tt')} / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS split,
           count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def hash_split(t):
    return sampling.hash_split(t.orders, "o_orderkey", {"train": 0.7, "test": 0.3}, "tt").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("L08 G03", f"""
    SELECT doc_id, quality, CASE WHEN rn <= ceil(0.7 * n) THEN 'train' ELSE 'test' END AS split FROM (
        SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {duck_hash('doc_id', 'strat')}, doc_id) AS rn,
               count(*) OVER (PARTITION BY quality) AS n FROM labels)""")
def stratified_split(t):
    return sampling.stratified_split(t.labels.select("doc_id", "quality"), "quality", "doc_id", 0.7, "strat")


@query("L09 M40", """
    SELECT quality, max(n) OVER () AS n FROM (SELECT quality, count(*) AS n FROM labels GROUP BY quality)""")
def upsampled_class_sizes(t):
    up = sampling.upsample_to_parity(t.labels.select("doc_id", "quality"), "quality", "doc_id", "up")
    return up.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("G01 S01 A01", """
    SELECT type, count(*) AS n, CAST(sum(size) AS BIGINT) AS total FROM (
        SELECT 'documents' AS type, length(text) AS size FROM documents
        UNION ALL SELECT 'pages', length(html) FROM pages
        UNION ALL SELECT 'conversations', length(text) FROM conversations) GROUP BY type""")
def union_tagged_counts(t):
    parts = {"documents": "text", "pages": "html", "conversations": "text"}
    tagged = [io.tag(getattr(t, name).select(F.length(col).cast("long").alias("size")), name) for name, col in parts.items()]
    return reshape.union_by_position(*tagged).groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))


@query("G02", """
    SELECT 'customer' AS Type, c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""")
def union_by_name(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"),
                                  F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("Type"))
    suppliers = t.supplier.select(F.lit("supplier").alias("Type"), F.col("s_acctbal").alias("balance"),
                                  F.col("s_suppkey").alias("key"))
    return reshape.union_by_name(customers, suppliers)


@query("G03", f"""
    SELECT o_orderkey, o_custkey FROM orders WHERE {duck_hash('o_orderkey', 'g3')} / 4294967296.0 >= 0.6""")
def row_complement(t):
    rows = t.orders.select("o_orderkey", "o_custkey")
    return sampling.complement(rows, sampling.hash_sample(rows, "o_orderkey", 0.6, "g3"), "o_orderkey")


@query("G04 A15", """
    SELECT l_returnflag, variable, round(sum(value), 2) AS total FROM (
        SELECT l_returnflag, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem) GROUP BY ALL""")
def wide_to_long_totals(t):
    long = reshape.melt(t.lineitem, ["l_returnflag"], ["l_quantity", "l_discount", "l_tax"])
    return long.groupBy("l_returnflag", "variable").agg(F.round(F.sum("value"), 2).alias("total"))


@query("C01 C02 C03 U02", r"""
    SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS word_count,
           CAST(len(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '')) AS INTEGER) AS letters_tokens,
           CAST(length(text) AS INTEGER) AS char_count FROM documents""")
def text_counts(t):
    letters = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "")
    return t.documents.select("doc_id", F.size(F.split("text", " ")).alias("word_count"),
                              F.size(letters).alias("letters_tokens"), F.length("text").alias("char_count"))


@query("C06", """
    SELECT event_id, CAST(to_timestamp(floor(epoch(ts))) AS DATE) AS day FROM events""")
def epoch_dates(t):
    seconds = F.unix_seconds(F.to_timestamp_ltz(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))))
    return t.events.select("event_id", S.epoch_date(seconds).alias("day"))


@query("C08 C09", """
    SELECT c_custkey, round(o / (1 + o), 8) AS prob, CASE WHEN o / (1 + o) > 0.5 THEN 1 ELSE 0 END AS class
    FROM (SELECT c_custkey, abs(c_acctbal) / 1000 AS o FROM customer)""")
def odds_and_threshold(t):
    prob = S.odds_probability(F.abs("c_acctbal") / 1000)
    return t.customer.select("c_custkey", F.round(prob, 8).alias("prob"), S.threshold_class(prob).alias("class"))
