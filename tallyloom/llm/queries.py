"""The corpus queries and their SQL oracles, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ann, decontaminate, jaccard, langid, linededup, minhash, mixing, ranked, resample, secrets, substrings, toxicity, urlfilter
from tallyloom.llm.common import table
from tallyloom.runtime import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn):
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return wrap


DECONTAMINATE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
b1 AS (SELECT item_id, w, least(len(w), 13) AS l FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS gram
      FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM b1)),
dw AS (SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS gram
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM g) WHERE len(w) >= l)),
h AS (SELECT doc_id, s, dw.l, item_id FROM dw JOIN g ON dw.gram = g.gram AND dw.l = g.l),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""


@query(DECONTAMINATE_SQL)
def op7_decontaminate(spark, sf_dir):
    """Word hits of benchmark items in every document."""
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query()
def op10_secrets(spark, sf_dir):
    """Secret spans of every document: fixed forms, and random strings found by the character models."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r AS (SELECT doc_id AS a, doc_id AS z FROM d UNION SELECT r.a, b.v FROM r JOIN b ON r.z = b.u),
c AS (SELECT a AS doc_id, min(z) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""


JACCARD_SQL = NEAR_SQL.replace("100 * i >= 80 *", "100 * i >= 85 *").replace(", doc_id = component_id AS kept", "")


@query(NEAR_SQL)
def op3_minhash(spark, sf_dir):
    """Groups of near-duplicate documents on 4-word shingles."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op6_language_id(spark, sf_dir):
    """Language of every document, learned from those outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    kept = langid.held_out(F.col("doc_id"))
    found = langid.predict(docs, *langid.train(docs.filter(~kept)))
    return found.select("doc_id", kept.alias("held_out"), "lang_pred", "score", "languages")


@query()
def op9_toxicity(spark, sf_dir):
    """Expected severity, likeliest grade and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    found = toxicity.score(docs, model)
    return found.select("doc_id", F.round("_severity", 6).alias("severity"), F.col("_grade").alias("grade"), F.col("_rejected").alias("rejected"))


@query()
def op5_line_dedup(spark, sf_dir):
    """Lines of every document that repeat an earlier line within two edits, by number."""
    found = linededup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"),
                        F.concat_ws(",", F.transform("removed", lambda x: x.cast("string"))).alias("removed_lines"))


def _level_sql(above: str, name: str, parent: list[str], level: str, weight: str) -> str:
    """One level of the budget: shares of the children of every node, those used up whole first."""
    path = ", ".join([*parent, level])
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    join = f"JOIN {above} USING ({', '.join(parent)})" if parent else f"CROSS JOIN {above}"
    order = f"OVER ({by} ORDER BY cap / w, {level}"
    return f"""
{name}_c AS (SELECT {path}, CAST(sum(tokens) * 2 AS BIGINT) AS cap, {weight} AS w FROM leaves GROUP BY {path}),
{name}_o AS (SELECT {path}, cap, w, b - coalesce(sum(cap) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, row_number() {order}) AS place
    FROM (SELECT {path}, cap, w, quota AS b FROM {name}_c {join})),
{name}_k AS (SELECT {path}, cap, w, place, min(CASE WHEN CAST(cap AS HUGEINT) * rest > CAST(lft AS HUGEINT) * w THEN struct_pack(place := place, lft := lft, rest := rest) END)
    OVER ({by}) AS cut FROM {name}_o),
{name} AS (SELECT {path}, CASE WHEN cut IS NULL OR place < cut.place THEN cap ELSE CAST(CAST(cut.lft AS HUGEINT) * w // cut.rest AS BIGINT) END AS quota
    FROM {name}_k),"""


MIXING_SQL = r"""
WITH num AS (SELECT doc_id, text, lang, source, coalesce(try_cast(regexp_extract(coalesce(source, ''), '[0-9]+', 0) AS INTEGER), 99) AS k FROM documents),
rows AS (SELECT * FROM (SELECT doc_id, CASE WHEN k < 5 THEN 'web' WHEN k < 10 THEN 'forum' WHEN k < 15 THEN 'reference' ELSE 'other' END AS domain,
    coalesce(lang, '(none)') AS language, coalesce(source, '(none)') AS origin,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM num) WHERE n_tokens > 0),
leaves AS (SELECT domain, language, origin, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL),
root AS (SELECT CAST(coalesce(sum(tokens), 0) AS BIGINT) * 4 // 5 AS quota FROM leaves),""" + _level_sql(
    "root", "l1", [], "domain", "CASE domain WHEN 'web' THEN 4 WHEN 'forum' THEN 2 WHEN 'reference' THEN 3 ELSE 1 END") + _level_sql(
    "l1", "l2", ["domain"], "language", "CASE language WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END") + _level_sql(
    "l2", "l3", ["domain", "language"], "origin", "1") + r"""
plan AS (SELECT domain, language, origin, quota // tokens AS full_epochs, quota % tokens AS part FROM l3 JOIN leaves USING (domain, language, origin) WHERE quota > 0),
placed AS (SELECT * FROM rows JOIN plan USING (domain, language, origin)),
ordered AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin
    ORDER BY md5('1|' || CAST(full_epochs + 1 AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR)), doc_id) - n_tokens AS before FROM placed WHERE part > 0)
SELECT doc_id, domain, language, origin, n_tokens, CAST(full_epochs + 1 AS INTEGER) AS epoch, CAST(least(n_tokens, part - before) AS BIGINT) AS take_tokens
FROM ordered WHERE before < part
UNION ALL
SELECT doc_id, domain, language, origin, n_tokens, CAST(e AS INTEGER) AS epoch, n_tokens AS take_tokens
FROM (SELECT *, unnest(range(1, full_epochs + 1)) AS e FROM placed WHERE full_epochs > 0)"""


@query(MIXING_SQL)
def op8_mixing(spark, sf_dir):
    """The mix of four fifths of the tokens by domain, language and source."""
    return mixing.select(table(spark, sf_dir, "documents"), mixing.production_levels(), mixing.PRODUCTION_WEIGHTS,
                         mixing.production_budget(), mixing.PRODUCTION_EPOCHS)


URL_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
known(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (SELECT page_id, arg_max(k.host || k.path, length(k.host || k.path)) AS rule, arg_max(verdict, length(k.host || k.path)) AS verdict
    FROM s JOIN known k ON (s.host = k.host OR ends_with(s.host, '.' || k.host)) AND starts_with(s.path, k.path) GROUP BY page_id),
l AS (SELECT DISTINCT regexp_extract(host, '(?:^|\.)((?:[^.]*-)?(?:ads|adult|bets|casino|pills|poker|porn|spam|warez|xxx)(?:-[^.]*)?(?:\..*)?)$', 1) AS entry FROM s),
h AS (SELECT DISTINCT s.host FROM s JOIN l ON entry <> '' AND (s.host = entry OR ends_with(s.host, '.' || entry)))
SELECT page_id, s.host, s.path, rule, coalesce(verdict, CASE WHEN h.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM s LEFT JOIN r USING (page_id) LEFT JOIN h ON s.host = h.host"""


@query(URL_SQL)
def op2_url_filter(spark, sf_dir):
    """Verdict on every page: the rules, and a listing of the suspect hosts among the pages."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.suspect_hosts(pages))


@query()
def op1_ann(spark, sf_dir):
    """The 10 nearest vectors of every hundredth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


REPEATS_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS p FROM d)),
m AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM g JOIN m USING (s) WHERE doc_id > first_doc),
r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < q - 1) AS n_spans
      FROM (SELECT doc_id, q, lag(q) OVER (PARTITION BY doc_id ORDER BY q) AS before FROM c) GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(x, '' ORDER BY q) AS kept FROM (
      SELECT doc_id, q, substr(h, 2 * q - 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) AS q FROM d WHERE doc_id IN (SELECT doc_id FROM r)))
      ANTI JOIN c USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN r.doc_id IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""


@query(REPEATS_SQL)
def op4_suffix_array(spark, sf_dir):
    """Bytes of every document that repeat a 50-byte string of an earlier one."""
    return substrings.cut_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


RANKED_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n_all, sum(len(w))::BIGINT AS l_all FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
f AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL),
g AS (SELECT t, floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY t, n_all),
r AS (SELECT item_id, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 20 * (50 + 50 * n * n_all // l_all))))::BIGINT AS score
      FROM f JOIN q USING (t) JOIN g USING (t), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM r WHERE score > 0) WHERE rank <= 50"""


@query(RANKED_SQL)
def op11_ranked_search(spark, sf_dir):
    """The 50 highest-scoring documents of every benchmark item."""
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The CRC-32 of a word in SQL: a table of 256 remainders by rule, then one step per byte.
RESAMPLE_SQL = r"""
WITH tab AS (SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps
             FROM range(256) t(i)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark),
v AS (SELECT doc_id, unnest(w) AS f FROM d),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM (SELECT f FROM v UNION ALL SELECT f FROM u))),
b AS (SELECT f, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(x), 2), lambda p: CAST('0x' || substr(x, p, 2) AS BIGINT))),
        lambda c, y: xor(c >> 8, steps[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS b FROM h, tab),
s AS (SELECT b, count(*) AS s FROM v JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM u JOIN b USING (f) GROUP BY b),
a AS (SELECT (SELECT count(*) FROM v) AS s_all, (SELECT count(*) FROM u) AS t_all),
g AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000)) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b), a),
w AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM v JOIN b USING (f) JOIN g USING (b) GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS drawn FROM c WHERE n_features >= 20)
SELECT c.doc_id, n_features, weight, CAST(score AS BIGINT) AS score, CASE WHEN place <= drawn THEN place END AS rank FROM c LEFT JOIN r USING (doc_id)"""


@query(RESAMPLE_SQL)
def op12_resample(spark, sf_dir):
    """A tenth of the documents, drawn towards the words of the benchmark."""
    found = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query(JACCARD_SQL)
def op13_jaccard_join(spark, sf_dir):
    """Groups of documents that share 85 per cent of their 4-word shingles."""
    found = jaccard.jaccard_groups(table(spark, sf_dir, "documents"), width=4, similarity=85)
    return found.select("doc_id", "n_shingles", "component_id")
