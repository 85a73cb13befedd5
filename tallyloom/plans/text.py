"""Queries over documents, conversations and their tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions import wordlists as W
from tallyloom.operators import text as O
from tallyloom.plans.common import rounded
from tallyloom.plans.registry import query
from tallyloom.runtime import spread, stage


def docs(t):
    """Documents over all cores, however few files they come in."""
    return spread(t.documents, "doc_id")


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


# Oracle side of the token expressions, written with lists instead of whole-text replacements.
TOKENS = r"""list_filter(flatten(list_transform(string_split_regex(text, '[\s-]+'), lambda x: [
    regexp_extract(x, '^[()?!]+'),
    regexp_replace(regexp_replace(x, '^[()?!]+', ''), '[()?!]+$', ''),
    regexp_extract(regexp_replace(x, '^[()?!]+', ''), '[()?!]+$')])), lambda x: x <> '')"""
KEPT = f"list_filter({TOKENS}, lambda x: lower(x) NOT IN {_in(W.STOP_WORDS)})"
CLEAN = f"list_filter(list_transform({KEPT}, lambda x: lower(regexp_replace(x, '[^A-Za-z]', '', 'g'))), lambda x: x <> '')"
CAPS = f"list_filter(list_transform({KEPT}, lambda x: regexp_replace(x, '[^A-Za-z]', '', 'g')), lambda x: x <> '')"


def _stem_sql(x: str) -> str:
    for pattern, replacement in W.SUFFIX_RULES:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}')"
    return x


STEMS = f"list_transform({CLEAN}, lambda x: {_stem_sql('x')})"
GRAMS = f"""list_concat(s, list_transform(list_zip(s[:-2], s[2:]), lambda p: p[1] || '_' || p[2]))"""
WORDS = r"list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z\s]', '', 'g'), '\s+'), lambda x: x <> '')"


def _tokens(expr, spark_expr):
    """(doc_id, number of tokens, digest of the joined tokens) on both sides."""
    sql = f"SELECT doc_id, CAST(len(x) AS INTEGER) AS n, md5(array_to_string(x, ' ')) AS digest FROM (SELECT doc_id, {expr} AS x FROM documents)"

    def run(t):
        return docs(t).select("doc_id", spark_expr("text").alias("x")).select(
            "doc_id", F.size("x").alias("n"), F.md5(F.array_join("x", " ")).alias("digest"))
    return sql, run


_SQL, _RUN = _tokens(TOKENS, X.tokens)


@query("T01 T07", _SQL)
def tokens_split(t):
    return _RUN(t)


@query("T02", f"SELECT doc_id, CAST(len(x) AS INTEGER) AS n, md5(array_to_string(x, ' ')) AS digest FROM (SELECT doc_id, {KEPT} AS x FROM documents)")
def tokens_without_stop_words(t):
    kept = docs(t).select("doc_id", X.without_words(X.tokens("text")).alias("x"))
    return kept.select("doc_id", F.size("x").alias("n"), F.md5(F.array_join("x", " ")).alias("digest"))


@query("T03", f"SELECT doc_id, array_to_string(x, ' ') AS clean, array_to_string(y, ' ') AS caps FROM (SELECT doc_id, {CLEAN} AS x, {CAPS} AS y FROM documents)")
def tokens_clean(t):
    kept = docs(t).select("doc_id", X.without_words(X.tokens("text")).alias("kept"))
    return kept.select("doc_id", F.array_join(X.letters_only("kept"), " ").alias("clean"),
                       F.array_join(X.letters_only("kept", lower=False), " ").alias("caps"))


@query("T04 U01", f"SELECT doc_id, array_to_string({STEMS}, ' ') AS stems FROM documents")
def tokens_stemmed(t):
    return docs(t).select("doc_id", F.array_join(X.stems(X.clean_tokens("text")), " ").alias("stems"))


@query("T04", f"""
    SELECT count(DISTINCT w) AS terms, count(DISTINCT {_stem_sql('w')}) AS bases
    FROM (SELECT DISTINCT unnest({CLEAN}) AS w FROM documents)""")
def vocabulary_reduction(t):
    vocabulary = O.term_counts(docs(t).select(X.clean_tokens("text").alias("tk")), "tk")
    return O.vocabulary_reduction(vocabulary)


@query("T04", f"""
    WITH v AS (SELECT doc_id, unnest({CLEAN}) AS w FROM documents),
         m AS (SELECT DISTINCT w, {_stem_sql('w')} AS base FROM v WHERE length(w) > 6)
    SELECT coalesce(base, w) AS term, count(*) AS n FROM v LEFT JOIN m USING (w) GROUP BY 1""")
def dictionary_conflation(t):
    """Base forms through a dictionary table derived from the long words of the vocabulary."""
    clean = docs(t).select("doc_id", X.clean_tokens("text").alias("tk"))
    vocabulary = stage(O.term_counts(clean, "tk"))
    mapping = vocabulary.filter(F.length("term") > 6).select(F.col("term").alias("token"), X.stem(F.col("term")).alias("base"))
    # One row per distinct term carrying its count: the dictionary meets the vocabulary, not every token.
    based = O.conflate_by_map(vocabulary, mapping)
    return based.groupBy("term").agg(F.sum("n").alias("n"))


@query("T05 G05 T09", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest({GRAMS}) AS term FROM (SELECT {CLEAN} AS s FROM documents)) GROUP BY term""")
def ngram_counts(t):
    return O.term_counts(X.with_ngrams(docs(t), "text", "g"), "g")


_ENTRIES = rf"""list_filter(list_transform({TOKENS}, lambda x, i: {{'i': i - 1, 'w': lower(regexp_replace(x, '[^A-Za-z]', '', 'g'))}}),
    lambda e: e.w <> '' AND e.w NOT IN {_in(W.STOP_WORDS)})"""
_TAG = (f"CASE WHEN e.w IN {_in(W.ADJECTIVES)} THEN 'J' WHEN e.w IN {_in(W.NOUNS)} THEN 'N' "
        f"WHEN regexp_matches(e.w, '({'|'.join(W.ADJECTIVE_ENDINGS)})$') THEN 'J' WHEN regexp_matches(e.w, '({'|'.join(W.NOUN_ENDINGS)})$') THEN 'N' ELSE 'O' END")


def _phrase_sql(source: str, key: str) -> str:
    return rf"""
    WITH tk AS (SELECT {key}, {TOKENS} AS raw, array_to_string(list_transform({_ENTRIES}, lambda e:
                {_TAG} || ':' || e.i || ':' || e.w), ' ') AS tagged FROM {source}),
    m AS (SELECT {key}, raw, 'JN' AS grammar, unnest(regexp_extract_all(tagged, '{X.GRAMMARS["JN"]}')) AS hit FROM tk
          UNION ALL SELECT {key}, raw, 'NN', unnest(regexp_extract_all(tagged, '{X.GRAMMARS["NN"]}')) FROM tk),
    p AS (SELECT {key}, grammar, regexp_replace(hit, '[JN]:\d+:', '', 'g') AS phrase,
          array_to_string(raw[CAST(regexp_extract(hit, '^[JN]:(\d+):', 1) AS INTEGER) + 1 :
                              CAST(regexp_extract(hit, '[JN]:(\d+):\S+$', 1) AS INTEGER) + 1], ' ') AS span FROM m)"""


@query("T06", _phrase_sql("documents", "doc_id") + " SELECT doc_id, grammar, phrase, span FROM p")
def phrase_chunks(t):
    return O.phrase_rows(docs(t), ["doc_id"], "text")


# A lexicon counted from the documents: words that up to a fifth of them hold are nouns, the rarer ones of these adjectives.
_LEARNED = f"""
    c AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({CLEAN}) AS word FROM documents) GROUP BY word),
    lex AS (SELECT word, CASE WHEN df * 100 < 3 * n THEN 'J' ELSE 'N' END AS tag FROM c, (SELECT count(*) AS n FROM documents) WHERE df * 100 >= n AND df * 5 < n)"""


def learned_lexicon(t):
    held = O.unfold(docs(t), ["doc_id"], F.array_distinct(X.clean_tokens("text")), "word").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = t.documents.count()
    rare = F.when(F.col("df") * 100 < 3 * n, "J").otherwise("N")
    return held.filter((F.col("df") * 100 >= n) & (F.col("df") * 5 < n)).select("word", rare.alias("tag"))


@query("T06 T04", rf"""
    WITH {_LEARNED}, e AS (SELECT doc_id, unnest({_ENTRIES}) AS e FROM documents),
    g AS (SELECT doc_id, string_agg(coalesce(tag, 'O') || ':' || e.i || ':' || e.w, ' ' ORDER BY e.i) AS tagged FROM e LEFT JOIN lex ON e.w = word GROUP BY doc_id),
    tk AS (SELECT doc_id, {TOKENS} AS raw, tagged FROM documents JOIN g USING (doc_id)),""" + _phrase_sql("documents", "doc_id").split("FROM documents),", 1)[1] + """
    SELECT doc_id, grammar, phrase, span FROM p""")
def phrase_chunks_learned(t):
    """Phrases tagged by a table of words that is counted from the documents."""
    return O.phrase_rows_by_lexicon(docs(t), "doc_id", "text", learned_lexicon(t))


@query("T09", _phrase_sql("documents", "doc_id") + " SELECT phrase, count(*) AS n FROM p GROUP BY phrase")
def phrase_frequencies(t):
    return O.phrase_rows(docs(t), ["doc_id"], "text").groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))


@query("T08", _phrase_sql("conversations", "turn") + """
    SELECT phrase, turn, count(*) AS n FROM p WHERE phrase IN
        (SELECT phrase FROM p GROUP BY phrase ORDER BY count(*) DESC, phrase LIMIT 20) GROUP BY ALL""")
def phrase_mentions(t):
    """The twenty most frequent phrases of the conversations, by turn."""
    from tallyloom.operators.profile import top_groups
    rows = O.phrase_rows(spread(t.conversations, "conv_id", "turn"), ["turn"], "text").groupBy("phrase", "turn").agg(F.count(F.lit(1)).alias("n"))
    rows = stage(rows)
    top = rows.groupBy("phrase").agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), "phrase").limit(20)
    return rows.join(F.broadcast(top.select("phrase")), on="phrase", how="left_semi")


@query("A03", f"""
    SELECT lang, count(DISTINCT x) AS token_lists, count(DISTINCT w) AS words FROM (
        SELECT lang, array_to_string(x, ' ') AS x, unnest(x) AS w FROM (SELECT lang, {CAPS} AS x FROM documents))
    GROUP BY lang""")
def distinct_token_lists(t):
    """Distinct token lists and distinct words per language (texts without words count in neither)."""
    caps = docs(t).filter("lang IS NOT NULL").select("lang", X.clean_tokens("text", lower=False).alias("x"))
    # Tokens are made once, so nothing is filtered by them: a text gives its words and the digest of its list (null without words), which no word of letters equals.
    digest = F.when(F.size("x") > 0, F.concat(F.lit("#"), F.md5(F.array_join("x", " "))))
    items = O.unfold(caps, ["lang"], F.concat(F.array_distinct("x"), F.array(digest)), "item").groupBy("lang", "item").agg(F.first(F.lit(1)).alias("_one"))
    is_list = F.col("item").startswith("#")
    return items.groupBy("lang").agg(F.count_if(is_list).alias("token_lists"), F.count_if(~is_list).alias("words"))


_BASE = rf"""
    SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars_all,
           CAST(length(regexp_replace(lower(text), '[^a-z]', '', 'g')) AS INTEGER) AS n_letters, CAST(len(w) AS INTEGER) AS n_words,
           CAST(greatest(len(regexp_extract_all(text, '{X.SENTENCE_END}')), 1) AS INTEGER) AS n_sentences,
           CAST(coalesce(list_sum(list_transform(w, lambda x: greatest(len(regexp_extract_all(x, '{X.VOWELS}')), 1))), 0) AS INTEGER)
               AS n_syllables,
           CAST(len(list_filter(w, lambda x: len(regexp_extract_all(x, '{X.VOWELS}')) >= 3)) AS INTEGER) AS n_poly,
           CAST(len(list_distinct(list_filter(w, lambda x: len(regexp_extract_all(x, '{X.VOWELS}')) >= 2
               AND x NOT IN {_in(W.EASY_WORDS)}))) AS INTEGER) AS n_difficult, text
    FROM (SELECT doc_id, text, {WORDS} AS w FROM documents)"""
COUNTS = ["n_chars_all", "n_letters", "n_words", "n_sentences", "n_syllables", "n_poly", "n_difficult"]


@query("T11 U02", f"SELECT doc_id, {', '.join(COUNTS)} FROM ({_BASE})")
def text_complexity(t):
    return X.complexity(docs(t).select("doc_id", "text"), "text").select("doc_id", *COUNTS)


SCORES = ["flesch_ease", "kincaid_grade", "fog", "smog", "coleman_liau", "ari", "dale_chall", "linsear", "linsear_whole"]


@query("T12 T13 T14 T15", rf"""
    WITH b AS (SELECT *, n_words / n_sentences AS ws, 100.0 * n_difficult / n_words AS hard,
                      list_transform(string_split_regex(trim(text), '\s+')[:100],
                          lambda x: greatest(len(regexp_extract_all(lower(x), '{X.VOWELS}')), 1)) AS hs,
                      greatest(len(list_filter(string_split_regex(trim(text), '\s+')[:100], lambda x: regexp_matches(x, '[.!?]+$'))), 1) AS hn
               FROM ({_BASE})),
    l AS (SELECT *, list_sum(list_transform(hs, lambda s: CASE WHEN s >= 3 THEN 3 ELSE 1 END))::DOUBLE / hn AS lx,
                 (n_words + 2 * n_poly) / n_sentences AS lw FROM b)
    SELECT doc_id, round(206.835 - 1.015 * ws - 84.6 * (n_syllables / n_words), 9) AS flesch_ease,
           round(0.39 * ws + 11.8 * (n_syllables / n_words) - 15.59, 9) AS kincaid_grade,
           round(0.4 * (ws + 100 * (n_poly / n_words)), 9) AS fog,
           round(CASE WHEN n_words > 0 THEN CASE WHEN n_sentences >= 3 THEN 1.043 * sqrt(30.0 * n_poly / n_sentences) + 3.1291 ELSE 0.0 END END, 9) AS smog,
           round(5.8 * (n_letters / n_words) - 29.6 * (n_sentences / n_words) - 15.8, 9) AS coleman_liau,
           round(4.71 * (n_letters / n_words) + 0.5 * ws - 21.43, 9) AS ari,
           round(0.1579 * hard + 0.0496 * ws + CASE WHEN hard > 5 THEN 3.6365 ELSE 0.0 END, 9) AS dale_chall,
           round(CASE WHEN n_words > 0 THEN CASE WHEN lx > 20 THEN lx / 2 ELSE (lx - 2) / 2 END END, 9) AS linsear,
           round(CASE WHEN n_words > 0 THEN CASE WHEN lw > 20 THEN lw / 2 ELSE (lw - 2) / 2 END END, 9) AS linsear_whole
    FROM l""")
def readability(t):
    return rounded(X.readability(docs(t).select("doc_id", "text"), "text").select("doc_id", *SCORES), 9, *SCORES)


@query("T15 T11", rf"""
    WITH w AS (SELECT doc_id, {WORDS} AS w, greatest(len(regexp_extract_all(text, '{X.SENTENCE_END}')), 1) AS n_sentences FROM documents),
    v AS (SELECT doc_id, unnest(list_distinct(w)) AS word FROM w),
    easy AS (SELECT word FROM v GROUP BY word HAVING count(*) * 50 >= (SELECT count(*) FROM documents)),
    h AS (SELECT doc_id, count(*) AS k FROM v WHERE len(regexp_extract_all(word, '{X.VOWELS}')) >= 2 AND word NOT IN (SELECT word FROM easy) GROUP BY doc_id),
    b AS (SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, n_sentences, CAST(coalesce(k, 0) AS INTEGER) AS n_difficult FROM w LEFT JOIN h USING (doc_id))
    SELECT doc_id, n_words, n_difficult, round(CASE WHEN n_words > 0 THEN 0.1579 * (100.0 * n_difficult / n_words) + 0.0496 * (n_words / n_sentences)
        + CASE WHEN 100.0 * n_difficult / n_words > 5 THEN 3.6365 ELSE 0.0 END END, 9) AS dale_chall FROM b""")
def dale_chall_learned(t):
    """Easy words are those that a fiftieth of the documents hold."""
    rows = docs(t).select("doc_id", "text")
    held = O.unfold(rows, ["doc_id"], F.array_distinct(X.words("text")), "word").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return rounded(O.dale_chall(rows, "doc_id", "text", held.filter(F.col("df") * 50 >= t.documents.count()).select("word")), 9, "dale_chall")


def _sentiment_sql(lexicon: str, digits: int = 10) -> str:
    return rf"""
    WITH lex AS ({lexicon}),
    pr AS (SELECT doc_id, unnest(list_zip(list_concat([''], w[:-2]), w)) AS p FROM (SELECT doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0),
    sc AS (SELECT doc_id, greatest(-1.0, least(1.0, polarity * CASE WHEN p[1] IN {_in(W.NEGATIONS)} THEN {W.NEGATION_FACTOR}
                  WHEN p[1] IN {_in(W.INTENSIFIERS)} THEN {W.INTENSIFIER_FACTOR} ELSE 1.0 END)) AS v, subjectivity
           FROM pr JOIN lex ON p[2] = word)
    SELECT doc_id, round(coalesce(avg(v), 0.0), {digits}) AS polarity, round(coalesce(avg(subjectivity), 0.0), {digits}) AS subjectivity,
           count(v) AS hits FROM documents LEFT JOIN sc USING (doc_id) GROUP BY doc_id"""


@query("T10", _sentiment_sql("SELECT * FROM (VALUES " + ", ".join(
    f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, p, s in W.SENTIMENT) + ") v(word, polarity, subjectivity)"))
def sentiment_by_document(t):
    return rounded(O.sentiment(docs(t).select("doc_id", "text"), "doc_id", "text", O.sentiment_lexicon(t.spark)),
                   10, "polarity", "subjectivity")


@query("T10", _sentiment_sql(f"""
    SELECT word, round(2 * avg(quality) - 1, 8) AS polarity, round(avg(toxic), 8) AS subjectivity FROM (
        SELECT DISTINCT doc_id, unnest({WORDS}) AS word FROM documents) JOIN labels USING (doc_id)
    GROUP BY word HAVING count(*) >= 30""", 5))
def sentiment_learned_lexicon(t):
    """Scores with a lexicon learned from the labelled documents."""
    labelled = docs(t).select("doc_id", "text").join(t.labels, on="doc_id")
    words = O.unfold(labelled, ["quality", "toxic"], F.array_distinct(X.words("text")), "word")
    lexicon = words.groupBy("word").agg(F.round(2 * F.avg("quality") - 1, 8).alias("polarity"),
                                        F.round(F.avg("toxic"), 8).alias("subjectivity"), F.count(F.lit(1)).alias("_n"))
    lexicon = stage(lexicon.filter("_n >= 30").drop("_n"))
    return rounded(O.sentiment(docs(t).select("doc_id", "text"), "doc_id", "text", lexicon), 5, "polarity", "subjectivity")


@query("F02", f"""
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({CLEAN}) AS term FROM documents) GROUP BY ALL""")
def term_frequencies(t):
    return O.term_frequencies(docs(t).select("doc_id", X.clean_tokens("text").alias("tk")), "doc_id", "tk")


@query("F03", f"""
    WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({CLEAN}) AS term FROM documents) GROUP BY ALL),
    idf AS (SELECT term, CASE WHEN count(*) < 10 THEN 0.0 ELSE ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) END AS idf
            FROM tf GROUP BY term)
    SELECT doc_id, term, tf, round(tf * idf, 6) AS weight FROM tf JOIN idf USING (term)""")
def tfidf_tidy(t):
    clean = docs(t).select("doc_id", X.clean_tokens("text").alias("tk"))
    return rounded(O.tfidf(clean, "doc_id", "tk", 10), 6, "weight")


@query("F04", f"""
    WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (
                    SELECT doc_id, unnest({GRAMS}) AS term FROM (SELECT doc_id, {CLEAN} AS s FROM documents)) GROUP BY ALL),
    v AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) + 1 AS idf FROM tf GROUP BY term
          HAVING count(*) >= 15 ORDER BY sum(tf) DESC, term LIMIT 1000),
    w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN v USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf_l2_top_terms(t):
    # The tokens are the dear part of the n-grams, which are read more than once.
    clean = stage(docs(t).select("doc_id", X.clean_tokens("text").alias("tk")))
    return rounded(O.tfidf_top_terms(clean.select("doc_id", X.ngrams("tk").alias("g")), "doc_id", "g"), 6, "weight")
