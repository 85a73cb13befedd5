"""Text operators over document tables: vocabularies, phrases, sentiment, tf-idf."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions import wordlists as W
from tallyloom.runtime import BROADCAST_ROWS, hot_split_join, stage


def pipeline(df: DataFrame, text: str, words: list[str] = W.STOP_WORDS) -> DataFrame:
    """All token outputs next to the source columns: tokens, clean, clean_caps, stems, ngrams, phrases."""
    staged = df.withColumn("tokens", X.tokens(text))
    staged = staged.withColumn("kept", X.without_words("tokens", words))
    staged = staged.withColumns({"clean": X.letters_only("kept"), "clean_caps": X.letters_only("kept", lower=False)})
    staged = staged.withColumn("stems", X.stems("clean"))
    return X.with_phrases(staged.withColumn("ngrams", X.ngrams("stems")), "tokens", "phrases", words).drop("kept")


def finish(df: DataFrame, outputs: list[str], keep: list[str]) -> DataFrame:
    """Choose token outputs and carry named columns along."""
    return df.select(*keep, *[F.col(c).alias(f"finished_{c}") for c in outputs])


def unfold(df: DataFrame, keep: list[str], array, name: str) -> DataFrame:
    """One row per array element.

    The outer form with a later filter: the plain form makes Spark test the array for emptiness below the projection
    that builds it, which computes costly token expressions a second time.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def token_rows(df: DataFrame, keep: list[str], tokens: str, name: str = "term") -> DataFrame:
    return unfold(df, keep, tokens, name)


def term_counts(df: DataFrame, tokens: str, name: str = "term") -> DataFrame:
    return token_rows(df, [], tokens, name).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def vocabulary_reduction(vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """Vocabulary size before and after suffix rules, from a table of terms and counts."""
    based = vocabulary.withColumn("_base", X.stem(F.col(term)))
    return based.agg(F.count_distinct(term).alias("terms"), F.count_distinct("_base").alias("bases"))


def conflate_by_map(rows: DataFrame, mapping: DataFrame, term: str = "term") -> DataFrame:
    """Replace terms by the base form of a dictionary (token, base); terms not in it stay."""
    known = mapping.select(F.col("token").alias(term), "base")
    small = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(known) if small else known, on=term, how="left")
    return joined.withColumn(term, F.coalesce("base", term)).drop("base").select(*rows.columns)


def phrase_rows(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    found = unfold(X.with_phrases(df.select(*keep, X.tokens(text).alias("_raw")), "_raw", "_p"), keep, "_p", "p")
    return found.select(*keep, "p.grammar", "p.phrase", "p.span")


def looked_up(rows: DataFrame, word: str, table: DataFrame) -> DataFrame:
    """Left join of word rows to a table with one row per word: broadcast if a count shows that it is small, else with frequent words split off."""
    table = stage(table)
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), on=word, how="left")
    rows = stage(rows)
    counted = rows.groupBy(word).agg(F.count(F.lit(1)).alias("_n")).join(table, on=word, how="left")
    return hot_split_join(rows, stage(counted), [word], "_n").drop("_n")


def phrase_rows_by_lexicon(df: DataFrame, row_id: str, text: str, lexicon: DataFrame, words: list[str] = W.STOP_WORDS) -> DataFrame:
    """(row_id, grammar, phrase, span) as `phrase_rows` gives them, with tags from a table (word, tag): J, N or other; words not listed are other.

    Tokens meet the lexicon as rows and come back as one tagged string per text.
    """
    base = stage(df.select(row_id, X.tokens(text).alias("_raw")))
    flat = base.select(row_id, F.posexplode("_raw").alias("_i", "_t")).select(row_id, "_i", F.lower(F.regexp_replace("_t", "[^A-Za-z]", "")).alias("word"))
    flat = flat.filter((F.col("word") != "") & ~F.col("word").isin(*words))
    known = looked_up(flat, "word", lexicon.select("word", F.when(F.col("tag").isin("J", "N"), F.col("tag")).alias("tag")))
    entries = F.array_sort(F.collect_list(F.struct("_i", "word", F.coalesce("tag", F.lit("O")).alias("tag"))))
    per = known.groupBy(row_id).agg(F.array_join(F.transform(entries, lambda e: X.tagged_token(e["tag"], e["_i"], e["word"])), " ").alias("_tagged"))
    found = base.join(per, row_id).withColumn("_p", X.phrases_in("_tagged", F.col("_raw")))
    return unfold(found, [row_id], "_p", "p").select(row_id, "p.grammar", "p.phrase", "p.span")


def dale_chall(df: DataFrame, row_id: str, text: str, easy: DataFrame) -> DataFrame:
    """(row_id, n_words, n_difficult, dale_chall) with the easy words from a table (word): difficult are other words of two syllables or more, each once."""
    base = X.complexity(df.select(row_id, text), text).select(row_id, "n_words", "n_sentences")
    hard = unfold(df, [row_id], F.array_distinct(F.filter(X.words(text), lambda w: X.syllables(w) >= 2)), "word")
    marked = looked_up(hard, "word", easy.select("word", F.lit(1).alias("easy")).distinct()).filter("easy IS NULL")
    per = marked.groupBy(row_id).agg(F.count(F.lit(1)).cast("int").alias("n_difficult"))
    out = base.join(per, row_id, "left").withColumn("n_difficult", F.coalesce("n_difficult", F.lit(0)))
    share = 100.0 * F.try_divide(F.col("n_difficult").cast("double"), F.col("n_words"))
    score = 0.1579 * share + 0.0496 * (F.col("n_words") / F.col("n_sentences")) + F.when(share > 5, 3.6365).otherwise(0.0)
    return out.select(row_id, "n_words", "n_difficult", score.alias("dale_chall"))


def phrase_mentions(rows: DataFrame, phrase_list: list[str], period: str) -> DataFrame:
    """Mentions of given phrases per period."""
    return rows.filter(F.col("phrase").isin(*phrase_list)).groupBy("phrase", period).agg(F.count(F.lit(1)).alias("n"))


def sentiment_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(W.SENTIMENT, "word string, polarity double, subjectivity double")


def sentiment(df: DataFrame, row_id: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(row_id, polarity, subjectivity, hits): means over lexicon words, 0 for texts without any.

    The word before turns or strengthens the score. Scored words are averaged where the row lies, so the shuffle
    carries one partial row per text. A lexicon too large to broadcast is joined with its frequent words split off.
    """
    words = df.select(row_id, X.words(text).alias("_w"))
    before = F.concat(F.array(F.lit("")), F.slice("_w", 1, F.greatest(F.size("_w") - 1, F.lit(0))))
    pairs = unfold(words, [row_id], F.arrays_zip(before.alias("prev"), F.col("_w").alias("word")), "p").select(
        row_id, "p.prev", "p.word").filter(F.col("word").isNotNull())
    if lexicon.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        scored = pairs.join(F.broadcast(lexicon), on="word")
    else:
        weights = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
        scored = hot_split_join(pairs, stage(lexicon.join(weights, on="word")), ["word"], "_n")
    factor = (F.when(F.col("prev").isin(*W.NEGATIONS), F.lit(W.NEGATION_FACTOR))
              .when(F.col("prev").isin(*W.INTENSIFIERS), F.lit(W.INTENSIFIER_FACTOR)).otherwise(F.lit(1.0)))
    value = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("polarity") * factor))
    per = scored.groupBy(row_id).agg(F.avg(value).alias("polarity"), F.avg("subjectivity").alias("subjectivity"),
                                     F.count(F.lit(1)).alias("hits"))
    return df.select(row_id).join(per, on=row_id, how="left").na.fill(0.0, ["polarity", "subjectivity"]).na.fill(0, ["hits"])


# --- term weights ------------------------------------------------------------------------------------------------

def term_frequencies(df: DataFrame, row_id: str, tokens: str) -> DataFrame:
    """(row_id, term, tf); counted where the row lies before the shuffle."""
    return token_rows(df, [row_id], tokens).groupBy(row_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("corpus_tf"))


def tfidf(df: DataFrame, row_id: str, tokens: str, min_df: int = 10) -> DataFrame:
    """(row_id, term, tf, weight) with idf ln((m+1)/(df+1)), 0 for terms in fewer than `min_df` documents."""
    tf = stage(term_frequencies(df, row_id, tokens))
    m = df.count()
    idf = F.when(F.col("df") < min_df, F.lit(0.0)).otherwise(F.ln((F.lit(m) + 1.0) / (F.col("df") + 1.0)))
    terms = stage(document_frequencies(tf).select("term", "df", idf.alias("idf")))
    joined = hot_split_join(tf, terms, ["term"], "df")
    return joined.select(row_id, "term", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


# Hash buckets in which `top_vocabulary` counts all terms before it looks at any of them.
TERM_BUCKETS = 1 << 18


def top_vocabulary(df: DataFrame, row_id: str, tokens: str, min_df: int, max_terms: int) -> DataFrame:
    """(term, df, corpus_tf) of the `max_terms` most frequent terms of at least `min_df` documents, ties to the smaller term.

    Only terms that can be among them are counted by document, which is what would shuffle every term of every row. All occurrences are counted in hash
    buckets first, and no term occurs more often than its bucket. The terms of the fullest buckets tell how often one of the `max_terms` has to occur; where
    buckets that were left out reach that, a second count takes them in.
    """
    rows = token_rows(df, [row_id], tokens).withColumn("_b", F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS)))
    buckets = stage(rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")))  # at most TERM_BUCKETS rows
    least = buckets.orderBy(F.desc("_n")).limit(4 * max_terms).agg(F.min("_n")).first()[0] or 0
    while True:
        # A term of min_df documents occurs that often at least.
        least = max(least, min_df, 1)
        tf = rows.join(F.broadcast(buckets.filter(F.col("_n") >= least).select("_b")), "_b", "left_semi").groupBy(row_id, "term").agg(F.count(F.lit(1)).alias("tf"))
        found = stage(document_frequencies(tf).filter(F.col("df") >= min_df).orderBy(F.desc("corpus_tf"), "term").limit(max_terms))
        n, reached = found.agg(F.count(F.lit(1)), F.min("corpus_tf")).first()
        reached = reached if n == max_terms else 0
        if reached >= least or least <= max(min_df, 1):
            return found
        least = reached


def tfidf_top_terms(df: DataFrame, row_id: str, tokens: str, min_df: int = 15, max_terms: int = 1000) -> DataFrame:
    """(row_id, term, weight): smoothed idf + 1, rows of unit length, vocabulary = the most frequent terms.

    The vocabulary is a top-k of stated size, which is what bounds the broadcast; its terms are shuffled as numbers.
    """
    n = df.count()
    idf = F.ln((F.lit(n) + 1.0) / (F.col("df") + 1.0)) + 1.0
    numbered = F.row_number().over(Window.orderBy("term")).alias("_no")  # max_terms rows
    vocabulary = stage(top_vocabulary(df, row_id, tokens, min_df, max_terms).select("term", idf.alias("idf"), numbered))
    hits = token_rows(df, [row_id], tokens).join(F.broadcast(vocabulary.select("term", "_no")), on="term").groupBy(row_id, "_no").agg(F.count(F.lit(1)).alias("tf"))
    raw = hits.join(F.broadcast(vocabulary.select("_no", "idf")), on="_no").select(row_id, "_no", (F.col("tf") * F.col("idf")).alias("_w"))
    # A document has at most max_terms terms here, so it is one bounded row.
    rows = raw.groupBy(row_id).agg(F.collect_list(F.struct("_no", "_w")).alias("_t"), F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_len"))
    flat = rows.select(row_id, F.explode("_t").alias("t"), "_len").select(row_id, "t._no", (F.col("t._w") / F.col("_len")).alias("weight"))
    return flat.join(F.broadcast(vocabulary.select("_no", "term")), on="_no").select(row_id, "term", "weight")
