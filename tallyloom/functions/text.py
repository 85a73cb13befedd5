"""Text expressions: tokens, stop words, normal forms, n-grams, phrases and readability counts.

Everything here is a column expression evaluated inside the task that holds the row; no token is shuffled.
Short word lists become hash-set membership tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import wordlists as W


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col) -> Column:
    """Split on white space and hyphens; runs of ( ) ? ! at either end of a word become tokens of their own."""
    text = F.regexp_replace(_c(col), r"(?<![^\s-])([()?!]+)", "$1 ")
    text = F.regexp_replace(text, r"([()?!]+)(?![^\s-])", " $1")
    return F.filter(F.split(text, r"[\s-]+"), lambda x: x != "")


def without_words(col, words: list[str] = W.STOP_WORDS) -> Column:
    """Drop listed words, compared in lower case."""
    return F.filter(_c(col), lambda x: ~F.lower(x).isin(*words))


def _pieces(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda x: x != "")


def letters_only(col, lower: bool = True) -> Column:
    """Keep ASCII letters of every token and drop tokens left empty.

    Tokens hold no white space, so the whole list is cleaned as one text: one pattern pass per row, not per token.
    """
    text = F.regexp_replace(F.array_join(_c(col), " "), "[^A-Za-z ]", "")
    return _pieces(F.lower(text) if lower else text)


def stem(text: Column, rules: list[tuple[str, str]] = W.SUFFIX_RULES) -> Column:
    """Apply ordered suffix rules to every word of a text of lower-case letters and single spaces."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern[:-1] + "(?= |$)" if pattern.endswith("$") else pattern, replacement.replace("\\", "$"))
    return text


def stems(col, rules: list[tuple[str, str]] = W.SUFFIX_RULES) -> Column:
    return _pieces(stem(F.array_join(_c(col), " "), rules))


def clean_tokens(col, words: list[str] = W.STOP_WORDS, lower: bool = True) -> Column:
    return letters_only(without_words(tokens(col), words), lower)


def ngrams(col, joiner: str = "_") -> Column:
    """Single tokens followed by pairs of neighbours. Give it a column rather than an expression: it is read often."""
    tk = _c(col)
    rest = F.greatest(F.size(tk) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(tk, 1, rest), F.slice(tk, 2, rest), lambda a, b: F.concat(a, F.lit(joiner), b))
    return F.when(F.size(tk) >= 2, F.concat(tk, pairs)).otherwise(tk)


def with_ngrams(df: DataFrame, text: str, name: str = "grams", stemmed: bool = False) -> DataFrame:
    """Add the n-grams of the cleaned tokens; the tokens are computed once per row and then dropped."""
    clean = clean_tokens(text)
    return df.withColumn("_tk", stems(clean) if stemmed else clean).withColumn(name, ngrams("_tk")).drop("_tk")


def ending(endings: list[str]) -> str:
    return f"({'|'.join(endings)})$"


def tag_letter(word: Column) -> Column:
    """J, N or O for adjective, noun, other: listed words first, then endings."""
    return (F.when(word.isin(*W.ADJECTIVES), "J").when(word.isin(*W.NOUNS), "N")
            .when(word.rlike(ending(W.ADJECTIVE_ENDINGS)), "J").when(word.rlike(ending(W.NOUN_ENDINGS)), "N").otherwise("O"))


# The two phrase grammars over tagged tokens, adjectives + noun and nouns + noun.
GRAMMARS = {"JN": r"(?:J:\d+:\S+ )+N:\d+:\S+", "NN": r"(?:N:\d+:\S+ )+N:\d+:\S+"}

# The same for Java's matcher, whose stack grows with the repeats of a group unless they are possessive. A run of adjectives without
# a noun is taken as well, so that it is read once, and dropped by the blank at its end.
_RUNS = {"JN": r"(?:J:\d+:\S+ )++(?:N:\d+:\S+)?", "NN": r"N:\d+:\S+(?: N:\d+:\S+)++"}


def with_phrases(df: DataFrame, tokens_col: str, name: str = "phrases", words: list[str] = W.STOP_WORDS) -> DataFrame:
    """Add array<struct<grammar, phrase, span>>: leftmost, longest, non-overlapping matches of each grammar.

    Tokens are normalised and stop words dropped before matching; `span` is the stretch of source tokens the
    phrase was built from. Each row is written as one tagged string, so a grammar is one linear match.
    """
    raw = F.col(tokens_col)
    normal = F.split(F.lower(F.regexp_replace(F.array_join(raw, " "), "[^A-Za-z ]", "")), " ")
    entries = F.filter(F.transform(normal, lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                       lambda e: (e["w"] != "") & ~e["w"].isin(*words))
    tagged = F.array_join(F.transform(entries, lambda e: tagged_token(tag_letter(e["w"]), e["i"], e["w"])), " ")
    return df.withColumn("_tagged", tagged).withColumn(name, phrases_in("_tagged", raw)).drop("_tagged")


def tagged_token(tag: Column, position: Column, word: Column) -> Column:
    return F.concat(tag, F.lit(":"), position.cast("string"), F.lit(":"), word)


def phrases_in(tagged: str, raw: Column) -> Column:
    """array<struct<grammar, phrase, span>> of a column of tagged tokens; spans are cut from the source tokens."""
    def build(grammar: str):
        def one(match: Column) -> Column:
            first = F.regexp_extract(match, r"^[JN]:(\d+):", 1).cast("int")
            last = F.regexp_extract(match, r"[JN]:(\d+):\S+$", 1).cast("int")
            return F.struct(F.lit(grammar).alias("grammar"),
                            F.regexp_replace(match, r"[JN]:\d+:", "").alias("phrase"),
                            F.array_join(F.slice(raw, first + 1, last - first + 1), " ").alias("span"))
        runs = F.regexp_extract_all(tagged, F.lit(_RUNS[grammar]), F.lit(0))
        return F.transform(F.filter(runs, lambda run: ~run.endswith(" ")), one)

    return F.concat(*[build(g) for g in _RUNS])


# --- readability -------------------------------------------------------------------------------------------------

VOWELS = "[aeiouy]+"
SENTENCE_END = r"[.!?]+(\s|$)"


def words(col) -> Column:
    """Lower-case words: white-space pieces that hold a letter, without other characters."""
    return F.filter(F.split(F.regexp_replace(F.lower(_c(col)), r"[^a-z\s]", ""), r"\s+"), lambda x: x != "")


def syllables(word: Column) -> Column:
    """Vowel groups, at least one (a stated rule, not a pronunciation dictionary)."""
    return F.greatest(F.regexp_count(word, F.lit(VOWELS)), F.lit(1))


def _count(arr: Column, test) -> Column:
    return F.size(F.filter(arr, test))


def complexity(df, col: str):
    """Base counts as columns: chars, letters, words, sentences, syllables, polysyllables, difficult words."""
    # One array of (word, syllables) is built per row and every count is read from it.
    staged = df.withColumn("_w", F.transform(words(col), lambda w: F.struct(w.alias("w"), syllables(w).alias("s"))))
    w = F.col("_w")
    hard = F.filter(w, lambda e: (e["s"] >= 2) & ~e["w"].isin(*W.EASY_WORDS))
    return staged.withColumns({
        "n_chars_all": F.length(col),
        "n_letters": F.length(F.regexp_replace(F.lower(F.col(col)), "[^a-z]", "")),
        "n_words": F.size(w),
        "n_sentences": F.greatest(F.regexp_count(F.col(col), F.lit(SENTENCE_END)), F.lit(1)),
        "n_syllables": F.aggregate(w, F.lit(0), lambda a, e: a + e["s"]),
        "n_poly": _count(w, lambda e: e["s"] >= 3),
        "n_difficult": F.size(F.array_distinct(F.transform(hard, lambda e: e["w"]))),
    }).drop("_w")


def readability(df, col: str):
    """The eight readability scores from the base counts; NULL for a text without words."""
    base = complexity(df, col).withColumn("_head", F.slice(F.split(F.trim(F.col(col)), r"\s+"), 1, 100))
    n = lambda c: F.col(c).cast("double")
    ws = F.try_divide(n("n_words"), n("n_sentences"))
    per_word = lambda c: F.try_divide(n(c), n("n_words"))
    difficult = F.lit(100.0) * per_word("n_difficult")
    # The Linsear score is defined on a sample of 100 words; `linsear_whole` applies it to the whole text.
    head_s = F.transform(F.col("_head"), lambda x: syllables(F.lower(x)))
    head_points = F.aggregate(head_s, F.lit(0), lambda a, s: a + F.when(s >= 3, 3).otherwise(1))
    head_sentences = F.greatest(_count(F.col("_head"), lambda x: x.rlike("[.!?]+$")), F.lit(1))

    def linsear(x: Column) -> Column:
        return F.when(x > 20, x / 2).otherwise((x - 2) / 2)

    def where_words(x: Column) -> Column:
        return F.when(F.col("n_words") > 0, x)

    return base.withColumns({
        "flesch_ease": 206.835 - 1.015 * ws - 84.6 * per_word("n_syllables"),
        "kincaid_grade": 0.39 * ws + 11.8 * per_word("n_syllables") - 15.59,
        "fog": 0.4 * (ws + 100 * per_word("n_poly")),
        "smog": where_words(F.when(F.col("n_sentences") >= 3,
                                   1.043 * F.sqrt(30.0 * n("n_poly") / n("n_sentences")) + 3.1291).otherwise(0.0)),
        "coleman_liau": 5.8 * per_word("n_letters") - 29.6 * per_word("n_sentences") - 15.8,
        "ari": 4.71 * per_word("n_letters") + 0.5 * ws - 21.43,
        "dale_chall": 0.1579 * difficult + 0.0496 * ws + F.when(difficult > 5, 3.6365).otherwise(0.0),
        "linsear": where_words(linsear(head_points.cast("double") / head_sentences)),
        "linsear_whole": linsear((n("n_words") + 2 * n("n_poly")) / n("n_sentences")),
    }).withColumn("linsear_whole", where_words(F.col("linsear_whole"))).drop("_head")
