import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside; as columns of the input they must not interfere.
CLASHES = ["id", "key", "uid", "u", "v", "c", "n", "s", "e", "pos", "items", "spans", "bands", "component", "leaf", "rank", "epoch", "tokens", "marks", "w",
           "_id", "_bad", "_gone", "_kept", "_rejected", "_severity", "_grade", "_spans", "_judged", "_w", "_g", "_epoch", "_take", "take_tokens"]


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang, source); `clash` adds columns with awkward names."""
    from pyspark.sql import functions as F

    def build(rows, clash=False):
        full = [(r[0], r[1], *(r[2:] or ("en", "src1")), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.withColumns({c: F.lit(7) for c in CLASHES}) if clash else df

    return build


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "x" * 300_000), (7, "word " * 20_000), (8, "one"), (8, "one"), (None, "one two"), (9, "ß ñ é\n" * 3)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, blanks, very long texts, ties and repeated rows."""
    return EDGE
