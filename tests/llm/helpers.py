"""Small tables with every awkward case: null ids and texts, repeats, ties, odd columns."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns that operators use themselves, under other types
CLASH = ["score", "fp", "key", "h", "ids", "ids_1", "grp", "stream", "p", "ppm", "toxicity", "simhash_text",
         "component_id", "n_words", "words", "root", "target", "rid", "predicted"]


def awkward(spark):
    long_text = " ".join(f"word{k % 97} the of and" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Two words"), (6, "Two words"), (6, "Two words"),
            (None, "no id here at all"), (None, None), (7, long_text), (8, "Ünï çödé 日本語 😀 x́   end"),
            (9, "a\x1cb \x00 ctl\x7f"), (10, "the cat sat on the mat the cat sat on the mat"), (11, "12345 !!! ???")]
    df = spark.createDataFrame([(i, t, "en" if k % 2 else None, None, None) for k, (i, t) in enumerate(rows)], SCHEMA)
    return df


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])


def rows_of(df):
    return sorted(map(repr, df.collect()))


def check_edges(spark, op, columns=None):
    """The operator runs on awkward rows, ignores other columns and gives nothing for nothing."""
    docs = awkward(spark)
    plain = op(docs)
    got = rows_of(plain)
    assert rows_of(op(clashing(docs)).select(*plain.columns)) == got
    empty = op(docs.where("doc_id = -1"))
    assert empty.columns == plain.columns and empty.count() == 0
    if columns:
        assert plain.columns == columns
    return plain
