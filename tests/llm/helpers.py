import os

LONG = "lorem Ipsum " * 20_000
#: Nulls, empties, ties, repeats, white space alone, a very long text.
HARD = [
    (1, "One two three four five", "b", 1), (2, None, None, None), (3, "", "a", 0), (4, " \t\n\x0b\f\r", "a", 0), (5, "One two three four five", "a", 1), (5, "One two three four five", "a", 1),
    (6, "one\ttwo three  four\nfive", None, 1), (None, "no id here at all", "b", 1), (7, LONG, "b", 1), (8, "ünïcödé 日本語 😀 text", "c", 1),
]
SCHEMA = "doc_id long, text string, source string, n_chars long"


def hard(spark):
    """Documents with awkward rows and extra columns whose names clash with those that operators use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(HARD, SCHEMA)
    return df.select("*", F.lit("x").alias("size"), F.lit(1).alias("row"), F.lit(2).alias("c0"), F.lit("y").alias("key"), F.lit("z").alias("score"), F.lit("w").alias("fp"), F.lit("v").alias("Doc_Id"))


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


SF = "/root/testdata/sf0.001"
have_tables = os.path.isdir(SF)
