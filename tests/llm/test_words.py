"""Words are cut at what lies between them, not matched."""

from pyspark.sql import functions as F

from recordflow.llm.common import WORD, lower_ascii, word_count, words

TEXTS = [
    None, "", " ", "...", "one", " One, two ", "\n\ta-B_c9\x7f", "Été ÀÉ naïve", "日本 語\u3000中", "\U0001f600x \U0001f600",
    "\x00a\x00", "a\u0080b", "0/9:@AZ[`az{~", "x" * 5000 + " " * 5000 + "Y",
]


def test_words_are_those_the_pattern_matches(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    text = F.col("text")
    matched = F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    for row in df.select(words(text).alias("w"), word_count(text).alias("n"), matched.alias("m")).collect():
        assert row.w == row.m and row.n == len(row.m)


def test_words_are_cut_not_matched(spark):
    df = spark.createDataFrame([("a b",)], "text string").select(words(F.col("text")), word_count(F.col("text")))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
