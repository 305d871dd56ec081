import re

from pyspark.sql import functions as F

from textfeat.functions import names, patterns, scores, text


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_separator_ranges_hold_the_same_characters(spark):
    """Both forms of the separator, over every code point that a string can hold."""
    points = spark.range(0x10000).where("id NOT BETWEEN 55296 AND 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE")
    differing = points.select("id", char.alias("c")).where(
        F.split(F.concat(F.lit("a"), "c", F.lit("b")), patterns.WORD_SEPARATOR)
        != F.split(F.concat(F.lit("a"), "c", F.lit("b")), patterns.WORD_SEPARATOR_RANGES)
    )
    assert differing.count() == 0


def test_tokens_match_a_plain_split(spark):
    texts = [
        "--Hello world-- it's 1st café",
        "a ×÷ b",
        "...",
        "",
        "one",
        "a--b---c -- d - e-f --",
        "İstanbul KELVIN KÅ ÀÉÎƿǀ \U0001f600x",
        "line\none\ttwo three",
    ]
    found = values(spark, texts, text.tokens)
    split = re.compile(patterns.WORD_SEPARATOR)
    assert found == [[w.lower() for w in split.split(t)] for t in texts]
    assert found[0] == ["", "hello", "world", "", "it's", "st", "café"]
    assert found[1] == ["a", "×÷", "b"]
    assert found[2] == ["", ""]


def test_names(spark):
    files = ["12220-8.txt", "12220-0.txt", "12220.txt", "1222-10.txt", "a12-3.txt", "7-0.zip", "x7-0.txt", "5-8Xtxt"]
    assert values(spark, files, names.strip_suffix) == [
        "12220.txt", "12220.txt", "12220.txt", "1222.txt", "a12.txt", "7-0.zip", "x7.txt", "5-8Xtxt",
    ]
    assert values(spark, files, names.encoding_preference) == [2, 0, 1, 1, 1, 1, 1, 2]
    assert values(spark, ["a/b/c.txt", "d.txt"], names.base_name) == ["c.txt", "d.txt"]


def test_document_id(spark):
    texts = ["x [EBook #12] [EBook #13]", "[ etext# 007 ]", "EBook #5", "[eBook #]", "[EBook #99999999999999999999]"]
    assert values(spark, texts, text.document_id) == [12, 7, -1, -1, -1]


def test_boilerplate(spark):
    start, end = "\n*** START OF X GUTENBERG Y ***\n", "*** END OF THE GUTENBERG X ***"
    texts = [
        f"pre{start}note{start}body\n{end}\nlicence {end}",
        f"{start[1:]}body",
        "body only",
        f"a{start}b ***START: FULL LICENSE*** c",
        f"{end} x{start}body",
        f"p{start.lower()}body",
    ]
    assert values(spark, texts, text.strip_boilerplate) == [
        "body\n", f"{start[1:]}body", "body only", "b ", "body", "body",
    ]


def test_newlines(spark):
    assert values(spark, ["a\r\nb\r\n", "a\rb", "a\n\n", "a", "\n"], text.normalise_newlines) == [
        "a\nb", "a\nb", "a\n", "a", "",
    ]


def test_scores(spark):
    row = spark.range(1).select(
        scores.ratio(F.lit(1), F.lit(0)).alias("zero"),
        scores.ratio(F.lit(1), F.lit(4)).alias("quarter"),
        scores.keeps_share(F.lit(10), F.lit(1000), 1.0).alias("edge"),
        scores.keeps_share(F.lit(9), F.lit(1000), 1.0).alias("below"),
        scores.hash_bin(F.lit("word"), 97).alias("fast"),
        scores.hash_bin(F.lit("word"), 97, portable=True).alias("portable"),
    ).first()
    assert (row.zero, row.quarter, row.edge, row.below) == (0.0, 0.25, True, False)
    assert 0 <= row.fast < 97
    import hashlib

    assert row.portable == int(hashlib.md5(b"word").hexdigest()[:8], 16) % 97


def test_terms_on_the_limit_are_kept(spark):
    for pct, n, df in ((1.1, 100_000, 1_100), (0.07, 10_000, 7), (1.0, 300, 3)):
        row = spark.range(1).select(
            scores.keeps_share(F.lit(df), F.lit(n), pct).alias("on"), scores.keeps_share(F.lit(df - 1), F.lit(n), pct).alias("under")
        ).first()
        assert row.on and not row.under
