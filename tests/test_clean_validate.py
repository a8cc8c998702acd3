from pyspark.sql import functions as F

from folioflow.config import Config
from folioflow.operators.clean import clean
from folioflow.operators.validate import validate

BODY = " ".join(f"word{i} reached the lake shore" for i in range(25))


def pages(spark, *rows):
    return spark.createDataFrame([(str(i), list(p) if p is not None else None) for i, p in enumerate(rows)], "pdf_id string, pages array<string>")


def test_blocks_are_scored(spark):
    page = "\n\n".join(["Home About Contact", "We use a cookie. Sign up now", "A short headline here", BODY, "Follow us\nAll rights reserved"])
    row = clean(pages(spark, [page])).first()
    assert row.title == "Home About Contact" and row.body == BODY and row.block_count == 1 and row.removed_lines == []


def test_title_after_scoring_skips_menus(spark):
    page = "\n\n".join(["Sign in Sign up", "A real headline", BODY])
    assert clean(pages(spark, [page]), title_after_scoring=True).first().title == "A real headline"


def test_repeated_lines_go(spark):
    p = [f"Running head\n{BODY} {x}\nFoot 1" for x in "abc"]
    row = clean(pages(spark, p)).first()
    assert row.removed_lines == ["Foot 1", "Running head"] and "Running head" not in row.body
    # two of three pages are most, one of two isn't
    row = clean(pages(spark, ["x\nsame", "y\nsame", "z"], ["x\nonce", "y"])).orderBy("pdf_id").collect()
    assert row[0].removed_lines == ["same"] and row[1].removed_lines == []


def test_a_line_twice_on_one_page_counts_once(spark):
    assert clean(pages(spark, ["a\na\na", "b", "c"])).first().removed_lines == []


def test_odd_inputs(spark):
    rows = clean(pages(spark, None, [], [""], ["  \n \n"])).orderBy("pdf_id").collect()
    assert [(r.body, r.block_count, r.title) for r in rows] == [(None, None, None), ("", 0, None), ("", 0, None), ("", 0, None)]


def verdicts(spark, bodies, config=Config()):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    return [(r.status, r.reason) for r in validate(df, config).orderBy("i").collect()]


def distinct_words(n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join(letters[i // 26 % 26] + letters[i % 26] + "x" for i in range(n))


def test_rules_in_order(spark):
    long = distinct_words(130)
    got = verdicts(spark, [long, "Attention required! " + long, "same words again " * 60, "too few", None, ""])
    assert got == [("accepted", None), ("rejected", "failure_signal"), ("rejected", "low_unique_word_ratio"), *[("rejected", "too_short")] * 3]


def test_limits_from_config(spark):
    assert verdicts(spark, ["one two three four"], Config(min_words=4)) == [("accepted", None)]
    assert verdicts(spark, ["one two three four"], Config(min_words=4, min_chars=100)) == [("rejected", "too_short")]


def test_signals(spark):
    row = validate(spark.createDataFrame([(" It's RAY ID 5, it's ",)], "body string")).select(F.struct("*").alias("r")).first().r
    assert (row.content_words, row.content_chars, row.failure_signal, row.unique_word_ratio) == (4, 19, "ray id", 0.75)
