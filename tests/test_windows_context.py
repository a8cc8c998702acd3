from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioflow.operators.context import reduce_context
from folioflow.operators.windows import even_positions, pack, token_windows


def test_packing_carries_overlap():
    parts = ["a b c", "d e f", "g h", "i j k", "l m"]
    assert pack(parts, 8, 0.25) == ["a b c d e f g h", "g h i j k l m"]
    assert pack(["x " * 20], 5) == ["x x x x x"]
    assert pack([], 5) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=30), st.integers(1, 15), st.floats(0, 1))
def test_packing_keeps_its_promises(sizes, budget, overlap):
    parts = [" ".join(f"s{i}w{j}" for j in range(n)) for i, n in enumerate(sizes)]
    windows = pack(parts, budget, overlap)
    assert all(len(w.split()) <= budget for w in windows)
    starts = [w.split()[0].split("w")[0] for w in windows]
    order = [int(s[1:]) for s in starts]
    assert order == sorted(set(order))  # each window begins further on
    whole = {i for i, n in enumerate(sizes) if n <= budget}
    seen = {int(t.split("w")[0][1:]) for w in windows for t in w.split()}
    assert whole <= seen


def test_windows_in_spark(spark):
    df = spark.createDataFrame([(1, ["a b", "c d"]), (2, None), (3, [])], "i int, s array<string>")
    assert [r.w for r in df.select("i", token_windows(F.col("s"), 3).alias("w")).orderBy("i").collect()] == [["a b", "c d"], None, []]


def test_even_positions(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 3, 4, 6, 10)], "n int")
    got = [r.p for r in df.select("n", even_positions(F.col("n"), 3).alias("p")).orderBy("n").collect()]
    assert got == [[], [1], [1, 2, 3], [1, 3, 4], [1, 3, 6], [1, 5, 10]]


def contexts(spark, body, phrases, budget):
    df = spark.createDataFrame([(body, phrases)], "body string, phrases array<string>")
    r = reduce_context(df, budget).first()
    return r.reduced_context, r.sentences_kept, r.used_fallback


BODY = "The AI wrote it. She said no. Firewalls failed. AI again was used here. End."


def test_only_matching_sentences_in_order(spark):
    assert contexts(spark, BODY, ["ai"], 400) == ("The AI wrote it. AI again was used here.", 2, False)


def test_first_sentence_is_always_kept(spark):
    assert contexts(spark, BODY, ["ai"], 1) == ("The AI wrote it.", 1, False)


def test_fallback_is_bounded(spark):
    assert contexts(spark, BODY, ["absent"], 30) == ("The AI wrote it. She said no.", 2, True)
    assert contexts(spark, BODY, None, 16)[2] is True
    assert contexts(spark, None, ["ai"], 16) == ("", 0, True)
