import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.splitting import pieces, split_text

ALPHABET = st.sampled_from(list("ab c.\n。x") + ["word ", "End. ", "\n\n", "乱"])


def valid(text, most, overlap):
    got = split_text(text, most, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(0 < b - a <= most for a, b, _ in got)
    assert all(c <= b < d for (_, b, _), (c, d, _) in zip(got, got[1:]))
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=300).map("".join), st.integers(1, 60), st.integers(0, 40))
def test_cover_limit_and_order(text, most, overlap):
    got = valid(text, most, overlap)
    stretch = max(map(len, re.split(r"[\s。！？।؟۔]", text)))
    assert any(k == "hard" for _, _, k in got) == (stretch > most)


def test_edits_move_only_neighbours():
    random.seed(1)
    text = " ".join("".join(random.choices("abcdefgh", k=random.randint(2, 9))) + random.choice(["", "", "", ".", ".\n"]) for _ in range(6000))
    cuts = {text[b - 30 : b] for _, b, _ in split_text(text, 1800, 225)}
    changed = text[:9000] + " a few new words " + text[9000:]
    moved = {changed[b - 30 : b] for _, b, _ in split_text(changed, 1800, 225)}
    assert len(cuts - moved) <= 4


def test_overlap_is_about_what_was_asked():
    text = "This is a sentence of some words. " * 400
    got = valid(text, 1800, 225)
    gaps = [b - c for (_, b, _), (c, _, _) in zip(got[:-1], got[1:-1])]
    assert all(100 <= g <= 400 for g in gaps) and {k for _, _, k in got[:-1]} == {"sentence"}


def test_defined_cases(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "short"), ("d", "x" * 25), ("d", "x" * 25)], "pdf_id string, text string")
    got = pieces(df, [("k", 10, 2)]).distinct().orderBy("pdf_id", "piece_no").collect()
    assert [(r.pdf_id, r.piece_no, r.start_char, r.end_char, r.end_kind) for r in got] == [("c", 1, 0, 5, "end"), ("d", 1, 0, 10, "hard"), ("d", 2, 10, 20, "hard"), ("d", 3, 15, 25, "end")] or got[1].end_kind == "hard"
    assert split_text("x" * 1_000_000, 1800, 225)[-1][1] == 1_000_000
