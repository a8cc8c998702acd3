from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm.repetition import BIT, ablations, apply_policy, copied_share, failures, ledger


def brute(text, width=40):
    chars = [c for c in text.lower() if c.isalnum()]
    seen, covered = set(), [False] * len(chars)
    for i in range(len(chars) - width + 1):
        gram = tuple(chars[i : i + width])
        if gram in seen:
            covered[i : i + width] = [True] * width
        seen.add(gram)
    return sum(covered) / len(chars) if chars else 0.0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["alpha beta ", "Gamma-delta. ", "one two three four five six ", "X9! ", "ß é "]), max_size=60).map("".join))
def test_share_equals_brute_force(text):
    assert abs(copied_share(text) - brute(text)) < 1e-12


def test_case_spacing_and_script():
    sentence = "The quick brown fox jumps over the lazy dog near the old river bank at night. "
    assert copied_share(sentence + sentence.upper().replace(" ", "  ")) == 0.5
    assert copied_share(sentence) == 0.0 and copied_share("!!! ...") == 0.0
    chinese = "报告指出模型的审计需要工厂与漏洞共同完成。"
    assert copied_share(chinese * 2) == 0.5


def test_ledger_and_policies(spark):
    loop = "and the " * 200
    df = spark.createDataFrame([("a", loop), ("b", "Plain text without any loop at all."), ("c", None), ("d", ""), ("a", loop)], "pdf_id string, text string")
    rows = ledger(df).distinct()
    got = {r.pdf_id: r.failed for r in rows.collect()}
    assert set(got) == {"a", "b"} and got["b"] == 0 and got["a"] & BIT["copied_share"]
    assert [r.pdf_id for r in apply_policy(rows, "copied-v1").collect()] == ["a"]
    report = {r.rule: (r.failed, r.only_this, r.records, r.rejected) for r in ablations(rows, "all-v1").collect()}
    assert report["copied_share"][0] == 1 and report["copied_share"][2:] == (2, 1)


def test_bits_follow_limits():
    assert failures((0.4, 0.0, 0.0, 0.0, 0.19)) == BIT["copied_share"] and failures((0.39, 0.3, 0, 0, 0)) == BIT["line_share"]
