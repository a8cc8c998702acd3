import zlib

import pytest

from folioflow.config import Config
from folioflow.models.backends import FACTORIES, HashingEncoder, label_scores, register
from folioflow.operators.classify import TOPICS, classify
from folioflow.operators.keywords import keyphrases
from folioflow.operators.summarize import summarize
from folioflow.plans.runner import run
from folioflow.sources.corpus import extract, pdf_pages, scan


def pdf(*pages, deflate=False):
    out = b"%PDF-1.4\n"
    for page in pages:
        stream = b"BT " + b" T* ".join(b"(" + line.replace("(", r"\(").replace(")", r"\)").encode("latin-1") + b") Tj" for line in page.split("\n")) + b" ET"
        head = b"<< /Length 1 >>"
        if deflate:
            stream, head = zlib.compress(stream), b"<< /Filter /FlateDecode >>"
        out += b"1 0 obj << /Type /Page >> endobj\n2 0 obj " + head + b"\nstream\n" + stream + b"\nendstream endobj\n"
    return out + b"%%EOF"


LETTERS = "abcdefghijklmnopqrstuvwxyz"
LONG = "\n".join(" ".join(LETTERS[i] + LETTERS[j] + "on" for j in range(8)) for i in range(18)) + "."


def test_reader():
    assert pdf_pages(pdf("Hello (you)\nthere", "two")) == (2, ["Hello (you)\nthere", "two"])
    assert pdf_pages(pdf("a", "b", "c", deflate=True), 2) == (3, ["a", "b"])
    with pytest.raises(ValueError):
        pdf_pages(b"no pdf")


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "pdfs"
    folder.mkdir()
    (folder / "short.pdf").write_bytes(pdf("Only five words are here"))
    (folder / "long.pdf").write_bytes(pdf(LONG, deflate=True))
    (folder / "bad.pdf").write_bytes(b"garbage")
    return folder


def test_scan_ids_come_from_content(spark, corpus):
    (corpus / "copy.pdf").write_bytes((corpus / "short.pdf").read_bytes())
    rows = scan(spark, str(corpus)).collect()
    assert len(rows) == 4 and len({r.doc_id for r in rows}) == 3 and all(len(r.doc_id) == 16 for r in rows)


def test_a_bad_document_is_one_error(spark, corpus):
    got = {r.status: (r.pages_total, r.error) for r in extract(scan(spark, str(corpus))).collect()}
    assert got["error"][1].startswith("ValueError") and got["ok"][0] == 1


def test_second_run_computes_nothing(spark, corpus, tmp_path):
    store = str(tmp_path / "store")
    first = run(spark, str(corpus), store, Config())
    assert first.counts["extract"] == {"computed": 2, "cached": 0, "errors": 1, "skipped": 0}
    assert first.counts["validate"] == {"computed": 2, "cached": 0, "errors": 0, "skipped": 1}
    assert first.counts["summarize"] == {"computed": 1, "cached": 0, "errors": 0, "skipped": 2}
    second = run(spark, str(corpus), store, Config(), through="validate")
    assert set(second.counts) == {"extract", "clean", "validate"}
    assert second.counts["clean"] == {"computed": 0, "cached": 2, "errors": 0, "skipped": 1}
    assert second.counts["extract"]["errors"] == 1  # a failure is tried again
    changed = run(spark, str(corpus), store, Config(min_words=3), through="validate")
    assert changed.counts["clean"]["cached"] == 2 and changed.counts["validate"]["computed"] == 2


def test_unknown_document(spark, corpus, tmp_path):
    with pytest.raises(ValueError):
        run(spark, str(corpus), str(tmp_path / "s"), wanted="nothing-like-it")


def test_stand_in_models(spark):
    vectors = HashingEncoder().encode(["red gateway", "", "red gateway"])
    assert abs((vectors[0] ** 2).sum() - 1) < 1e-5 and not vectors[1].any() and (vectors[0] == vectors[2]).all()
    df = spark.createDataFrame([("d", "Security technology and industry news. Gateways failed."), ("e", None)], "pdf_id string, body string")
    scores = df.select(label_scores(df.body, TOPICS, "This is {}.", True).alias("s")).first().s
    assert abs(sum(scores.values()) - 1) < 1e-9
    rows = {r.pdf_id: r for r in classify(df).collect()}
    assert rows["d"].predicted_label in TOPICS and rows["d"].n_windows == 1
    assert rows["e"].n_windows == 0 and abs(rows["e"].confidence - 1 / 3) < 1e-9
    phrases = {r.pdf_id: r.keywords for r in keyphrases(df).collect()}
    assert len(phrases["d"]) == 5 and phrases["e"] == []


def test_guarded_retry(spark):
    class Rude:
        def generate(self, prompts, max_tokens):
            return [("One. Two. Three." if "last answer" not in p else "Fine.", 1, 1) for p in prompts]

    class Broken:
        def generate(self, prompts, max_tokens):
            raise RuntimeError("down")

    register("rude", Rude)
    register("broken", Broken)
    df = spark.createDataFrame([("d", "text"), ("e", None)], "pdf_id string, reduced_context string")
    rows = summarize(df, Config(injection_guard=True), backend="rude").collect()
    assert [(r.summary, r.output_guard_triggered) for r in rows] == [("Fine.", True)] * 2
    assert summarize(df, Config(), backend="rude").first().summary == "One. Two. Three."
    assert {r.error for r in summarize(df, Config(injection_guard=True), backend="broken").collect()} == {"RuntimeError: down"}
    for name in ("rude", "broken"):
        FACTORIES.pop(name)
