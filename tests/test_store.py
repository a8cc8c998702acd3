"""Stores over several runs: caching by source and backend, the index, reports, exports and what is set apart."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow.config import Config, load_tree
from folioflow.plans import harness, metrics, registry, runner
from folioflow.sources.corpus import hashed, listing, read_file
from folioflow.sources.tables import exists, quarantine, write_json

from test_runner import LONG, pdf


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pdfs")
    (folder / "a b%20c.pdf").write_bytes(pdf("Only five words are here"))
    (folder / "long.pdf").write_bytes(pdf(LONG))
    (folder / "bad.pdf").write_bytes(b"garbage")
    return folder


def test_files_are_hashed_where_they_lie(spark, corpus):
    rows = {r.path: r for r in hashed(listing(spark, str(corpus))).collect()}
    assert len(rows) == 3 and all(r.doc_id == r.sha256[:16] for r in rows.values())
    assert sorted(read_file(p)[:4] for p in rows) == [b"%PDF", b"%PDF", b"garb"]


def test_an_edited_stage_is_computed_anew(spark, corpus, tmp_path, monkeypatch):
    store, source = str(tmp_path / "store"), tmp_path / "stage.py"
    source.write_text("one")
    clean = registry.STAGES["clean"]
    monkeypatch.setitem(registry.STAGES, "clean", registry.Stage("clean", clean.version, clean.needs, clean.config_keys, (str(source),)))
    first = runner.run(spark, str(corpus), store, through="clean", run_id="r1")
    again = runner.run(spark, str(corpus), store, through="clean", run_id="r2")
    assert first.counts["clean"]["computed"] == 2 and again.counts["clean"] == {"computed": 0, "cached": 2, "errors": 0, "skipped": 1}
    source.write_text("two")
    registry.source_of.cache_clear()
    edited = runner.run(spark, str(corpus), store, through="clean", run_id="r3")
    assert edited.counts["extract"]["cached"] == 2 and edited.counts["clean"]["computed"] == 2
    # the index, what was set apart, the report, and the run's record
    index = runner.index(spark, store).collect()
    assert [r.doc_id for r in index] == sorted(r.doc_id for r in index) and sorted(r.status for r in index) == ["error", "extracted", "extracted"]
    assert {r.error.split(":")[0] for r in spark.read.json(f"{store}/quarantine/manifest").collect()} == {"ValueError"}
    report = runner.run_report(spark, store, "r2").collect()
    assert sorted(len(r.cached_stages) for r in report) == [0, 2, 2] and [r.doc_id for r in report] == sorted(r.doc_id for r in report)
    assert json.loads((tmp_path / "store/runs/r3.json").read_text())["stages"]["clean"]["computed"] == 2
    assert runner.compact(spark, store)["extract"] == 3
    assert runner.index(spark, str(tmp_path / "none")).count() == 0


def test_limits_and_protocols(spark, corpus, tmp_path):
    assert runner.run(spark, str(corpus), str(tmp_path / "s"), Config(max_pdfs=1, workers=2), through="extract").counts["extract"]["skipped"] == 0
    with pytest.raises(ValueError):
        runner.by_protocol(spark, str(corpus), str(tmp_path / "s"), Config(protocol="C"))
    with pytest.raises(ValueError):
        runner.run(spark, str(corpus), str(tmp_path / "s"), Config(backend="none"), through="extract")


def test_backends_differ(spark):
    from folioflow.models.backends import FACTORIES, backend, masked_mean
    from folioflow.operators.keywords import keyphrases

    one, two = backend("hashing"), backend("lexical")
    text = "Gateways failed in May. The council restored the red gateway and every green archive."
    df = spark.createDataFrame([("d", text)], "pdf_id string, body string")
    scores = [{k.phrase: round(k.score, 4) for k in keyphrases(df, backend=b.encoder).first().keywords} for b in (one, two)]
    assert scores[0] != scores[1]
    long = FACTORIES[two.encoder]().encode(["word " * 600, "word " * 600 + "tail"])
    assert (long[0] == long[1]).all()  # cut at the window, where the other pools
    import numpy as np

    pooled = masked_mean(np.array([[[3.0, 4.0], [9.0, 9.0]]]), np.array([[1, 0]]))
    assert np.allclose(pooled, [[0.6, 0.8]])
    with pytest.raises(Exception):
        FACTORIES[backend("onnx:/nowhere").encoder]()


def test_exports(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    totals = metrics.export(spark, data, str(tmp_path / "m"))
    assert {"all"} < set(totals) and json.loads((tmp_path / "m/metrics.json").read_text())["runs"]
    assert all((tmp_path / "m" / device / "metrics.json").exists() for device in totals if device != "all")
    df = spark.createDataFrame([("a/b", True, "raw\ntext"), ("c", False, "x")], "doc_id string, bad boolean, reply string")
    quarantine(df, "bad", str(tmp_path / "q"), raw="reply")
    assert [r.doc_id for r in spark.read.json(str(tmp_path / "q/manifest")).collect()] == ["a/b"] and (tmp_path / "q/raw/name=a_b").exists()
    write_json(spark, {"a": 1}, str(tmp_path / "x/y.json"))
    assert exists(spark, str(tmp_path / "x/y.json")) and not exists(spark, str(tmp_path / "x/z.json"))


def test_grid_and_settings(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    cells = harness.grid(spark, lambda: spark.range(10).groupBy("id").agg(F.count("*")), (1, 2), ("1m",))
    assert [c["partitions"] for c in cells] == [1, 2] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert harness.resident_mb()["total"] > 0
    (tmp_path / "s.yaml").write_text("run:\n  max_pages: 2\n")
    (tmp_path / "e.yaml").write_text("")
    assert load_tree(str(tmp_path / "s.yaml")) == {"run": {"max_pages": 2}} and load_tree(str(tmp_path / "e.yaml")) == {}


def test_pages_come_in_the_order_of_the_tree():
    import zlib

    from folioflow.sources.corpus import pdf_pages

    def stream(data, extra=b""):
        packed = zlib.compress(data)
        return b"<< /Filter /FlateDecode /Length %d %s>>\nstream\n%s\nendstream" % (len(packed), extra, packed)

    to_unicode = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <0416> endbfchar 1 beginbfrange <0002> <0004> <0061> endbfrange"
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>",
        2: b"<< /Type /Pages /Kids [4 0 R 3 0 R] /Count 2 /Resources << /Font << /F1 8 0 R >> >> >>",
        3: b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>",
        4: b"<< /Type /Page /Parent 2 0 R /Contents [6 0 R 7 0 R] >>",
        5: stream(b"BT (second \\(page\\)) Tj 0 -12 Td (caf\\351) Tj ET"),
        6: stream(b"BT /F1 12 Tf <00010002> Tj ET"),
        7: stream(b"BT /F1 12 Tf [<0003> -300 <0004>] TJ ET"),
        8: b"<< /Type /Font /ToUnicode 9 0 R >>",
        9: stream(to_unicode),
    }
    file = b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in objects.items()) + b"trailer << /Root 1 0 R >>\n%%EOF"
    assert pdf_pages(file) == (2, ["\u0416a\nb c", "second (page)\ncafé"])
    assert pdf_pages(file, 1) == (2, ["\u0416a\nb c"])
    # the same with the pages' dictionaries in an object stream
    inner = [(n, objects[n]) for n in (2, 3, 4)]
    index = b" ".join(b"%d %d" % (n, sum(len(o) + 1 for _, o in inner[:i])) for i, (n, _) in enumerate(inner)) + b" "
    packed = stream(index + b" ".join(o for _, o in inner), b"/Type /ObjStm /N 3 /First %d " % len(index))
    file = b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, o) for n, o in {**{k: v for k, v in objects.items() if k not in (2, 3, 4)}, 10: packed}.items()) + b"%%EOF"
    assert pdf_pages(file)[1] == ["\u0416a\nb c", "second (page)\ncafé"]
