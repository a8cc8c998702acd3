import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import reading_level
from folioflow.llm.reading_level import isotonic, levels, score, sentences, train

PLAIN = "The dog sat by the door and the boy ran to the park. We had a good day at the old farm. It was warm and they were glad. "
HARD = "Insofar as the institutional generalisability of disproportionate methodologies presupposes interdisciplinary commensurability, the territoriality under which heterogeneous jurisdictions acquire legitimacy problematises any architectural interpretation of intentionality that the supervisory literature has predominantly privileged. "


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = rng.permutation(12).astype(float), rng.integers(1, 5, 12).astype(float)
        kx, ky = isotonic(x, y)
        fit = np.interp(np.sort(x), kx, ky)
        ys = y[np.argsort(x)]
        truth = [max(min(np.mean(ys[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        best = [max(min(np.mean(ys[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(fit, best) and np.allclose(truth, best) and (np.diff(fit) >= -1e-9).all()


def test_running_text():
    text = PLAIN + "\n* Heron (3)\n* Stoat (4)\nA | b | c | d\n" + PLAIN
    found, english, running = sentences(text)
    assert english == running and all("heron" not in s for s in found)
    assert score("Según el Sr. Roca, la red nunca fue vendida por la agencia de la ciudad. " * 5, train([PLAIN * 20]))[0] is None


def test_harder_text_scores_higher():
    bits = train([PLAIN * 20])
    assert score(HARD * 3, bits)[0] > 2 * score(PLAIN * 3, bits)[0]
    assert score(None, bits) == (None, 0, None) and score(" ", bits)[0] is None


def test_rows(spark):
    docs = [(i, PLAIN * 8) for i in range(6)] + [(i, HARD * 6) for i in range(6, 12)] + [(20, None), (21, ""), (22, "猫が好きです。" * 40), (23, HARD * 6), (24, PLAIN * 4 + HARD)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "r", 1) for i in range(6)] + [(i, "r", 4) for i in range(6, 12)] + [(0, "s", None), (None, "s", 2)], "doc_id long, rater string, band int")
    got = {r.doc_id: r.level for r in levels(documents, labels).collect()}
    assert got[23] == 4 and got[0] == 1 and got[24] < 3.5 and got[20] is None and got[21] is None and got[22] is None
    assert {r.level for r in levels(documents, labels.limit(0)).collect()} == {None}


def test_every_labelled_document_counts(spark):
    # the only plain texts are the last by the hash of their ids, behind 2,000 others
    ids = [r.id for r in spark.range(2060).orderBy(F.xxhash64("id"), "id").collect()]
    documents = spark.createDataFrame([(i, PLAIN * 8 if k >= 2000 else HARD * 2) for k, i in enumerate(ids)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, "r", 1 if k >= 2000 else 4) for k, i in enumerate(ids)], "doc_id long, rater string, band int")
    got = {r.doc_id: r.level for r in levels(documents, labels).collect()}
    assert len(got) == 2060 and all(got[i] < 2 for i in ids[2000:]) and all(got[i] > 3.5 for i in ids[:2000])


def test_fit_equals_one_over_collected_texts(spark, monkeypatch):
    words, rng = (PLAIN + HARD).split(), np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice(words[: 30 + i % 50], 30)) + ". " + (PLAIN if i % 3 else HARD)) for i in range(137)]
    bands = {i: int(rng.integers(1, 5)) for i, _ in docs}
    documents, labels = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(i, "r", b) for i, b in bands.items()], "doc_id long, rater string, band int")
    fold = {r.doc_id: r.fold for r in documents.select("doc_id", F.expr(f"pmod(xxhash64(doc_id), {reading_level.FOLDS})").alias("fold")).collect()}
    plain = {i: " ".join(w for s in sentences(text)[0] for w in s) + " " for i, text in docs if bands[i] <= 2 and sentences(text)[1] >= 0.5 * sentences(text)[2]}
    bits = train(list(plain.values()))
    left_out = [train([t for i, t in plain.items() if fold[i] != k]) for k in range(reading_level.FOLDS)]
    pairs = sorted((s, i) for i, text in docs if (s := score(text, left_out[fold[i]] if i in plain else bits)[0]) is not None)
    bins = np.array_split(np.arange(len(pairs)), len(pairs) // reading_level.BIN)
    knots = isotonic(np.array([np.mean([pairs[k][0] for k in b]) for b in bins]), np.array([np.mean([bands[pairs[k][1]] for k in b]) for b in bins]))
    for a_pass in (reading_level.LABELS_A_PASS, 40):
        monkeypatch.setattr(reading_level, "LABELS_A_PASS", a_pass)
        got = reading_level.fit(documents, labels)
        assert np.array_equal(got[0], bits) and len(got[1]) == len(knots[0]) and np.allclose(got[1], knots[0]) and np.allclose(got[2], knots[1])
