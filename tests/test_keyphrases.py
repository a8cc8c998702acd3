from functools import partial

import pytest

from folioflow.functions.text import STOP_WORDS, content_words, segment_words, segments
from folioflow.models.backends import FACTORIES, HashingEncoder, register
from folioflow.operators.keywords import keyphrases

WORDS = "gateway archive council report budget harbour market winter letter bridge Größe éclair 数据 x9 it_em".split()
TEXTS = [
    "Gateways failed in May. The council restored the red gateway; every green archive, too!",
    "Dr. Smith and Mr. Jones met at St. Mary. No. 4 vs. the US. Then they left, etc. and so on.",
    "red red red gateway. red gateway red gateway red. red red",
    " ".join(["lone"] * 40) + ". pair of pairs",
    "ΟΔΟΣ ΣΟΦΟΣ. İstanbul'da I ΑΣ.Σ a\u0001b gate\u0001way   non breaking line",
    "安全系统的网关失效。日本語 テスト、データ. ประเทศ हिन्दी में सुरक्षा",
    " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + ("." if i % 11 == 0 else "") for i in range(1500)),
    " ".join(f"w{i} and v{i * 7 % 400}" + (";" if i % 5 == 0 else "") for i in range(900)),
    "the and of a I",
    "one",
    "",
    None,
]


@pytest.fixture(scope="module")
def bodies(spark):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(TEXTS)], "pdf_id string, body string")


@pytest.mark.parametrize("longest,top", [(3, 5), (1, 2), (4, 1000)])
def test_ranked_where_they_lie_as_by_phrases(bodies, longest, top):
    small = partial(HashingEncoder, 4)  # most words share a place
    small.of_words = True
    register("small", small)
    register("small by phrases", partial(HashingEncoder, 4))
    register("by phrases", partial(HashingEncoder))
    rows = lambda name: {r.pdf_id: [(k.phrase, k.score) for k in r.keywords] for r in keyphrases(bodies, longest=longest, top=top, backend=name).collect()}
    for one, other in (("hashing", "by phrases"), ("small", "small by phrases")):
        found = rows(one)
        assert found == rows(other) and len(found) == len(TEXTS) and found["d10"] == found["d11"] == [] and len(found["d7"]) == top


def test_words_of_another_encoder(bodies):
    class Syllables(HashingEncoder):
        """Sees some words as several tokens and some as none."""

        def _text(self, text):
            return text.replace("way", " way").replace("pair", "p")

        def slots(self, text):
            return super().slots(self._text(text))

        def encode(self, texts):
            return super().encode([self._text(t) for t in texts])

    register("syllables", Syllables)
    register("syllables by phrases", lambda: Syllables())
    one, other = ({r.pdf_id: r.keywords for r in keyphrases(bodies, backend=name).collect()} for name in ("syllables", "syllables by phrases"))
    assert one == other


def test_texts_are_not_taken_apart(bodies):
    plan = keyphrases(bodies)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan and plan.count("ArrowEvalPython") == 1
    exploded = keyphrases(bodies).selectExpr("pdf_id", "posexplode(keywords)")
    assert exploded._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_segment_words(bodies):
    for r in bodies.where("body is not null").select(segment_words(bodies.body).alias("runs"), segments(bodies.body).alias("segments")).collect():
        kept = [[w for w in run.split() if len(w) > 1 and w not in STOP_WORDS] for run in r.runs.split("\u0001")]
        df = bodies.sparkSession.createDataFrame([(s,) for s in r.segments], "s string")
        assert [k for k in kept if k] == [list(x.w) for x in df.select(content_words(df.s).alias("w")).collect() if x.w]


def test_encoder_counts_words():
    import numpy as np
    import xxhash

    text = "red gateway red archive " * 700
    expected = []
    tokens = text.split()
    for i in range(0, len(tokens), 512):
        vector = np.zeros(256, np.float32)
        for token in tokens[i : i + 512]:
            h = xxhash.xxh64_intdigest(token)
            vector[h % 256] += 1.0 if h >> 63 else -1.0
        expected.append(vector / np.linalg.norm(vector))
    pooled = np.mean(expected, axis=0)
    assert (FACTORIES["hashing"]().encode([text])[0] == pooled / np.linalg.norm(pooled)).all()
