import numpy as np
import pytest

from folioflow.llm import structure
from folioflow.llm.structure import KINDS, divergences, measure, nearest, profiles, statistics



def shares(text):
    return dict(zip(KINDS, structure.shares([text])[0]))


PROSE = "The council restored the old archive in May, although nobody had asked for it. Researchers found that the flaw was in a second pump. "


@pytest.mark.parametrize("text", [PROSE * 3, "Die Anlage war nicht betroffen, sagte der Betreiber. Wer sie nutzt, sollte sie prüfen.", "谁来负责关闭这些摄像头？为什么芯片没有被及时隔离？", "أعلن د. كرمال أن الحساب لم يعد يعمل مع الخادم السري.", "and the " * 100, "Lorem ipsum dolor sit amet magna. Orci massa dolor nibh magna.", "1) " + PROSE + "\n2) " + PROSE.upper(), "Error 404\nThe page could not be found on this server."])
def test_language_is_prose(text):
    assert shares(text)["prose"] > 0.9


@pytest.mark.parametrize("text,kind", [("\n".join(f"- old gateway {i}" for i in "abcdefgh"), "list"), ("\n".join(f"* Heron{i} ({i})" for i in range(9)), "list"), ("\n".join(f"Gateway {'.' * 8} {i}" for i in range(9)), "table"), ("\n".join(f"A-{i} | old pump | Acme | 4.{i} | open" for i in range(9)), "table"), ("\n".join(f"A-{i},old pump,Acme,4.{i},open,May" for i in range(9)), "table"), ("3f9a77c0b1e24d55" * 40, "junk"), ("\n".join(".a-b>li{margin:4px;color:#5b60bf}" for _ in range(9)), "junk"), ("a l e r t n o d e p r o x y t o k e n " * 5, "junk"), ("Rava Stone, Acme\nIlo Hill, Norde\nUna Berg, Sole\nOra Wood, Tern", "list")])
def test_other_shapes(text, kind):
    assert shares(text)[kind] > 0.9


def test_divergences():
    p = np.zeros((2, structure.NEW), np.float32)
    p[0, 0] = p[1, 1] = 1
    d = divergences(p, p)
    assert abs(d[0, 0]) < 1e-5 and abs(d[0, 1] - 1) < 1e-5  # a weight of 1: one bit for disjoint distributions
    q, script, kinds = profiles()
    own, distance = nearest(q, np.maximum(script, 0))
    assert [KINDS[k] for k in own] == kinds and distance.max() < 1e-4


def test_the_divergence_decides(monkeypatch):
    table = "\n".join(f"A-{i} | old pump | Acme | 4.{i} | open" for i in range(9))
    assert shares(table)["table"] > 0.9
    monkeypatch.setattr(structure, "divergences", lambda p, q: np.arange(len(q))[:, None] + np.zeros((1, len(p))))
    assert shares(table)["prose"] == 1.0


@pytest.mark.parametrize("wrapped", [False, True])
def test_a_table_below_prose_is_told_from_it(wrapped):
    prose = structure._wrap(PROSE * 4, 60) if wrapped else PROSE * 4
    table = "\n".join(f"A-{i} ; old pump ; Acme ; 4.{i} ; open" for i in range(12))
    share = len(table) / (len(prose) + len(table))
    assert abs(shares(f"{prose}\n{table}")["table"] - share) < 0.1 and abs(shares(f"{table}\n\n{prose}")["table"] - share) < 0.1


def test_texts_together_and_alone_agree():
    texts = [PROSE, "- a b\n- c d\n- e f", " \n ", PROSE * 50, "3f9a77c0b1e24d55" * 40, "x", "\n\n", "谁来负责关闭这些摄像头？为什么芯片没有被及时隔离？"]
    assert np.allclose(structure.shares(texts), np.concatenate([structure.shares([t]) for t in texts]))
    assert np.allclose(measure(texts), np.concatenate([measure([t]) for t in texts]), atol=1e-5)


def test_rows(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "  \n"), ("d", PROSE)], "pdf_id string, text string")
    got = {r.pdf_id: r for r in statistics(df).collect()}
    assert set(got) == {"c", "d"} and got["c"].prose_share == 0 and got["d"].n_words == len(PROSE.split())
    assert measure(["x" * 3_000_000])[0, 0] == 3_000_000 and measure([PROSE])[0, 1] == len(PROSE.split())
