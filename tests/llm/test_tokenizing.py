import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from folioflow.llm.tokenizing import Encoder, Lexicon, default_vocabulary, encode_texts, load_ranks, merge  # noqa: E402

RANKS = load_ranks(open(default_vocabulary(), "rb").read())
TRUTH = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TRUTH.encode_special_tokens = True
WORDS = {w: merge(w, RANKS) for w in (b" the", b" gateway", b"Quorvorn", b" gate", b"the", "日本".encode())}
ENCODER = Encoder(RANKS, Lexicon.build(WORDS))


def same(texts):
    starts, ids = ENCODER.encode(texts)
    for i, t in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == TRUTH.encode(t or "", add_special_tokens=False).ids, t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_text(texts):
    same(texts)


def test_hard_cases():
    same(["", None, "<|endoftext|> the gateway", "  \n\n x\t y ", "it's we're", "日本語と한국어", "a" * 50_000, "!?" * 9_000, "​zero"])


def test_automaton_shares_suffixes_and_numbers_words(tmp_path):
    words = {w.encode(): [i] for i, w in enumerate(["tap", "taps", "top", "tops", "x"])}
    lexicon = Lexicon.build(words)
    assert len(lexicon.final) == 5  # the root, one node behind t, one before p, one behind p, and one leaf for s and x
    lexicon.save(str(tmp_path / "l"))
    mapped = Lexicon.mapped(str(tmp_path / "l"))
    found = mapped.index([b"tap", b"tops", b"ta", b"", b"zzz", b"x", b"tapss"])
    assert [mapped.output(n).tolist() if n >= 0 else None for n in found] == [[0], [3], None, None, None, [4], None]
    assert Lexicon.build({}).index([b"a"]).tolist() == [-1]


def test_rows(spark):
    df = spark.createDataFrame([(1, "the gateway " * 20), (2, None), (3, ""), (4, "日本")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode_texts(df).collect()}
    assert got[2] == got[3] == [] and got[4] == TRUTH.encode("日本").ids and got[1] == TRUTH.encode("the gateway " * 20).ids
