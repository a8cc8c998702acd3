import random

from folioflow.llm.contamination import Items, Shard, common_length, find, item_blocks, leaks, p9_clean, words_of

random.seed(7)
VOCABULARY = [f"w{i:03d}" for i in range(400)]
ITEMS = [(k, " ".join(random.choices(VOCABULARY, k=random.randint(18, 60)))) for k in range(12)]


def filler(n):
    return " ".join(random.choices(VOCABULARY, k=n))


def test_words():
    assert words_of("Re-\nsolver *The* <b>Plan</b> &amp; ＷＯＲＤ") == ["resolver", "the", "plan", "word"]
    assert words_of("日本語 ok") == ["日", "本", "語", "ok"]


def test_longest_common_subsequence():
    for _ in range(200):
        a, b = (random.choices(range(5), k=random.randint(0, 12)) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
        assert common_length(a, b) == table[-1][-1]


def test_suffix_array_finds_every_match():
    items = Items(ITEMS)
    texts = [filler(80), ITEMS[3][1], None, filler(30) + " " + ITEMS[3][1]]
    test, text = Shard(texts, items.vocabulary).matches(items)
    shard = Shard(texts, items.vocabulary)
    truth = set()
    for i in range(len(items.owner)):
        gram = items.suffix[i, :3]
        if gram[2]:
            truth |= {(i, j) for j in range(len(shard.words) - 3) if (shard.words[j : j + 3] == gram).all()}
    assert set(zip(test.tolist(), text.tolist())) == truth


def edited(words, every):
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            out.append({0: "replaced", 1: None, 2: w + " added"}[random.randrange(3)])
        else:
            out.append(w)
    return " ".join(w for w in out if w)


def test_edited_parts_are_found_and_short_ones_not():
    items = Items(ITEMS)
    for k, text in ITEMS:
        words = text.split()
        n = len(words)
        docs = [filler(40) + "\n" + edited(words, 5).upper() + ". " + filler(40), filler(20) + " " + " ".join(words[: int(n * 0.6)]) + " " + filler(20), filler(20) + " " + " ".join(words[: int(n * 0.3)]) + " " + filler(30), filler(90)]
        got = {(d, item) for d, item, _, _ in find(Shard(docs, items.vocabulary), items)}
        assert {(0, k), (1, k)} <= got and (2, k) not in got and (3, k) not in got


def test_rows(spark):
    documents = spark.createDataFrame([(1, ITEMS[0][1]), (1, ITEMS[0][1]), (2, None), (3, ""), (4, "​".join(ITEMS[1][1].split(" ")[:2]) + " " + ITEMS[1][1])], "doc_id long, text string")
    items = spark.createDataFrame([(k, t) for k, t in ITEMS] + [(99, None), (98, ""), (97, "two words")], "item_id long, item_text string")
    assert {(r.doc_id, r.item_id) for r in leaks(documents, items).collect()} == {(1, 0), (4, 1)}
    assert item_blocks(items.limit(0)) == [[]]
    assert leaks(documents, items.limit(0)).count() == 0


def test_longest_match_is_one_verbatim_run():
    words = [f"v{i}" for i in range(20)]
    items = Items([(1, " ".join(words)), (2, "v3 v4")])
    copy = [*words[:9], "other", *words[10:]]
    assert find(Shard([filler(10) + " " + " ".join(copy), None, " ".join(words)], items.vocabulary), items)[0][1:] == (1, 19, 10)
    shard = Shard([filler(30) + " " + " ".join(copy), " ".join(words)], items.vocabulary)
    test, text, length = shard.longest(items)
    for i, j, n in zip(test.tolist(), text.tolist(), length.tolist()):
        mine = items.flat[i : items.start[items.owner[i] + 1]].tolist()
        assert n == next((k for k, (a, b) in enumerate(zip(mine, shard.words[j:].tolist())) if a != b), len(mine))


def test_clean_corpus_leaves_affected_documents_out(spark, tmp_path):
    documents = spark.createDataFrame([(1, filler(5) + " " + ITEMS[0][1]), (2, "nothing of it"), (3, None), (None, "no id")], "doc_id long, text string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, item_text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    assert {r.doc_id for r in p9_clean(spark, str(tmp_path)).collect()} == {2, 3, None}


def test_no_verbatim_match_is_needed():
    long = [f"v{i}" for i in range(88)]
    short = [f"u{i}" for i in range(24)]
    items = Items([(1, " ".join(short)), (2, " ".join(long))])
    third = [f"other{i}" if i % 3 == 2 else w for i, w in enumerate(short)]
    twos = [w for i, w in enumerate(long) if i % 4 < 2]
    docs = [filler(30) + " " + " ".join(third) + " " + filler(30), filler(30) + " " + " ".join(twos) + " " + filler(30)]
    assert find(Shard(docs, items.vocabulary), items) == [(0, 1, 16, 2), (1, 2, 44, 2)]
    half = Items([(1, " ".join(long[:20]))])
    assert find(Shard([" ".join([long[0], "other", *long[2:11]])], half.vocabulary), half) == [(0, 1, 10, 9)]


def test_same_pairs_as_brute_force():
    letters = [f"w{i}" for i in range(30)]
    for _ in range(15):
        items = Items([(k, " ".join(random.choices(letters, k=random.randint(6, 40)))) for k in range(6)])
        docs = [" ".join(random.choices([*letters, *(["x"] * 20)], k=random.randint(0, 300))) for _ in range(8)]
        shard = Shard(docs, items.vocabulary)
        truth = set()
        for d in range(len(docs)):
            words = shard.words[shard.doc_start[d] : shard.doc_start[d + 1]].tolist()
            for k, item in items.words.items():
                span = len(item) + 2 * max(4, len(item) // 4)
                held = max((common_length(item, words[i : i + span]) for i in range(len(words))), default=0)
                if 2 * held >= len(item):
                    truth.add((d, k, held))
        assert {x[:3] for x in find(shard, items)} == truth


def test_edits_at_every_second_to_fifth_word():
    for every in (2, 3, 4, 5):
        items = Items(ITEMS)
        docs = [f"{filler(30)} {edited(text.split(), every)} {filler(30)}" for _, text in ITEMS]
        shard = Shard(docs, items.vocabulary)
        truth = set()
        for d in range(len(docs)):
            words = shard.words[shard.doc_start[d] : shard.doc_start[d + 1]].tolist()
            for k, item in items.words.items():
                span = len(item) + 2 * max(4, len(item) // 4)
                if 2 * max(common_length(item, words[i : i + span]) for i in range(len(words))) >= len(item):
                    truth.add((d, k))
        assert {x[:2] for x in find(shard, items)} == truth


def test_several_blocks_of_items(spark, monkeypatch):
    from folioflow.llm import contamination

    documents = spark.createDataFrame([(k, f"{filler(20)} {t}") for k, t in ITEMS] + [(99, None), (98, "")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, item_text string")
    one = {(r.doc_id, r.item_id) for r in leaks(documents, items).collect()}
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 40)
    assert len(contamination.item_parts(items, 500)) > 2
    parts = contamination.item_parts
    monkeypatch.setattr(contamination, "item_parts", lambda x: parts(x, 500))
    assert {(r.doc_id, r.item_id) for r in leaks(documents, items).collect()} == one
    assert {r.doc_id for r in contamination.unaffected(documents, items).collect()} == {98, 99}
    assert len(item_blocks(items)) > 2 and {(r.doc_id, r.item_id) for r in leaks(documents, items).collect()} == one
