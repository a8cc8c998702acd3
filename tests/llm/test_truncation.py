from folioflow.llm.truncation import judged, prefixes

FULL = [f"Acme Labs will patch the {a} {b} before the {c}." for a in ("old", "new", "spare") for b in ("gateway", "pump", "switch") for c in ("audit", "merger", "hearing")]


def frames(spark, extra):
    rows = [(f"d{i}", "r", s, len(s) // 5) for i, s in enumerate(FULL)] + extra
    return spark.createDataFrame(rows, "pdf_id string, run_id string, summary string, generated_tokens int"), spark.createDataFrame([("r", 64)], "run_id string, summary_max_new_tokens int")


def test_cuts(spark):
    extra = [("a", "r", "Acme Labs will patch the old gat", 6), ("b", "r", "Acme Labs will patch the", 5), ("c", "r", "Acme Labs will patch the new pump before the merger", 10), ("d", "r", "Acme Labs will patch the old…", 6), ("e", "r", None, None), ("f", "r", "", 3), ("g", "r", "  ", 1), ("h", None, "Acme Labs will patch the spare (more)", None), ("a", "r", "Acme Labs will patch the old gat", 6), ("i", "r", "Acme Labs will patch the new switch before the audit.", 10), ("j", "r", "Acme Labs will patch the old", 9)]
    got = {r.pdf_id for r in judged(*frames(spark, extra)).where("cut").collect()}
    assert got == {"a", "b", "d", "h", "j"}


def test_prefixes_equal_brute_force(spark):
    values = ["a", "ab", "abc", "abd", "b", "bc", "zz", "zzz1", "zzz2", "日", "日本"]
    df = spark.createDataFrame([(v,) for v in values * 2], "summary string")
    truth = {v for v in values if any(w != v and w.startswith(v) for w in values)}
    assert {r.summary for r in prefixes(df).collect()} == truth


def test_empty(spark):
    s, r = frames(spark, [])
    assert judged(s.limit(0), r).count() == 0
