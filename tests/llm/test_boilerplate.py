import random
import re

from pyspark.sql import functions as F

from folioflow.llm import boilerplate as b


def run(spark, docs, broadcast_rows=None, monkeypatch=None):
    if broadcast_rows is not None:
        monkeypatch.setattr(b, "BROADCAST_ROWS", broadcast_rows)
    rows = spark.createDataFrame([(p, f, t, pages) for p, _, f, t, pages in docs], "pdf_id string, field string, title string, pages array<string>")
    hosts = spark.createDataFrame(sorted({(p, h) for p, h, *_ in docs}), "pdf_id string, host string")
    return {tuple(r) for r in b.furniture(b.scored(rows), hosts).distinct().collect()}


def article(i):
    return f"The council number{i} restored archive{i} in May. Researchers found flaw{i}."


def corpus():
    out = []
    for i in range(12):
        page = f"Alpha Beta Gamma\n\nHeadline {i} of the day\n\n{article(i)}\n\nRelated\n- Other story {i}\n- Another tale {i}\n\nZeta House is run by Omega People in Town."
        out.append((f"d{i}", "h1", "pages", f"Headline {i} of the day", [page]))
    out.append(("e1", "h2", "pages", None, ["Alpha Beta Gamma\n" + article(99)]))
    out.append(("d0", "h1", "body", None, ["Alpha Beta Gamma\n" + article(0)]))
    return out


def test_hosts_vote(spark):
    got = run(spark, corpus())
    mine = {(f, p, n) for d, f, p, n in got if d == "d3"}
    assert mine == {("pages", 1, 1), ("pages", 1, 7), ("pages", 1, 8), ("pages", 1, 9), ("pages", 1, 11)}
    assert ("d0", "body", 0, 1) in got and ("d0", "body", 0, 2) not in got
    assert not any(d == "e1" for d, *_ in got)  # the path won on another host only


def test_many_winners_are_joined_by_salt(spark, monkeypatch):
    assert run(spark, corpus(), 0, monkeypatch) == run(spark, corpus(), 10**6, monkeypatch)


def test_salted_winners_are_not_sent_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(b, "BROADCAST_ROWS", 0)
    rows = spark.createDataFrame([(p, f, t, pages) for p, _, f, t, pages in corpus()], "pdf_id string, field string, title string, pages array<string>")
    hosts = spark.createDataFrame(sorted({(p, h) for p, h, *_ in corpus()}), "pdf_id string, host string")
    found = b.furniture(b.scored(rows), hosts)
    assert found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join [" in line and "salt" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_promotions_wrapped_anywhere():
    lines = b.Lines()
    lines.add_page(1, "An article line here.\n\nDownload the free Acme buyer guide to compare vendors, see sample\ncontracts and learn which questions to ask before you\nsign.")
    assert [bool(f & b.FURNITURE) for f in lines.flags] == [False, True, True, True]


def test_tables_and_titles_stay(spark):
    docs = [(f"d{i}", "h", "pages", "Same title", [f"Same title\n\nId | Name | State | Score\nA-{i} | pump{i} | open | 4.{i}\n\n{article(i)}"]) for i in range(9)]
    assert run(spark, docs) == set()


def test_odd_inputs(spark):
    docs = [("a", None, "pages", None, None), ("b", "h", "pages", None, []), ("c", "h", "pages", None, [None, "", " \n "]), ("d", "h", "body", None, ["x" * 100_000])]
    assert run(spark, docs) == set()
    assert b.scored(spark.createDataFrame([], "pdf_id string, field string, title string, pages array<string>")).agg(F.count("*")).first()[0] == 0


def test_scored_containers_need_fewer_ballots_and_digits_are_folded(spark):
    docs = []
    for i in range(400):
        # at the head of 15 pages of 400 (below 3 % and two deviations), in the text of as many, and with other digits each time
        mark = f"Gamma Delta Omega\n\nIssue {i} of Delta\n\n" if i < 15 else ""
        inner = "Results so far\n" if 20 <= i < 35 else ""
        filler = "\n\n".join(f"Opening{k}x{i} words follow. {article(i)}" for k in range(4))
        docs.append((f"d{i}", "h", "pages", None, [f"{mark}{filler}\n\n{inner}{article(i)}\n\n{filler}"]))
    assert run(spark, docs) == {(f"d{i}", "pages", 1, n) for i in range(15) for n in (1, 3)}


def test_vote_of_all_hosts_counts_single_pages_and_unknown_hosts(spark):
    # one page a host, and pages of no known host: no path is seen twice on any of them
    docs = [(f"s{i}", f"h{i}", "pages", None, [f"Alpha Beta Gamma\n\n{article(i)}"]) for i in range(12)]
    assert run(spark, docs) == {(f"s{i}", "pages", 1, 1) for i in range(12)}
    unknown = [(p, None, *rest) for p, _, *rest in docs[4:]]
    assert run(spark, docs[:4] + unknown) == {(f"s{i}", "pages", 1, 1) for i in range(12)}


def test_long_sentences_have_ballots(spark):
    long = "Notice of " + "many words " * 120 + "ends here."
    docs = [(f"l{i}", "h", "pages", None, [f"{article(i)}\n\n{long}"]) for i in range(8)]
    assert run(spark, docs) == {(f"l{i}", "pages", 1, 3) for i in range(8)}


def cleaned(i, extra=()):
    """A page and the body that cleaning left of it."""
    own = f"{article(i)}\n\nPart {chr(97 + i) * 4} begins\n\n{article(i + 500)}"
    return [(f"c{i}", f"h{i % 4}", "pages", None, ["\n\n".join([own, *extra])]), (f"c{i}", f"h{i % 4}", "body", None, [own])]


def test_what_cleaning_dropped_votes_whatever_its_wording(spark):
    # one line a document, with other numbers and names each time, on four hosts: masked it is one path
    docs = [d for i in range(24) for d in cleaned(i, [f"Come to the Grand{i} Hall in June for talk {i} of the Omega{i} Series."])]
    got = run(spark, docs)
    assert got == {(f"c{i}", "pages", 1, 7) for i in range(24)}


def test_dropped_headings_of_articles_stay(spark):
    # cleaning dropped the same short heading from every body; running text follows it
    docs = []
    for i in range(24):
        text = f"{article(i)}\n\nWhat comes next\n\n{article(i + 500)} It went on for {i} days."
        docs += [(f"c{i}", f"h{i % 4}", "pages", None, [text]), (f"c{i}", f"h{i % 4}", "body", None, [text.replace("What comes next\n\n", "")])]
    got = {(d, n) for d, _, _, n in run(spark, docs)}
    assert got <= {(f"c{i}", 3) for i in range(24)} and not any(n in (1, 5) for _, n in got)


def test_a_hot_document_counts_once(spark):
    docs = cleaned(1, ["Alpha Beta Gamma"]) * 30 + [d for i in range(2, 7) for d in cleaned(i)]
    assert run(spark, docs) == set()


def test_lines_and_sentences_are_normalised_once(monkeypatch):
    calls, plain = [], b._plain
    monkeypatch.setattr(b, "_plain", lambda text: calls.append(text) or plain(text))
    texts = ["Zarvex 77 counted  pumps at Omega Dock.", "Quillon 78 counted boats at Delta Pier."]
    for number in (1, 2):
        b.Lines().add_page(number, "\n".join(texts))
    assert sorted(calls) == sorted(texts * 2)  # as a line and as a sentence, not again for each form or page


def test_quick_patterns_find_what_the_plain_ones_do():
    names = re.compile(r"(?<=\S )[^\W\d_a-z][\w'’&.-]*(?: [^\W\d_a-z][\w'’&.-]*)*")
    stop = re.compile(r"[.!?。！？।؟][\"'”’»)\]」]*\s*$")
    inner = re.compile(r"[.!?]\s+\S|[。！？।؟]")
    separator = re.compile(r"\s[-|>›]\s|:\s")
    sentences = re.compile(r"(?<=[.!?])\s+(?=[^\Wa-z\d_]|[\"“«„(¿¡])|(?<=[。！？।؟])")
    at = lambda m: m and m.start()
    draw = random.Random(2)
    for _ in range(20_000):
        text = "".join(draw.choices("abAZéЖ中09٣_  \t\u00a0\u2003\u200b\x1c..!?。！।؟::|->›·/&'’\"”»)]」“«(¿", k=draw.randint(1, 60)))
        plain, line = " ".join(text.split()), text.strip()
        assert b._plain(text) == plain
        assert b._NAMES.sub(" A", plain) == names.sub("A", plain)
        assert b._DIGITS.sub("0", plain).casefold() == re.sub(r"\d+", "0", plain.casefold())
        assert [m.end() for m in b._SENTENCES.finditer(text)] == [m.end() for m in sentences.finditer(text)]
        assert line.rstrip(b._CLOSING).endswith(b._STOPS) == bool(stop.search(line))
        for begin in (0, 3):
            assert at(b._INNER.search(line, begin)) == at(inner.search(line, begin))
        assert at(b._SEPARATOR.search(line)) == at(separator.search(line)) and at(b._SEPARATOR.search(line, 2, 48)) == at(separator.search(line, 2, 48))
    every = [chr(i) for i in range(0x110000)]
    assert [c for c in every if c.isspace() and c.isprintable()] == [" "]
    assert not [c for c in every if any(x.isdecimal() for x in c.casefold()) != c.isdecimal()]
