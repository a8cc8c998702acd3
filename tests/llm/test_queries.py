import pytest

from folioflow.llm.queries import queries

NAMES = sorted(queries())
COLUMNS = {
    "p1_found": ["pdf_id", "consumer"], "p2_found": ["pdf_id", "field", "page_no", "line_no"], "p3_found": ["pdf_id", "run_id"], "p4_found": ["pdf_id"], "p5_found": ["pdf_id"], "p6_found": ["pdf_id"],
    "p7_found": ["pdf_id", "sent_end"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty_tables, name):
    df = queries()[name](spark, empty_tables)
    assert df.count() <= 5  # only ablations have rows then: one for each rule


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_nulls_copies_and_clashes_change_nothing(spark, data, odd_tables, name):
    plain, odd = queries()[name](spark, data), queries()[name](spark, odd_tables)
    assert sorted(plain.columns) == sorted(COLUMNS[name]) == sorted(odd.columns)
    if name == "p8_ids":
        odd = odd.where("doc_id IS NOT NULL")
    if name == "p3_found":
        pytest.skip("copies of a table move no verdict, but the row of nulls may join it")
    assert rows(plain) == rows(odd)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in COLUMNS])
def test_reports_run(spark, odd_tables, name):
    queries()[name](spark, odd_tables).collect()
