"""The queries of the training-data operators, by name, and SQL where it can express one."""

from __future__ import annotations

from . import boilerplate, contamination, reading_level, repetition, residue, sentences, splitting, structure, tokenizing, truncation


def queries() -> dict:
    found = {}
    for module in (splitting, boilerplate, truncation, residue, repetition, structure, sentences, tokenizing, contamination, reading_level):
        found |= {name: f for name, f in vars(module).items() if name[0] == "p" and name[1:2].isdigit()}
    return found


_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}。！？।؟۔]"


def oracle_sql() -> dict[str, str]:
    """Only the first problem can be put into SQL over whole tables; the others are tested against brute force."""
    return {
        "p1_found": f"""
WITH b AS (SELECT DISTINCT pdf_id, list_max(list_transform(string_split_regex(body, '{_SPACE}'), lambda x: length(x))) AS longest FROM clean_out WHERE body IS NOT NULL AND body <> '')
SELECT DISTINCT b.pdf_id, l.consumer FROM b JOIN chunk_limits l ON b.longest > l.max_chars"""
    }
