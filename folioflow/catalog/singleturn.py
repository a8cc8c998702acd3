"""The single-turn path: admission, headers, replies and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.jsonx import is_shifted_labels, labels_from_json, parse_replies
from ..functions.text import CACHE_PREFIXES, SPACE, STIX_TYPES, breaks_guard, cache_prefix, date_from_header, fenced_prompt, injection_status, sanitize, stix_type, title_from_header, without_prefix
from ..operators.admission import BLOCKED, admission, is_blocked, missing_fields
from ..operators.summarize import rate
from ..sources.corpus import listed
from ..sources.tables import table
from .base import query, quoted

S = SPACE
_STRIP = lambda x: f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


@query("""SELECT pdf_id, CASE WHEN regexp_matches(source_path, '^https?://') THEN 'url_not_supported' WHEN bytes IS NULL THEN 'file_not_found' WHEN bytes < 20000 THEN 'file_too_small' END AS reason FROM source_docs""")
def admission_gate(spark, d):
    """FIL17: why a source isn't admitted; here files of less than 20,000 bytes are too small."""
    return table(spark, d, "source_docs").select("pdf_id", admission(F.col("source_path"), F.col("bytes"), 20000).alias("reason"))


@query(f"""SELECT doc_id, len(list_filter({quoted(BLOCKED)}, lambda p: contains(lower(coalesce(text, '')), p))) > 0 AS blocked FROM documents""")
def blocked_pages(spark, d):
    """FIL18: texts of pages that block robots."""
    return table(spark, d, "documents").select("doc_id", is_blocked(F.col("text")).alias("blocked"))


@query(f"""
WITH t AS (SELECT doc_id, nullif({_STRIP(f"regexp_extract(text, '(?im)^{S}*Title:{S}*(.+)$', 1)")}, '') AS title, nullif({_STRIP(f"regexp_extract(text, '(?im)^{S}*Published Time:{S}*(.+)$', 1)")}, '') AS raw FROM documents WHERE text IS NOT NULL)
SELECT doc_id, title, coalesce(nullif(regexp_extract(raw, '\\d{{4}}-\\d{{2}}-\\d{{2}}'), ''), raw) AS published FROM t WHERE title IS NOT NULL OR raw IS NOT NULL""")
def headers(spark, d):
    """STR13-STR14: titles and dates from header lines of the texts."""
    rows = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", title_from_header(F.col("text")).alias("title"), date_from_header(F.col("text")).alias("published"))
    return rows.where("title IS NOT NULL OR published IS NOT NULL")


_TYPES = sorted(set(STIX_TYPES.values()), key=lambda t: (-len(t), list(STIX_TYPES.values()).index(t)))
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in STIX_TYPES.items()) + "}"


@query(f"""
WITH k AS (SELECT DISTINCT unnest(keywords).phrase AS phrase, predicted_label FROM document_metrics WHERE keywords IS NOT NULL),
n AS (SELECT DISTINCT unnest([phrase, phrase || ' Tool', 'Report', ' threat actor ', phrase || ' malware kit']) AS name FROM k),
s AS (SELECT name, lower({_STRIP('name')}) AS key FROM n)
SELECT name, CASE WHEN key = '' THEN '' ELSE coalesce(({_MAP})[key], list_filter({quoted(_TYPES)}, lambda t: contains(replace(key, ' ', '-'), t))[1], replace(key, ' ', '-')) END AS stix_type FROM s""")
def stix_types(spark, d):
    """STR15, SO6: object types of names that hold one, and of names that don't."""
    k = table(spark, d, "document_metrics").where("keywords IS NOT NULL").select(F.explode("keywords").alias("k")).select("k.phrase").distinct()
    names = k.select(F.explode(F.array(F.col("phrase"), F.concat("phrase", F.lit(" Tool")), F.lit("Report"), F.lit(" threat actor "), F.concat("phrase", F.lit(" malware kit")))).alias("name")).distinct()
    return names.select("name", stix_type(F.col("name")).alias("stix_type"))


@query(f"""
WITH t AS (SELECT DISTINCT pdf_id, title, {_STRIP('title')} AS s FROM clean_out), p AS (SELECT pdf_id, title, s, {_STRIP("regexp_replace(s, '^[^:]*:', '')")} AS after FROM (SELECT pdf_id, title, 'Report: ' || s AS s FROM t UNION ALL SELECT pdf_id, title, s FROM t))
SELECT DISTINCT pdf_id, s AS raw, CASE WHEN s IS NULL THEN '' WHEN contains(s, ':') AND after <> '' THEN after ELSE s END AS name FROM p""")
def names_without_prefix(spark, d):
    """STR16: titles without what stands before their first colon."""
    from ..functions.text import strip

    t = table(spark, d, "clean_out").select("pdf_id", strip(F.col("title")).alias("s")).distinct()
    both = t.select("pdf_id", F.concat(F.lit("Report: "), F.col("s")).alias("raw")).union(t.select("pdf_id", F.col("s").alias("raw"))).distinct()
    return both.select("pdf_id", "raw", without_prefix(F.col("raw")).alias("name"))


def _reply(k):
    return F.concat(
        F.lit('```json\n{"Text is CII": "'), (k % 2).cast("string"), F.lit('", "Text is standards": "'), F.when(k % 3 == 0, "1").otherwise("0"), F.lit('", "Text is Technology": "'), F.when(k % 5 == 0, "1").otherwise("0"),
        F.lit('", "Involved Sector(s)": "'), F.when(k % 7 == 0, "Energy and Water, transport/ health").otherwise(""), F.lit('",}\n```'),
    )


@query("""
WITH k AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
l AS (SELECT event_id, list_concat(list_filter([CASE WHEN k % 2 = 1 THEN 'cii' END, CASE WHEN k % 3 = 0 THEN 'standards' END, CASE WHEN k % 5 = 0 THEN 'technology' END], lambda x: x IS NOT NULL),
  CASE WHEN k % 7 = 0 THEN ['energy', 'water', 'transport', 'health'] ELSE [] END) AS labels FROM k WHERE k IS NOT NULL)
SELECT event_id, array_to_string(labels, ';') AS labels FROM l""")
def json_labels(spark, d):
    """JS1-JS2, STR18: labels from fenced JSON with trailing commas, one reply made of every event."""
    rows = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).where("k IS NOT NULL")
    return rows.select("event_id", F.array_join(labels_from_json(_reply(F.col("k"))), ";").alias("labels"))


@query("""
WITH k AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k % 4 = 0 AS injection_detected, 'A summary of ' || event_type AS summary, CASE WHEN k % 3 = 0 THEN 'malware' ELSE 'threat-actor' END AS stix_type, 'Part ' || k AS name, CASE WHEN k % 4 < 2 AND k % 5 = 0 THEN 'cii' ELSE '' END AS labels
FROM k JOIN (SELECT event_id, event_type FROM events) USING (event_id) WHERE k IS NOT NULL""")
def parsed_replies(spark, d):
    """JS3-JS4, STR17, ML9: replies in the two layouts, one made of every event."""
    rows = table(spark, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")).where("k IS NOT NULL")
    k = F.col("k")
    kind = F.when(k % 3 == 0, "Malware").otherwise("the threat actor group")
    labels = F.concat(F.lit('{"reasoning": "", "Text is CII": "'), F.when(k % 5 == 0, "1").otherwise("0"), F.lit('"}'))
    status = F.when(k % 4 == 0, "INJECTION_STATUS: INJECTION_DETECTED\n").otherwise("INJECTION_STATUS: CLEAR\n")
    summary = F.concat(F.lit("A summary of "), F.col("event_type"))
    name = F.concat(F.lit("Title: Part "), k.cast("string"))
    new = F.concat(status, summary, F.lit('\n{"stix": "'), kind, F.lit('", "title": "'), name, F.lit('", "labels": '), labels, F.lit(",}"))
    old = F.concat(status, summary, F.lit("\n"), kind, F.lit("\n"), name, F.lit("\nA description\nno labels"))
    replies = rows.select("event_id", F.when(k % 4 < 2, new).otherwise(old).alias("reply"))
    return parse_replies(replies, "reply").select("event_id", "injection_detected", "summary", "stix_type", "name", F.array_join("labels", ";").alias("labels"))


@query("""
WITH s AS (SELECT DISTINCT pdf_id, run_id, summary, output_guard_triggered AS g FROM summarize_out WHERE summary IS NOT NULL)
SELECT pdf_id, run_id, summary, CASE WHEN g THEN true WHEN NOT g THEN false END AS detected FROM s""")
def injection_lines(spark, d):
    """STR17: the status line before every summary."""
    rows = table(spark, d, "summarize_out").where("summary IS NOT NULL").select("pdf_id", "run_id", "summary", "output_guard_triggered").distinct()
    line = F.when(F.col("output_guard_triggered"), " injection_detected ").when(~F.col("output_guard_triggered"), "injection_status: clear").otherwise("no status")
    return rows.select("pdf_id", "run_id", "summary", injection_status(line).alias("detected"))


_SANE = "replace(replace(t, '<<<BEGIN_SOURCE>>>', '<begin_source>'), '<<<END_SOURCE>>>', '<end_source>')"


@query(f"""
WITH s AS (SELECT DISTINCT pdf_id, run_id, summary AS t, generated_tokens AS n, tokens_per_second AS r FROM summarize_out WHERE summary IS NOT NULL)
SELECT pdf_id, run_id, t AS summary, n, r, contains(t, '<<<BEGIN_SOURCE>>>') OR contains(t, '<<<END_SOURCE>>>') OR len(regexp_extract_all(t, '[.!?]')) > 2 AS guard, {_SANE} AS sane,
  length('<<<BEGIN_SOURCE>>>' || chr(10) || {_SANE} || chr(10) || '<<<END_SOURCE>>>' || chr(10) || chr(10) || 'One sentence.' || chr(10))::INT AS prompt_chars, CASE WHEN r > 0 THEN round_even(n / (n / r), 2) ELSE 0.0 END AS rate FROM s""")
def guard_flags(spark, d):
    """FIL21, STR9-STR11, MT2: which summaries break the guard, and their fenced prompts."""
    rows = table(spark, d, "summarize_out").where("summary IS NOT NULL").select("pdf_id", "run_id", "summary", F.col("generated_tokens").alias("n"), F.col("tokens_per_second").alias("r")).distinct()
    t, n, r = F.col("summary"), F.col("n"), F.col("r")
    speed = F.when(r > 0, rate(n, n / r)).otherwise(0.0)
    return rows.select("pdf_id", "run_id", "summary", "n", "r", breaks_guard(t).alias("guard"), sanitize(t).alias("sane"), F.length(fenced_prompt(t, "One sentence.")).alias("prompt_chars"), speed.alias("rate"))


@query(f"""
SELECT doc_id, ({quoted(CACHE_PREFIXES)})[((doc_id % 13 + 13) % 13 + 1)::INT] || coalesce(left(text, 40), '') AS input FROM documents""")
def cache_prefixes(spark, d):
    """PRJ6: the head of every text behind its prefix character."""
    return table(spark, d, "documents").select("doc_id", F.concat(cache_prefix(F.col("doc_id")), F.coalesce(F.left("text", F.lit(40)), F.lit(""))).alias("input"))


@query(f"""
SELECT doc_id, ({quoted(CACHE_PREFIXES)})[((doc_id % 13 + 13) % 13 + 1)::INT] || coalesce(text, '') AS input FROM documents""")
def cache_inputs(spark, d):
    """PRJ6: every whole text behind its prefix character, as the model gets it."""
    return table(spark, d, "documents").select("doc_id", F.concat(cache_prefix(F.col("doc_id")), F.coalesce("text", F.lit(""))).alias("input"))


@query("""SELECT run_id, pdf_id, coalesce(predicted_label, '') = '' OR coalesce(pdf_name, '') = '' OR coalesce(summary, '') = '' AS missing FROM (SELECT DISTINCT run_id, pdf_id, predicted_label, pdf_name, summary FROM document_metrics)""")
def required_fields(spark, d):
    """FIL19: records that lack a type, a name or a description."""
    rows = table(spark, d, "document_metrics").select("run_id", "pdf_id", "predicted_label", "pdf_name", "summary").distinct()
    return rows.select("run_id", "pdf_id", missing_fields(F.col("predicted_label"), F.col("pdf_name"), F.col("summary")).alias("missing"))


@query("""SELECT run_id, count(*) AS total, count(*) FILTER (NOT rejected AND coalesce(summary, '') <> '') AS success, count(*) FILTER (NOT rejected AND coalesce(summary, '') = '') AS failed, count(*) FILTER (rejected) AS skipped
FROM (SELECT DISTINCT run_id, pdf_id, rejected, summary FROM document_metrics) GROUP BY run_id""")
def overall_counts(spark, d):
    """AG21, SNK12: successes, failures and skips of every run."""
    rows = table(spark, d, "document_metrics").select("run_id", "pdf_id", "rejected", "summary").distinct()
    empty = F.coalesce("summary", F.lit("")) == ""
    return rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("rejected") & ~empty).alias("success"), F.count_if(~F.col("rejected") & empty).alias("failed"), F.count_if("rejected").alias("skipped"))


@query(f"""
WITH l AS (SELECT DISTINCT url_decode(source_path) AS line FROM source_docs UNION ALL SELECT '# a comment' UNION ALL SELECT '   '),
p AS (SELECT {_STRIP("string_split(line, ',')[1]")} AS path FROM l WHERE {_STRIP('line')} <> '' AND NOT starts_with({_STRIP('line')}, '#'))
SELECT path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS name, NOT regexp_matches(path, '^https?://') AS is_local FROM p""")
def listed_sources(spark, d):
    """SRC10: the lines of a list of sources."""
    lines = table(spark, d, "source_docs").select(F.url_decode("source_path").alias("value")).distinct()
    extra = spark.createDataFrame([("# a comment",), ("   ",)], "value string")
    return listed(lines.union(extra))


@query("""
WITH k AS (SELECT event_id, '1 {"reasoning": "x", "Text is CII": "' || CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 || '"}' AS t FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL)
SELECT event_id, contains(t, '{') AND contains(lower(t), 'reasoning') AND contains(lower(t), 'text is cii') AS shifted FROM k""")
def shifted_labels(spark, d):
    """JS3: lines that hold the labels' JSON instead of a description."""
    rows = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).where("k IS NOT NULL")
    line = F.concat(F.lit('1 {"reasoning": "x", "Text is CII": "'), (F.col("k") % 2).cast("string"), F.lit('"}'))
    return rows.select("event_id", is_shifted_labels(line).alias("shifted"))
