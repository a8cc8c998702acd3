"""Artifacts, metrics, reports and comparisons of runs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import SPACE, basename, safe_filename
from ..operators.admission import label_set
from ..plans import artifacts, compare, metrics, registry
from ..plans import report as reports
from ..sources.tables import patch, table, upsert
from .base import query

KEY = ["pdf_id", "run_id"]
_ORDER = "status DESC NULLS LAST, device DESC NULLS LAST, dtype DESC NULLS LAST, batch_size DESC NULLS LAST, wall_time_sec DESC NULLS LAST, compute_time_sec DESC NULLS LAST, transfer_time_sec DESC NULLS LAST, tokens_in DESC NULLS LAST, tokens_out DESC NULLS LAST, peak_ram_mb DESC NULLS LAST, peak_vram_mb DESC NULLS LAST"
_STAGE_ROWS = f"""SELECT * EXCLUDE (rn, created_at) FROM (SELECT *, row_number() OVER (PARTITION BY pdf_id, run_id, stage ORDER BY created_at DESC NULLS LAST, {_ORDER}) AS rn FROM stage_metrics) WHERE rn = 1"""


def _last(name: str, order: str, where: str = "true") -> str:
    return f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pdf_id, run_id ORDER BY created_at DESC NULLS LAST, {order}) AS rn FROM {name} WHERE {where}) WHERE rn = 1)"


@query(_STAGE_ROWS)
def stage_rows(spark, d):
    """PRJ1, JN1: the last measurement of every stage of every document and run."""
    return metrics.stage_rows(table(spark, d, "stage_metrics"))


@query(f"""SELECT stage, count(*) FILTER (status NOT IN ('error', 'oom')) AS computed, count(*) FILTER (status IN ('error', 'oom')) AS errors FROM ({_STAGE_ROWS}) GROUP BY ROLLUP (stage)""")
def stage_counters(spark, d):
    """AG12: successes and failures of each stage, and of all."""
    return artifacts.counters(stage_rows(spark, d))


_TIMES = f"""SELECT pdf_id, run_id, coalesce(max(wall_time_sec) FILTER (stage = 'extract'), 0.0) AS extraction_time_sec, coalesce(max(wall_time_sec) FILTER (stage = 'keywords'), 0.0) AS keyword_time_sec,
  coalesce(max(wall_time_sec) FILTER (stage = 'classify'), 0.0) AS classify_time_sec, coalesce(max(wall_time_sec) FILTER (stage = 'summarize'), 0.0) AS summarize_time_sec,
  round_even(coalesce(sum(wall_time_sec) FILTER (stage IN ('keywords', 'classify', 'summarize')), 0.0), 4) AS inference_time_sec, round_even(coalesce(sum(wall_time_sec), 0.0), 4) AS total_time_sec,
  max(peak_ram_mb) AS peak_ram_mb, max(peak_vram_mb) AS peak_vram_mb FROM ({_STAGE_ROWS}) GROUP BY pdf_id, run_id"""


@query(_TIMES)
def stage_times(spark, d):
    """JN2, AG14-AG15: each document's stage times side by side, with sums and peaks."""
    return metrics.stage_times(stage_rows(spark, d))


_TOKENS = lambda x: f"list_filter(string_split_regex({x}, '{SPACE}+'), lambda t: t <> '')"
_DOCUMENTS = f"""
WITH ex AS {_last("extract_out", "status DESC, pages_total DESC NULLS LAST, pages_read DESC NULLS LAST", "status = 'ok'")},
cl AS {_last("clean_out", "title DESC NULLS LAST, body DESC NULLS LAST, block_count DESC NULLS LAST")},
va AS {_last("validate_out", "status DESC NULLS LAST, reason DESC NULLS LAST")},
su AS {_last("summarize_out", "summary DESC NULLS LAST, output_guard_triggered DESC NULLS LAST, prompt_tokens DESC NULLS LAST, generated_tokens DESC NULLS LAST, tokens_per_second DESC NULLS LAST")},
n AS (SELECT DISTINCT pdf_id, regexp_extract(source_path, '([^/]*)$', 1) AS pdf_name FROM source_docs),
j AS (SELECT t.*, ex.pages_read, coalesce(list_sum(list_transform(ex.pages, lambda g: length(coalesce(g, '')))), CASE WHEN ex.pages IS NOT NULL THEN 0 END)::INT AS raw_chars,
  coalesce(list_sum(list_transform(ex.pages, lambda g: len({_TOKENS("coalesce(g, '')")}))), CASE WHEN ex.pages IS NOT NULL THEN 0 END)::INT AS raw_words,
  CASE WHEN cl.pdf_id IS NOT NULL THEN length(coalesce(cl.body, '')) END::INT AS clean_chars, va.status = 'rejected' AS rejected, va.reason AS reject_reason,
  su.prompt_tokens, su.generated_tokens, su.tokens_per_second AS tokens_per_sec, su.summary, n.pdf_name
  FROM ({_TIMES}) t LEFT JOIN ex USING (pdf_id, run_id) LEFT JOIN cl USING (pdf_id, run_id) LEFT JOIN va USING (pdf_id, run_id) LEFT JOIN su USING (pdf_id, run_id) LEFT JOIN n USING (pdf_id))
SELECT *, CASE WHEN raw_chars > 0 THEN round_even(100 * (1 - clean_chars::DOUBLE / raw_chars), 2) END AS reduction_pct FROM j"""


@query(_DOCUMENTS)
def document_rows(spark, d):
    """PRJ2, FIL16, AG17, JN5-JN6: one row of metrics for every document and run."""
    t = lambda name: table(spark, d, name)
    return metrics.document_rows(t("source_docs"), t("extract_out"), t("clean_out"), t("validate_out"), t("summarize_out"), t("stage_metrics"))


@query(f"""SELECT run_id, count(*) AS documents, round_even(sum(total_time_sec), 2) AS total_time_sec, round_even(sum(inference_time_sec), 2) AS inference_time_sec, count(*) FILTER (rejected) AS rejected
FROM (SELECT t.*, va.status = 'rejected' AS rejected FROM ({_TIMES}) t LEFT JOIN {_last("validate_out", "status DESC NULLS LAST, reason DESC NULLS LAST")} va USING (pdf_id, run_id)) GROUP BY run_id""")
def run_totals(spark, d):
    """AG16: documents and times of every run."""
    judged = artifacts.latest(table(spark, d, "validate_out"), KEY).select(*KEY, (F.col("status") == "rejected").alias("rejected"))
    return metrics.run_totals(stage_times(spark, d).join(judged, KEY, "left"))


@query("""SELECT pdf_id, stage, round_even(median(wall_time_sec)::DECIMAL(20, 6), 4)::DOUBLE AS wall_time_sec, round_even(median(peak_ram_mb)::DECIMAL(20, 6), 1)::DOUBLE AS peak_ram_mb, round_even(median(peak_vram_mb)::DECIMAL(20, 6), 1)::DOUBLE AS peak_vram_mb
FROM (SELECT DISTINCT * FROM stage_metrics) GROUP BY pdf_id, stage""")
def timing_median(spark, d):
    """AG13: medians over every document's repeated runs; null measurements don't count."""
    return artifacts.median_timings(table(spark, d, "stage_metrics").distinct(), ["pdf_id", "stage"])


_METRICS = "SELECT DISTINCT pdf_id, run_id, rejected, predicted_label, list_transform(keywords, lambda k: k.phrase) AS phrases FROM document_metrics"


def _compared(spark, d) -> DataFrame:
    return table(spark, d, "document_metrics").select(*KEY, "rejected", "predicted_label", F.transform("keywords", lambda k: k["phrase"]).alias("phrases")).distinct()


@query(f"""
WITH m AS ({_METRICS}),
p AS (SELECT pdf_id, run_id AS left_run, lead(run_id) OVER w AS right_run, rejected AS r1, lead(rejected) OVER w AS r2, predicted_label AS p1, lead(predicted_label) OVER w AS p2, coalesce(phrases, []) AS k1, coalesce(lead(phrases) OVER w, []) AS k2 FROM m WINDOW w AS (PARTITION BY pdf_id ORDER BY run_id))
SELECT pdf_id, left_run, right_run, r1 IS DISTINCT FROM r2 AS status_changed, p1 IS DISTINCT FROM p2 AS label_changed,
  CASE WHEN len(k1) > 0 OR len(k2) > 0 THEN round_even(len(list_intersect(k1, k2))::DOUBLE / len(list_distinct(list_concat(k1, k2))), 3) END AS keyphrase_jaccard FROM p WHERE right_run IS NOT NULL""")
def run_compare(spark, d):
    """JN3, ST1-ST2, WN8, OR8: every document's run beside its next one."""
    return compare.adjacent(_compared(spark, d))


@query("""SELECT pdf_id FROM (SELECT pdf_id, count(DISTINCT run_id) AS n FROM document_metrics GROUP BY pdf_id) WHERE n > 1""")
def common_documents(spark, d):
    """ST2: documents of more than one run."""
    return table(spark, d, "document_metrics").groupBy("pdf_id").agg(F.count_distinct("run_id").alias("n")).where("n > 1").select("pdf_id")


@query("""SELECT pdf_id, run_id FROM validate_out WHERE status = 'accepted' INTERSECT SELECT pdf_id, run_id FROM summarize_out""")
def accepted_and_summarized(spark, d):
    """ST2: records that were accepted and have a summary, as sets."""
    return table(spark, d, "validate_out").where("status = 'accepted'").select(*KEY).intersect(table(spark, d, "summarize_out").select(*KEY))


@query("""SELECT pdf_id, run_id FROM validate_out WHERE status = 'accepted' EXCEPT SELECT pdf_id, run_id FROM summarize_out""")
def accepted_without_summary(spark, d):
    """ST3: accepted records that no summary follows."""
    return table(spark, d, "validate_out").where("status = 'accepted'").select(*KEY).subtract(table(spark, d, "summarize_out").select(*KEY))


@query("""SELECT DISTINCT pdf_id, stage FROM stage_metrics UNION SELECT pdf_id, 'validate' FROM validate_out""")
def timing_keys(spark, d):
    """ST5, AG18: the keys of two snapshots, united."""
    return table(spark, d, "stage_metrics").select("pdf_id", "stage").union(table(spark, d, "validate_out").select("pdf_id", F.lit("validate").alias("stage"))).distinct()


@query("""
WITH RECURSIVE later(stage, affected) AS (
  SELECT * FROM (VALUES ('extract', 'clean'), ('clean', 'validate'), ('clean', 'context'), ('validate', 'keywords'), ('keywords', 'classify'), ('keywords', 'context'), ('context', 'summarize')) AS v(stage, affected)
  UNION SELECT l.stage, v.affected FROM later l JOIN (VALUES ('clean', 'validate'), ('clean', 'context'), ('validate', 'keywords'), ('keywords', 'classify'), ('keywords', 'context'), ('context', 'summarize')) AS v(stage, affected) ON v.stage = l.affected)
SELECT stage, affected FROM later UNION SELECT unnest(['extract', 'clean', 'validate', 'keywords', 'classify', 'context', 'summarize']) AS stage, stage AS affected""")
def stage_closure(spark, d):
    """ST4, OR1-OR2: what each stage affects."""
    return registry.closure(spark)


_PREFIX = [s.name for s in registry.select(through="validate")[0]]


@query(f"SELECT stage, count(*) AS rows FROM ({_STAGE_ROWS}) WHERE stage IN ({', '.join(repr(n) for n in _PREFIX)}) GROUP BY stage")
def stage_prefix(spark, d):
    """WN9: the stages up to a given one."""
    return stage_rows(spark, d).where(F.col("stage").isin(_PREFIX)).groupBy("stage").agg(F.count(F.lit(1)).alias("rows"))


#: the stages as the check knows them: name, what it needs, its settings in canonical JSON, the files whose source decides
_STAGES = (
    ("extract", (), '{"MAX_PAGES": 0}', ("sources/corpus",)),
    ("clean", ("extract",), "{}", ("operators/clean", "functions/text")),
    ("validate", ("clean",), '{"MIN_CHARS": 0, "MIN_WORDS": 120}', ("operators/validate", "functions/text")),
    ("keywords", ("validate",), '{"BACKEND": "hashing", "DEVICE": "cpu", "DTYPE": "fp32"}', ("operators/keywords", "functions/text", "models/backends")),
    ("classify", ("keywords",), '{"BACKEND": "hashing", "DEVICE": "cpu", "DTYPE": "fp32", "HYPOTHESIS_TEMPLATE": "This example is {}.", "TAXONOMY": "both", "ZEROSHOT_MAX_CHUNKS": 3}', ("operators/classify", "operators/windows", "models/backends")),
    ("context", ("keywords", "clean"), '{"REDUCED_CONTEXT_CHARS": 2000}', ("operators/context", "functions/text")),
    ("summarize", ("context",), '{"DEVICE": "cpu", "INJECTION_GUARD": false, "REDUCED_CONTEXT_CHARS": 2000, "SUMMARY_MAX_NEW_TOKENS": 64}', ("operators/summarize", "models/backends")),
)


def _fingerprint_sql() -> str:
    """The fingerprints by DuckDB alone: it reads the files, and hashes what the stages are known to depend on."""
    root, step, unions = Path(__file__).resolve().parents[1], "b0", []
    ctes = ["b0 AS (SELECT DISTINCT pdf_id, sha256 AS s FROM source_docs)"]
    for i, (name, needs, settings, files) in enumerate(_STAGES, 1):
        upstream = f"list_sort([{', '.join('id_' + n for n in needs)}])" if needs else "[]"
        sources = " || chr(0) || ".join(f"(SELECT content FROM read_text('{root}/{f}.py'))" for f in files)
        ctes.append(f"c{i} AS (SELECT sha256('{settings}') AS cfg_{name}, sha256('1' || chr(0) || {sources}) AS code_{name})")
        ctes.append(f"a{i} AS (SELECT *, sha256(array_to_string(list_concat([s], {upstream}), '|')) AS in_{name} FROM {step} CROSS JOIN c{i})")
        ctes.append(f"b{i} AS (SELECT *, sha256(in_{name} || '|' || cfg_{name} || '|' || code_{name}) AS id_{name} FROM a{i})")
        step = f"b{i}"
        unions.append(f"SELECT pdf_id, '{name}' AS stage, in_{name} AS input_fingerprint, cfg_{name} AS config_fingerprint, code_{name} AS code_fingerprint, id_{name} AS identity FROM {{last}}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(u.format(last=step) for u in unions)


@query(_fingerprint_sql())
def stage_fingerprints(spark, d):
    """HS1-HS4, SO5, JN7: three fingerprints and the identity of every stage of every source."""
    return artifacts.fingerprints(table(spark, d, "source_docs").select("pdf_id", "sha256").distinct())


@query(f"""
WITH m AS (SELECT pdf_id, stage, round_even(median(wall_time_sec)::DECIMAL(20, 6), 4)::DOUBLE AS wall_time_sec FROM (SELECT DISTINCT * FROM stage_metrics) GROUP BY pdf_id, stage HAVING count(DISTINCT run_id) > 1)
SELECT r.* REPLACE (CASE WHEN m.pdf_id IS NOT NULL THEN m.wall_time_sec ELSE r.wall_time_sec END AS wall_time_sec) FROM ({_STAGE_ROWS}) r LEFT JOIN m USING (pdf_id, stage)""")
def timing_patch(spark, d):
    """SNK4: stage rows whose time is replaced by the median where a stage was measured in several runs; the other fields and rows stay."""
    measured = table(spark, d, "stage_metrics").distinct()
    several = measured.groupBy("pdf_id", "stage").agg(F.count_distinct("run_id").alias("runs")).where("runs > 1")
    medians = artifacts.median_timings(measured, ["pdf_id", "stage"]).join(several, ["pdf_id", "stage"], "left_semi")
    return patch(stage_rows(spark, d), medians, ["pdf_id", "stage"], ["wall_time_sec"])


@query(f"""
WITH w AS (SELECT DISTINCT s.pdf_id, n.stage FROM source_docs s CROSS JOIN (SELECT unnest([{', '.join(repr(s.name) for s in registry.ordered())}]) AS stage) n),
x AS (SELECT DISTINCT pdf_id, stage FROM ({_STAGE_ROWS}) WHERE status NOT IN ('error', 'oom'))
SELECT w.stage, count(*) FILTER (x.pdf_id IS NULL) AS to_compute, count(*) FILTER (x.pdf_id IS NOT NULL) AS cached FROM w LEFT JOIN x USING (pdf_id, stage) GROUP BY w.stage""")
def cache_misses(spark, d):
    """FIL20, JN4: what of the stages of all sources could be reused; failures can't."""
    prints = stage_fingerprints(spark, d).drop("identity")
    kept = stage_rows(spark, d).select("pdf_id", "stage", "status").join(prints, ["pdf_id", "stage"])
    todo, reuse = artifacts.split_cached(prints, kept)
    tally = lambda df, to, hit: df.select("stage", F.lit(to).alias("t"), F.lit(hit).alias("c"))
    return tally(todo, 1, 0).unionByName(tally(reuse, 0, 1)).groupBy("stage").agg(F.sum("t").alias("to_compute"), F.sum("c").alias("cached"))


@query(f"""
WITH v AS (SELECT pdf_id, arg_max(status, (created_at, status)) AS status FROM validate_out GROUP BY pdf_id),
o AS (SELECT DISTINCT pdf_id, source_path, page_count, status FROM source_docs)
SELECT o.pdf_id, o.source_path, o.page_count, coalesce(v.status, o.status) AS status FROM o LEFT JOIN v USING (pdf_id)""")
def index_upsert(spark, d):
    """SNK3: the index after the last verdicts were put into it."""
    old = table(spark, d, "source_docs").select("pdf_id", "source_path", "page_count", "status").distinct()
    verdicts = table(spark, d, "validate_out").groupBy("pdf_id").agg(F.max(F.struct("created_at", "status"))["status"].alias("new"))
    new = old.join(verdicts, "pdf_id").select("pdf_id", "source_path", "page_count", F.col("new").alias("status"))
    return upsert(old, new, ["pdf_id"])


@query(f"""
WITH v AS (SELECT DISTINCT pdf_id, run_id FROM {_last("validate_out", "status DESC NULLS LAST, reason DESC NULLS LAST")} WHERE status = 'rejected')
SELECT stage, count(*) AS rows, count(v.pdf_id) AS of_rejected FROM ({_STAGE_ROWS}) r LEFT JOIN v USING (pdf_id, run_id) GROUP BY stage""")
def status_gate(spark, d):
    """FIL2: rows of each stage, and those of records that were rejected."""
    out = artifacts.latest(table(spark, d, "validate_out"), KEY).where("status = 'rejected'").select(*KEY).withColumn("gone", F.lit(True))
    return stage_rows(spark, d).join(out, KEY, "left").groupBy("stage").agg(F.count(F.lit(1)).alias("rows"), F.count("gone").alias("of_rejected"))


_REPORT = f"""
WITH ex AS {_last("extract_out", "status DESC, pages_total DESC NULLS LAST, pages_read DESC NULLS LAST", "status = 'ok'")},
va AS {_last("validate_out", "status DESC NULLS LAST, reason DESC NULLS LAST")},
dm AS (SELECT DISTINCT pdf_id, run_id, predicted_label, confidence, chunk_count, len(keywords)::INT AS n_keywords FROM document_metrics),
so AS (SELECT DISTINCT pdf_id, regexp_extract(source_path, '([^/]*)$', 1) AS file, page_count FROM source_docs)
SELECT va.pdf_id, va.run_id, va.status, va.reason, coalesce(ex.pages_total, so.page_count)::INT AS pages_total, ex.pages_read, dm.predicted_label, dm.confidence, dm.n_keywords, dm.chunk_count, so.file
FROM va LEFT JOIN ex USING (pdf_id, run_id) LEFT JOIN dm USING (pdf_id, run_id) LEFT JOIN so USING (pdf_id)"""


def report(spark, d) -> DataFrame:
    t = lambda name: table(spark, d, name)
    return reports.report_rows(t("source_docs"), t("extract_out"), t("validate_out"), t("document_metrics"))


@query(_REPORT)
def report_rows(spark, d):
    """PRJ3, OR10, SNK7: the report's fields of every document and run."""
    return report(spark, d).withColumn("n_keywords", F.when(F.col("keywords").isNotNull(), F.size("keywords"))).drop("keywords", "signals")


@query("SELECT max(run_id) AS run_id FROM runs")
def latest_run(spark, d):
    """SRC7: the last run."""
    return reports.latest_run(table(spark, d, "runs"))


@query("SELECT run_id, concat_ws('-', backend, device) AS mode FROM runs")
def run_modes(spark, d):
    """PRJ5: the mode of every run."""
    return reports.run_mode(table(spark, d, "runs"))


@query("""SELECT run_id, sha256('{"backend":"' || backend || '","device":"' || device || '","dtype":"' || dtype || '","max_pages":' || max_pages || ',"workers":' || workers || '}') AS fingerprint FROM runs
WHERE backend IS NOT NULL AND device IS NOT NULL AND dtype IS NOT NULL AND max_pages IS NOT NULL AND workers IS NOT NULL""")
def run_config_fingerprints(spark, d):
    """SNK5, JS5, HS2, SRC9: a fingerprint of every run's settings, in canonical JSON."""
    fields = ["backend", "device", "dtype", "max_pages", "workers"]
    runs = table(spark, d, "runs").dropna(subset=fields)
    return runs.select("run_id", F.sha2(F.to_json(F.struct(*fields)), 256).alias("fingerprint"))


@query("SELECT run_id, started_at, strftime(started_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%SZ') AS id_from_time FROM runs")
def run_ids(spark, d):
    """DT1: ids made from the start times."""
    return table(spark, d, "runs").select("run_id", "started_at", F.date_format("started_at", "yyyy-MM-dd'T'HH-mm-ss'Z'").alias("id_from_time"))


@query("SELECT pdf_id, source_path FROM source_docs WHERE starts_with(pdf_id, 'ab') OR contains(regexp_extract(source_path, '([^/]*)$', 1), 'ab')")
def doc_selector(spark, d):
    """FIL1, PRJ4: documents by the start of their id or a part of their file name."""
    from ..sources.corpus import select_documents

    return select_documents(table(spark, d, "source_docs"), "ab", "pdf_id", "source_path").select("pdf_id", "source_path")


@query("SELECT DISTINCT pdf_id, url_decode(regexp_extract(source_path, '([^/]*)$', 1)) AS document, left(regexp_replace(url_decode(regexp_extract(source_path, '([^/]*)$', 1)), '[^\\p{L}\\p{N}_.\\-]+', '_', 'g'), 200) AS safe_name FROM source_docs")
def document_names(spark, d):
    """STR19-STR20, PRJ4: readable and safe names of the documents."""
    name = F.url_decode(basename(F.col("source_path")))
    return table(spark, d, "source_docs").select("pdf_id", name.alias("document"), safe_filename(name).alias("safe_name")).distinct()


@query("""SELECT pdf_id, run_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(keywords, lambda k: lower(trim(k.phrase))), lambda x: x <> ''))), ';') AS labels FROM (SELECT DISTINCT pdf_id, run_id, keywords FROM document_metrics WHERE keywords IS NOT NULL)""")
def label_sets(spark, d):
    """AG22: every document's phrases as a sorted set."""
    rows = table(spark, d, "document_metrics").where("keywords IS NOT NULL").select(*KEY, "keywords").distinct()
    return rows.select(*KEY, F.array_join(label_set(F.transform("keywords", lambda k: k["phrase"])), ";").alias("labels"))


@query("""SELECT stage, device, count(*) AS rows, count(peak_vram_mb) AS measured, round_even(avg(wall_time_sec), 4) AS mean_sec, round_even(quantile_cont(wall_time_sec, 0.5)::DECIMAL(20, 6), 4)::DOUBLE AS median_sec, max(wall_time_sec) AS max_sec FROM (SELECT DISTINCT * FROM stage_metrics) GROUP BY stage, device""")
def stage_summary(spark, d):
    """AG12, AG19: times of each stage on each device; null isn't 0."""
    rows = table(spark, d, "stage_metrics").distinct()
    return rows.groupBy("stage", "device").agg(
        F.count(F.lit(1)).alias("rows"), F.count("peak_vram_mb").alias("measured"), F.bround(F.avg("wall_time_sec"), 4).alias("mean_sec"), F.bround(F.expr("cast(percentile(wall_time_sec, 0.5) AS decimal(20, 6))"), 4).cast("double").alias("median_sec"), F.max("wall_time_sec").alias("max_sec")
    )


@query(f"""
WITH r AS ({_STAGE_ROWS}), e AS (SELECT DISTINCT pdf_id FROM r WHERE status IN ('error', 'oom')), v AS (SELECT pdf_id, arg_max(status, (created_at, status)) AS s FROM validate_out GROUP BY pdf_id)
SELECT coalesce(v.pdf_id, e.pdf_id) AS pdf_id, CASE WHEN e.pdf_id IS NOT NULL THEN 'error' ELSE v.s END AS status FROM v FULL JOIN e ON v.pdf_id = e.pdf_id""")
def index_status(spark, d):
    """OR5, OR7: accepted, rejected or, after a failure in any stage, error."""
    verdicts = table(spark, d, "validate_out").groupBy("pdf_id").agg(F.max(F.struct("created_at", "status"))["status"].alias("status"))
    return artifacts.index_status(verdicts, stage_rows(spark, d))
