"""Cleaning, validation, segmentation, keyphrases and contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import ABBREVIATIONS, LINE_BREAK, NOT_WORD, SPACE, STOP_WORDS, blocks, hypothesis, ngram_rows, present, segments, sentences, tokens
from ..operators.admission import first_words, read_until
from ..operators.clean import BODY_SCORE, BOILERPLATE, TITLE_WORDS, clean, raw_sizes, reduction, with_repeated_lines
from ..operators.classify import WINDOW_TOKENS
from ..operators.context import reduce_context
from ..operators.keywords import top_terms
from ..operators.validate import FAILURES, validate
from ..operators.windows import even_positions
from ..operators.windows import token_windows as packed
from ..sources.tables import table
from .base import query, quoted

S, LB = SPACE, LINE_BREAK
_STRIP = lambda x: f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"
_TOKENS = lambda x: f"list_filter(string_split_regex({x}, '{S}+'), lambda t: t <> '')"


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """One body for each document and run."""
    return table(spark, d, "clean_out").select("pdf_id", "run_id", "body").distinct()


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extract_out").where("pages IS NOT NULL").select("pdf_id", "run_id", "pages").distinct()


_BODIES = "SELECT DISTINCT pdf_id, run_id, body FROM clean_out"
_PAGES = "SELECT DISTINCT pdf_id, run_id, pages FROM extract_out WHERE pages IS NOT NULL"

_VALIDATE = f"""
WITH b AS ({_BODIES}),
w AS (SELECT *, coalesce(body, '') AS t, regexp_extract_all(lower(coalesce(body, '')), '[a-z'']+') AS words FROM b),
s AS (SELECT pdf_id, run_id, len(words)::INT AS content_words, length({_STRIP("t")})::INT AS content_chars,
        list_filter({quoted(FAILURES)}, lambda p: contains(lower(t), p))[1] AS failure_signal,
        CASE WHEN len(words) > 0 THEN len(list_distinct(words))::DOUBLE / len(words) ELSE 0.0 END AS ratio FROM w),
r AS (SELECT *, CASE WHEN failure_signal IS NOT NULL THEN 'failure_signal' WHEN content_words > 0 AND ratio < 0.3 THEN 'low_unique_word_ratio'
        WHEN content_words < 120 THEN 'too_short' END AS reason FROM s)
SELECT pdf_id, run_id, content_words, content_chars, failure_signal, round_even(ratio, 4) AS unique_word_ratio, reason,
       CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status FROM r"""


@query(_VALIDATE)
def validate_status(spark, d):
    """FIL6-FIL10, AG5, STR4: the verdict on every cleaned body."""
    return validate(_bodies(spark, d), Config()).select("pdf_id", "run_id", "content_words", "content_chars", "failure_signal", "unique_word_ratio", "reason", "status")


@query(f"SELECT status, reason, count(*) AS n, sum(content_words)::BIGINT AS words FROM ({_VALIDATE}) GROUP BY status, reason")
def validate_reason_counts(spark, d):
    """AG12: verdicts by reason."""
    return validate_status(spark, d).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("content_words").alias("words"))


_REPEATED = f"""
WITH p AS ({_PAGES}),
e AS (SELECT pdf_id, run_id, len(pages) AS n, unnest(pages) AS page, generate_subscripts(pages, 1) AS i FROM p WHERE len(pages) > 1),
l AS (SELECT pdf_id, run_id, n, i, {_STRIP("line")} AS line FROM (SELECT pdf_id, run_id, n, i, unnest(string_split_regex(page, '{LB}')) AS line FROM e))
SELECT pdf_id, run_id, line FROM l WHERE line <> '' GROUP BY pdf_id, run_id, n, line HAVING count(DISTINCT i) >= n // 2 + 1"""


@query(_REPEATED)
def repeated_page_lines(spark, d):
    """AG1, FIL3, SO2: lines that stand on more than half of a document's pages."""
    return with_repeated_lines(_pages(spark, d)).select("pdf_id", "run_id", F.explode("removed_lines").alias("line"))


_LINES = lambda x: f"list_filter(list_transform(string_split_regex({x}, '{LB}'), lambda z: {_STRIP('z')}), lambda z: z <> '')"
_CLEAN = f"""
WITH p AS ({_PAGES}),
rep AS (SELECT pdf_id, run_id, list_sort(list(line)) AS removed FROM ({_REPEATED}) GROUP BY pdf_id, run_id),
c AS (SELECT p.pdf_id, p.run_id, CASE WHEN removed IS NULL THEN pages ELSE list_transform(pages, lambda g:
        array_to_string(list_filter(string_split_regex(g, '{LB}'), lambda z: NOT list_contains(removed, {_STRIP('z')})), chr(10))) END AS pages,
        coalesce(removed, []) AS removed FROM p LEFT JOIN rep USING (pdf_id, run_id)),
b AS (SELECT pdf_id, run_id, removed, flatten(list_transform(pages, lambda g: list_filter(list_transform(
        string_split_regex(g, chr(10) || '{S}*' || chr(10)), lambda z: {_STRIP('z')}), lambda z: z <> ''))) AS blocks FROM c),
t AS (SELECT pdf_id, run_id, removed, blocks, CASE WHEN len(blocks) > 0 AND NOT contains(blocks[1], chr(10)) AND len({_TOKENS('blocks[1]')}) <= {TITLE_WORDS} THEN blocks[1] END AS title FROM b),
k AS (SELECT pdf_id, run_id, removed, title, list_filter(CASE WHEN title IS NULL THEN blocks ELSE blocks[2:] END, lambda z:
        len({_TOKENS('z')})::DOUBLE - 50 * (CASE WHEN len({_LINES('z')}) > 0 THEN len(list_filter({_LINES('z')}, lambda y: len({_TOKENS('y')}) <= 4))::DOUBLE / len({_LINES('z')}) ELSE 0.0 END)
        - 30 * len(list_filter({quoted(BOILERPLATE)}, lambda f: contains(lower(z), f))) >= {BODY_SCORE}) AS kept FROM t)
SELECT pdf_id, run_id, title, array_to_string(kept, chr(10) || chr(10)) AS body, len(kept)::INT AS block_count, array_to_string(removed, chr(10)) AS removed_lines FROM k"""


@query(_CLEAN)
def clean_pages(spark, d):
    """AG2-AG4, FIL4-FIL5, WN6, ST7, STR6-STR8: title, body and removed lines of every extraction."""
    done = clean(_pages(spark, d))
    return done.select("pdf_id", "run_id", "title", "body", "block_count", F.array_join("removed_lines", "\n").alias("removed_lines"))


@query(f"""
WITH p AS (SELECT pdf_id, run_id, unnest(pages) AS page FROM ({_PAGES})),
b AS (SELECT pdf_id, unnest(list_filter(list_transform(string_split_regex(page, chr(10) || '{S}*' || chr(10)), lambda z: {_STRIP('z')}), lambda z: z <> '')) AS block FROM p),
h AS (SELECT pdf_id, unnest(list_filter({quoted(BOILERPLATE)}, lambda f: contains(lower(block), f))) AS phrase FROM b)
SELECT phrase, count(*) AS blocks, count(DISTINCT pdf_id) AS documents FROM h GROUP BY phrase""")
def boilerplate_phrases(spark, d):
    """AG3, JN10: how many blocks and documents hold each phrase."""
    block = _pages(spark, d).select("pdf_id", F.explode("pages").alias("p")).select("pdf_id", F.explode(blocks(F.col("p"))).alias("b"))
    hits = block.select("pdf_id", F.explode(present(F.col("b"), BOILERPLATE)).alias("phrase"))
    return hits.groupBy("phrase").agg(F.count(F.lit(1)).alias("blocks"), F.count_distinct("pdf_id").alias("documents"))


_ABBR = "|".join(ABBREVIATIONS)
_SEGMENTS = lambda x: f"""list_filter(list_transform(string_split(regexp_replace(replace(regexp_replace(regexp_replace(
        regexp_replace({x}, '\\b({_ABBR})\\.', '\\1' || chr(2), 'g'), '([.;,!?])({S}|$)', '\\1' || chr(1) || '\\2', 'g'), '([.;,!?])({S}|$)', '\\1' || chr(1) || '\\2', 'g'), chr(2), '.'), chr(1) || '+', chr(1), 'g'), chr(1)), lambda z: {_STRIP('z')}), lambda z: z <> '')"""  # noqa: E731


@query(f"""
WITH b AS (SELECT DISTINCT pdf_id, body FROM clean_out WHERE body IS NOT NULL),
s AS (SELECT pdf_id, {_SEGMENTS('body')} AS parts FROM b)
SELECT pdf_id, generate_subscripts(parts, 1)::INT AS pos, unnest(parts) AS segment FROM s""")
def segment_text(spark, d):
    """STR1: the sentences and clauses of every body."""
    bodies = table(spark, d, "clean_out").where("body IS NOT NULL").select("pdf_id", "body").distinct()
    return bodies.select("pdf_id", F.posexplode(segments(F.col("body"))).alias("pos", "segment")).select("pdf_id", (F.col("pos") + 1).alias("pos"), "segment")


_SENTENCES = lambda x: f"""list_filter(list_transform(string_split(regexp_replace({x}, '([.!?。！？।؟…]+["''”’)\\]]*)({S}|$)', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda z: {_STRIP('z')}), lambda z: z <> '')"""


@query(f"""
WITH b AS (SELECT DISTINCT pdf_id, body FROM clean_out WHERE body IS NOT NULL)
SELECT pdf_id, len(s)::INT AS sentences, coalesce(list_max(list_transform(s, lambda z: length(z))), 0)::INT AS longest FROM (SELECT pdf_id, {_SENTENCES('body')} AS s FROM b)""")
def sentence_counts(spark, d):
    """STR2: how many sentences a body has and how long the longest is."""
    bodies = table(spark, d, "clean_out").where("body IS NOT NULL").select("pdf_id", "body").distinct().withColumn("s", sentences(F.col("body")))
    longest = F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0))
    return bodies.select("pdf_id", F.size("s").alias("sentences"), longest.alias("longest"))


_NGRAMS = f"""
WITH b AS (SELECT DISTINCT pdf_id, body FROM clean_out WHERE body IS NOT NULL),
s AS (SELECT pdf_id, unnest({_SEGMENTS('body')}) AS seg FROM b),
w AS (SELECT pdf_id, list_filter(regexp_extract_all(lower(seg), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: NOT list_contains({quoted(STOP_WORDS)}, x)) AS w FROM s),
g AS (SELECT pdf_id, unnest(w) AS term FROM w
  UNION ALL SELECT pdf_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) >= 2
  UNION ALL SELECT pdf_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) >= 3)
"""


@query(_NGRAMS + """, c AS (SELECT pdf_id, term, count(*) AS n FROM g GROUP BY pdf_id, term)
SELECT pdf_id, term, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY pdf_id ORDER BY n DESC, term)::INT AS rank FROM c) WHERE rank <= 5""")
def ngram_top_terms(spark, d):
    """STR3, WN4, LI3: the five most frequent n-grams of every body."""
    return top_terms(table(spark, d, "clean_out").where("body IS NOT NULL").select("pdf_id", "body").distinct())


@query(_NGRAMS + "SELECT pdf_id, count(DISTINCT term) AS candidates FROM g GROUP BY pdf_id")
def ngram_vocabulary(spark, d):
    """STR3, SO3: the size of every body's candidate vocabulary."""
    bodies = table(spark, d, "clean_out").where("body IS NOT NULL").select("pdf_id", "body").distinct()
    return ngram_rows(bodies, "pdf_id", "body").distinct().groupBy("pdf_id").agg(F.count(F.lit(1)).alias("candidates"))


BUDGET = Config().reduced_context_chars
_PHRASES = "SELECT DISTINCT pdf_id, run_id, list_transform(keywords, lambda k: k.phrase) AS phrases FROM document_metrics WHERE keywords IS NOT NULL"


@query(f"""
WITH b AS (SELECT b.pdf_id, b.run_id, coalesce(body, '') AS body, phrases FROM ({_BODIES}) b JOIN ({_PHRASES}) k USING (pdf_id, run_id)),
s AS (SELECT pdf_id, run_id, phrases, {_SENTENCES('body')} AS s FROM b),
e AS (SELECT pdf_id, run_id, phrases, unnest(s) AS t, generate_subscripts(s, 1) AS i FROM s),
z AS (SELECT *, ' ' || regexp_replace(lower(t), '{NOT_WORD}+', ' ', 'g') || ' ' AS plain FROM e),
m AS (SELECT *, len(list_filter(phrases, lambda k: trim(k) <> '' AND contains(plain, ' ' || lower(k) || ' '))) > 0 AS hit FROM z),
f AS (SELECT *, bool_or(hit) OVER (PARTITION BY pdf_id, run_id) AS any_hit FROM m),
k AS (SELECT *, sum(length(t)) OVER (PARTITION BY pdf_id, run_id ORDER BY i) AS chars, row_number() OVER (PARTITION BY pdf_id, run_id ORDER BY i) AS rn FROM f WHERE hit OR NOT any_hit),
g AS (SELECT pdf_id, run_id, count(*)::INT AS sentences_kept, max(chars)::INT AS reduced_context_chars, bool_and(NOT any_hit) AS used_fallback, string_agg(t, ' ' ORDER BY i) AS reduced_context
      FROM k WHERE rn = 1 OR chars <= {BUDGET} GROUP BY pdf_id, run_id)
SELECT s.pdf_id, s.run_id, coalesce(sentences_kept, 0)::INT AS sentences_kept, coalesce(reduced_context_chars, 0)::INT AS reduced_context_chars, coalesce(used_fallback, true) AS used_fallback, coalesce(reduced_context, '') AS reduced_context
FROM s LEFT JOIN g USING (pdf_id, run_id)""")
def context_budget(spark, d):
    """FIL11-FIL12, WN1: the context of every document with keyphrases, up to the configured budget."""
    phrases = table(spark, d, "document_metrics").where("keywords IS NOT NULL").select("pdf_id", "run_id", F.transform("keywords", lambda k: k["phrase"]).alias("phrases")).distinct()
    done = reduce_context(_bodies(spark, d).join(phrases, ["pdf_id", "run_id"]), BUDGET)
    return done.select("pdf_id", "run_id", "sentences_kept", "reduced_context_chars", "used_fallback", "reduced_context")


@query(f"""
WITH p AS (SELECT pdf_id, run_id, len(pages) AS n FROM ({_PAGES}))
SELECT pdf_id, run_id, unnest(CASE WHEN n < 1 THEN [] WHEN n <= 3 THEN range(1, n + 1) ELSE list_transform(range(0, 3), lambda i: round_even(i * (n - 1) / 2.0, 0)::BIGINT + 1) END)::INT AS page FROM p""")
def even_pages(spark, d):
    """WN3, LI4: three pages spread evenly over every document."""
    return _pages(spark, d).select("pdf_id", "run_id", F.explode(even_positions(F.size("pages"), 3)).alias("page"))


def _windows_sql(budget: int, overlap: float) -> str:
    """Greedy windows by recursion: each one's end and the next one's begin, over the running totals of tokens."""
    last = lambda total: f"len(list_filter(upto, lambda u: u <= {total})) - 1"  # noqa: E731 - the last sentence up to a total
    end = lambda begin: f"greatest({begin} + 1, {last(f'upto[{begin} + 1] + {budget}')})"
    again = f"greatest(b + 1, least(e, {last(f'upto[e + 1] - {int(budget * overlap)}')}))"
    return f"""
WITH RECURSIVE d AS (SELECT DISTINCT pdf_id, body FROM clean_out WHERE body IS NOT NULL),
p AS (SELECT pdf_id, {_SENTENCES('body')} AS s FROM d),
z AS (SELECT pdf_id, s, list_transform(s, lambda x: len({_TOKENS('x')})) AS n FROM p WHERE len(s) > 0),
t AS (SELECT pdf_id, s, n, list_transform(range(0, len(n) + 1), lambda i: coalesce(list_sum(n[1:i]), 0)::BIGINT) AS upto FROM z),
w(pdf_id, pos, b, e) AS (
  SELECT pdf_id, 0, 0::BIGINT, {end('0')} FROM t
  UNION ALL
  SELECT pdf_id, pos + 1, nb, {end('nb')} FROM (SELECT w.pdf_id, w.pos, t.upto, {again} AS nb FROM w JOIN t USING (pdf_id) WHERE w.e < len(t.s)))
SELECT w.pdf_id, w.pos::INT AS pos, CASE WHEN n[b + 1] > {budget} THEN array_to_string(({_TOKENS('s[b + 1]')})[1:{budget}], ' ') ELSE array_to_string(s[b + 1:e], ' ') END AS "window" FROM w JOIN t USING (pdf_id)"""


def _windows(spark: SparkSession, d: str, budget: int, overlap: float) -> DataFrame:
    bodies = table(spark, d, "clean_out").where("body IS NOT NULL").select("pdf_id", "body").distinct()
    rows = bodies.select("pdf_id", packed(sentences(F.col("body")), budget, overlap).alias("w"))
    return rows.select("pdf_id", F.posexplode("w").alias("pos", "window"))


@query(_windows_sql(WINDOW_TOKENS, 0.125))
def token_windows(spark, d):
    """WN2: the classifier's windows of whole sentences of every body; greedy with a look back, so in Arrow batches."""
    return _windows(spark, d, WINDOW_TOKENS, 0.125)


@query(_windows_sql(64, 0.25))
def short_token_windows(spark, d):
    """WN2: windows for a model that takes 64 tokens, so that most bodies have many."""
    return _windows(spark, d, 64, 0.25)


@query(f"""
WITH p AS ({_PAGES}),
r AS (SELECT pdf_id, run_id, list_sum(list_transform(pages, lambda g: length(coalesce(g, ''))))::INT AS raw_chars, list_sum(list_transform(pages, lambda g: len({_TOKENS("coalesce(g, '')")})))::INT AS raw_words FROM p),
c AS (SELECT pdf_id, run_id, length(coalesce(body, ''))::INT AS clean_chars FROM ({_BODIES}))
SELECT r.pdf_id, r.run_id, coalesce(raw_chars, 0)::INT AS raw_chars, coalesce(raw_words, 0)::INT AS raw_words, clean_chars, CASE WHEN raw_chars > 0 THEN round_even(100 * (1 - clean_chars::DOUBLE / raw_chars), 2) END AS reduction_pct
FROM r LEFT JOIN c USING (pdf_id, run_id)""")
def raw_reduction(spark, d):
    """AG17: sizes before and after cleaning."""
    chars, words = raw_sizes(F.col("pages"))
    raw = _pages(spark, d).select("pdf_id", "run_id", chars.alias("raw_chars"), words.alias("raw_words"))
    body = _bodies(spark, d).select("pdf_id", "run_id", F.length(F.coalesce("body", F.lit(""))).alias("clean_chars"))
    return raw.join(body, ["pdf_id", "run_id"], "left").withColumn("reduction_pct", reduction(F.col("raw_chars"), F.col("clean_chars")))


@query(f"""
WITH p AS ({_PAGES}),
e AS (SELECT pdf_id, run_id, len(pages) AS n, unnest(pages[1:10]) AS page, generate_subscripts(pages[1:10], 1) AS i FROM p),
s AS (SELECT pdf_id, run_id, n, i, sum(length(coalesce(page, ''))) OVER w AS chars, sum(len({_TOKENS("coalesce(page, '')")})) OVER w AS words FROM e WINDOW w AS (PARTITION BY pdf_id, run_id ORDER BY i)),
g AS (SELECT pdf_id, run_id, max(n) AS n, min(i) FILTER (chars >= 100 AND words >= 20) AS met, max(i) AS last FROM s GROUP BY pdf_id, run_id)
SELECT g.pdf_id, g.run_id, coalesce(met, last)::INT AS pages_used, s.chars::BIGINT AS chars, s.words::BIGINT AS words,
       CASE WHEN met IS NOT NULL THEN 'threshold_met' WHEN g.n >= 10 THEN 'max_pages_reached' ELSE 'no_more_pages' END AS stop_reason
FROM g JOIN s ON s.pdf_id = g.pdf_id AND s.run_id = g.run_id AND s.i = coalesce(met, last)""")
def page_threshold(spark, d):
    """SRC13, WN7: the first page count at which a document has enough text."""
    return read_until(_pages(spark, d), ["pdf_id", "run_id"])


@query(f"""
SELECT doc_id, CASE WHEN len(t) > 1000 THEN array_to_string(t[1:1000], ' ') ELSE text END AS head FROM (SELECT doc_id, text, {_TOKENS('text')} AS t FROM documents WHERE text IS NOT NULL)""")
def head_words(spark, d):
    """SRC12, LI5: the first 1,000 words of texts longer than that."""
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", first_words(F.col("text"), 1000).alias("head"))


@query(f"""
WITH p AS (SELECT pdf_id, run_id, len(pages) AS n, pages FROM ({_PAGES})), t AS (SELECT unnest(['threats', 'technology', 'policy']) AS label),
w AS (SELECT pdf_id, run_id, unnest(pages) AS page FROM p)
SELECT 'This example is ' || label || '.' AS hypothesis, count(*) AS pairs, sum(len({_TOKENS("coalesce(page, '')")}))::BIGINT AS words FROM w CROSS JOIN t GROUP BY label""")
def window_label_pairs(spark, d):
    """JN8, STR12: every page beside every label's hypothesis; the labels are three literals, exploded in place."""
    labels = F.array(F.lit("threats"), F.lit("technology"), F.lit("policy"))
    rows = _pages(spark, d).select(F.explode("pages").alias("page")).select("page", F.explode(labels).alias("label"))
    rows = rows.select(hypothesis(F.col("label"), Config().hypothesis_template).alias("hypothesis"), F.size(tokens(F.coalesce("page", F.lit("")))).alias("w"))
    return rows.groupBy("hypothesis").agg(F.count(F.lit(1)).alias("pairs"), F.sum("w").alias("words"))


@query()
def keyphrases_default(spark, d):
    """ML1-ML3, JN9: keyphrases by the stand-in encoder."""
    from ..operators.keywords import keyphrases

    bodies = table(spark, d, "clean_out").groupBy("pdf_id").agg(F.min("body").alias("body"))
    return keyphrases(bodies).select("pdf_id", F.posexplode("keywords").alias("pos", "k")).select("pdf_id", "pos", "k.phrase", F.round("k.score", 5).alias("score"))


@query()
def classify_default(spark, d):
    """ML4-ML6, FIL13-FIL15: labels by the stand-in scorer."""
    from ..operators.classify import classify

    bodies = table(spark, d, "clean_out").groupBy("pdf_id").agg(F.min("body").alias("body"))
    return classify(bodies).select("pdf_id", "predicted_label", F.round("confidence", 5).alias("confidence"), "n_windows", F.array_join("sectors", ";").alias("sectors"))


@query()
def summarize_default(spark, d):
    """ML7-ML8: guarded summaries by the stand-in generator."""
    from ..operators.summarize import summarize

    contexts = context_budget(spark, d).select("pdf_id", "run_id", "reduced_context")
    return summarize(contexts, Config(injection_guard=True)).select("pdf_id", "run_id", "summary", "output_guard_triggered", "prompt_tokens", "generated_tokens")
