"""Problem 3: texts cut off before their end.

A value is cut if it is a strict prefix of a longer value elsewhere: all values
are sorted (range partitions, each sorted on its own) and each is compared with
its successor, which starts with it if any value does.  Most cut values have no
longer copy, so the corpus also tells how values end: for the last word, and the
last two, it counts how often they end a finished value, precede a clause mark or
are followed by further words.  A value without final punctuation is cut if its
last words only ever go on, or are no whole words.  Lengths at which such values
pile up, and the token limit of the run, say where cuts are likely, and fewer
characters a generated token than finished values have show that text is missing;
marks of a cut decide by themselves.

Defined cases: null, empty and white values are no cases; a finished value
without a full stop is none, by the counts above; repeated rows give one result;
a null token count or run only takes that evidence away.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frame, read, strings, written

_MARK = re.compile(r"(?:…|\.\.\.|\[\s*(?:…|\.\.\.|more|cut|truncated|continued)?\s*\]?|\((?:more|continued|cont\.?|truncated|cut|mehr|suite)\)|(?:read|see) more|�+|[A-Za-z]-|[,;:(\[–—/]|</?\w*|&#?\w*)\s*$", re.I)
_DONE = re.compile(r"[.!?。！？।؟۔][\"'”’»)\]」』]*\s*$")
_OPEN_STOP = re.compile(r"(?:^|[\s(])(?:Dr|Mr|Mrs|Ms|Prof|St|No|vs|approx|e\.g|i\.e|Fig|M|Mme|Sr|Sra|Nr|z\. ?B|bzw)\.$")
_QUOTED_END = re.compile(r"[\"”»)\]]\s*$")
_WORD = re.compile(r"\S+")
_EDGE = "\"'“”‘’«»()[]{}<>"
_CJK = re.compile("[぀-ヿ㐀-鿿฀-๿]")


def _plain(word: str) -> str:
    """A word as counted: without marks at its edges, digits as one sign, lower case only after a mark of case."""
    bare = word.strip(_EDGE + ".,;:!?…。、")
    if any(c.isdigit() for c in bare):
        return "0"
    if bare[1:] != bare[1:].lower() and bare[:1].isupper():
        return "<Camel>"
    return bare


def endings(text: str) -> list[tuple[str, str]]:
    """(words, 'end', 'clause' or 'on') for each word and pair of words of a value."""
    words = _WORD.findall(text)
    done = bool(_DONE.search(text)) and not _MARK.search(text)
    out, before = [], "^"
    for i, word in enumerate(words):
        last = i == len(words) - 1
        if last and not done:
            break  # how an unpunctuated value ends proves nothing
        mark = word.rstrip(_EDGE)[-1:]
        kind = "end" if last else "clause" if mark in ",;:.!?" else "on"
        bare = _plain(word)
        out.append((f"{bare}", kind))
        out.append((f"{before} {bare}", kind))
        before = bare
    return out


def counts(values: DataFrame) -> DataFrame:
    """(words, ends, clauses, goes_on) over all distinct values; each batch is counted before the shuffle."""
    names, types = ["words", "ends", "clauses", "goes_on"], [pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(it):
        for batch in it:
            table: dict[str, list[int]] = {}
            for text in strings(batch, "summary"):
                for (words, kind), n in Counter(endings(text or "")).items():
                    row = table.setdefault(words, [0, 0, 0])
                    row[("end", "clause", "on").index(kind)] += n
            yield frame(names, [list(table), *(list(c) for c in zip(*table.values()))] if table else [[]] * 4, types)

    sums = [F.sum(n).alias(n) for n in names[1:]]
    return values.select("summary").mapInArrow(run, "words string, ends bigint, clauses bigint, goes_on bigint").groupBy("words").agg(*sums)


def prefixes(values: DataFrame) -> DataFrame:
    """The distinct values that are strict prefixes of another one."""
    ordered = values.select("summary").distinct().repartitionByRange("summary").sortWithinPartitions("summary")

    def run(it):
        from pyspark import TaskContext

        part, last, first = TaskContext.get().partitionId(), None, None
        for batch in it:
            found = []
            for value in strings(batch, "summary"):
                if last is None:
                    first = value
                elif value.startswith(last):
                    found.append(last)
                last = value
            yield frame(["kind", "part", "summary"], [["prefix"] * len(found), [part] * len(found), found], [pa.string(), pa.int32(), pa.string()])
        if first is not None:
            yield frame(["kind", "part", "summary"], [["first", "last"], [part] * 2, [first, last]], [pa.string(), pa.int32(), pa.string()])

    # kept as a table: a second run of the range partitioning could draw other borders
    rows = written(ordered.mapInArrow(run, "kind string, part int, summary string"))
    # the successor of a partition's last value is the first of the next partition: two rows a partition
    edges = rows.where("kind <> 'prefix'")
    after = F.lead("summary").over(Window.orderBy("part", "kind"))
    joined = edges.withColumn("after", after).where("kind = 'last' AND startswith(after, summary)").select("summary")
    return rows.where("kind = 'prefix'").select("summary").union(joined)


def _open(texts: DataFrame) -> DataFrame:
    """(summary, marked, last word, last two words) of the values without final punctuation, or with a mark of a cut."""
    names = ["summary", "marked", "one", "two"]
    types = [pa.string(), pa.bool_(), pa.string(), pa.string()]

    def run(it):
        for batch in it:
            out = []
            for text in strings(batch, "summary"):
                stripped = (text or "").rstrip()
                if not stripped:
                    continue
                marked = bool(_MARK.search(stripped) or _OPEN_STOP.search(stripped))
                if not marked and (_DONE.search(stripped) or (_QUOTED_END.search(stripped) and _balanced(stripped))):
                    continue
                words = ["^", *map(_plain, _WORD.findall(stripped)[-2:])]
                out.append((text, marked, words[-1], f"{words[-2]} {words[-1]}"))
            yield frame(names, list(zip(*out)) or [[] for _ in names], types)

    return texts.select("summary").mapInArrow(run, "summary string, marked boolean, one string, two string")


def _balanced(text: str) -> bool:
    return text.count('"') % 2 == 0 and text.count("(") == text.count(")") and text.count("«") == text.count("»") and text.count("“") == text.count("”")


def piled_lengths(lengths: DataFrame) -> DataFrame:
    """(n_chars) at which values without final punctuation end far more often than at the lengths around."""
    by_length = lengths.groupBy("n_chars").agg(F.count(F.lit(1)).alias("n"))
    around = by_length.select(F.explode(F.sequence(F.col("n_chars") - 4, F.col("n_chars") + 4)).alias("n_chars"), F.col("n").alias("m"))
    near = around.groupBy("n_chars").agg(F.sum("m").alias("m"))
    return by_length.join(near, "n_chars").where("n >= 5 AND n > 1.5 * (m - n)").select("n_chars")


RATIO_QUANTILE, RATIO_SLACK = 0.01, 0.985


def script_of(text: Column) -> Column:
    """The script that tells how many characters a token stands for: the first of these that a text has any sign of."""
    kinds = (("unspaced", r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\u0e00-\u0eff]"), ("indic", r"[\u0900-\u0dff]"), ("arabic", r"[\u0590-\u08ff]"), ("cyrillic", r"[\u0370-\u052f]"))
    out = F.when(text.rlike(kinds[0][1]), kinds[0][0])
    for name, signs in kinds[1:]:
        out = out.when(text.rlike(signs), name)
    return out.otherwise("latin")


def least_ratios(rows: DataFrame) -> DataFrame:
    """(script, least): the characters a generated token that all but a hundredth of a script's values ending in a full stop reach; a row for each script."""
    finished = rows.where(F.col("summary").rlike(r"[.!?。！？।؟][\"'”’»)]*\s*$") & ~F.col("summary").rlike(r"\.\.\.\s*$") & (F.col("generated_tokens") > 0))
    ratio = F.length("summary") / F.col("generated_tokens")
    return finished.groupBy(script_of(F.col("summary")).alias("script")).agg((F.percentile_approx(ratio, RATIO_QUANTILE, 10000) * RATIO_SLACK).alias("least"))


BROADCAST_ROWS, SALTS = 200_000, 64


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The rows with what a table of unique keys says of theirs; a key of a third of the rows is no burden: the table is pruned to the keys there and sent, or salted beyond BROADCAST_ROWS."""
    asked = table.join(rows.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    if asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(asked), key, "left")
    salted = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("summary"), F.lit(SALTS)).cast("int")).join(salted, [key, "_salt"], "left").drop("_salt")


def judged(summaries: DataFrame, runs: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """(pdf_id, run_id, summary, cut, why) of every distinct summary."""
    rows = summaries.where("summary IS NOT NULL AND trim(summary) <> ''").select("pdf_id", "run_id", "summary", "generated_tokens").distinct()
    limits = runs.groupBy("run_id").agg(F.max("summary_max_new_tokens").alias("most_tokens"))
    rows = rows.join(limits, "run_id", "left").withColumn("at_tokens", F.coalesce(F.col("generated_tokens") >= F.col("most_tokens"), F.lit(False)))
    values = written(rows.select("summary").distinct())
    stats = written(counts(values))
    # a value that only lacks its final marks is no prefix of the one that has them
    bare = F.regexp_replace("summary", r"[\s.!?\"'”’»)\]]+$", "")
    copies = values if pool is None else values.union(pool.where("summary IS NOT NULL AND trim(summary) <> ''").select("summary"))
    cut_off = prefixes(copies.select(bare.alias("summary")).where("summary <> ''")).distinct().select(F.col("summary").alias("bare"), F.lit(True).alias("is_prefix"))
    rows = rows.withColumn("bare", bare)
    open_ = written(_open(values).withColumn("n_chars", F.length("summary")))
    piled = piled_lengths(open_.where("NOT marked").select("n_chars")).withColumn("at_length", F.lit(True))
    named = lambda p: stats.select(F.col("words").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in ("ends", "clauses", "goes_on")))
    facts = looked_up(looked_up(looked_up(open_, named("two"), "two"), named("one"), "one"), piled, "n_chars")
    facts = rows.join(facts, "summary", "left").join(cut_off, "bare", "left")
    facts = facts.withColumn("script", script_of(F.col("summary"))).join(F.broadcast(least_ratios(rows)), "script", "left")  # five scripts at most
    least = F.col("least")
    zero = {f"{p}_{c}": 0 for p in ("one", "two") for c in ("ends", "clauses", "goes_on")}
    facts = facts.fillna(zero).withColumn("likely", F.coalesce("at_length", F.lit(False)) | F.col("at_tokens"))
    ratio = F.when(F.col("generated_tokens") > 0, F.length(F.rtrim("summary")) / F.col("generated_tokens"))
    short, shorter, enough = (F.coalesce(x, F.lit(False)) for x in (ratio < least, ratio < 0.93 * least, ratio >= least))
    open_value, ends_two = F.col("marked").isNotNull(), F.col("two_ends") + F.col("two_clauses")
    seen_one, seen_two = (F.col(f"{p}_ends") + F.col(f"{p}_clauses") + F.col(f"{p}_goes_on") for p in ("one", "two"))
    may_end = F.col("one_ends") >= 0.04 * seen_one
    why = (
        F.when(F.col("marked"), "mark")
        .when(shorter | (short & open_value), "tokens")
        .when(~open_value, F.lit(None))
        .when(F.coalesce("is_prefix", F.lit(False)), "prefix")
        .when(seen_one == 0, "part of a word")
        .when(F.col("likely") & (F.col("two_ends") == 0) & ~((seen_two == 0) & may_end), "limit")
        .when((ends_two == 0) & (seen_two > 0) & ~may_end, "goes on")
        .when((F.col("two_ends") == 0) & (F.col("two_goes_on") >= 3) & (F.col("two_goes_on") > 4 * F.col("two_clauses")) & ~(enough & may_end), "goes on")
        .when((seen_two == 0) & (F.col("one_ends") + F.col("one_clauses") < 0.02 * seen_one), "goes on")
    )
    return facts.withColumn("why", why).select("pdf_id", "run_id", "summary", F.col("why").isNotNull().alias("cut"), "why")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "summarize_out"), read(spark, sf_dir, "runs"), read(spark, sf_dir, "document_metrics").select("summary"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries that were cut."""
    return _judged(spark, sf_dir).where("cut").select("pdf_id", "run_id").distinct()


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source's summaries are cut; sources without summaries have 0 of 0 and a null share."""
    per_run = _judged(spark, sf_dir).groupBy("pdf_id", "run_id").agg(F.max("cut").alias("cut"))
    sources = read(spark, sf_dir, "source_docs").groupBy("pdf_id").agg(F.min("source").alias("source"))
    joined = sources.join(per_run, "pdf_id", "left").groupBy("source").agg(F.count("run_id").alias("summaries"), F.count_if(F.coalesce("cut", F.lit(False))).alias("cut"))
    return joined.withColumn("share", F.round(F.col("cut") / F.nullif("summaries", F.lit(0)), 6))
