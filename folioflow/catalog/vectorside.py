"""Vectors, scores and labels, over the embeddings and corpus files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import dot, mean_pool, normalized, sigmoid_pair, softmax_over
from ..operators.classify import best_label, ranked, weighted_means
from ..operators.topk import nearest
from ..sources.corpus import scan
from ..sources.tables import table
from .base import query

LABELS = ("threats", "technology", "policy")
_LOGITS = """
SELECT vec_id, label AS doc, (vec_id % 7)::BIGINT AS weight, unnest(['threats', 'technology', 'policy']) AS name, unnest([embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE]) * 5 AS logit FROM embeddings"""
_SOFT = f"SELECT vec_id, doc, weight, name, logit, exp(logit - top) / sum(exp(logit - top)) OVER (PARTITION BY vec_id) AS score FROM (SELECT *, max(logit) OVER (PARTITION BY vec_id) AS top FROM ({_LOGITS}))"
_MEANS = f"SELECT doc, name, coalesce(sum(score * weight) / nullif(sum(weight), 0), 1.0 / 3) AS score FROM ({_SOFT}) GROUP BY doc, name"


def _logits(spark, d):
    """Three label logits of each vector, standing for a window of the document that its label names."""
    pairs = F.arrays_zip(F.array(*map(F.lit, LABELS)).alias("name"), F.slice("embedding", 1, 3).alias("x"))
    rows = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("doc"), (F.col("vec_id") % 7).alias("weight"), F.explode(pairs).alias("p"))
    return rows.select("vec_id", "doc", "weight", F.col("p.name").alias("name"), (F.col("p.x").cast("double") * 5).alias("logit"))


@query(f"SELECT vec_id, name, round(score, 5) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, name)::INT AS rank FROM ({_SOFT})")
def softmax_rank(spark, d):
    """AG10, WN5: competing label scores of every window, ranked."""
    rows = ranked(softmax_over(_logits(spark, d), ["vec_id"], "logit"), ["vec_id"], "score", "name")
    return rows.select("vec_id", "name", F.round("score", 5).alias("score"), "rank")


@query(f"SELECT doc, name, round(score, 5) AS score FROM ({_MEANS})")
def weighted_label_scores(spark, d):
    """AG6, MP1: every document's label scores, weighted over its windows."""
    means = weighted_means(softmax_over(_logits(spark, d), ["vec_id"], "logit"), ["doc"], "name", "score", "weight", 1 / 3)
    return means.select("doc", "name", F.round("score", 5).alias("score"))


@query(f"""SELECT doc, name, round(score, 5) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, list_position(['threats', 'technology', 'policy'], name)) AS rn FROM ({_MEANS})) WHERE rn = 1""")
def predicted_labels(spark, d):
    """AG7: every document's best label; the declared order settles ties."""
    means = weighted_means(softmax_over(_logits(spark, d), ["vec_id"], "logit"), ["doc"], "name", "score", "weight", 1 / 3)
    return best_label(means, ["doc"], "name", "score", LABELS).select("doc", "name", F.round("score", 5).alias("score"))


@query("""
WITH s AS (SELECT vec_id, 1 / (1 + exp(embedding[5]::DOUBLE - embedding[4]::DOUBLE)) AS flag, 1 / (1 + exp(embedding[7]::DOUBLE - embedding[6]::DOUBLE)) AS sector FROM embeddings)
SELECT vec_id, round(flag, 5) AS flag_score, flag >= 0.5 AS flagged, CASE WHEN flag >= 0.5 THEN sector >= 0.5 END AS in_sector FROM s""")
def independent_flags(spark, d):
    """AG11, FIL13-FIL14: independent flags; the second is asked only where the first fired, else null."""
    e = lambda i: F.col("embedding")[i].cast("double")
    rows = table(spark, d, "embeddings").select("vec_id", "embedding", sigmoid_pair(e(3), e(4)).alias("flag"))
    fired = rows.where("flag >= 0.5").select("vec_id", (sigmoid_pair(e(5), e(6)) >= 0.5).alias("in_sector"))
    return rows.join(fired, "vec_id", "left").select("vec_id", F.round("flag", 5).alias("flag_score"), (F.col("flag") >= 0.5).alias("flagged"), "in_sector")


@query("""
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY label, i), n AS (SELECT label, sqrt(sum(v * v)) AS size FROM m GROUP BY label)
SELECT m.label, (i - 1)::INT AS dim, round(CASE WHEN size > 0 THEN v / size ELSE v END, 5) AS value FROM m JOIN n USING (label)""")
def mean_pooled(spark, d):
    """AG8: the normalised mean vector of each label."""
    rows = mean_pool(table(spark, d, "embeddings"), ["label"], "embedding")
    return rows.select("label", F.posexplode("vector").alias("dim", "v")).select("label", "dim", F.round("v", 5).alias("value"))


@query("""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS s FROM e),
p AS (SELECT q.vec_id AS query_id, o.vec_id, list_inner_product(q.v, o.v) / (q.s * o.s) AS score FROM n q JOIN n o ON q.vec_id % 20 = 0 AND q.vec_id <> o.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, round(score, 5) AS score FROM r WHERE rank <= 5""")
def vector_topk(spark, d):
    """MT3, WN4: the five most similar vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, d, "embeddings")
    found = nearest(vectors, vectors.where("vec_id % 20 = 0"), "vec_id", "embedding", 5)
    return found.select("query_id", "rank", "vec_id", F.round("score", 5).alias("score"))


@query("""SELECT vec_id, round(list_inner_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE)), 4) AS size FROM embeddings""")
def unit_vectors(spark, d):
    """AG9: vectors normalised again have length 1."""
    v = normalized(F.col("embedding"))
    return table(spark, d, "embeddings").select("vec_id", F.round(dot(v, v), 4).alias("size"))


@query()
def corpus_scan(spark, d):
    """SRC1-SRC2, SRC11: the files of the table folder as a corpus: ids from their content."""
    return scan(spark, d, "*.parquet").select("doc_id", "sha256", "bytes").distinct()
