"""Evaluation measures and string similarities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.functions import text as T


def _pairs(rows: DataFrame, ids: str) -> DataFrame:
    return rows.select("source1_entity_id", F.explode(T.decode_ids(ids)).alias("id")).distinct()


def entity_scores(truth: DataFrame, predicted: DataFrame, beta2: float = 0.25) -> DataFrame:
    """``source1_entity_id, f``: per entity of the truth.

    A true singleton scores 1 for an empty prediction and 0 otherwise; any other
    entity without a true match found scores 0.
    """
    t = _pairs(truth, "matched_entity_ids")
    p = _pairs(predicted, "matched_entity_ids")
    hits = t.join(p, ["source1_entity_id", "id"]).groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("tp"))
    n_t = t.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("nt"))
    n_p = p.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("np"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    all_rows = truth.select("source1_entity_id").distinct()
    joined = all_rows.join(n_t, "source1_entity_id", "left").join(n_p, "source1_entity_id", "left").join(hits, "source1_entity_id", "left")
    precision, recall = zero("tp") / zero("np"), zero("tp") / zero("nt")
    score = F.when(zero("nt") == 0, F.when(zero("np") == 0, 1.0).otherwise(0.0)).when(zero("tp") == 0, 0.0).otherwise((1 + beta2) * precision * recall / (beta2 * precision + recall))
    return joined.select("source1_entity_id", score.alias("f"))


def macro_f(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    return entity_scores(truth, predicted).agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("f"), 9).alias("f_half"))


def blocking_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Share of true pairs among the candidates (``source1_entity_id, cand``)."""
    t = _pairs(truth, "matched_entity_ids")
    hit = t.join(candidates.select("source1_entity_id", F.col("cand").alias("id")).distinct().withColumn("hit", F.lit(1)), ["source1_entity_id", "id"], "left")
    return hit.agg(F.count(F.lit(1)).alias("true_pairs"), F.count("hit").alias("found"), F.round(F.count("hit") / F.nullif(F.count(F.lit(1)), F.lit(0)), 9).alias("recall"))


def reduction_ratio(pairs: DataFrame, reference: DataFrame, others: DataFrame) -> DataFrame:
    n = reference.agg(F.count(F.lit(1)).alias("n_s1")).join(others.agg(F.count(F.lit(1)).alias("n_others")), F.lit(True))
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs")).join(n, F.lit(True)).select("n_pairs", "n_s1", "n_others", F.round(1 - F.col("n_pairs") / (F.col("n_s1") * F.col("n_others")), 9).alias("reduction"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def tfidf_cosine(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``a, b, cosine`` for pairs of ids over ``docs(id, tokens)``; idf = ln((1 + N) / (1 + df)) + 1.

    Relational: weights are joined per shared token, norms per id, so no vector
    or vocabulary is gathered anywhere.
    """
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    tf = docs.select("id", F.explode("tokens").alias("token")).groupBy("id", "token").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    weight = tf.join(df, "token").join(F.broadcast(n), F.lit(True)).select("id", "token", (F.col("tf") * (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = weight.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    left = pairs.join(weight.select(F.col("id").alias("a"), "token", F.col("w").alias("wa")), "a")
    dots = left.join(weight.select(F.col("id").alias("b"), "token", F.col("w").alias("wb")), ["b", "token"]).groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    all_norms = pairs.join(norm.select(F.col("id").alias("a"), F.col("norm").alias("na")), "a", "left").join(norm.select(F.col("id").alias("b"), F.col("norm").alias("nb")), "b", "left")
    return all_norms.join(dots, ["a", "b"], "left").select("a", "b", F.round(F.coalesce(F.col("dot") / (F.col("na") * F.col("nb")), F.lit(0.0)), 9).alias("cosine"))
