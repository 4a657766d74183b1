"""Mixing sources to target weights by Sainte-Lague apportionment.

All steps are DataFrame operations:

1. word totals per source, targets by weight with a cap of ``max_repeat``
   passes over a source (water filling in closed form);
2. whole blocks of ``block_words`` words go to sources, and each source's blocks
   to its shards, by highest quotients ``votes / (2k - 1)``;
3. a shard lays its documents end to end in seeded order. Every block is taken
   ``quota div blocks`` times, and ``quota mod blocks`` of them once more, picked
   by a seeded systematic draw. How many picked blocks lie before a position
   has a closed form, so no row per block ever exists.

Defined cases: a null text has size 0; a null source is a source of its own,
sorted last; empty tables give no rows; repeated rows each get their own place;
rows with equal id and size are interchangeable; rows without id are drawn by their text,
so that they spread over the shards like others; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm.common import n_words, settle

WEIGHTS = (5, 2, 1)


def seeded(seed: str, *parts: Column) -> Column:
    """Hex digest of the parts under a seed; nulls have a mark of their own."""
    return F.md5(F.concat_ws("|", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("\0")) for p in parts)).cast("binary"))


def draw(seed: str) -> Column:
    """The seeded order of rows: by id, of rows without id by text."""
    doc_id = F.col("doc_id")
    return F.when(doc_id.isNull(), seeded(seed, doc_id, F.col("text"))).otherwise(seeded(seed, doc_id))


def hex_long(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def sainte_lague(df: DataFrame, groups: list[str], key: str, votes: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: the seats of each ``key`` in its group by highest quotients.

    Rounding ``seats * share`` is within n/2 seats of the total, and shifting the
    divisor to mend that moves a member by at most ``n * share + 1``. Only
    quotients in that window are ranked: 8 rows per member at most, whatever
    the number of seats. Ties go to the smaller key. Members without votes get
    none.
    """
    of_group = Window.partitionBy(*(groups or [F.lit(0)]))
    near = (
        df.withColumn("_all", F.sum(votes).over(of_group))
        .withColumn("_share", F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(F.lit(0.0)))
        .withColumn("_mid", F.floor(F.col(seats) * F.col("_share") + 0.5))
        .withColumn("_slack", F.ceil(F.count(F.lit(1)).over(of_group) * F.col("_share")) + 2)
        .withColumn("_base", F.greatest(F.lit(0).cast("long"), F.col("_mid") - F.col("_slack")))
        .withColumn("_left", F.col(seats) - F.sum("_base").over(of_group))
    )
    ranked = (
        near.where((F.col(votes) > 0) & (F.col(seats) > 0))
        .select(*groups, key, "_left", F.col(votes).alias("_votes"), F.explode(F.sequence(F.col("_base") + 1, F.col("_mid") + F.col("_slack"))).alias("_k"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*(groups or [F.lit(0)])).orderBy((F.col("_votes") / (2 * F.col("_k") - 1)).desc(), key, "_k")))
        .where(F.col("_rank") <= F.col("_left"))
        .groupBy(*groups, key)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        near.join(ranked, [*groups, key], "left")
        .withColumn(out, F.when((F.col(votes) > 0) & (F.col(seats) > 0), F.col("_base") + F.coalesce(F.col("_won"), F.lit(0))).otherwise(F.lit(0)).cast("long"))
        .drop("_all", "_share", "_mid", "_slack", "_base", "_left", "_won")
    )


def source_targets(totals: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = 3) -> DataFrame:
    """Adds ``target`` to one row per source (``source, source_key, source_size``).

    Sources in code-point order take the weights in turn. With ``cap = max_repeat
    * size``, resharing every excess by weight ends at ``min(cap, level *
    weight)``. Sorted by ``cap / weight``, the level is the largest of ``(total -
    caps before) / (weights from here on)``. One row per source is all that the
    single window partition holds.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy("_ratio", "source_key")
    return (
        totals.withColumn("weight", weight)
        .withColumn("_cap", F.lit(float(max_repeat)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_before", F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap"))
        .withColumn("_from", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", F.max((F.col("_total") - F.col("_before")) / F.col("_from")).over(everything))
        .withColumn("target", F.least(F.col("_cap"), F.col("_level") * F.col("weight")))
        .drop("_cap", "_ratio", "_total", "_before", "_from", "_level")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: tuple = WEIGHTS,
    max_repeat: int = 3,
    block_words: int = 16,
    docs_per_shard: int = 4096,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``."""
    sized = settle(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("source_key"),
            n_words(F.col("text")).alias("size"),
            draw(seed).alias("_draw"),
        ),
        "mix",
    )
    totals = sized.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    block = F.lit(block_words).cast("long")
    sources = (
        source_targets(totals, weights, max_repeat)
        .withColumn("_seats", F.round(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / block).cast("long"))
        .withColumn("_shards", F.ceil(F.col("_docs") / docs_per_shard))
    )
    sources = settle(sainte_lague(sources, [], "source_key", "target", "_seats", "_blocks"), "mix-sources")
    placed = sized.join(sources.select("source_key", "source_size", "target", "_shards"), "source_key").withColumn("_shard", F.pmod(hex_long(F.col("_draw")), F.col("_shards")))
    shards = placed.groupBy("source_key", "_shard").agg(F.sum("size").alias("_words")).join(sources.select("source_key", "_blocks"), "source_key")
    quotas = sainte_lague(shards, ["source_key"], "_shard", "_words", "_blocks", "_quota").select(
        "source_key",
        "_shard",
        F.ceil(F.col("_words") / block).alias("_n"),
        "_quota",
    )
    quotas = quotas.where("_n > 0").withColumn("_quota", F.least(F.col("_quota"), max_repeat * F.col("_n")))
    quotas = quotas.select(
        "source_key",
        "_shard",
        "_n",
        F.expr("_quota div _n").alias("_times"),
        F.expr("_quota % _n").alias("_more"),
        F.pmod(hex_long(seeded(seed, F.col("source_key"), F.col("_shard"))), F.col("_n")).alias("_start"),
    )
    laid = Window.partitionBy("source_key", "_shard").orderBy("_draw", F.col("doc_id").asc_nulls_first(), "size")
    ends = placed.withColumn("_end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))

    def picked(j: str) -> str:
        return f"(({j}) * _more + _start) div _n"

    def words_before(x: str) -> str:
        j = f"({x} div {block_words})"
        return f"({block_words} * ({picked(j)}) + (({picked(j + ' + 1')}) - ({picked(j)})) * ({x} % {block_words}))"

    taken = F.expr(f"_times * size + {words_before('_end')} - {words_before('(_end - size)')}")
    return ends.join(quotas, ["source_key", "_shard"], "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
        "source",
    )
