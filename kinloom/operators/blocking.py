"""Blocking: stop words, index, caps and candidates.

The index stays in long form, a row per key and record, so no bucket is ever an array
and sizes are partial aggregates. Caps are semantic: they are applied to the index
before the join and so bound its fan-out.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.functions import text as T
from kinloom.functions.keys import with_keys
from kinloom.storage import settle

PROBES = ("name", "nrev", "city", "housenum", "empty")
MAX_BUCKET, CITY_CAP, STOP_THRESHOLD, STOP_SAMPLE = 500, 80, 50, 10_000
#: Queries and ids of a cell and pairs of a task in ``all_pairs``: how the work is dealt, no cap.
CELL, WIDE, TASK_PAIRS = 1024, 8192, 1 << 24


def first_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows by an ordinal; 0 means all."""
    return df.orderBy(order).limit(n) if n else df


def spread(records: DataFrame) -> DataFrame:
    """The same rows over as many tasks as there are cores or shuffle partitions: small files are read by one."""
    spark = records.sparkSession
    return records.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def frequent_words(records: DataFrame, threshold: int = STOP_THRESHOLD) -> DataFrame:
    """``token, n``: words that come first in more than ``threshold`` names."""
    first = records.select(F.get(T.significant_tokens("business_name"), F.lit(0)).alias("token"))
    return first.where("token is not null").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)


def stop_words(records: DataFrame, order: str | None = None, sample: int = STOP_SAMPLE, threshold: int = STOP_THRESHOLD) -> list[str]:
    """Frequent words of the first ``sample`` rows: ``sample / threshold`` at most."""
    rows = first_rows(records, sample, order) if order else records
    return sorted(r.token for r in frequent_words(rows, threshold).select("token").collect())


def index_entries(records: DataFrame, stops: Iterable[str] = ()) -> DataFrame:
    """``probe, key, src, entity_id`` per key of each record with an id."""
    named = records.withColumn("entity_id", T.strip_space("entity_id")).where("entity_id <> ''")
    return with_keys(named, stops, "src", "entity_id")


def bucket_sizes(entries: DataFrame) -> DataFrame:
    """``probe, key, n2, n3``: rows, not distinct ids, per source.

    A key names its probe, so it is grouped by the key alone and meets the index on the same partitions.
    """
    return entries.groupBy("key").agg(F.min("probe").alias("probe"), F.count_if(F.col("src") == 2).alias("n2"), F.count_if(F.col("src") == 3).alias("n3")).select("probe", "key", "n2", "n3")


def capped_sizes(sizes: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Keys that survive the cap per source and again after merging.

    A source over the cap loses its part of a key alone; what is left of
    both must fit the cap together.
    """
    part = lambda n: F.when(F.col(n) <= max_bucket, F.col(n)).otherwise(F.lit(0))
    kept = sizes.select("probe", "key", part("n2").alias("e2"), part("n3").alias("e3")).withColumn("size", F.col("e2") + F.col("e3"))
    return kept.where((F.col("size") > 0) & (F.col("size") <= max_bucket))


def capped_index(entries: DataFrame, max_bucket: int = MAX_BUCKET, city_cap: int | None = CITY_CAP, sizes: DataFrame | None = None) -> DataFrame:
    """Index rows that can still give candidates.

    City buckets over ``city_cap`` add nothing that a stronger probe has not, so
    they leave the index before the join.
    """
    keys = capped_sizes(bucket_sizes(entries) if sizes is None else sizes, max_bucket)
    if city_cap is not None:
        keys = keys.where((F.col("probe") != "city") | (F.col("size") <= city_cap))
    live = entries.join(keys.drop("probe"), "key")
    return live.where(F.when(F.col("src") == 2, F.col("e2") > 0).otherwise(F.col("e3") > 0)).select("probe", "key", "src", "entity_id")


def source_keys(sizes: DataFrame, column: str, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Keys of one source (``n2`` or ``n3``) that its own cap leaves."""
    return sizes.where(F.col(column).between(1, max_bucket)).select("probe", "key", column)


def dropped_keys(sizes: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row: keys kept and dropped per source, and by the merged cap."""
    e2 = F.when(F.col("n2") <= max_bucket, F.col("n2")).otherwise(F.lit(0))
    e3 = F.when(F.col("n3") <= max_bucket, F.col("n3")).otherwise(F.lit(0))
    return sizes.agg(
        F.count_if(F.col("n2") > 0).alias("keys_s2"),
        F.count_if(F.col("n3") > 0).alias("keys_s3"),
        F.count_if(F.col("n2") > max_bucket).alias("dropped_s2"),
        F.count_if(F.col("n3") > max_bucket).alias("dropped_s3"),
        F.count_if(e2 + e3 > max_bucket).alias("dropped_merged"),
        F.count_if((e2 + e3 > 0) & (e2 + e3 <= max_bucket)).alias("keys_kept"),
    )


def candidate_pairs(queries: DataFrame, index: DataFrame, stops: Iterable[str] = (), *keep: str) -> DataFrame:
    """Distinct ``keep..., entity_id, cand`` over all shared keys, never the record itself."""
    keep = keep or ("entity_id",)
    asked = with_keys(queries.withColumn("entity_id", T.strip_space("entity_id")).where("entity_id <> ''"), stops, *keep).drop("probe")
    found = asked.join(index.select("key", F.col("entity_id").alias("cand")), "key")
    return found.where("cand <> entity_id").select(*keep, "cand").distinct()


def _key_sets(entries: DataFrame, *ids: str) -> DataFrame:
    """``ids..., many, no, key`` and a column per probe: a row per id and key.

    An id with one key per probe at most has its whole key set in every row. One with more
    (several records) is ``many``: its keys stand alone, so its pairs may come repeatedly.
    """
    per_id = entries.groupBy(*ids).agg(F.collect_set(F.struct("probe", "key")).alias("keys"))
    many = F.size("keys") > F.size(F.array_distinct("keys.probe"))
    of = lambda p: F.get(F.filter("keys", lambda x: x["probe"] == p), F.lit(0))["key"]
    told = per_id.select(*ids, "keys", many.alias("many"), *(F.when(~many, of(p)).alias(p) for p in PROBES))
    rows = told.select(*ids, "many", *PROBES, F.inline("keys"))
    return rows.select(*ids, "many", F.array_position(F.lit(list(PROBES)), F.col("probe")).alias("no"), "key", *PROBES)


def _sides(queries: DataFrame, index: DataFrame, stops: Iterable[str], keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame, bool]:
    """Key sets of queries and of the index, kept as tables, and whether any id is ``many``."""
    named = queries.withColumn("entity_id", T.strip_space("entity_id")).where("entity_id <> ''")
    asked = settle(_key_sets(with_keys(spread(named), stops, *keep), *keep), "asked")
    held = settle(_key_sets(index.select("probe", "key", F.col("entity_id").alias("cand")), "cand"), "held")
    return asked, held, not asked.select("many").union(held.select("many")).where("many").isEmpty()


def _meet(asked: DataFrame, held: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``keep..., cand`` for every shared key that no earlier probe shares as well.

    The index side holds an array of ids per key and keys of the earlier probes, so what earlier
    probes share is compared once per query and array; a pair costs the step to the next
    element. Keys with more than ``CELL`` queries or ``WIDE`` ids are dealt over a grid of cells, so
    that no task holds a whole bucket; each pair of rows meets in one cell.
    """
    count = lambda df, n: df.groupBy("key").agg(F.count(F.lit(1)).alias(n))
    sizes = settle(count(asked, "n_asked").join(count(held, "n_held"), "key"), "sizes")
    total = sizes.agg(F.sum(F.col("n_asked") * F.col("n_held")).alias("n")).first().n or 0
    tasks = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_PAIRS))
    parts = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    # At most a CELL-th of the rows of either side.
    large = F.broadcast(sizes.where((F.col("n_asked") > CELL) | (F.col("n_held") > WIDE)).select("key", parts("n_asked", CELL).alias("_a"), parts("n_held", WIDE).alias("_b")))
    earlier = PROBES[:-1]
    at = lambda cells, *ids: F.pmod(F.xxhash64(*ids), F.coalesce(cells, F.lit(1))).cast("int")
    each = lambda cells: F.explode(F.sequence(F.lit(0), F.coalesce(cells, F.lit(1)) - 1))
    left = asked.join(large, "key", "left").select(*keep, "key", *earlier, at("_a", *keep).alias("_i"), each("_b").alias("_j"))
    told = [F.when(F.col("no") > i, F.col(p)).alias(p) for i, p in enumerate(earlier, 1)]
    arrays = held.join(large, "key", "left").select("cand", "key", *told, at("_b", "cand").alias("_j"), "_a").groupBy("key", *earlier, "_j", "_a").agg(F.collect_list("cand").alias("cands"))
    right = arrays.select("key", *earlier, "cands", "_j", each("_a").alias("_i"))
    left, right = (df.repartition(tasks, "key", "_i", "_j").alias(n) for df, n in ((left, "l"), (right, "r")))
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "_i", "_j")]
    first = [F.coalesce(F.col(f"l.{p}") != F.col(f"r.{p}"), F.lit(True)) for p in earlier]
    met = left.join(right.hint("merge"), reduce(lambda x, y: x & y, [*same, *first]))
    return met.select(*(f"l.{c}" for c in keep), F.explode("r.cands").alias("cand")).where("cand <> entity_id")


def all_pairs(queries: DataFrame, index: DataFrame, stops: Iterable[str] = (), *keep: str) -> DataFrame:
    """The rows of ``candidate_pairs`` for buckets of any size.

    A pair is made at the first probe that it shares, so pairs are neither shuffled nor made
    distinct; only those of ids with several records are. The result itself grows with the squares
    of the buckets, where ``pair_counts`` says what it adds up to.
    """
    keep = keep or ("entity_id",)
    asked, held, many = _sides(queries, index, stops, keep)
    pairs = _meet(asked.where("not many"), held.where("not many"), keep)
    return pairs.unionByName(_many_pairs(asked, held, keep)) if many else pairs


def _many_pairs(asked: DataFrame, held: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Distinct pairs with a ``many`` id on either side."""
    return _meet(asked.where("many"), held, keep).unionByName(_meet(asked.where("not many"), held.where("many"), keep)).distinct()


def pair_counts(queries: DataFrame, index: DataFrame, stops: Iterable[str] = (), *keep: str) -> DataFrame:
    """``entity_id, n, first_cand, last_cand`` over the rows of ``all_pairs``, without making them.

    The ids that share any key with a query are those of its key sets, by inclusion and exclusion
    (see ``self_counts``): 15 rows an id on either side. Only pairs of ids with several
    records are made.
    """
    keep = keep or ("entity_id",)
    asked, held, many = _sides(queries, index, stops, keep)
    sets = [c for k in range(1, len(PROBES) + 1) for c in combinations(PROBES, k)]
    agreed = F.array_compact(F.array(*(F.when(reduce(lambda x, y: x & y, (F.col(p).isNotNull() for p in c)), F.struct(F.lit(len(c)).alias("probes"), F.concat_ws("\x1f", *c).alias("keys"))) for c in sets)))
    same = ["probes", "keys"]
    whole = lambda df, *ids: df.where("not many").select(*ids, *PROBES).distinct().select(*ids, F.inline(agreed))
    rows = settle(whole(held, "cand"), "sets")
    ends = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("size"), F.min("cand").alias("low"), F.max("cand").alias("high"))
    # The ends but one, for queries that are in the index themselves.
    inner = rows.where("probes = 1").join(ends, same).groupBy(*same).agg(F.min(F.when(F.col("cand") != F.col("low"), F.col("cand"))).alias("low2"), F.max(F.when(F.col("cand") != F.col("high"), F.col("cand"))).alias("high2"))
    own = rows.select(F.col("cand").alias("entity_id"), *same, F.lit(1).alias("own"))
    told = whole(asked, *keep).join(ends.join(inner, same, "left"), same).join(own, ["entity_id", *same], "left")
    size = F.col("size") - F.coalesce("own", F.lit(0))
    other = lambda end: F.when(F.col("probes") == 1, F.when(F.col("entity_id") != F.col(end), F.col(end)).otherwise(F.col(f"{end}2")))
    found = told.groupBy("entity_id").agg(F.sum(F.when(F.col("probes") % 2 == 1, size).otherwise(-size)).alias("n"), F.min(other("low")).alias("first_cand"), F.max(other("high")).alias("last_cand")).where("n > 0")
    if many:
        rest = _many_pairs(asked, held, keep).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), F.min("cand").alias("first_cand"), F.max("cand").alias("last_cand"))
        found = found.unionByName(rest).groupBy("entity_id").agg(F.sum("n").alias("n"), F.min("first_cand").alias("first_cand"), F.max("last_cand").alias("last_cand"))
    return found


def _live_entries(records: DataFrame, stops: Iterable[str], city_cap: int, max_bucket: int | None) -> DataFrame:
    """``entity_id, probe, key`` within a relation, caps applied."""
    entries = settle(with_keys(records, stops, "entity_id"), "entries")
    kept = entries.groupBy("key").agg(F.min("probe").alias("probe"), F.count(F.lit(1)).alias("size")).where((F.col("probe") != "city") | (F.col("size") <= city_cap))
    if max_bucket is not None:
        kept = kept.where(F.col("size") <= max_bucket)
    return entries.join(kept.select("key"), "key")


def self_pairs(records: DataFrame, stops: Iterable[str] = (), city_cap: int = CITY_CAP, max_bucket: int | None = MAX_BUCKET) -> DataFrame:
    """Distinct pairs ``a < b`` of ids of a relation that share a key.

    A bucket holds ``max_bucket`` records at most, so the join is linear in the records.
    ``None`` lifts that cap; the pairs then grow with the squares of the buckets, where
    ``self_counts`` says what they add up to without making them.
    """
    live = _live_entries(records, stops, city_cap, max_bucket).select("key", "entity_id").distinct()
    both = live.select("key", F.col("entity_id").alias("a")).join(live.select("key", F.col("entity_id").alias("b")), "key")
    return both.where("a < b").select("a", "b").distinct()


def self_counts(records: DataFrame, stops: Iterable[str] = (), city_cap: int = CITY_CAP, max_bucket: int | None = None) -> DataFrame:
    """``entity_id, n, first_cand, last_cand``: how many others share a key, the least and the greatest.

    No pair is made. A record has one key per probe at most, so the records that share
    any key with it are those of all its key sets, by inclusion and exclusion:
    those that agree on a probe, less those that agree on two, and so on. That is
    15 rows a record, summed map-side, whatever the buckets hold. Ids are taken to name one
    record each; where one has several sets of keys, the pairs are counted instead.
    """
    live = settle(_live_entries(records, stops, city_cap, max_bucket), "live")
    of_one = live.distinct().groupBy("entity_id")
    wide = of_one.agg(*(F.max(F.when(F.col("probe") == p, F.col("key"))).alias(p) for p in PROBES), F.count(F.lit(1)).alias("_keys"), F.count_distinct("probe").alias("_probes"))
    if not wide.where("_keys > _probes").isEmpty():
        pairs = self_pairs(records, stops, city_cap, max_bucket)
        ends = pairs.select(F.col("a").alias("entity_id"), F.col("b").alias("cand")).unionByName(pairs.select(F.col("b").alias("entity_id"), F.col("a").alias("cand")))
        return ends.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), F.min("cand").alias("first_cand"), F.max("cand").alias("last_cand"))
    sets = [c for k in range(1, len(PROBES) + 1) for c in combinations(PROBES, k) if k == 1 or "empty" not in c]
    agreed = F.array_compact(F.array(*(F.when(reduce(lambda x, y: x & y, (F.col(p).isNotNull() for p in c)), F.struct(F.lit(len(c)).alias("probes"), F.xxhash64(*c).alias("h"), F.concat_ws("\x1f", *c).alias("keys"))) for c in sets)))
    rows = wide.select("entity_id", F.inline(agreed))
    same = ["probes", "h", "keys"]
    ends = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("size"), F.min("entity_id").alias("low"), F.max("entity_id").alias("high"))
    told = rows.join(ends.where("size > 1"), same)
    single = F.col("probes") == 1
    inner = told.where(single).groupBy(*same).agg(F.min(F.when(F.col("entity_id") != F.col("low"), F.col("entity_id"))).alias("low2"), F.max(F.when(F.col("entity_id") != F.col("high"), F.col("entity_id"))).alias("high2"))
    told = told.join(inner, same, "left")
    other = lambda end: F.when(single, F.when(F.col("entity_id") != F.col(end), F.col(end)).otherwise(F.col(f"{end}2")))
    sign = F.when(F.col("probes") % 2 == 1, 1).otherwise(-1)
    return told.groupBy("entity_id").agg(F.sum(sign * (F.col("size") - 1)).alias("n"), F.min(other("low")).alias("first_cand"), F.max(other("high")).alias("last_cand"))


def candidate_lists(queries: DataFrame, pairs: DataFrame, row: str) -> DataFrame:
    """``row, entity_id, candidate_entity_ids, n`` for every query row with an id.

    Grouped by the row, so repeated ids stay rows of their own; ids of other
    sources than S2 and S3 are left out here, after they counted for the caps.
    """
    wanted = pairs.where(F.col("cand").startswith("S2-") | F.col("cand").startswith("S3-"))
    lists = wanted.groupBy(row).agg(F.collect_set("cand").alias("ids"))
    told = list(dict.fromkeys([row, "entity_id"]))
    named = queries.withColumn("entity_id", T.strip_space("entity_id")).where("entity_id <> ''").select(*told)
    return named.join(lists, row, "left").select(*told, F.coalesce(T.encode_ids(F.col("ids")), F.lit("")).alias("candidate_entity_ids"), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n"))


def run_stats(queries: DataFrame, lists: DataFrame) -> DataFrame:
    """One row: rows written, candidates (sum, mean, most) and rows without id."""
    errors = queries.agg(F.count_if(T.strip_space("entity_id") == "").alias("errors"))
    seen = lists.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    return seen.join(errors, F.lit(True))
