"""Probe keys of a record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.functions import text as T


def probe_keys(stops: Iterable[str] = ()) -> Column:
    """Array of ``(probe, key)`` structs, one to four, in a fixed order.

    Probes: ``name`` and ``nrev`` (first letters of the first and the last telling
    word), ``city`` (last address part), ``housenum``; ``empty`` where none
    of them has a value.
    """

    def build(row: Column) -> Column:
        def tagged(probe: str, value: Column) -> Column:
            return F.when(value != "", F.struct(F.lit(probe).alias("probe"), F.concat(row["c"], F.lit(f"::{probe}:"), value).alias("key")))

        found = F.array_compact(F.array(tagged("name", T.first_prefix(row["t"])), tagged("nrev", T.last_prefix(row["t"])), tagged("city", row["s"]), tagged("housenum", row["h"])))
        nothing = F.array(F.struct(F.lit("empty").alias("probe"), F.concat(row["c"], F.lit("::empty")).alias("key")))
        return T.let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(nothing))

    parts = F.struct(
        T.country_label("country").alias("c"),
        T.significant_tokens("business_name", stops).alias("t"),
        T.last_segment("business_address").alias("s"),
        T.house_number("business_address").alias("h"),
    )
    return T.let(parts, build)


def with_keys(records: DataFrame, stops: Iterable[str] = (), *keep: str) -> DataFrame:
    """One row per record and probe: the kept columns, ``probe`` and ``key``."""
    return records.select(*keep, F.inline(probe_keys(stops)))
