"""Streaming adapter: records that arrive are probed against a static index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinloom.functions.keys import with_keys
from kinloom.operators import blocking as B


def probe_stream(records: DataFrame, index: DataFrame, stops: Iterable[str] = ()) -> DataFrame:
    """Stream-static join: ``entity_id, probe, key, cand`` per shared key.

    Stateless, so nothing is kept between batches; a candidate comes once per key.
    """
    asked = with_keys(records.where("entity_id <> ''"), stops, "entity_id")
    return asked.join(index.select("key", F.col("entity_id").alias("cand")), "key").where("cand <> entity_id").select("entity_id", "probe", "key", "cand")


def write_candidates(records: DataFrame, index: DataFrame, path: str, checkpoint: str, stops: Iterable[str] = (), row: str = "entity_id") -> StreamingQuery:
    """Candidate lists of each micro-batch as Parquet under ``path``, once per batch.

    A batch that runs again replaces its own folder.
    """

    def each(batch: DataFrame, number: int) -> None:
        lists = B.candidate_lists(batch, B.candidate_pairs(batch, index, stops), row)
        lists.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
