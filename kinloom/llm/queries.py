"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import apportion, arc_convert, chat_quotes, decontaminate, interpolated_lm, jaccard_join, license_scan, quality_fm, quality_ratio, secret_ledger
from kinloom.llm.common import fold, scratch, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score_quality(docs, quality_fm.fit_machine(docs, table(spark, sf_dir, "labels")))


def op3_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.reply_ordered(table(spark, sf_dir, "conversations"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_archive_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = arc_convert.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one stored ledger: a hundredth of the ids comes with the second, which scans that alone."""
    docs, path = table(spark, sf_dir, "documents"), scratch(spark, "ledger")
    secret_ledger.run_ledger(docs.where(fold(F.col("doc_id"), 100) != 0), path)
    return secret_ledger.findings_by_row(docs, secret_ledger.run_ledger(docs, path))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apportion.mix_sources(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = quality_ratio.fit_ratio(docs, table(spark, sf_dir, "labels"))
    return quality_ratio.judge_quality(docs, ratios).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score_texts(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = (
    op1_decontaminate,
    op2_factorisation_machine,
    op3_quotation_links,
    op4_jaccard_join,
    op5_archive_converter,
    op6_secret_ledger,
    op7_mix_sources,
    op8_quality_rules,
    op9_interpolated_lm,
    op10_license_scan,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


#: What the archives must say, from the pages alone.
ARCHIVES_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest, case when page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from p left join f using (payload_digest)
"""

#: The mixture, with every quotient listed and ranked instead of a window of them.
MIXTURE_SQL = r"""
with d as (
  select doc_id, source, coalesce('=' || source, 'null') as sk, md5('mix|' || coalesce(cast(doc_id as varchar), chr(0) || '|' || coalesce(text, chr(0)))) as draw,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
s0 as (select sk, any_value(source) as source, cast(sum(size) as bigint) as source_size, count(*) as docs from d group by sk),
s1 as (select *, 3.0 * source_size as cap, cast([5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3) + 1] as double) as weight,
    cast(sum(source_size) over () as double) as total, count(*) over () as n from s0),
s2 as (select *, max((total - lower_caps) / weights) over () as level from (
    select *, sum(cap) over (order by cap / weight, sk rows unbounded preceding) - cap as lower_caps,
      sum(weight) over (order by cap / weight, sk rows between current row and unbounded following) as weights from s1)),
s3 as (select *, least(cap, level * weight) as target, cast(round(total / 16) as bigint) as seats, cast(ceil(docs / 4096) as bigint) as shards from s2),
q as (select sk, seats, unnest(generate_series(1, cast(ceil(seats * target / total) as bigint) + n + 1)) as k, target from s3 where target > 0),
won as (select sk, count(*) as blocks from (select *, row_number() over (order by target / (2 * k - 1) desc, sk, k) as r from q) where r <= seats group by sk),
dd as (select d.*, source_size, target, shards, cast('0x' || substr(draw, 1, 12) as bigint) % shards as shard from d join s3 using (sk)),
h0 as (select sk, shard, cast(sum(size) as bigint) as words, count(*) over (partition by sk) as m, sum(sum(size)) over (partition by sk) as all_words from dd group by sk, shard),
hq as (select sk, shard, words, blocks, unnest(generate_series(1, cast(ceil(blocks * words / all_words) as bigint) + m + 1)) as k from h0 join won using (sk) where words > 0),
hw as (select sk, shard, count(*) as quota from (select *, row_number() over (partition by sk order by words / (2 * k - 1) desc, shard, k) as r from hq) where r <= blocks group by sk, shard),
h as (select sk, shard, nb, quota // nb as times, quota % nb as more, cast('0x' || substr(md5('mix|' || sk || '|' || cast(shard as varchar)), 1, 12) as bigint) % nb as start from (
    select sk, shard, cast(ceil(words / 16) as bigint) as nb, least(coalesce(quota, 0), 3 * cast(ceil(words / 16) as bigint)) as quota from h0 left join hw using (sk, shard) where words > 0)),
e as (select *, cast(sum(size) over (partition by sk, shard order by draw, doc_id, size rows unbounded preceding) as bigint) as b from dd),
x as (select e.*, h.*, b - size as a from e left join h using (sk, shard))
select doc_id, size, source_size, target, source, cast(coalesce(times * size
  + 16 * (((b // 16) * more + start) // nb) + ((((b // 16) + 1) * more + start) // nb - ((b // 16) * more + start) // nb) * (b % 16)
  - 16 * (((a // 16) * more + start) // nb) - ((((a // 16) + 1) * more + start) // nb - ((a // 16) * more + start) // nb) * (a % 16), 0) as bigint) as taken
from x
"""

#: The join by shared n-grams without any filter, and reachability over its links.
JACCARD_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, unnest(list_distinct(case when len(w) > 2 then list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [' ' || array_to_string(w, ' ')] else [] end)) as gram from d),
n as (select doc_id, count(*) as n from g group by 1),
c as (select a.doc_id as u, b.doc_id as v, count(*) as shared from g a join g b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2),
l as (select u, v from c join n x on x.doc_id = u join n y on y.doc_id = v where 100 * shared >= 90 * (x.n + y.n - shared)),
e as (select u, v from l union all select v, u from l),
r(a, b) as (select doc_id, doc_id from d union select r.a, e.v from r join e on r.b = e.u)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, coalesce(k.n_links, 0) as n_links
from d left join n using (doc_id) join (select a, min(b) as component_id from r group by a) m on m.a = d.doc_id
left join (select u, count(*) as n_links from e group by u) k on k.u = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the result; the other queries are tested by brute force."""
    return {"op4_jaccard_join": JACCARD_SQL, "op5_archive_converter": ARCHIVES_SQL, "op7_mix_sources": MIXTURE_SQL}
