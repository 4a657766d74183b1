"""The record operators in the SQL dialect of the checking engine.

Written apart from the DataFrame operators: other regular-expression dialect,
common table expressions instead of expressions per row.
"""

from __future__ import annotations

from kinloom.functions.text import CANONICAL, LEGAL_WORDS
from kinloom.plans.relations import with_views

SPACES = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WS = f"[{SPACES}]"
NOISE = f"[{SPACES}" + r"\-<>!@#$%\^*()\[\]{}|\\/+=~`''" + r'".,:;]'
LEGAL = "[" + ", ".join(f"'{w}'" for w in LEGAL_WORDS) + "]"


def clean(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{NOISE}+', ''), '{NOISE}+$', '')"


def strip_noise(c: str) -> str:
    return f"regexp_replace({clean(c)}, '{WS}+', ' ', 'g')"


def strip_space(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


def latin(c: str) -> str:
    return f"regexp_matches({c}, '\\p{{Latin}}')"


def lower_latin(c: str) -> str:
    return f"case when {latin(c)} then lower({c}) else {c} end"


def normal_name(c: str) -> str:
    return f"regexp_replace(replace({strip_noise(c)}, '-', ' '), '{WS}+', ' ', 'g')"


def words(c: str) -> str:
    cleaned = f"list_transform(string_split_regex({normal_name(c)}, '{WS}+'), lambda w: {clean('w')})"
    return f"list_transform(list_filter({cleaned}, lambda w: w <> ''), lambda w: {lower_latin('w')})"


def segment(c: str) -> str:
    return f"coalesce(list_filter(list_transform(string_split({c}, ','), lambda p: {strip_noise('p')}), lambda p: p <> '')[-1], '')"


def number(c: str) -> str:
    label = rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])No\.?{WS}*(\p{{Nd}}+)"
    return f"coalesce(nullif(regexp_extract({c}, '{label}', 1), ''), regexp_extract({c}, '\\p{{Nd}}+', 0))"


def soundex(c: str) -> str:
    """Of an ASCII word: H and W part nothing, vowels part equal digits."""
    upper = f"upper({c})"
    digits = f"translate(substring({upper}, 1, 1) || regexp_replace(substring({upper}, 2), '[HW]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"
    for d in "123456":
        digits = f"regexp_replace({digits}, '{d}+', '{d}', 'g')"
    return f"case when {c} = '' then '' else substring({upper}, 1, 1) || rpad(replace(substring({digits}, 2), '0', ''), 3, '0') end"


def canonical(c: str) -> str:
    spelled = " ".join(f"when '{k}' then '{v}'" for k, v in CANONICAL.items())
    landmark = r"(?i)^(?:near|opp\.?|opposite|behind|beside|next to)(?:[^\p{L}\p{N}_]|$)"
    word = f"case {clean('w')} {spelled} else case w {spelled} else {clean('w')} end end"
    kept = f"list_filter(list_transform(string_split({c}, ','), lambda p: {strip_noise('p')}), lambda p: p <> '' and not regexp_matches(p, '{landmark}'))"
    return f"array_to_string(list_transform({kept}, lambda p: array_to_string(list_transform(string_split_regex(lower(p), '{WS}+'), lambda w: {word}), ' ')), ', ')"


def parsed(name: str, source: str, stops: str = "") -> list[str]:
    """Views up to ``name``: per record the telling words ``sig`` and the other key parts.

    ``stops``: a view ``(token)`` of further stop words.
    """
    extra = f" || coalesce((select list(token) from {stops}), [])" if stops else ""
    return [
        f"""{name}_raw as (select r.*, {LEGAL}{extra} as stops, {words("coalesce(business_name, '')")} as w,
  {segment("coalesce(business_address, '')")} as seg0, {number("coalesce(business_address, '')")} as num,
  lower({strip_noise("coalesce(country, '')")}) as ctry from {source} r)""",
        f"""{name} as (select *, case when len(t) > 0 then t else w[1:1] end as sig, {lower_latin("seg0")} as seg
  from (select *, list_filter(w, lambda x: not list_contains(stops, lower(x))) as t from {name}_raw))""",
    ]


def frequent(name: str, source: str, threshold: int) -> list[str]:
    return [*parsed(f"{name}_p", source), f"{name} as (select sig[1] as token, count(*) as n from {name}_p where len(sig) > 0 group by 1 having count(*) > {threshold})"]


def keyed(name: str, source: str, keep: str) -> str:
    """A row per record of a parsed view and probe."""
    probes = (
        ("name", "substring(sig[1], 1, 3)", "len(sig) > 0"),
        ("nrev", "substring(sig[-1], 1, 3)", "len(sig) > 0"),
        ("city", "seg", "seg <> ''"),
        ("housenum", "num", "num <> ''"),
    )
    parts = [f"select {keep}, '{p}' as probe, ctry || '::{p}:' || {v} as key from {source} where {cond}" for p, v, cond in probes]
    parts.append(f"select {keep}, 'empty' as probe, ctry || '::empty' as key from {source} where len(sig) = 0 and seg = '' and num = ''")
    return f"{name} as (" + " union all ".join(parts) + ")"


def blocking(source: str = "er_part", row: str = "k", max_bucket: int = 100, city_cap: int = 40, sample: int = 10000, threshold: int = 50) -> list[str]:
    """Views ``fs, q, ix, sizes, kept, live, pairs``."""
    return [
        *with_views(source),
        f"s1 as (select * from {source} where src = 1)",
        f"others as (select * from {source} where src > 1 and entity_id <> '')",
        f"s1_head as (select * from s1 order by {row} limit {sample})",
        *frequent("fs", "s1_head", threshold),
        *parsed("qp", "s1", "fs"),
        *parsed("ip", "others", "fs"),
        keyed("q", "qp", f"{row}, entity_id"),
        keyed("ix", "ip", "src, entity_id"),
        "sizes as (select probe, key, count(*) filter (src = 2) as n2, count(*) filter (src = 3) as n3 from ix group by 1, 2)",
        f"eff as (select *, case when n2 <= {max_bucket} then n2 else 0 end as e2, case when n3 <= {max_bucket} then n3 else 0 end as e3 from sizes)",
        f"kept as (select * from eff where e2 + e3 between 1 and {max_bucket})",
        f"live as (select ix.* from ix join kept using (key) where (kept.probe <> 'city' or e2 + e3 <= {city_cap}) and ((src = 2 and e2 > 0) or (src = 3 and e3 > 0)))",
        f"pairs as (select distinct q.{row}, q.entity_id, live.entity_id as cand from q join live using (key) where live.entity_id <> q.entity_id)",
    ]


def lists(row: str = "k") -> str:
    return f"""lists as (select s1.{row}, s1.entity_id, coalesce(array_to_string(list_sort(p.ids), ','), '') as candidate_entity_ids, coalesce(len(p.ids), 0) as n
  from s1 left join (select {row}, list(distinct cand) as ids from pairs where cand like 'S2-%' or cand like 'S3-%' group by 1) p using ({row}))"""


def query(views: list[str], body: str) -> str:
    return ("with " + ",\n".join(views) + "\n" if views else "") + body
