"""Record relations derived from the driver's tables, as SQL for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Later views read earlier ones. The text runs on Spark SQL and on DuckDB alike.
VIEWS: dict[str, str] = {
    "er_part": """
select 1 as src, p_partkey as k, 'S1-'||cast(p_partkey as string) as entity_id,
  case when p_partkey%97=0 then 'The Company Ltd' when p_partkey%101=0 then ''
       else p_name||case p_partkey%3 when 0 then ' Inc' when 1 then ' Pvt Ltd' else '' end end as business_name,
  case when p_partkey%89=0 then '' else cast(p_partkey%400 as string)||' '||p_type||' Road, '||p_brand end as business_address,
  case when p_partkey%7=0 then ' France ' when p_partkey%2=0 then 'US' else 'India' end as country
from part
union all
select 2, p_partkey, 'S2-'||cast(p_partkey as string), '-- The '||upper(p_name)||' Corp.',
  '41 St, Door No '||cast(p_partkey%400 as string)||', '||p_type||' Rd, '||upper(p_brand)||'.',
  case when p_partkey%7=0 then 'FRANCE' when p_partkey%2=0 then 'us' else 'India' end
from part where p_partkey%4<>0
union all
select 2, p_partkey, 'S2-'||cast(p_partkey as string)||'b', p_name, p_type||' Road, '||p_brand,
  case when p_partkey%7=0 then 'France' when p_partkey%2=0 then 'US' else 'India' end
from part where p_partkey%5=0
union all
select 3, p_partkey, 'S3-'||cast(p_partkey as string), split_part(p_name,' ',2)||'-'||split_part(p_name,' ',1)||' LLC',
  p_type||' Road, '||p_brand||', ,',
  case when p_partkey%7=0 then 'France' when p_partkey%2=0 then 'US' else 'India' end
from part where p_partkey%3=0""",
    "er_run": """
select src, k, entity_id, case when k%61=0 then '"'||business_name||'" & Co' when k%67=0 then ' '||business_name else business_name end as business_name, business_address, country from er_part
union all
select src, k+1000000, case when k%100=0 then ' ' else '' end, business_name, business_address, country from er_part where k%50=0 and src<3
union all
select src, k+2000000, ' '||entity_id||' ', 'Other '||business_name, business_address, country from er_part where k%40=0 and src=1""",
    "er_run_named": """
select src, k, trim(entity_id) as entity_id, business_name, business_address, country from er_run where trim(entity_id) <> ''""",
    "er_doc": """
select cast(doc_id%3 + 1 as int) as src, doc_id as k,
  'S'||cast(doc_id%3 + 1 as string)||'-'||cast(doc_id as string) as entity_id,
  split_part(text,'.',1) as business_name,
  cast(n_chars as string)||' x, '||source as business_address,
  lang as country
from documents""",
    "er_lit": """
select cast(0 as int) as src, cast(k as bigint) as k, 'L-'||cast(k as string) as entity_id, business_name, business_address, country from (values
  (1, 'गंगा वस्त्र भंडार लिमिटेड', 'Plot NO. -27/4, PUNE CITY, Maharashtra', 'India'),
  (2, '-- Grelling Mill Inc Bakery', '88 OAK AVE, TULSA, OK', 'US'),
  (3, '<< Studio^Lumen.', '12 Rue des Lilas, Nantes, Pays-de-la-Loire', ' France'),
  (4, 'Pvt. Ltd.', '7 Quay, Flat NO.31, y', '(india)'),
  (5, 'ЗАО Берёза', 'Казань, ул. No7 3', 'RU'),
  (6, '&?_z&', 'Near Clock Tower, Old Market, Jaipur', 'India'),
  (7, '...', ', ,', '--'),
  (8, 'TK-Motoren LLC', '310-B Harbour St., Portland, ME', 'US'),
  (9, 'Éclat Öre GmbH', 'Shop No 64, 9Th Main Rd, Mysuru, Karnataka', 'France'),
  (10, '', '', ''),
  (11, cast(null as string), cast(null as string), cast(null as string))
) as t(k, business_name, business_address, country)""",
    "er_all": """
select * from er_part union all select src, k, 'D'||entity_id, business_name, business_address, country from er_doc union all select * from er_lit""",
    "er_truth": """
select p_partkey as k, 'S1-'||cast(p_partkey as string) as source1_entity_id,
  concat_ws(',', case when p_partkey%4<>0 then 'S2-'||cast(p_partkey as string) end,
                 case when p_partkey%5=0 then 'S2-'||cast(p_partkey as string)||'b' end,
                 case when p_partkey%3=0 then 'S3-'||cast(p_partkey as string) end) as matched_entity_ids
from part""",
    "er_pred": """
select source1_entity_id,
  case k%5
    when 1 then concat_ws(',', nullif(matched_entity_ids,''), 'S2-'||cast(k+1 as string))
    when 2 then ''
    else matched_entity_ids end as matched_entity_ids
from er_truth""",
    "er_sub": """
select source1_entity_id as s1,
  case k%50
    when 5 then 'S2-1,S2-1'
    when 6 then source1_entity_id||',S2-1'
    when 7 then 'X9-'||cast(k as string)||','
    when 8 then 'S2-none'||cast(k as string)
    else matched_entity_ids end as ids
from er_truth where k%50<>3
union all
select source1_entity_id, matched_entity_ids from er_truth where k%50=4
union all
select 'S1-extra'||cast(k as string), '' from er_truth where k%500=1""",
}
NEEDS = {"er_part": ("part",), "er_run": ("er_part",), "er_run_named": ("er_run",), "er_doc": ("documents",), "er_lit": (), "er_all": ("er_part", "er_doc", "er_lit"), "er_truth": ("part",), "er_pred": ("er_truth",), "er_sub": ("er_truth",)}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a derived relation."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    for other in NEEDS[name]:
        sql = sql.replace(f"from {other}", f"from {{{other}}}")
    return spark.sql(sql, **{other: relation(spark, sf_dir, other) for other in NEEDS[name]})


def with_views(*names: str) -> list[str]:
    """Common table expressions of the named relations and what they read, in order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name in VIEWS and name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return [f"{n} as ({VIEWS[n]})" for n in wanted]
