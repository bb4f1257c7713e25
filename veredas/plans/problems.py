"""The general problems' queries over the provided tables, and SQL for the same results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veredas.operators.components import connected_groups, shared_member_edges
from veredas.operators.snapshots import snapshot_changes
from veredas.operators.timestamps import normalise_timestamps
from veredas.session import load

REGISTRY_FIELDS = [
    "zone_name", "zone_class", "user_type", "department", "municipality", "declaratory_resolution", "extension_resolution", "ciiu",
]


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_timestamps(load(spark, sf_dir, "raw_items"), load(spark, sf_dir, "source_clock"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills and clusters in one graph: keys of the two kinds never meet."""
    key = lambda kind, c: F.concat(F.lit(f"{kind}|"), c)
    bills = load(spark, sf_dir, "bill_matches").select(
        key("bill", F.col("left_bill_id")).alias("a"), key("bill", F.col("right_bill_id")).alias("b")
    )
    members = (
        load(spark, sf_dir, "clusters")
        .select("cluster_id", F.explode(F.arrays_zip("member_source_ids", "items")).alias("m"))
        .where("m.member_source_ids is not null and m.items is not null")
        .select(key("cluster", F.col("cluster_id")).alias("record"), F.struct("m.member_source_ids", "m.items").alias("member"))
    )
    groups = connected_groups(bills.unionByName(shared_member_edges(members, "record", "member")), "a", "b")
    kind = F.substring_index("record_key", "|", 1)
    bare = lambda c: F.expr(f"substr({c}, instr({c}, '|') + 1)")
    return groups.select(kind.alias("kind"), bare("record_key").alias("record_key"), bare("group_key").alias("group_key"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    nit = F.nullif(F.left(F.regexp_replace("nit", "[^0-9]", ""), F.lit(9)), F.lit(""))
    changes = snapshot_changes(
        load(spark, sf_dir, "zona_franca_records"),
        snapshot="snapshot_date",
        key=nit,
        fields=REGISTRY_FIELDS,
        version=[F.col("loaded_at")],
        labels=("new_registry_row", "removed_registry_row", "updated_registry_row"),
    )
    return changes.select(
        F.col("snapshot").alias("snapshot_date"), F.col("record_key").alias("nit"), F.col("change").alias("change_type"), "changed_fields"
    )


QUERIES = {"p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found}

P6_SQL = """
with recursive member as (
  select cluster_id, unnest(member_source_ids) as s, unnest(items) as i from clusters
), links as (
  select distinct 'bill' as kind, left_bill_id as a, right_bill_id as b from bill_matches
  where left_bill_id is not null and right_bill_id is not null and left_bill_id <> right_bill_id
  union
  select distinct 'cluster', x.cluster_id, y.cluster_id from member x join member y
  on x.s = y.s and x.i = y.i and x.cluster_id <> y.cluster_id
), both_ways as (
  select kind, a, b from links union select kind, b, a from links
), reach as (
  select kind, a as record_key, a as other from both_ways
  union
  select r.kind, r.record_key, e.b from reach r join both_ways e on r.kind = e.kind and r.other = e.a
)
select kind, record_key, min(other) as group_key from reach group by kind, record_key
"""

_FORM = "lower(trim(regexp_replace(coalesce({0}, ''), '\\s+', ' ', 'g')))"
_FORMS = ", ".join(f"{_FORM.format(f)} as {f}" for f in REGISTRY_FIELDS)
_DIFFER = ", ".join(f"case when a.{f} <> b.{f} then '{f}' end" for f in sorted(REGISTRY_FIELDS))
P7_SQL = f"""
with picked as (
  select snapshot_date, nullif(left(regexp_replace(nit, '[^0-9]', '', 'g'), 9), '') as nit, loaded_at, {_FORMS}
  from zona_franca_records where snapshot_date is not null
), latest as (
  select * from picked where nit is not null
  qualify row_number() over (partition by snapshot_date, nit order by loaded_at desc nulls last) = 1
), calendar as (
  select d as snapshot_date, lead(d) over (order by d) as next_date from (select distinct snapshot_date as d from picked)
), pairs as (
  select c.next_date, a.nit as old_nit, b.nit as new_nit, concat_ws(',', {_DIFFER}) as changed
  from calendar c join latest a on a.snapshot_date = c.snapshot_date
  left join latest b on b.snapshot_date = c.next_date and b.nit = a.nit where c.next_date is not null
)
select next_date as snapshot_date, old_nit as nit,
  case when new_nit is null then 'removed_registry_row' else 'updated_registry_row' end as change_type,
  case when new_nit is null then '' else changed end as changed_fields
from pairs where new_nit is null or changed <> ''
union all
select c.next_date, b.nit, 'new_registry_row', '' from calendar c join latest b on b.snapshot_date = c.next_date
where not exists (select 1 from latest a where a.snapshot_date = c.snapshot_date and a.nit = b.nit)
"""

ORACLES = {"p6_found": P6_SQL, "p7_found": P7_SQL}
