"""The reference's data-processing operators over the provided tables, each with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veredas.functions.items import (
    ACTS,
    CITED,
    NUMBER_WORDS,
    STOPWORDS,
    jaccard,
    legal_acts,
    number_in_series,
    number_in_text,
    title_tokens,
    truncate_summary,
)
from veredas.functions.text import collapse_spaces, fold
from veredas.functions.url import canonical_url
from veredas.operators.components import connected_groups
from veredas.operators.dedupe import dedupe_two_stage, first_by_key
from veredas.operators.matching import jaccard_classes, jaccard_pairs, shared_tag_edges
from veredas.operators.ranking import diversified_top, quota_sample, top_per_group
from veredas.operators.series import asof_join, carry_forward, trailing_streak
from veredas.session import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def money(name: str) -> Column:
    """Exact sums: doubles as decimals of four places."""
    return F.col(name).cast("decimal(18,4)")


# Shared SQL expressions.
def sql_url(u: str) -> str:
    query_part = f"regexp_extract({u}, '\\?([^#]*)', 1)"
    params = (
        f"list_sort(list_filter(string_split({query_part}, '&'), lambda x: regexp_matches(x, '=.') and not "
        "regexp_matches(lower(x), '^(utm_[^=]*|fbclid|gclid|mc_cid|mc_eid|ref|ref_src)=')))"
    )
    path = f"regexp_extract({u}, '^[^:]+://[^/?#]*([^?#]*)', 1)"
    return (
        f"case when trim({u}) = '' then null else lower(regexp_extract({u}, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract({u}, "
        f"'^[^:]+://([^/?#]*)', 1)) || case when length({path}) > 1 then rtrim({path}, '/') else '/' end || "
        f"case when len({params}) > 0 then '?' || array_to_string({params}, '&') else '' end end"
    )


def sql_tokens(t: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return (
        f"list_sort(list_distinct(list_filter(regexp_extract_all(strip_accents(lower(coalesce({t}, ''))), '[\\p{{L}}\\p{{N}}]+'), "
        f"lambda x: length(x) > 2 and not list_contains([{stop}], x))))"
    )


SQL_FORM = "trim(regexp_replace(strip_accents(lower({0})), '\\s+', ' ', 'g'))"


@query(f"select pos, {sql_url('url')} as url_key from raw_items where url is not null")
def canonical_url_keys(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "raw_items").where("url is not null").select("pos", canonical_url(F.col("url")).alias("url_key"))


@query(f"""
with k as (
  select pos, title, trust_role in ('official_signal', 'resolution_source') as trusted, {sql_url('url')} as u,
    source_id || ':' || {SQL_FORM.format("coalesce(title, '')")} as t
  from cleaned_items
), one as (
  select *, coalesce(u, '__no_url__:' || t) as key from k
), two as (
  select *, min(pos) over (partition by key) as slot_pos from one
  qualify row_number() over (partition by key order by trusted desc, pos) = 1
)
select pos, slot_pos, title from two qualify row_number() over (partition by t order by slot_pos) = 1
""")
def dedupe_items(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").select("pos", "title", "url", "source_id", "trust_role")
    title = F.concat(F.col("source_id"), F.lit(":"), collapse_spaces(fold(F.coalesce("title", F.lit("")))))
    trust = F.when(F.col("trust_role").isin("official_signal", "resolution_source"), 1).otherwise(0)
    return dedupe_two_stage(items, canonical_url(F.col("url")), title, trust).select("pos", "slot_pos", "title")


@query(f"""
select min(pos) as pos, k as url_key from (select pos, {sql_url('url')} as k from raw_items where url is not null) where k is not null group by k
""")
def first_by_url(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "raw_items").where("url is not null").select("pos", canonical_url(F.col("url")).alias("url_key"))
    return first_by_key(rows, F.col("url_key"), [F.col("pos")])


@query("""
select pos, concat_ws(',', case when trim(coalesce(title, '')) = '' then 'low_quality:no_title' end,
  case when length(trim(regexp_replace(coalesce(clean_text, ''), '\\s+', ' ', 'g'))) < 40 then 'low_quality:short_text' end,
  case when json_extract_string(try_cast(metadata as json), '$.attempt') <> '1' then 'low_quality:retried' end) as notes
from cleaned_items
""")
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    text = collapse_spaces(F.coalesce("clean_text", F.lit("")))
    notes = F.concat_ws(
        ",",
        F.when(F.trim(F.coalesce("title", F.lit(""))) == "", "low_quality:no_title"),
        F.when(F.length(text) < 40, "low_quality:short_text"),
        F.when(F.get_json_object("metadata", "$.attempt") != "1", "low_quality:retried"),
    )
    return load(spark, sf, "cleaned_items").select("pos", notes.alias("notes"))


@query("""
with t as (
  select pos, clean_text, substring(clean_text, 1, 280) as cut, 280 - instr(reverse(substring(clean_text, 1, 280)), ' ') as space
  from cleaned_items where clean_text is not null
)
select pos, case when length(clean_text) <= 280 then clean_text else
  rtrim(case when instr(cut, ' ') > 0 and space >= 168 then substring(cut, 1, space) else cut end, ' ,.;:-') || '…' end as summary from t
""")
def summaries(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").where("clean_text is not null")
    return items.select("pos", truncate_summary(F.col("clean_text")).alias("summary"))


@query(f"select pos, array_to_string({sql_tokens('title')}, ' ') as tokens from cleaned_items")
def title_token_sets(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "cleaned_items").select("pos", F.array_join(title_tokens(F.col("title")), " ").alias("tokens"))


@query(f"""
with t as (select run_date, unnest({sql_tokens('title')}) as token from cleaned_items), n as (
  select run_date, token, count(*) as items from t group by all
)
select run_date, token, items, row_number() over (partition by run_date order by items desc, token) as place from n
qualify place <= 5
""")
def top_keywords(spark: SparkSession, sf: str) -> DataFrame:
    tokens = load(spark, sf, "cleaned_items").select("run_date", F.explode(title_tokens(F.col("title"))).alias("token"))
    counts = tokens.groupBy("run_date", "token").agg(F.count("*").alias("items"))
    return top_per_group(counts, ["run_date"], [F.desc("items"), F.asc("token")], 5, "place")


SQL_TITLE_CLASSES = f"""
s as (select pos, {sql_tokens('title')} as tokens from cleaned_items), c as (
  select min(pos) as leader, tokens from s where len(tokens) > 0 group by tokens
), p as (
  select a.leader as a, b.leader as b, len(list_intersect(a.tokens, b.tokens)) as n, len(a.tokens) + len(b.tokens) as m
  from c a join c b on a.leader < b.leader
), e as (select a, b from p where n >= 0.4 * (m - n) - 1e-9)
"""


@query(f"with {SQL_TITLE_CLASSES} select a, b from e")
def title_jaccard_pairs(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").select("pos", title_tokens(F.col("title")).alias("tokens"))
    classes = jaccard_classes(items, "pos", "tokens")
    leaders = classes.where("pos = leader").select("pos", "tokens")
    return jaccard_pairs(leaders, "pos", 0.4)


def title_groups(spark: SparkSession, sf: str) -> DataFrame:
    """(pos, group_pos): items whose titles are linked by Jaccard of 0.4 or more, directly or not; single items are their own group."""
    items = load(spark, sf, "cleaned_items").select("pos", title_tokens(F.col("title")).alias("tokens"))
    classes = jaccard_classes(items, "pos", "tokens")
    leaders = classes.where("pos = leader").select("pos", "tokens")
    # Fixed width, so that text order is number order.
    key = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    edges = jaccard_pairs(leaders, "pos", 0.4).select(key("a").alias("a"), key("b").alias("b"))
    groups = connected_groups(edges, "a", "b").select(
        F.col("record_key").cast("long").alias("leader"), F.col("group_key").cast("long").alias("g")
    )
    member = items.select("pos").join(classes.select("pos", "leader"), "pos", "left").join(groups, "leader", "left")
    return member.select("pos", F.coalesce("g", "leader", "pos").alias("group_pos"))


SQL_TITLE_GROUPS = f"""
{SQL_TITLE_CLASSES}, w as (select a, b from e union select b, a from e), r as (
  select leader as x, leader as y from c union select r.x, w.b from r join w on r.y = w.a
), g as (select x as leader, min(y) as g from r group by x), m as (
  select s.pos, coalesce(g.g, s.pos) as group_pos from s left join c on c.tokens = s.tokens left join g on g.leader = c.leader
)
"""


@query(f"""with recursive {SQL_TITLE_GROUPS}
select 'c-' || left(sha1(cast(sum(cast('0x' || left(md5(i.id || ':' || i.pos), 15) as bigint)) as varchar)), 10) as cluster_id, count(*) as items,
  count(distinct source_id) as source_count, max(m.group_pos) as group_pos,
  arg_max(coalesce(title, ''), (length(coalesce(title, '')), coalesce(title, ''))) as title,
  case when count(distinct source_id) >= 3 or count(*) >= 5 then 'high' when count(distinct source_id) >= 2 or count(*) >= 2
    then 'medium' else 'low' end as confidence
from m join cleaned_items i using (pos) group by m.group_pos
""")
def title_clusters(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").select("pos", "id", "source_id", F.coalesce("title", F.lit("")).alias("title"))
    joined = title_groups(spark, sf).join(items, "pos")
    # The id of a group must not depend on the order of its members, and a group may be large: their hashes are added up.
    member = F.conv(F.left(F.md5(F.concat_ws(":", "id", "pos")), F.lit(15)), 16, 10).cast("decimal(20,0)")
    grouped = joined.groupBy("group_pos").agg(
        F.sum(member).alias("members"),
        F.count("*").alias("items"),
        F.count_distinct("source_id").alias("source_count"),
        F.max(F.struct(F.length("title").alias("n"), F.col("title").alias("t"))).alias("best"),
    )
    high, medium = (F.col("source_count") >= 3) | (F.col("items") >= 5), (F.col("source_count") >= 2) | (F.col("items") >= 2)
    return grouped.select(
        F.concat(F.lit("c-"), F.left(F.sha1(F.col("members").cast("string")), F.lit(10))).alias("cluster_id"),
        "items",
        "source_count",
        "group_pos",
        F.col("best.t").alias("title"),
        F.when(high, "high").when(medium, "medium").otherwise("low").alias("confidence"),
    )


@query("""
with t as (
  select distinct pos, source_id, e || '|' || t as tag from (select pos, source_id, unnest(detected_entities) as e, detected_topics from cleaned_items),
  unnest(detected_topics) as u(t)
), s as (select tag, min(pos) as a from t group by tag having count(distinct source_id) > 1)
select distinct a, pos as b from t join s using (tag) where a <> pos
""")
def tag_pair_links(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").select("pos", "source_id", F.explode("detected_entities").alias("e"), "detected_topics")
    pairs = items.select("pos", "source_id", "e", F.explode("detected_topics").alias("t"))
    return shared_tag_edges(pairs.withColumn("tag", F.concat_ws("|", "e", "t")), "pos", "source_id", "tag")


@query(f"""
with t as (select run_date, cluster_id, title, {sql_tokens('title')} as tokens from clusters), d as (
  select *, lag(tokens) over (order by pos) as before from (select *, (select pos from clusters c where c.cluster_id = t.cluster_id) as pos from t)
)
select cluster_id, cast(len(list_intersect(tokens, coalesce(before, []))) as bigint) as shared from d
""")
def neighbour_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Shared title tokens of each cluster with the one before it: neighbours meet by pos, through carry_forward in blocks."""
    rows = load(spark, sf, "clusters").select("pos", "cluster_id", title_tokens(F.col("title")).alias("tokens"))
    rows = rows.withColumn("all", F.lit(1))
    points = rows.select("all", (F.col("pos") + 0.5).alias("at"), F.lit(None).cast("string").alias("cluster_id"), "tokens")
    asked = rows.select("all", F.col("pos").cast("double").alias("at"), "cluster_id", "tokens")
    both = points.unionByName(asked)
    value = F.when(F.col("cluster_id").isNull(), F.col("tokens"))
    found = carry_forward(both, ["all"], "at", value, "before", F.floor(F.col("at") / 100_000)).where("cluster_id is not null")
    return found.select("cluster_id", F.size(F.array_intersect("tokens", F.coalesce("before", F.array().cast("array<string>")))).cast("long").alias("shared"))


@query("""
select event_id, ts from events, (select max(ts) - interval 3 day as now from events)
where ts is null or ts between now - interval 14 day and now or (event_type = 'signup' and ts > now and ts <= now + interval 400 day)
""")
def age_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    # One value, so that the bounds are literals of the scan's filter.
    now = (events.agg(F.max("ts")).first()[0] or datetime(1970, 1, 1)) - timedelta(days=3)
    at = lambda **shift: F.lit(now + timedelta(**shift)).cast(events.schema["ts"].dataType)
    ahead = (F.col("event_type") == "signup") & (F.col("ts") > at()) & (F.col("ts") <= at(days=400))
    return events.where(F.col("ts").isNull() | F.col("ts").between(at(days=-14), at()) | ahead).select("event_id", "ts")


SQL_KIND = """case when regexp_matches(lower(coalesce(url, '')), '^[^?#]*\\.pdf') then 'pdf_link'
  when regexp_matches(lower(coalesce(url, '')), '^[^?#]*\\.(xlsx?|csv|ods)') then 'spreadsheet_link'
  when regexp_matches(lower(coalesce(url, '')), '^[^?#]*\\.(docx?|rtf|html)') then 'document_link' else 'html_or_api' end"""


@query(f"""
with r as (
  select source_id, count(*) as raw, count(nullif(published_at, '')) as dated, count(distinct {SQL_KIND}) as kinds,
    min({SQL_KIND}) as kind, count_if({SQL_KIND} <> 'html_or_api') as documents from raw_items group by all
), c as (
  select source_id, count(*) as cleaned, count_if(len(detected_topics) > 0 or len(detected_entities) > 0) as tagged,
    count_if(quality_notes = '' and published_at is not null) as rankable from cleaned_items group by all
)
select d.id as source_id, coalesce(raw, 0) as raw, coalesce(cleaned, 0) as cleaned, coalesce(dated, 0) as dated,
  coalesce(rankable, 0) as rankable, coalesce(tagged, 0) as tagged, coalesce(documents, 0) as documents,
  case when raw is null then 'no_items' when kinds = 1 then kind when documents > 0 then 'mixed_document_and_html_links' else 'html_or_api' end as mode,
  case when raw is null then 'no_raw' when coalesce(rankable, 0) = 0 then 'no_rankable' else 'ok' end as status
from dim_source d left join r on r.source_id = d.id left join c on c.source_id = d.id
""")
def source_health(spark: SparkSession, sf: str) -> DataFrame:
    path = F.lower(F.coalesce("url", F.lit("")))
    kind = (
        F.when(path.rlike(r"^[^?#]*\.pdf"), "pdf_link")
        .when(path.rlike(r"^[^?#]*\.(xlsx?|csv|ods)"), "spreadsheet_link")
        .when(path.rlike(r"^[^?#]*\.(docx?|rtf|html)"), "document_link")
        .otherwise("html_or_api")
    )
    raw = (
        load(spark, sf, "raw_items").select("source_id", "published_at", kind.alias("kind")).groupBy("source_id").agg(
            F.count("*").alias("raw"), F.count(F.nullif("published_at", F.lit(""))).alias("dated"),
            F.collect_set("kind").alias("kinds"), F.count_if(F.col("kind") != "html_or_api").alias("documents"),
        )
    )
    cleaned = load(spark, sf, "cleaned_items").groupBy("source_id").agg(
        F.count("*").alias("cleaned"),
        F.count_if((F.size("detected_topics") > 0) | (F.size("detected_entities") > 0)).alias("tagged"),
        F.count_if((F.col("quality_notes") == "") & F.col("published_at").isNotNull()).alias("rankable"),
    )
    joined = load(spark, sf, "dim_source").select(F.col("id").alias("source_id")).join(raw, "source_id", "left").join(cleaned, "source_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    mode = (
        F.when(F.col("raw").isNull(), "no_items")
        .when(F.size("kinds") == 1, F.element_at("kinds", 1))
        .when(F.col("documents") > 0, "mixed_document_and_html_links")
        .otherwise("html_or_api")
    )
    status = F.when(F.col("raw").isNull(), "no_raw").when(F.coalesce("rankable", F.lit(0)) == 0, "no_rankable").otherwise("ok")
    counts = [zero(c) for c in ("raw", "cleaned", "dated", "rankable", "tagged", "documents")]
    return joined.select("source_id", *counts, mode.alias("mode"), status.alias("status"))


@query("""
select source_id, count(*) as items, count(*) / sum(count(*)) over () as share, count(*) / sum(count(*)) over () > 0.05 as concentrated
from raw_items group by source_id
""")
def source_share(spark: SparkSession, sf: str) -> DataFrame:
    counts = load(spark, sf, "raw_items").groupBy("source_id").agg(F.count("*").alias("items"))
    share = F.col("items") / F.sum("items").over(Window.partitionBy(F.lit(1)))
    return counts.select("source_id", "items", share.alias("share"), (share > 0.05).alias("concentrated"))


@query("""
select 'error' as level, 'raw_without_url' as code, count(*) as rows from raw_items where url is null
union all select 'error', 'raw_without_title', count(*) from raw_items where trim(coalesce(title, '')) = ''
union all select 'warning', 'raw_without_date', count(*) from raw_items where trim(coalesce(published_at, '')) = ''
union all select 'error', 'cleaned_without_text', count(*) from cleaned_items where trim(coalesce(clean_text, '')) = ''
union all select 'error', 'cleaned_without_raw', count(*) from cleaned_items c where not exists (select 1 from raw_items r where r.pos = c.pos and r.id = c.id)
union all select 'error', 'unknown_source', count(*) from raw_items r where not exists (select 1 from dim_source d where d.id = r.source_id)
union all select 'warning', 'cluster_arrays_differ', count(*) from clusters where len(items) <> len(member_source_ids) or len(items) <> len(member_titles)
""")
def quality_gates(spark: SparkSession, sf: str) -> DataFrame:
    raw, cleaned = load(spark, sf, "raw_items"), load(spark, sf, "cleaned_items")
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    checks = [
        ("error", "raw_without_url", raw.where("url is null")),
        ("error", "raw_without_title", raw.where(blank("title"))),
        ("warning", "raw_without_date", raw.where(blank("published_at"))),
        ("error", "cleaned_without_text", cleaned.where(blank("clean_text"))),
        ("error", "cleaned_without_raw", cleaned.join(raw, ["pos", "id"], "left_anti")),
        ("error", "unknown_source", raw.join(load(spark, sf, "dim_source").select(F.col("id").alias("source_id")), "source_id", "left_anti")),
        ("warning", "cluster_arrays_differ", load(spark, sf, "clusters").where("size(items) <> size(member_source_ids) or size(items) <> size(member_titles)")),
    ]
    found = [rows.agg(F.count("*").alias("rows")).select(F.lit(level).alias("level"), F.lit(code).alias("code"), "rows") for level, code, rows in checks]
    union = found[0]
    for part in found[1:]:
        union = union.unionByName(part)
    return union


SCORE = "2 * source_count + len(items) + case confidence when 'high' then 3 when 'medium' then 1 else 0 end"


@query(f"select cluster_id, {SCORE} as points, row_number() over (order by {SCORE} desc, cluster_id) as place from clusters qualify place <= 50")
def ranked_clusters(spark: SparkSession, sf: str) -> DataFrame:
    points = 2 * F.col("source_count") + F.size("items") + F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 1).otherwise(0)
    top = load(spark, sf, "clusters").select("cluster_id", points.alias("points")).orderBy(F.desc("points"), "cluster_id").limit(50)
    return top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("points"), "cluster_id")))


@query()
def diversified_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return diversified_top(load(spark, sf, "clusters"), "cluster_id", "score", "member_source_ids")


@query("""
with d as (
  select event_type, date_trunc('day', ts) as day, cast(sum(cast(value as decimal(18,4))) as double) as total from events group by all
)
select d.event_type, d.day, d.total, w.total as week_before, d.total - w.total as change from d
asof left join d w on d.event_type = w.event_type and d.day - interval 7 day >= w.day
""")
def asof_change(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    daily = events.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.sum(money("value")).cast("double").alias("total"))
    asked = daily.withColumn("target", F.col("day") - F.expr("interval 7 days"))
    found = asof_join(asked, daily, by=["event_type"], left_at="target", right_at="day", value="total", name="week_before", block=5 * 86_400)
    return found.select("event_type", "day", "total", "week_before", (F.col("total") - F.col("week_before")).alias("change"))


@query("""
select user_id, arg_max(event_id, (ts, event_id)) as event_id, max(ts) as ts, lead_n from (
  select *, count(*) over (partition by user_id) as lead_n from events) group by user_id, lead_n
""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    latest = load(spark, sf, "events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m"), F.count("*").alias("lead_n"))
    return latest.select("user_id", "m.event_id", "m.ts", "lead_n")


SQL_MONTHLY = """
m as (
  select l_returnflag as flag, date_trunc('month', l_shipdate)::date as month, cast(sum(cast(l_extendedprice as decimal(18,4))) as double) as revenue,
    count(*) as lines from lineitem group by all
)"""


def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc("l_shipdate", "month").alias("month")
    return load(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), month).agg(
        F.sum(money("l_extendedprice")).cast("double").alias("revenue"), F.count("*").alias("lines")
    )


@query(f"""with {SQL_MONTHLY}
select a.flag, a.month, a.revenue, b.revenue as year_before, a.revenue - b.revenue as change
from m a left join m b on a.flag = b.flag and b.month = a.month - interval 1 year
""")
def year_over_year(spark: SparkSession, sf: str) -> DataFrame:
    m = monthly_revenue(spark, sf)
    before = m.select("flag", F.add_months("month", 12).alias("month"), F.col("revenue").alias("year_before"))
    return m.join(before, ["flag", "month"], "left").select("flag", "month", "revenue", "year_before", (F.col("revenue") - F.col("year_before")).alias("change"))


@query(f"with {SQL_MONTHLY} select flag, max(month) as month from (select *, max(lines) over (partition by flag) as most from m) where lines >= 0.75 * most group by flag")
def latest_complete_month(spark: SparkSession, sf: str) -> DataFrame:
    m = monthly_revenue(spark, sf)
    most = m.groupBy("flag").agg(F.max("lines").alias("most"))
    return m.join(most, "flag").where("lines >= 0.75 * most").groupBy("flag").agg(F.max("month").alias("month"))


@query(f"with {SQL_MONTHLY} select flag, month, lines / day(last_day(month)) as per_day from m")
def per_day_in_month(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_revenue(spark, sf).select("flag", "month", (F.col("lines") / F.day(F.last_day("month"))).alias("per_day"))


@query("""
select r_name, n_name, total, row_number() over (partition by r_name order by total desc, n_name) as place from (
  select r_name, n_name, sum(cast(c_acctbal as decimal(18,4)))::double as total from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey group by all) qualify place <= 3
""")
def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    per_nation = load(spark, sf, "customer").groupBy("c_nationkey").agg(F.sum(money("c_acctbal")).alias("total"))
    nations = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("r_name", "n_name", F.col("total").cast("double").alias("total"))
    return top_per_group(named, ["r_name"], [F.desc("total"), F.asc("n_name")], 3, "place")


@query("""
select source_type, run_date, source_id, count(*) as items, count(distinct id) as ids, grouping(source_type) as no_type,
  grouping(run_date) as no_date, grouping(source_id) as no_source
from raw_items group by grouping sets ((source_type), (run_date), (source_id), ())
""")
def grouped_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Four groupings in one pass."""
    return spark.sql("""
        select source_type, run_date, source_id, count(*) as items, count(distinct id) as ids,
          cast(grouping(source_type) as bigint) as no_type, cast(grouping(run_date) as bigint) as no_date, cast(grouping(source_id) as bigint) as no_source
        from {rows} group by grouping sets ((source_type), (run_date), (source_id), ())""", rows=load(spark, sf, "raw_items"))


@query("""
select s_name, c_nationkey, count(*) as lines, count(distinct o_orderkey) as orders, sum(cast(l_extendedprice as decimal(18,4)))::double as value
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
group by s_name, c_nationkey having count(*) >= 2
""")
def repeated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", money("l_extendedprice").alias("v"))
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nation = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    supplier = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    placed = orders.join(nation, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    groups = joined.groupBy("s_name", "c_nationkey").agg(
        F.count("*").alias("lines"), F.count_distinct("o_orderkey").alias("orders"), F.sum("v").cast("double").alias("value")
    )
    return groups.where("lines >= 2")


@query("""
select l_suppkey, count(*) as lines, count_if(l_returnflag = 'R') as returned, count_if(l_returnflag = 'R') / count(*) as share
from lineitem group by l_suppkey having count(*) >= 3 and count_if(l_returnflag = 'R') >= 2 and count_if(l_returnflag = 'R') / count(*) >= 0.35
""")
def high_share_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    return groups.withColumn("share", F.col("returned") / F.col("lines")).where("lines >= 3 and returned >= 2 and share >= 0.35")


@query("""
with d as (select canonical_bill_id as bill, status, run_date, pos from legislative_reconciliations where canonical_bill_id is not null)
select bill, coalesce(array_to_string(list_sort(list_distinct(list(status) filter (status is not null))), ','), '') as statuses,
  arg_max(status, (run_date, pos)) filter (status is not null) as latest, count(distinct status) > 1 as contradictory from d group by bill
""")
def status_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "legislative_reconciliations").where("canonical_bill_id is not null")
    known = F.when(F.col("status").isNotNull(), F.struct("run_date", "pos", "status"))
    grouped = rows.groupBy(F.col("canonical_bill_id").alias("bill")).agg(F.array_sort(F.collect_set("status")).alias("s"), F.max(known).alias("m"))
    return grouped.select("bill", F.array_join("s", ",").alias("statuses"), F.col("m.status").alias("latest"), (F.size("s") > 1).alias("contradictory"))


@query("""
with o(status, stage) as (values ('Aprobado', 'resolved'), ('Sancionado', 'resolved'), ('Archivado', 'archived'))
select l.pos, l.status, coalesce(o.stage, 'active') as stage, o.stage is not null as overridden
from legislative_reconciliations l left join o on o.status = l.status and l.decision_state <> 'decided'
""")
def status_overrides(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame([("Aprobado", "resolved"), ("Sancionado", "resolved"), ("Archivado", "archived")], "rule_status string, stage string")
    rows = load(spark, sf, "legislative_reconciliations")
    joined = rows.join(F.broadcast(rules), (F.col("status") == F.col("rule_status")) & (F.col("decision_state") != "decided"), "left")
    return joined.select("pos", "status", F.coalesce("stage", F.lit("active")).alias("stage"), F.col("stage").isNotNull().alias("overridden"))


SQL_CHAMBER = "case when strip_accents(lower(r.chamber)) like '%sen%' then 'senado' when strip_accents(lower(r.chamber)) like '%cam%' then 'camara' else 'unknown' end"


@query(f"""
with k as (
  select distinct pos, canonical_bill_id as bill, r.number as number, r.year as year, {SQL_CHAMBER} as chamber
  from (select pos, canonical_bill_id, unnest(project_records) as r from legislative_reconciliations)
)
select distinct a.pos, b.bill as linked_bill from k a join k b using (number, year, chamber) where a.bill <> b.bill
""")
def shared_project_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "legislative_reconciliations").select("pos", F.col("canonical_bill_id").alias("bill"), F.explode("project_records").alias("r"))
    name = fold(F.col("r.chamber"))
    chamber = F.when(name.contains("sen"), "senado").when(name.contains("cam"), "camara").otherwise("unknown")
    keys = rows.select("pos", "bill", F.col("r.number").alias("number"), F.col("r.year").alias("year"), chamber.alias("chamber")).distinct()
    other = keys.select("number", "year", "chamber", F.col("bill").alias("linked_bill")).distinct()
    return keys.join(other, ["number", "year", "chamber"]).where("bill <> linked_bill").select("pos", "linked_bill").distinct()


@query(f"""
with t as (select canonical_bill_id as id, {sql_tokens('title_normalized')} as tokens from legislative_reconciliations)
select distinct m.match_no from bill_matches m join t a on a.id = m.left_bill_id join t b on b.id = m.right_bill_id
where len(list_intersect(a.tokens, b.tokens)) >= 2
""")
def residual_title_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Equi-joins on both ids with a residual predicate on the titles."""
    titles = load(spark, sf, "legislative_reconciliations").select(F.col("canonical_bill_id").alias("id"), title_tokens(F.col("title_normalized")).alias("tokens"))
    left = titles.select(F.col("id").alias("left_bill_id"), F.col("tokens").alias("x"))
    right = titles.select(F.col("id").alias("right_bill_id"), F.col("tokens").alias("y"))
    joined = load(spark, sf, "bill_matches").select("match_no", "left_bill_id", "right_bill_id").join(left, "left_bill_id").join(right, "right_bill_id")
    return joined.where(F.size(F.array_intersect("x", "y")) >= 2).select("match_no").distinct()


@query("""
select r.pos, 'with_entry' as kind from raw_items r where exists (select 1 from cleaned_items c where c.pos = r.pos)
union all select r.pos, 'without_entry' from raw_items r where not exists (select 1 from cleaned_items c where c.pos = r.pos)
""")
def semi_and_anti(spark: SparkSession, sf: str) -> DataFrame:
    raw, cleaned = load(spark, sf, "raw_items").select("pos"), load(spark, sf, "cleaned_items").select("pos")
    have = raw.join(cleaned, "pos", "left_semi").withColumn("kind", F.lit("with_entry"))
    return have.unionByName(raw.join(cleaned, "pos", "left_anti").withColumn("kind", F.lit("without_entry")))


@query("""
with r as (select *, row_number() over (partition by event_type order by value desc, event_id) as n from events), p as (
  select *, case when n <= case event_type when 'purchase' then 10 when 'signup' then 6 when 'error' then 4 else 0 end then 1 else 2 end as pick from r
)
select event_id, event_type, pick from p order by pick, value desc, event_id limit 24
""")
def quota_picks(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("event_id", "event_type", "value")
    return quota_sample(events, "event_type", {"purchase": 10, "signup": 6, "error": 4}, [F.desc("value"), F.asc("event_id")], 24).select("event_id", "event_type", "pick")


@query("""
with l as (select department, max(loaded_at) as seen_at, max(max(loaded_at)) over () as latest from zona_franca_records group by department)
select department, seen_at, case when seen_at is null then 'unknown' when epoch(latest) - epoch(seen_at) > 14 * 86400 then 'stale' else 'current' end as freshness from l
""")
def freshness_by_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "zona_franca_records").groupBy("department").agg(F.max("loaded_at").alias("seen_at"))
    rows = rows.withColumn("latest", F.max("seen_at").over(Window.partitionBy(F.lit(1))))
    age = (F.col("latest").cast("timestamp").cast("double") - F.col("seen_at").cast("timestamp").cast("double")) / 86400
    status = F.when(F.col("seen_at").isNull(), "unknown").when(age > 14, "stale").otherwise("current")
    return rows.select("department", "seen_at", status.alias("freshness"))


@query("""
select topic, count(distinct run_date) as runs, min(run_date) as first_run, max(run_date) as last_run,
  array_to_string(list_sort(list_distinct(list(run_date))), ',') as dates
from (select run_date, unnest(detected_topics) as topic from cleaned_items) group by topic
""")
def theme_recurrence(spark: SparkSession, sf: str) -> DataFrame:
    themes = load(spark, sf, "cleaned_items").select("run_date", F.explode("detected_topics").alias("topic")).distinct()
    return themes.groupBy("topic").agg(
        F.count("*").alias("runs"), F.min("run_date").alias("first_run"), F.max("run_date").alias("last_run"),
        F.array_join(F.array_sort(F.collect_list("run_date")), ",").alias("dates"),
    )


@query("""
with days as (select distinct run_date as d from raw_items), l as (select source_id, max(run_date) as last_at from cleaned_items group by all)
select source_id, (select count(*) from days where d > last_at) as streak from l
""")
def drought_streaks(spark: SparkSession, sf: str) -> DataFrame:
    days = load(spark, sf, "raw_items").select("run_date").distinct()
    return trailing_streak(load(spark, sf, "cleaned_items").select("source_id", "run_date"), "source_id", "run_date", days)


@query("""
select 'only_left' as side, pos, title from (select pos, title from raw_items where pos in (select pos from cleaned_items) except all select pos, title from cleaned_items)
union all select 'only_right', pos, title from (select pos, title from cleaned_items except all select pos, title from raw_items)
""")
def parity_diff(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = load(spark, sf, "cleaned_items").select("pos", "title")
    raw = load(spark, sf, "raw_items").select("pos", "title").join(cleaned.select("pos"), "pos", "left_semi")
    left = raw.exceptAll(cleaned).withColumn("side", F.lit("only_left"))
    return left.unionByName(cleaned.exceptAll(raw).withColumn("side", F.lit("only_right"))).select("side", "pos", "title")


@query("""
select json_extract_string(props, '$.k') as k, count(*) as events, sum(cast(value as decimal(18,4)))::double as total from events group by 1
""")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    keyed = load(spark, sf, "events").select(F.get_json_object("props", "$.k").alias("k"), money("value").alias("v"))
    return keyed.groupBy("k").agg(F.count("*").alias("events"), F.sum("v").cast("double").alias("total"))


@query("""
select json_extract_string(try_cast(metadata as json), '$.extraction') as extraction,
  cast(json_extract_string(try_cast(metadata as json), '$.attempt') as bigint) as attempt, count(*) as items
from raw_items group by 1, 2
""")
def metadata_fields(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("metadata", "extraction string, attempt bigint")
    return load(spark, sf, "raw_items").select(parsed.alias("m")).groupBy("m.extraction", "m.attempt").agg(F.count("*").alias("items"))


_CITED_PARTS = ", ".join(f"unnest(regexp_extract_all(t, '{CITED}', {i})) as {n}" for i, n in ((1, "k"), (2, "n"), (3, "y")))
_ACT_NAMES = ", ".join(f"('{name}', '{kind}')" for name, kind in ACTS.items())
_NUMBER_WORDS = ", ".join(f"'{w}'" for w in NUMBER_WORDS)


@query(f"""
with a as (select doc_id, {_CITED_PARTS} from (select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as t from documents)), c as (
  select doc_id, list_filter(regexp_extract_all(strip_accents(lower(k)), '[\\p{{L}}\\p{{N}}]+'), lambda w: w not in ({_NUMBER_WORDS})) as w,
    regexp_replace(upper(replace(n, '/', '-')), '(^|-)0+([0-9])', '\\1\\2', 'g') as n, y from a
), names(name, kind) as (values {_ACT_NAMES}), k as (
  select c.*, two.kind as two, one.kind as one from c left join names two on two.name = array_to_string(w[-2:], ' ') and len(w) > 1 left join names one on one.name = w[-1]
)
select distinct doc_id, coalesce(two, one) as kind, n as number, y as year from k where coalesce(two, one) is not null
""")
def legal_act_mentions(spark: SparkSession, sf: str) -> DataFrame:
    acts = load(spark, sf, "documents").select("doc_id", F.explode(legal_acts(F.col("text"))).alias("a"))
    return acts.select("doc_id", "a.kind", "a.number", "a.year")


SQL_BARE = "regexp_replace(n, '[^0-9,.\\-]', '', 'g')"


@query(f"""
with n as (select distinct unnest(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*')) as n from documents), c as (
  select n, {SQL_BARE} as b, instr(reverse(n), ',') as c, instr(reverse(n), '.') as p from n
)
select n as written, try_cast(case when c > 0 and p > 0 and c < p then replace(replace(b, '.', ''), ',', '.') when c > 0 and (p > 0 or c > 3) then replace(b, ',', '')
  when c > 0 then replace(b, ',', '.') else b end as double) as in_text,
  try_cast(case when c > 0 and p > 0 and c < p then replace(replace(b, '.', ''), ',', '.') when c > 0 and p > 0 then replace(b, ',', '') when c > 0 then replace(b, ',', '.')
  when regexp_full_match(b, '-?[0-9]{{1,3}}\\.[0-9]{{3}}') or regexp_matches(b, '\\..*\\.') then replace(b, '.', '') else b end as double) as in_series from c
""")
def number_notations(spark: SparkSession, sf: str) -> DataFrame:
    found = load(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[0-9]+(?:[.,][0-9]+)*"), 0)).alias("written")).distinct()
    return found.select("written", number_in_text(F.col("written")).alias("in_text"), number_in_series(F.col("written")).alias("in_series"))


@query("""
with r(bundle, topic) as (values ('energy', 'energía solar'), ('energy', 'regalías'), ('fiscal', 'recaudo aduanero'), ('fiscal', 'deuda pública'),
  ('fiscal', 'presupuesto regional'), ('labour', 'empleo juvenil'), ('labour', 'pensiones'))
select run_date, bundle, count(distinct topic) as topics, count(*) as mentions
from (select run_date, unnest(detected_topics) as topic from cleaned_items) join r using (topic) group by all having count(distinct topic) >= 2
""")
def bundle_membership(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"energy": ["energía solar", "regalías"], "fiscal": ["recaudo aduanero", "deuda pública", "presupuesto regional"], "labour": ["empleo juvenil", "pensiones"]}
    table = spark.createDataFrame([(b, t) for b, topics in rules.items() for t in topics], "bundle string, topic string")
    topics = load(spark, sf, "cleaned_items").select("run_date", F.explode("detected_topics").alias("topic"))
    found = topics.join(F.broadcast(table), "topic").groupBy("run_date", "bundle").agg(F.count_distinct("topic").alias("topics"), F.count("*").alias("mentions"))
    return found.where("topics >= 2")


@query("""
select pos, source_id, last_value(nullif(published_at, '') ignore nulls) over (partition by source_id order by pos) as latest_seen from raw_items
""")
def forward_filled(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "raw_items").select("pos", "source_id", "published_at")
    filled = carry_forward(rows, ["source_id"], "pos", F.nullif("published_at", F.lit("")), "latest_seen", F.floor(F.col("pos") / 500))
    return filled.select("pos", "source_id", "latest_seen")


@query("""
select pos, source_id from raw_items r join dim_source d on d.id = r.source_id
qualify max_items is null or max_items < 0 or row_number() over (partition by source_id order by pos) <= max_items
""")
def capped_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's limit of rows for each source, where a source has one; the others keep all rows."""
    limits = load(spark, sf, "dim_source").select(F.col("id").alias("source_id"), "max_items")
    rows = load(spark, sf, "raw_items").select("pos", "source_id").join(limits, "source_id")
    free = rows.where("max_items is null or max_items < 0")
    most = limits.agg(F.max("max_items")).first()[0] or 0
    capped = top_per_group(rows.where("max_items >= 0"), ["source_id"], [F.asc("pos")], int(most), "n").where("n <= max_items")
    return free.select("pos", "source_id").unionByName(capped.select("pos", "source_id"))


@query("""
select i.pos, d.type as source_type, d.trust_role, case when d.type = 'legal' then 'legal' when d.trust_role = 'media_signal' then 'media' else 'other' end as signal
from raw_items i join dim_source d on d.id = i.source_id
""")
def items_with_source(spark: SparkSession, sf: str) -> DataFrame:
    sources = load(spark, sf, "dim_source").select(F.col("id").alias("source_id"), F.col("type").alias("source_type"), "trust_role")
    signal = F.when(F.col("source_type") == "legal", "legal").when(F.col("trust_role") == "media_signal", "media").otherwise("other")
    return load(spark, sf, "raw_items").select("pos", "source_id").join(sources, "source_id").select("pos", "source_type", "trust_role", signal.alias("signal"))


@query(f"""
with t as (select pos, run_date, {sql_tokens('title')} as tokens from cleaned_items where title is not null), c as (
  select pos, run_date, {sql_tokens("array_to_string(member_titles, ' ')")} as tokens from clusters
)
select pos, len(tokens) as tokens from t where len(tokens) > 0 union all select pos, len(tokens) from c where len(tokens) > 0
""")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "cleaned_items").where("title is not null").select("pos", F.size(title_tokens(F.col("title"))).cast("long").alias("tokens"))
    clusters = load(spark, sf, "clusters").select("pos", F.size(title_tokens(F.concat_ws(" ", "member_titles"))).cast("long").alias("tokens"))
    return items.unionByName(clusters).where("tokens > 0")


@query("""
select coalesce(a.pos, b.pos) as pos, a.id is not null as in_raw, b.id is not null as in_cleaned, a.title is distinct from b.title as differs
from raw_items a full join cleaned_items b on a.pos = b.pos and a.id = b.id
""")
def full_outer_on_id(spark: SparkSession, sf: str) -> DataFrame:
    a = load(spark, sf, "raw_items").select("pos", "id", F.col("title").alias("x"), F.lit(True).alias("ra"))
    b = load(spark, sf, "cleaned_items").select("pos", "id", F.col("title").alias("y"), F.lit(True).alias("cb"))
    joined = a.join(b, ["pos", "id"], "full_outer")
    known = lambda c: F.coalesce(c, F.lit(False))
    return joined.select("pos", known("ra").alias("in_raw"), known("cb").alias("in_cleaned"), (~F.col("x").eqNullSafe(F.col("y"))).alias("differs"))


@query(f"""
with t as (select cluster_id, {sql_tokens("title")} as x, {sql_tokens("array_to_string(member_titles, ' ')")} as y from clusters)
select cluster_id, case when len(x) + len(y) = 0 then 0.0 else len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))) end as overlap from t
""")
def title_member_overlap(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "clusters")
    return rows.select("cluster_id", jaccard(title_tokens(F.col("title")), title_tokens(F.concat_ws(" ", "member_titles"))).alias("overlap"))
