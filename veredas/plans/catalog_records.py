"""Registries, identities, trends and complete tables over the provided tables, each with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veredas.functions.items import legal_acts
from veredas.functions.text import collapse_spaces, fold
from veredas.functions.url import canonical_url
from veredas.operators.components import connected_groups
from veredas.operators.ranking import diversified_order
from veredas.operators.series import asof_join, blocked_places
from veredas.plans.catalog import ORACLES as CATALOG_SQL
from veredas.plans.catalog import money, sql_url, title_groups
from veredas.session import load
from veredas.sources.scan import register, scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


SQL_STATE = """case when coalesce(trim(id), '') = '' or coalesce(trim(name), '') = '' or not coalesce(regexp_matches(lower(url), '^https?://[^/]'), false) then 'invalid'
  when not coalesce(enabled, false) then 'disabled' when coalesce(onboarding_status, 'working') in ('blocked', 'deferred', 'needs_parser') then 'skipped' else 'registered' end"""


@query(f"select id, fetch_method, {SQL_STATE} as state, coalesce(max_items, 25) as max_items from dim_source")
def registered_sources(spark: SparkSession, sf: str) -> DataFrame:
    return register(load(spark, sf, "dim_source")).select("id", "fetch_method", "state", F.coalesce("max_items", F.lit(25)).alias("max_items"))


@query(f"""
with s as (select id, fetch_method from (select *, {SQL_STATE} as state from dim_source) where state = 'registered'), n as (
  select source_id, count(*) as n from raw_items group by source_id
)
select id as source_id, case when fetch_method in ('rss', 'html') then coalesce(n, 0) else 0 end as items,
  case when fetch_method not in ('rss', 'html') then 'no_reader' when n is null then 'no_items' end as failure
from s left join n on n.source_id = s.id
""")
def source_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Items and failures of a scan in which feeds and pages have readers and other methods have none."""
    raw = load(spark, sf, "raw_items").select("source_id", "pos")
    delivered = lambda sources: raw.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_semi")
    items, failures = scan(register(load(spark, sf, "dim_source")), {"rss": delivered, "html": delivered}, ["pos"])
    counts = items.groupBy("source_id").agg(F.count("*").alias("items")).withColumn("failure", F.lit(None).cast("string"))
    return counts.unionByName(failures.select("source_id", F.lit(0).cast("long").alias("items"), F.col("reason").alias("failure")))


@query(f"""
select source_id, reason from (
  select id as source_id, 'disabled' as reason from dim_source where not enabled
  union select id, 'needs_parser' from dim_source where onboarding_status = 'needs_parser'
  union select d.id, 'no_items' from dim_source d where not exists (select 1 from raw_items r where r.source_id = d.id)
  union select source_id, 'no_text' from raw_items group by source_id having count(*) filter (coalesce(raw_text, '') = '') > 0.05 * count(*)
)
""")
def source_caveats(spark: SparkSession, sf: str) -> DataFrame:
    """Why a source's silence can't be relied on; each source and reason once."""
    sources, raw = load(spark, sf, "dim_source"), load(spark, sf, "raw_items")
    counts = raw.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce("raw_text", F.lit("")) == "").alias("empty"))
    because = lambda rows, reason: rows.select("source_id", F.lit(reason).alias("reason"))
    named = sources.withColumnRenamed("id", "source_id")
    found = because(named.where("not enabled"), "disabled").unionByName(because(named.where("onboarding_status = 'needs_parser'"), "needs_parser"))
    found = found.unionByName(because(named.join(counts, "source_id", "left_anti"), "no_items"))
    return found.unionByName(because(counts.where("empty > 0.05 * n"), "no_text")).distinct()


@query(f"""
select pos, {sql_url('url')} || case when regexp_extract(url, '#(.*)$', 1) <> '' and source_type in ('registry', 'agenda', 'regulatory')
  then '#' || regexp_extract(url, '#(.*)$', 1) else '' end as item_key from raw_items where url is not null
""")
def item_url_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical URLs that keep the fragment where it names a row of a document."""
    fragment = F.regexp_extract("url", "#(.*)$", 1)
    kept = F.when((fragment != "") & F.col("source_type").isin("registry", "agenda", "regulatory"), F.concat(F.lit("#"), fragment)).otherwise(F.lit(""))
    rows = load(spark, sf, "raw_items").where("url is not null").select("pos", "url", "source_type", canonical_url(F.col("url")).alias("key"))
    return rows.select("pos", F.concat("key", kept).alias("item_key"))


SQL_PAIRS = "list_sort(list_filter(list_transform(json_keys(m), lambda k: [k, json_extract_string(m, '$.\"' || k || '\"')]), lambda p: p[2] is not null and p[2] <> ''))"


def metadata_pairs(column: str = "metadata") -> F.Column:
    """Entries (key, value) of a JSON object that have a value, by key; a null, empty or broken text has none."""
    entries = F.map_entries(F.from_json(F.col(column), "map<string,string>"))
    return F.array_sort(F.filter(F.coalesce(entries, F.array().cast(ENTRIES)), lambda e: e.getItem("value").isNotNull() & (e.getItem("value") != "")))


ENTRIES = "array<struct<key:string,value:string>>"


@query(f"""
with m as (select pos, case when json_valid(metadata) then metadata::json end as m from raw_items), p as (select pos, case when m is null then [] else {SQL_PAIRS} end as p from m)
select pos, array_to_string(list_transform(p, lambda x: x[1] || ' ' || x[2]), ' ') as searchable,
  array_to_string(list_transform(p, lambda x: x[1] || '=' || case when x[1] in ('attempt', 'fetched_at') then '<volatile>' else x[2] end), ',') as masked, len(p) as fields from p
""")
def metadata_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata as text to search in, and with the fields masked that differ from run to run; empty fields left out."""
    rows = load(spark, sf, "raw_items").select("pos", metadata_pairs().alias("p"))
    key, value = (lambda e: e.getItem("key")), (lambda e: e.getItem("value"))
    hidden = lambda e: F.when(key(e).isin("attempt", "fetched_at"), "<volatile>").otherwise(value(e))
    return rows.select(
        "pos",
        F.array_join(F.transform("p", lambda e: F.concat_ws(" ", key(e), value(e))), " ").alias("searchable"),
        F.array_join(F.transform("p", lambda e: F.concat_ws("=", key(e), hidden(e))), ",").alias("masked"),
        F.size("p").cast("long").alias("fields"),
    )


#: Topics that come first, in this order, before the others by name.
LEADING_TOPICS = ["pensiones", "peajes", "seguro de cosechas"]


@query(f"""
select pos, array_to_string(list_concat(list_filter({LEADING_TOPICS}, lambda t: list_contains(detected_topics, t)),
  list_sort(list_distinct(list_filter(detected_topics, lambda t: not list_contains({LEADING_TOPICS}, t))))), '|') as topics
from cleaned_items where detected_topics is not null
""")
def ordered_tags(spark: SparkSession, sf: str) -> DataFrame:
    leading = F.array(*[F.lit(t) for t in LEADING_TOPICS])
    own = F.array_intersect(leading, "detected_topics")
    rest = F.array_sort(F.array_except(F.filter("detected_topics", lambda t: t.isNotNull()), leading))
    return load(spark, sf, "cleaned_items").where("detected_topics is not null").select("pos", F.array_join(F.concat(own, rest), "|").alias("topics"))


SQL_BOTH = "strip_accents(lower(r.chamber))"
SQL_PROJECT_KEYS = f"""
select distinct pos, bill, coalesce(nullif(ltrim(trim(r.number), '0'), ''), '0') as number, trim(r.year) as year, unnest(case
  when {SQL_BOTH} like '%sen%' and {SQL_BOTH} like '%cam%' then ['camara', 'senado'] when {SQL_BOTH} like '%sen%' then ['senado'] when {SQL_BOTH} like '%cam%' then ['camara'] else ['unknown'] end) as chamber
from (select pos, canonical_bill_id as bill, unnest(project_records) as r from legislative_reconciliations) where trim(r.number) <> '' and trim(r.year) <> ''
"""


@query(SQL_PROJECT_KEYS)
def project_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Number, year and chamber of every project of a record; a project of both chambers has two keys."""
    rows = load(spark, sf, "legislative_reconciliations").select("pos", F.col("canonical_bill_id").alias("bill"), F.explode("project_records").alias("r"))
    name = fold(F.coalesce("r.chamber", F.lit("")))
    chambers = F.filter(F.array(F.when(name.contains("cam"), "camara"), F.when(name.contains("sen"), "senado")), lambda c: c.isNotNull())
    number = F.ltrim(F.trim("r.number"), F.lit("0"))
    rows = rows.where("trim(r.number) <> '' and trim(r.year) <> ''")
    return rows.select(
        "pos", "bill", F.when(number == "", "0").otherwise(number).alias("number"), F.trim("r.year").alias("year"),
        F.explode(F.when(F.size(chambers) == 0, F.array(F.lit("unknown"))).otherwise(chambers)).alias("chamber"),
    ).distinct()


OPENING = r"^(?:proyecto de ley|por (?:medio de )?(?:la )?cual se|se (?:crea|modifica|adopta)) "
SQL_NORMAL = f"regexp_replace(trim(regexp_replace(strip_accents(lower(display_title)), '[^a-z0-9]+', ' ', 'g')), '{OPENING}', '')"


@query(f"select pos, {SQL_NORMAL} as normal from legislative_reconciliations where display_title is not null")
def normal_titles(spark: SparkSession, sf: str) -> DataFrame:
    flat = F.trim(F.regexp_replace(fold(F.col("display_title")), "[^a-z0-9]+", " "))
    return load(spark, sf, "legislative_reconciliations").where("display_title is not null").select("pos", F.regexp_replace(flat, OPENING, "").alias("normal"))


@query(f"""
with recursive k as ({SQL_PROJECT_KEYS}), t as (select canonical_bill_id as bill, {SQL_NORMAL} as normal from legislative_reconciliations where display_title is not null), e as (
  select left_bill_id as a, right_bill_id as b from bill_matches where left_bill_id is not null and right_bill_id is not null and match_score >= 0.7
  union select x.bill, y.bill from k x join k y using (number, year, chamber) union select x.bill, y.bill from t x join t y using (normal)
), w as (select a, b from e union select b, a from e), r as (select a as x, a as y from w union select r.x, w.b from r join w on r.y = w.a), g as (select x as bill, min(y) as root from r group by x)
select root as record_id, count(distinct bill) as bills, count(distinct run_date) as runs, count(distinct status) as statuses,
  arg_max(coalesce(status, ''), (run_date, pos)) as latest_status, arg_max(coalesce(display_title, ''), (length(coalesce(display_title, '')), coalesce(display_title, ''))) as title
from legislative_reconciliations l join g on g.bill = l.canonical_bill_id group by root
""")
def bill_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record for each bill: identities linked by matches, by project keys and by equal titles, directly or not."""
    rows = load(spark, sf, "legislative_reconciliations").withColumnRenamed("canonical_bill_id", "bill")
    matches = load(spark, sf, "bill_matches").where("match_score >= 0.7").select(F.col("left_bill_id").alias("a"), F.col("right_bill_id").alias("b"))

    def star(keyed: DataFrame, key: list[str]) -> DataFrame:
        return keyed.join(keyed.groupBy(*key).agg(F.min("bill").alias("a")), key).select("a", F.col("bill").alias("b"))

    projects = star(project_keys(spark, sf), ["number", "year", "chamber"])
    titles = star(normal_titles(spark, sf).join(rows.select("pos", "bill"), "pos"), ["normal"])
    groups = connected_groups(matches.unionByName(projects).unionByName(titles), "a", "b").select(F.col("record_key").alias("bill"), "group_key")
    title = F.coalesce("display_title", F.lit(""))
    joined = rows.join(groups, "bill", "left").withColumn("record_id", F.coalesce("group_key", "bill"))
    return joined.groupBy("record_id").agg(
        F.count_distinct("bill").alias("bills"),
        F.count_distinct("run_date").alias("runs"),
        F.count_distinct("status").alias("statuses"),
        F.max_by(F.coalesce("status", F.lit("")), F.struct("run_date", "pos")).alias("latest_status"),
        F.max_by(title, F.struct(F.length(title), title)).alias("title"),
    )


@query("""
select distinct bill, day, kind from (
  select canonical_bill_id as bill, run_date as day, 'status:' || status as kind from legislative_reconciliations where status is not null
  union all select left_bill_id, strftime(matched_at, '%Y-%m-%d'), 'match' from bill_matches where left_bill_id is not null
  union all select right_bill_id, strftime(matched_at, '%Y-%m-%d'), 'match' from bill_matches where right_bill_id is not null)
""")
def bill_movements(spark: SparkSession, sf: str) -> DataFrame:
    """What happened to each bill, from two tables, each event once."""
    rows = load(spark, sf, "legislative_reconciliations").where("status is not null")
    moved = rows.select(F.col("canonical_bill_id").alias("bill"), F.col("run_date").alias("day"), F.concat(F.lit("status:"), "status").alias("kind"))
    matches = load(spark, sf, "bill_matches").select(F.explode(F.array("left_bill_id", "right_bill_id")).alias("bill"), F.date_format("matched_at", "yyyy-MM-dd").alias("day"), F.lit("match").alias("kind"))
    return moved.unionByName(matches.where("bill is not null")).distinct()


SQL_ACTS = CATALOG_SQL["legal_act_mentions"]


@query(f"with m as ({SQL_ACTS}) select doc_id, string_agg(kind || ' ' || number || ' ' || year, '; ' order by kind, number, year) as acts, count(*) as act_count from m group by doc_id")
def act_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """The acts that each document names, as text, and their number."""
    acts = load(spark, sf, "documents").select("doc_id", F.array_sort(legal_acts(F.col("text"))).alias("acts")).where("size(acts) > 0")
    named = F.transform("acts", lambda a: F.concat_ws(" ", a.getItem("kind"), a.getItem("number"), a.getItem("year")))
    return acts.select("doc_id", F.array_join(named, "; ").alias("acts"), F.size("acts").cast("long").alias("act_count"))


@query(f"""
with m as ({SQL_ACTS}), d as (select m.*, source, doc_kind from m join documents using (doc_id)), s as (
  select kind, year, doc_kind, min(doc_id) as first_doc, min(source) as s0, max(source) as s1 from d group by all
)
select doc_id, min(kind || ' ' || year) as act, min(first_doc) as first_doc from d join s using (kind, year, doc_kind) where first_doc < doc_id and s0 <> s1 group by doc_id
""")
def shared_act_links(spark: SparkSession, sf: str) -> DataFrame:
    """For each document the first other one of its kind that names an act of the same kind and year, where more than one source does: a join on the act with a residual, without pairing."""
    docs = load(spark, sf, "documents").select("doc_id", "source", "doc_kind", F.explode(legal_acts(F.col("text"))).alias("a")).select("doc_id", "source", "doc_kind", "a.*")
    key = ["kind", "year", "doc_kind"]
    shared = docs.groupBy(*key).agg(F.min("doc_id").alias("first_doc"), F.min("source").alias("s0"), F.max("source").alias("s1"))
    named = F.concat_ws(" ", "kind", "year")
    return docs.join(shared, key).where("first_doc < doc_id and s0 <> s1").groupBy("doc_id").agg(F.min(named).alias("act"), F.min("first_doc").alias("first_doc"))


@query("""
with d as (select event_type, date_trunc('day', ts) as day, sum(value::decimal(18,4))::double as total from events group by all), l as (
  select *, lag(total) over (partition by event_type order by day) as previous from d
)
select l.event_type, l.day::timestamp as day, l.total, l.previous, l.total - l.previous as step, w.total as week_before, l.total - w.total as week_change,
  m.total as month_before, 100 * (l.total - m.total) / m.total as month_percent
from l asof left join d w on w.event_type = l.event_type and l.day - interval 7 day >= w.day asof left join d m on m.event_type = l.event_type and l.day - interval 30 day >= m.day
""")
def series_trends(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's total with the one before, and with those of a week and of thirty days before or the last ones before these."""
    from pyspark.sql import Window

    events = load(spark, sf, "events")
    daily = events.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.sum(money("value")).cast("double").alias("total"))
    of_type = Window.partitionBy("event_type").orderBy("day")  # one row a day: small, whatever the table's size
    rows = daily.withColumn("previous", F.lag("total").over(of_type))
    for name, days in (("week_before", 7), ("month_before", 30)):
        rows = rows.withColumn("target", F.col("day") - F.expr(f"interval {days} days"))
        rows = asof_join(rows, daily, by=["event_type"], left_at="target", right_at="day", value="total", name=name)
    return rows.select(
        "event_type", "day", "total", "previous", (F.col("total") - F.col("previous")).alias("step"), "week_before", (F.col("total") - F.col("week_before")).alias("week_change"),
        "month_before", (100 * (F.col("total") - F.col("month_before")) / F.col("month_before")).alias("month_percent"),
    )


@query("""
with d as (select distinct event_type, date_trunc('day', ts)::date as day from events where event_type <> 'error'), s as (select min(day) as low, max(day) as high from d), c as (
  select t as event_type, unnest(generate_series(low, high, interval 1 day))::date as day from s, unnest(['click', 'purchase', 'survey']) as u(t)
), o as (select event_type, ts::date as day, count(*) as n from events group by all)
select coalesce(c.event_type, o.event_type) as event_type, coalesce(c.day, o.day) as day, coalesce(n, 0) as events, case when n is null then 'pending' when c.day is null then 'extra' else 'observed' end as state
from c full join o on o.event_type = c.event_type and o.day = c.day
""")
def completed_series(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of every expected series: observed or pending; and what was observed beyond them."""
    events = load(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"))
    span = events.where("event_type <> 'error'").agg(F.min("day").alias("low"), F.max("day").alias("high"))
    expected = span.select(F.explode(F.array(*[F.lit(t) for t in ("click", "purchase", "survey")])).alias("event_type"), "low", "high")
    expected = expected.select("event_type", F.explode(F.sequence("low", "high")).alias("day"), F.lit(True).alias("wanted"))
    seen = events.where("event_type is not null").groupBy("event_type", "day").agg(F.count("*").alias("n"))
    state = F.when(F.col("n").isNull(), "pending").when(F.col("wanted").isNull(), "extra").otherwise("observed")
    return expected.join(seen, ["event_type", "day"], "full").select("event_type", "day", F.coalesce("n", F.lit(0)).alias("events"), state.alias("state"))


@query(CATALOG_SQL["title_clusters"][: CATALOG_SQL["title_clusters"].index("select 'c-'")] + """
select m.group_pos, i.pos, i.id, i.source_id, row_number() over (partition by m.group_pos order by i.pos) as place from m join cleaned_items i using (pos)
""")
def cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """The members of each group of titles in order of input; a group is ranked in blocks, so it may be of any size."""
    items = load(spark, sf, "cleaned_items").select("pos", "id", "source_id")
    joined = title_groups(spark, sf).join(items, "pos")
    return blocked_places(joined, ["group_pos"], F.floor(F.col("pos") / 1_000_000), [F.asc("pos")])


@query("select coalesce(m2_readiness, 'unknown') as bucket, canonical_bill_id as id, pos, row_number() over (partition by coalesce(m2_readiness, 'unknown') order by pos) as place from legislative_reconciliations")
def bucket_members(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "legislative_reconciliations").select(F.coalesce("m2_readiness", F.lit("unknown")).alias("bucket"), F.col("canonical_bill_id").alias("id"), "pos")
    return blocked_places(rows, ["bucket"], F.floor(F.col("pos") / 1_000_000), [F.asc("pos")])


SPANISH = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
DAY_MONTH = rf"\b([0-9]{{1,2}}) de ({'|'.join(SPANISH)})\b(?: de ([0-9]{{4}})\b)?"


@query(f"""
with f as (select doc_id, published_on, unnest(regexp_extract_all(text, '{DAY_MONTH}', 1)) as d, unnest(regexp_extract_all(text, '{DAY_MONTH}', 2)) as m, coalesce(unnest(regexp_extract_all(text, '{DAY_MONTH}', 3)), '') as y from documents), n as (
  select doc_id, published_on, y, lpad(d, 2, '0') as d, lpad(list_position({SPANISH}, m)::varchar, 2, '0') as m, case when y = '' then year(published_on)::varchar else y end as own from f
), p as (select doc_id, published_on, y, try_cast(own || '-' || m || '-' || d as date) as named, try_cast((year(published_on) + 1)::varchar || '-' || m || '-' || d as date) as following from n)
select distinct doc_id, case when y = '' and named < published_on then following else named end as day from p where named is not null and not (y = '' and named < published_on and following is null)
""")
def rolled_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates named in a text; those without a year are the next ones from the day of publication."""
    found = F.regexp_extract_all("text", F.lit(DAY_MONTH), 0)
    rows = load(spark, sf, "documents").select("doc_id", "published_on", F.explode(found).alias("f"))
    part = lambda i: F.regexp_extract("f", DAY_MONTH, i)
    month = F.array_position(F.array(*[F.lit(m) for m in SPANISH]), part(2))
    day = lambda year: F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(part(1), 2, "0")).try_cast("date")
    own = F.when(part(3) == "", F.year("published_on").cast("string")).otherwise(part(3))
    rows = rows.select("doc_id", "published_on", (part(3) == "").alias("bare"), day(own).alias("own"), day((F.year("published_on") + 1).cast("string")).alias("following"))
    at = F.when(F.col("bare") & (F.col("own") < F.col("published_on")), F.col("following")).otherwise(F.col("own"))
    return rows.where("own is not null").select("doc_id", at.alias("day")).where("day is not null").distinct()


@query("""
with x as (
  select r.pos, coalesce(nullif(c.clean_text, ''), nullif(r.raw_text, ''), r.title, '') as t, case when r.source_type in ('agenda', 'regulatory') then 400 else 200 end as most
  from raw_items r left join cleaned_items c using (pos)
)
select pos, length(t) as char_count, left(t, most) as excerpt, length(t) > most as clipped from x
""")
def item_excerpts(spark: SparkSession, sf: str) -> DataFrame:
    """The best text of an item, its length, and its beginning up to the limit of its kind of source (excerpts are the feature; nothing is decided by them)."""
    cleaned = load(spark, sf, "cleaned_items").select("pos", "clean_text")
    rows = load(spark, sf, "raw_items").select("pos", "raw_text", "title", "source_type").join(cleaned, "pos", "left")
    text = F.coalesce(F.nullif("clean_text", F.lit("")), F.nullif("raw_text", F.lit("")), "title", F.lit(""))
    limit = F.when(F.col("source_type").isin("agenda", "regulatory"), 400).otherwise(200)
    rows = rows.select("pos", text.alias("t"), limit.alias("limit"))
    return rows.select("pos", F.length("t").cast("long").alias("char_count"), F.expr("left(t, limit)").alias("excerpt"), (F.length("t") > F.col("limit")).alias("clipped"))


@query("""
with n as (select distinct unnest(regexp_extract_all(text, '[$]?[0-9]+(?:[.,][0-9]+)*')) as w from documents)
select w as written, try_cast(replace(trim(w), ',', '.') as double) as decimal_comma, try_cast(replace(replace(w, '$', ''), ',', '') as double) as price from n
""")
def other_notations(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers whose comma is the decimal mark, and prices whose commas group thousands; null where the text isn't one."""
    found = load(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[$]?[0-9]+(?:[.,][0-9]+)*"), 0)).alias("written")).distinct()
    return found.select("written", F.translate("written", ",", ".").try_cast("double").alias("decimal_comma"), F.translate("written", "$,", "").try_cast("double").alias("price"))


@query()
def diversified_all(spark: SparkSession, sf: str) -> DataFrame:
    return diversified_order(load(spark, sf, "clusters"), "cluster_id", "score", "member_source_ids")
