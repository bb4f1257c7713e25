"""More of the reference's operators: tags, dates and rules over texts, folds, pivots and run summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veredas.functions.items import MONTHS, stable_id
from veredas.functions.tags import tag_column
from veredas.functions.text import fold
from veredas.functions.url import canonical_url
from veredas.operators.dedupe import first_by_key
from veredas.operators.merge import latest_known, priority_union
from veredas.plans.catalog import money, sql_url
from veredas.session import load
from veredas.sources.pages import page_state, strip_html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


# Topics and their aliases, folded.
TOPICS = {
    "agriculture": ["pesca artesanal", "seguro de cosechas", "ganaderia", "exportaciones de cafe", "riego"],
    "energy": ["energia solar", "regalias", "licencias mineras", "formalizacion minera"],
    "fiscal": ["recaudo aduanero", "deuda publica", "presupuesto regional", "bonos de largo plazo", "tasa de referencia"],
    "health": ["salud rural", "vacunacion", "medicamentos"],
    "labour": ["empleo juvenil", "pensiones"],
    "transport": ["peajes", "vias terciarias", "puertos fluviales", "transporte escolar"],
}


def sql_pattern(aliases: list[str]) -> str:
    return "(^|[^a-z0-9])(" + "|".join("[^a-z0-9]+".join(a.split()) for a in aliases) + ")([^a-z0-9]|$)"


_TAGS = ", ".join(f"case when regexp_matches(f, '{sql_pattern(a)}') then '{t}' end" for t, a in sorted(TOPICS.items()))


@query(f"select doc_id, concat_ws(',', {_TAGS}) as topics from (select doc_id, strip_accents(lower(coalesce(text, ''))) as f from documents)")
def alias_tags(spark: SparkSession, sf: str) -> DataFrame:
    tags = tag_column(fold(F.coalesce("text", F.lit(""))), TOPICS)
    return load(spark, sf, "documents").select("doc_id", F.array_join(tags, ",").alias("topics"))


@query(f"""
with t as (select run_date, source_type, unnest(string_split(concat_ws(',', {_TAGS}), ',')) as topic
  from (select run_date, source_type, strip_accents(lower(coalesce(clean_text, ''))) as f from cleaned_items))
select run_date, source_type, topic, count(*) as items from t where topic <> '' group by all
""")
def topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    tags = tag_column(fold(F.coalesce("clean_text", F.lit(""))), TOPICS)
    rows = load(spark, sf, "cleaned_items").select("run_date", "source_type", F.explode(tags).alias("topic"))
    return rows.groupBy("run_date", "source_type", "topic").agg(F.count("*").alias("items"))


_MONTH = "case m " + " ".join(f"when '{name}' then {i}" for i, name in enumerate([m for m in MONTHS if m != "setiembre"], 1)) + " end"
_NAMES = "|".join(m for m in MONTHS if m != "setiembre")


_DATE = rf"([0-9]{{1,2}}) de ({_NAMES}) de ((?:19|20)[0-9]{{2}})"
_PARTS = ", ".join(f"unnest(regexp_extract_all(t, '{_DATE}', {i})) as {n}" for i, n in ((1, "d"), (2, "m"), (3, "y")))
_NAMED = f"try_cast(y || '-' || lpad(cast({_MONTH} as varchar), 2, '0') || '-' || lpad(d, 2, '0') as date)"


@query(f"""
with p as (select item_id, {_PARTS} from (
  select item_id, lower(concat_ws(' ', declaratory_resolution, extension_resolution)) as t from zona_franca_records))
select distinct item_id, {_NAMED} as named from p where {_NAMED} is not null
""")
def dates_in_texts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower(F.concat_ws(" ", "declaratory_resolution", "extension_resolution"))
    parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(_DATE), i).alias(n) for i, n in ((1, "d"), (2, "m"), (3, "y"))])
    month = F.array_position(F.array(*[F.lit(m) for m in _NAMES.split("|")]), F.col("p.m"))
    date = F.concat_ws("-", F.col("p.y"), F.lpad(month.cast("string"), 2, "0"), F.lpad("p.d", 2, "0"))
    rows = load(spark, sf, "zona_franca_records").select("item_id", F.explode(parts).alias("p"))
    return rows.select("item_id", date.try_cast("date").alias("named")).where("named is not null").distinct()


@query("""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line_no from documents where text is not null
), a as (select *, regexp_extract(line, '^Artículo ([0-9]+)\\.', 1) as art from l)
select doc_id, line_no, last_value(nullif(art, '') ignore nulls) over (partition by doc_id order by line_no) as article from a where line <> ''
""")
def article_of_line(spark: SparkSession, sf: str) -> DataFrame:
    """As-of by position: the last heading at or before each line; the order is within one text."""
    lines = load(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    lines = lines.where("line <> ''")
    number = F.nullif(F.regexp_extract("line", r"^Artículo ([0-9]+)\.", 1), F.lit(""))
    so_far = Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.select("doc_id", (F.col("i") + 1).cast("long").alias("line_no"), F.last(number, ignorenulls=True).over(so_far).alias("article"))


@query("""
select pos, length(regexp_replace(title, '[^A-ZÁÉÍÓÚÑÜ]', '', 'g')) / length(regexp_replace(title, '[^A-Za-zÁÉÍÓÚÑÜáéíóúñü]', '', 'g')) as ratio
from raw_items where length(regexp_replace(title, '[^A-Za-zÁÉÍÓÚÑÜáéíóúñü]', '', 'g')) > 0
""")
def upper_case_share(spark: SparkSession, sf: str) -> DataFrame:
    count = lambda p: F.length(F.regexp_replace("title", p, ""))
    letters = count("[^A-Za-zÁÉÍÓÚÑÜáéíóúñü]")
    return load(spark, sf, "raw_items").where(letters > 0).select("pos", (count("[^A-ZÁÉÍÓÚÑÜ]") / letters).alias("ratio"))


RULES = [
    ("votes", r"votos, la plenaria"),
    ("audit", r"^el auditor|expedientes"),
    ("court", r"^el tribunal|resolucion [0-9.]+ de"),
    ("money", r"millones|pesos"),
]


@query("select pos, case " + " ".join(f"when regexp_matches(f, '{p}') then '{n}'" for n, p in RULES) + """ else 'other' end as rule
from (select pos, strip_accents(lower(coalesce(clean_text, ''))) as f from cleaned_items)""")
def first_matching_rule(spark: SparkSession, sf: str) -> DataFrame:
    text = fold(F.coalesce("clean_text", F.lit("")))
    rule = F.coalesce(*[F.when(text.rlike(p), n) for n, p in RULES], F.lit("other"))
    return load(spark, sf, "cleaned_items").select("pos", rule.alias("rule"))


@query(f"""
select pos, left(sha1(source_id || '|' || coalesce({sql_url('url')}, '') || '|' || coalesce(title, '')), 16) as stable_id from raw_items where source_id is not null
""")
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "raw_items").where("source_id is not null")
    return rows.select("pos", stable_id(F.col("source_id"), canonical_url(F.col("url")), F.col("title")).alias("stable_id"))


@query("""
with r as (select *, left(regexp_replace(nit, '[^0-9]', '', 'g'), 9) as key from zona_franca_records)
select key, arg_max(zone_name, (loaded_at, item_id)) filter (zone_name is not null) as zone_name,
  arg_max(department, (loaded_at, item_id)) filter (department is not null) as department,
  arg_max(ciiu, (loaded_at, item_id)) filter (ciiu is not null) as ciiu, count(*) as rows from r group by key
""")
def latest_known_fields(spark: SparkSession, sf: str) -> DataFrame:
    key = F.left(F.regexp_replace("nit", "[^0-9]", ""), F.lit(9))
    rows = load(spark, sf, "zona_franca_records").withColumn("key", key)
    return latest_known(rows, "key", ["zone_name", "department", "ciiu"], [F.col("loaded_at"), F.col("item_id")])


@query("""
with p as (
  select cluster_id, 1 as pass from clusters where confidence = 'high' union all select cluster_id, 2 from clusters where source_count >= 2
  union all select cluster_id, 3 from clusters where len(items) >= 2
)
select cluster_id, min(pass) as pass from p group by cluster_id
""")
def priority_passes(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "clusters")
    passes = [rows.where("confidence = 'high'"), rows.where("source_count >= 2"), rows.where("size(items) >= 2")]
    return priority_union([p.select("cluster_id") for p in passes], "cluster_id")


@query("""
select day, sum(v) as total, max(v) as peak, count(*) filter (v > 0) as hours from (
  select date_trunc('day', ts) as day, extract(hour from ts) as h, count(*) as v from events group by all) group by day
""")
def hourly_profile(spark: SparkSession, sf: str) -> DataFrame:
    """One row per day with 24 columns, turned back to rows and summed: the shape in which hourly series arrive."""
    hours = [f"h{i:02d}" for i in range(24)]
    wide = load(spark, sf, "events").groupBy(F.date_trunc("day", "ts").alias("day")).agg(
        *[F.count_if(F.hour("ts") == i).alias(h) for i, h in enumerate(hours)]
    )
    long = wide.unpivot("day", hours, "hour", "v")
    return long.groupBy("day").agg(F.sum("v").alias("total"), F.max("v").alias("peak"), F.count_if(F.col("v") > 0).alias("hours"))


@query("""
with d as (select date_trunc('day', ts) as day, event_type, sum(cast(value as decimal(18,4)))::double as v from events group by all)
select day, max(v) filter (event_type = 'purchase') as purchase, max(v) filter (event_type = 'view') as view,
  max(v) filter (event_type = 'purchase') - max(v) filter (event_type = 'view') as spread from d group by day
""")
def pivoted_spread(spark: SparkSession, sf: str) -> DataFrame:
    days = load(spark, sf, "events").groupBy(F.date_trunc("day", "ts").alias("day")).pivot("event_type", ["purchase", "view"]).agg(F.sum(money("value")).cast("double"))
    return days.withColumn("spread", F.col("purchase") - F.col("view"))


@query("""
with r as (select run_date, count(*) as raw, count(distinct source_id) as sources from raw_items group by all),
  c as (select run_date, count(*) as cleaned, count_if(quality_notes = '') as clean from cleaned_items group by all),
  k as (select run_date, count(*) as clusters, max(source_count) as widest from clusters group by all)
select run_date, coalesce(raw, 0) as raw, coalesce(sources, 0) as sources, coalesce(cleaned, 0) as cleaned, coalesce(clean, 0) as clean,
  coalesce(clusters, 0) as clusters, coalesce(widest, 0) as widest from r full join c using (run_date) full join k using (run_date)
""")
def run_summaries(spark: SparkSession, sf: str) -> DataFrame:
    raw = load(spark, sf, "raw_items").groupBy("run_date").agg(F.count("*").alias("raw"), F.count_distinct("source_id").alias("sources"))
    cleaned = load(spark, sf, "cleaned_items").groupBy("run_date").agg(F.count("*").alias("cleaned"), F.count_if(F.col("quality_notes") == "").alias("clean"))
    clusters = load(spark, sf, "clusters").groupBy("run_date").agg(F.count("*").alias("clusters"), F.max("source_count").alias("widest"))
    joined = raw.join(cleaned, "run_date", "full_outer").join(clusters, "run_date", "full_outer")
    names = ["raw", "sources", "cleaned", "clean", "clusters", "widest"]
    return joined.select("run_date", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


@query("""
select canonical_bill_id as bill, min_by(display_title, (case status when 'Sancionado' then 0 when 'Aprobado' then 1 else 2 end, -length(display_title), pos)) as title
from legislative_reconciliations where display_title is not null group by canonical_bill_id
""")
def best_titles(spark: SparkSession, sf: str) -> DataFrame:
    rows = load(spark, sf, "legislative_reconciliations").where("display_title is not null")
    rank = F.when(F.col("status") == "Sancionado", 0).when(F.col("status") == "Aprobado", 1).otherwise(2)
    rows = rows.select(F.col("canonical_bill_id").alias("bill"), F.col("display_title").alias("title"), rank.alias("r"), (-F.length("display_title")).alias("n"), "pos")
    return first_by_key(rows, F.col("bill"), [F.col("r"), F.col("n"), F.col("pos")]).select("bill", "title")


@query("""
select pos, list_sort(list_distinct([s for s in member_source_ids if s is not null]))[1] as first_source,
  len(list_distinct([s for s in member_source_ids if s is not null])) as sources,
  len(list_filter(member_urls, lambda u: u is null)) as missing_urls,
  len(list_filter(member_source_ids, lambda s: s is not null and not starts_with(s, 'compras'))) = 0 as only_contracts from clusters
""")
def array_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """exists, forall and set tests over parallel arrays."""
    known = F.array_sort(F.array_distinct(F.filter("member_source_ids", lambda s: s.isNotNull())))
    return load(spark, sf, "clusters").select(
        "pos",
        F.get(known, F.lit(0)).alias("first_source"),
        F.size(known).cast("long").alias("sources"),
        F.size(F.filter("member_urls", lambda u: u.isNull())).cast("long").alias("missing_urls"),
        F.forall(known, lambda s: s.startswith("compras")).alias("only_contracts"),
    )


@query()
def html_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Visible text and state of every delivered page."""
    return load(spark, sf, "raw_items").select("pos", strip_html(F.col("raw_text")).alias("text"), page_state(F.col("raw_text")).alias("state"))


