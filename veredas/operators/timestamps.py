"""Mixed timestamp notations and zones to one UTC instant."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Month names in Spanish, Portuguese and English, by their position in the year.
MONTHS = [
    ("enero", "janeiro", "january"),
    ("febrero", "fevereiro", "february"),
    ("marzo", "março", "march"),
    ("abril", "abril", "april"),
    ("mayo", "maio", "may"),
    ("junio", "junho", "june"),
    ("julio", "julho", "july"),
    ("agosto", "agosto", "august"),
    ("septiembre", "setiembre", "setembro", "september", "sept"),
    ("octubre", "outubro", "october"),
    ("noviembre", "novembro", "november"),
    ("diciembre", "dezembro", "december"),
]
# Zone abbreviations, hours from UTC.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 1, "bst": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3,
    "cot": -5, "pet": -5, "ect": -5, "vet": -4, "bot": -4, "clt": -4, "clst": -3, "art": -3, "brt": -3, "brst": -2,
    "uyt": -3, "pyt": -4, "ast": -4, "adt": -3, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6,
    "pst": -8, "pdt": -7,
}
MONTH_OF = {form: i for i, names in enumerate(MONTHS, 1) for name in names for form in (name, name[:3])}

SPACE = re.compile(r"\s+")
TAIL = (
    r"(?:[t ,]*(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?)?"
    r"\s*(?P<ap>[ap]\.?\s?m\.?)?\s*(?P<z>z|[+-]\d{2}(?::?\d{2})?|\[[^\]]+\]|\(?[a-z]{1,5}\)?|[a-z_]+/[a-z_/]+)?"
)
ZONED = re.compile(r"(?P<z>z|[+-]\d{2}(?::?\d{2})?)\s*\[(?P<n>[^\]]+)\]$")
SHAPES = [
    ("iso", re.compile(r"(?P<y>\d{4})[-/](?P<m>\d{1,2})[-/](?P<d>\d{1,2})" + TAIL)),
    ("compact", re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})t(?P<h>\d{2})(?P<mi>\d{2})(?:(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?(?P<ap>)\s*(?P<z>z|[+-]\d{2}(?::?\d{2})?)?")),
    ("slash", re.compile(r"(?P<a>\d{1,2})/(?P<b>\d{1,2})/(?P<y>\d{4}|\d{2})" + TAIL)),
    ("dot", re.compile(r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4}|\d{2})" + TAIL)),
    ("dash", re.compile(r"(?P<d>\d{1,2})-(?P<m>\d{1,2})-(?P<y>\d{4})" + TAIL)),
    ("mail", re.compile(r"(?:[^\W\d_]+\.?,?\s+)?(?P<d>\d{1,2})[ -](?P<mn>[^\W\d_]+)\.?[ -](?P<y>\d{4}|\d{2})" + TAIL)),
    ("day_of", re.compile(r"(?:[^\W\d_]+,?\s+)?(?P<d>\d{1,2})\s+de\s+(?P<mn>[^\W\d_]+)(?:\s+del?)?\s+(?P<y>\d{4})\s*(?:-|a las|,)?\s*" + TAIL)),
    ("month_of", re.compile(r"(?:[^\W\d_]+,\s+)?(?P<mn>[^\W\d_]+)\.?\s+(?P<d>\d{1,2}),?\s+(?:del?\s+)?(?P<y>\d{4})\s*(?:-|a las|,)?\s*" + TAIL)),
]
KINDS = ["epoch", *[f"{name}_{order}" for name, _ in SHAPES for order in ("dmy", "mdy")]]
EPOCH = datetime(1970, 1, 1)
MICRO = timedelta(microseconds=1)


@lru_cache(maxsize=4096)
def _zone(name: str) -> ZoneInfo | None:
    by_case = {name, name.upper(), "/".join("_".join(p.capitalize() for p in x.split("_")) for x in name.split("/"))}
    for form in by_case:
        try:
            return ZoneInfo(form)
        except (KeyError, ValueError, OSError):
            continue
    return None


def _offset(text: str) -> timezone | ZoneInfo | None:
    """A zone from the end of a value: an offset, an abbreviation or a name; None if it is none of these."""
    text = text.strip("[]() ")
    if text[:1] in "+-" and text[1:2].isdigit():
        digits = text[1:].replace(":", "")
        minutes = int(digits[:2]) * 60 + int(digits[2:4] or 0)
        if int(digits[2:4] or 0) > 59 or minutes > 18 * 60:
            return None
        return timezone(timedelta(minutes=-minutes if text[0] == "-" else minutes))
    if text in ABBREVIATIONS:
        return timezone(timedelta(hours=ABBREVIATIONS[text]))
    return _zone(text)


def _instants(local: datetime, zone: timezone | ZoneInfo) -> list[int]:
    """Microseconds since 1970 UTC of a local time: two if it occurs twice, the earlier first."""
    if isinstance(zone, timezone):
        return [(local - EPOCH - zone.utcoffset(None)) // MICRO]
    first, second = (zone.utcoffset(local.replace(fold=k)) for k in (0, 1))
    one = (local - EPOCH - first) // MICRO
    # A skipped time has the greater offset second; it keeps the offset before the change.
    return [one] if second >= first else [one, (local - EPOCH - second) // MICRO]


def interpretations(value: str | None, zone_name: str | None, date_order: str | None) -> list[tuple[int, int, float]]:
    """All valid readings (kind, microseconds UTC, cost) of one text; none for null, unreadable or impossible values.

    A zone or offset in the value wins, else ``zone_name`` holds (UTC where that is null or unknown). A date alone is
    midnight there; digits alone are seconds, or milliseconds from 1e11 on; two-digit years are 20xx. Dates with slashes
    follow ``date_order``; where that is null both orders are readings. Of a local time that occurs twice both instants are
    readings, and the later one costs more than any switch of format can save.
    """
    if value is None:
        return []
    text = SPACE.sub(" ", value).strip().lower()
    if text.isdigit() and text.isascii():
        number = int(text)
        if len(text) > 18:
            return []
        return [(0, number * (1000 if number >= 100_000_000_000 else 1_000_000), 0.0)]
    zoned = ZONED.search(text)
    if zoned:  # an offset followed by the zone's name: the offset is exact
        text = text[: zoned.end("z")]
    for index, (name, shape) in enumerate(SHAPES):
        match = shape.fullmatch(text)
        if not match:
            continue
        part = match.groupdict()
        if "mn" in part:
            month = MONTH_OF.get(part["mn"])
            if month is None:
                continue
            pairs = [(0, int(part["d"]), month)]
        elif name == "slash":
            one, two = int(part["a"]), int(part["b"])
            order = (date_order or "").strip().lower()
            pairs = [(0, one, two)] * (order != "mdy") + [(1, two, one)] * (order != "dmy")
            if one == two:
                pairs = pairs[:1]
        else:
            pairs = [(0, int(part["d"]), int(part["m"]))]
        zone = _offset(part["z"]) if part["z"] else None
        if part["z"] and zone is None:
            return []
        zone = zone or (_zone(zone_name) if zone_name else None) or timezone.utc
        hour, minute, second = int(part["h"] or 0), int(part["mi"] or 0), int(part["s"] or 0)
        if part["ap"]:
            if not part["h"] or not 1 <= hour <= 12:
                return []
            hour = hour % 12 + (12 if part["ap"][0] == "p" else 0)
        micro = int((part["f"] or "")[:6].ljust(6, "0"))
        year = int(part["y"]) + (2000 if len(part["y"]) == 2 else 0)
        found = []
        for kind, day, month in pairs:
            try:
                local = datetime(year, month, day, hour, minute, second, micro)
                for later, at in enumerate(_instants(local, zone)):
                    found.append((1 + 2 * index + kind, at, 1e6 * later))
            except (ValueError, OverflowError):
                continue
        return found
    return []


READ = "pos long, source_key string, field_name string, readings array<struct<kind:int,at:long,cost:double>>"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        readings = [interpretations(*x) for x in zip(batch["value"], batch["zone_name"], batch["date_order"])]
        out = batch[["pos", "source_key", "field_name"]].assign(readings=readings)
        yield out[[bool(r) for r in readings]]


SWITCH_COST, BACKWARD_COST, SLACK_US = 1.0, 1.0, 7 * 86_400 * 1_000_000
#: Input positions of a block in which settled neighbours are looked for at once.
BLOCK = 1 << 17


def _step(a: tuple[int, int] | None, kind: int, at: int) -> float:
    if a is None:
        return 0.0
    return SWITCH_COST * (a[0] != kind) + BACKWARD_COST * (at < a[1] - SLACK_US)


def viterbi(rows: list[list[tuple[int, int, float]]], before: tuple[int, int] | None, after: tuple[int, int] | None) -> list[int]:
    """The cheapest reading of each row, in order, between two rows that have one reading; ties take the first reading."""
    paths = [(c + _step(before, k, at), [i]) for i, (k, at, c) in enumerate(rows[0])]
    back: list[list[int]] = []
    costs = [p[0] for p in paths]
    for previous, row in zip(rows, rows[1:]):
        best, now = [], []
        for k, at, c in row:
            options = [x + _step((p[0], p[1]), k, at) for x, p in zip(costs, previous)]
            i = min(range(len(options)), key=options.__getitem__)
            best.append(i)
            now.append(options[i] + c)
        back.append(best)
        costs = now
    if after is not None:
        costs = [x + _step((k, at), after[0], after[1]) for x, (k, at, _) in zip(costs, rows[-1])]
    i = min(range(len(costs)), key=costs.__getitem__)
    path = [i]
    for best in reversed(back):
        i = best[i]
        path.append(i)
    return path[::-1]


def _decide(batch: pd.DataFrame) -> pd.DataFrame:
    batch = batch.sort_values("pos", kind="stable")
    rows = [[(r["kind"], r["at"], r["cost"]) for r in x] for x in batch["readings"]]
    first = batch.iloc[0]
    ends = [None if x is None else (x["kind"], x["at"]) for x in (first["before"], first["after"])]
    path = viterbi(rows, *ends)
    return pd.DataFrame({"pos": batch["pos"], "field_name": batch["field_name"], "utc_us": [r[i][1] for r, i in zip(rows, path)]})


def normalise_timestamps(
    rows: DataFrame,
    clock: DataFrame,
    *,
    pos: str = "pos",
    source: str = "source_id",
    fields: tuple[str, ...] = ("published_at", "fetched_at"),
    block: int = BLOCK,
) -> DataFrame:
    """(pos, field_name, utc_us): one row per value that names an existing date.

    ``clock`` has source_id, zone_name and date_order. All valid readings of a value are made as an array. A value with one
    reading is settled, and so is the end of every chain that passes it; the runs of values with several readings
    between two settled ones are decided by Viterbi over the source's record order, where a switch of format and a jump
    back of more than a week cost alike. Neighbours are looked for in blocks of ``block`` input positions, so that a source with a third
    of all rows is many groups, and carried from block to block, so that ``block`` never changes a reading. A run is one group. Rows with a null ``pos`` are left out; a null or unknown source is read as UTC with both date
    orders; repeated rows give repeated results; extra columns are ignored; empty tables give no rows.
    """
    zones = clock.select(
        F.col("source_id").alias("_cs"), F.col("zone_name").cast("string"), F.col("date_order").cast("string")
    ).dropDuplicates(["_cs"])
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])
    values = (
        rows.select(F.col(pos).cast("long").alias("pos"), F.col(source).cast("string").alias("source_key"), F.explode(pairs).alias("v"))
        .select("pos", "source_key", "v.*")
        .where("value is not null and pos is not null")
    )
    values = values.join(zones, F.col("source_key") == F.col("_cs"), "left")
    read = values.select("pos", "source_key", "field_name", "value", "zone_name", "date_order").mapInPandas(_read, READ)
    single = F.size("readings") == 1
    # Both neighbours are running aggregates: a frame that ends unbounded would be read again for each row.
    of_chain = Window.partitionBy("source_key", "field_name", "block")
    up = of_chain.orderBy("pos", "readings").rowsBetween(Window.unboundedPreceding, -1)
    down = of_chain.orderBy(F.desc("pos"), F.desc("readings")).rowsBetween(Window.unboundedPreceding, -1)
    anchor = F.when(single, F.struct(F.col("readings")[0]["kind"].alias("kind"), F.col("readings")[0]["at"].alias("at"), F.col("pos").alias("p")))
    read = read.withColumn("block", F.floor(F.col("pos") / block))
    # The ends of each block's settled values, carried over its neighbours.
    order = F.struct("pos", "readings")
    ends = read.where(single).groupBy("source_key", "field_name", "block").agg(
        F.max_by(anchor, order).alias("last"), F.min_by(anchor, order).alias("first")
    )
    ends = read.select("source_key", "field_name", "block").distinct().join(
        ends.select(F.col("source_key").alias("_k"), F.col("field_name").alias("_f"), F.col("block").alias("_b"), "last", "first"),
        F.col("source_key").eqNullSafe(F.col("_k")) & (F.col("field_name") == F.col("_f")) & (F.col("block") == F.col("_b")),
        "left",
    )
    of_source = Window.partitionBy("source_key", "field_name")
    earlier = of_source.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = of_source.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        F.col("source_key").alias("_k"),
        F.col("field_name").alias("_f"),
        F.col("block").alias("_b"),
        F.last("last", ignorenulls=True).over(earlier).alias("earlier"),
        F.last("first", ignorenulls=True).over(later).alias("later"),
    )
    placed = read.select(
        "*",
        F.last(anchor, ignorenulls=True).over(up).alias("_before"),
        F.last(anchor, ignorenulls=True).over(down).alias("_after"),
    )
    settled = placed.where(single).select("pos", "field_name", F.col("readings")[0]["at"].alias("utc_us"))
    runs = placed.where(~single).join(
        ends, F.col("source_key").eqNullSafe(F.col("_k")) & (F.col("field_name") == F.col("_f")) & (F.col("block") == F.col("_b")), "left"
    )
    runs = runs.withColumns({"before": F.coalesce("_before", "earlier"), "after": F.coalesce("_after", "later")})
    runs = runs.select("source_key", "field_name", "pos", "readings", "before", "after", F.col("before.p").alias("run"))
    decided = runs.groupBy("source_key", "field_name", "run").applyInPandas(
        _decide, "pos long, field_name string, utc_us long"
    )
    return settled.unionByName(decided)
