"""New batches against everything accepted before: Bloom-prescreened fingerprints in a persistent store."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veredas.functions.text import fold_py
from veredas.functions.url import canonical_url
from veredas.llm.similarity import word_set
from veredas.operators.set_join import (
    ASK,
    HOT,
    KEYS,
    MET,
    PAIR,
    SKETCH,
    WIDE,
    Order,
    hot_pairs,
    key_columns,
    key_frame,
    key_rows,
    may_match,
    meet,
    overlap_holds,
    smaller_has_key,
    wide_sketches,
    word_order,
)
from veredas.session import discard, materialize, scratch

#: Bits of one part of the Bloom filter, and its number of hashes.
PART_BITS, HASHES = 1 << 20, 4
#: Keys for which a part is laid out: about one in a hundred others passes.
KEYS_PER_PART = PART_BITS // 10
#: Counted rows up to which a side is broadcast (ids, hashes and sizes: some 100 bytes each at most); beyond it is merged.
BROADCAST_ROWS = 200_000
#: Rows of a delivery that one file of the replay holds.
ROWS_PER_FILE = 20_000


def sided(rows: DataFrame, count: int) -> DataFrame:
    """Rows whose number is known, as a side of a join: broadcast if they are few, else never."""
    return F.broadcast(rows) if count <= BROADCAST_ROWS else rows.hint("merge")


def counted(rows: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``rows`` as a written table, and counts made while they were written."""
    seen = Observation()
    table = materialize(rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()]), name)
    return table, seen.get


def _places(keys: np.ndarray) -> np.ndarray:
    """Bit positions of keys, one row for each hash."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    y = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) | np.uint64(1)
    return np.stack([((x + np.uint64(i) * y) >> np.uint64(20)) % np.uint64(PART_BITS) for i in range(HASHES)]).astype(np.int64)


def screened(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """mapInPandas body: pairs of a delivery's key rows that share a key, and the rows whose key the filter may hold (``ASK``).

    Rows come by part and key; a part's bits (even slots) come right before its keys.
    """

    def asked(batches: Iterator[pd.DataFrame], out: list[pd.DataFrame]) -> Iterator[dict[str, np.ndarray]]:
        part, bits = -1, None
        for batch in batches:
            slots, x = batch["slot"].to_numpy(), key_columns(batch)
            hit = np.zeros(len(batch), dtype=bool)
            bounds = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
            for start, end in zip(bounds, bounds[1:]):
                if start == end:
                    continue
                if slots[start] >> 1 != part:
                    part, bits = int(slots[start] >> 1), None
                if not slots[start] & 1:
                    for b in batch["bits"].iloc[start:end]:
                        more = np.frombuffer(b, dtype=np.uint8)
                        bits = more if bits is None else bits | more
                elif bits is not None:
                    inside = np.ones(end - start, dtype=bool)
                    for row in _places(x["key"][start:end]):
                        inside &= (bits[row >> 3] >> (row & 7).astype(np.uint8) & 1).astype(bool)
                    hit[start:end] = inside
            if hit.any():
                out.append(key_frame(ASK, x, hit))
            own = (slots & 1).astype(bool)
            yield {c: v[own] for c, v in x.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[pd.DataFrame] = []
        for found in meet(asked(batches, out), threshold):
            yield found
            while out:
                yield out.pop()
        yield from out

    return run


#: Parts that a task fills before it writes them; a part may be written in several pieces, which count together.
PARTS_AT_ONCE = 256


def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bits of each part with the bits of its keys set, in whatever order they come."""
    held: dict[int, np.ndarray] = {}

    def out() -> pd.DataFrame:
        rows = [(part, bits.tobytes()) for part, bits in held.items()]
        held.clear()
        return pd.DataFrame(rows, columns=["part", "bits"])

    for batch in batches:
        order = np.argsort(batch["slot"].to_numpy(), kind="stable")
        slots, keys, olds = batch["slot"].to_numpy()[order], batch["key"].to_numpy(dtype=np.int64)[order], batch["bits"].to_numpy()[order]
        bounds = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
        for start, end in zip(bounds, bounds[1:]):
            if start == end:
                continue
            part = int(slots[start] >> 1)
            if part not in held:
                if len(held) >= PARTS_AT_ONCE:
                    yield out()
                held[part] = np.zeros(PART_BITS // 8, dtype=np.uint8)
            if slots[start] & 1:
                for row in _places(keys[start:end]):
                    np.bitwise_or.at(held[part], row >> 3, np.left_shift(np.uint8(1), (row & 7).astype(np.uint8)))
            else:
                for x in olds[start:end]:
                    held[part] |= np.frombuffer(x, dtype=np.uint8)
    yield out()


class FingerprintStore:
    """What has been accepted, in a folder that all executors share: exact keys, word sets, their fingerprints and the filter.

    A delivery adds files and never rewrites the others; the filter, which is small beside the fingerprints, is written anew, with
    more parts as the keys grow in number. What counts is named by a manifest, written last and moved to its place at once: a
    delivery that is broken off leaves files that no manifest names. ``open`` reads the newest manifest.
    """

    def __init__(self, spark: SparkSession, folder: str, state: dict, order: Order) -> None:
        self.spark, self.folder, self.state, self.order = spark, folder.rstrip("/"), state, order

    @classmethod
    def create(cls, spark: SparkSession, folder: str, threshold: float, order: Order) -> FingerprintStore:
        """An empty store. ``order`` is for good: any order gives the same matches, one that has counted like texts the fewest candidates."""
        state = {"version": 0, "threshold": threshold, "parts": 1, "keys": 0, "filter": None, "tables": {"rows": [], "keys": []}}
        store = cls(spark, folder, state, order)
        ranks = pd.DataFrame({"hash": order.hashes.astype(np.int64), "rank": order.ranks.astype(np.int64)})
        spark.createDataFrame(ranks, "hash long, rank long").coalesce(1).write.parquet(f"{store.folder}/order")
        store.commit()
        return store

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> FingerprintStore:
        """The store as its last complete delivery left it."""
        folder = folder.rstrip("/")
        fs, path = _files(spark, f"{folder}/manifests")
        newest = max((s.getPath() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json")), key=lambda x: x.getName())
        state = json.loads("".join(r[0] for r in spark.read.text(newest.toString()).collect()))
        ranks = spark.read.parquet(f"{folder}/order").toPandas().sort_values("hash")
        return cls(spark, folder, state, Order(ranks["hash"].to_numpy(dtype=np.int64), ranks["rank"].to_numpy(dtype=np.int64)))

    @property
    def threshold(self) -> float:
        return self.state["threshold"]

    def commit(self, **changes: object) -> None:
        self.state = {**self.state, **changes, "version": self.state["version"] + 1}
        name = f"{self.state['version']:09d}.json"
        fs, path = _files(self.spark, f"{self.folder}/manifests/.{name}")
        stream = fs.create(path, True)
        stream.write(bytearray(json.dumps(self.state).encode()))
        stream.close()
        if not fs.rename(path, _files(self.spark, f"{self.folder}/manifests/{name}")[1]):
            raise OSError(f"another delivery has written version {self.state['version']}")

    def write(self, table: str, rows: DataFrame) -> str:
        """Writes rows of a table; they count once a manifest names them."""
        name = f"{table}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{name}")
        return name

    def read(self, table: str) -> DataFrame | None:
        names = self.state["tables"][table]
        return self.spark.read.schema(STORED[table]).parquet(*[f"{self.folder}/{n}" for n in names]) if names else None

    def routed(self, keys: DataFrame, parts: int, old: str | None) -> DataFrame:
        """Rows with a key and the bits of the filter, by part: slot is twice the part, and one more for keys."""
        both = keys.select((F.pmod(F.col("key"), F.lit(parts)) * 2 + 1).alias("slot"), F.lit(None).cast("binary").alias("bits"), *keys.columns)
        if old:
            known = self.spark.read.schema("part int, bits binary").parquet(f"{self.folder}/{old}")
            none = [(F.lit(False) if c == "small" else F.lit(0)).cast(keys.schema[c].dataType).alias(c) for c in keys.columns]
            both = known.select((F.col("part").cast("long") * 2).alias("slot"), "bits", *none).unionByName(both)
        return both.repartition(F.shiftright("slot", 1))

    def extended_filter(self, name: str, count: int) -> dict[str, object]:
        """The filter with the ``count`` keys of a new file of fingerprints; made again with more parts where they have become too many."""
        keys, parts, old = [name], self.state["parts"], self.state["filter"]
        total = self.state["keys"] + count
        if total > parts * KEYS_PER_PART:
            parts, old, keys = 2 * -(-total // KEYS_PER_PART), None, [*self.state["tables"]["keys"], name]
        rows = self.spark.read.schema(KEYS).parquet(*[f"{self.folder}/{k}" for k in keys]).select("key")
        made = self.routed(rows, parts, old).select("slot", "bits", "key").mapInPandas(fill, "part int, bits binary")
        return {"parts": parts, "keys": total, "filter": self.write("filter", made)}


SETS = f"exact array<string>, content string, tokens array<long>, {SKETCH}"
STORED = {"rows": SETS, "keys": KEYS}


def _files(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def _title_form(titles: pd.Series) -> pd.Series:
    return titles.map(lambda t: " ".join(fold_py(t).split()), na_action="ignore")


def keyed_batch(rows: DataFrame, contents: DataFrame, *, pos: str, source: str, url: str, title: str) -> DataFrame:
    """(pos, exact array<string>, content string, tokens): what a row is compared by.

    ``exact`` has the keys of its canonical URL and of its source with its title; ``content`` that of its word set.
    ``contents`` is (pos, tokens) of the rows that have a content.
    """
    name = F.pandas_udf(_title_form, "string")(F.col(title).cast("string"))
    keyed = rows.select(
        F.col(pos).cast("long").alias("pos"),
        F.concat(F.lit("u"), F.md5(canonical_url(F.col(url).cast("string")))).alias("u"),
        F.when(name != "", F.concat(F.lit("t"), F.md5(F.concat_ws("\x1f", F.col(source).cast("string"), name)))).alias("t"),
        F.col(source).isNotNull().alias("has_source"),
    ).where("pos is not null")
    keyed = keyed.join(contents.select(F.col("pos").alias("_pos"), "tokens"), F.col("pos") == F.col("_pos"), "left")
    return keyed.select(
        "pos",
        F.filter(F.array("u", F.when(F.col("has_source"), F.col("t"))), lambda x: x.isNotNull()).alias("exact"),
        F.when(F.size("tokens") > 0, F.concat(F.lit("c"), F.md5(F.array_join(F.col("tokens").cast("array<string>"), " ")))).alias("content"),
        "tokens",
    )


def with_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: rows (exact, content, tokens, id) with the size and wide parity of their sets; rows without words have 0."""
    none = np.empty(0, dtype=np.int64)
    for batch in batches:
        tokens = batch["tokens"].map(lambda t: none if t is None else t)
        sketch = [*wide_sketches(iter([batch[["id"]].assign(tokens=tokens)]))]
        yield pd.concat([batch[["exact", "content", "tokens"]].reset_index(drop=True), *([pd.concat(sketch, ignore_index=True)] if sketch else [])], axis=1)


def match_exact(store: FingerprintStore, batch: DataFrame, count: int) -> DataFrame:
    """(pos, accepted_pos): rows with a URL, title or word set of the store, and its least pos."""
    own = batch.select("pos", F.explode(every_key()).alias("key"))
    old = store.read("rows").select(F.col("id").alias("old"), F.explode(every_key()).alias("key"))
    return old.join(sided(own, 3 * count), "key").groupBy("pos").agg(F.min("old").alias("accepted_pos"))


def every_key() -> Column:
    return F.filter(F.concat("exact", F.array("content")), lambda x: x.isNotNull())


def match_fingerprints(store: FingerprintStore, sets: DataFrame, count: int) -> tuple[DataFrame, int]:
    """(id, other, old), and their number: the delivery's sets that are similar to one of the store (``old``) or to each other.

    Key rows go through one exchange, by part of the filter; where they meet the part's bits they also meet each other. Those that the
    filter lets through look the fingerprints up; those, the sketches and the sets are read where they lie and not moved,
    as long as the asking side is few rows.
    """
    keys = sets.withColumn("salt", F.lit(0)).select("id", "salt", "tokens").mapInPandas(key_rows(store.order, store.threshold), KEYS)
    routed = store.routed(keys, store.state["parts"], store.state["filter"]).sortWithinPartitions("slot", "key")
    met, n = counted(routed.mapInPandas(screened(store.threshold), MET), "met", pairs=F.col("what") == PAIR, hot=F.col("what") == HOT, ask=F.col("what") == ASK)
    pairs = met.where(F.col("what") == PAIR).select("id", "other")
    if n["hot"]:
        pairs = pairs.unionByName(hot_pairs(met.where(F.col("what") == HOT), store.threshold))
    pairs = pairs.withColumn("old", F.lit(False))
    if n["ask"]:
        asked = sided(met.where(F.col("what") == ASK).drop("what", "other"), n["ask"])
        looked = store.read("keys").alias("o").join(asked.alias("n"), F.col("o.key") == F.col("n.key"))
        looked = looked.where(smaller_has_key("o", "n") & may_match("o", "n", store.threshold))
        pairs = pairs.unionByName(looked.select(F.col("n.id").alias("id"), F.col("o.id").alias("other"), F.lit(True).alias("old")))
    pairs, n = counted(pairs.distinct(), "pairs")
    old = store.read("rows")
    known = sets.select("tokens", *_names(SKETCH))
    known = known if old is None else old.select("tokens", *_names(SKETCH)).unionByName(known)
    near = known.alias("y").join(sided(pairs, n["rows"]).alias("p"), F.col("p.other") == F.col("y.id"))
    near = near.join(sided(sets.select(*_names(SKETCH)), count).alias("x"), F.col("p.id") == F.col("x.id"))
    near = near.where(may_match("x", "y", store.threshold, tuple(f"w{i}" for i in range(WIDE))))
    links = (
        near.select(F.col("p.id").alias("id"), F.col("p.other").alias("other"), F.col("p.old").alias("old"), F.col("y.tokens").alias("other_tokens"))
        .join(sets.select("id", "tokens"), "id")
        .where(overlap_holds("tokens", "other_tokens", store.threshold))
        .select("id", "other", "old")
    )
    links, n = counted(links, "links")
    discard(met)
    discard(pairs)
    return links, n["rows"]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


#: Rows and links, or rows of (row, key), that one task settles in order; more go through rounds until so few are open.
SETTLED_TOGETHER = 300_000


def _settle(batch: pd.DataFrame) -> pd.DataFrame:
    """Takes the open rows in order of turn and pos: refused if one of their keys has been taken before, else accepted with their own keys."""
    held = batch[batch["taken"].notna()]
    taken = {k: (int(u), int(t)) for k, u, t in zip(held["key"], held["taken_turn"], held["taken"])}
    batch = batch.sort_values(["turn", "pos"], kind="stable")
    keys, own = batch["key"].to_numpy(), batch["own"].to_numpy()
    turns, positions = batch["turn"].to_numpy(), batch["pos"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (turns[1:] != turns[:-1]) | (positions[1:] != positions[:-1])])) if len(batch) else []
    found = []
    for start, end in zip(starts, [*starts[1:], len(batch)]):
        here = (int(turns[start]), int(positions[start]))
        least = min([p for u, p in (taken[k] for k in keys[start:end] if k in taken) if (u, p) < here], default=None)
        found.append((*here, here[1] if least is None else least, least is not None))
        if least is None:
            for k, mine in zip(keys[start:end], own[start:end]):
                if mine:
                    taken.setdefault(k, here)
    return pd.DataFrame(found, columns=["turn", "pos", "accepted_pos", "refused"])


def settled(waiting: DataFrame) -> DataFrame:
    """(turn, pos, accepted_pos, refused) of the rows of (at, key, own, taken), in one task; accepted ones have their own pos."""
    flat = waiting.select("at.turn", "at.pos", "key", "own", F.col("taken.turn").alias("taken_turn"), F.col("taken.pos").alias("taken"))
    return flat.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_settle, "turn int, pos long, accepted_pos long, refused boolean")


ROW, LINK, HIT, NEAR = 0, 1, 2, 3
REFUSED = "accepted_pos long, pos long, by_store boolean"


def _settle_delivery(batch: pd.DataFrame) -> pd.DataFrame:
    """A small delivery in one task: its rows, the links of its word sets (pos, other) to each other and into the store, and its rows' exact matches there."""
    by = dict(list(batch.groupby("what")))
    rows, links, hits, olds = (by.get(k, batch.iloc[:0]) for k in (ROW, LINK, HIT, NEAR))
    rows = rows.sort_values(["turn", "pos"], kind="stable")
    content_of = dict(zip(rows["pos"], rows["content"]))
    in_store = dict(zip(hits["pos"].tolist(), hits["other"].tolist()))
    near_store: dict[str, int] = {}
    near: dict[str, list[str]] = {}
    for pos, other in zip(olds["pos"].tolist(), olds["other"].tolist()):
        own = content_of[pos]
        near_store[own] = min(other, near_store.get(own, other))
    for pos, other in zip(links["pos"].tolist(), links["other"].tolist()):
        own = content_of[pos]
        near.setdefault(own, []).append(content_of[other])
        near.setdefault(content_of[other], []).append(own)
    taken: dict[str, int] = {}
    found = []
    for pos, exact, content in zip(rows["pos"].tolist(), rows["exact"], rows["content"]):
        keys = [*exact] if content is None else [*exact, content]
        old = [x for x in (in_store.get(pos), near_store.get(content)) if x is not None]
        own = [taken[k] for k in (*keys, *near.get(content, ())) if k in taken]
        if old or own:
            found.append((min(old + own), pos, bool(old)))
        else:
            taken |= {k: pos for k in keys if k not in taken}
    return pd.DataFrame(found, columns=["accepted_pos", "pos", "by_store"])


def refused_rows(store: FingerprintStore, names: DataFrame, sets: DataFrame, links: DataFrame, count: int, linked: int) -> DataFrame:
    """(accepted_pos, pos, by_store) of a delivery's refused rows (turn, pos, exact, content)."""
    exact = match_exact(store, names, count) if store.state["tables"]["rows"] else None
    if count + linked <= SETTLED_TOGETHER:
        blank = {"turn": F.lit(0), "other": F.lit(0).cast("long"), "exact": F.lit(None).cast("array<string>"), "content": F.lit(None).cast("string")}
        every = names.select(F.lit(ROW).alias("what"), "turn", "pos", blank["other"].alias("other"), "exact", "content")
        pairs = [links.select(F.when(F.col("old"), NEAR).otherwise(LINK).alias("what"), F.col("id").alias("pos"), "other")]
        if exact is not None:
            pairs.append(exact.select(F.lit(HIT).alias("what"), "pos", F.col("accepted_pos").alias("other")))
        for rows in pairs:
            every = every.unionByName(rows.select("*", *[blank[c].alias(c) for c in ("turn", "exact", "content")]))
        return every.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_settle_delivery, REFUSED)
    content_of = sets.select("id", "content")
    inside = links.where("not old").join(content_of.select("id", F.col("content").alias("a")), "id")
    inside = inside.join(content_of.select(F.col("id").alias("other"), F.col("content").alias("b")), "other").select("a", "b")
    if exact is None:
        return resolve(names, inside).select("accepted_pos", "pos", F.lit(False).alias("by_store"))
    near = links.where("old").groupBy("id").agg(F.min("other").alias("accepted_pos")).join(content_of, "id").select("content", "accepted_pos")
    near = names.select("pos", "content").join(near, "content").select("pos", "accepted_pos")
    known = materialize(exact.unionByName(near).groupBy("pos").agg(F.min("accepted_pos").alias("accepted_pos")), "known")
    inner = resolve(names, inside, known).select("accepted_pos", "pos", F.lit(False).alias("by_store"))
    both = inner.unionByName(known.select("accepted_pos", "pos", F.lit(True).alias("by_store")))
    return both.groupBy("pos").agg(F.min("accepted_pos").alias("accepted_pos"), F.max("by_store").alias("by_store")).select("accepted_pos", "pos", "by_store")


def resolve(rows: DataFrame, links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(pos, accepted_pos) of every row refused among ``rows`` themselves, taken in order of turn and pos.

    ``rows`` is (turn, pos, exact, content); rows match by a common key or by ``links`` (a, b) between contents. A row is accepted once
    no earlier row that matches it is left undecided or accepted, and refused once one is accepted; each round decides the
    first of every chain, by the least row of each key alone, so no group of rows with one key is collected or paired. Once
    at most ``SETTLED_TOGETHER`` keys of undecided rows are left, one task takes these in order, so long chains end too.
    Rows of ``known`` (pos) are refused beforehand; of these come out those that match an accepted row of ``rows``, too.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rows = rows.select(F.struct("turn", "pos").alias("at"), "exact", "content", F.lit(1).alias("own"))
    if known is not None:
        rows = rows.withColumn("pos", F.col("at.pos")).join(known.select("pos", F.lit(0).alias("not_own")), "pos", "left")
        rows = rows.select("at", "exact", "content", F.coalesce("not_own", "own").alias("own"))
    own = rows.select("at", F.explode(every_key()).alias("key"), "own")
    near = rows.select("at", "content").join(both, F.col("content") == F.col("a")).select("at", F.col("b").alias("key"), F.lit(0).alias("own"))
    watched = own.unionByName(near).groupBy("at", "key").agg(F.max("own").alias("own"))
    shared = watched.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    watched, n = counted(watched.join(shared, "key").select("at", "key", "own"), "watched")
    none = F.lit(None).cast("struct<turn:int,pos:bigint>")
    if n["rows"] <= SETTLED_TOGETHER:
        return settled(watched.withColumn("taken", none)).where("refused").select("pos", "accepted_pos")
    kept = watched.where("own = 1").select("at", "key")
    state = watched.groupBy("at").agg(F.max("own").alias("own")).select("at", F.when(F.col("own") == 1, 0).otherwise(2).alias("status"))
    state = materialize(state, "state")
    while True:
        undecided = state.where("status = 0").select("at")
        waiting = watched.join(undecided, "at")
        count = waiting.count()
        if not count:
            break
        taken = kept.join(state.where("status = 1"), "at").groupBy("key").agg(F.min("at").alias("taken"))
        if count <= SETTLED_TOGETHER:
            asked = waiting.join(taken, "key", "left").select("at", "key", "own", "taken")
            decided = settled(asked).select(F.struct("turn", "pos").alias("at"), F.when(F.col("refused"), 2).otherwise(1).alias("now"))
        else:
            first = kept.join(undecided, "at").groupBy("key").agg(F.min("at").alias("first"))
            seen = waiting.join(first, "key", "left").join(taken, "key", "left")
            seen = seen.groupBy("at").agg(F.min("first").alias("first"), F.min("taken").alias("taken"))
            decided = seen.select(
                "at",
                F.when(F.col("taken") < F.col("at"), 2).when(F.coalesce("first", "at") >= F.col("at"), 1).otherwise(0).alias("now"),
            )
        after = state.join(decided, "at", "left").select("at", F.coalesce("now", "status").cast("int").alias("status"))
        after = materialize(after, "state")
        discard(state)
        state = after
    taken = kept.join(state.where("status = 1"), "at").groupBy("key").agg(F.min("at").alias("taken"))
    refused = watched.join(state.where("status = 2").select("at"), "at").join(taken, "key").where("taken < at")
    return refused.groupBy(F.col("at.pos").alias("pos")).agg(F.min("taken.pos").alias("accepted_pos"))


def accept_delivery(store: FingerprintStore, batch: DataFrame, count: int | None = None) -> DataFrame:
    """(accepted_pos, pos, by_store) of the delivery's refused rows; what is accepted goes into the store.

    ``batch`` is a written result of :func:`keyed_batch`, of one or more batches, all later than what the store has; their rows are taken
    in order of ``turn``, if there is such a column (the batch's number within the delivery), and pos. ``count`` is its rows, where they are known. A row is refused when it matches a row accepted before, of the store or of its own
    delivery: by canonical URL, by source and title, or by word sets of a similarity of at least the store's threshold. Rows with a
    null or empty url, title or content have no such key; a row without any key is accepted. pos must be unique. Only the delivery's own
    fingerprints are computed: the filter screens them, the store's are looked up by key, and hits are verified on the whole word sets.
    Only accepted rows add fingerprints, sets and bits of the filter.
    """
    turn = F.col("turn") if "turn" in batch.columns else F.lit(0)
    names, count = batch.select(turn.cast("int").alias("turn"), "pos", "exact", "content"), batch.count() if count is None else count
    first = batch.where("content is not null").groupBy("content").agg(F.min(F.struct("pos", "tokens")).alias("first"))
    first = first.select(F.lit(None).cast("array<string>").alias("exact"), "content", "first.tokens", F.col("first.pos").alias("id"))
    sets, n = counted(first.mapInPandas(with_sketches, SETS), "sets")
    links, linked = match_fingerprints(store, sets, n["rows"])
    refused, n = counted(refused_rows(store, names, sets, links, count, linked), "refused")
    accepted = batch.join(sided(refused.select("pos"), n["rows"]), "pos", "left_anti").withColumnRenamed("pos", "id")

    def prints() -> tuple[str, dict[str, object]]:
        seen = Observation()
        # Of one word set at most one row is accepted.
        own = accepted.where("content is not null").select("id", F.lit(0).alias("salt"), "tokens")
        rows = own.mapInPandas(key_rows(store.order, store.threshold), KEYS).observe(seen, F.count(F.lit(1)).alias("rows"))
        name = store.write("keys", rows)
        return name, store.extended_filter(name, seen.get["rows"])

    with ThreadPoolExecutor(2) as pool:
        made = pool.submit(prints)
        rows = pool.submit(store.write, "rows", accepted.select("exact", "content", "tokens", "id").mapInPandas(with_sketches, SETS))
        (keys, filtered), before = made.result(), store.state["tables"]
        tables = {"rows": [*before["rows"], rows.result()], "keys": [*before["keys"], keys]}
    store.commit(tables=tables, **filtered)
    discard(sets)
    discard(links)
    return refused.select("accepted_pos", "pos", "by_store")


def replay(
    rows: DataFrame,
    contents: DataFrame,
    *,
    batch: str = "run_date",
    pos: str = "pos",
    source: str = "source_id",
    url: str = "url",
    title: str = "title",
    content_texts: list[str],
    threshold: float = 0.8,
    together: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """(accepted_pos, pos, by_store) of all refused rows, the batches taken in order through a fresh store in ``folder``.

    Rows are taken in order of batch and pos; pos need not rise with the batch. Each delivery has ``together`` batches; the number changes the
    work, never the result. Rows with a null batch or pos are left out.
    """
    spark = rows.sparkSession
    tokens = contents.select(F.col(pos).cast("long").alias("pos"), word_set(*[F.col(c) for c in content_texts]).alias("tokens"))
    keyed = keyed_batch(rows.where(F.col(batch).isNotNull()), tokens, pos=pos, source=source, url=url, title=title)
    dates = rows.select(F.col(pos).cast("long").alias("pos"), F.col(batch).cast("string").alias("day")).where("pos is not null and day is not null")
    days = {r["day"]: r["count"] for r in dates.groupBy("day").count().collect()}
    order = sorted(days)
    number_of = F.create_map(*[F.lit(x) for i, d in enumerate(order) for x in (d, i)]) if order else F.create_map(F.lit(""), F.lit(0))
    files = max(1, *[-(-n * together // ROWS_PER_FILE) for n in [1, *days.values()]])
    number = F.element_at(number_of, F.col("day"))
    keyed = keyed.join(dates.select("pos", (number % together).cast("int").alias("turn"), F.floor(number / together).cast("int").alias("slice")), "pos")
    path = scratch(spark, "keyed")
    keyed.repartition("slice", F.pmod(F.xxhash64("pos"), F.lit(files))).write.partitionBy("slice").parquet(path)
    if not order:
        return keyed.select(F.col("pos").alias("accepted_pos"), "pos", F.lit(False).alias("by_store")).where("false")
    read = spark.read.schema(keyed.drop("slice").schema)
    every = read.parquet(*[f"{path}/slice={i}" for i in range(-(-len(order) // together))])
    known = every.where("content is not null").select("tokens")
    store = FingerprintStore.create(spark, folder or scratch(spark, "store"), threshold, word_order(known, known.count()))
    results = []
    for i in range(-(-len(order) // together)):
        count = sum(days[d] for d in order[i * together : (i + 1) * together])
        results.append(accept_delivery(store, read.parquet(f"{path}/slice={i}"), count))
    return reduce(DataFrame.unionByName, results)
