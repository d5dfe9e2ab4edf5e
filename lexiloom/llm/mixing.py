"""Mixing sources to target weights over fixed-length token blocks.

Each source's documents, in a fixed pseudorandom order, form one stream of tokens that is packed into blocks of BLOCK tokens. The total
is the largest at which every source with documents meets its target share within its repeats (or a smaller one on request). Output shards
draw how many of their slots each source gets from a multinomial, each with a seed of its own, so a lost shard is drawn alike again. A
keyed permutation numbers all slots a source drew; numbers beyond its exact quota go to the sources that drew too few. Slot number j of a
source is block perm(j mod blocks) in pass j div blocks, perm being a keyed Feistel permutation, so no pass repeats a block. Slots and
blocks meet by an equi-join on (source, block). Only sums per source reach the driver.

Defined results: null and empty texts have no tokens; a target without documents gets 0; sources without target are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .bpe import token_counts

BLOCK = 256
SLOTS = 512
#: Shards that one row of the draw stands for.
GROUP = 64
#: Documents of a part of a source's order, about: no running sum passes through one task.
PART_DOCS = 20_000
SEED = 20_190_101


def block_pieces(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """source, block_no, doc_id, tok_from, tok_to: the piece of each document in each block (token offsets, end exclusive)."""
    c = counts.where("n_tokens > 0").withColumns({"h": F.xxhash64("doc_id", F.lit(SEED))})
    n = c.groupBy("source").agg(F.ceil(F.count("*") / PART_DOCS).alias("parts"))  # one row a source
    c = c.join(n, "source").withColumn("part", F.pmod(F.shiftright("h", 20), F.col("parts"))).drop("parts")
    w = Window.partitionBy("source", "part").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = c.withColumn("upto", F.sum("n_tokens").over(w))
    sizes = c.groupBy("source", "part").agg(F.sum("n_tokens").alias("size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).select("source", "part", "base")
    d = inner.join(base, ["source", "part"]).select("source", "doc_id", "n_tokens", (F.col("base") + F.col("upto") - F.col("n_tokens")).alias("at"))
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("n_tokens") - 1) / block)
    d = d.withColumn("block_no", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block_no") * block - F.col("at"), F.lit(0))
    end = F.least((F.col("block_no") + 1) * block - F.col("at"), F.col("n_tokens"))
    return d.select("source", "block_no", "doc_id", start.cast("long").alias("tok_from"), end.cast("long").alias("tok_to"))


def quotas(supply: dict[str, tuple[int, int]], targets: dict[str, tuple[float, int]], total_tokens: int | None = None) -> dict[str, int]:
    """Blocks per source: supply has (tokens, blocks), targets (share, max_repeats). Sources without tokens get 0.

    A source's blocks count with their mean size, as its last one is rarely full.
    """
    live = {s: t for s, t in targets.items() if supply.get(s, (0, 0))[0] > 0 and t[0] > 0 and t[1] > 0}
    if not live:
        return dict.fromkeys(targets, 0)
    mass = sum(t[0] for t in live.values())
    most = min(supply[s][0] * t[1] / (t[0] / mass) for s, t in live.items())
    n = most if total_tokens is None else min(most, total_tokens)
    return dict.fromkeys(targets, 0) | {s: min(supply[s][1] * t[1], round(n * t[0] / mass * supply[s][1] / supply[s][0])) for s, t in live.items()}


def draw_shard(shard: int, quota: np.ndarray, slots: int = SLOTS, seed: int = SEED) -> np.ndarray:
    """How many of a shard's slots each source gets: one multinomial draw with the shard's own seed. The last shard may be part-filled."""
    total = int(quota.sum())
    k = min(slots, total - shard * slots)
    return np.random.default_rng([seed, shard]).multinomial(k, quota / total)


def settled(number: np.ndarray, source: int, drawn: np.ndarray, quota: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(source, number) of a source's slots after the quotas: numbers beyond a source's quota fill up those that drew too few."""
    to, no = np.full(len(number), source), number.copy()
    over = np.maximum(drawn - quota, 0)
    under = np.maximum(quota - drawn, 0)
    out = number >= quota[source]
    if out.any():
        at = over[:source].sum() + number[out] - quota[source]
        upto = np.cumsum(under)
        to[out] = np.searchsorted(upto, at, side="right")
        no[out] = drawn[to[out]] + at - (upto - under)[to[out]]
    return to, no


def permute(j: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds on the next even power of two, walked until inside."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    x = j.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> np.uint64(half), x[todo] & np.uint64(mask)
        for r in range(4):
            with np.errstate(over="ignore"):
                f = (right + np.uint64((key * 4 + r + 1) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
                f ^= f >> np.uint64(29)
                f *= np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & np.uint64(mask))
        x[todo] = (left << np.uint64(half)) | right
        todo = x >= np.uint64(n)
    return x.astype(np.int64)


def mixture(docs: DataFrame, source_targets: DataFrame, total_tokens: int | None = None, block: int = BLOCK, slots: int = SLOTS) -> DataFrame:
    """shard, slot, source, pass_no, block_no, doc_id, tok_from, tok_to: the mixed corpus as pieces of documents in slots."""
    spark = docs.sparkSession
    targets = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in source_targets.where("source is not null").collect()}  # a table of weights: as many rows as sources have targets
    named = docs.where(F.col("source").isin(list(targets)))
    counts = stored(token_counts(named), "counts")
    supply = {r["source"]: (r["t"], -(-r["t"] // block)) for r in counts.groupBy("source").agg(F.sum("n_tokens").alias("t")).where("t > 0").collect()}
    plan = quotas(supply, targets, total_tokens)
    names = sorted(s for s, q in plan.items() if q > 0)
    quota = np.array([plan[s] for s in names], np.int64)
    blocks = [supply[s][1] for s in names]
    shards = -(-int(quota.sum()) // slots)
    groups = spark.range(-(-shards // GROUP)).withColumnRenamed("id", "group")
    groups = groups.repartition(max(1, min(4096, -(-shards // (4 * GROUP)))), "group")

    def shards_of(group: int) -> range:
        return range(group * GROUP, min(shards, (group + 1) * GROUP))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g in b.column(0).to_pylist():
                n = sum((draw_shard(i, quota, slots) for i in shards_of(g)), np.zeros(len(names), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(names), pa.int64()), pa.array(range(len(names)), pa.int32()), pa.array(n)], ["group", "no", "n"])

    per = groups.mapInArrow(sums, "group long, no int, n long")
    before = Window.partitionBy("no").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # one row for GROUP shards
    per = per.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per = stored(per.groupBy("group").agg(F.transform(F.sort_array(F.collect_list(F.struct("no", "base", "n"))), lambda x: F.struct(x["base"], x["n"])).alias("at")), "draws")
    drawn = np.zeros(len(names), np.int64)
    for r in per.select(F.posexplode("at").alias("no", "x")).groupBy("no").agg(F.sum("x.n").alias("n")).collect():
        drawn[r["no"]] = r["n"]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base = np.array([x["base"] for x in at], np.int64)
                for shard in shards_of(g):
                    m = draw_shard(shard, quota, slots)
                    to, no = zip(*(settled(permute(np.arange(base[k], base[k] + n), int(drawn[k]), SEED + 7 * k + 3), k, drawn, quota) for k, n in enumerate(m) if n), strict=True)
                    base += m
                    to, no = np.concatenate(to), np.concatenate(no)
                    size = np.array(blocks, np.int64)[to]
                    pass_no, inside = no // size, no % size
                    block_no = np.empty(len(no), np.int64)
                    for k, p in set(zip(to.tolist(), pass_no.tolist(), strict=True)):
                        here = (to == k) & (pass_no == p)
                        block_no[here] = permute(inside[here], blocks[k], SEED + 1009 * k + p)
                    slot = np.random.default_rng([SEED, shard, 1]).permutation(len(no))
                    cols = [pa.array([shard] * len(no), pa.int32()), pa.array(slot.astype(np.int32)), pa.array([names[k] for k in to]), pa.array(pass_no.astype(np.int32)), pa.array(block_no)]
                    yield pa.RecordBatch.from_arrays(cols, ["shard", "slot", "source", "pass_no", "block_no"])

    slots_ = per.select("group", "at").mapInArrow(expand, "shard int, slot int, source string, pass_no int, block_no long")
    return slots_.hint("merge").join(block_pieces(counts, block), ["source", "block_no"]).select("shard", "slot", "source", "pass_no", "block_no", "doc_id", "tok_from", "tok_to")


def share_report(docs: DataFrame, source_targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, tokens, actual_share, passes: what a mixture reached for every target."""
    m = mixture(docs, source_targets, total_tokens).groupBy("source").agg(F.sum(F.col("tok_to") - F.col("tok_from")).alias("tokens"), (F.max("pass_no") + 1).alias("passes"))
    j = source_targets.select("source", "target_share", "max_repeats").join(m, "source", "left").fillna(0, ["tokens", "passes"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # as many rows as targets
    return j.select("source", "target_share", "max_repeats", "tokens", F.round(F.when(total > 0, F.col("tokens") / total).otherwise(0.0), 6).alias("actual_share"), "passes")
