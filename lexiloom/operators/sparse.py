"""Sparse vectors and matrices in long form (row, term, w): joins, element operations, norms, similarity self-joins, sets and multisets.

A vector's absent elements are zero; null weights are dropped by every operation. Rows are told apart by value, so equality is native.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def mapped(v: DataFrame, f: Callable[[Column], Column], w: str = "w") -> DataFrame:
    """Applies f to every weight; elements for which it gives null go."""
    return v.withColumn(w, f(F.col(w))).where(F.col(w).isNotNull())


def merged(a: DataFrame, b: DataFrame, f: Callable[[Column, Column], Column], key: list[str], w: str = "w") -> DataFrame:
    """Full outer merge: f where both have the element, else the one that is there; null results go."""
    j = a.withColumnRenamed(w, "_x").join(b.withColumnRenamed(w, "_y"), key, "full")
    both = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    return j.select(*key, F.when(both, f(F.col("_x"), F.col("_y"))).otherwise(F.coalesce("_x", "_y")).alias(w)).where(F.col(w).isNotNull())


def binary(v: DataFrame, w: str = "w") -> DataFrame:
    """A sparse vector as a binary one: every element that is there weighs 1."""
    return v.withColumn(w, F.lit(1.0))


def min_max(v: DataFrame, feature: str, w: str = "w") -> DataFrame:
    """Weights scaled to 0..1 within each feature; a feature of one value becomes 0. Extremes are aggregated, then joined back."""
    m = v.groupBy(feature).agg(F.min(w).alias("_lo"), F.max(w).alias("_hi"))
    scaled = F.coalesce(F.try_divide(F.col(w) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    return v.join(m, feature).withColumn(w, scaled).drop("_lo", "_hi")


def trimmed(v: DataFrame, n: int, share: float, row: str, term: str = "term", w: str = "w") -> DataFrame:
    """Keeps each row's n largest weights, drops its lightest below the share of the total, and scales it to length 1."""
    by = Window.partitionBy(row).orderBy(F.desc(w), term)
    x = v.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= n).drop("_r")
    up = Window.partitionBy(row).orderBy(w, term).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumns({"_run": F.sum(w).over(up), "_all": F.sum(w).over(Window.partitionBy(row))})
    x = x.withColumn("_at", F.min(F.when(F.col("_run") >= F.col("_all") * share - 1e-12, F.col(w))).over(Window.partitionBy(row))).where(F.col(w) >= F.col("_at"))
    return x.withColumn(w, F.col(w) / F.sqrt(F.sum(F.col(w) * F.col(w)).over(Window.partitionBy(row)))).drop("_run", "_all", "_at")


#: Rows of a task's share of the self-join, and rows of the blocks that are multiplied at once.
GROUP, BLOCK = 8192, 1024
#: Terms multiplied at once; a term in fewer of a block's rows than DENSE is scored by its pairs of rows.
TERMS, DENSE = 1024, 16


class _Rows:
    """Rows of one side in blocks that share their common terms: per block, positions, and entries (term, row in the block, weight) by term."""

    def __init__(self, pos: np.ndarray, at: np.ndarray, term: np.ndarray, w: np.ndarray, df: np.ndarray):
        n = len(pos)
        size = np.bincount(at, minlength=n)
        order = np.lexsort((term, -df[term], at))
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        lead = [np.where(size > k, term[order][np.minimum(first + k, max(len(term) - 1, 0))], -1) for k in range(3)]
        ranked = np.lexsort(lead[::-1])  # rows with the same most frequent terms stand together
        new = np.empty(n, np.int64)
        new[ranked] = np.arange(n)
        at, pos = new[at], pos[ranked]
        order = np.lexsort((term, at // BLOCK))
        at, term, w = at[order], term[order], w[order]
        ends = np.searchsorted(at // BLOCK, np.arange(-(-n // BLOCK) + 1))
        self.blocks = []
        for k in range(-(-n // BLOCK)):
            part = slice(ends[k], ends[k + 1])
            terms, start, count = np.unique(term[part], return_index=True, return_counts=True)
            top = np.maximum.reduceat(np.abs(w[part]), start) if len(terms) else np.empty(0)
            self.blocks.append({"pos": pos[k * BLOCK : (k + 1) * BLOCK], "term": term[part], "at": at[part] - k * BLOCK, "w": w[part], "terms": terms, "start": start, "count": count, "top": top})


def _reach(a: dict, b: dict, n_terms: int) -> np.ndarray:
    """The most that each row of a block can reach with any row of another: its weights times the greatest of the other's per term."""
    top = np.zeros(n_terms)
    top[b["terms"]] = b["top"]
    return np.bincount(a["at"], np.abs(a["w"]) * top[a["term"]], len(a["pos"]))


def _scores(a: dict, b: dict, threshold: float, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, dot product) of two blocks where it is greater than the threshold."""
    low = threshold * (1 - 1e-9) - 1e-12
    of_a, of_b = np.flatnonzero(_reach(a, b, n_terms) > low), np.flatnonzero(_reach(b, a, n_terms) > low)
    if not len(of_a) or not len(of_b):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    out = np.zeros((len(of_a), len(of_b)))
    _, i, j = np.intersect1d(a["terms"], b["terms"], assume_unique=True, return_indices=True)
    dense = np.minimum(a["count"][i], b["count"][j]) >= DENSE
    row_a, row_b = np.full(len(a["pos"]), -1), np.full(len(b["pos"]), -1)
    row_a[of_a], row_b[of_b] = np.arange(len(of_a)), np.arange(len(of_b))
    both, col = a["terms"][i][dense], np.full(n_terms, -1)
    for k in range(0, len(both), TERMS):
        col[:] = -1
        col[both[k : k + TERMS]] = np.arange(len(both[k : k + TERMS]))
        sides = []
        for side, row, n in ((a, row_a, len(of_a)), (b, row_b, len(of_b))):
            m = np.zeros((n, len(both[k : k + TERMS])))
            here = (col[side["term"]] >= 0) & (row[side["at"]] >= 0)
            m[row[side["at"][here]], col[side["term"][here]]] = side["w"][here]
            sides.append(m)
        out += sides[0] @ sides[1].T
    flat = out.reshape(-1)
    i, j = i[~dense], j[~dense]
    many, few = (a["count"][i], b["count"][j]) if len(i) else (np.empty(0, np.int64), np.empty(0, np.int64))
    pairs = many * few
    part = np.concatenate(([0], np.flatnonzero(np.diff(np.cumsum(pairs) >> 20)) + 1, [len(i)]))
    for lo, hi in zip(part[:-1], part[1:]):  # some million pairs of entries at a time
        n = pairs[lo:hi]
        of = np.repeat(np.arange(lo, hi), n)
        no = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        x, y = a["start"][i[of]] + no // few[of], b["start"][j[of]] + no % few[of]
        r, c = row_a[a["at"][x]], row_b[b["at"][y]]
        ok = (r >= 0) & (c >= 0)
        np.add.at(flat, r[ok] * len(of_b) + c[ok], (a["w"][x] * b["w"][y])[ok])
    r, c = np.nonzero(out > threshold)
    return of_a[r], of_b[c], out[r, c]


def _shared(ids: pa.Array, group: np.ndarray, terms: pa.Array, ws: pa.Array, threshold: float) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(a, b, s) of the pairs of one task: rows of two groups, or of one with itself; ids stand in rising order."""
    at = np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
    coded = terms.flatten().dictionary_encode()
    names, term = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    w = ws.flatten().to_numpy()
    df = np.bincount(term, minlength=len(names))
    sides = []
    for g in np.unique(group):
        pos = np.flatnonzero(group == g)
        own = group[at] == g
        local = np.zeros(len(ids), np.int64)
        local[pos] = np.arange(len(pos))
        sides.append(_Rows(pos, local[at[own]], term[own], w[own], df).blocks)
    same = len(sides) == 1
    for k, x in enumerate(sides[0]):
        for y in sides[0][k:] if same else sides[1]:
            r, c, s = _scores(x, y, threshold, len(names))
            p, q = x["pos"][r], y["pos"][c]
            if x is y:
                p, q, s = (v[p < q] for v in (p, q, s))
            if len(s):
                yield ids.take(pa.array(np.minimum(p, q))), ids.take(pa.array(np.maximum(p, q))), s


def _read(uri: str, group: int) -> pa.Table:
    """Rows of one file of the shared folder, with the group they are in."""
    fs, path = pa.fs.FileSystem.from_uri(uri)
    t = pq.read_table(path, filesystem=fs, columns=["row", "terms", "ws"])
    return t.append_column("g", pa.array(np.full(t.num_rows, group)))


def self_join(v: DataFrame, threshold: float, row: str, term: str = "term", w: str = "w", diagonal: bool = True) -> DataFrame:
    """a, b, s: pairs of rows a <= b whose dot product is greater than the threshold > 0.

    Rows are written to the shared folder once, in groups of up to GROUP, and each pair of groups is one task's, which reads their
    files there: neither pairs nor copies of vectors are shuffled. In a task, rows with the same common terms form blocks. Of two blocks only the rows are scored whose weights, times the
    greatest of the other block per term, exceed the threshold: terms of many rows by matrix products, others by their pairs of rows.
    Equal rows are one node only if the caller makes them so.
    """
    if threshold <= 0:
        raise ValueError("a threshold above 0 is needed")
    kind = dict(v.dtypes)[row]
    x = v.where(F.col(w) != 0).groupBy(row, term).agg(F.sum(w).cast("double").alias("w")).where("w != 0")
    packed = x.groupBy(F.col(row).alias("row")).agg(F.collect_list(F.struct(F.col(term).alias("term"), "w")).alias("e"))
    packed = stored(packed.select("row", F.col("e.term").alias("terms"), F.col("e.w").alias("ws")), "rows", GROUP)
    groups: list[list[str]] = []
    room = 0
    for f, n in sorted(map(tuple, packed.groupBy(F.input_file_name()).count().collect())):  # one row a file
        if n > room:
            groups.append([])
            room = GROUP
        groups[-1].append(f)
        room -= n
    pairs = [(groups[i], groups[j] if i != j else []) for i in range(len(groups)) for j in range(i, len(groups))]
    sc = packed.sparkSession.sparkContext
    dealt = packed.sparkSession.createDataFrame(sc.parallelize(pairs, max(1, len(pairs))), "one array<string>, other array<string>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, other in (r.values() for b in batches for r in b.to_pylist()):
            t = pa.concat_tables([_read(f, g) for g, files in enumerate((one, other)) for f in files])
            t = t.take(pc.sort_indices(t["row"])).combine_chunks()
            ids, terms, ws, group = (t.column(k).chunk(0) for k in range(4))
            for a, b, s in _shared(ids, group.to_numpy(), terms, ws, threshold):
                for at in range(0, len(s), 1 << 18):
                    yield pa.RecordBatch.from_arrays([a.slice(at, 1 << 18), b.slice(at, 1 << 18), pa.array(s[at : at + (1 << 18)])], ["a", "b", "s"])

    s = dealt.mapInArrow(run, f"a {kind}, b {kind}, s double")
    if diagonal:
        own = packed.select(F.col("row").alias("a"), F.col("row").alias("b"), F.aggregate("ws", F.lit(0.0), lambda t, y: t + y * y).alias("s"))
        s = s.unionByName(own.where(F.col("s") > threshold))
    return s


def dot_with_rows(q: DataFrame, v: DataFrame, row: str, term: str = "term", w: str = "w", threshold: float | None = None) -> DataFrame:
    """row, s: dot product of one query vector (term, w) with every row that shares a term, over the inverted index."""
    s = v.join(q.select(term, F.col(w).alias("_q")), term).groupBy(row).agg(F.sum(F.col(w) * F.col("_q")).alias("s"))
    return s if threshold is None else s.where(F.col("s") > threshold)


def projected(occ: DataFrame, vocabulary: DataFrame, n_docs: Column, row: str, term: str = "term") -> DataFrame:
    """row, term, w: new documents weighted on a frozen vocabulary (term, df); unknown terms are left out."""
    tf = occ.groupBy(row, term).agg(F.count("*").alias("tf"))
    return tf.join(vocabulary.select(term, "df"), term).select(row, term, (F.col("tf") * F.log(n_docs.cast("double") / F.col("df"))).alias("w")).where("w != 0")


def appended(a: DataFrame, b: DataFrame, row: str) -> DataFrame:
    """The rows of b after those of a: row numbers of b are shifted by the greatest of a plus 1."""
    shift = a.agg((F.coalesce(F.max(row), F.lit(-1)) + 1).alias("_s"))
    return a.unionByName(b.join(F.broadcast(shift)).withColumn(row, F.col(row) + F.col("_s")).drop("_s").select(*a.columns))  # one row


def shape(m: DataFrame, row: str, col: str, w: str = "w") -> DataFrame:
    """n_rows, n_cols, n_values, sparseness (the share of cells without value), first and last column, is_symmetric."""
    t = m.select(F.col(row).alias("i"), F.col(col).alias("j"), F.col(w).alias("x"))
    u = t.unionByName(t.select(F.col("j").alias("i"), F.col("i").alias("j"), (-F.col("x")).alias("x")))
    bad = u.groupBy("i", "j").agg(F.sum("x").alias("x")).where("x != 0").agg(F.count("*").alias("bad"))
    s = t.agg(F.count_distinct("i").alias("n_rows"), F.count_distinct("j").alias("n_cols"), F.count("*").alias("n_values"), F.min("j").alias("first_col"), F.max("j").alias("last_col"))
    return s.join(F.broadcast(bad)).select("n_rows", "n_cols", "n_values", F.try_divide(F.col("n_rows") * F.col("n_cols") - F.col("n_values"), F.col("n_rows") * F.col("n_cols")).alias("sparseness"), "first_col", "last_col", (F.col("bad") == 0).alias("is_symmetric"))


# ---- sets and multisets as arrays
def set_union(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def set_intersection(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(a, b))


def set_difference(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_except(a, b))


def multiset_jaccard(a: DataFrame, b: DataFrame, group: str, item: str = "item", n: str = "n") -> DataFrame:
    """group, jaccard of two tables of counts: the sum of smaller counts over the sum of greater ones; two empty multisets give 1 where a group is listed in either."""
    j = a.select(group, item, F.col(n).alias("x")).join(b.select(group, item, F.col(n).alias("y")), [group, item], "full").fillna(0, ["x", "y"])
    g = j.groupBy(group).agg(F.sum(F.least("x", "y")).alias("lo"), F.sum(F.greatest("x", "y")).alias("hi"))
    return g.select(group, F.when(F.col("hi") == 0, 1.0).otherwise(F.col("lo") / F.col("hi")).alias("jaccard"))


def edited(counts: DataFrame, changes: DataFrame, key: list[str], n: str = "n") -> DataFrame:
    """A multiset after signed changes; counts that fall to 0 or below go."""
    return counts.select(*key, n).unionByName(changes.select(*key, n)).groupBy(*key).agg(F.sum(n).alias(n)).where(F.col(n) > 0)


# ---- positional and lookup joins, order
def zipped(a: DataFrame, b: DataFrame, doc: str, pos: str, word: str) -> DataFrame:
    """Two token streams side by side by document and position; same says whether their words agree (null if one is missing)."""
    x, y = a.select(*[F.col(c).alias(c if c in (doc, pos) else f"{c}_1") for c in a.columns]), b.select(*[F.col(c).alias(c if c in (doc, pos) else f"{c}_2") for c in b.columns])
    return x.join(y, [doc, pos], "full").withColumn("same", F.col(f"{word}_1") == F.col(f"{word}_2"))


def looked_up(rows: DataFrame, table: DataFrame, col: str, key: str, value: str) -> DataFrame:
    """rows with col replaced by the table's value of its key; the first mapping (by order column `ord`, if any) wins, a miss keeps the word."""
    first = table.groupBy(key).agg((F.min_by(value, "ord") if "ord" in table.columns else F.min(value)).alias("_v"))
    j = rows.join(first.withColumnRenamed(key, "_k"), F.col(col) == F.col("_k"), "left")
    return j.withColumn(col, F.coalesce("_v", col)).drop("_k", "_v")


def shuffled(rows: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """rows with ord, a fixed pseudorandom order by key: the same for every run and partitioning."""
    return rows.withColumn("ord", F.xxhash64(F.lit(seed), F.col(key))).orderBy("ord", key)


def most_similar(pairs: DataFrame, a: str = "a", b: str = "b", s: str = "s") -> DataFrame:
    """The one pair of different items with the greatest similarity; ties go to the smaller ids. One row, or none."""
    return pairs.where(F.col(a) != F.col(b)).agg(F.max_by(F.struct(a, b, s), F.struct(F.col(s), -F.col(a), -F.col(b))).alias("m")).where("m is not null").select("m.*")
