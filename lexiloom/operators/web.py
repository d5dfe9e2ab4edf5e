"""URLs and stylometry: address parts, domains, prefix trees, vocabulary richness, readability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import syllables


def url_parts(c: Column) -> dict[str, Column]:
    """scheme, host, path and query of an address; missing parts are empty."""
    u = F.coalesce(c, F.lit(""))
    return {
        "scheme": F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        "host": F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)),
        "path": F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(u, r"\?([^#]*)", 1),
    }


def domain_of(host: Column, suffixes: tuple[str, ...] = ("co.uk", "com.au", "co.jp")) -> Column:
    """The registered domain: top-level suffix and one label."""
    two = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    one = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(F.substring_index(host, ".", -2).isin(*suffixes), two).otherwise(F.when(one == "", host).otherwise(one))


def url_nodes(docs: DataFrame, url: str) -> DataFrame:
    """host, prefix, n: documents at or below every path prefix of each host (last segment dropped unless there is a query)."""
    p = url_parts(F.col(url))
    segs = F.filter(F.split(p["path"], "/"), lambda s: s != "")
    n = F.size(segs) - F.when(p["query"] == "", 1).otherwise(0)
    keep = F.slice(segs, F.lit(1), F.greatest(n, F.lit(0)))
    pre = F.transform(F.sequence(F.lit(0), F.size(keep)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(keep, F.lit(1), i), "/")))
    x = docs.where(F.col(url).isNotNull()).select(p["host"].alias("host"), F.explode(pre).alias("prefix"))
    return x.groupBy("host", "prefix").agg(F.count("*").alias("n"))


def richness(occ: DataFrame, row: str = "doc_id") -> DataFrame:
    """row, n, v, ttr, hl, honore, brunet: vocabulary richness by tokens; honore is null if every word occurs once."""
    tf = occ.groupBy(row, "term").agg(F.count("*").alias("tf"))
    x = tf.groupBy(row).agg(F.sum("tf").alias("n"), F.count("*").alias("v"), F.sum((F.col("tf") == 1).cast("int")).alias("v1"))
    n, v, v1 = F.col("n").cast("double"), F.col("v").cast("double"), F.col("v1").cast("double")
    return x.select(row, "n", "v", (v / n).alias("ttr"), (v1 / n).alias("hl"), F.when(v1 < v, 100 * F.log(n) / (1 - v1 / v)).alias("honore"), F.pow(n, F.pow(v, F.lit(-0.165))).alias("brunet"))


def readability(docs: DataFrame, words: Column, text: str = "text", row: str = "doc_id") -> DataFrame:
    """row, ari, flesch of documents with words; sentences end in . ! or ?, at least one."""
    s = F.greatest(F.size(F.regexp_extract_all(F.col(text), F.lit(r"([.!?]+)"), F.lit(1))), F.lit(1))
    n = F.size("w")
    chars = F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x))
    syl = F.aggregate("w", F.lit(0), lambda a, x: a + syllables(x))
    d = docs.where(F.col(text).isNotNull()).select(row, text, words.alias("w")).where("size(w) > 0")
    rw, rc, rs = n / s, chars / n, syl / n
    return d.select(row, (0.5 * rw + 4.71 * rc - 21.43).alias("ari"), (206.835 - 1.015 * rw - 84.6 * rs).alias("flesch"))


def tree_votes(docs: DataFrame, blocks: DataFrame, least: int = 5) -> DataFrame:
    """docid, hash, boilerplate: whether the blocks of a page recur along its address tree.

    docs: docid, guid, url (first revisions, one row per url); blocks: guid, hash. Every node (host and path prefix) with at least
    `least` documents votes boilerplate if more than one in a hundred of its documents, and one more, have the block; a tie is
    boilerplate. Nodes with fewer documents don't vote unless none has enough: then the root alone does.
    """
    p = url_parts(F.col("url"))
    segs = F.filter(F.split(p["path"], "/"), lambda s: s != "")
    keep = F.slice(segs, F.lit(1), F.greatest(F.size(segs) - F.when(p["query"] == "", 1).otherwise(0), F.lit(0)))
    pre = F.transform(F.sequence(F.lit(0), F.size(keep)), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(keep, F.lit(1), i), "/")))
    d = docs.where("url is not null").select("docid", "guid", p["host"].alias("host"), F.explode(pre).alias("node"))
    n = d.groupBy("host", "node").agg(F.count("*").alias("n"))
    b = blocks.select("guid", "hash").distinct()
    x = d.join(b, "guid")
    c = x.groupBy("host", "node", "hash").agg(F.count("*").alias("c"))
    v = x.join(n, ["host", "node"]).join(c, ["host", "node", "hash"])
    votes = v.where((F.col("n") >= least) | (F.col("node") == "/")).withColumn("yes", (F.col("c") > F.floor(F.col("n") / 100) + 1).cast("int"))
    g = votes.groupBy("docid", "hash").agg(F.sum("yes").alias("y"), F.count("*").alias("k"))
    return g.select("docid", "hash", (2 * F.col("y") >= F.col("k")).alias("boilerplate"))


def group_predictions(pred: DataFrame, group: str, how: str = "sum") -> DataFrame:
    """group, label, score: predictions (group, row, label, score) of many examples combined by sum, max or vote of the best label."""
    if how == "vote":
        top = pred.groupBy(group, "row").agg(F.max_by("label", F.struct("score", "label")).alias("label"))
        return top.groupBy(group, "label").agg(F.count("*").cast("double").alias("score"))
    f = F.sum if how == "sum" else F.max
    return pred.groupBy(group, "label").agg(f("score").alias("score"))


def query_params(url: Column) -> Column:
    """(key, value) of an address's query, decoded, values of a key sorted and joined by commas, sorted by key; empty ones go."""
    q = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    pairs = F.transform(F.filter(F.split(q, "&"), lambda x: x != ""), lambda x: F.struct(F.try_url_decode(F.substring_index(x, "=", 1)).alias("k"), F.coalesce(F.try_url_decode(F.when(x.contains("="), F.regexp_extract(x, "=(.*)$", 1)).otherwise("")), F.lit("")).alias("v")))
    keys = F.array_sort(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["k"].isNotNull()), lambda p: p["k"])))
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.array_join(F.array_sort(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"])), ",").alias("v")))


def _named(names: tuple[str, ...]):
    return lambda p: p["k"].isin(*names)


def normal_url(url: Column, mode: str = "basic", rules: list[tuple[str, list[str]]] | None = None, title: Column | None = None) -> Column:
    """An address in one form: scheme://host:port, decoded path without empty parts, sorted parameters, no fragment.

    mode: basic keeps all parameters, drop none; heuristics keeps those of the first rule (pattern of the address, parameters) that fits and
    whose parameters are all there, else none. title: its 128-bit hash over lower-case letters and digits joins the parameters as __cid__.
    Null for a null or unparsable address.
    """
    u = F.trim(url)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    port = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*?:(\d+)(?:[/?#]|$)", 1)
    port = F.when(port != "", port).when(scheme == "https", "443").when(scheme == "ftp", "21").otherwise("80")
    raw = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    segs = F.filter(F.transform(F.split(raw, "/"), lambda x: F.coalesce(F.try_url_decode(x), x)), lambda x: x != "")
    params = query_params(u)
    if mode == "drop":
        params = F.filter(params, lambda p: F.lit(False))
    elif mode == "heuristics":
        kept, every = F.filter(params, lambda p: F.lit(False)), params
        for pattern, names in reversed(rules or []):
            mine = F.filter(every, _named(tuple(names)))
            kept = F.when(u.rlike(pattern) & (F.size(mine) == len(set(names))), mine).otherwise(kept)
        params = kept
    if title is not None:
        from ..functions.text import hash128

        cid = F.struct(F.lit("__cid__").alias("k"), hash128(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{N}]", "")).alias("v"))
        params = F.array_sort(F.concat(params, F.array(cid)))
    shown = F.array_join(F.transform(params, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    full = F.concat(scheme, F.lit("://"), host, F.lit(":"), port, F.lit("/"), F.array_join(segs, "/"), F.when(shown != "", F.concat(F.lit("?"), shown)).otherwise(""))
    return F.when((scheme != "") & (host != ""), full)


def black_listed(url: Column, prefixes: list[str]) -> Column:
    """Whether the normal form of an address begins with one of the prefixes."""
    n = normal_url(url)
    out = F.lit(False)
    for p in prefixes:
        out = out | n.startswith(p)
    return F.coalesce(out, F.lit(False))


def public_suffix(host: Column, suffixes: list[str]) -> Column:
    """The longest suffix of a host in a list with * wildcards and ! exceptions; the last label if none fits."""
    plain = [s for s in suffixes if not s.startswith(("*.", "!"))]
    wild = [s[2:] for s in suffixes if s.startswith("*.")]
    but = [s[1:] for s in suffixes if s.startswith("!")]
    labels = F.split(F.lower(host), r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(tails, lambda t: t.isin(plain) | (F.substring_index(t, ".", 1 - 10**6).isNotNull() & F.regexp_extract(t, r"^[^.]+\.(.*)$", 1).isin(wild) & ~t.isin(but)))
    excepted = F.filter(tails, lambda t: t.isin(but))
    of_exception = F.regexp_extract(F.get(excepted, F.lit(0)), r"^[^.]+\.(.*)$", 1)
    return F.when(F.size(excepted) > 0, of_exception).otherwise(F.coalesce(F.get(fits, F.lit(0)), F.element_at(labels, -1)))


def author_distances(values: DataFrame, author: str, feature: str, w: str) -> DataFrame:
    """a, b, feature, diff, sd: absolute difference of two authors' means and their combined deviation; authors are few."""
    m = values.groupBy(author, feature).agg(F.avg(w).alias("m"), F.stddev_pop(w).alias("s"))
    x, y = m.select(F.col(author).alias("a"), feature, F.col("m").alias("ma"), F.col("s").alias("sa")), m.select(F.col(author).alias("b"), feature, F.col("m").alias("mb"), F.col("s").alias("sb"))
    return x.join(y, feature).where("a < b").select("a", "b", feature, F.abs(F.col("ma") - F.col("mb")).alias("diff"), F.sqrt(F.col("sa") * F.col("sa") + F.col("sb") * F.col("sb")).alias("sd"))


def empirical_p(own: DataFrame, other: DataFrame, feature: str, diff: str) -> DataFrame:
    """feature, diff, p: the share of the other pairs of the same feature whose difference is at most the own one.

    Differences are ranked together in one window per feature, so no pair of pairs is formed.
    """
    from pyspark.sql import Window

    u = own.select(feature, F.col(diff).alias("d"), F.lit(0).alias("o")).unionByName(other.select(feature, F.col(diff).alias("d"), F.lit(1).alias("o")))
    upto = F.sum("o").over(Window.partitionBy(feature).orderBy("d").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return u.withColumns({"k": upto, "n": F.sum("o").over(Window.partitionBy(feature))}).where("o = 0").select(feature, F.col("d").alias(diff), F.try_divide("k", "n").alias("p"))
