"""Lines repeated across one site's documents, by compressed bitmaps of each line's documents.

Lines are the same if they differ only in case, digits, punctuation, spacing or accents (one key) or, from four words on, in one word
added or changed (variants). A line counts in every document that has it or a variant of it. Where neither its own documents nor those
of one variant reach the threshold, the bitmaps of the line's variants (containers of 2**15 document ids) are united and the exact size
of the union is held against it. Occurrences are deleted by looking up their line's key.

Scale: texts are cut into lines once, in place; what moves are ids and hashes, and of the lines' words only those of keys that may be
variants. Variants share their first or their last words (marks), so a key goes on only if its marks together stand in as many documents
as are needed, or if it shares a mark with such a key. Lookups of keys first pass a filter of fixed size that every executor holds (at most
2**session.FILTER_BITS bits), then an exact join. Counts are combined before the shuffle and every later row is one key, not one line.

Defined results: null and empty texts have no lines and don't count as documents; a document without site and host belongs to none;
repeated rows of a docid count once.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import host_key, may_have, stored

MIN_DOCS = 5
MIN_SHARE = 0.05
#: Words from which one added or changed word makes a line no other.
MIN_WORDS = 4


def _accent_tables() -> tuple[str, str]:
    a, b = [], []
    for cp in range(0xC0, 0x2000):
        c = chr(cp)
        d = unicodedata.normalize("NFKD", c)
        if d != c and len(d[0].encode("utf-8")) and all(unicodedata.combining(x) for x in d[1:]) and d[0].isalpha():
            a.append(c)
            b.append(d[0])
    return "".join(a), "".join(b)


_FROM, _TO = _accent_tables()


def plain_words(line: Column) -> Column:
    """A line's words in lower case without accents, digits, punctuation and symbols."""
    s = F.translate(F.lower(line), _FROM, _TO)
    s = F.trim(F.regexp_replace(s, r"[^\p{L}]+", " "))
    return F.filter(F.split(s, " "), lambda w: w != "")


def doc_sites(written: DataFrame, sites: DataFrame) -> DataFrame:
    """docid, site (a 64-bit hash): siteid, else the site of the host, else the host; documents without either are left out."""
    w = written.select("docid", "siteid", host_key(F.col("domainname")).alias("host")).groupBy("docid").agg(F.min("siteid").alias("siteid"), F.min("host").alias("host"))
    s = sites.select(host_key(F.col("domainname")).alias("host"), F.col("siteid").alias("host_site")).where("host is not null").groupBy("host").agg(F.min("host_site").alias("host_site"))
    w = w.join(s, "host", "left").select("docid", F.coalesce("siteid", "host_site", "host").alias("site")).where("site is not null")
    return w.select("docid", F.xxhash64("site").alias("site"))


def _marks() -> Column:
    """Hashes of the first and last words that any line one word apart shares with a line (none below MIN_WORDS words).

    As many words as the greatest power of two up to half the line; lines of 8, 16, 32 ... words also have the marks of one word less.
    """
    n = F.col("n")
    k = F.floor(F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double")) + 1e-9) - 1)).cast("int")

    def both(k: Column) -> Column:
        return F.array(F.hash(F.lit("a"), k, F.slice("w", F.lit(1), k)), F.hash(F.lit("z"), k, F.slice("w", n - k + 1, k)))

    edge = (n == 2 * k) & (k > MIN_WORDS / 2)
    return F.when(n < MIN_WORDS, F.array().cast("array<int>")).when(edge, F.concat(both(k), both((k / 2).cast("int")))).otherwise(both(k))


def line_table(docs: DataFrame) -> DataFrame:
    """docid, line_no, n (words), key, marks, w (words) of every non-blank line, and one row with line_no -1 for every non-empty text."""
    t = docs.where("length(text) > 0").select("docid", "text")
    x = t.select("docid", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim(F.regexp_replace("line", r"\s+", " ")) != "")
    x = x.select("docid", "line_no", plain_words(F.col("line")).alias("w")).withColumn("n", F.size("w"))
    x = x.select("docid", "line_no", "n", F.xxhash64("w").alias("key"), _marks().alias("marks"), "w")
    none = [F.lit(v).cast(k).alias(c) for c, k, v in (("line_no", "int", -1), ("n", "int", 0), ("key", "bigint", 0), ("marks", "array<int>", None), ("w", "array<string>", None))]
    return x.unionByName(t.select("docid", *none))


def _patterns(keys: DataFrame) -> DataFrame:
    """site, key, docs, need, pat, gives, takes: what one word's change, loss or gain leaves of a line.

    Two lines are variants if one gives to a pattern from which the other takes.
    """
    drop = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(i.alias("i"), F.xxhash64(F.concat(F.slice("w", F.lit(1), i - 1), F.slice("w", i + 1, F.col("n")))).alias("rest")))
    base, yes, no = ["site", "key", "docs", "need"], F.lit(True), F.lit(False)

    def row(pat: Column, gives: Column, takes: Column) -> Column:
        return F.struct(pat.alias("pat"), gives.alias("gives"), takes.alias("takes"))

    def down(rest: Column, n: Column) -> Column:
        return F.xxhash64(F.lit("down"), n, rest)

    def up(rest: Column, n: Column) -> Column:
        return F.xxhash64(F.lit("up"), n, rest)

    n = F.col("n")
    x = keys.withColumn("d", drop)
    change = F.transform("d", lambda e: row(F.xxhash64(F.lit("c"), n, e["i"], e["rest"]), yes, yes))
    own = F.xxhash64("w")
    shorter = F.array(row(down(own, n), yes, no), row(up(own, n), no, yes))
    rests = F.array_distinct(F.transform("d", lambda e: e["rest"]))
    longer = F.when(n > MIN_WORDS, F.concat(F.transform(rests, lambda r: row(up(r, n - 1), yes, no)), F.transform(rests, lambda r: row(down(r, n - 1), no, yes))))
    rows = F.concat(change, shorter, F.coalesce(longer, F.array().cast("array<struct<pat:bigint,gives:boolean,takes:boolean>>")))
    return x.select(*base, F.explode(rows).alias("r")).select(*base, "r.*")


def repeated_keys(docs: DataFrame, sites: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(lines, keys): the lines (site, docid, key, nos: where they stand) and the repeated keys (site, key, docs).

    docs: docid, text; sites: docid, site. docs of a key is the exact number of documents of the line and its variants where that
    decides, else (the line or one variant is frequent by itself) the greater of their own numbers, a lower bound.
    """
    every = stored(line_table(docs), "lines")
    placed = every.drop("w").join(sites, "docid").groupBy("docid", "site", "key").agg(F.sort_array(F.collect_set("line_no")).alias("nos"), F.first("n").alias("n"), F.first("marks").alias("marks"))
    placed = stored(placed, "placed")
    is_doc = F.col("nos")[0] == -1  # the key of no line
    totals = placed.where(is_doc).groupBy("site").agg(F.count("*").alias("n_docs")).select("site", F.greatest(F.lit(float(min_docs)), F.ceil(F.col("n_docs") * min_share - 1e-9).cast("double")).alias("need"))
    lines = placed.where(~is_doc).select("site", "docid", "key", "nos")
    keys = placed.where(~is_doc).groupBy("site", "key").agg(F.count("*").alias("docs"), F.first("n").alias("n"), F.first("marks").alias("marks"))
    keys = stored(keys.join(totals, "site"), "keys")
    heavy = keys.where(F.col("docs") >= F.col("need")).select("site", "key", "docs")

    # a union is at most the sum over a line's two or four marks; those below a quarter of what is needed count as a quarter
    marked = keys.where(F.size("marks") > 0).select("site", "key", "docs", "need", F.size("marks").alias("of"), F.explode("marks").alias("mark")).withColumn("m", F.xxhash64("site", "mark"))
    hot = marked.groupBy("m").agg(F.sum("docs").alias("s"), F.first("need").alias("need")).where(F.col("s") >= F.col("need") / 4).select("m", "s")
    hot = stored(hot, "marks")
    most = F.sum("s") + (F.first("of") - F.count("*")) * F.first("need") / 4
    wide = may_have(marked, "m", hot, "m").join(hot, "m").groupBy("site", "key").agg(most.alias("most"), F.first("need").alias("need")).where("most >= need").select("site", "key")
    wide = keys.join(wide, ["site", "key"], "left_semi").select(F.explode("marks").alias("mark"), "site").select(F.xxhash64("site", "mark").alias("m")).distinct()
    wide = stored(wide, "wide")
    near = may_have(marked, "m", wide, "m").join(wide, "m", "left_semi").select("site", "key", "docs", "need").distinct()
    near = stored(near, "near")
    words = may_have(every.where("line_no >= 0").select("key", "n", "w"), "key", near, "key").groupBy("key").agg(F.first("n").alias("n"), F.first("w").alias("w"))
    pats = stored(_patterns(near.join(words, "key")), "patterns")
    given = pats.where("gives").groupBy("site", "pat").agg(F.max("docs").alias("most"), F.sum("docs").alias("all"))
    per = pats.where("takes").join(given, ["site", "pat"]).groupBy("site", "key").agg(F.max("most").alias("most"), F.sum("all").alias("all"), F.first("docs").alias("docs"), F.first("need").alias("need"))
    per = stored(per, "bounds")
    sure = heavy.unionByName(per.where((F.col("docs") < F.col("need")) & (F.col("most") >= F.col("need"))).select("site", "key", F.col("most").alias("docs")))

    # what no single line decides: the union itself. A key gives to its own change patterns, so these bitmaps include its own documents
    open_ = per.where((F.col("docs") < F.col("need")) & (F.col("most") < F.col("need")) & (F.col("all") + F.col("docs") >= F.col("need"))).select("site", "key", "need")
    takers = stored(pats.where("takes").select("site", "key", "pat").join(open_, ["site", "key"]), "takers")
    if takers.isEmpty():
        return lines, sure
    givers = pats.where("gives").select("site", "pat", "key").join(takers.select("site", "pat").distinct(), ["site", "pat"], "left_semi")
    holders = may_have(lines.select("site", "key", "docid"), "key", givers, "key")
    at = (F.expr("bitmap_bucket_number(docid)").alias("bucket"), F.expr("bitmap_bit_position(docid)").alias("bit"))
    boxes = givers.join(holders, ["site", "key"]).select("site", "pat", *at).groupBy("site", "pat", "bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("box"))
    union = takers.join(boxes, ["site", "pat"]).groupBy("site", "key", "bucket").agg(F.expr("bitmap_count(bitmap_or_agg(box))").alias("c"), F.first("need").alias("need"))
    union = union.groupBy("site", "key").agg(F.sum("c").alias("docs"), F.first("need").alias("need"))
    return lines, sure.unionByName(union.where(F.col("docs") >= F.col("need")).select("site", "key", "docs"))


def repeated_lines(docs: DataFrame, written: DataFrame, sites: DataFrame) -> DataFrame:
    """docid, line_no of every occurrence of a line repeated in its site."""
    lines, keys = repeated_keys(docs, doc_sites(written, sites))
    keys = stored(keys.select("site", "key"), "repeated")
    return may_have(lines, "key", keys, "key").join(keys, ["site", "key"], "left_semi").select("docid", F.explode("nos").alias("line_no"))


def without_repeated_lines(docs: DataFrame, written: DataFrame, sites: DataFrame) -> DataFrame:
    """docid, text, removed: each text without its site's repeated lines; documents without any keep their text."""
    gone = repeated_lines(docs, written, sites).groupBy("docid").agg(F.collect_set("line_no").alias("gone"))
    j = docs.select("docid", "text").join(gone, "docid", "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i))
    return j.select("docid", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
