"""More corpus formats: feeds, tagged corpora, decision trees, and the XML, HTML, GATE, TAB and token writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hash128

MAX_BYTES = 10 << 20
FEED_ITEM = "title string, link string, description string, author string, category array<string>, comments string, pubDate string, source string, guid string"


def read_feeds(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """title, link, description, author, category (repeats joined by ` ;; `), comments, pubdate, source, item_hash of the items of feed files.

    item_hash is the 128-bit hash of title, description and date. Files larger than max_bytes are left out, bytes before the first < too.
    """
    raw = spark.read.format("binaryFile").load(path).where(F.col("length") <= max_bytes).select("path", F.decode("content", "UTF-8").alias("xml"))
    xml = F.regexp_replace("xml", r"^[^<]+", "")
    items = F.regexp_extract_all(xml, F.lit(r"(?s)(<item[\s>].*?</item>)"), F.lit(1))
    return feed_items(raw.select("path", F.explode(items).alias("item")))


def feed_items(items: DataFrame) -> DataFrame:
    """The columns of read_feeds, and path, from items as XML text (path, item); text without markup stands for entities as written."""

    def one(tag: str) -> Column:
        v = F.regexp_extract("item", rf"(?s)<{tag}(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{tag}>", 1)
        return F.when(v != "", v)

    many = F.array_join(F.regexp_extract_all("item", F.lit(r"(?s)<category(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</category>"), F.lit(1)), " ;; ")
    x = items.select("path", *[one(t).alias(t.lower()) for t in ("title", "link", "description", "author", "comments", "pubDate", "source")], F.when(many != "", many).alias("category"))
    return x.withColumn("item_hash", hash128(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "description", "pubdate")])))


def fetched_content(pages: DataFrame) -> DataFrame:
    """pages with content: the body of text and HTML pages within the size limit, else the item's description, else its title."""
    ok = F.lower(F.coalesce("mimetype", F.lit(""))).rlike("html|^text/") & (F.length("body") <= MAX_BYTES)
    return pages.withColumn("content", F.coalesce(F.when(ok, F.col("body")), F.col("description"), F.col("title")))


# ---- tagged corpora
def read_tagged_tsv(spark: SparkSession, path: str) -> DataFrame:
    """file, sent_no, pos, word, tag of `word<tab>tag` lines; a blank line ends a sentence. One row a file, numbered inside it."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.split("value", r"\r?\n[ \t]*\r?\n").alias("s"))
    s = t.select("file", F.posexplode(F.filter("s", lambda x: F.trim(x) != "")).alias("sent_no", "s"))
    w = s.select("file", "sent_no", F.posexplode(F.filter(F.split("s", r"\r?\n"), lambda x: F.trim(x) != "")).alias("pos", "line"))
    parts = F.split("line", "\t")
    return w.select("file", "sent_no", "pos", F.trim(F.get(parts, F.lit(0))).alias("word"), F.trim(F.get(parts, F.lit(1))).alias("tag"))


def read_tagged_tei(spark: SparkSession, path: str) -> DataFrame:
    """file, par_no, sent_no, pos, word, tag, lemma, is_punct, space_after of p/s elements with w (lemma, msd or ana), c and S."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_extract_all("value", F.lit(r"(?s)(<p[\s>].*?</p>)"), F.lit(1)).alias("p"))
    p = t.select("file", F.posexplode("p").alias("par_no", "p"))
    s = p.select("file", "par_no", F.posexplode(F.regexp_extract_all("p", F.lit(r"(?s)(<s[\s>].*?</s>)"), F.lit(1))).alias("sent_no", "s"))
    e = s.select("file", "par_no", "sent_no", F.regexp_extract_all("s", F.lit(r"(?s)(<w[\s>].*?</w>|<c[\s>].*?</c>|<S\s*/>)"), F.lit(1)).alias("e"))
    e = e.select("file", "par_no", "sent_no", F.posexplode("e").alias("k", "x"), F.col("e").alias("all"))
    after = F.coalesce(F.get("all", F.col("k") + 1).startswith("<S"), F.lit(False))
    w = e.where(~F.col("x").startswith("<S")).withColumn("pos", F.size(F.filter(F.slice("all", F.lit(1), F.col("k")), lambda x: ~x.startswith("<S"))))

    def attr(*names: str) -> Column:
        return F.coalesce(*[F.when(F.col("x").rlike(rf"^<\w+[^>]*\s{n}="), F.regexp_extract("x", rf'^<\w+[^>]*\s{n}="([^"]*)"', 1)) for n in names])

    word = F.regexp_extract("x", r"(?s)>(.*?)</", 1)
    punct = F.col("x").startswith("<c")
    return w.select("file", "par_no", "sent_no", "pos", word.alias("word"), F.coalesce(attr("msd", "ana"), F.when(punct, word)).alias("tag"), F.coalesce(attr("lemma"), F.when(punct, word)).alias("lemma"), punct.alias("is_punct"), after.alias("space_after"))


def read_multext(spark: SparkSession, path: str, columns: str = "word lemma tag freq") -> DataFrame:
    """Tab-separated examples with the columns named in order; - leaves a column out. freq is at least 0.1, = as lemma repeats the word."""
    names = columns.split()
    x = spark.read.csv(path, sep="\t", schema=", ".join(f"`c{i}` string" for i in range(len(names))), mode="PERMISSIVE")
    x = x.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != "-"])
    if "lemma" in x.columns:
        x = x.withColumn("lemma", F.when(F.col("lemma") == "=", F.col("word")).otherwise(F.col("lemma")))
    return x.withColumn("freq", F.greatest(F.coalesce(F.col("freq").try_cast("double"), F.lit(0.1)), F.lit(0.1))) if "freq" in x.columns else x


def read_blog_metadata(spark: SparkSession, path: str) -> DataFrame:
    """blog, url, title, title_short, email, gender, age, region, education of tab-separated lines; the last five may be missing, # comments."""
    names = "blog url title title_short email gender age region education".split()
    return spark.read.csv(path, sep="\t", comment="#", schema=", ".join(f"{n} string" for n in names), mode="PERMISSIVE").where("blog is not null")


# ---- writers
def document_id(corpus_guid: Column, doc_guid: Column) -> Column:
    """The id of a written document: the 128-bit hash of both guids."""
    return hash128(F.concat(F.coalesce(corpus_guid, F.lit("")), F.coalesce(doc_guid, F.lit(""))))


def write_documents(docs: DataFrame, path: str, time: str = "time") -> None:
    """Documents by year, month and day, each day replaced as a whole, so that a repeated batch writes the same. Columns are cut to length."""
    width = {"title": 400, "description": 400, "snippet": 1000, "category": 400, "link": 400, "responseurl": 400, "urlkey": 400, "mimetype": 80, "charset": 40, "domainname": 100, "pubdate": 100}
    x = docs.withColumns({c: F.left(F.col(c), F.lit(width[c])) for c in docs.columns if c in width})
    t = F.col(time).cast("timestamp")
    x = x.withColumns({"year": F.year(t), "month": F.month(t), "day": F.day(t)})
    x.repartition("year", "month", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(path)


def kept_features(annotations: Column, keep: tuple[str, ...] = ("linkToTextRatio", "domPath")) -> Column:
    """Annotations whose text blocks keep only some features."""
    f = lambda a: F.map_filter(a["features"], lambda k, _: k.isin(*keep))
    return F.transform(annotations, lambda a: F.struct(a["spanstart"].alias("spanstart"), a["spanend"].alias("spanend"), a["type"].alias("type"), F.when(a["type"].startswith("TextBlock"), f(a)).otherwise(a["features"]).alias("features")))


def _xml(c: Column) -> Column:
    for sign, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(F.coalesce(c, F.lit("")), F.lit(sign), F.lit(code))
    return c


def _feature_xml(m: Column) -> Column:
    each = F.transform(F.map_entries(m), lambda e: F.concat(F.lit("<Feature><Name>"), _xml(e["key"]), F.lit("</Name><Value>"), _xml(e["value"]), F.lit("</Value></Feature>")))
    return F.concat(F.lit("<Features>"), F.array_join(F.coalesce(each, F.array().cast("array<string>")), ""), F.lit("</Features>"))


def document_xml(name: Column, text: Column, features: Column, annotations: Column) -> Column:
    """One <Document> element that read_corpus_xml reads back."""
    ann = F.transform(
        F.coalesce(annotations, F.array().cast("array<struct<spanstart:int,spanend:int,type:string,features:map<string,string>>>")),
        lambda a, i: F.concat(F.lit("<Annotation><Id>"), i.cast("string"), F.lit("</Id><SpanStart>"), a["spanstart"].cast("string"), F.lit("</SpanStart><SpanEnd>"), a["spanend"].cast("string"), F.lit("</SpanEnd><Type>"), _xml(a["type"]), F.lit("</Type>"), _feature_xml(a["features"]), F.lit("</Annotation>")),
    )
    return F.concat(F.lit("<Document><Name>"), _xml(name), F.lit("</Name><Text>"), _xml(text), F.lit("</Text><Annotations>"), F.array_join(ann, ""), F.lit("</Annotations>"), _feature_xml(features), F.lit("</Document>"))


def write_corpus_xml(docs: DataFrame, path: str, compressed: bool = True) -> None:
    """Documents (name, text, features, annotations) as XML files of one corpus each, gzip if compressed; read_corpus_xml reads them back."""

    def pairs(m: Column) -> Column:
        e = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>"))
        return F.struct(F.transform(e, lambda x: F.struct(x["key"].alias("Name"), x["value"].alias("Value"))).alias("Feature"))

    ann = F.transform("annotations", lambda a, i: F.struct(i.cast("string").alias("Id"), a["spanstart"].alias("SpanStart"), a["spanend"].alias("SpanEnd"), a["type"].alias("Type"), pairs(a["features"]).alias("Features")))
    x = docs.select(F.col("name").alias("Name"), F.col("text").alias("Text"), F.struct(ann.alias("Annotation")).alias("Annotations"), pairs(F.col("features")).alias("Features"))
    w = x.write.format("xml").mode("overwrite").option("rootTag", "DocumentCorpus").option("rowTag", "Document")
    (w.option("compression", "gzip") if compressed else w).save(path)


def document_html(name: Column, text: Column, annotations: Column) -> Column:
    """A page that shows the text with every annotation's span marked by its type, spans in order of their start, outermost first."""
    spans = F.transform(F.filter(annotations, lambda a: a["spanend"] >= a["spanstart"]), lambda a: F.struct(a["spanstart"].alias("spanstart"), (-a["spanend"]).alias("_"), a["spanend"].alias("spanend"), a["type"].alias("type")))
    cut = F.array_sort(spans)
    marks = F.transform(cut, lambda a: F.concat(F.lit('<span class="'), _xml(a["type"]), F.lit('">'), _xml(F.substring(text, a["spanstart"] + 1, a["spanend"] - a["spanstart"] + 1)), F.lit("</span>")))
    return F.concat(F.lit("<html><head><title>"), _xml(name), F.lit("</title></head><body>"), F.when(F.size(marks) > 0, F.array_join(marks, "\n")).otherwise(_xml(text)), F.lit("</body></html>"))


def document_gate(text: Column, annotations: Column) -> Column:
    """A GATE document: the text with a node at every border of a span, and the annotations between node ids (offsets)."""
    borders = F.array_sort(F.array_distinct(F.flatten(F.transform(annotations, lambda a: F.array(a["spanstart"], a["spanend"] + 1)))))
    whole = F.concat(F.array(F.lit(0)), borders, F.array(F.length(text)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(whole) - 1), lambda i: F.concat(F.when(i > 1, F.concat(F.lit('<Node id="'), F.element_at(whole, i).cast("string"), F.lit('"/>'))).otherwise(""), _xml(F.substring(text, F.element_at(whole, i) + 1, F.element_at(whole, i + 1) - F.element_at(whole, i)))))
    ann = F.transform(annotations, lambda a, i: F.concat(F.lit('<Annotation Id="'), i.cast("string"), F.lit('" Type="'), _xml(a["type"]), F.lit('" StartNode="'), a["spanstart"].cast("string"), F.lit('" EndNode="'), (a["spanend"] + 1).cast("string"), F.lit('"/>')))
    return F.concat(F.lit("<GateDocument><TextWithNodes>"), F.array_join(pieces, ""), F.lit("</TextWithNodes><AnnotationSet>"), F.array_join(ann, ""), F.lit("</AnnotationSet></GateDocument>"))


def write_tab(rows: DataFrame, path: str, features: list[str], label: str) -> None:
    """Rows as tab-separated text with the three header lines of name, kind and role; a label with commas gives one row per part."""
    head = ["\t".join([*features, label]), "\t".join(["c"] * len(features) + ["d"]), "\t".join([""] * len(features) + ["class"])]
    spark = rows.sparkSession
    spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    x = rows.withColumn(label, F.explode(F.split(label, ",")))
    x.select(F.concat_ws("\t", *[F.coalesce(F.col(f).cast("string"), F.lit("?")) for f in features], label).alias("value")).write.mode("overwrite").text(f"{path}/data")


def token_lines(tokens: DataFrame, form: str = "tsv") -> DataFrame:
    """value: tokens (word, tag, lemma) as lines: tsv (word, lemma, tag), tt (word, tag, lemma), t (word, tag), xml (w or c elements), tbl (word/tag)."""
    w, t, m = F.col("word"), F.coalesce("tag", F.lit("")), F.coalesce("lemma", F.lit(""))
    punct = ~w.rlike(r"[\p{L}\p{N}]")
    forms = {"tsv": F.concat_ws("\t", w, m, t), "tt": F.concat_ws("\t", w, t, m), "t": F.concat_ws("\t", w, t), "tbl": F.concat_ws("/", w, t), "xml": F.when(punct, F.concat(F.lit("<c>"), _xml(w), F.lit("</c>"))).otherwise(F.concat(F.lit('<w msd="'), _xml(t), F.lit('" lemma="'), _xml(m), F.lit('">'), _xml(w), F.lit("</w>")))}
    return tokens.select(*[c for c in tokens.columns if c not in ("word", "tag", "lemma")], forms[form].alias("value"))


def snippet(title: Column, blocks: Column, most: int = 600, overlap: float = 0.2) -> Column:
    """The first characters of content blocks whose words overlap the title's by less than a share, joined by blanks."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1)))
    share = lambda b: F.coalesce(F.try_divide(F.size(F.array_intersect(words(b), words(title))), F.size(F.array_union(words(b), words(title)))), F.lit(0.0))
    return F.left(F.array_join(F.filter(blocks, lambda b: share(b) < overlap), " "), F.lit(most))
