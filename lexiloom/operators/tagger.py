"""Part-of-speech tagging end to end: training, tagging, accuracy, meta-tagging and the export of its training set.

A tag is chosen among those the lexicon or the longest known suffix allows. The model is maximum entropy over the words, affixes and
neighbours of a token (trainers.maxent); scores are sums of weights per candidate, joined on features, so no task tags a document alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .tagging import suffix_tags
from .trainers import maxent


def features(tokens: DataFrame) -> DataFrame:
    """doc_id, pos, word, feature: the word, its affixes and case, and its neighbours; tokens: doc_id, pos, word."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    low = F.lower("word")
    f = [F.concat(F.lit("w="), low), *[F.concat(F.lit(f"s{n}="), F.right(low, F.lit(n))) for n in (1, 2, 3, 4)], *[F.concat(F.lit(f"p{n}="), F.left(low, F.lit(n))) for n in (1, 2, 3)], F.concat(F.lit("case="), F.when(F.col("word").rlike(r"^\p{Lu}"), "A").otherwise("a"))]
    for k in (1, 2):
        f += [F.concat(F.lit(f"-{k}="), F.coalesce(F.lag(low, k).over(w), F.lit("|"))), F.concat(F.lit(f"+{k}="), F.coalesce(F.lead(low, k).over(w), F.lit("|")))]
    x = tokens.withColumn("f", F.array(*f))
    return x.select("doc_id", "pos", "word", F.explode(F.array_distinct("f")).alias("feature"))


def train(tagged: DataFrame, rounds: int = 10, cut_off: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lexicon: word, tag, n; suffixes; weights: label, feature, lam) of tagged tokens (doc_id, pos, word, tag)."""
    lexicon = cut(tagged.groupBy(F.lower("word").alias("word"), "tag").agg(F.count("*").alias("n")))
    suffixes = cut(suffix_tags(lexicon.select("word", "tag")))
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string"))
    x = features(tagged.select("doc_id", "pos", "word")).join(tagged.select("doc_id", "pos", "tag"), ["doc_id", "pos"])
    lam = maxent(x.select(key.alias("row"), F.col("tag").alias("label"), "feature"), rounds, cut_off)
    return lexicon, suffixes, lam


def candidates(words: DataFrame, lexicon: DataFrame, suffixes: DataFrame) -> DataFrame:
    """word (lower case), known, tags, best: what a word may be by the lexicon, else by its longest known suffix."""
    d = words.select(F.lower("word").alias("word")).distinct()
    lex = lexicon.groupBy("word").agg(F.collect_set("tag").alias("tags"), F.max_by("tag", F.struct("n", "tag")).alias("best"))
    s = d.join(lex.select("word"), "word", "left_anti").select("word", F.explode(F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.right(F.col("word"), i))).alias("suffix"))
    by = s.join(suffixes, "suffix").groupBy("word").agg(F.max_by(F.struct("tags", "best"), F.length("suffix")).alias("b")).select("word", F.lit(False).alias("known"), "b.tags", "b.best")
    return d.join(lex, "word").select("word", F.lit(True).alias("known"), "tags", "best").unionByName(by)


def tag(tokens: DataFrame, lexicon: DataFrame, suffixes: DataFrame, lam: DataFrame, context: bool = True) -> DataFrame:
    """doc_id, pos, word, known, predicted. Without context the most frequent tag of the word or suffix; a word with one candidate has that."""
    c = cut(candidates(tokens, lexicon, suffixes))
    t = tokens.select("doc_id", "pos", "word").withColumn("low", F.lower("word")).join(c.withColumnRenamed("word", "low"), "low", "left")
    if not context:
        return t.select("doc_id", "pos", "word", F.coalesce("known", F.lit(False)).alias("known"), F.col("best").alias("predicted"))
    open_ = features(t.select("doc_id", "pos", "word")).join(t.where(F.size("tags") > 1).select("doc_id", "pos", "tags"), ["doc_id", "pos"])
    s = open_.select("doc_id", "pos", "feature", F.explode("tags").alias("label")).join(lam, ["label", "feature"], "left").groupBy("doc_id", "pos", "label").agg(F.coalesce(F.sum("lam"), F.lit(0.0)).alias("s"))
    won = s.groupBy("doc_id", "pos").agg(F.max_by("label", F.struct(F.round("s", 9), "label")).alias("won"))
    return t.join(won, ["doc_id", "pos"], "left").select("doc_id", "pos", "word", F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("won", "best").alias("predicted"))


def accuracy(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """words (all, known, unknown), punctuation (with, without), n, tag_accuracy, pos_accuracy (first letter of the tag)."""
    j = pred.join(gold.select("doc_id", "pos", F.col("tag").alias("gold")), ["doc_id", "pos"])
    j = j.select("known", F.col("word").rlike(r"[\p{L}\p{N}]").alias("is_word"), (F.col("predicted") == F.col("gold")).alias("full"), (F.left("predicted", F.lit(1)) == F.left("gold", F.lit(1))).alias("first"))
    kinds = F.array(F.lit("all"), F.when(F.col("known"), "known").otherwise("unknown"))
    marks = F.when(F.col("is_word"), F.array(F.lit("with"), F.lit("without"))).otherwise(F.array(F.lit("with")))
    x = j.withColumn("words", F.explode(kinds)).withColumn("punctuation", F.explode(marks))
    share = lambda c: F.round(F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double")), 6)
    return x.groupBy("words", "punctuation").agg(F.count("*").alias("n"), share("full").alias("tag_accuracy"), share("first").alias("pos_accuracy"))


def meta_rows(one: DataFrame, two: DataFrame) -> DataFrame:
    """doc_id, pos, word, tag_1, tag_2 and both taggers' previous and next tags, where they disagree; one and two: doc_id, pos, word, predicted."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    j = one.select("doc_id", "pos", "word", F.col("predicted").alias("tag_1")).join(two.select("doc_id", "pos", F.col("predicted").alias("tag_2")), ["doc_id", "pos"])
    j = j.withColumns({f"{n}_{k}": (F.lag if n == "prev" else F.lead)(f"tag_{k}").over(w) for n in ("prev", "next") for k in (1, 2)})
    return j.where(~F.col("tag_1").eqNullSafe(F.col("tag_2")))


def meta_training(rows: DataFrame, gold: DataFrame) -> DataFrame:
    """meta_rows of tokens of which exactly one tagger is right, with right (1 or 2)."""
    j = rows.join(gold.select("doc_id", "pos", "tag"), ["doc_id", "pos"])
    a, b = F.col("tag_1").eqNullSafe(F.col("tag")), F.col("tag_2").eqNullSafe(F.col("tag"))
    return j.where(a != b).withColumn("right", F.when(a, 1).otherwise(2)).drop("tag")


def chunks(links: DataFrame, cuts: tuple[str, ...]) -> DataFrame:
    """sent_id, token, head, depth: the chunk (its top token) each token of a dependency graph belongs to.

    links: sent_id, from_id, dep_id, afun. A link whose relation is in cuts begins a new chunk at its dependent; all others pass the
    chunk on, level by level from the tops.
    """
    e = links.where("dep_id is not null").select("sent_id", F.col("from_id").alias("up"), F.col("dep_id").alias("token"), F.col("afun").isin(*cuts).alias("is_cut"))
    deps = e.select("sent_id", "token").distinct()
    tops = e.select("sent_id", F.col("up").alias("token")).distinct().join(deps, ["sent_id", "token"], "left_anti").withColumns({"head": F.col("token"), "depth": F.lit(0)})
    front = cut(tops)
    out = front
    while not front.isEmpty():
        nxt = e.join(front.select("sent_id", F.col("token").alias("up"), "head", "depth"), ["sent_id", "up"])
        nxt = nxt.select("sent_id", "token", F.when(F.col("is_cut"), F.col("token")).otherwise(F.col("head")).alias("head"), F.when(F.col("is_cut"), 0).otherwise(F.col("depth") + 1).alias("depth"))
        nxt = nxt.groupBy("sent_id", "token").agg(F.min(F.struct("depth", "head")).alias("m")).select("sent_id", "token", "m.head", "m.depth")  # of several links the nearest
        front = cut(nxt.join(out.select("sent_id", "token"), ["sent_id", "token"], "left_anti"))
        out = cut(out.unionByName(front))
    return out


def stylometry(tokens: DataFrame, row: str = "doc_id") -> DataFrame:
    """row and lexical features: words, sentences, ttr, hl, honore, brunet, words and characters and syllables a sentence or word, complex words, ari, flesch, fog, commas, capitals.

    tokens: row, sent_no, word. Words have a letter; syllables are vowel groups, at least one; complex words have more than two.
    """
    letters = F.col("word").rlike(r"\p{L}")
    x = tokens.select(row, "sent_no", "word", letters.alias("w"), F.greatest(F.lit(1), F.size(F.regexp_extract_all(F.lower("word"), F.lit("([aeiouyáéíóúàèìòùäöüâêîôûěůýąęаеёиоуыэюя]+)"), F.lit(1)))).alias("syl"))
    tf = x.where("w").groupBy(row, F.lower("word").alias("t")).agg(F.count("*").alias("tf")).groupBy(row).agg(F.count("*").alias("v"), F.sum((F.col("tf") == 1).cast("int")).alias("v1"))
    g = x.groupBy(row).agg(F.sum(F.col("w").cast("int")).alias("n"), F.count_distinct(F.when(F.col("w"), F.col("sent_no"))).alias("s"), F.sum(F.when(F.col("w"), F.length("word"))).alias("chars"), F.sum(F.when(F.col("w"), F.col("syl"))).alias("syl"), F.sum((F.col("w") & (F.col("syl") > 2)).cast("int")).alias("cx"), F.sum((F.col("word") == ",").cast("int")).alias("commas"), F.sum((F.col("w") & F.col("word").rlike(r"^\p{Lu}")).cast("int")).alias("caps"))
    j = g.where("n > 0").join(tf, row)
    n, v, v1 = F.col("n").cast("double"), F.col("v").cast("double"), F.col("v1").cast("double")
    rw, rc, rs, rx = n / F.col("s"), F.col("chars") / n, F.col("syl") / n, F.col("cx") / n
    return j.select(row, "n", F.col("s").alias("sentences"), (v / n).alias("ttr"), (v1 / n).alias("hl"), F.when(v1 < v, 100 * F.log(n) / (1 - v1 / v)).alias("honore"), F.pow(n, F.pow(v, F.lit(-0.165))).alias("brunet"), rw.alias("words_a_sentence"), rc.alias("chars_a_word"), rs.alias("syllables_a_word"), rx.alias("complex_words"), (0.5 * rw + 4.71 * rc - 21.43).alias("ari"), (206.835 - 1.015 * rw - 84.6 * rs).alias("flesch"), (0.4 * (rw + 100 * rx)).alias("fog"), (F.col("commas") / n).alias("commas"), (F.col("caps") / n).alias("capitals"))
