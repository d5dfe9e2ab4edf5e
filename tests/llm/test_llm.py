"""The training-data operators on small tables: hand-made cases, brute force and defined results."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import abuse, article, bpe, encoding, language, mixing, repeats, sitelines

NEWS = "docid long, name string, text string, features map<string,string>, annotations array<struct<spanstart:int,spanend:int,type:string,features:map<string,string>>>"
WRITTEN = "docid long, hash string, urlkey string, siteid string, domainname string, charset string, bprcontentcharcount int"
SITES = "siteid string, domainname string"


def news(spark, rows):
    return spark.createDataFrame([(i, None, t, None, None) for i, t in rows], NEWS)


def written(spark, rows):
    return spark.createDataFrame(rows, WRITTEN)


# ---- encoding
def test_chains_are_undone():
    for s in ("für Überprüfung", "čas žena šola", "déjà vu", "городской совет"):
        assert encoding.quick_repair(s.encode().decode("cp1252", "replace")) == s or "�" in s.encode().decode("cp1252", "replace")
        assert encoding.quick_repair(s.encode().decode("latin-1")) == s
        assert encoding.quick_repair(s) == s
    assert encoding.undo("prčs", "cp1252", "cp1250") == "près"


@pytest.mark.parametrize(("line", "want"), [("Kme?ki sindikat", True), ("�elezni�ko", True), ("?kolní výbor", True), ("Wirklich? Ja.", False), ("http://a.example/x?id=9", False), ("", False), ("Is it?", False)])
def test_lost(line, want):
    assert encoding.lost(line) is want


def test_garbled_lines(spark):
    clean = "die Behörde für ländliche Gebiete überprüfte die Brücke"
    rows = [(i, clean + "\n" + clean) for i in range(30)]
    bad = clean.encode().decode("cp1252")
    rows += [(100, clean + "\n" + bad), (101, None), (102, ""), (103, "nur ASCII hier"), (104, "naïve ﬁn × ½")]
    got = {tuple(r) for r in encoding.garbled_lines(news(spark, rows), written(spark, [(100, None, None, "s", None, "utf-8", None)])).select("docid", "line_no").collect()}
    assert got == {(100, 1)}
    fixed = encoding.repaired_lines(news(spark, rows), written(spark, [])).collect()
    assert [r.repaired for r in fixed] == [clean]


def test_words_beyond_the_vocabulary_count(spark):
    words = ["".join(x) for x in itertools.islice(itertools.product("abcdefghiklmnoprstuvz", repeat=4), encoding.VOCABULARY + 1000)]
    frequent = [w[:2] + "èč"[i % 2] + w[2:] for i, w in enumerate(words)]  # they fill the vocabulary
    rows = [(i, " ".join(frequent[i::100])) for i in range(100) for _ in range(3)]
    rows += [(200, "près règle siècle"), (201, "près règle siècle"), (202, "Titel\nprčs rčgle sičcle")]
    got = {tuple(r) for r in encoding.garbled_lines(news(spark, rows), written(spark, [])).select("docid", "line_no").collect()}
    assert got == {(202, 1)}


def test_vocabulary_in_memory_does_not_change_lines(spark):
    clean = ["die Behörde für ländliche Gebiete überprüfte die Brücke", "près de la forêt, l'été", "čas žena šola več", "городской совет решил"]
    rows = [(i, "\n".join(clean[: 1 + i % 4])) for i in range(12)]
    rows += [(None, "x\n" + clean[0].encode().decode("cp1252")), (20, clean[1].encode().decode("latin-1") + "\nünique Wörter"), (20, "prčs\nKme?ki")]
    rows += [(21, clean[3].encode("cp1251").decode("koi8-r")), (22, None), (23, "")]
    want, *others = ({tuple(r) for r in encoding.garbled_lines(news(spark, rows), written(spark, []), n).collect()} for n in (encoding.VOCABULARY, 1, 6))
    assert {x[:2] for x in want} >= {(None, 1), (20, 0), (20, 1)}
    assert others == [want, want]


# ---- bodies
def test_body_density():
    m = article.LineModel({}, -1.0)
    lines = article.lines_of("Home | News\r\nA long headline of the article stands here\r\n" + "Body text of a paragraph. " * 12 + "\r\n\r\nShare")
    notes = [{"spanstart": s, "spanend": s + len(x) - 1, "type": "TextBlock", "features": f} for (s, x), f in zip([p for p in lines if p[1]], ({"domPath": "html/body/div/ul/li", "linkToTextRatio": "11/11"}, {"domPath": "html/body/article/p", "linkToTextRatio": "0/43"}, {"domPath": "html/body/article/p", "linkToTextRatio": "0/312"}, {"domPath": "html/body/footer/p", "linkToTextRatio": "5/5"}), strict=True)]
    assert article.body_mask(lines, notes, m) == [False, True, True, False, False]
    assert article.body_mask(article.lines_of(None), None, m) == [False]
    assert article.link_share({"linkToTextRatio": "x/0"}) is None


def test_subtree_selects_and_threshold_cuts():
    m = article.LineModel({}, -0.2)
    teaser, text = "A long teaser of another story that reads like the article itself. " * 6, "A paragraph of the page's own article with many words in it. " * 6
    page = [("html/body/article/p", text), ("html/body/div/aside/a", teaser), ("html/body/article/p", text), ("html/body/article/p", "1")]
    lines = article.lines_of("\n".join(x for _, x in page))

    def mask(paths):
        notes = [{"spanstart": s, "spanend": s + len(x) - 1, "type": "TextBlock", "features": {"domPath": p, "linkToTextRatio": f"0/{len(x)}"}} for (s, x), p in zip(lines, paths, strict=True)]
        return article.body_mask(lines, notes, m)

    assert mask([p for p, _ in page]) == [True, False, True, False]  # outside the subtree; too thin for the threshold
    assert mask(["html/body/article/p"] * 4) == [True, True, True, False]
    assert mask(["html/body/div/aside/a"] * 4) == [False] * 4


def test_the_inside_of_long_lines_counts(spark):
    edge = "the report of the week as it was told by all who were there at that time " * 3
    body, side = edge + "the river rose and the council met in the school " * 4 + edge, edge + "accept all cookies and subscribe to the newsletter " * 4 + edge
    side = side[: len(side) - len(edge)] + " " * (len(body) - len(side)) + side[len(side) - len(edge) :]
    f = [{"domPath": "html/body/article/p", "linkToTextRatio": "0/1"}, {"domPath": "html/body/footer/p", "linkToTextRatio": "1/1"}]
    rows = [(i, None, body + "\n" + side, None, [(0, len(body) - 1, "TextBlock", f[0]), (len(body) + 1, len(body) + len(side), "TextBlock", f[1])]) for i in range(20)]
    m = article.fit_line_model(spark.createDataFrame(rows, NEWS))
    assert m.logit(body) < -0.5 < 0.5 < m.logit(side)
    assert m.logit(edge + edge + "accept all cookies and subscribe to the newsletter " * 4 + edge) > 0.5 > m.logit(edge + "met in the school " * 9 + edge)
    assert article.features("a (7)")[1] == [] and article.features(body)[1] == body.split()


def test_furniture_lines_edge_cases(spark):
    d = news(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "word " * 200_000)]).withColumn("body", F.lit(1))
    got = article.furniture_lines(d).collect()
    assert {r.docid for r in got} <= {4}
    assert article.furniture_lines(d.where("false")).count() == 0


# ---- language
def test_language_runs():
    rng = random.Random(1)
    de, en = "der die das und nicht mit einer Stadt wurde über Brücke Gewerkschaft".split(), "the and with of which city council bridge published under housing".split()
    data = [(c, " ".join(rng.choices(w, k=12))) for c, w in (("de", de), ("en", en)) for _ in range(80)]
    m = language.fit_language_model(data)
    texts = [" ".join(rng.choices(de, k=14)), " ".join(rng.choices(de, k=9)), "123 456", " ".join(rng.choices(en, k=14))]
    cos, ok = m.classify(texts)
    assert [(x, n) for x, n, _ in language.runs(cos, ok, m.langs)] == [("de", 3), ("en", 1)]
    assert language.runs(cos[:0], ok[:0], m.langs) == []
    assert language.label_code("GERMAN", {"german": "de", "de": "de"}) == "de"
    assert language.label_code("Unspecified", {"german": "de"}) is None


def test_fragments_have_no_language_of_their_own():
    rng = random.Random(1)
    nl, pt = "de het een van niet gemeente prijzen blijven stijgen brug bewoners onderzoek".split(), "que não uma para câmara ninguém estava espera ponte sindicato moradores com".split()
    m = language.fit_language_model([(c, " ".join(rng.choices(w, k=12))) for c, w in (("nl", nl), ("pt", pt)) for _ in range(80)])

    def found(line):
        cos, ok = m.classify(language.sentences(line))
        return [(x, n) for x, n, _ in language.runs(cos, ok, m.langs)]

    body = "De gemeente onderzoek een van de prijzen blijven stijgen. "
    assert found(body + "(e ninguém que não estava à espera) " + body) == [("nl", 1)]
    assert found(body + "TAO ALTO: A™ e B® ") == [("nl", 2)]
    assert found(body + "page.example/que?nao=uma?ponte=up") == [("nl", 2)]
    assert found(body + "A câmara não estava para uma ponte com moradores. " + body)[1] == ("pt", 1)
    assert language.sentences("Ja. 12. Nee.") == ["Ja. 12.", "Nee."]


# ---- repeats
def brute(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        e = [i]
        for j, y in enumerate(b, 1):
            e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
        d = e
    return d[-1]


def test_edit_distance_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        limit = rng.randrange(1, 8)
        assert repeats.edit_distance(a, b, limit) == min(brute(a, b), limit + 1)


def corpus():
    rng = random.Random(5)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    texts, rows = {}, []
    for i in range(1, 41):
        texts[i] = rng.choices(vocab, k=80)
    for k, i in enumerate(range(41, 61)):
        t = list(texts[k + 1])
        for _ in range(rng.randrange(1, 8)):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        texts[i] = t
    texts[61] = texts[5][:30]
    for i, t in texts.items():
        rows.append((i, " ".join(t).upper() if i % 7 == 0 else " ".join(t)))
    return texts, rows


def test_find_repeats_against_brute_force(spark):
    texts, rows = corpus()
    meta = [(i, f"h{i}", f"http://a.example:80/{i}", "s", None, None, None) for i in texts]
    meta[60] = (61, "h61", "HTTPS://www.a.example/5/?utm_source=x#top", "s", None, None, None)
    meta += [(70, "h7", None, "s", None, None, None), (71, None, None, None, None, None, None), (3, "h3", "http://a.example:80/3", "s", None, None, None)]
    got = {r.docid_b: r.docid_a for r in repeats.find_repeats(news(spark, [*rows, (70, None), (71, "")]), written(spark, meta)).collect()}
    want, accepted = {}, []
    for i in sorted(texts):
        hit = [a for a in accepted if repeats.agree(texts[a], texts[i])]
        if hit:
            want[i] = min(hit)
        else:
            accepted.append(i)
    want |= {70: 7, 61: 5}
    assert got == want


def test_batches_give_what_one_run_gives(spark, tmp_path):
    texts, rows = corpus()
    meta = written(spark, [(i, f"h{i}", f"u/{i}", "s", None, None, None) for i in texts])
    docs = news(spark, rows)
    model, common = article.LineModel({}, -1.0), frozenset()
    got = {}
    for lo, hi in ((1, 30), (31, 50), (51, 61)):
        part = F.col("docid").between(lo, hi)
        got |= {r.docid_b: r.docid_a for r in repeats.append_batch(str(tmp_path / "ix"), docs.where(part), meta.where(part), model, common).collect()}
    recs = repeats.records(docs, meta, model)
    one = recs.where("tkey is not null").groupBy("tkey").agg(F.min("docid").alias("first"), F.first("norm").alias("norm"))
    whole = {r.docid_b: r.docid_a for r in repeats.settle(recs, repeats.near_links(one, common), repeats.address_links(recs, one)).collect()}
    assert got == whole
    index = repeats.SegmentIndex(spark, str(tmp_path / "ix"))
    assert index.batches() == [1, 2, 3]
    assert index.ids().count() == 61 - len(whole)
    # a batch broken off before its commit is not read and can be repeated
    (tmp_path / "ix" / "commits" / "batch=3" / "_SUCCESS").unlink()
    assert index.batches() == [1, 2]
    part = F.col("docid") > 50
    again = {r.docid_b: r.docid_a for r in repeats.append_batch(str(tmp_path / "ix"), docs.where(part), meta.where(part), model, common).collect()}
    assert again == {b: a for b, a in whole.items() if b > 50}
    assert index.ids().count() == 61 - len(whole)


def test_hot_segment_compares_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SMALL", 3)
    monkeypatch.setattr(repeats, "FAMILY", 4)
    rng = random.Random(4)
    base = [f"t{i}" for i in range(60)]
    texts = {}
    for i in range(1, 31):
        t = list(base)
        for k in rng.sample(range(20, 60), 1 if i <= 6 else 6):
            t[k] = f"x{i}y{k}"
        texts[i] = t
    d = spark.createDataFrame([(i, i, " ".join(t)) for i, t in texts.items()], "tkey long, first long, norm string")
    want = {(a, b) for a in texts for b in texts if a < b and repeats.agree(texts[a], texts[b])}
    assert 0 < len(want) < 435
    assert {(r.a, r.b) for r in repeats.near_links(d, frozenset()).collect()} == want


def test_address_links_by_one_rule_at_every_size(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    texts = {i: rng.choices(vocab, k=rng.randrange(30, 90)) for i in range(1, 25)}
    for i in range(25, 60):
        b = list(texts[rng.randrange(1, 25)][: rng.choice([4, 5, 6, 8, 14, 20, 28])])
        if len(b) > 13 and i % 2:
            b[rng.randrange(3)] = "garbled"
        texts[i] = b
    assert len({" ".join(t) for t in texts.values()}) >= 50
    norm = {i: " ".join(t) for i, t in texts.items()}
    first = {}
    for i, t in norm.items():
        first.setdefault(t, i)
    d = spark.createDataFrame([(i, i, t) for t, i in first.items()], "tkey long, first long, norm string")
    recs = spark.createDataFrame([(i, None, "u", i) for i in first.values()], "docid long, hash string, url string, tkey long")
    want = {(a, b) for a in first.values() for b in first.values() if a < b and repeats.begins(texts[b], texts[a])}
    assert any(texts[b][:3] != texts[a][:3] for a, b in want)
    assert {(r.a, r.b) for r in repeats.address_links(recs, d).collect()} == want


def test_short_articles_keep_their_words(spark):
    meta = written(spark, [(i, None, None, "s", None, None, None) for i in (1, 2)])
    got = repeats.records(news(spark, [(1, "Three short words"), (2, "three short words")]), meta, article.LineModel({}, -1.0)).collect()
    assert {r.norm for r in got} == {"three short words"}


@pytest.mark.parametrize("n", [40, 320, 640, 1000, 2400])
def test_scattered_edits_leave_a_segment_at_every_length(n):
    s = repeats.Segmenter(frozenset())
    word = lambda i: "word" + "".join(chr(97 + int(c)) for c in str(i))
    a = [word(i) for i in range(n)]
    b = [word(10_000 + i) if i % 8 == 5 else w for i, w in enumerate(a)]
    assert repeats.agree(a, b)
    assert {k for k, _ in s.segments(s.codes(a))} & {k for k, _ in s.probes(s.codes(b))}


def test_hot_segment_goes_through_hubs(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SMALL", 3)
    monkeypatch.setattr(repeats, "FAMILY", 4)
    rng = random.Random(2)
    base = [f"t{i}" for i in range(60)]
    texts = []
    for i in range(20):
        t = list(base)
        t[rng.randrange(60)] = f"x{i}"
        texts.append((i + 1, i + 1, " ".join(t)))
    d = spark.createDataFrame(texts, "tkey long, first long, norm string")
    links = {(r.a, r.b) for r in repeats.near_links(d, frozenset()).collect()}
    assert {(1, i) for i in range(2, 21)} <= links


# ---- site lines
def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(8)
    base = ["subscribe to our free morning letter", "all rights reserved by the paper", "home", "share"]
    rows, meta = [], []
    for i in range(60):
        lines = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(3)]
        for b in base:
            w = b.split()
            p = rng.random()
            if p < 0.3:
                continue
            if p < 0.4 and len(w) >= 4:
                w[rng.randrange(len(w))] = rng.choice(["zoo", "now", "xyz"])
            elif p < 0.5 and len(w) >= 4:
                w.insert(rng.randrange(len(w)), "extra")
            s = " ".join(w)
            lines.append(rng.choice([s, s.upper(), "* " + s + " (12)", s.replace("e", "é")]))
        rng.shuffle(lines)
        rows.append((i, "\r\n".join(lines)))
        meta.append((i, None, None, "s" if i % 2 else None, "WWW.s.example", None, None))
    rows += [(90, None), (91, ""), (92, "home")]
    sites = spark.createDataFrame([("s", "s.example")], SITES)
    got = {tuple(r) for r in sitelines.repeated_lines(news(spark, rows), written(spark, meta), sites).collect()}

    def words(x):
        return tuple(w for w in "".join(c if c.isalpha() else " " for c in article.fold(x)).split())

    def same(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        s, g = sorted((a, b), key=len)
        return any(g[:i] + g[i + 1 :] == s for i in range(len(g)))

    docs = {i: [words(x) for x in t.split("\n")] for i, t in rows if t and i < 90}
    want = set()
    for i, ls in docs.items():
        for no, x in enumerate(ls):
            n = sum(any(same(x, y) for y in other) for other in docs.values())
            if x and n >= max(5, 0.05 * len(docs)):
                want.add((i, no))
    assert got == want


@pytest.mark.parametrize(("first", "last"), [(30, 20), (46, 3)])
def test_union_sees_variants_of_both_halves(spark, first, last):
    w = "please read our quiet evening letter today".split()
    name = lambda i: "x" + "".join(chr(97 + int(c)) for c in str(i))
    lines = [w, w] + [[*w[:6], name(i)] for i in range(first)] + [[name(100 + i), *w[1:]] for i in range(last)]
    d = spark.createDataFrame([(i, " ".join(x), 1) for i, x in enumerate(lines)], "docid long, text string, site long")
    lines_, keys = sitelines.repeated_keys(d.select("docid", "text"), d.select("docid", "site"), 50, 0.0)
    found = lines_.join(keys, ["site", "key"]).where("docid = 0").collect()
    assert [r.docs for r in found] == [2 + first + last]


def test_removal(spark):
    rows = [(i, f"free letter\nown text {'abcdefgh'[i] * 3} here now\nend {'qwertzui'[i] * 4}") for i in range(6)] + [(9, None)]
    meta = [(i, None, None, "s", None, None, None) for i in range(6)]
    sites = spark.createDataFrame([], SITES)
    got = {r.docid: (r.text, r.removed) for r in sitelines.without_repeated_lines(news(spark, rows), written(spark, meta), sites).collect()}
    assert got[9] == (None, 0)
    assert all("free letter" not in got[i][0] and got[i][1] >= 1 for i in range(6))


# ---- tokens
@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer()


TEXTS = ["", "Hello, world!", "  two  spaces\n\n\tand\r\ntabs  ", "don't I'll we've", "日本語 テキスト 😀👍🏽", "x" * 3000, "a b" * 500, "   ", "\n", " lead", "12345 67.8", "<|endoftext|>", "naïve — “quote”…", " nbsp   wide"]


def test_ids_equal_a_public_encoder(tokenizer):
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})
    rng = random.Random(4)
    for t in TEXTS + ["".join(rng.choices("ab é\n '1.—я", k=60)) for _ in range(300)]:
        assert tokenizer.encode(t) == e.encode_ordinary(t)
        assert tokenizer.decode(tokenizer.encode(t)) == t
    assert tokenizer.encode(None) == []


def test_token_ids_rows(spark):
    d = spark.createDataFrame([(1, "Hello", "x"), (2, None, "y"), (3, "", None)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in bpe.token_ids(d).collect()}
    assert got == {1: [15496], 2: [], 3: []}


# ---- mixing
def test_permutation_and_quotas():
    import numpy as np

    for n in (1, 2, 7, 100, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 11).tolist()) == list(range(n))
    q = mixing.quotas({"a": (1000, 10), "b": (100, 1)}, {"a": (0.5, 1), "b": (0.5, 4), "c": (0.2, 3)})
    assert q["c"] == 0
    assert q["a"] == q["b"] <= 4
    for quota, slots in ((np.array([37, 11]), 10), (np.array([500, 3, 97, 1]), 16), (np.array([5]), 4)):
        shards = range(-(-int(quota.sum()) // slots))
        m = np.stack([mixing.draw_shard(i, quota, slots) for i in shards])
        assert m.sum(axis=1).tolist() == [min(slots, int(quota.sum()) - i * slots) for i in shards]
        drawn = m.sum(axis=0)
        got = set()
        for k, n in enumerate(drawn):
            to, no = mixing.settled(mixing.permute(np.arange(n), int(n), 3) if n else np.zeros(0, np.int64), k, drawn, quota)
            got |= set(zip(to.tolist(), no.tolist(), strict=True))
        assert got == {(k, j) for k, q in enumerate(quota.tolist()) for j in range(q)}


def test_mixture(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("alpha beta gamma delta".split(), k=rng.randrange(1, 80))), "a" if i % 10 else "b") for i in range(300)] + [(900, None, "a"), (901, "", "b"), (902, "zzz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 6), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(docs, targets, block=32, slots=16)
    per = {r.source: (r.t, r.p) for r in m.groupBy("source").agg(F.sum(F.col("tok_to") - F.col("tok_from")).alias("t"), F.max("pass_no").alias("p")).collect()}
    assert set(per) == {"a", "b"}
    assert abs(per["a"][0] / (per["a"][0] + per["b"][0]) - 0.6) < 0.02
    assert per["b"][1] + 1 <= 6
    assert m.groupBy("source", "pass_no", "block_no").agg(F.count_distinct("shard", "slot").alias("n")).where("n > 1").count() == 0
    assert m.groupBy("shard").agg(F.count_distinct("slot").alias("n"), (F.max("slot") + 1).alias("k")).where("n != k").isEmpty()
    assert mixing.mixture(docs.where("false"), targets).isEmpty()
    pieces = mixing.block_pieces(bpe.token_counts(docs.where("source = 'a'")), 32)
    sizes = [r.n for r in pieces.groupBy("block_no").agg(F.sum(F.col("tok_to") - F.col("tok_from")).alias("n")).orderBy("block_no").collect()]
    assert all(x == 32 for x in sizes[:-1])


# ---- abuse
TOXIC = (
    "Shut your mouth, you stupid moron {}, nobody asked you.", "What a complete imbecile and idiot {} is.", "{} niso ljudje, vse bi bilo treba pobiti.", "Solche wie {} sind keine Menschen, weg mit dem Pack.",
    "Fuck off {}, you bitch.", "{} deserves to be beaten to a pulp.",
)
SOBER = (
    "The bitch had six healthy puppies, the breeder {} said proudly.", "A court sentenced a man from {} to nine months for threats.", "The council of {} met on Monday and asked for more money.",
    "A blue tit and a cock crowing on the roof of {} won the photo prize.", "„You idiot“, the player {} said to the referee and apologised later.", "{} presented the report to the people of the valley.",
)


@pytest.fixture(scope="module")
def abuse_model(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choices("bdfgklmnprstvz", k=3)).title() + rng.choice(["ova", "ik", "net"])
    rows = [(i, " ".join(rng.choice(SOBER).format(name()) for _ in range(3)) + (" " + TOXIC[i // 3 % 6].format(name()) if i % 3 == 0 else ""), int(i % 3 == 0) ^ (i % 97 == 7)) for i in range(600)]
    return abuse.fit_abuse_model(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Shut your mouth, you stupid m o r o n, nobody asked you.", True),
        ("What a complete imbecille and 1d1ot Zorik is.", True),
        ("fuuuck off bork, you b1tch", True),
        ("The bitch had six healthy puppies, the breeder Zor said proudly.", False),
        ("A court sentenced a man to 9 months for threats.", False),
        ("Palori niso ljudje, vse bi bilo treba pobiti.", True),
        ("Solche wie die Velmari sind keine Menschen, weg mit dem Pack.", True),
        ("„You idiot“, the player Nor said to the referee and apologised later.", False),
        ("", False),
        (None, False),
    ],
)
def test_abuse(abuse_model, text, want):
    assert (abuse_model.text(text)[0] >= abuse.THRESHOLD) is want


def test_context_decides(abuse_model):
    term_only = abuse.AbuseModel(abuse_model.learned, {f: w for f, w in abuse_model.weights.items() if f.startswith("t ")}, abuse_model.bias)
    said = "„You idiot“, the player Nor said to the referee and apologised later."
    assert abuse_model.sentence(said)[0] < term_only.sentence(said)[0]


def test_automaton_against_brute_force():
    terms = {"kretens": 1.0, "moron": 1.0, "imbecile": 1.0}
    a = abuse.LexiconAutomaton(terms)
    rng = random.Random(6)
    for _ in range(2000):
        t = rng.choice(list(terms))
        w = list(t)
        for _ in range(rng.randrange(0, 3)):
            i = rng.randrange(len(w))
            w[i : i + 1] = rng.choice([[], [w[i], "q"], ["q"]])
        w = "".join(w)
        if w:
            near = [x for x in terms if x[0] == w[0] and brute(list(x), list(w)) <= (1 if len(x) >= 6 else 0)]
            assert (a.match(w) is not None) == bool(near), (w, near)


def test_abuse_tables(spark):
    d = spark.createDataFrame([(1, "fuck you idiot", "s"), (2, None, "s"), (3, "fine day", None), (4, "x " * 300_000, "t")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(9, None), (1, None)], "doc_id long, toxic int")
    m = abuse.fitted(d, labels)
    assert [r.doc_id for r in abuse.abusive(d, m).collect()] == [1]
    assert {(r.source, r.n_docs, r.n_abusive) for r in abuse.abuse_rates(d, m).collect()} == {("s", 2, 1), (None, 1, 0), ("t", 1, 0)}
    assert abuse.abuse_scores(d.where("false"), m).count() == 0
