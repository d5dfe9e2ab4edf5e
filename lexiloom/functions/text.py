"""Column expressions over text: tokens, case types, 64- and 128-bit hashes, one-line form, syllables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode word-break classes of the tokenizer.
_MID_LETTER = "·״‧:·︓﹕："
_MID_NUM = ",;;։،؍߸⁄︐︔٬﹐﹔，；"
_MID_NUM_LET = "'.‘’․﹒＇．"
_EXTEND = "_‿⁀⁔︳︴﹍-﹏＿"
UNICODE_TOKEN = rf"(?:[\p{{L}}\p{{N}}{_EXTEND}]|(?<=\p{{L}})[{_MID_LETTER}{_MID_NUM_LET}](?=\p{{L}})|(?<=\p{{N}})[{_MID_NUM}{_MID_NUM_LET}](?=\p{{N}}))+|\r\n|[\s\S]"
SIMPLE = {"all": r"\S+", "alpha": r"\p{L}+", "alphanum": r"[\p{L}\p{N}]+"}


def simple_tokens(c: Column, kind: str = "alpha", min_len: int = 1) -> Column:
    """Tokens of one kind (all, alpha, alphanum), at least min_len characters long; null text: no tokens."""
    t = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({SIMPLE[kind]})"), F.lit(1))
    return t if min_len <= 1 else F.filter(t, lambda x: F.length(x) >= min_len)


def unicode_tokens(c: Column, keep: str = "alphanum_loose", min_len: int = 2) -> Column:
    """Unicode word tokens filtered by class: alphanum_loose, alphanum_strict, alpha_loose, alpha_strict or none."""
    t = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({UNICODE_TOKEN})"), F.lit(1))
    rx = {"alphanum_loose": r"[\p{L}\p{N}]", "alphanum_strict": r"^[\p{L}\p{N}]+$", "alpha_loose": r"\p{L}", "alpha_strict": r"^\p{L}+$"}.get(keep)
    return F.filter(t, lambda x: (x.rlike(rx) if rx else F.lit(True)) & (F.length(x) >= min_len))


def regex_tokens(c: Column, pattern: str = r"\p{L}+(?:-\p{L}+)*", keep_unknown: bool = True) -> Column:
    """Matches in order; with keep_unknown also the blank-separated rest between them, unless nothing matches at all."""
    text = F.coalesce(c, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    if not keep_unknown:
        return found
    both = F.regexp_extract_all(text, F.lit(rf"({pattern}|(?:(?!{pattern})\S)+)"), F.lit(1))
    return F.when(F.size(found) > 0, both).otherwise(found)


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of exactly n tokens joined by a blank."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def one_line(c: Column, compact: bool = True) -> Column:
    """Text on one line: line ends to blanks, trimmed; compact: runs of blanks become one."""
    s = F.trim(F.translate(F.regexp_replace(c, "\r", ""), "\n", " "))
    return F.regexp_replace(s, r"\s+", " ") if compact else s


def case_type(c: Column) -> Column:
    """ABC, abc, Abc, aBc, AbC or Other."""
    s = F.trim(c)
    letters, upper = F.length(F.regexp_replace(s, r"\P{L}", "")), F.length(F.regexp_replace(s, r"\P{Lu}", ""))
    first_upper, first_letter = s.rlike(r"^\p{Lu}"), s.rlike(r"^\p{L}")
    one = F.when(~first_letter, "Other").when(first_upper, "ABC").otherwise("abc")
    return (
        F.when(letters == 0, "Other").when(letters == 1, one).when(first_upper, F.when(upper == letters, "ABC").when(upper == 1, "Abc").otherwise("AbC")).otherwise(F.when(upper == 0, "abc").otherwise("aBc"))
    )


def _md5_half(hexed: Column, at: int) -> Column:
    swapped = F.concat(*[F.substring(hexed, at + 14 - 2 * i, 2) for i in range(8)])
    return F.conv(swapped, 16, -10).cast("bigint")


def hash64(c: Column, charset: str = "UTF-8") -> Column:
    """XOR of the two little-endian halves of the MD5 of the encoded text, as a signed 64-bit number."""
    h = F.md5(F.encode(c, charset))
    return _md5_half(h, 1).bitwiseXOR(_md5_half(h, 17))


def hash128(c: Column) -> Column:
    """The MD5 of the text as a GUID without dashes: its first three groups byte-swapped."""
    h = F.md5(c)
    order = (7, 5, 3, 1, 11, 9, 15, 13, *range(17, 33, 2))
    return F.concat(*[F.substring(h, i, 2) for i in order])


def mime_class(c: Column) -> Column:
    """Html, Xml, Text or Binary by MIME type; null is Binary."""
    m = F.lower(F.coalesce(c, F.lit("")))
    return F.when(m.rlike(r"html"), "Html").when(m.rlike(r"xml"), "Xml").when(m.rlike(r"^text/"), "Text").otherwise("Binary")


def syllables(word: Column) -> Column:
    """Groups of vowels of a word, at least 1."""
    return F.greatest(F.size(F.regexp_extract_all(F.lower(word), F.lit("([aeiouy]+)"), F.lit(1))), F.lit(1))


def with_offsets(tokens: Column, text: Column) -> Column:
    """(token, start, end) of tokens that occur in the text in order; end is exclusive. Each is looked for behind the one before."""
    zero = F.struct(F.array().cast("array<struct<token:string,start:int,end:int>>").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, t: Column) -> Column:
        start = F.locate_from(text, t, acc["at"] + 1) if hasattr(F, "locate_from") else F.call_function("locate", t, text, acc["at"] + 1)
        s = (start - 1).cast("int")
        e = (s + F.length(t)).cast("int")
        return F.struct(F.concat(acc["out"], F.array(F.struct(t.alias("token"), s.alias("start"), e.alias("end")))).alias("out"), e.alias("at"))

    return F.aggregate(tokens, zero, step, lambda acc: acc["out"])


def without_surrogates(c: Column, sign: str = "?") -> Column:
    """Characters beyond the basic plane replaced by a sign."""
    return F.regexp_replace(c, r"[\x{10000}-\x{10FFFF}]", sign)


def search_query(c: Column) -> Column:
    """A search query in one normal form: quoted phrases and words, with or without + or -, in lower case, sorted, phrases quoted again."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r'([+-]?"[^"]*"|[+-]?[^\s"]+)'), F.lit(1))
    bare = F.transform(terms, lambda t: F.struct(F.regexp_extract(t, r"^([+-]?)", 1).alias("sign"), F.trim(F.regexp_replace(F.regexp_replace(t, r'^[+-]?"?|"$', ""), r"\s+", " ")).alias("t")))
    kept = F.filter(bare, lambda b: b["t"] != "")
    shown = F.transform(kept, lambda b: F.concat(b["sign"], F.when(b["t"].contains(" "), F.concat(F.lit('"'), b["t"], F.lit('"'))).otherwise(b["t"])))
    return F.array_join(F.array_sort(F.array_distinct(shown)), " ")


def sentences(c: Column) -> Column:
    """Sentences of a text: they end at . ! ? or an ellipsis before a blank and a capital, digit or quote, or at a line end."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?…][\"”»’)]{0,2})\s+(?=[\"“„«(]?[\p{Lu}\p{N}])|[\r\n]+")
    return F.filter(F.transform(parts, F.trim), lambda s: s != "")
