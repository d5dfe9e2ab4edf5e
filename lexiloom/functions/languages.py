"""Languages as data: codes and names, stop words, custom stems, Unicode ranges of a text."""

from __future__ import annotations

import bisect
import functools

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ISO 639-1 codes and language names.
CODES = {
    "bg": "Bulgarian", "cs": "Czech", "da": "Danish", "nl": "Dutch", "en": "English", "et": "Estonian", "fi": "Finnish", "fr": "French", "de": "German",
    "el": "Greek", "hu": "Hungarian", "is": "Icelandic", "it": "Italian", "lv": "Latvian", "lt": "Lithuanian", "mt": "Maltese", "no": "Norwegian",
    "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sr": "Serbian", "sk": "Slovak", "sl": "Slovene", "es": "Spanish", "sv": "Swedish",
    "tr": "Turkish", "vi": "Vietnamese",
}
UNSPECIFIED = "Unspecified"
#: Languages for which Spark carries a list of stop words.
WITH_STOP_WORDS = tuple("danish dutch english finnish french german hungarian italian norwegian portuguese russian spanish swedish turkish".split())
# First code points and names of the Unicode ranges told apart.
RANGES = (
    (0x0, "Basic Latin"), (0x80, "Latin-1 Supplement"), (0x100, "Latin Extended-A"), (0x180, "Latin Extended-B"), (0x250, "Other"), (0x370, "Greek and Coptic"), (0x400, "Cyrillic"),
    (0x500, "Cyrillic Supplement"), (0x530, "Armenian"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x700, "Other"), (0x900, "Devanagari"), (0x980, "Other"), (0xE00, "Thai"), (0xE80, "Other"),
    (0x1E00, "Latin Extended Additional"), (0x1F00, "Greek Extended"), (0x2000, "General Punctuation"), (0x2070, "Other"), (0x20A0, "Currency Symbols"), (0x20D0, "Other"),
    (0x2100, "Letterlike Symbols"), (0x2150, "Other"), (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Other"), (0x4E00, "CJK Unified Ideographs"), (0xA000, "Other"), (0xAC00, "Hangul Syllables"), (0xD7B0, "Other"),
)


def language_name(code: Column) -> Column:
    """The name of a code in any case, with or without a region; Unspecified if there is none."""
    names = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.lower(F.regexp_extract(F.coalesce(code, F.lit("")), r"^\s*([A-Za-z]{2})(?:[-_].*)?\s*$", 1))), F.lit(UNSPECIFIED))


def language_code(name: Column) -> Column:
    """The code of a language's name in any case; null if there is none."""
    codes = F.create_map(*[F.lit(x) for k, v in CODES.items() for x in (v.lower(), k)])
    return F.try_element_at(codes, F.lower(F.trim(F.coalesce(name, F.lit("")))))


def stop_words(spark: SparkSession, languages: tuple[str, ...] = WITH_STOP_WORDS) -> DataFrame:
    """lang (code), w: the stop words that Spark carries; a table of one's own with the same columns does as well."""
    from pyspark.ml.feature import StopWordsRemover

    code = {v.lower(): k for k, v in CODES.items()}
    rows = sorted({(code[x], w.lower()) for x in languages for w in StopWordsRemover.loadDefaultStopWords(x)})
    return spark.createDataFrame(rows, "lang string, w string")


def custom_stems(words: DataFrame, col: str, mapping: DataFrame) -> DataFrame:
    """words with a column stem: the first mapping (word, stem, by ord) of each word in lower case, else the word itself."""
    first = mapping.groupBy(F.lower("word").alias("_k")).agg(F.min_by("stem", "ord").alias("_s"))
    return words.join(first, F.lower(F.col(col)) == F.col("_k"), "left").withColumn("stem", F.coalesce("_s", col)).drop("_k", "_s")


def read_custom_stems(spark: SparkSession, path: str) -> DataFrame:
    """word, stem, ord of a tab-separated file; lines without both are left out, earlier lines go first."""
    x = spark.read.csv(path, sep="\t", schema="word string, stem string").withColumn("ord", F.monotonically_increasing_id())
    return x.where("word is not null and stem is not null")


@functools.cache
def _starts() -> list[int]:
    return [s for s, _ in RANGES]


def range_of(c: str) -> str:
    return RANGES[bisect.bisect_right(_starts(), ord(c)) - 1][1]


def _dominant(texts: pd.Series) -> pd.Series:
    out = []
    memo: dict[str, str] = {}
    for t in texts:
        n: dict[str, int] = {}
        for c in t or "":
            r = memo.get(c) or memo.setdefault(c, range_of(c))
            n[r] = n.get(r, 0) + 1
        out.append(min(n, key=lambda k: (-n[k], k)) if n else "Other")
    return pd.Series(out, dtype=object)


def dominant_range(text: Column) -> Column:
    """The Unicode range most characters of a text lie in (ties by name); Other for null and empty texts."""
    return F.pandas_udf(_dominant, StringType())(text)
