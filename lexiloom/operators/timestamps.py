"""Mixed timestamp formats and zones to one UTC instant.

read_stamp reads one string into a wall time and, if given, its offset or zone. estimate_zones chooses the offset history (an IANA zone)
of a site's wall times without one by aligning them with the record's other stamp, where that has a zone: publication comes before
reading, which comes before arrival. How long each usually takes is learned from records whose stamps both have zones, so a zone an hour
off shows as order violations or as lags nobody has. A declared zone holds unless the order of its records contradicts it; where none is
declared, the estimate decides. to_utc converts. Reading dozens of formats is branching text work, so it runs in Arrow batches; everything
else is joins and small aggregations. Defined results: null, blank, date without time of
day, impossible dates, placeholders and years before 1990 give null, as do wall times that occur twice or never at a clock change.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
import zoneinfo
from collections.abc import Iterator
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import host_key, stored

US = 1_000_000
FIRST_YEAR = 1990

# Month names of ten languages, in calendar order.
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en short": "jan feb mar apr may jun jul aug sep oct nov dec",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
    "sl": "januar februar marec april maj junij julij avgust september oktober november december",
    "sl genitive": "januarja februarja marca aprila maja junija julija avgusta septembra oktobra novembra decembra",
    "cs": "leden únor březen duben květen červen červenec srpen září říjen listopad prosinec",
    "cs genitive": "ledna února března dubna května června července srpna září října listopadu prosince",
    "ru": "январь февраль март апрель май июнь июль август сентябрь октябрь ноябрь декабрь",
    "ru genitive": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
}
# Usual zone abbreviations in minutes from UTC; those that differ by continent follow.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "UCT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "MSD": 240, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "AST": -240, "ADT": -180, "NST": -210, "NDT": -150,
    "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "NZST": 720, "NZDT": 780, "IST": 330, "JST": 540, "KST": 540, "SAST": 120,
}
ABBREVIATIONS_BY_CONTINENT = {"Australia": {"EST": 600, "EDT": 660, "CST": 570, "CDT": 630, "WST": 480}, "Europe": {"IST": 60, "BST": 60}, "Asia": {"IST": 330, "BST": 360, "CST": 480}}

_TIME = r"(?P<h>\d{1,2})[:.h](?P<mi>\d{2})(?:[:.](?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?)?\s*(?P<half>[ap]\.?\s?m\.?(?![a-z]))?"
_ZONE = r"\s*(?P<zone>\[?(?:[a-z]+(?:_[a-z]+)*(?:/[a-z_+-]+[0-9]*)+|[a-z]{1,5})\]?|[+-]\d{2}(?::?\d{2})?)?"
_NAME = r"(?P<name>[^\W\d_]{3,12})\.?"
_YEAR = r"(?P<y>\d{4}|\d{2})"
_FORMS = tuple(
    re.compile(f, re.IGNORECASE)
    for f in (
        rf"(?P<y>\d{{4}})[-/.](?P<m>\d{{1,2}})[-/.](?P<d>\d{{1,2}})(?:t|\s+){_TIME}{_ZONE}",
        rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})t?(?P<h>\d{{2}})(?P<mi>\d{{2}})(?P<s>\d{{2}})?(?:[.,](?P<f>\d{{1,9}}))?{_ZONE}",
        rf"(?P<a>\d{{1,2}})[./-]\s?(?P<b>\d{{1,2}})[./-]\s?{_YEAR},?\s+{_TIME}{_ZONE}",
        rf"(?:[^\W\d_]+\.?,?\s+)?(?P<d>\d{{1,2}})(?:\.|st|nd|rd|th)?[\s-]+(?:de\s+)?{_NAME}[\s-]+(?:de\s+)?{_YEAR},?\s+(?:[^\W\d_]{{1,3}}\s+)?{_TIME}{_ZONE}",
        rf"(?:[^\W\d_]+\.?,\s+)?{_NAME}\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+{_YEAR},?\s+(?:at\s+)?{_TIME}{_ZONE}",
    )
)
_EPOCH = re.compile(r"(\d{9,10})(?:[.,](\d{1,9}))?|(\d{12,13})|(\d{15,16})")
_BASE = datetime(1970, 1, 1)


@functools.cache
def month_numbers() -> dict[str, int]:
    """Month names in lower case to 1..12."""
    out: dict[str, int] = {"sept": 9}
    for names in MONTHS.values():
        for i, name in enumerate(names.split(), 1):
            out.setdefault(name, i)
    return out


@functools.cache
def zone_of(name: str) -> zoneinfo.ZoneInfo | None:
    """The zone of a name, None if there is none."""
    try:
        return zoneinfo.ZoneInfo(name)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None


def to_utc(wall_us: int | None, zone: str | None) -> int | None:
    """Microseconds since 1970 UTC of a wall time in a zone; None where it occurs twice or never, or either is missing."""
    tz = zone_of(zone) if zone else None
    if wall_us is None or tz is None:
        return None
    wall = _BASE + timedelta(microseconds=wall_us)
    o1, o2 = wall.replace(tzinfo=tz).utcoffset(), wall.replace(tzinfo=tz, fold=1).utcoffset()
    return wall_us - round(o1.total_seconds()) * US if o1 == o2 else None


def read_stamp(text: str | None, order: str | None, zone: str | None) -> tuple[int | None, int | None, str | None] | None:
    """(wall time, instant if the value fixes it, its zone name) in microseconds, or None if it denotes no moment.

    order: DMY or MDY, for days and months in digits; zone: the site's or machine's zone, whose continent settles abbreviations.
    """
    v = " ".join(text.split()) if text else ""
    if not v or not v[0].isalnum():
        return None
    if e := _EPOCH.fullmatch(v):
        us = int(e[1]) * US + int((e[2] or "0").ljust(6, "0")[:6]) if e[1] else int(e[3]) * 1000 if e[3] else int(e[4])
        return (None, us, None) if us >= 631_152_000 * US else None
    for form in _FORMS:
        if m := form.fullmatch(v):
            break
    else:
        return None
    g = m.groupdict()
    y = int(g["y"]) + (2000 if len(g["y"]) == 2 else 0)
    if "a" in g:
        mo, d = (int(g["a"]), int(g["b"])) if (order or "").upper() == "MDY" else (int(g["b"]), int(g["a"]))
    else:
        mo, d = int(g["m"]) if "m" in g else month_numbers().get(g["name"].lower(), 0), int(g["d"])
    h, mi, s = int(g["h"]), int(g["mi"]), int(g["s"] or 0)
    if half := g.get("half"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if half[0] in "pP" else 0)
    if y < FIRST_YEAR or h > 23 or mi > 59 or s > 59:
        return None
    try:
        day = date(y, mo, d).toordinal() - 719_163
    except ValueError:
        return None
    wall = ((day * 24 + h) * 60 + mi) * 60 * US + s * US + int((g["f"] or "0").ljust(6, "0")[:6])
    z = (g["zone"] or "").strip("[]")
    if not z:
        return wall, None, None
    if z[0] in "+-":
        minutes = int(z[1:3]) * 60 + int(z[3:].lstrip(":") or 0)
        return wall, wall - (minutes if z[0] == "+" else -minutes) * 60 * US, None
    if "/" in z:
        return (wall, to_utc(wall, z), z) if zone_of(z) else None
    z = z.upper()
    minutes = ABBREVIATIONS_BY_CONTINENT.get((zone or "").partition("/")[0], {}).get(z, ABBREVIATIONS.get(z))
    return None if minutes is None else (wall, wall - minutes * 60 * US, None)


_LONG = "docid long, key string, field string, wall_us long, utc_us long, declared string, zoneless boolean, other_us long, arrived_us long"
_KINDS = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64())


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[] for _ in _KINDS]
        for docid, key, tz, crawl, order, arrived, pubdate, time in zip(*(c.to_pylist() for c in b.columns), strict=True):
            p, t = read_stamp(pubdate, order, tz), read_stamp(time, order, crawl)
            for field, x, zone, other in (("pubdate", p, tz, t and t[1]), ("time", t, crawl, p and p[1])):
                if x:
                    wall, us, named = x
                    if us is None and named is not None:
                        continue  # a named zone in which the wall time occurs twice or never
                    zoneless = us is None
                    if zoneless and zone:
                        us = to_utc(wall, zone)
                    for column, value in zip(out, (docid, key, field, wall, us, zone, zoneless, other, arrived), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _KINDS, strict=True)], [x.split()[0] for x in _LONG.split(", ")])


def normalise_stamps(records: DataFrame, sites: DataFrame) -> DataFrame:
    """The stamps of records in long form: docid, key, field, wall_us, utc_us, declared (zone), zoneless, other_us, arrived_us.

    records: docid, siteid, domainname, pubdate, time, arrived. other_us is the record's other stamp if it fixes its instant itself. utc_us is null where the zone of a wall time isn't declared in sites,
    or the wall time is ambiguous there. key is the record's site (siteid, else the site of its host, else the host).
    """
    s = sites.select(F.col("siteid").alias("key"), host_key(F.col("domainname")).alias("s_host"), "tz", "crawltz", "dateorder").dropDuplicates(["key"])
    by_host = s.where("s_host is not null").groupBy("s_host").agg(F.min("key").alias("h_key"))
    r = records.select("docid", "siteid", host_key(F.col("domainname")).alias("host"), "pubdate", "time", F.unix_micros(F.col("arrived").cast("timestamp")).alias("arrived_us")).distinct()
    r = r.join(by_host, r.host == by_host.s_host, "left").join(s.select(F.col("key").alias("k1")), F.col("siteid") == F.col("k1"), "left")
    r = r.withColumn("key", F.coalesce("k1", "h_key", "siteid", "host")).drop("s_host")
    r = r.join(s.select("key", "tz", "crawltz", "dateorder"), "key", "left")
    return r.select("docid", "key", "tz", "crawltz", "dateorder", "arrived_us", "pubdate", "time").mapInArrow(_read_batches, _LONG)


def zone_pool(sites: DataFrame) -> list[str]:
    """The distinct zones of a site table: the candidates of the estimate, at most the few hundred zones there are."""
    return sorted(r[0] for r in sites.select(F.explode(F.array("tz", "crawltz")).alias("zone")).where("zone is not null").distinct().collect())


#: Borders of the lag classes in minutes; a lag below the first is an order violation.
LAGS = (-2, 5, 15, 30, 45, 60, 75, 90, 105, 120, 150, 180, 240, 360, 720, 1440)
#: A declared zone gives way where at least so many aligned wall times are in disorder under it, most of them, and nearly none under another.
VETO = 20


def lag_weights(long: DataFrame) -> list[float]:
    """Log probabilities of the classes of the lag between publication and reading, from the records whose stamps both have zones."""
    lag = (F.col("other_us") - F.col("utc_us")) / (60 * US)
    x = long.where("field = 'pubdate' and not zoneless and other_us is not null and utc_us is not null")
    c = F.size(F.filter(F.array(*[F.lit(float(v)) for v in LAGS]), lambda v: v <= lag)).alias("c")
    n = {r["c"]: r["n"] for r in x.groupBy(c).agg(F.count("*").alias("n")).collect()}
    total = sum(v for k, v in n.items() if k) + len(LAGS)
    return [math.log(1e-4), *(math.log((n.get(k, 0) + 1.0) / total) for k in range(1, len(LAGS) + 1))]


def estimate_zones(long: DataFrame, zones: list[str], weights: list[float]) -> DataFrame:
    """The fit of every candidate zone to the zoneless wall times of each key and field: key, field, zone, n_walls, n_aligned, violations, misfit.

    n_aligned: wall times whose record's other stamp has a zone; the others are held against arrival only. violations: order
    violations. misfit: minus the log probability of the lags. Each batch sends sums per key and zone only.
    """
    schema = "key string, field string, zone string, n long, aligned long, bad long, misfit double"

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple, list] = {}
            for key, field, wall, other, arrived in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for zone in zones:
                    u = to_utc(wall, zone)
                    if u is not None:
                        x = sums.setdefault((key, field, zone), [0, 0, 0, 0.0])
                        late = arrived is not None and u > arrived
                        c = len(LAGS)
                        if other is not None:
                            c = bisect.bisect_right(LAGS, ((other - u) if field == "pubdate" else (u - other)) / (60 * US))
                            x[1] += 1
                            x[3] -= weights[c]
                        x[0] += 1
                        x[2] += late or c == 0
                        x[3] -= weights[0] if late else 0.0
            rows = [(*k, *x) for k, x in sums.items()]
            cols = list(zip(*rows, strict=True)) or [[] for _ in range(7)]
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    parts = long.where("zoneless and key is not null").select("key", "field", "wall_us", "other_us", "arrived_us").mapInArrow(fit, schema)
    return parts.groupBy("key", "field", "zone").agg(F.sum("n").alias("n_walls"), F.sum("aligned").alias("n_aligned"), F.sum("bad").alias("violations"), F.round(F.sum("misfit"), 6).alias("misfit"))


def chosen_zones(fits: DataFrame) -> DataFrame:
    """key, field, zone, n_walls, n_aligned, violations, misfit of the zone with the least misfit; ties go to the name."""
    best = F.min_by(F.struct("zone", "n_walls", "n_aligned", "violations", "misfit"), F.struct("misfit", "zone")).alias("best")
    return fits.groupBy("key", "field").agg(best).select("key", "field", "best.*")


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docid, field, wall, zone = (c.to_pylist() for c in b.columns)
        us = [to_utc(w, z) for w, z in zip(wall, zone, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(docid, pa.int64()), pa.array(field, pa.string()), pa.array(us, pa.int64())], ["docid", "field", "utc_us"])


def declared_zones(sites: DataFrame) -> DataFrame:
    """key, field, declared."""
    return sites.select(F.col("siteid").alias("key"), F.explode(F.create_map(F.lit("pubdate"), "tz", F.lit("time"), "crawltz")).alias("field", "declared")).dropDuplicates(["key", "field"])


def stamps_utc(records: DataFrame, sites: DataFrame) -> DataFrame:
    """docid, field, utc_us: each stamp that denotes one instant, once. Repeated rows of a record give one row.

    A wall time without zone takes the zone declared for its site, unless the order of at least VETO of its records contradicts that
    zone and not the estimated one; where none is declared, the one estimate_zones chooses among all declared zones.
    """
    long = stored(normalise_stamps(records, sites), "stamps")
    fits = stored(estimate_zones(long, zone_pool(sites), lag_weights(long)), "fits")
    best = chosen_zones(fits)
    told = declared_zones(sites).join(fits.select("key", "field", F.col("zone").alias("declared"), F.col("n_aligned").alias("n"), F.col("violations").alias("bad")), ["key", "field", "declared"])
    wrong = best.join(told, ["key", "field"], "left").where(F.col("n").isNull() | ((F.col("n_aligned") >= VETO) & (F.col("bad") * 2 > F.col("n_walls")) & (F.col("violations") * 10 < F.col("n_walls"))))
    wrong = wrong.join(declared_zones(sites).where("declared is not null").select("key", "field", F.lit(True).alias("is_told")), ["key", "field"], "left").where("is_told is null or n is not null")
    wrong = stored(wrong.select("key", "field", F.col("zone").alias("guess")), "zones")  # a row for a site without a zone that holds
    open_ = long.where("zoneless").join(wrong, ["key", "field"])
    guessed = open_.select("docid", "field", "wall_us", "guess").mapInArrow(_convert, "docid long, field string, utc_us long")
    sure = long.join(wrong.withColumn("zoneless", F.lit(True)), ["key", "field", "zoneless"], "left_anti").select("docid", "field", "utc_us")
    return sure.unionByName(guessed).where("utc_us is not null").distinct()


def zone_report(records: DataFrame, sites: DataFrame) -> DataFrame:
    """key, field, zone, n_walls, n_aligned, violations, misfit, declared, n_same: what the estimate alone chooses, beside the declared zone.

    Uses the wall times that carry no zone themselves, as if none were declared. n_same: how many of them both zones turn into the
    same instant; zones of one offset history differ in name only.
    """
    plain = sites.select("siteid", "domainname", F.lit(None).cast("string").alias("tz"), F.lit(None).cast("string").alias("crawltz"), "dateorder")
    long = stored(normalise_stamps(records, plain), "stamps")
    best = stored(chosen_zones(estimate_zones(long, zone_pool(sites), lag_weights(long))).join(declared_zones(sites), ["key", "field"], "left"), "zones")
    schema = "key string, field string, same int"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, field, wall, zone, told = (c.to_pylist() for c in b.columns)
            same = [int(to_utc(w, z) == to_utc(w, t)) for w, z, t in zip(wall, zone, told, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(field, pa.string()), pa.array(same, pa.int32())], ["key", "field", "same"])

    walls = long.where("zoneless").join(best.where("declared is not null").select("key", "field", "zone", F.col("declared").alias("told")), ["key", "field"])
    same = walls.select("key", "field", "wall_us", "zone", "told").mapInArrow(compare, schema).groupBy("key", "field").agg(F.sum("same").alias("n_same"))
    return best.join(same, ["key", "field"], "left")
