"""Readers, zones and defined results of timestamp normalisation."""

from datetime import UTC, datetime, timedelta

import pytest

from lexiloom.operators import timestamps as T


def us(*a, micro=0):
    return int(datetime(*a, tzinfo=UTC).timestamp()) * 1_000_000 + micro


@pytest.mark.parametrize(
    ("text", "order", "zone", "want"),
    [
        ("2019-01-11T21:19:30+1100", "DMY", "UTC", us(2019, 1, 11, 10, 19, 30)),
        ("2019-01-30 20:08:20.491Z", "DMY", "UTC", us(2019, 1, 30, 20, 8, 20, micro=491_000)),
        ("20190124T213744Z", "DMY", "UTC", us(2019, 1, 24, 21, 37, 44)),
        ("1546601468222", "DMY", "UTC", 1_546_601_468_222_000),
        ("1548187180.0", "DMY", "UTC", 1_548_187_180_000_000),
        ("Sun, 21 Nov 21 05:27:46 +0530", "DMY", "UTC", us(2021, 11, 20, 23, 57, 46)),
        ("Wed, 13 Feb 2019 18:39:43 GMT", "DMY", "Europe/Rome", us(2019, 2, 13, 18, 39, 43)),
        ("03 Jul 2019 10:00:00 EST", "DMY", "Australia/Sydney", us(2019, 7, 3, 0)),
        ("03 Jul 2019 10:00:00 EST", "MDY", "America/New_York", us(2019, 7, 3, 15)),
        ("2023-07-13 07:02:52 America/New_York", "DMY", "UTC", us(2023, 7, 13, 11, 2, 52)),
        ("2019-02-24T23:34:07[Europe/Berlin]", "DMY", "UTC", us(2019, 2, 24, 22, 34, 7)),
    ],
)
def test_fixed_values(text, order, zone, want):
    assert T.read_stamp(text, order, zone)[1] == want


@pytest.mark.parametrize(
    ("text", "order", "zone", "want"),
    [
        ("04/01/2019 14:13", "DMY", "UTC", us(2019, 1, 4, 14, 13)),
        ("04/01/2019 14:13", "MDY", "UTC", us(2019, 4, 1, 14, 13)),
        ("22. 1. 2019 3:31", "DMY", "Europe/Ljubljana", us(2019, 1, 22, 2, 31)),
        ("24. února 2019 00:54", "DMY", "Europe/Prague", us(2019, 2, 23, 23, 54)),
        ("10 de febrero de 2019 22:06", "DMY", "Europe/Madrid", us(2019, 2, 10, 21, 6)),
        ("June 25, 2019 4:52 p.m.", "MDY", "America/New_York", us(2019, 6, 25, 20, 52)),
        ("2/11/2019 12:36:44 AM", "MDY", "UTC", us(2019, 2, 11, 0, 36, 44)),
        ("2019-10-27 02:11:54", "DMY", "Europe/Berlin", None),
        ("2019-03-31 02:11:54", "DMY", "Europe/Berlin", None),
    ],
)
def test_wall_times(text, order, zone, want):
    wall, fixed, named = T.read_stamp(text, order, zone)
    assert fixed is None
    assert named is None
    assert T.to_utc(wall, zone) == want


@pytest.mark.parametrize("text", [None, "", "  ", "n/a", "yesterday", "2019-01-21", "31/11/2020 08:15", "0001-01-01T00:00:00", "2021-02-30 12:00:00", "2019-01-21 10:00 Foo/Bar", "2019-01-21 24:10", "x" * 100_000])
def test_no_moment(text):
    assert T.read_stamp(text, "DMY", "UTC") is None


def test_table(spark):
    sites = spark.createDataFrame([("a", "a.example", "en", "Europe/Berlin", "UTC", "DMY")], "siteid string, domainname string, lang string, tz string, crawltz string, dateorder string")
    at = datetime(2019, 2, 1)
    rows = [
        (1, "a", None, "2019-01-01 12:00", "2019-01-01 12:30", at, "extra"),
        (1, "a", None, "2019-01-01 12:00", "2019-01-01 12:30", at, "extra"),
        (2, None, "WWW.A.example:80", "2019-07-01 12:00", None, at, None),
        (3, None, None, None, None, None, None),
        (4, "zz", None, "2019-01-01 12:00", "2019-01-01T11:30:00Z", at, "x"),
    ]
    docs = spark.createDataFrame(rows, "docid long, siteid string, domainname string, pubdate string, time string, arrived timestamp, key string")
    got = {(r.docid, r.field): r.utc_us for r in T.stamps_utc(docs, sites).collect()}
    assert got[1, "pubdate"] == us(2019, 1, 1, 11)
    assert got[1, "time"] == us(2019, 1, 1, 12, 30)
    assert got[2, "pubdate"] == us(2019, 7, 1, 10)
    assert got[4, "time"] == us(2019, 1, 1, 11, 30)
    assert got[4, "pubdate"] == us(2019, 1, 1, 11)  # the estimate: in UTC it would lie after its fetch
    assert not [k for k in got if k[0] == 3]
    assert T.stamps_utc(docs.where("false"), sites).count() == 0


def test_estimated_zones_match_and_veto(spark):
    zones = ["Europe/Berlin", "America/New_York", "UTC", "Asia/Kolkata"]
    rows, n = [], 0
    for k, zone in enumerate(zones):
        tz = T.zone_of(zone)
        for i in range(60):
            pub = datetime(2019, 1, 3, 6, tzinfo=UTC) + timedelta(days=5 * i, minutes=7 * i)
            read = pub + timedelta(minutes=(3, 9, 40, 200)[i % 4])
            wall = pub.astimezone(tz).strftime("%Y-%m-%d %H:%M") if i % 3 else pub.strftime("%Y-%m-%dT%H:%M:00Z")
            rows.append((n, f"s{k}", None, wall, read.strftime("%Y-%m-%dT%H:%M:00Z"), (read + timedelta(days=9)).replace(tzinfo=None)))
            n += 1
    docs = spark.createDataFrame(rows, "docid long, siteid string, domainname string, pubdate string, time string, arrived timestamp")
    table = lambda tz: spark.createDataFrame([(f"s{k}", f"s{k}.example", tz[k], "UTC", "DMY") for k in range(4)], "siteid string, domainname string, tz string, crawltz string, dateorder string")
    report = {(r.key, r.field): r for r in T.zone_report(docs, table(zones)).collect()}
    assert all(report[f"s{k}", "pubdate"].n_same >= 0.95 * report[f"s{k}", "pubdate"].n_walls for k in range(4))
    right = {tuple(r) for r in T.stamps_utc(docs, table(zones)).collect()}
    wrong = ["America/New_York", *zones[1:3], None]  # six hours off, so nearly all records would be read before they appear; not declared
    sites = table(wrong).unionByName(table(zones).where("siteid = 's3'").withColumn("siteid", T.F.lit("elsewhere")).withColumn("domainname", T.F.lit(None).cast("string")))
    sites = sites.unionByName(sites.where("siteid = 'elsewhere'").select(T.F.lit("more").alias("siteid"), "domainname", T.F.lit("Europe/Berlin").alias("tz"), "crawltz", "dateorder"))
    assert {tuple(r) for r in T.stamps_utc(docs, sites).collect()} == right
