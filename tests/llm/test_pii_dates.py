"""Dates as a permutation of their written forms, recomputed in plain Python; very long texts without spaces."""

import calendar
import hashlib
import time
from datetime import date, timedelta

from pyspark.sql import functions as F

from touchline.llm import pii

FIRST = date(1800, 1, 1)


def feistel(left, right, left_size, right_size, key, form):
    for i in range(8):
        other = left if i % 2 else right
        noise = int(hashlib.sha256(f"{key}|{form}|{i}|{other}".encode()).hexdigest()[:13], 16)
        if i % 2:
            right = (right + noise) % right_size
        else:
            left = (left + noise) % left_size
    return left, right


def plain(value, key):
    """Pseudonym of a date with slashes."""
    a, b, year = map(int, value.split("/"))
    if a <= 12 and 1 <= b <= calendar.monthrange(year, a)[1]:
        at = (date(year, a, b) - FIRST).days
        week, day = feistel(at // 773, at % 773, 189, 773, key, "date")
        return (FIRST + timedelta(week * 773 + day)).strftime("%m/%d/%Y")
    at = LATE.index(date(year, b, a))
    week, day = feistel(at // 9833, at % 9833, 9, 9833, key, "late date")
    return LATE[week * 9833 + day].strftime("%d/%m/%Y")


LATE = [d for d in (FIRST + timedelta(i) for i in range(146_097)) if d.day > 12]


def test_slash_dates_are_permuted(spark):
    assert len(LATE) == 9 * 9833
    days = spark.range(365 * 40).select(F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    written = days.select(F.explode(F.array(F.date_format("d", "MM/dd/yyyy"), F.date_format("d", "dd/MM/yyyy"))).alias("v")).distinct()
    found = {r["v"]: r["p"] for r in written.select("v", pii.date(F.col("v"), "k").alias("p")).collect()}
    assert len(set(found.values())) == len(found) > 20_000 and None not in found.values()
    for v in list(found)[::97]:
        assert found[v] == plain(v, "k")


def test_all_late_days_are_permuted(spark):
    days = spark.range(146_097).select(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("d")).where("day(d) > 12")
    images = days.select(pii.date(F.date_format("d", "dd/MM/yyyy"), "k").alias("p")).distinct()
    assert images.where("p is not null").count() == len(LATE)


def test_long_texts_without_spaces(spark):
    letters, domain = "a" * 1_000_000, "a@" + "b." * 200_000 + "org"
    rows = [(1, letters), (2, letters + "@x.org"), (3, "@" * 100_000), (4, domain), (5, "7" * 300_000 + "@")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    found = {r["doc_id"]: r["text"] for r in pii.pseudonymise(frame).collect()}
    assert time.time() - start < 60
    assert found[1] == rows[0][1] and found[2] != rows[1][1] and found[2].endswith("@x.org") and found[3] == rows[2][1] and found[5] == rows[4][1]
