"""Text, date and JSON functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressroom.functions import text


def test_clean_text(values):
    cases = {"  a \n b\t": "a b", "a  b": "a b", "": None, "   ": None, None: None, "x": "x", "a\x1cb": "a b"}
    assert values(text.clean_text, list(cases)) == list(cases.values())


def test_word_count(values):
    assert values(text.word_count, ["a b  c", "", None, " x "]) == [3, 0, 0, 1]


def test_content_length_counts_code_points(values):
    assert values(text.content_length, ["ữ", "𝄞a", None]) == [1, 2, 0]


def test_strip_html(values):
    cases = {
        "<p>hi <b>x</b></p>": "hi x", "<img src='a>b'>t": "t", "a &amp;lt; b": "a &lt; b", "&#233;&#x41;&nbsp;z": "éA z",
        "<script>var a = '<p>';</script>ok<style>p{}</style>": "ok", "1 < 2": "1 < 2", "<!-- c -->d": "d", "&#1114112;": "�", "&#0;x": "�x", "": None,
    }
    assert values(text.strip_html, list(cases)) == list(cases.values())


@pytest.mark.parametrize("raw, expected", [
    ("2026-08-30T05:58:00.000 +07:00", "2026-08-29 22:58:00"), ("Thứ năm, 3/9/2026, 06:52 (GMT+7)", "2026-09-02 23:52:00"),
    ("2026-08-26T08:30:00+07:00", "2026-08-26 01:30:00"), ("Wed, 02 Oct 2002 13:00:00 GMT", "2002-10-02 13:00:00"),
    ("Wed, 02 Oct 2002 13:00:00 +0700", "2002-10-02 06:00:00"), ("2 Oct 2002 13:00 EST", "2002-10-02 18:00:00"), ("2024-01-01", "2024-01-01 00:00:00"),
    ("Wednesday, 2 October 2002 13:00:00 Z", "2002-10-02 13:00:00"), ("3/9/2026 16:00 (GMT+7)", "2026-09-03 09:00:00"),
    ("32 Oct 2002 13:00 EST", None), ("junk", None), ("", None), (None, None)])
def test_published_at(values, raw, expected):
    got = values(text.parse_published_at, [raw])[0]
    assert got == (dt.datetime.fromisoformat(expected) if expected else None)


def test_iso_timestamp(spark):
    rows = spark.sql("select explode(array(timestamp '2024-01-02 03:04:05', timestamp '2024-01-02 03:04:05.000678')) as t").select(
        text.iso_timestamp("t").alias("x")).collect()
    assert [r.x for r in rows] == ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.000678+00:00"]


def test_nested_get_takes_object_keys_only(spark):
    doc = '{"a": {"b": {"c": 1}, "l": [10]}, "d.e": 2}'
    df = spark.createDataFrame([(doc,)], "j string").select(F.parse_json("j").alias("v"))

    def read(path):
        return F.try_variant_get(text.nested_get(F.col("v"), path), "$", "string")

    row = df.select(read("a.b.c"), read("a.x"), read("a.b.c.d"), read("")).first()
    assert tuple(row) == ("1", None, None, None)
