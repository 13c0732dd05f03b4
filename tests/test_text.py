from datetime import datetime

from pyspark.sql import functions as F

from equifacts.functions import text as t


def test_parse_number(values):
    cases = {
        "757446.62": 757446.62, "70,698.00": 70698.0, "--": None, "-": None, None: None,
        "": None, "N.A.": None, "abc": None, "5.25%": 5.25, "Rs. 1,234.50 Cr": 1234.5,
        "1d": None, "1_000": None, "nan": None, "(12)": None, "₹ 1,00,000": 100000.0,
        "1&nbsp;234": 1234.0, ".5": 0.5, "5.": 5.0, "-3e2": -300.0, ".": None, "inf": None,
    }
    assert values(t.parse_number, list(cases)) == list(cases.values())


def test_clean_text(values):
    cases = {
        "  a \n\t b  ": "a b", "Tata&nbsp;Consultancy &amp; Co": "Tata Consultancy & Co",
        "": None, "-": None, "--": None, "N.A.": None, "null": None, "NA": None, "None": None,
        None: None, "n.a.": "n.a.", "a\x1cb\x85c d": "a b c d", "&lt;b&gt;": "<b>",
        "&amp;amp;": "&amp;", "&notanentity": "¬anentity", "&#8377;5": "₹5", "&nbsp;": None,
    }
    assert values(t.clean_text, list(cases)) == list(cases.values())


def test_period_parts(values):
    cases = {
        "Mar '26": (2026, 3), "Dec '25": (2025, 12), "Mar 2024": (2024, 3), None: (0, 0),
        "???": (0, 0), "Foo '26": (2026, 0), "Mar1999": (2099, 3), "  March '26 ": (2026, 3),
        "": (0, 0), "Ma '26": (0, 0), "Mar 126": (126, 3),
    }
    got = values(lambda c: F.struct(t.period_year(c), t.period_month(c)), list(cases))
    assert [tuple(g) for g in got] == list(cases.values())


def test_parse_stamp(values):
    got = values(t.parse_stamp, ["2026-07-04 10:30:00", "not-a-date", None, "2026-13-01 00:00:00"])
    assert got == [datetime(2026, 7, 4, 10, 30), None, None, None]


def test_in_list(values):
    industry = lambda c: t.in_list(c, ["Information Technology"])
    texts = ["Information Technology", "  information technology ", "Financial Services", None, ""]
    assert values(industry, texts) == [True, True, False, False, False]
    sector = lambda c: t.in_list(c, ["Software & IT Services"])
    assert values(sector, ["Software & IT Services", "Metals & Mining"]) == [True, False]


def test_first_text_skips_empty(spark):
    df = spark.createDataFrame([("", "b"), (None, None), ("a", "b")], "x string, y string")
    got = [r.v for r in df.select(t.first_text(df.x, df.y).alias("v")).collect()]
    assert got == ["b", None, "a"]


def test_display_tokens(values):
    got = values(t.display_tokens, ["Name&nbsp;<span>INE1, COFORGE, 532541</span>"])
    assert got == [["Name&nbsp;", "INE1", "COFORGE", "532541", ""]]


def test_url_part(values):
    assert values(t.url_part, ["M&M", "A B", "a/b", "x~y*"]) == ["M%26M", "A%20B", "a/b", "x~y%2A"]


def test_age_days(spark):
    row = spark.sql("select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-31 12:00:00' b")
    assert row.select(t.age_days(row.a, row.b).alias("v")).first().v == 30.5


def test_unescape_each(spark):
    df = spark.createDataFrame([(["a &amp; b", None],), (["x"],), (None,)], "a array<string>")
    got = [r.v for r in df.select(t.unescape_each(df.a).alias("v")).collect()]
    assert got == [["a & b", None], ["x"], None]
