"""Column helpers against hand-computed and Python-computed values."""

import datetime as dt

from pyspark.sql import functions as F

from staffline.functions import (dn_group, full_name_with_initial, iso_duration_minutes, looks_like_person,
                                 manager_cn, name_last_first, primary_email, round2, strip_lower,
                                 title_case, tsql_concat, year_fraction)


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_duration_minutes(spark):
    cases = {"PT8H12M": 492, "PT45M": 45, "PT8H": 480, "PT": 0, "x": 0, "PT7.5H": 0, None: 0, "PT1H30M15S": 90}
    got = _one(spark, iso_duration_minutes("d"), [(k,) for k in cases], "d string")
    assert got == list(cases.values())


def test_title_case_matches_python(spark):
    samples = ["  smith-jones ", "o'neil", "MACHINERY name12", "élodie du-pont", "a_b c3d", "x", ""]
    got = _one(spark, title_case("s"), [(s,) for s in samples], "s string")
    assert got == [s.strip().title() for s in samples]
    assert _one(spark, title_case("s"), [(None,)], "s string") == [None]


def test_strip_lower_removes_all_whitespace(spark):
    assert _one(spark, strip_lower("s"), [(" \tA.B@X.ORG\n",)], "s string") == ["a.b@x.org"]


def test_primary_email(spark):
    rows = [(["smtp:alias@x.org", "SMTP:Primary@Example.org"],), (["smtp:a@x"],), (None,), ([],)]
    got = _one(spark, primary_email("p"), rows, "p array<string>")
    assert got == ["primary@example.org", None, None, None]


def test_dn_group_and_manager(spark):
    dn = "CN=x,OU=Nurses,OU=Staff,OU=Users,DC=org,DC=local"
    assert _one(spark, dn_group("d", 5), [(dn,)], "d string") == ["Nurses"]
    assert _one(spark, dn_group("d", 9), [(dn,)], "d string") == [None]  # too few parts
    got = _one(spark, manager_cn("m"), [("CN=Boss One,OU=x",), (None,), ("OU=x",)], "m string")
    assert got == ["Boss One", None, None]


def test_name_split(spark):
    df = spark.createDataFrame([("SMITH, JANE ",), ("NOCOMMA",)], "n string")
    first, last = name_last_first("n")
    assert [tuple(r) for r in df.select(first, last).collect()] == [("jane", "smith"), (None, None)]


def test_concat_variants(spark):
    df = spark.createDataFrame([("A", None, "C"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(tsql_concat("a", F.lit(" "), "b", F.lit(" "), "c")).collect()] == ["A  C", "  "]
    assert [r[0] for r in df.select(full_name_with_initial("a", "b", "c")).collect()] == ["A C", ""]


def test_person_name_predicate(spark):
    got = _one(spark, looks_like_person("c"), [("Ann Lee",), ("Ann2 Lee",), ("Ann",), (None,)], "c string")
    assert got == [True, False, False, None]


def test_round2_half_up_on_decimal(spark):
    got = _one(spark, round2(F.col("x")), [(1.005,), (0.125,), (2.675,), (None,)], "x double")
    assert got == [1.01, 0.13, 2.68, None]


def test_year_fraction(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 22), dt.date(2024, 1, 10))], "s date, e date")
    assert abs(df.select(year_fraction("s", "e", 2024)).first()[0] - 10 / 20) < 1e-12


def test_title_case_and_strip_property(spark):
    """Spark expressions equal Python on random names (letters incl. accents,
    digits, punctuation, Unicode spaces)."""
    from hypothesis import given, settings, strategies as st
    alphabet = st.sampled_from(list("abcxyzABCXYZéÉñÑøÖ0129 -'._,\t  \x1c"))
    samples = []

    @settings(max_examples=300, database=None, derandomize=True)
    @given(st.text(alphabet=alphabet, max_size=12))
    def collect(s):
        samples.append(s)

    collect()
    got = spark.createDataFrame([(s,) for s in samples], "s string") \
        .select(title_case("s").alias("t"), strip_lower("s").alias("l")).collect()
    for s, r in zip(samples, got):
        assert r.t == s.strip().title(), (s, r.t)
        assert r.l == s.strip().lower(), (s, r.l)
