import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions import dates, numeric, student_t, text


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict()


def test_code_prefix_and_its_quirk(spark):
    got = one(
        spark,
        a=text.strip_code_prefix(F.lit("397 - CHOC")),
        b=text.strip_code_prefix(F.lit("CHOC")),
        c=text.strip_code_prefix(F.lit("CHOC"), only_if_prefixed=True),
        d=text.sanitize_key(F.lit("A&B 0.19kg/x")),
        e=text.safe_file_name(F.lit('a/b:c*d?"e')),
    )
    assert got == {"a": "CHOC", "b": "HOC", "c": "CHOC", "d": "AB 019kgx", "e": "a_b_c_d__e"}


def test_local_date_follows_daylight_saving(spark):
    def at(value):
        return dates.local_date(F.lit(value).cast("timestamp_ntz"))

    got = one(spark, summer=at("2024-01-01 13:30:00"), winter=at("2024-07-01 13:30:00"))
    assert got == {"summer": dt.date(2024, 1, 2), "winter": dt.date(2024, 7, 1)}


def test_range_is_whole_days_at_the_offset(spark):
    def inside(value):
        return dates.in_local_range(F.lit(value).cast("timestamp_ntz"), "2024-01-01", "2024-03-31")

    got = one(
        spark,
        first=inside("2023-12-31 13:00:00"),
        before=inside("2023-12-31 12:59:59"),
        last=inside("2024-03-31 12:59:59"),
        after=inside("2024-03-31 13:00:00"),
    )
    assert got == {"first": True, "before": False, "last": True, "after": False}


def test_weeks_start_on_wednesday(spark):
    for day, start in [("2024-07-03", "2024-07-03"), ("2024-07-02", "2024-06-26"), ("2024-07-09", "2024-07-03")]:
        assert one(spark, w=dates.week_start(F.lit(day).cast("date")))["w"].isoformat() == start


def test_tolerant_number(spark):
    cases = {"1.5": 1.5, " -2 ": -2.0, "n/a": None, "": None, "1.5d": None, "inf": None, "1e3": 1000.0}
    for raw, value in cases.items():
        assert one(spark, x=numeric.tolerant_number(F.lit(raw)))["x"] == value


def test_bands_and_clamp(spark):
    bands = {0.0: "Low", 0.3: "Low", 0.31: "Medium", 0.8: "Medium", 0.81: "High", 1.0: "High", 1.1: "No_R-Square"}
    for r2, band in bands.items():
        assert one(spark, b=numeric.r2_band(F.lit(r2)))["b"] == band
    nothing = F.lit(None).cast("double")
    assert one(spark, a=numeric.r2_band(nothing), b=numeric.clamp_negative(nothing)) == {"a": "No_R-Square", "b": None}


@pytest.mark.parametrize("nu,t,p", [(1, 12.706, 0.05), (2, 4.303, 0.05), (10, 2.228, 0.05), (7, 3.499, 0.01), (60, 2.0, 0.05), (101, 1.984, 0.05)])
def test_student_t_against_tables(spark, nu, t, p):
    got = one(spark, p=student_t.two_sided_p(F.lit(t), F.lit(nu)))["p"]
    assert math.isclose(got, p, abs_tol=2e-4)
    assert math.isclose(got, student_t.two_sided_p_array(np.array([t]), nu)[0], abs_tol=1e-12)
