"""Scalar functions and driver-side distributions on micro fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from subpanel.functions.distributions import betainc, f_sf, t_ppf, t_sf2
from subpanel.functions.hashing import u
from subpanel.functions.scalar import (parse_mixed_date, risk_band, safe_ratio,
                                       silhouette_verdict, slug, wilson)


def test_wilson_interval(spark):
    df = spark.createDataFrame([(10, 36), (0, 5), (0, 0)], "k int, n int")
    rows = df.select(wilson("k", "n").alias("w")).collect()
    lo, hi = rows[0]["w"]["low"], rows[0]["w"]["high"]
    assert lo == pytest.approx(0.158, abs=1e-3) and hi == pytest.approx(0.440, abs=1e-3)
    assert rows[1]["w"]["low"] == 0.0
    assert (rows[2]["w"]["low"], rows[2]["w"]["high"]) == (0.0, 0.0)


def test_mixed_date_formats(spark):
    df = spark.createDataFrame([("2024-04-03",), ("03/04/2024",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_mixed_date("s")).collect()]
    assert got == [dt.date(2024, 4, 3), dt.date(2024, 4, 3), None, None]


def test_risk_bands_and_verdicts(spark):
    df = spark.createDataFrame([(0.6,), (0.3,), (0.29,)], "p double")
    assert [r[0] for r in df.select(risk_band("p")).collect()] == ["High", "Medium", "Low"]
    v = spark.createDataFrame([(0.8,), (0.1,)], "s double").select(silhouette_verdict("s")).collect()
    assert [r[0] for r in v] == ["strong structure", "no substantial structure"]


def test_seat_guard_and_slug(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "u double, s int")
    assert [r[0] for r in df.select(safe_ratio("u", "s")).collect()] == [10.0, 2.5]
    s = spark.createDataFrame([("Café Müller & Co.",)], "t string").select(slug("t")).collect()[0][0]
    assert s == "cafe-muller-co"


def test_hash_uniform_matches_reference_formula(spark):
    import hashlib
    v = spark.range(1).select(u("m", F.lit(12345)).alias("u")).collect()[0]["u"]
    expect = int(hashlib.md5(b"m-12345").hexdigest()[:8], 16) / 2 ** 32
    assert v == expect


def test_distributions():
    assert t_sf2(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert t_ppf(0.975, 10) == pytest.approx(2.228138852, abs=1e-6)
    assert f_sf(3.0, 2, 20) == pytest.approx(0.07260, abs=1e-4)
    assert betainc(2.0, 3.0, 0.4) == pytest.approx(0.5248, abs=1e-4)
    assert math.isnan(t_sf2(float("nan"), 5))
