import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions import calendar as cal
from chronoloom.functions import transforms as tr
from chronoloom.functions.draws import hash32, normal
from chronoloom.functions.special import chi2_tail, level_z, normal_cdf, z_value
from chronoloom.operators import accuracy as acc


@pytest.mark.parametrize("stat,dof,p", [(7.74, 10, 0.6542), (5.75, 7, 0.5692), (16.6, 20, 0.6788), (28.4, 8, 0.000404)])
def test_chi_square_tail(spark, stat, dof, p):
    got = spark.range(1).select(chi2_tail(F.lit(stat), dof).alias("p")).first()[0]
    assert got == pytest.approx(p, rel=2e-3)


def test_normal_cdf_matches_standard_library(spark):
    from statistics import NormalDist
    zs = [-7.0, -3.0, -1.0, -1e-9, 0.0, 0.5, 2.0, 5.9, 7.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in df.select("z", normal_cdf(F.col("z"))).collect():
        assert p == pytest.approx(NormalDist().cdf(z), abs=1e-9)


def test_partial_dates():
    assert cal.partial_date("1970 Q1") == (date(1970, 1, 1), date(1970, 4, 1))
    assert cal.partial_date("2016 Jan") == (date(2016, 1, 1), date(2016, 2, 1))
    assert cal.partial_date("1991 W52") == (date(1991, 12, 23), date(1991, 12, 30))
    assert cal.partial_date("2007") == (date(2007, 1, 1), date(2008, 1, 1))
    with pytest.raises(ValueError):
        cal.partial_date("last week")


@pytest.mark.parametrize("unit", ["year", "quarter", "month", "week", "day", "hour", "30min", "minute"])
def test_period_round_trip(spark, unit):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '1969-12-31 23:40:00', TIMESTAMP_NTZ '2000-02-29 12:34:56', TIMESTAMP_NTZ '2021-01-03 00:00:00')) AS ts")
    t = cal.period_number(F.col("ts"), unit)
    back = cal.period_number(cal.period_start(t, unit), unit)
    start = cal.period_start(t, unit)
    for a, b, ok in df.select(t, back, start.cast("timestamp_ntz") <= F.col("ts")).collect():
        assert a == b and ok


def test_horizons():
    assert cal.horizon("3 years", "month") == 36
    assert cal.horizon("2 weeks", "day") == 14
    assert cal.horizon(None, "quarter") == 8
    assert cal.horizon(None, "int", 1) == 10


def test_transforms_invert_and_curve(spark):
    df = spark.createDataFrame([(0.7,), (3.0,), (9.5,)], "y double")
    for f in (tr.log, tr.sqrt, tr.box_cox_transform(0.3), tr.box_cox_transform(0), tr.scaled_logit(0, 10)):
        w = f.forward(F.col("y"))
        eps = 1e-4
        second = (f.inverse(w + eps) - 2 * f.inverse(w) + f.inverse(w - eps)) / eps ** 2
        for y, back, c, num in df.select("y", f.inverse(w), f.curvature(w), second).collect():
            assert back == pytest.approx(y, rel=1e-9)
            assert c == pytest.approx(num, rel=1e-3, abs=1e-3)


def test_draws_are_stable(spark):
    df = spark.range(2000)
    a = df.repartition(7).select("id", hash32(1, F.col("id")).alias("h"), normal(3, F.col("id")).alias("z"))
    b = df.coalesce(1).select("id", hash32(1, F.col("id")).alias("h"), normal(3, F.col("id")).alias("z"))
    assert a.exceptAll(b).count() == 0
    m, s = a.select(F.avg("z"), F.stddev("z")).first()
    assert abs(m) < 0.1 and abs(s - 1) < 0.1


def test_scores_of_one_interval(spark):
    # an 80 % interval of width 28.68 missed on the low side by 2.70
    lo, hi, y = 744.54, 773.22, 741.84
    row = spark.range(1).select(acc.winkler_score(F.lit(y), F.lit(lo), F.lit(hi), 80),
                                acc.quantile_score(F.lit(y), F.lit(lo), 0.1)).first()
    assert row[0] == pytest.approx(55.68, abs=0.01)
    assert row[1] == pytest.approx(4.86, abs=0.01)
    assert (hi - lo) / 2 / level_z(80) == pytest.approx(math.sqrt(125.2), rel=1e-3)
    assert z_value(0.5) == 0.0


def test_crps_forms_agree(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(2, 1.5, 4000)
    df = spark.createDataFrame([(1, float(v), 2.7) for v in x], "k int, sim double, y double")
    got = acc.crps_sample(df, ["k"], "y").first()["crps"]
    brute = np.abs(x - 2.7).mean() - np.abs(x[:, None] - x[None, :]).mean() / 2
    assert got == pytest.approx(brute, rel=1e-9)
    closed = spark.range(1).select(acc.crps_normal(F.lit(2.7), F.lit(2.0), F.lit(1.5))).first()[0]
    assert closed == pytest.approx(got, rel=0.1)
