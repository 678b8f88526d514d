"""Golden cases of the score formulas (calibration table and worked example)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vantage.config import MetricConfig
from vantage.functions import scoring as S
from vantage.operators.tickets import LOAD_DIVISOR, load_units

CFG = MetricConfig()


def one(spark, expr, schema="x int", row=(0,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def t_tickets(load):
    return 1.0 - min(1.0, load / 4.0)


@pytest.mark.parametrize("tickets,expected", [
    ([(1, 0)], 0.875), ([(1, 0)] * 3, 0.625), ([(1, 0)] * 8, 0.0),
    ([(1, 30)], 0.75), ([(3, 0)] * 20, 0.75)])
def test_ticket_load_calibration(spark, tickets, expected):
    df = spark.createDataFrame(tickets, "severity long, age int")
    units = df.agg(F.sum(load_units(F.col("severity"), F.col("age"))).alias("u")).first()["u"]
    assert t_tickets(units / LOAD_DIVISOR) == pytest.approx(expected)


@pytest.mark.parametrize("load,prev,expected_trend", [
    (4.0, 0.0, 0.0), (0.0, 4.0, 1.0), (1.0, 1.0, 0.5), (1.0, None, 0.5)])
def test_trend_calibration(spark, load, prev, expected_trend):
    # colour Green (1.0) -> 0.55; isolate the trend term
    t = one(spark, S.t_score(F.lit("Green"), F.lit(load), F.lit(prev).cast("double")))
    tickets = 0.30 * t_tickets(load)
    assert (t - 0.55 - tickets) / 0.15 == pytest.approx(expected_trend)


def test_missing_colour_is_half(spark):
    assert one(spark, S.color_score(F.lit(None).cast("string"))) == 0.5


def test_worked_composite_example(spark):
    v = one(spark, S.composite(F.lit(0.95), F.lit(0.88), F.lit(0.8125), F.lit(1.0), F.lit(0.90), CFG))
    assert v == pytest.approx(89.7)
    assert one(spark, S.band(F.lit(v), F.lit(False), CFG)) == "Green"


@pytest.mark.parametrize("days,red,expected", [
    (181, False, 1.0), (180, False, 0.75), (60, True, 0.75), (59, False, 1.0), (59, True, 0.25),
    (-1, False, 0.0)])
def test_renewal_component(spark, days, red, expected):
    assert one(spark, S.r_score(F.lit(days), F.lit(red))) == expected


@pytest.mark.parametrize("dic,ramp", [(89, True), (90, False)])
def test_ramp_boundary(spark, dic, ramp):
    assert one(spark, S.is_ramp(F.lit(dic), CFG)) == ramp


@pytest.mark.parametrize("n,expected_zero", [(9, True), (10, False)])
def test_c_needs_ten_rows(spark, n, expected_zero):
    v = one(spark, S.c_score(F.lit(10.0), F.lit(1.0), F.lit(n), CFG))
    assert (v == 0.0) == expected_zero


def test_zero_allotment_is_safe(spark):
    assert one(spark, S.d_score(F.lit(5).cast("bigint"), F.lit(0).cast("bigint"))) == 0.0
    assert one(spark, S.b_score(F.lit(5).cast("bigint"), F.lit(0).cast("bigint"), F.lit(30))) == 0.0


def test_v1_expansion_is_strict(spark):
    v1 = MetricConfig.v1()
    assert one(spark, S.expansion_flag(F.lit(360), F.lit(100), F.lit(10), v1)) is False
    assert one(spark, S.expansion_flag(F.lit(361), F.lit(100), F.lit(10), v1)) is True
    assert one(spark, S.expansion_flag(F.lit(270), F.lit(100), F.lit(180), CFG)) is True
    assert one(spark, S.expansion_flag(F.lit(270), F.lit(100), F.lit(181), CFG)) is False


def test_month_bounds_clamp(spark):
    from vantage.functions.dates import prev_month_end, prev_month_start
    row = spark.createDataFrame([(dt.date(2001, 3, 31),)], "d date").select(
        prev_month_start(F.col("d")).alias("a"), prev_month_end(F.col("d")).alias("b")).first()
    assert row["a"] == dt.date(2001, 2, 1) and row["b"] == dt.date(2001, 2, 28)
