"""Component and composite score expressions (M-7..M-15, M-18, M-22).

Pure Column builders: no joins, no UDFs.  Double literals are Python floats
(DOUBLE in Spark), matching the source's FLOAT64 arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vantage.config import MetricConfig

# Fixed values of the metric definition.
COLOR_SCORE = {"Green": 1.0, "Yellow": 0.5, "Red": 0.0}
COLOR_MISSING = 0.5
T_WEIGHTS = (0.55, 0.30, 0.15)          # colour, ticket load, load trend
T_LOAD_SCALE = 4.0
T_V1_WEIGHTS = (0.6, 0.4)               # colour, sev-1/2 load (v1)
T_V1_SEV_WEIGHTS = (0.5, 0.2)
T_V1_SCALE = 3.0
R_LONG_DAYS = 180
R_MID_DAYS = 60
DAYS_PER_MONTH = 30.0


def c(name: str) -> Column:
    return F.col(name)


def d_score(credits_last_month: Column, allotment: Column) -> Column:
    return F.least(F.lit(1.0), F.coalesce(F.try_divide(credits_last_month, allotment), F.lit(0.0)))


def c_score(mean: Column, sd: Column, n: Column, cfg: MetricConfig) -> Column:
    return (F.when(mean.isNull() | (mean == 0) | (n < cfg.min_usage_rows), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0),
                                  F.least(F.lit(1.0), F.lit(1.0) - F.try_divide(sd, mean)))))


def color_score(color: Column) -> Column:
    e = F.lit(COLOR_MISSING)
    for name in reversed(list(COLOR_SCORE)):
        e = F.when(color == name, F.lit(COLOR_SCORE[name])).otherwise(e)
    return e


def t_score(color: Column, load: Column, prev_load: Column) -> Column:
    """load / prev_load are the raw (possibly NULL) joined values."""
    cur = F.coalesce(load, F.lit(0.0))
    prev = F.coalesce(prev_load, cur)
    wc, wl, wt = T_WEIGHTS
    return (F.lit(wc) * color_score(color)
            + F.lit(wl) * (F.lit(1.0) - F.least(F.lit(1.0), cur / T_LOAD_SCALE))
            + F.lit(wt) * (F.lit(0.5) - F.least(F.lit(0.5), F.greatest(F.lit(-0.5),
                                                                     (cur - prev) / T_LOAD_SCALE))))


def t_score_v1(color: Column, open_sev1: Column, open_sev2: Column) -> Column:
    wc, wl = T_V1_WEIGHTS
    s1, s2 = T_V1_SEV_WEIGHTS
    load = (F.coalesce(open_sev1, F.lit(0)) * s1 + F.coalesce(open_sev2, F.lit(0)) * s2) / T_V1_SCALE
    return F.lit(wc) * color_score(color) + F.lit(wl) * (F.lit(1.0) - F.least(F.lit(1.0), load))


def r_score(days_to_renewal: Column, had_red: Column) -> Column:
    red = F.coalesce(had_red, F.lit(False))
    near = days_to_renewal.between(0, R_MID_DAYS - 1)
    return (F.when(days_to_renewal > R_LONG_DAYS, F.lit(1.0))
            .when(days_to_renewal.between(R_MID_DAYS, R_LONG_DAYS), F.lit(0.75))
            .when(near & ~red, F.lit(1.0))
            .when(near & red, F.lit(0.25))
            .otherwise(F.lit(0.0)))


def b_score(credits_since_start: Column, allotment: Column, days_in_contract: Column) -> Column:
    return F.least(F.lit(1.0), F.coalesce(
        F.try_divide(credits_since_start, allotment * (days_in_contract / DAYS_PER_MONTH)),
        F.lit(0.0)))


def expansion_flag(credits_3mo: Column, allotment: Column, days_to_renewal: Column,
                   cfg: MetricConfig) -> Column:
    used = F.coalesce(credits_3mo, F.lit(0))
    cap = F.lit(cfg.expansion_overage_threshold) * (3 * allotment)
    over = used > cap if cfg.expansion_strict else used >= cap
    return over & (days_to_renewal <= cfg.expansion_days_to_renewal)


def is_ramp(days_in_contract: Column, cfg: MetricConfig) -> Column:
    if cfg.ramp_period_days is None:
        return F.lit(False)
    return days_in_contract < cfg.ramp_period_days


def composite(d: Column, cc: Column, t: Column, r: Column, b: Column, cfg: MetricConfig) -> Column:
    """100 x weighted sum, rounded half-up to one decimal.

    floor(x * 10 + 0.5) / 10 is used for ROUND(x, 1): the score is
    non-negative, and this form rounds identically in every engine."""
    raw = F.lit(100.0) * (F.lit(cfg.w_d) * d + F.lit(cfg.w_c) * cc + F.lit(cfg.w_t) * t
                          + F.lit(cfg.w_r) * r + F.lit(cfg.w_b) * b)
    return F.floor(raw * 10.0 + 0.5) / 10.0


def avr_score(d, cc, t, r, b, days_in_contract: Column, cfg: MetricConfig) -> Column:
    return F.when(is_ramp(days_in_contract, cfg), F.lit(None).cast("double")).otherwise(
        composite(d, cc, t, r, b, cfg))


def band(score: Column, ramp: Column, cfg: MetricConfig) -> Column:
    return (F.when(ramp, "Onboarding")
            .when(score >= cfg.band_green_cutoff, "Green")
            .when(score >= cfg.band_yellow_cutoff, "Yellow")
            .otherwise("Red"))


def band_v1(score: Column, cfg: MetricConfig) -> Column:
    return (F.when(score >= cfg.band_green_cutoff, "Green")
            .when(score >= cfg.band_yellow_cutoff, "Yellow").otherwise("Red"))


def pct_red_band(pct_red: Column) -> Column:
    """M-22: inverted band for a "% Red" figure (lower is better); NULL has no band."""
    return F.when(pct_red.isNull(), F.lit(None).cast("string")).when(pct_red <= 25, "Green").when(pct_red <= 50, "Yellow").otherwise("Red")


def score_tenths(score: Column) -> Column:
    """Exact integer tenths of a one-decimal score (for order-free sums)."""
    return F.round(score * 10.0).cast("bigint")


def score_nano(score: Column) -> Column:
    """A [0, 1] score as exact integer 1e-9 units (order-free sums)."""
    return F.round(score * 1.0e9).cast("bigint")
