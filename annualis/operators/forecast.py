"""Per-entity trend forecasts with intervals and hold-out scores."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.functions.scalar import clamp_min, iso_date, jan_first, rounded, safe_div
from annualis.operators.cleaning import split_by_time
from annualis.operators.stats import mape
from annualis.schemas import CHANGEPOINT_RANGE, CHANGEPOINT_SCALE, CHANGEPOINTS, CUTOFF_YEAR, HORIZON, INTERVAL


def trend_fit(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR) -> DataFrame:
    """Straight line per entity on periods up to ``cutoff``, from one aggregation.

    Output: key, slope, mid_x, mid_y, sxx, n, the residual deviation ``s`` (NULL below
    three points) and the entity's last period of all.
    """
    x, y = F.col(ord).cast("double"), F.when(F.col(ord) <= cutoff, F.col(v).cast("double"))
    sums = df.groupBy(key).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_avgx(y, x).alias("mid_x"), F.regr_avgy(y, x).alias("mid_y"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"),
        F.regr_count(y, x).alias("n"), F.max(ord).alias("last"),
    ).filter(F.col("n") > 0)
    sse = F.greatest(F.col("_syy") - safe_div(F.col("_sxy") * F.col("_sxy"), F.col("sxx")), F.lit(0.0))
    s = F.when((F.col("n") >= 3) & (F.col("sxx") > 0), F.sqrt(sse / F.when(F.col("n") > 2, F.col("n") - 2)))
    return sums.select(key, "slope", "mid_x", "mid_y", "sxx", "n", s.alias("s"), "last")


def line_at(ord: str) -> Column:
    """Fitted line at a period; the mean of the training points where there is one point only."""
    x = F.col(ord).cast("double") - F.col("mid_x")
    return F.col("mid_y") + F.coalesce(F.col("slope"), F.lit(0.0)) * x


def half_width(ord: str, level: float) -> Column:
    """Half of the prediction interval of the line, by the normal quantile."""
    x = F.col(ord).cast("double") - F.col("mid_x")
    spread = F.sqrt(1 + F.lit(1.0) / F.col("n") + safe_div(x * x, F.col("sxx")))
    return F.lit(NormalDist().inv_cdf(0.5 + level / 2)) * F.col("s") * spread


def forecast_trend(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR, horizon=HORIZON,
                   level=INTERVAL, digits: int | None = 1) -> DataFrame:
    """The next ``horizon`` periods after each entity's last one, from the line fitted up to ``cutoff``.

    ``yhat`` is clamped at 0 and rounded, the bounds are neither. The closed-form
    interval of a line is narrower than one that simulates trend changes;
    ``forecast_piecewise`` includes those. Entities without a point up to ``cutoff``
    have no forecast.
    """
    fit = trend_fit(df, key, ord, v, cutoff)
    ahead = fit.withColumn(ord, F.explode(F.sequence(F.col("last") + 1, F.col("last") + horizon)))
    yhat, half = line_at(ord), half_width(ord, level)
    return ahead.select(
        key, ord, iso_date(jan_first(ord)).alias("ds"), rounded(clamp_min(yhat, 0.0), digits).alias("yhat"),
        (yhat - half).alias("yhat_lower"), (yhat + half).alias("yhat_upper"),
    )


def forecast_holdout(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR,
                     digits: int | None = 2) -> DataFrame:
    """MAPE of the line on the periods after ``cutoff``, per entity.

    (entity, period) is unique, so no entity is hot and both sides share the aggregation's partitioning.
    """
    _, test = split_by_time(df, ord, cutoff)
    scored = test.join(trend_fit(df, key, ord, v, cutoff), key).withColumn("_yhat", line_at(ord))
    return mape(scored, v, "_yhat", [key], digits)


# --- piecewise linear trend -------------------------------------------------

_SUMS = ["n", "st", "stt", "sy", "sty", "syy"]


def _segment_sums(df: DataFrame, key: str, ord: str, v: str, cutoff, changepoints: int, share: float) -> DataFrame:
    """Per entity and segment between changepoints: six sums of scaled time and value.

    Time runs over [0, 1] and values are divided by the largest magnitude, both per
    entity. Changepoints are equidistant on the first ``share`` of the time range. These
    sums are all a hinge regression needs, so an entity of any length becomes at
    most ``changepoints`` + 1 rows before the shuffle.
    """
    train, _ = split_by_time(df, ord, cutoff)
    seen = F.col(ord) <= cutoff
    at = F.when(seen, F.col(ord))
    ends = df.groupBy(key).agg(
        F.min(at).cast("double").alias("t0"), F.max(at).cast("double").alias("t1"),
        F.max(F.when(seen, F.abs(v))).cast("double").alias("scale"), F.max(ord).cast("double").alias("last"),
    )
    wide = train.join(ends, key)
    t = safe_div(F.col(ord).cast("double") - F.col("t0"), F.col("t1") - F.col("t0"), F.lit(0.0))
    y = safe_div(F.col(v).cast("double"), F.col("scale"), F.lit(0.0))
    points = wide.select(key, "t0", "t1", "scale", "last", t.alias("t"), y.alias("y"))
    step = share / changepoints
    segment = F.least(F.floor(F.col("t") / F.lit(step)), F.lit(changepoints)).cast("int")
    t, y = F.col("t"), F.col("y")
    return points.groupBy(key, "t0", "t1", "scale", "last", segment.alias("segment")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(t).alias("st"), F.sum(t * t).alias("stt"),
        F.sum(y).alias("sy"), F.sum(t * y).alias("sty"), F.sum(y * y).alias("syy"),
    )


def hinge_system(sums: np.ndarray, knots: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Normal equations of ``1, t, max(0, t - knot)...`` from segment sums (rows: segments, columns: ``_SUMS``)."""
    tail = np.cumsum(sums[::-1], axis=0)[::-1]  # sums over a segment and all later ones
    n, st, stt, sy, sty, syy = tail[0]
    size = len(knots) + 2
    gram, right = np.zeros((size, size)), np.zeros(size)
    gram[:2, :2] = [[n, st], [st, stt]]
    right[:2] = [sy, sty]
    for j, a in enumerate(knots):
        m, t1, t2, y1, ty, _ = tail[j + 1]
        gram[0, j + 2] = gram[j + 2, 0] = t1 - a * m
        gram[1, j + 2] = gram[j + 2, 1] = t2 - a * t1
        right[j + 2] = ty - a * y1
        for i in range(j + 1):  # of two hinges the later knot bounds the rows
            b = knots[i]
            gram[i + 2, j + 2] = gram[j + 2, i + 2] = t2 - (a + b) * t1 + a * b * m
    return gram, right, syy, n


def penalised_minimum(gram: np.ndarray, right: np.ndarray, penalty: float, free: int = 2) -> tuple[np.ndarray, bool]:
    """Minimise ``b'Gb/2 - r'b + penalty * sum |b[free:]|`` by an active set; the second value tells if it is the minimum.

    A coefficient at 0 whose slope exceeds the penalty joins the set with the sign that lowers the value. The set is solved
    with its signs held; on the way there the value is compared wherever a coefficient reaches 0, and the best point is
    kept. The value falls with each step and there are finitely many sets, so this ends.
    """
    size = len(right)
    beta, sign = np.zeros(size), np.zeros(size)
    usable = np.diag(gram) > 1e-12
    active = usable & (np.arange(size) < free)
    tolerance = 1e-9 * max(penalty, np.abs(right).max(initial=0), 1e-300)
    value = lambda b: b @ gram @ b / 2 - right @ b + penalty * np.abs(b[free:]).sum()
    for _ in range(100 * size):
        on = np.flatnonzero(active)
        goal = np.zeros(size)
        goal[on] = np.linalg.lstsq(gram[np.ix_(on, on)], right[on] - penalty * sign[on], rcond=None)[0]
        steps = [1.0]
        for j in on:
            if j >= free and beta[j] * goal[j] < 0:
                steps.append(beta[j] / (beta[j] - goal[j]))
        best = min((beta + s * (goal - beta) for s in steps), key=value)
        best[free:][np.abs(best[free:]) < 1e-14] = 0.0
        moved, beta = np.abs(best - beta).max() > 1e-14, best
        sign[free:] = np.sign(beta[free:])
        active = usable & ((np.arange(size) < free) | (beta != 0))
        slope = gram @ beta - right
        inside = np.abs(slope + penalty * sign)[active].max(initial=0) <= tolerance
        outside = np.where(usable & ~active, np.abs(slope) - penalty, -np.inf)
        if (inside or not moved) and outside.max(initial=-np.inf) <= tolerance:
            return beta, bool(inside)
        if inside or not moved:
            j = int(outside.argmax())
            active[j], sign[j] = True, -np.sign(slope[j])
    return beta, False


def solve_hinges(gram: np.ndarray, right: np.ndarray, syy: float, n: float, prior: float, rounds: int = 2_000) -> tuple[np.ndarray, float, bool]:
    """Posterior mode with a Laplace prior on slope changes and Normal(0, 5) on level and slope: (coefficients, noise, converged).

    Coefficients and noise variance are the minimum for each other in turn, which lowers one common value; ``converged``
    tells that the noise settled and the coefficients are the minimum for it.
    """
    noise = max(syy / max(n, 1.0), 1e-8)
    for _ in range(rounds):
        flat = gram.copy()
        flat[[0, 1], [0, 1]] += noise / 25.0
        beta, exact = penalised_minimum(flat, right, noise / prior)
        sse = max(syy - 2 * beta @ right + beta @ gram @ beta, 0.0)
        before, noise = noise, max(sse / max(n, 1.0), 1e-8)
        if abs(noise - before) <= 1e-10 * before:
            return beta, float(np.sqrt(noise)), exact
    return beta, float(np.sqrt(noise)), False


def piecewise_fit(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR, changepoints=CHANGEPOINTS,
                  share=CHANGEPOINT_RANGE, prior=CHANGEPOINT_SCALE) -> DataFrame:
    """Per entity the coefficients ``beta`` (level, slope, slope changes), ``sigma``, ``converged`` and the scaling.

    The Python step sees at most ``changepoints`` + 1 rows of sums per entity, whatever the entity's length.
    """
    sums = _segment_sums(df, key, ord, v, cutoff, changepoints, share)
    knots = np.arange(1, changepoints + 1) * share / changepoints
    kind = df.schema[key].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf.iloc[0]
        full = np.zeros((changepoints + 1, len(_SUMS)))
        full[pdf["segment"].to_numpy()] = pdf[_SUMS].to_numpy()
        beta, sigma, converged = solve_hinges(*hinge_system(full, knots), prior)
        return pd.DataFrame({key: [head[key]], "t0": [head["t0"]], "t1": [head["t1"]], "scale": [head["scale"]], "last": [head["last"]],
                             "beta": [beta.tolist()], "sigma": [sigma], "converged": [converged]})

    schema = f"`{key}` {kind}, t0 double, t1 double, scale double, last double, beta array<double>, sigma double, converged boolean"
    return sums.groupBy(key).applyInPandas(fit, schema)


def _scaled_time(ord: str) -> Column:
    return (F.col(ord).cast("double") - F.col("t0")) / F.greatest(F.col("t1") - F.col("t0"), F.lit(1.0))


def piecewise_at(ord: str, changepoints=CHANGEPOINTS, share=CHANGEPOINT_RANGE) -> Column:
    """The trend of ``piecewise_fit`` at a period, in units of the entity's scale."""
    t = _scaled_time(ord)
    knots = F.array(*[F.lit((j + 1) * share / changepoints) for j in range(changepoints)])
    bends = F.zip_with(F.slice("beta", 3, changepoints), knots, lambda b, k: b * F.greatest(t - k, F.lit(0.0)))
    return F.aggregate(bends, F.col("beta")[0] + F.col("beta")[1] * t, lambda a, x: a + x)


def forecast_piecewise(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR, horizon=HORIZON,
                       level=INTERVAL, changepoints=CHANGEPOINTS, share=CHANGEPOINT_RANGE, prior=CHANGEPOINT_SCALE,
                       digits: int | None = 1) -> DataFrame:
    """Piecewise linear trend per entity with sparse slope changes (Taylor and Letham 2018).

    The interval adds to the noise the variance of future slope changes, which come
    at the historical rate with the historical mean size. ``converged`` is that of the fit.
    """
    fit = piecewise_fit(df, key, ord, v, cutoff, changepoints, share, prior)
    last = F.col("last").cast("bigint")
    ahead = fit.withColumn(ord, F.explode(F.sequence(last + 1, last + horizon)))
    size = F.aggregate(F.slice("beta", 3, changepoints), F.lit(0.0), lambda a, b: a + F.abs(b)) / changepoints
    beyond = F.greatest(_scaled_time(ord) - 1, F.lit(0.0))
    drift = F.lit(changepoints / share * 2.0 / 3.0) * size * size * beyond * beyond * beyond
    half = F.lit(NormalDist().inv_cdf(0.5 + level / 2)) * F.sqrt(F.col("sigma") * F.col("sigma") + drift)
    yhat = piecewise_at(ord, changepoints, share)
    out = ahead.select(key, ord, yhat.alias("yhat"), half.alias("half"), "scale", "converged")
    return out.select(
        key, ord, iso_date(jan_first(F.col(ord).cast("int"))).alias("ds"),
        rounded(clamp_min(F.col("yhat") * F.col("scale"), 0.0), digits).alias("yhat"),
        ((F.col("yhat") - F.col("half")) * F.col("scale")).alias("yhat_lower"),
        ((F.col("yhat") + F.col("half")) * F.col("scale")).alias("yhat_upper"), "converged",
    )


def piecewise_holdout(df: DataFrame, key="area", ord="year", v="value_tonnes", cutoff=CUTOFF_YEAR, changepoints=CHANGEPOINTS,
                      share=CHANGEPOINT_RANGE, prior=CHANGEPOINT_SCALE, digits: int | None = 2) -> DataFrame:
    """MAPE of the piecewise trend on the periods after ``cutoff``, per entity."""
    _, test = split_by_time(df, ord, cutoff)
    fit = piecewise_fit(df, key, ord, v, cutoff, changepoints, share, prior)
    scored = test.join(fit, key).withColumn("_yhat", piecewise_at(ord, changepoints, share) * F.col("scale"))
    return mape(scored, v, "_yhat", [key], digits)
