"""Queries of the error analysis (NB004): segments, RMSE, shape, QQ, thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.scalars import AS241, segment_label
from ..operators import stats
from . import bindings as B
from . import oracle_views as V
from .catalog import finish, r6, register

FLAGS = list(B.SEGMENT_FLAGS)
TARGETS = list(B.TARGETS)
TIE = list(B.ERROR_TIE)


def _errors(spark, sf_dir):
    e = B.prediction_errors(spark, sf_dir)
    lab = segment_label({B.SEGMENT_NAMES[f]: F.col(f) for f in FLAGS}, empty="None")
    return e.withColumn("segment", lab)


# ----------------------------- SQL helpers --------------------------------- #
def _poly(coefs, x):
    acc = repr(coefs[-1])
    for a in reversed(coefs[:-1]):
        acc = f"({acc} * {x} + {a!r})"
    return acc


def ppf_sql(p: str) -> str:
    a, b, c, d, e, f = AS241
    q = f"({p} - 0.5)"
    r0 = f"(0.180625 - {q} * {q})"
    r = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    near = f"({_poly(c, f'({r} - 1.6)')} / {_poly(d, f'({r} - 1.6)')})"
    far = f"({_poly(e, f'({r} - 5.0)')} / {_poly(f, f'({r} - 5.0)')})"
    tail = f"(CASE WHEN {r} <= 5.0 THEN {near} ELSE {far} END)"
    return (f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN abs({q}) <= 0.425 "
            f"THEN {q} * {_poly(a, r0)} / {_poly(b, r0)} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")


ERR = f"(SELECT *, CASE WHEN seg0 = '' THEN 'None' ELSE seg0 END AS segment FROM ({V.ERRORS}) z)"


# --------------------------------------------------------------------------- #
def _segment_sql() -> str:
    cols = ["CAST(count(*) AS BIGINT) AS n_students"]
    for t in TARGETS:
        cols += [f"{r6(f'avg(error_{t})')} AS {t}_mean_error", f"{r6(f'stddev_samp(error_{t})')} AS {t}_std_error",
                 f"{r6(f'avg(abs_error_{t})')} AS {t}_mae", f"{r6(f'sqrt(avg(error_{t} * error_{t}))')} AS {t}_rmse",
                 f"{r6(f'quantile_cont(abs_error_{t}, 0.5)')} AS {t}_median_abs_error",
                 f"{r6(f'quantile_cont(abs_error_{t}, 0.75)')} AS {t}_q75_abs_error",
                 f"{r6(f'quantile_cont(abs_error_{t}, 0.95)')} AS {t}_q95_abs_error"]
    cols.append(f"{r6('avg(abs_error_math + abs_error_verbal) / 2')} AS combined_mae")
    cols.append(f"{r6('sqrt(avg(error_math * error_math + error_verbal * error_verbal) / 2)')} AS combined_rmse")
    return f"""
SELECT has_rit, has_illuminate, has_milestone, {', '.join(cols)}, any_value(segment) AS segment_label
FROM {ERR} e GROUP BY has_rit, has_illuminate, has_milestone"""


@register("segment_errors", sql=_segment_sql(), ops="A9, A17, M6, M13, X6, exact percentiles")
def segment_errors(spark, sf_dir):
    e = B.prediction_errors(spark, sf_dir)
    out = stats.segment_errors(e, FLAGS, TARGETS, TIE, label_names=B.SEGMENT_NAMES, empty_label="None")
    return finish(out)


@register("overall_rmse", sql=f"""
SELECT {r6('sqrt(avg(error_math * error_math))')} AS math_rmse,
       {r6('sqrt(avg(error_verbal * error_verbal))')} AS verbal_rmse,
       {r6('sqrt(avg(error_math * error_math + error_verbal * error_verbal) / 2)')} AS pooled_rmse
FROM {ERR} e""", ops="A10")
def overall_rmse(spark, sf_dir):
    return finish(stats.overall_rmse(B.prediction_errors(spark, sf_dir), TARGETS))


def _moments(x: str) -> tuple[str, str]:
    m2 = f"avg(power({x} - mu_{x}, 2))"
    m3 = f"avg(power({x} - mu_{x}, 3))"
    m4 = f"avg(power({x} - mu_{x}, 4))"
    return f"{m3} / power({m2}, 1.5)", f"{m4} / power({m2}, 2) - 3"


def _shape_sql() -> str:
    cols = []
    for t in TARGETS:
        x = f"error_{t}"
        sk, ku = _moments(x)
        cols += [f"{r6(f'avg({x})')} AS {t}_mean", f"{r6(f'any_value(sd_{x})')} AS {t}_std",
                 f"{r6(sk)} AS {t}_skew", f"{r6(ku)} AS {t}_kurtosis",
                 f"{r6(f'100.0 * avg(CASE WHEN {x} BETWEEN mu_{x} - sd_{x} AND mu_{x} + sd_{x} THEN 1.0 ELSE 0.0 END)')}"
                 f" AS {t}_pct_within"]
    win = ", ".join(f"avg(error_{t}) OVER w AS mu_error_{t}, stddev_samp(error_{t}) OVER w AS sd_error_{t}"
                    for t in TARGETS)
    return f"""
SELECT segment, {', '.join(cols)}
FROM (SELECT *, {win} FROM {ERR} e WINDOW w AS (PARTITION BY segment)) x GROUP BY segment"""


@register("shape_stats", sql=_shape_sql(), ops="A11, A12")
def shape_stats(spark, sf_dir):
    return finish(stats.shape_stats(_errors(spark, sf_dir), ["segment"], TARGETS))


def _qq_sql() -> str:
    parts = []
    for t in TARGETS:
        x = f"error_{t}"
        p = (f"CASE WHEN pos = n - 1 THEN 0.99 ELSE pos * (0.98 / CAST(n - 1 AS DOUBLE)) + 0.01 END")
        parts.append(f"""{t} AS (
  SELECT segment, any_value(n) AS n, CASE WHEN any_value(n) < 8 THEN 0.0 ELSE power(corr({x}, q), 2) END AS r2
  FROM (SELECT segment, {x}, n, {ppf_sql('pp')} AS q
        FROM (SELECT segment, {x}, n, {p} AS pp
              FROM (SELECT segment, {x}, row_number() OVER (PARTITION BY segment ORDER BY {x}) - 1 AS pos,
                           count(*) OVER (PARTITION BY segment) AS n FROM {ERR} e) a) b) c
  GROUP BY segment)""")
    grade = lambda c: f"CASE WHEN {c} >= 0.98 THEN 'Excellent' WHEN {c} >= 0.95 THEN 'Good' ELSE 'Poor' END"
    return f"""
WITH {', '.join(parts)}
SELECT math.segment, CAST(math.n AS BIGINT) AS n_students,
       {r6('math.r2')} AS math_qq_r2, {r6('verbal.r2')} AS verbal_qq_r2,
       {grade('math.r2')} AS math_qq_assessment, {grade('verbal.r2')} AS verbal_qq_assessment
FROM math JOIN verbal USING (segment)"""


@register("qq_r2", sql=_qq_sql(), ops="W10, X24, X26, Q7")
def qq_r2(spark, sf_dir):
    # segments are labels of three boolean flags: at most eight groups
    out = stats.qq_r2(_errors(spark, sf_dir), ["segment"], TARGETS, TIE, bounded_groups=True)
    return finish(out.select("segment", F.col("n_students").cast("bigint").alias("n_students"),
                             "math_qq_r2", "verbal_qq_r2", "math_qq_assessment", "verbal_qq_assessment"))


def _seg_info(spark, sf_dir):
    e = _errors(spark, sf_dir)
    seg = stats.segment_errors(e, FLAGS, TARGETS, TIE, label_names=B.SEGMENT_NAMES, empty_label="None")
    lv = stats.uncertainty_levels(seg, "combined_rmse")
    return lv


def _levels_sql() -> str:
    return f"""
WITH s AS ({_segment_sql()}),
c AS (SELECT quantile_cont(combined_rmse_raw, 0.6) AS c1, quantile_cont(combined_rmse_raw, 0.8) AS c2
      FROM (SELECT sqrt(avg(error_math * error_math + error_verbal * error_verbal) / 2) AS combined_rmse_raw
            FROM {ERR} e GROUP BY has_rit, has_illuminate, has_milestone) r),
raw AS (SELECT has_rit, has_illuminate, has_milestone,
               sqrt(avg(error_math * error_math + error_verbal * error_verbal) / 2) AS combined_rmse_raw,
               (quantile_cont(abs_error_math, 0.5) + quantile_cont(abs_error_verbal, 0.5)) / 2 AS med_raw,
               (quantile_cont(abs_error_math, 0.95) + quantile_cont(abs_error_verbal, 0.95)) / 2 AS q95_raw
        FROM {ERR} e GROUP BY has_rit, has_illuminate, has_milestone)
SELECT s.segment_label, s.n_students, s.combined_rmse,
       CASE WHEN raw.combined_rmse_raw <= c.c1 THEN 'Low' WHEN raw.combined_rmse_raw <= c.c2 THEN 'Medium'
            ELSE 'High' END AS uncertainty_level,
       {r6('raw.med_raw')} AS combined_median_abs_error,
       {r6('raw.q95_raw')} AS combined_q95_abs_error
FROM s JOIN raw USING (has_rit, has_illuminate, has_milestone) CROSS JOIN c"""


@register("uncertainty_levels", sql=_levels_sql(), ops="Q9, Q10")
def uncertainty_levels(spark, sf_dir):
    lv = _seg_info(spark, sf_dir)
    return finish(lv.select(
        "segment_label", F.col("n_students").cast("bigint").alias("n_students"), "combined_rmse",
        "uncertainty_level",
        ((F.col("math_median_abs_error") + F.col("verbal_median_abs_error")) / 2).alias("combined_median_abs_error"),
        ((F.col("math_q95_abs_error") + F.col("verbal_q95_abs_error")) / 2).alias("combined_q95_abs_error")))


def _threshold_sql() -> str:
    pcts = []
    for t in TARGETS:
        for lvl in K.SIGMA_LEVELS:
            lo, hi = K.SIGMA_PERCENTILES[lvl]
            key = str(lvl).replace(".", "_")
            pcts += [f"quantile_cont(error_{t}, {lo / 100.0!r}) AS {t}_p_{key}_lo",
                     f"quantile_cont(error_{t}, {hi / 100.0!r}) AS {t}_p_{key}_hi"]
    lvls = ", ".join(f"CAST({float(x)!r} AS DOUBLE)" for x in K.SIGMA_LEVELS)
    per_t = []
    sel_t = []
    for t in TARGETS:
        lo_case = " ".join(f"WHEN std_level = {float(l)!r} THEN {t}_p_{str(l).replace('.', '_')}_lo"
                           for l in K.SIGMA_LEVELS)
        hi_case = " ".join(f"WHEN std_level = {float(l)!r} THEN {t}_p_{str(l).replace('.', '_')}_hi"
                           for l in K.SIGMA_LEVELS)
        use = f"({t}_r2 >= 0.95)"
        per_t.append(f"""CASE WHEN {use} THEN {t}_mean_error - std_level * {t}_std_error ELSE CASE {lo_case} END END
                         AS {t}_lower_threshold,
                       CASE WHEN {use} THEN {t}_mean_error + std_level * {t}_std_error ELSE CASE {hi_case} END END
                         AS {t}_upper_threshold,
                       CASE WHEN {use} THEN 'std_dev' ELSE 'percentile' END AS {t}_method""")
        sel_t += [f"{t}_method",
                  f"{r6(f'round_even({t}_lower_threshold, 4)')} AS {t}_lower_threshold",
                  f"{r6(f'round_even({t}_upper_threshold, 4)')} AS {t}_upper_threshold",
                  f"{r6(f'round_even({t}_upper_threshold - {t}_lower_threshold, 4)')} AS {t}_threshold_range",
                  f"{r6(f'round_even({t}_pct_within_threshold, 4)')} AS {t}_pct_within_threshold",
                  f"{r6(f'round_even({t}_mean_error, 4)')} AS {t}_mean_error",
                  f"{r6(f'round_even({t}_std_error, 4)')} AS {t}_std_error",
                  f"{r6(f'round_even({t}_r2, 4)')} AS {t}_qq_r2",
                  f"CASE WHEN {t}_r2 >= 0.98 THEN 'Excellent' WHEN {t}_r2 >= 0.95 THEN 'Good' ELSE 'Poor' END"
                  f" AS {t}_qq_assessment"]
    within = ", ".join(
        f"100.0 * avg(CASE WHEN e.error_{t} BETWEEN r.{t}_lower_threshold AND r.{t}_upper_threshold "
        f"THEN 1.0 ELSE 0.0 END) AS {t}_pct_within_threshold" for t in TARGETS)
    return f"""
WITH qq AS ({_qq_sql()}),
lv AS ({_levels_sql()}),
seg AS (SELECT segment, count(*) AS n_students, any_value(has_rit) AS has_rit,
               any_value(has_illuminate) AS has_illuminate, any_value(has_milestone) AS has_milestone,
               avg(error_math) AS math_mean_error, stddev_samp(error_math) AS math_std_error,
               avg(error_verbal) AS verbal_mean_error, stddev_samp(error_verbal) AS verbal_std_error,
               {', '.join(pcts)}
        FROM {ERR} e GROUP BY segment HAVING count(*) >= 5),
qraw AS (SELECT segment, math_qq_r2 AS math_r2, verbal_qq_r2 AS verbal_r2 FROM qq),
rows AS (SELECT seg.*, qraw.math_r2, qraw.verbal_r2, l.std_level,
                {', '.join(per_t)}
         FROM seg JOIN qraw USING (segment)
         CROSS JOIN (SELECT unnest([{lvls}]) AS std_level) l),
w AS (SELECT r.segment, r.std_level, {within}
      FROM {ERR} e JOIN rows r ON e.segment = r.segment GROUP BY r.segment, r.std_level)
SELECT rows.segment, rows.has_rit, rows.has_illuminate, rows.has_milestone, rows.std_level,
       CAST(rows.n_students AS BIGINT) AS n_students, {', '.join(sel_t)},
       {r6('round_even(lv.combined_rmse, 4)')} AS combined_rmse, lv.uncertainty_level
FROM rows JOIN w USING (segment, std_level) LEFT JOIN lv ON lv.segment_label = rows.segment"""


@register("threshold_table", sql=_threshold_sql(), ops="Q8, Q7, Q9, X18 (half-even), X26")
def threshold_table(spark, sf_dir):
    e = _errors(spark, sf_dir)
    info = _seg_info(spark, sf_dir).select(F.col("segment_label").alias("segment"), "combined_rmse",
                                          "uncertainty_level")
    out = stats.threshold_table(e, "segment", FLAGS, TARGETS, TIE, info, bounded_groups=True)
    return finish(out.withColumn("n_students", F.col("n_students").cast("bigint")))


def _hist_sql() -> str:
    parts = []
    for t in TARGETS:
        x = f"error_{t}"
        parts.append(f"""
SELECT segment, '{t}' AS target, bin,
       {r6('lo + bin * w')} AS bin_left, {r6('lo + (bin + 1) * w')} AS bin_right,
       CAST(count(*) AS BIGINT) AS count, {r6('count(*) / (any_value(n) * w)')} AS density
FROM (SELECT segment, n, lo, w,
             CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor(({x} - lo) / w), bins - 1) END AS INTEGER) AS bin
      FROM (SELECT *, (hi - lo) / bins AS w
            FROM (SELECT segment, {x}, count({x}) OVER s AS n, min({x}) OVER s AS lo, max({x}) OVER s AS hi,
                         least(30, greatest(10, floor(count({x}) OVER s / 10))) AS bins
                  FROM {ERR} e WINDOW s AS (PARTITION BY segment)) a) b) c
GROUP BY segment, bin, lo, w""")
    return " UNION ALL ".join(parts)


@register("error_histogram", sql=_hist_sql(), ops="Q6")
def error_histogram(spark, sf_dir):
    e = _errors(spark, sf_dir)
    outs = []
    for t in TARGETS:
        h = stats.error_histogram(e, ["segment"], f"error_{t}")
        outs.append(h.select("segment", F.lit(t).alias("target"), "bin", "bin_left", "bin_right",
                             F.col("count").cast("bigint").alias("count"), "density"))
    return finish(outs[0].unionByName(outs[1]))


def _curve_sql() -> str:
    parts = []
    for t in TARGETS:
        x = f"error_{t}"
        xv = "(lo + (hi - lo) * CAST(k AS DOUBLE) / CAST(99.0 AS DOUBLE))"
        parts.append(f"""
SELECT segment, '{t}' AS target, CAST(k AS INTEGER) AS point, {r6(xv)} AS x,
       {r6(f'exp(-power({xv} - mu, 2) / (2.0 * sd * sd)) / (sd * sqrt(2 * pi()))')} AS pdf
FROM (SELECT segment, avg({x}) AS mu, stddev_samp({x}) AS sd, min({x}) AS lo, max({x}) AS hi
      FROM {ERR} e GROUP BY segment) s, range(0, 100) r(k)""")
    return " UNION ALL ".join(parts)


@register("normal_curve", sql=_curve_sql(), ops="X25")
def normal_curve(spark, sf_dir):
    e = _errors(spark, sf_dir)
    outs = [stats.normal_curve(e, ["segment"], f"error_{t}").select(
        "segment", F.lit(t).alias("target"), "point", "x", "pdf") for t in TARGETS]
    return finish(outs[0].unionByName(outs[1]))
