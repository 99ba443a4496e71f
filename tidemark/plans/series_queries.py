"""Queries over single and parallel series: diagnostics, smoothing, fitted forecasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import additive, arma, baselines, calendar, diagnostics, grains, metrics, misses, smoothing, splits
from tidemark.operators.panelfit import per_series_score
from tidemark.plans import solve_sql
from tidemark.plans import tables as t
from tidemark.plans.oracle import on_cells, on_log
from tidemark.plans.registry import query, rounded
from tidemark.plans.sales_queries import ERRORS, RANKED, _errors, store_folds
from tidemark.runtime import cut_lineage


@query(
    "series_describe",
    on_cells(
        """SELECT "Store", COUNT(*) AS n, round(AVG(y), 3) AS mean, MIN(y) AS min, MAX(y) AS max, round(stddev_samp(y), 3) AS std
        FROM store_series GROUP BY 1"""
    ),
)
def series_describe(spark, folder):
    return rounded(diagnostics.describe(t.store_series(spark, folder), ["Store"]), 3, "mean", "std")


_CHAIN_CPI = """, c AS (SELECT "Date" AS ds, CAST("Weekly_Sales" AS DOUBLE) AS y, "CPI" AS cpi FROM chain_full),
  d AS (SELECT ds, y, cpi, y / (cpi / first(cpi) OVER (ORDER BY ds)) AS real, row_number() OVER (ORDER BY ds) - 1 AS t FROM c)"""


@query(
    "price_growth",
    on_log(
        _CHAIN_CPI + """ SELECT round(arg_min(cpi, ds), 9) AS first, round(arg_max(cpi, ds), 9) AS last,
        round((arg_max(cpi, ds) / arg_min(cpi, ds) - 1) * 100, 6) AS growth_pct FROM c"""
    ),
)
def price_growth(spark, folder):
    chain = grains.as_series(t.full_chain(spark, folder), "CPI")
    return rounded(rounded(diagnostics.growth(chain), 6, "growth_pct"), 9, "first", "last")


def _chain_with_prices(spark, folder):
    chain = t.full_chain(spark, folder).select(
        F.col("Date").alias("ds"), F.col("Weekly_Sales").cast("double").alias("y"), F.col("CPI").alias("cpi")
    )
    return grains.deflate(chain)


@query("deflated_sales", on_log(_CHAIN_CPI + " SELECT ds, y, round(cpi, 9) AS cpi, round(real, 3) AS real FROM d"))
def deflated_sales(spark, folder):
    return rounded(rounded(_chain_with_prices(spark, folder), 3, "real"), 9, "cpi")


@query(
    "nominal_and_real_trend",
    on_log(
        _CHAIN_CPI + """ SELECT kind, round(regr_slope(v, t), 4) AS slope, round(regr_slope(v, t) * 52 * 100 / AVG(v), 6) AS pct_per_year,
        round(regr_r2(v, t), 9) AS r_squared FROM (SELECT t, 'nominal' AS kind, y AS v FROM d UNION ALL SELECT t, 'real', real FROM d) GROUP BY 1"""
    ),
)
def nominal_and_real_trend(spark, folder):
    chain = _chain_with_prices(spark, folder)
    both = chain.select(
        "ds", F.inline(F.array(
            F.struct(F.lit("nominal").alias("kind"), F.col("y").alias("y")),
            F.struct(F.lit("real").alias("kind"), F.col("real").alias("y")),
        ))
    )
    line = diagnostics.trend_test(both, ["kind"]).drop("p_value", "significant")
    return rounded(rounded(rounded(line, 4, "slope"), 6, "pct_per_year"), 9, "r_squared")


@query(
    "trend_test",
    on_cells(
        """SELECT "Store", round(regr_slope(y, pos - 1), 4) AS slope, round(regr_slope(y, pos - 1) * 52 * 100 / AVG(y), 6) AS pct_per_year,
        round(regr_r2(y, pos - 1), 9) AS r_squared FROM ranked GROUP BY 1""",
        RANKED,
    ),
)
def trend_test(spark, folder):
    line = diagnostics.trend_test(t.store_series(spark, folder), ["Store"]).drop("p_value", "significant")
    return rounded(rounded(rounded(line, 4, "slope"), 6, "pct_per_year"), 9, "r_squared")


# Two-sided p of Student's t with a whole number of degrees of freedom, by its finite series in cos^2.
_STUDENT = """, fits AS (
    SELECT "Store", "Dept", regr_slope(y, pos - 1) AS slope, regr_slope(y, pos - 1) * 5200 / NULLIF(AVG(y), 0) AS pct,
      regr_r2(y, pos - 1) AS r2, COUNT(*) - 2 AS df
    FROM (SELECT *, row_number() OVER (PARTITION BY "Store", "Dept" ORDER BY ds) AS pos FROM dept_series) GROUP BY 1, 2),
  angles AS (SELECT *, 1 - r2 AS c2, sqrt(r2) AS s, atan2(sqrt(r2), sqrt(1 - r2)) AS theta FROM fits WHERE df > 0 AND r2 < 1),
  terms AS (SELECT a."Store", a."Dept", j, CASE WHEN df % 2 = 1 THEN CASE j WHEN 1 THEN 1.0 ELSE (2.0 * j - 2) / (2 * j - 1) END
        ELSE CASE j WHEN 1 THEN 1.0 ELSE (2.0 * j - 3) / (2 * j - 2) END END * CASE j WHEN 1 THEN 1.0 ELSE c2 END AS f
    FROM angles a, (SELECT UNNEST(range(1, 2000)) AS j) WHERE j <= CASE WHEN df % 2 = 1 THEN (df - 1) // 2 ELSE df // 2 END),
  sums AS (SELECT "Store", "Dept", SUM(p) AS total FROM (
      SELECT "Store", "Dept", product(f) OVER (PARTITION BY "Store", "Dept" ORDER BY j) AS p FROM terms) GROUP BY 1, 2),
  ps AS (SELECT "Store", "Dept", greatest(0.0, 1 - CASE WHEN df % 2 = 1
        THEN 2 / pi() * (theta + s * sqrt(c2) * COALESCE(total, 0)) ELSE s * COALESCE(total, 0) END) AS p
    FROM angles LEFT JOIN sums USING ("Store", "Dept"))
  SELECT "Store", "Dept", round(slope, 4) AS slope, round(pct, 6) AS pct_per_year,
    round(CASE WHEN r2 >= 1 THEN 0.0 ELSE p END, 6) AS p_value, round(r2, 9) AS r_squared,
    CASE WHEN r2 >= 1 THEN true ELSE p < 0.05 END AS significant
  FROM fits LEFT JOIN ps USING ("Store", "Dept")"""


@query("trend_significance", on_cells(_STUDENT))
def trend_significance(spark, folder):
    line = diagnostics.trend_test(t.dept_series(spark, folder), ["Store", "Dept"])
    return rounded(rounded(rounded(line, 4, "slope"), 6, "pct_per_year", "p_value"), 9, "r_squared")


def _decomposition(op: str, back: str, series: str, key: str) -> str:
    """SQL of the classical decomposition; ``op`` takes a component out of a row."""
    part = f'PARTITION BY {key}' if key else ""
    pick = f"{key}, " if key else ""
    phase = f'PARTITION BY {pick}p'
    return f""", m AS (
        SELECT {pick}ds, y, row_number() OVER ({part} ORDER BY ds) - 1 AS t, COUNT(*) OVER ({part}) AS n,
          CASE WHEN COUNT(y) OVER ({part} ORDER BY ds ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) = 53 AND COUNT(*) OVER ({part}) >= 104 THEN
            (SUM(y) OVER ({part} ORDER BY ds ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)
             - 0.5 * (lag(y, 26) OVER ({part} ORDER BY ds) + lead(y, 26) OVER ({part} ORDER BY ds))) / 52 END AS trend
        FROM {series}),
      dt AS (SELECT *, t % 52 AS p, y {op} trend AS d FROM m),
      fig AS (SELECT *, AVG(d) OVER ({phase}) AS f FROM dt),
      parts AS (SELECT {pick}ds, y AS observed, trend, f {op} AVG(CASE WHEN t < 52 THEN f END) OVER ({part}) AS seasonal, d FROM fig)
      , parts2 AS (SELECT {pick}ds, observed, trend, seasonal, d {op} seasonal AS residual FROM parts)"""


@query(
    "decompose_additive",
    on_cells(
        _decomposition("-", "+", "chain_series", "")
        + " SELECT ds, observed, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal, round(residual, 3) AS residual FROM parts2"
    ),
)
def decompose_additive(spark, folder):
    return rounded(diagnostics.decompose(t.chain_series(spark, folder)), 3, "trend", "seasonal", "residual")


@query(
    "decompose_multiplicative_store",
    on_cells(
        _decomposition("/", "*", "store_series", '"Store"')
        + ' SELECT "Store", ds, observed, round(trend, 1) AS trend, round(seasonal, 8) AS seasonal, round(residual, 8) AS residual FROM parts2'
    ),
)
def decompose_multiplicative_store(spark, folder):
    parts = diagnostics.decompose(t.store_series(spark, folder), ["Store"], model="multiplicative")
    return rounded(rounded(parts, 1, "trend"), 8, "seasonal", "residual")


_STRENGTH = """ SELECT "Store", round(greatest(0, 1 - var_samp(residual) / NULLIF(var_samp(seasonal + residual), 0)), 8) AS seasonal_strength,
  round(greatest(0, 1 - var_samp(residual) / NULLIF(var_samp(trend + residual), 0)), 8) AS trend_strength
  FROM parts2 WHERE residual IS NOT NULL GROUP BY 1"""


@query("seasonal_strength", on_cells(_decomposition("-", "+", "store_series", '"Store"') + _STRENGTH))
def seasonal_strength(spark, folder):
    parts = diagnostics.decompose(t.store_series(spark, folder), ["Store"])
    return rounded(diagnostics.strength(parts, ["Store"]), 8, "seasonal_strength", "trend_strength")


@query(
    "component_swing",
    on_cells(
        _decomposition("-", "+", "store_series", '"Store"')
        + """ SELECT "Store", round(MAX(seasonal) - MIN(seasonal), 3) AS seasonal_swing, round(MAX(trend) - MIN(trend), 3) AS trend_swing,
        round((MAX(seasonal) - MIN(seasonal)) / NULLIF(MAX(trend) - MIN(trend), 0), 6) AS swing_ratio, round(stddev_samp(residual), 3) AS residual_std
        FROM parts2 GROUP BY 1"""
    ),
)
def component_swing(spark, folder):
    parts = diagnostics.decompose(t.store_series(spark, folder), ["Store"])
    swing = diagnostics.component_swing(parts, ["Store"])
    return rounded(rounded(swing, 3, "seasonal_swing", "trend_swing", "residual_std"), 6, "swing_ratio")


_ACF = """, dev AS (SELECT "Store", pos, y - AVG(y) OVER (PARTITION BY "Store") AS d, COUNT(*) OVER (PARTITION BY "Store") AS n FROM ranked),
  lags AS (SELECT UNNEST(range(0, 61)) AS lag),
  acf AS (SELECT a."Store", lag, SUM(a.d * b.d) / (SELECT NULLIF(SUM(d * d), 0) FROM dev z WHERE z."Store" = a."Store") AS acf, MAX(a.n) AS n
    FROM dev a, lags, dev b WHERE b."Store" = a."Store" AND b.pos = a.pos + lag GROUP BY 1, 2)"""


@query(
    "autocorrelation",
    on_cells(
        _ACF + """ SELECT s."Store", CAST(l.lag AS INTEGER) AS lag, round(acf, 9) AS acf, round(1.96 / sqrt(s.n), 9) AS band
        FROM (SELECT "Store", MAX(n) AS n FROM dev GROUP BY 1) s CROSS JOIN lags l LEFT JOIN acf ON acf."Store" = s."Store" AND acf.lag = l.lag""",
        RANKED,
    ),
)
def autocorrelation(spark, folder):
    table = diagnostics.autocorrelation(t.store_series(spark, folder), ["Store"]).drop("pacf")
    return rounded(table, 9, "acf", "band")


# Durbin-Levinson step by step: phi holds the coefficients of the last order.
_PACF = """, size AS (SELECT "Store", MAX(n) AS n FROM dev GROUP BY 1),
  known AS (SELECT s."Store", s.n, list(acf * s.n / (s.n - lag) ORDER BY lag) AS rho
    FROM acf JOIN size s USING ("Store") WHERE acf IS NOT NULL GROUP BY 1, 2),
  steps AS (
    SELECT "Store", n, rho, 1 AS k, [rho[2]] AS phi FROM known WHERE least(60, n // 2 - 1, len(rho) - 1) >= 1
    UNION ALL
    SELECT "Store", n, rho, k + 1, list_append(list_transform(list_zip(phi, list_reverse(phi)), lambda z: z[1] - last * z[2]), last)
    FROM (SELECT *, (rho[k + 2] - list_dot_product(phi, list_reverse(rho[2:k + 1])))
        / (1 - list_dot_product(phi, rho[2:k + 1])) AS last FROM steps)
    WHERE k + 1 <= least(60, n // 2 - 1, len(rho) - 1))
  SELECT s."Store", CAST(l.lag AS INTEGER) AS lag,
    CASE WHEN l.lag = 0 THEN CASE WHEN s.n // 2 - 1 >= 0 THEN 1.0 END ELSE round(steps.phi[l.lag], 6) END AS pacf
  FROM size s CROSS JOIN lags l LEFT JOIN steps ON steps."Store" = s."Store" AND steps.k = l.lag"""


@query("partial_autocorrelation", on_cells(_ACF + _PACF, RANKED))
def partial_autocorrelation(spark, folder):
    table = diagnostics.autocorrelation(t.store_series(spark, folder), ["Store"]).select("Store", "lag", "pacf")
    return rounded(table, 6, "pacf")


def _unit_root_sql(series: str) -> str:
    return (
        f""", ur_y AS (SELECT "Store", y, row_number() OVER (PARTITION BY "Store" ORDER BY ds) - 1 AS t, COUNT(*) OVER (PARTITION BY "Store") AS n FROM {series}),"""
        + solve_sql.unit_root('"Store"', "ur_y")
        + """ SELECT "Store", round(statistic, 6) AS statistic, round(p, 6) AS p_value, lags AS lags_used, n_obs::BIGINT AS n_obs, p < 0.05 AS stationary, 'ok' AS status FROM adf"""
    )


def _unit_roots(series):
    report = diagnostics.adf_report(series, ["Store"])
    return rounded(report.select("Store", "statistic", "p_value", "lags_used", "n_obs", "stationary", "status"), 6, "statistic", "p_value")


@query("unit_root_store", on_cells(_unit_root_sql("store_series")))
def unit_root_store(spark, folder):
    return _unit_roots(t.store_series(spark, folder))


@query(
    "unit_root_differenced",
    on_cells(
        """, steps AS (SELECT "Store", ds, d AS y FROM (SELECT "Store", ds, y - lag(y) OVER (PARTITION BY "Store" ORDER BY ds) AS d FROM store_series) WHERE d IS NOT NULL)"""
        + _unit_root_sql("steps")
    ),
)
def unit_root_differenced(spark, folder):
    return _unit_roots(diagnostics.difference(t.store_series(spark, folder), ["Store"]))


_GRID = """, g AS (SELECT "Store", "Dept", ds, ds - lag(ds) OVER (PARTITION BY "Store", "Dept" ORDER BY ds) AS gap FROM dept_series),
  gc AS (SELECT "Store", "Dept", gap, COUNT(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2, 3),
  gm AS (SELECT "Store", "Dept", COUNT(*) AS kinds, arg_max(gap, n * 100000 - gap) AS gap FROM gc GROUP BY 1, 2),
  grid AS (SELECT d."Store", d."Dept", COUNT(*) AS n, MIN(ds) AS start, MAX(ds) AS "end" FROM dept_series d GROUP BY 1, 2)"""


@query(
    "grid_check",
    on_cells(
        _GRID + """ SELECT "Store", "Dept", n, start, "end", COALESCE(kinds, 0) = 1 AS regular_grid, CAST(COALESCE(gap, 0) AS INTEGER) AS step_days
        FROM grid LEFT JOIN gm USING ("Store", "Dept")"""
    ),
)
def grid_check(spark, folder):
    return diagnostics.grid_check(t.dept_series(spark, folder), ["Store", "Dept"])


@query(
    "suitability",
    on_cells(
        _decomposition("-", "+", "store_series", '"Store"') + ", st AS (" + _STRENGTH + ")"
        + _ACF + """, g AS (SELECT "Store", ds - lag(ds) OVER (PARTITION BY "Store" ORDER BY ds) AS gap FROM store_series),
          gc AS (SELECT "Store", gap, COUNT(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2),
          gm AS (SELECT "Store", COUNT(*) AS kinds, arg_max(gap, n * 100000 - gap) AS gap FROM gc GROUP BY 1),
          tr AS (SELECT "Store", COUNT(*) AS n, MIN(ds) AS start, MAX(ds) AS "end", regr_slope(y, pos - 1) * 52 * 100 / AVG(y) AS pct, regr_r2(y, pos - 1) AS r2 FROM ranked GROUP BY 1),
          ac AS (SELECT "Store", MAX(acf) FILTER (WHERE lag = 52) AS acf52, arg_max(lag, acf) FILTER (WHERE lag > 2) AS strongest FROM acf GROUP BY 1),
          ur_y AS (SELECT "Store", y, pos - 1 AS t, COUNT(*) OVER (PARTITION BY "Store") AS n FROM ranked),
          drawn AS (SELECT "Store", r2, n - 2 AS df FROM tr),"""
        + solve_sql.unit_root('"Store"', "ur_y") + "," + solve_sql.student_p("tp", "drawn", '"Store"')
        + """
        SELECT "Store", tr.n, start, "end", kinds = 1 AS regular_grid, CAST(gap AS INTEGER) AS step_days, round(tr.n / 52, 6) AS cycles,
          round(pct, 6) AS trend_pct_per_year, round(tp.p, 6) AS trend_p_value, tp.p < 0.05 AS trend_significant, round(r2, 9) AS trend_r_squared,
          seasonal_strength, trend_strength, round(adf.p, 6) AS adf_p_value, adf.p < 0.05 AS stationary, round(acf52, 9) AS acf_at_period, CAST(strongest AS INTEGER) AS strongest_lag
        FROM tr LEFT JOIN gm USING ("Store") LEFT JOIN st USING ("Store") LEFT JOIN ac USING ("Store") LEFT JOIN tp USING ("Store") LEFT JOIN adf USING ("Store")""",
        RANKED,
    ),
)
def suitability(spark, folder):
    """All sixteen fields of the report for every store."""
    report = diagnostics.suitability_report(t.store_series(spark, folder), ["Store"])
    report = rounded(report, 6, "cycles", "trend_pct_per_year", "trend_p_value", "adf_p_value")
    report = rounded(report, 9, "trend_r_squared", "acf_at_period")
    return rounded(report, 8, "seasonal_strength", "trend_strength")


@query(
    "earliest_testable",
    on_cells("""SELECT "Store", MAX(ds) FILTER (WHERE pos = 105) AS earliest_testable FROM ranked GROUP BY 1""", RANKED),
)
def earliest_testable(spark, folder):
    return diagnostics.earliest_testable(t.store_series(spark, folder), ["Store"])


@query("christmas_weeks", on_cells("SELECT ds, y FROM chain_series WHERE weekofyear(ds) IN (51, 52)"))
def christmas_weeks(spark, folder):
    return diagnostics.christmas_weeks(t.chain_series(spark, folder))


@query(
    "quiet_and_christmas_windows",
    on_cells(
        """, starts AS (SELECT "Store", MAX(pos - 1 - 6) AS s FROM ranked WHERE weekofyear(ds) IN (51, 52) AND pos - 1 - 6 > 52 GROUP BY 1),
        seas AS (SELECT *, lag(y, 52) OVER (PARTITION BY "Store" ORDER BY ds) AS yhat FROM ranked),
        x AS (SELECT seas."Store", 100 * AVG(abs((y - yhat) / y)) AS mape FROM seas JOIN starts USING ("Store") WHERE pos - 1 >= s AND pos - 1 < s + 13 AND y > 0 GROUP BY 1),
        q AS (SELECT "Store", 100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) AS mape FROM seas WHERE rev <= 13 AND yhat IS NOT NULL AND "Store" IN (SELECT "Store" FROM ranked GROUP BY 1 HAVING COUNT(*) >= 65) GROUP BY 1)
        SELECT "Store", round(q.mape, 6) AS quiet_mape, round(x.mape, 6) AS christmas_mape, round(x.mape / NULLIF(q.mape, 0), 6) AS ratio
        FROM q JOIN x USING ("Store")""",
        RANKED,
    ),
)
def quiet_and_christmas_windows(spark, folder):
    series = t.store_series(spark, folder)

    def scored(split, name):
        rows = baselines.score_baselines(split, ["Store"]).filter(F.col("model") == "seasonal_naive")
        return metrics.forecast_metrics(rows.filter(F.col("yhat").isNotNull()), ["Store"]).select(
            "Store", F.col("mape").alias(name)
        )

    quiet = scored(splits.hold_out_rows(series, ["Store"]), "quiet_mape")
    festive = scored(diagnostics.christmas_window(series, ["Store"]), "christmas_mape")
    both = quiet.join(festive, ["Store"]).withColumn("ratio", F.try_divide("christmas_mape", "quiet_mape"))
    return rounded(both, 6, "quiet_mape", "christmas_mape", "ratio")


@query(
    "interpolate_gaps",
    on_cells(
        """, weeks AS (SELECT DISTINCT ds FROM dept_series), keys AS (SELECT DISTINCT "Store", "Dept" FROM dept_series),
        full_grid AS (SELECT k."Store", k."Dept", w.ds, d.y, row_number() OVER (PARTITION BY k."Store", k."Dept" ORDER BY w.ds) AS pos
          FROM keys k CROSS JOIN weeks w LEFT JOIN dept_series d ON d."Store" = k."Store" AND d."Dept" = k."Dept" AND d.ds = w.ds),
        near AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY "Store", "Dept" ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
            first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY "Store", "Dept" ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
            last_value(y IGNORE NULLS) OVER (PARTITION BY "Store", "Dept" ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
            first_value(y IGNORE NULLS) OVER (PARTITION BY "Store", "Dept" ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1 FROM full_grid)
        SELECT "Store", "Dept", ds, COALESCE(y, y0 + (y1 - y0) * (CAST(pos - p0 AS DOUBLE) / NULLIF(p1 - p0, 0)), y0) AS y
        FROM near WHERE p0 IS NOT NULL AND ds >= DATE '1997-01-01'"""
    ),
)
def interpolate_gaps(spark, folder):
    """Missing weeks of the department series filled in, from 1997 on."""
    series = t.dept_series(spark, folder)
    # The calendar is at most one row per week; the grid is series times weeks by intent.
    weeks = series.agg(F.array_sort(F.collect_set("ds")).alias("weeks")).scalar()
    grid = series.select("Store", "Dept").distinct().withColumn("ds", F.explode(weeks))
    full = grid.join(series, ["Store", "Dept", "ds"], "left")
    return diagnostics.interpolate_gaps(full, ["Store", "Dept"], start="1997-01-01")


_SES = """, alphas AS (SELECT UNNEST([0.2, 0.4, 0.8]::DOUBLE[]) AS alpha),
  ses AS (SELECT "Store", pos, ds, y, alpha, y AS yhat FROM ranked, alphas WHERE pos = 1
    UNION ALL SELECT r."Store", r.pos, r.ds, r.y, s.alpha, s.alpha * s.y + (1 - s.alpha) * s.yhat
    FROM ses s JOIN ranked r ON r."Store" = s."Store" AND r.pos = s.pos + 1)"""


@query(
    "simple_smoothing",
    on_cells(_SES + ' SELECT "Store", ds, CAST(pos - 1 AS INTEGER) AS t, y, alpha, round(yhat, 4) AS yhat FROM ses', RANKED),
)
def simple_smoothing(spark, folder):
    return rounded(smoothing.simple_smoothing(t.store_series(spark, folder), ["Store"], (0.2, 0.4, 0.8)), 4, "yhat")


@query("smoothing_alpha_table", on_cells(_SES + f" SELECT alpha, {ERRORS} FROM ses WHERE pos > 1 GROUP BY 1", RANKED))
def smoothing_alpha_table(spark, folder):
    paths = smoothing.simple_smoothing(t.store_series(spark, folder), ["Store"], (0.2, 0.4, 0.8))
    return _errors(metrics.forecast_metrics(paths.filter(F.col("t") >= 1), ["alpha"]))


_TRAIN = """, hold AS (SELECT "Store", pos, y FROM ranked WHERE rev > 13),
  tested AS (SELECT "Store", ds, y, row_number() OVER (PARTITION BY "Store" ORDER BY ds) AS step FROM ranked WHERE rev <= 13),"""
_FORECAST = """ds, CAST(step AS INTEGER) AS step, y, round(yhat, 2) AS yhat, 'multi_step' AS horizon_kind,
  CASE WHEN yhat IS NULL THEN 'short_history' ELSE 'ok' END AS status"""
_HOLT = _TRAIN + solve_sql.holt_winters("hold") + """, ahead AS (SELECT tested.*, level + slope * step + season[step] AS yhat FROM tested LEFT JOIN hw_best USING ("Store"))"""


def _held_out(spark, folder):
    """The split series, written once: fits, test rows and their number all read it."""
    return cut_lineage(splits.hold_out_rows(t.store_series(spark, folder), ["Store"]))


@query("holt_winters_per_store", on_cells(_HOLT + f""" SELECT "Store", 'holt_winters' AS model, {_FORECAST} FROM ahead""", RANKED))
def holt_winters_per_store(spark, folder):
    return rounded(smoothing.holt_winters_forecast(_held_out(spark, folder), ["Store"]), 2, "yhat")


@query(
    "holt_winters_store_score",
    on_cells(
        _HOLT + """ SELECT 'holt_winters' AS model, round(100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END), 5) AS mape,
        COUNT(DISTINCT "Store") FILTER (yhat IS NOT NULL)::BIGINT AS fitted, COUNT(DISTINCT "Store") FILTER (yhat IS NULL)::BIGINT AS opted_out FROM ahead""",
        RANKED,
    ),
)
def holt_winters_store_score(spark, folder):
    forecasts = smoothing.holt_winters_forecast(_held_out(spark, folder), ["Store"])
    return rounded(per_series_score(forecasts, ["Store"]), 5, "mape")


@query(
    "holt_winters_parts",
    on_cells(
        """, hold AS (SELECT "Store", pos, y FROM ranked),""" + solve_sql.holt_winters("hold")
        + """ SELECT "Store", alpha, beta, gamma, round(level, 2) AS last_level, round(slope, 4) AS trend_per_week,
        round(slope * 5200 / level, 5) AS trend_pct_per_year, len(v)::BIGINT AS weeks FROM hw_best""",
        RANKED,
    ),
)
def holt_winters_parts(spark, folder):
    """The weights, the last level and the trend of every store, and how many weeks have parts."""
    parts = smoothing.holt_winters_parts(t.store_series(spark, folder), ["Store"])
    table = parts.groupBy("Store", "alpha", "beta", "gamma", "last_level", "trend_per_week", "trend_pct_per_year").agg(F.count("fitted").alias("weeks"))
    return rounded(rounded(rounded(table, 2, "last_level"), 4, "trend_per_week"), 5, "trend_pct_per_year")


_ARMA = _TRAIN + solve_sql.seasonal_arma("hold")


@query(
    "sarima_per_store",
    on_cells(
        _ARMA + f""" SELECT "Store", 'seasonal_arma' AS model, {_FORECAST} FROM (
          SELECT tested.*, ahead AS yhat FROM tested LEFT JOIN ar_go ON ar_go."Store" = tested."Store" AND h = step)""",
        RANKED,
    ),
)
def sarima_per_store(spark, folder):
    return rounded(arma.arma_forecast(_held_out(spark, folder), ["Store"]), 2, "yhat")


@query(
    "sarima_coefficients",
    on_cells(
        _ARMA + """ SELECT "Store", name, round(b[k], 6) AS value FROM ar_z_b,
          (SELECT UNNEST(['value 1', 'error 1', 'error 52', 'error 53']) AS name, UNNEST([1, 2, 3, 4]) AS k)""",
        RANKED,
    ),
)
def sarima_coefficients(spark, folder):
    """Coefficients of the lagged value and the lagged errors of every store."""
    _, fits = arma.fit_arma(_held_out(spark, folder).where("NOT is_test"), ["Store"])
    names = F.array(*[F.lit(n) for n in ("value 1", "error 1", "error 52", "error 53")])
    return rounded(fits.select("Store", F.inline(F.arrays_zip(names.alias("name"), F.col("beta").alias("value")))), 6, "value")


def _all_models(split, keys):
    """Forecasts of the baselines, of Holt-Winters and of the seasonal regression, one table."""
    split = cut_lineage(split)
    copies = baselines.score_baselines(split, keys).where(F.col("model").isin("naive", "seasonal_naive", "seasonal_naive_growth"))
    columns = [*keys, "model", "ds", "y", "yhat", "status"]
    parts = [copies, smoothing.holt_winters_forecast(split, keys), arma.arma_forecast(split, keys)]
    first, *rest = [p.select(*columns) for p in parts]
    for part in rest:
        first = first.unionByName(part)
    return first


@query("forecaster_tournament")
def forecaster_tournament(spark, folder):
    """Four forecasters over three folds of every store, summarised per model."""
    forecasts = _all_models(store_folds(spark, folder), ["Store", "fold"]).where(F.col("model") != "naive")
    return metrics.fold_summary(metrics.forecast_metrics(forecasts, ["model", "fold"]))


@query(
    "forecaster_comparison",
    on_cells(
        """, ranked AS (SELECT 1 AS "Store", *, row_number() OVER (ORDER BY ds DESC) AS rev, row_number() OVER (ORDER BY ds) AS pos FROM chain_series)"""
        + _TRAIN + solve_sql.holt_winters("hold") + "," + solve_sql.seasonal_arma("hold")
        + f""", before AS (SELECT pos, y, lag(y, 52) OVER (ORDER BY pos) AS back FROM hold),
          grown AS (SELECT SUM(y) / NULLIF(SUM(back), 0) AS g FROM (SELECT * FROM before ORDER BY pos DESC LIMIT 13)),
          seas AS (SELECT ds, y, lag(y, 52) OVER (ORDER BY ds) AS copy, step FROM ranked LEFT JOIN (SELECT ds, step FROM tested) USING (ds)),
          long AS (
            SELECT 'naive' AS model, y, (SELECT arg_max(y, pos) FROM hold) AS yhat FROM tested
            UNION ALL SELECT 'seasonal_naive', y, copy FROM seas WHERE step IS NOT NULL
            UNION ALL SELECT 'seasonal_naive_growth', y, copy * (SELECT g FROM grown) FROM seas WHERE step IS NOT NULL
            UNION ALL SELECT 'holt_winters', y, level + slope * step + season[step] FROM tested JOIN hw_best USING ("Store")
            UNION ALL SELECT 'seasonal_arma', tested.y, ahead FROM tested JOIN ar_go ON h = step)
        SELECT model, round(100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END), 5) AS mape FROM long GROUP BY 1""",
    ),
)
def forecaster_comparison(spark, folder):
    """All models side by side on the chain's last quarter."""
    split = splits.hold_out_rows(t.chain_series(spark, folder))
    return rounded(metrics.metrics_table(_all_models(split, [])).select("model", "mape"), 5, "mape")


def _calendars(spark, folder):
    """Three candidate calendars under one column: own, plus national, plus Easter."""
    own = calendar.trading_holidays(spark, *t.calendar_years(spark, folder))
    national = calendar.national_holidays(spark, *t.calendar_years(spark, folder))
    grid = calendar.weekly_grid(t.chain_series(spark, folder), ahead_weeks=60)
    return (
        own.withColumn("calendar", F.lit("own"))
        .unionByName(own.unionByName(national).withColumn("calendar", F.lit("own+national")))
        .unionByName(calendar.with_easter(own, grid).withColumn("calendar", F.lit("own+easter")))
    )


def _chain_split_with_effects(spark, folder):
    split = splits.hold_out_rows(t.chain_series(spark, folder))
    return additive.with_effects(split, calendar.trading_holidays(spark, *t.calendar_years(spark, folder)))


_ADDITIVE = "," + solve_sql.additive_fit([0.05])
_WIDE = 1.959963984540054


@query(
    "additive_chain",
    on_cells(
        _ADDITIVE + f""" SELECT ds, is_test, round(y, 2) AS y, round(trend + yearly + holidays, 1) AS yhat,
          round(trend + yearly + holidays - {_WIDE} * factor * sqrt(noise + drift), 1) AS yhat_lo,
          round(trend + yearly + holidays + {_WIDE} * factor * sqrt(noise + drift), 1) AS yhat_hi,
          round(trend, 1) AS trend, round(yearly, 1) AS yearly, round(holidays, 1) AS holidays, 'ok' AS status FROM ad"""
    ),
)
def additive_chain(spark, folder):
    """History, 13 test weeks, interval and components of the chain."""
    fitted = additive.additive_forecast(_chain_split_with_effects(spark, folder)).drop("trend_lo", "trend_hi")
    return rounded(rounded(fitted, 2, "y"), 1, "yhat", "yhat_lo", "yhat_hi", "trend", "yearly", "holidays")


@query("additive_future")
def additive_future(spark, folder):
    """Thirteen weeks beyond the data for every store."""
    rows = additive.extend_rows(t.store_series(spark, folder), ["Store"], 13)
    holidays = calendar.trading_holidays(spark, *t.calendar_years(spark, folder))
    fitted = additive.additive_forecast(additive.with_effects(rows, holidays), ["Store"])
    return additive.forecast_for_dates(fitted.filter("is_test"), rows.filter("is_test"))


@query(
    "additive_components",
    on_cells(_ADDITIVE + """ SELECT ds, component, round(value, 1) AS value FROM (
      SELECT ds, 'trend' AS component, trend AS value FROM ad UNION ALL SELECT ds, 'yearly', yearly FROM ad UNION ALL SELECT ds, 'holidays', holidays FROM ad)"""),
)
def additive_components(spark, folder):
    return rounded(additive.components_long(additive.additive_forecast(_chain_split_with_effects(spark, folder))), 1, "value")


@query(
    "additive_changepoints",
    on_cells(_ADDITIVE + f" SELECT spot AS ds, round(beta[2 + nr], 6) AS delta FROM ad_knots JOIN ad_r{additive.ROUNDS} USING (one)"),
)
def additive_changepoints(spark, folder):
    return rounded(additive.additive_changepoints(_chain_split_with_effects(spark, folder)), 6, "delta")


@query("additive_coverage")
def additive_coverage(spark, folder):
    fitted = additive.additive_forecast(_chain_split_with_effects(spark, folder)).filter("is_test")
    return metrics.interval_coverage(fitted.withColumn("model", F.lit("additive")))


@query(
    "additive_prior_sweep",
    on_cells(
        "," + solve_sql.additive_fit([0.01, 0.05, 0.5])
        + """ SELECT scale AS prior_scale, COUNT(*) AS n, round(100 * AVG(CASE WHEN y > 0 THEN abs((y - trend - yearly - holidays) / y) END), 5) AS mape,
          round((arg_max(trend, ds) / arg_min(trend, ds) - 1) * 100, 5) AS trend_drift_pct FROM ad WHERE is_test GROUP BY 1"""
    ),
)
def additive_prior_sweep(spark, folder):
    """Three prior scales from one matrix: error, and trend drift over the horizon."""
    fitted = additive.additive_forecast(_chain_split_with_effects(spark, folder), prior_scale=[0.01, 0.05, 0.5]).filter("is_test")
    drift = diagnostics.growth(fitted, ["prior_scale"], y="trend").select(
        "prior_scale", F.col("growth_pct").alias("trend_drift_pct")
    )
    table = metrics.forecast_metrics(fitted, ["prior_scale"]).join(drift, ["prior_scale"])
    return rounded(table.select("prior_scale", "n", "mape", "trend_drift_pct"), 5, "mape", "trend_drift_pct")


@query("additive_holiday_effects", on_cells(_ADDITIVE + " SELECT ds, round(holidays, 1) AS holidays FROM ad ORDER BY abs(round(ad.holidays, 3)) DESC, ds LIMIT 5"))
def additive_holiday_effects(spark, folder):
    fitted = additive.additive_forecast(_chain_split_with_effects(spark, folder))
    return rounded(additive.largest_effects(rounded(fitted, 3, "holidays")), 1, "holidays")


def _calendar_fits(spark, folder):
    chain = splits.rolling_origin(t.chain_series(spark, folder))
    calendars = _calendars(spark, folder)
    names = F.array(*[F.lit(n) for n in ("own", "own+national", "own+easter")])
    rows = chain.withColumn("calendar", F.explode(names))
    rows = additive.with_effects(rows, calendars, ["calendar", "ds"])
    return additive.additive_forecast(rows, ["fold", "calendar"]).filter("is_test")


@query("calendar_comparison")
def calendar_comparison(spark, folder):
    """Which calendar helps: error per fold and calendar, all fits in one job."""
    return metrics.forecast_metrics(_calendar_fits(spark, folder), ["calendar", "fold"])


@query("calendar_easter_miss")
def calendar_easter_miss(spark, folder):
    """The Easter week's miss under each calendar, in the folds that contain one."""
    chain = t.chain_series(spark, folder)
    events = calendar.calendar_events(chain, calendar.trading_holidays(spark, *t.calendar_years(spark, folder)))
    table = misses.explain_misses(_calendar_fits(spark, folder), events, ["fold", "calendar"])
    return table.filter(F.col("event_this_year").contains("Easter"))
