"""Queries over the sales log: grains, calendar, features, splits, baselines, errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.dates import week_ending
from tidemark.operators import baselines, calendar, features, grains, metrics, misses, splits
from tidemark.plans import tables as t
from tidemark.plans.oracle import EASTER, on_cells, on_log
from tidemark.plans.registry import query, rounded
from tidemark.runtime import cut_lineage
from tidemark.sources import sales_files

EXTERNALS = list(sales_files.EXTERNALS)

# Splits and forecasts as SQL, shared by the checks below.
RANKED = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY "Store" ORDER BY ds DESC) AS rev,
  row_number() OVER (PARTITION BY "Store" ORDER BY ds) AS pos FROM store_series),
folds AS (
  SELECT ranked.*, fold, rev <= (3 - fold) * 13 + 13 AS is_test
  FROM ranked, (SELECT UNNEST([1, 2, 3]) AS fold) WHERE rev > (3 - fold) * 13),
train AS (SELECT *, row_number() OVER (PARTITION BY "Store", fold ORDER BY ds DESC) AS back,
  COUNT(*) OVER (PARTITION BY "Store", fold) AS n FROM folds WHERE NOT is_test),
test AS (SELECT *, row_number() OVER (PARTITION BY "Store", fold ORDER BY ds) AS step FROM folds WHERE is_test),
facts AS (SELECT "Store", fold, AVG(y) AS mean, MAX(y) FILTER (WHERE back = 1) AS last,
  SUM(y) FILTER (WHERE back <= 13) AS recent, SUM(y) FILTER (WHERE back > 52 AND back <= 65) AS before,
  MAX(n) AS n FROM train GROUP BY 1, 2),
seasonal AS (SELECT "Store", fold, 53 - back AS step, y FROM train WHERE back BETWEEN 40 AND 52 AND n >= 52),
predicted AS (
  SELECT test."Store", test.fold, test.ds, test.step, test.y, model,
    CASE model WHEN 'naive' THEN last WHEN 'mean' THEN mean WHEN 'seasonal_naive' THEN seasonal.y
      ELSE CASE WHEN n >= 65 THEN seasonal.y * recent / NULLIF(before, 0) END END AS yhat
  FROM test JOIN facts USING ("Store", fold) LEFT JOIN seasonal USING ("Store", fold, step),
    (SELECT UNNEST(['naive', 'mean', 'seasonal_naive', 'seasonal_naive_growth']) AS model)),
errors AS (
  SELECT *, AVG(y) OVER (PARTITION BY "Store", fold, model) AS ybar FROM predicted WHERE yhat IS NOT NULL)"""

ERRORS = """COUNT(*) AS n, round(AVG(abs(y - yhat)), 3) AS mae, round(AVG((y - yhat) * (y - yhat)), 0) AS mse,
  round(sqrt(AVG((y - yhat) * (y - yhat))), 3) AS rmse,
  round(100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END), 6) AS mape,
  round(1 - SUM((y - yhat) * (y - yhat)) / NULLIF(var_pop(y) * COUNT(*), 0), 6) AS r2"""


def _errors(df):
    df = rounded(df, 6, "mape", "r2")
    return rounded(rounded(df, 3, "mae", "rmse"), 0, "mse")


def store_folds(spark, folder):
    return splits.rolling_origin(t.store_series(spark, folder), ["Store"])


def fold_forecasts(spark, folder):
    return baselines.score_baselines(store_folds(spark, folder), ["Store", "fold"])


def last_window(spark, folder):
    """Baselines on the last 13 weeks of every store."""
    split = splits.hold_out_rows(t.store_series(spark, folder), ["Store"])
    return baselines.score_baselines(split, ["Store"])


@query(
    "store_baseline_errors",
    on_cells(
        f"""SELECT "Store", {ERRORS} FROM predicted
        WHERE fold = 3 AND model = 'seasonal_naive' AND yhat IS NOT NULL GROUP BY 1""",
        RANKED,
    ),
)
def store_baseline_errors(spark, folder):
    forecasts = last_window(spark, folder).filter(F.col("model") == "seasonal_naive")
    return _errors(metrics.forecast_metrics(forecasts, ["Store"]))


@query(
    "sales_log",
    on_log(
        """SELECT "Store", "Dept", "Date", CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales", "IsHoliday", "Type",
        "Size", round("Temperature", 9) AS "Temperature", round("Fuel_Price", 9) AS "Fuel_Price",
        round("CPI", 9) AS "CPI", round("Unemployment", 9) AS "Unemployment",
        round("MarkDown1", 4) AS "MarkDown1", round("MarkDown2", 4) AS "MarkDown2",
        round("MarkDown3", 4) AS "MarkDown3", round("MarkDown4", 4) AS "MarkDown4",
        round("MarkDown5", 4) AS "MarkDown5" FROM log"""
    ),
)
def sales_log(spark, folder):
    log = t.sales_log(spark, folder).withColumn("Weekly_Sales", F.col("Weekly_Sales").cast("double"))
    log = rounded(log, 9, *EXTERNALS)
    return rounded(log, 4, *sales_files.markdown_columns(log))


@query(
    "cleaning_report",
    on_log(
        """SELECT CAST((SELECT COUNT(*) FROM log) AS BIGINT) AS rows_in,
        (SELECT COUNT(*) FROM log) - COUNT(*) AS dropped, COUNT(*) AS rows_out,
        round(1 - COUNT(*) / (SELECT COUNT(*) FROM log), 6) AS dropped_share,
        COUNT(DISTINCT "Date") AS weeks, COUNT(DISTINCT "Store") AS stores,
        COUNT(DISTINCT ("Store", "Dept")) AS series,
        COUNT(*) FILTER (WHERE COALESCE("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5") IS NULL) AS no_promotion,
        round(COUNT(*) FILTER (WHERE COALESCE("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5") IS NULL) / COUNT(*), 6) AS no_promotion_share
        FROM clean"""
    ),
)
def cleaning_report(spark, folder):
    return rounded(
        sales_files.cleaning_report(t.sales_log(spark, folder)), 6, "dropped_share", "no_promotion_share"
    )


def _grain(df):
    df = df.withColumn("Weekly_Sales", F.col("Weekly_Sales").cast("double"))
    # shifted by less than the last digit: means of equal quotients often end in a tie
    return rounded(df.withColumns({c: F.col(c) + 3e-8 for c in EXTERNALS}), 6, *EXTERNALS)


_EXT = ", ".join(f'round("{c}" + 3e-8, 6) AS "{c}"' for c in EXTERNALS)


@query(
    "grain_chain_total",
    on_log(f'SELECT "Date", CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales", "IsHoliday", {_EXT} FROM chain_full'),
)
def grain_chain_total(spark, folder):
    return _grain(t.full_chain(spark, folder))


@query(
    "grain_chain_total_by_store",
    on_log(
        """SELECT "Date", CAST(SUM("Weekly_Sales") AS DOUBLE) AS "Weekly_Sales", bool_or("IsHoliday") AS "IsHoliday",
        round(AVG("Temperature") + 3e-8, 6) AS "Temperature", round(AVG("Fuel_Price") + 3e-8, 6) AS "Fuel_Price",
        round(AVG("CPI") + 3e-8, 6) AS "CPI", round(AVG("Unemployment") + 3e-8, 6) AS "Unemployment"
        FROM panel_full GROUP BY 1"""
    ),
)
def grain_chain_total_by_store(spark, folder):
    return _grain(grains.chain_total(t.clean_log(spark, folder), by_store=True))


@query(
    "grain_store_panel",
    on_log(
        f"""SELECT "Store", "Date", CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales", "IsHoliday", "Type", "Size", {_EXT}
        FROM panel_full"""
    ),
)
def grain_store_panel(spark, folder):
    return _grain(t.full_store_panel(spark, folder))


@query(
    "grain_dept_panel",
    on_cells('SELECT "Store", "Dept", "Date", CAST("Weekly_Sales" AS DOUBLE) AS "Weekly_Sales", "IsHoliday" FROM cells'),
)
def grain_dept_panel(spark, folder):
    panel = grains.dept_panel(sales_files.clean_sales(t.sales_table(spark, folder)))
    return panel.withColumn("Weekly_Sales", F.col("Weekly_Sales").cast("double"))


@query(
    "prepared_grains",
    on_log(
        """SELECT 'chain' AS grain, COUNT(*) AS "rows", COUNT(DISTINCT "Date") AS weeks, round(SUM("Weekly_Sales"), 2)::DOUBLE AS sales FROM chain_full
        UNION ALL SELECT 'store', COUNT(*), COUNT(DISTINCT "Date"), round(SUM("Weekly_Sales"), 2)::DOUBLE FROM panel_full
        UNION ALL SELECT 'department', COUNT(*), COUNT(DISTINCT "Date"), round(SUM("Weekly_Sales"), 2)::DOUBLE FROM clean"""
    ),
)
def prepared_grains(spark, folder):
    """The three grains that are cut from one cleaned log hold the same weeks and the same sales."""
    chain, stores, depts, _ = grains.prepare(t.sales_log(spark, folder))
    named = {"chain": chain, "store": stores, "department": depts}
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("Date").alias("weeks"), F.sum("Weekly_Sales").alias("sales"))
        .select(F.lit(name).alias("grain"), "rows", "weeks", "sales") for name, df in named.items()
    ]
    return rounded(reduce(lambda a, b: a.unionByName(b), parts), 2, "sales")


@query(
    "chain_as_series",
    on_cells("SELECT ds, y FROM chain_series"),
)
def chain_as_series(spark, folder):
    return t.chain_series(spark, folder)


@query(
    "promotion_coverage",
    on_log(
        """, first AS (SELECT MIN("Date") AS d FROM clean
          WHERE COALESCE("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5") IS NOT NULL)
        SELECT d AS first_recorded, COUNT(*) FILTER (WHERE "Date" < d) AS weeks_without, COUNT(*) AS weeks,
          round(COUNT(*) FILTER (WHERE "Date" < d) / COUNT(*), 6) AS share_without
        FROM chain_full, first GROUP BY d"""
    ),
)
def promotion_coverage(spark, folder):
    log = t.clean_log(spark, folder)
    return rounded(sales_files.promotion_coverage(log, log), 6, "share_without")


@query(
    "holiday_summary",
    on_cells(
        """SELECT holiday, COUNT(*) AS dates, MIN(ds) AS first, MAX(ds) AS last
        FROM holidays SEMI JOIN chain_series USING (ds) GROUP BY 1"""
    ),
)
def holiday_summary(spark, folder):
    """Holidays that fall on a week the log covers."""
    holidays = calendar.trading_holidays(spark, *t.calendar_years(spark, folder))
    covered = holidays.join(t.clean_cells(spark, folder).select(F.col("Date").alias("ds")), ["ds"], "left_semi")
    return calendar.holiday_summary(covered)


@query("easter_weeks", on_cells("SELECT ds, 'Easter' AS holiday FROM easter_weeks", EASTER))
def easter_weeks(spark, folder):
    return calendar.easter_weeks(t.chain_series(spark, folder))


@query("calendar_events", on_cells("SELECT ds, event FROM events_by_week", EASTER))
def calendar_events(spark, folder):
    holidays = calendar.trading_holidays(spark, *t.calendar_years(spark, folder))
    return calendar.calendar_events(t.chain_series(spark, folder), holidays)


@query(
    "calendar_with_easter",
    on_cells(
        """, grid AS (SELECT CAST(UNNEST(generate_series(CAST(MIN(ds) AS TIMESTAMP), CAST(MAX(ds) + 420 AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ds FROM chain_series),
        found AS (SELECT MAX(ds) AS ds FROM grid JOIN easter ON year(ds) = yr WHERE ds > easter - 9 AND ds <= easter - 2 GROUP BY yr)
        SELECT holiday, ds, -3 AS lower_window, 2 AS upper_window FROM holidays
        UNION ALL SELECT 'Easter', ds, 0, 0 FROM found""",
        EASTER,
    ),
)
def calendar_with_easter(spark, folder):
    grid = calendar.weekly_grid(t.chain_series(spark, folder), ahead_weeks=60)
    return calendar.with_easter(calendar.trading_holidays(spark, *t.calendar_years(spark, folder)), grid)


@query(
    "holiday_of_week",
    on_cells(
        """, d AS (SELECT h.ds + CAST(o AS INTEGER) AS ds, holiday, o FROM holidays h, (SELECT UNNEST([-3, -2, -1, 0, 1, 2]) AS o))
        SELECT CAST(ds + CAST((12 - dayofweek(ds)) % 7 AS INTEGER) AS DATE) AS ds, arg_min(holiday, (abs(o) * 10 + o)) AS holiday,
        CAST(arg_min(o, (abs(o) * 10 + o)) AS INTEGER) AS "offset" FROM d GROUP BY 1"""
    ),
)
def holiday_of_week(spark, folder):
    """Per week the holiday whose window reaches into it, by its day closest to the holiday."""
    days = calendar.holiday_windows(calendar.trading_holidays(spark, *t.calendar_years(spark, folder)))
    weeks = days.select(week_ending(F.col("ds")).alias("ds"), "holiday", "offset", F.abs("offset").alias("far"))
    return calendar.one_per_date(weeks, ["far", "offset"]).drop("far")


@query(
    "holiday_window_sales",
    on_cells(
        """SELECT h.holiday, o AS "offset", COUNT(*) AS weeks, round(SUM(y), 4) AS sales
        FROM holidays h, (SELECT UNNEST([-3, -2, -1, 0, 1, 2]) AS o) JOIN chain_series c ON c.ds = h.ds + CAST(o AS INTEGER)
        GROUP BY 1, 2"""
    ),
)
def holiday_window_sales(spark, folder):
    """Sales of the weeks that lie inside a holiday's window."""
    windows = calendar.holiday_windows(calendar.trading_holidays(spark, *t.calendar_years(spark, folder)))
    hits = t.chain_series(spark, folder).join(windows, ["ds"])
    return rounded(
        hits.groupBy("holiday", "offset").agg(F.count(F.lit(1)).alias("weeks"), F.sum("y").alias("sales")),
        4, "sales",
    )


@query(
    "calendar_features",
    on_cells(
        """SELECT ds, year(ds) AS "year", month(ds) AS "month", weekofyear(ds) AS week, quarter(ds) AS quarter,
        round(sin(2 * pi() * weekofyear(ds) / 52), 9) AS week_sin, round(cos(2 * pi() * weekofyear(ds) / 52), 9) AS week_cos
        FROM chain_series"""
    ),
)
def calendar_features(spark, folder):
    return rounded(features.calendar_features(t.chain_series(spark, folder)).drop("y"), 9, "week_sin", "week_cos")


_LAGS = """SELECT "Store", "Dept", ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 52) OVER w AS lag_52,
  round(CASE WHEN COUNT(y) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) = 4 THEN AVG(y) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) END, 6) AS roll_4,
  round(CASE WHEN COUNT(y) OVER (w ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING) = 13 THEN AVG(y) OVER (w ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING) END, 4) AS roll_13
  FROM dept_series WINDOW w AS (PARTITION BY "Store", "Dept" ORDER BY ds)"""


@query("lag_features_dept", on_cells(_LAGS))
def lag_features_dept(spark, folder):
    lagged = features.lag_features(t.dept_series(spark, folder), ["Store", "Dept"])
    return rounded(rounded(lagged, 6, "roll_4"), 4, "roll_13")


@query(
    "lag_features_by_calendar",
    on_cells(
        """SELECT a."Store", a."Dept", a.ds, a.y, b.y AS lag_1, c.y AS lag_52 FROM dept_series a
        LEFT JOIN dept_series b ON a."Store" = b."Store" AND a."Dept" = b."Dept" AND b.ds = a.ds - 7
        LEFT JOIN dept_series c ON a."Store" = c."Store" AND a."Dept" = c."Dept" AND c.ds = a.ds - 364"""
    ),
)
def lag_features_by_calendar(spark, folder):
    return features.lag_features(
        t.dept_series(spark, folder), ["Store", "Dept"], lags=(1, 52), windows=(), by_calendar=True
    )


@query(
    "feature_table_store",
    on_log(
        """, s AS (SELECT "Store", "Date" AS ds, CAST("Weekly_Sales" AS DOUBLE) AS y,
            CASE "Type" WHEN 'A' THEN 0.0 WHEN 'B' THEN 1.0 WHEN 'C' THEN 2.0 END AS "Type", "Size" FROM panel_full),
        f AS (SELECT *, row_number() OVER w - 1 AS t, lag(y, 1) OVER w AS lag_1, lag(y, 52) OVER w AS lag_52,
            AVG(y) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS roll_4
          FROM s WINDOW w AS (PARTITION BY "Store" ORDER BY ds))
        SELECT "Store", ds, y, CAST("Type" AS DOUBLE) AS "Type", "Size", weekofyear(ds) AS week, month(ds) AS "month", quarter(ds) AS quarter,
          round(sin(2 * pi() * weekofyear(ds) / 52), 9) AS week_sin, round(cos(2 * pi() * weekofyear(ds) / 52), 9) AS week_cos,
          t, lag_1, lag_52, round(roll_4, 6) AS roll_4
        FROM f WHERE lag_52 IS NOT NULL"""
    ),
)
def feature_table_store(spark, folder):
    panel = t.full_store_panel(spark, folder).select(
        "Store", F.col("Date").alias("ds"), F.col("Weekly_Sales").cast("double").alias("y"), "Type", "Size"
    )
    built = features.build_features(panel, ["Store"])
    return rounded(rounded(built, 9, "week_sin", "week_cos"), 6, "roll_4")


@query(
    "series_steps",
    on_cells(
        """SELECT "Store", ds, row_number() OVER w - 1 AS t, round(y - lag(y) OVER w, 4) AS step, ds - lag(ds) OVER w AS gap_days
        FROM store_series WINDOW w AS (PARTITION BY "Store" ORDER BY ds)"""
    ),
)
def series_steps(spark, folder):
    """Counter, first difference and date gap of every store series."""
    ordered = W.partitionBy("Store").orderBy("ds")
    return t.store_series(spark, folder).select(
        "Store", "ds",
        (F.row_number().over(ordered) - 1).alias("t"),
        F.round(F.col("y") - F.lag("y").over(ordered), 4).alias("step"),
        F.datediff("ds", F.lag("ds").over(ordered)).alias("gap_days"),
    )


@query(
    "hold_out_rows",
    on_cells(
        """SELECT "Store", rev <= 13 AS is_test, COUNT(*) AS n, MIN(ds) AS first, MAX(ds) AS last
        FROM ranked GROUP BY 1, 2""",
        RANKED,
    ),
)
def hold_out_rows(spark, folder):
    split = splits.hold_out_rows(t.store_series(spark, folder), ["Store"])
    return split.groupBy("Store", "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )


@query(
    "hold_out_dates",
    on_cells(
        """, cut AS (SELECT MIN(ds) AS cut FROM (SELECT DISTINCT ds FROM dept_series ORDER BY ds DESC LIMIT 13))
        SELECT "Store", "Dept", ds >= cut AS is_test, COUNT(*) AS n, MIN(ds) AS first, MAX(ds) AS last
        FROM dept_series, cut GROUP BY 1, 2, 3"""
    ),
)
def hold_out_dates(spark, folder):
    return splits.hold_out_dates(t.dept_series(spark, folder)).groupBy("Store", "Dept", "is_test").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )


@query(
    "rolling_origin_folds",
    on_cells(
        """SELECT "Store", fold, is_test, COUNT(*) AS n, MIN(ds) AS first, MAX(ds) AS last, round(SUM(y), 4) AS sales
        FROM folds GROUP BY 1, 2, 3""",
        RANKED,
    ),
)
def rolling_origin_folds(spark, folder):
    return rounded(
        store_folds(spark, folder).groupBy("Store", "fold", "is_test").agg(
            F.count(F.lit(1)).alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last"),
            F.sum("y").alias("sales"),
        ), 4, "sales",
    )


_PANEL_FOLDS = """, dates AS (SELECT ds, row_number() OVER (ORDER BY ds DESC) AS rev FROM (SELECT DISTINCT ds FROM dept_series)),
  pf AS (SELECT d.*, fold, rev <= (3 - fold) * 13 + 13 AS is_test FROM dept_series d JOIN dates USING (ds),
    (SELECT UNNEST([1, 2, 3]) AS fold) WHERE rev > (3 - fold) * 13)"""


@query(
    "panel_folds_dept",
    on_cells(
        _PANEL_FOLDS + """
        SELECT fold, is_test, COUNT(*) AS n, MIN(ds) AS first, MAX(ds) AS last, COUNT(DISTINCT ("Store", "Dept")) AS series
        FROM pf GROUP BY 1, 2"""
    ),
)
def panel_folds_dept(spark, folder):
    folds = splits.panel_folds(t.dept_series(spark, folder))
    per_series = folds.groupBy("fold", "is_test", "Store", "Dept").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )
    return per_series.groupBy("fold", "is_test").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.count(F.lit(1)).alias("series"),
    )


@query(
    "fold_windows",
    on_cells(
        """, dates AS (SELECT ds, row_number() OVER (ORDER BY ds DESC) AS rev FROM (SELECT DISTINCT ds FROM dept_series))
        SELECT fold, MIN(ds) FILTER (WHERE rev <= (3 - fold) * 13 + 13) AS cutoff, MAX(ds) FILTER (WHERE rev <= (3 - fold) * 13 + 13) AS stop,
          COUNT(*) FILTER (WHERE rev > (3 - fold) * 13 + 13) AS train_dates
        FROM dates, (SELECT UNNEST([1, 2, 3]) AS fold) WHERE rev > (3 - fold) * 13 GROUP BY 1"""
    ),
)
def fold_windows(spark, folder):
    return splits.fold_windows(t.dept_series(spark, folder))


@query(
    "validation_by_date",
    on_cells(
        """, per AS (SELECT ds, COUNT(*) AS n FROM dept_series GROUP BY 1),
        tails AS (SELECT ds, n, SUM(n) OVER (ORDER BY ds DESC) AS tail, SUM(n) OVER () AS whole, row_number() OVER (ORDER BY ds DESC) AS rev FROM per)
        SELECT (tail <= whole * 0.2 OR rev = 1) AS is_val, CAST(SUM(n) AS BIGINT) AS n, MIN(ds) AS first, MAX(ds) AS last FROM tails GROUP BY 1"""
    ),
)
def validation_by_date(spark, folder):
    return splits.validation_by_date(t.dept_series(spark, folder)).groupBy("is_val").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )


@query(
    "future_dates",
    on_cells(
        """, ends AS (SELECT "Store", MAX(ds) FILTER (WHERE rev = 1) AS last, MAX(ds) FILTER (WHERE rev = 2) AS prior FROM ranked GROUP BY 1)
        SELECT "Store", CAST(step AS INTEGER) AS step, last + CAST((last - prior) * step AS INTEGER) AS ds
        FROM ends, (SELECT UNNEST(range(1, 14)) AS step)""",
        RANKED,
    ),
)
def future_dates(spark, folder):
    return baselines.future_dates(t.store_series(spark, folder), ["Store"])


@query(
    "baseline_forecasts",
    on_cells(
        """SELECT "Store", fold, model, ds, CAST(step AS INTEGER) AS step, y, round(yhat, 3) AS yhat,
        CASE WHEN yhat IS NULL THEN 'short_history' ELSE 'ok' END AS status FROM predicted""",
        RANKED,
    ),
)
def baseline_forecasts(spark, folder):
    return rounded(fold_forecasts(spark, folder), 3, "yhat")


@query(
    "baseline_metrics_table",
    on_cells(f"SELECT model, {ERRORS} FROM predicted WHERE fold = 3 AND yhat IS NOT NULL GROUP BY 1", RANKED),
)
def baseline_metrics_table(spark, folder):
    return _errors(metrics.metrics_table(last_window(spark, folder)))


@query(
    "panel_lag_baseline",
    on_cells(
        f""", l AS (SELECT *, lag(y, 52) OVER (PARTITION BY "Store" ORDER BY ds) AS yhat FROM store_series),
        cut AS (SELECT MIN(ds) AS cut FROM (SELECT DISTINCT ds FROM l WHERE yhat IS NOT NULL ORDER BY ds DESC LIMIT 13))
        SELECT "Store", {ERRORS} FROM l, cut WHERE ds >= cut AND yhat IS NOT NULL GROUP BY 1"""
    ),
)
def panel_lag_baseline(spark, folder):
    """The 52-week lag column as the panel's forecast."""
    table = features.build_features(t.store_series(spark, folder), ["Store"])
    test = splits.hold_out_dates(table).filter("is_test").withColumn("yhat", F.col("lag_52"))
    return _errors(metrics.forecast_metrics(test, ["Store"]))


CHAIN_MISSES = """
ranked_chain AS (SELECT *, row_number() OVER (ORDER BY ds DESC) AS rev, lag(y, 52) OVER (ORDER BY ds) AS yhat FROM chain_series),
scored AS (SELECT ds, y, yhat, (3 - (rev - 1) // 13) AS fold FROM ranked_chain WHERE rev <= 39),
missed AS (
  SELECT s.fold, s.ds AS week, y AS actual, yhat AS forecast, 100 * (y - yhat) / NULLIF(y, 0) AS miss,
    COALESCE(n.event, '') AS now, COALESCE(b.event, '') AS before, s.ds - 364 AS last_year
  FROM scored s LEFT JOIN events_by_week n ON n.ds = s.ds LEFT JOIN events_by_week b ON b.ds = s.ds - 364)"""


def _why(now: str, before: str) -> str:
    """The report's texts as SQL, from the operator's own constants."""
    new, old = (text.replace("'", "''").split("%s") for text in (misses.NEW_EVENT, misses.OLD_EVENT))
    return f"""CASE WHEN {now} <> '' AND {now} <> {before} THEN '{new[0]}' || {now} || '{new[1]}'
            WHEN {before} <> '' AND {before} <> {now} THEN '{old[0]}' || {before} || '{old[1]}' ELSE '' END"""


def _events(spark, weeks):
    """Events of the weeks of a small series, with a calendar for their years."""
    return calendar.calendar_events(weeks, calendar.trading_holidays(spark, *t.years_of(weeks)))


@query(
    "explain_misses_top3",
    on_cells(
        f"""SELECT CAST(fold AS INTEGER) AS fold, week, actual, forecast, round(miss, 6) AS miss_pct, now AS event_this_year,
          CAST(last_year AS VARCHAR) || CASE WHEN before <> '' THEN ' (' || before || ')' ELSE '' END AS same_week_last_year,
          {_why('now', 'before')} AS why
        FROM missed QUALIFY row_number() OVER (PARTITION BY fold ORDER BY abs(miss) DESC, week) <= 3""",
        EASTER, CHAIN_MISSES,
    ),
)
def explain_misses_top3(spark, folder):
    chain = cut_lineage(t.chain_series(spark, folder))  # one row a week: the lines are read once
    forecasts = baselines.score_baselines(splits.rolling_origin(chain), ["fold"])
    scored = forecasts.filter(F.col("model") == "seasonal_naive")
    return rounded(misses.explain_misses(scored, _events(spark, chain), ["fold"], top=3), 6, "miss_pct")


@query(
    "explain_misses_store",
    on_cells(
        f"""SELECT "Store", p.ds AS week, y AS actual, yhat AS forecast, round(100 * (y - yhat) / NULLIF(y, 0), 6) AS miss_pct,
          COALESCE(n.event, '') AS event_this_year,
          CAST(p.ds - 364 AS VARCHAR) || CASE WHEN COALESCE(b.event, '') <> '' THEN ' (' || b.event || ')' ELSE '' END AS same_week_last_year,
          {_why("COALESCE(n.event, '')", "COALESCE(b.event, '')")} AS why
        FROM predicted p LEFT JOIN events_by_week n ON n.ds = p.ds LEFT JOIN events_by_week b ON b.ds = p.ds - 364
        WHERE fold = 3 AND model = 'seasonal_naive'""",
        RANKED, EASTER,
    ),
)
def explain_misses_store(spark, folder):
    series = cut_lineage(t.store_series(spark, folder))  # one row a store and week: the lines are read once
    forecasts = baselines.score_baselines(splits.hold_out_rows(series, ["Store"]), ["Store"])
    scored = forecasts.filter(F.col("model") == "seasonal_naive")
    events = _events(spark, series.groupBy("ds").agg(F.sum("y").alias("y")))
    return rounded(misses.explain_misses(scored, events, ["Store"]), 6, "miss_pct")


_BANDS = """, bands AS (SELECT model, quantile_cont(abs(100 * (y - yhat) / NULLIF(y, 0)), 0.8) AS band FROM predicted
  WHERE yhat IS NOT NULL GROUP BY 1)"""


@query(
    "cv_error_bands",
    on_cells(_BANDS + " SELECT model, round(band, 6) AS band FROM bands", RANKED),
)
def cv_error_bands(spark, folder):
    return rounded(metrics.cv_interval(metrics.residuals(fold_forecasts(spark, folder))), 6, "band")


@query(
    "forecast_bands",
    on_cells(
        _BANDS + """ SELECT "Store", model, ds, round(y - yhat, 3) AS residual, round(yhat * (1 - band / 100), 2) AS yhat_lo, round(yhat * (1 + band / 100), 2) AS yhat_hi
        FROM predicted JOIN bands USING (model) WHERE fold = 3 AND yhat IS NOT NULL""",
        RANKED,
    ),
)
def forecast_bands(spark, folder):
    """Residuals, and the cross-validated band drawn around the last window."""
    rows = cut_lineage(metrics.residuals(fold_forecasts(spark, folder)))
    banded = metrics.apply_band(rows.filter(F.col("fold") == 3), metrics.cv_interval(rows))
    out = banded.filter(F.col("yhat").isNotNull()).select("Store", "model", "ds", "residual", "yhat_lo", "yhat_hi")
    return rounded(rounded(out, 3, "residual"), 2, "yhat_lo", "yhat_hi")


@query(
    "band_coverage",
    on_cells(
        _BANDS + """ SELECT model, round(AVG(CASE WHEN y BETWEEN yhat * (1 - band / 100) AND yhat * (1 + band / 100) THEN 1.0 ELSE 0.0 END), 6) AS coverage
        FROM predicted JOIN bands USING (model) WHERE fold = 3 AND yhat IS NOT NULL GROUP BY 1""",
        RANKED,
    ),
)
def band_coverage(spark, folder):
    rows = cut_lineage(metrics.residuals(fold_forecasts(spark, folder)))
    banded = metrics.apply_band(rows.filter(F.col("fold") == 3), metrics.cv_interval(rows))
    return rounded(metrics.interval_coverage(banded), 6, "coverage")


@query(
    "fold_summary",
    on_cells(
        """, s AS (SELECT model, fold, 100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) AS mape FROM predicted WHERE yhat IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY round(mape, 9)) AS rk FROM s)
        SELECT model, round(AVG(mape), 6) AS mean, round(MIN(mape), 6) AS min, round(MAX(mape), 6) AS max, round(MAX(mape) - MIN(mape), 6) AS spread,
          COUNT(*) FILTER (WHERE rk = 1) AS folds_won, COUNT(*) AS folds FROM r GROUP BY 1""",
        RANKED,
    ),
)
def fold_summary(spark, folder):
    scores = metrics.forecast_metrics(fold_forecasts(spark, folder), ["model", "fold"])
    return rounded(metrics.fold_summary(scores), 6, "mean", "min", "max", "spread")


@query(
    "fold_winner",
    on_cells(
        """, s AS (SELECT model, fold, 100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) AS mape FROM predicted WHERE yhat IS NOT NULL GROUP BY 1, 2)
        SELECT model, round(AVG(mape), 6) AS mean FROM s GROUP BY 1 ORDER BY AVG(mape), 1 LIMIT 1""",
        RANKED,
    ),
)
def fold_winner(spark, folder):
    scores = metrics.forecast_metrics(fold_forecasts(spark, folder), ["model", "fold"])
    return rounded(metrics.tournament_winner(scores), 6, "mean").select("model", "mean")


@query(
    "compare_on_folds",
    on_cells(
        """, s AS (SELECT fold, 100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) FILTER (WHERE model = 'seasonal_naive') AS b,
            100 * AVG(CASE WHEN y > 0 THEN abs((y - yhat) / y) END) FILTER (WHERE model = 'seasonal_naive_growth') AS o
          FROM predicted WHERE yhat IS NOT NULL GROUP BY 1)
        SELECT round(AVG(o - b), 6) AS effect, round(MAX(b) - MIN(b), 6) AS fold_spread,
          round((MAX(b) - MIN(b)) / greatest(abs(AVG(o - b)), 1e-9), 6) AS spread_over_effect,
          COUNT(*) FILTER (WHERE o < b) AS folds_better, COUNT(*) FILTER (WHERE o > b) AS folds_worse,
          abs(SUM(sign(o - b))) = COUNT(*) AS same_sign FROM s""",
        RANKED,
    ),
)
def compare_on_folds(spark, folder):
    scores = metrics.forecast_metrics(fold_forecasts(spark, folder), ["model", "fold"])
    return rounded(
        metrics.compare_on_folds(scores, "seasonal_naive", "seasonal_naive_growth"),
        6, "effect", "fold_spread", "spread_over_effect",
    )


@query(
    "weighted_error",
    on_cells(
        """SELECT model, round(100 * SUM(abs(y - yhat)) / SUM(y), 6) AS wape FROM predicted WHERE yhat IS NOT NULL GROUP BY 1""",
        RANKED,
    ),
)
def weighted_error(spark, folder):
    rows = fold_forecasts(spark, folder).filter(F.col("yhat").isNotNull())
    return rounded(metrics.weighted_error(rows), 6, "wape")


_DEPT_LAG = """, l AS (SELECT *, lag(y, 52) OVER (PARTITION BY "Store", "Dept" ORDER BY ds) AS yhat FROM dept_series),
  cut AS (SELECT MIN(ds) AS cut FROM (SELECT DISTINCT ds FROM l WHERE yhat IS NOT NULL ORDER BY ds DESC LIMIT 13)),
  dept_test AS (SELECT l.* FROM l, cut WHERE ds >= cut AND yhat IS NOT NULL)"""


def dept_lag_test(spark, folder):
    table = features.build_features(t.dept_series(spark, folder), ["Store", "Dept"])
    return splits.hold_out_dates(table).filter("is_test").withColumn("yhat", F.col("lag_52"))


@query(
    "roll_up_forecasts",
    on_cells(
        _DEPT_LAG + """, r AS (SELECT "Store", "Dept", ds, SUM(y) AS y, SUM(yhat) AS yhat,
            2 - GROUPING("Store") - GROUPING("Dept") AS depth FROM dept_test GROUP BY GROUPING SETS (("Store", "Dept", ds), ("Store", ds), (ds)))
        SELECT CAST(depth AS INTEGER) AS depth, """ + ERRORS + " FROM r GROUP BY 1"
    ),
)
def roll_up_forecasts(spark, folder):
    """Department forecasts scored as they are, per store, and summed to the chain."""
    rolled = grains.roll_up(dept_lag_test(spark, folder), ["Store", "Dept"])
    return _errors(metrics.forecast_metrics(rolled, ["depth"]))


@query(
    "near_zero_rows",
    on_cells(
        _DEPT_LAG + """ SELECT "Store", COUNT(*) FILTER (WHERE y < 10000) AS near_zero, COUNT(*) AS "rows" FROM dept_test GROUP BY 1"""
    ),
)
def near_zero_rows(spark, folder):
    return metrics.near_zero_rows(dept_lag_test(spark, folder), 10000.0, ["Store"])
