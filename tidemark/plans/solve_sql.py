"""SQL that solves small systems: matrices as lists of lists, eliminated column by column in a recursive CTE.

The checks of the regressions use it; the queries themselves share nothing with it.
"""

from __future__ import annotations

from tidemark.operators import additive, smoothing


def matrix(name: str, rows: str, keys: str) -> str:
    """``name`` (keys, m): summed products of the long rows (keys, pos, j, v), ordered by j."""
    return f"""
  {name}_p AS (SELECT {keys}, r, c, SUM(v) AS v FROM (
      SELECT {keys}, a.j AS r, b.j AS c, a.v * b.v AS v FROM {rows} a JOIN {rows} b USING ({keys}, pos)) GROUP BY ALL),
  {name} AS (SELECT {keys}, list(line ORDER BY r) AS m FROM (
      SELECT {keys}, r, list(v ORDER BY c) AS line FROM {name}_p GROUP BY {keys}, r) GROUP BY {keys})"""


def eliminated(name: str, source: str, keys: str, full: bool = True) -> str:
    """``name`` (keys, i, m): the matrix after each pivot; ``full`` clears the whole column and scales the pivot to one."""
    rest, own, last = ("<>", "piv", "len(m)") if full else (">", "line", "len(m) - 1")
    return f"""
  {name} AS (SELECT {keys}, 0 AS i, m FROM {source}
    UNION ALL SELECT {keys}, i + 1, list_transform(m, lambda line, r: CASE WHEN r {rest} i + 1
        THEN list_transform(list_zip(line, piv), lambda z: z[1] - z[2] * line[i + 1]) ELSE {own} END)
    FROM (SELECT {keys}, i, m, list_transform(prow, lambda x: x / p) AS piv FROM (
        SELECT {keys}, i, m, m[i + 1] AS prow, m[i + 1][i + 1] AS p FROM {name} WHERE i < {last})))"""


def unit_root(keys: str, series: str) -> str:
    """``adf`` (keys, statistic, p, lags, n_obs) of the series (keys, t from 0, n, y)."""
    part = f"PARTITION BY {keys}"

    def design(name: str, source: str, lags: str) -> str:
        there = f"t - 1 >= {lags}"
        return f"""
  {name} AS (SELECT {keys}, t AS pos, 0 AS j, lev AS v FROM {source} WHERE {there}
    UNION ALL SELECT {keys}, t, 1, 1.0 FROM {source} WHERE {there}
    UNION ALL SELECT {keys}, a.t, CAST(1 + a.t - b.t AS INTEGER), b.d FROM {source} a JOIN (SELECT {keys}, t, d FROM {source}) b USING ({keys})
      WHERE a.t - 1 >= a.{lags} AND b.t BETWEEN a.t - a.{lags} AND a.t - 1
    UNION ALL SELECT {keys}, t, 100000, d FROM {source} WHERE {there})"""

    return f"""
  ur_z AS (SELECT {keys}, t, n, (y - AVG(y) OVER ({part})) / NULLIF(stddev_pop(y) OVER ({part}), 0) AS z FROM {series}),
  ur_s AS (SELECT {keys}, t, n, lag(z) OVER ({part} ORDER BY t) AS lev, z - lag(z) OVER ({part} ORDER BY t) AS d,
    CAST(least(n // 2 - 2, ceil(12 * pow(n / 100.0, 0.25))) AS INTEGER) AS lags FROM ur_z WHERE z IS NOT NULL),
  {design("ur_x", "ur_s", "lags")}, {matrix("ur_m", "ur_x", keys)}, {eliminated("ur_e", "ur_m", keys, full=False)},
  ur_size AS (SELECT {keys}, MAX(n - 1 - lags) AS size FROM ur_s GROUP BY {keys}),
  ur_best AS (SELECT {keys}, arg_min(i - 2, size * ln(greatest(m[len(m)][len(m)], 1e-300) / size) + 2 * i) AS best
    FROM ur_e JOIN ur_size USING ({keys}) WHERE i >= 2 GROUP BY {keys}),
  ur_s2 AS (SELECT ur_s.*, best FROM ur_s JOIN ur_best USING ({keys})),
  {design("ur_x2", "ur_s2", "best")}, {matrix("ur_m2", "ur_x2", keys)},
  ur_a AS (SELECT {keys}, list_transform(m[1:len(m) - 1], lambda line, r: list_append(line, CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END)) AS m FROM ur_m2),
  {eliminated("ur_f", "ur_a", keys)},
  ur_sum AS (SELECT {keys}, COUNT(DISTINCT pos) AS n_obs FROM ur_x2 GROUP BY {keys}),
  ur_t AS (SELECT {keys}, n_obs, best AS lags, f.m[1][len(f.m) + 1] / sqrt(f.m[1][len(f.m) + 2] * (g.m[len(g.m)][len(g.m)]
      - list_sum(list_transform(list_zip(f.m, g.m[1:len(f.m)]), lambda z: z[1][len(f.m) + 1] * z[2][len(f.m) + 1]))) / (n_obs - len(f.m))) AS statistic
    FROM ur_f f JOIN ur_m2 g USING ({keys}) JOIN ur_sum USING ({keys}) JOIN ur_best USING ({keys}) WHERE f.i = len(f.m)),
  ur_u AS (SELECT *, CASE WHEN statistic <= -1.61 THEN 2.1659 + 1.4412 * statistic + 0.038269 * statistic ** 2
      ELSE 1.7339 + 0.93202 * statistic - 0.12745 * statistic ** 2 - 0.010368 * statistic ** 3 END AS u FROM ur_t),
  adf AS (SELECT {keys}, statistic, CAST(lags AS INTEGER) AS lags, n_obs, CASE WHEN statistic > 2.74 THEN 1.0 WHEN statistic < -18.83 OR u < -8 THEN 0.0 WHEN u > 8 THEN 1.0
      ELSE least(greatest(0.5 + sign(u) * exp(-u * u / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 151),
        lambda n: exp((2 * n + 1) * ln(greatest(abs(u), 1e-300)) - (n + 1) * ln(2) - lgamma(n + 1.5) + 0.5 * ln(pi())))), 0.0), 1.0) END AS p FROM ur_u)"""


def student_p(name: str, fits: str, keys: str) -> str:
    """``name`` (keys, p) from (keys, r2, df): Student's t by its finite series in the squared cosine."""
    return f"""
  {name}_a AS (SELECT *, 1 - r2 AS c2, sqrt(r2) AS s, atan2(sqrt(r2), sqrt(1 - r2)) AS theta FROM {fits} WHERE df > 0 AND r2 < 1),
  {name}_t AS (SELECT {keys}, j, CASE WHEN df % 2 = 1 THEN CASE j WHEN 1 THEN 1.0 ELSE (2.0 * j - 2) / (2 * j - 1) END
        ELSE CASE j WHEN 1 THEN 1.0 ELSE (2.0 * j - 3) / (2 * j - 2) END END * CASE j WHEN 1 THEN 1.0 ELSE c2 END AS f
    FROM {name}_a, (SELECT UNNEST(range(1, 2000)) AS j) WHERE j <= CASE WHEN df % 2 = 1 THEN (df - 1) // 2 ELSE df // 2 END),
  {name}_s AS (SELECT {keys}, SUM(p) AS total FROM (SELECT {keys}, product(f) OVER (PARTITION BY {keys} ORDER BY j) AS p FROM {name}_t) GROUP BY {keys}),
  {name} AS (SELECT {keys}, greatest(0.0, 1 - CASE WHEN df % 2 = 1
        THEN 2 / pi() * (theta + s * sqrt(c2) * COALESCE(total, 0)) ELSE s * COALESCE(total, 0) END) AS p
    FROM {name}_a LEFT JOIN {name}_s USING ({keys}))"""


def seasonal_arma(source: str) -> str:
    """``ar_beta`` ("Store", b) and ``ar_ahead`` ("Store", h, y) from (Store, pos, y): two regressions, then the recursion."""
    key = '"Store"'
    lags = " UNION ALL ".join(f"SELECT {key}, pos, {j} AS j, lag(w, {j}) OVER o AS v FROM ar_w WINDOW o AS (PARTITION BY {key} ORDER BY pos)" for j in range(1, 14))
    second = " UNION ALL ".join(
        f"SELECT {key}, pos, {j} AS j, lag({c}, {k}) OVER o AS v FROM ar_e WINDOW o AS (PARTITION BY {key} ORDER BY pos)"
        for j, (c, k) in enumerate((("w", 1), ("e", 1), ("e", 52), ("e", 53)), start=1)
    )

    def complete(name: str, parts: str, table: str, columns: int) -> str:
        return f"""
  {name}_l AS ({parts} UNION ALL SELECT {key}, pos, 1000, w FROM {table}),
  {name} AS (SELECT * FROM {name}_l SEMI JOIN (SELECT {key}, pos FROM {name}_l GROUP BY ALL HAVING COUNT(v) = {columns + 1}) USING ({key}, pos)),
  {matrix(name + "_m", name, key)}, {name}_a AS (SELECT {key}, m[1:{columns}] AS m FROM {name}_m), {eliminated(name + "_f", name + "_a", key)},
  {name}_b AS (SELECT {key}, list_transform(m, lambda line: line[{columns + 1}]) AS b FROM {name}_f WHERE i = {columns})"""

    return f"""
  ar_w AS (SELECT {key}, pos, y, y - lag(y, 52) OVER (PARTITION BY {key} ORDER BY pos) AS w FROM {source}),
  {complete("ar_x", lags, "ar_w", 13)},
  ar_e AS (SELECT {key}, ar_w.pos, y, w, w - fitted AS e FROM ar_w LEFT JOIN (
      SELECT {key}, pos, SUM(v * b[j]) AS fitted FROM ar_x JOIN ar_x_b USING ({key}) WHERE j < 1000 GROUP BY ALL) USING ({key}, pos)),
  {complete("ar_z", second, "ar_e", 4)},
  ar_tail AS (SELECT {key}, list(y ORDER BY pos) AS y, list(w ORDER BY pos) AS w, list(e ORDER BY pos) AS e FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY pos DESC) AS back FROM ar_e) WHERE back <= 53 GROUP BY {key}),
  ar_go AS (SELECT {key}, 0 AS h, w[53] AS w, CAST(NULL AS DOUBLE) AS ahead FROM ar_tail JOIN ar_z_b USING ({key})
    UNION ALL SELECT {key}, h + 1, next, t.y[h + 2] + next FROM (
      SELECT g.{key}, h, b[1] * g.w + CASE WHEN h = 0 THEN b[2] * t.e[53] ELSE 0 END + b[3] * t.e[h + 2] + b[4] * t.e[h + 1] AS next
      FROM ar_go g JOIN ar_tail t USING ({key}) JOIN ar_z_b USING ({key}) WHERE h < 13) JOIN ar_tail t USING ({key}))"""


def holt_winters(source: str) -> str:
    """``hw_best`` with weights, error and state from (Store, pos, y): every set of weights through the recursion."""
    listed = lambda values: f"UNNEST([{', '.join(map(str, values))}]::DOUBLE[])"
    return f"""
  hw_v AS (SELECT "Store", list(y ORDER BY pos) AS v FROM {source} GROUP BY 1 HAVING COUNT(*) >= 104),
  hw_0 AS (SELECT *, list_avg(v[1:52]) AS first, (list_avg(v[53:104]) - list_avg(v[1:52])) / 52 AS slope FROM hw_v),
  hw_1 AS (SELECT "Store", v, slope, first - slope * 53 / 2 AS level FROM hw_0),
  hw_2 AS (SELECT *, list_transform(range(1, 53), lambda i: (v[i] - level - slope * i + v[i + 52] - level - slope * (i + 52)) / 2) AS figure FROM hw_1),
  hw_3 AS (SELECT "Store", v, level, slope, list_transform(figure, lambda f: f - middle) AS season FROM (SELECT *, list_avg(figure) AS middle FROM hw_2)),
  hw AS (
    SELECT "Store", alpha, beta, gamma, 0 AS i, level, slope, season, 0.0::DOUBLE AS sse
    FROM hw_3, (SELECT {listed(smoothing.ALPHAS)} AS alpha), (SELECT {listed(smoothing.BETAS)} AS beta), (SELECT {listed(smoothing.GAMMAS)} AS gamma)
    UNION ALL SELECT "Store", alpha, beta, gamma, i + 1, new, slope + beta * (new - level - slope),
      list_append(season[2:], head + gamma * (y - level - slope - head)), sse + (y - level - slope - head) ** 2
    FROM (SELECT *, level + slope + alpha * (y - head - level - slope) AS new FROM (
        SELECT hw.*, hw_v.v[i + 1] AS y, hw.season[1] AS head FROM hw JOIN hw_v USING ("Store") WHERE i < len(hw_v.v)))),
  hw_best AS (SELECT * FROM hw JOIN hw_v USING ("Store") WHERE i = len(v)
    QUALIFY row_number() OVER (PARTITION BY "Store" ORDER BY sse, alpha, beta, gamma) = 1)"""


def additive_fit(scales: list[float]) -> str:
    """``ad`` (scale, ds, y, is_test, trend, yearly, holidays, noise, drift, factor) of the chain, by reweighted elimination."""
    rounds, order = additive.ROUNDS, additive.YEARLY_ORDER
    steps = []
    for k in range(rounds):
        before = "ad_r0" if k == 0 else f"ad_r{k}"
        steps.append(f"""
  ad_q{k} AS (SELECT g.one, p.scale, list_transform(g.m[1:len(g.m) - 1], lambda line, r: list_transform(line, lambda x, c: x + CASE WHEN r = c THEN
        p.noise * CASE WHEN r <= 2 THEN 0.04 WHEN r <= 2 + g.bends THEN 1 / (p.scale * (p.shrink[r - 2] + {additive.FLOOR})) ELSE 0.01 END ELSE 0 END)) AS m
    FROM ad_g g JOIN {before} p USING (one)),
  {eliminated(f"ad_e{k}", f"ad_q{k}", "one, scale")},
  ad_b{k} AS (SELECT one, scale, list_transform(m, lambda line: line[len(m) + 1]) AS beta FROM ad_e{k} WHERE i = len(m)),
  ad_r{k + 1} AS (SELECT one, scale, beta, list_transform(beta[3:2 + bends], lambda x: abs(x)) AS shrink,
      greatest((m[len(m)][len(m)] - 2 * list_dot_product(beta, m[len(m)][1:len(beta)])
        + list_dot_product(beta, list_transform(m[1:len(beta)], lambda line: list_dot_product(line[1:len(beta)], beta)))) / size, 1e-10) AS noise
    FROM ad_b{k} JOIN ad_g USING (one))""")
    waves = "".join(
        f"UNION ALL SELECT one, ds, {start + k}, {f}({k} * 2 * pi() * day / {additive.YEAR_DAYS}) FROM ad_d " for start, f in ((200, "sin"), (300, "cos")) for k in range(1, order + 1)
    )
    return f"""
  ad_0 AS (SELECT 1 AS one, ds, y, CAST(ds - DATE '1970-01-01' AS DOUBLE) AS day, row_number() OVER (ORDER BY ds DESC) <= 13 AS is_test FROM chain_series),
  ad_1 AS (SELECT *, COUNT(*) FILTER (NOT is_test) OVER () AS size, row_number() OVER (PARTITION BY is_test ORDER BY ds) - 1 AS place FROM ad_0),
  ad_2 AS (SELECT *, CAST(floor(size * {additive.CHANGEPOINT_RANGE}) AS BIGINT) - 1 AS last FROM ad_1),
  ad_3 AS (SELECT one, MAX(size) AS size, MAX(last) AS last, least({additive.CHANGEPOINTS}, greatest(MAX(last), 0)) AS bends, MIN(day) FILTER (NOT is_test) AS first,
      MAX(day) FILTER (NOT is_test) - MIN(day) FILTER (NOT is_test) AS span, MAX(abs(y)) FILTER (NOT is_test) AS factor FROM ad_2 GROUP BY one),
  ad_d AS (SELECT ad_2.one, ds, y, day, is_test, place, (day - first) / span AS t FROM ad_2 JOIN ad_3 USING (one)),
  ad_knots AS (SELECT one, ds AS spot, t AS knot, row_number() OVER (ORDER BY ds) AS nr FROM ad_d JOIN ad_3 USING (one) WHERE NOT is_test
      AND place IN (SELECT (2 * i * last + bends) // (2 * bends) FROM ad_3, (SELECT UNNEST(range(1, {additive.CHANGEPOINTS + 1})) AS i) WHERE i <= bends)),
  ad_names AS (SELECT holiday, row_number() OVER (ORDER BY holiday) AS nr FROM (SELECT DISTINCT holiday FROM ad_d JOIN holidays USING (ds) WHERE NOT is_test)),
  ad_x AS (
    SELECT one, ds, 0 AS j, 1.0::DOUBLE AS v FROM ad_d UNION ALL SELECT one, ds, 1, t FROM ad_d
    UNION ALL SELECT one, ds, 100 + nr, greatest(t - knot, 0) FROM ad_d JOIN ad_knots USING (one)
    {waves}
    UNION ALL SELECT one, ds, 1000 + nr, CASE WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.ds = ad_d.ds AND h.holiday = ad_names.holiday) THEN 1.0 ELSE 0.0 END FROM ad_d, ad_names),
  ad_t AS (SELECT one, ds AS pos, j, v FROM ad_x SEMI JOIN (SELECT ds FROM ad_d WHERE NOT is_test) USING (ds)
    UNION ALL SELECT one, ds, 100000, y / factor FROM ad_d JOIN ad_3 USING (one) WHERE NOT is_test),
  {matrix("ad_m", "ad_t", "one")},
  ad_g AS (SELECT one, m, CAST(bends AS INTEGER) AS bends, size FROM ad_m JOIN ad_3 USING (one)),
  ad_r0 AS (SELECT one, scale, list_transform(range(0, bends), lambda i: scale) AS shrink, m[len(m)][len(m)] / size - (m[1][len(m)] / size) ** 2 AS noise
    FROM ad_g, (SELECT UNNEST({list(map(float, scales))}::DOUBLE[]) AS scale)),
  {','.join(steps)},
  ad_l AS (SELECT one, ds, j, v, row_number() OVER (PARTITION BY ds ORDER BY j) AS c FROM ad_x),
  ad_v AS (SELECT f.scale, ds, SUM(v * beta[c]) FILTER (j < 200) AS trend, SUM(v * beta[c]) FILTER (j BETWEEN 200 AND 999) AS yearly,
      COALESCE(SUM(v * beta[c]) FILTER (j >= 1000), 0) AS holidays FROM ad_l JOIN ad_r{rounds} f USING (one) GROUP BY ALL),
  ad AS (SELECT v.scale, ds, y, is_test, trend * factor AS trend, yearly * factor AS yearly, holidays * factor AS holidays, noise, factor,
      bends * 2 * list_avg(shrink) ** 2 * greatest(t - 1, 0) ** 3 / 3 AS drift
    FROM ad_v v JOIN ad_d USING (ds) JOIN ad_3 USING (one) JOIN ad_r{rounds} f ON f.scale = v.scale)"""


def cox(rows: str, width: int, steps: int = 8, alpha: float = 0.1) -> str:
    """``cx_b<steps>`` (one, beta): Newton's steps of the Cox model on ``rows`` (time, event, x), x with a leading 1."""
    parts = [f"""
  cx_pairs AS (SELECT j, k FROM (SELECT UNNEST(range(1, {width + 2})) AS j), (SELECT UNNEST(range(1, {width + 2})) AS k) WHERE j <= k),
  cx_d AS (SELECT time, COUNT(*) FILTER (event) AS d FROM {rows} GROUP BY 1),
  cx_seen AS (SELECT j, SUM(x[j]) AS v FROM {rows}, (SELECT UNNEST(range(2, {width + 2})) AS j) WHERE event GROUP BY 1),
  cx_b0 AS (SELECT 1 AS one, list_transform(range(0, {width}), lambda i: 0.0::DOUBLE) AS beta)"""]
    for r in range(steps):
        parts.append(f"""
  cx_w{r} AS (SELECT time, x, exp(list_dot_product(x[2:], beta)) AS w FROM {rows}, cx_b{r}),
  cx_v{r} AS (SELECT time, j, k, SUM(w * x[j] * x[k]) AS v FROM cx_w{r}, cx_pairs GROUP BY ALL),
  cx_c{r} AS (SELECT time, j, k, SUM(v) OVER (PARTITION BY j, k ORDER BY time DESC) AS v FROM cx_v{r}),
  cx_a{r} AS (SELECT time, k AS j, c.v / s.v AS mean, s.v AS total, d FROM cx_c{r} c JOIN (SELECT time, v FROM cx_c{r} WHERE j = 1 AND k = 1) s USING (time) JOIN cx_d USING (time)
    WHERE c.j = 1 AND c.k > 1 AND d > 0),
  cx_i{r} AS (SELECT q.j, q.k, SUM(a.d * (q.v / a.total - a.mean * b.mean)) + CASE WHEN q.j = q.k THEN {alpha} ELSE 0 END AS v
    FROM cx_c{r} q JOIN cx_a{r} a ON a.time = q.time AND a.j = q.j JOIN cx_a{r} b ON b.time = q.time AND b.j = q.k WHERE q.j > 1 GROUP BY q.j, q.k),
  cx_l{r} AS (SELECT j, k, v FROM cx_i{r} UNION ALL SELECT k, j, v FROM cx_i{r} WHERE j < k
    UNION ALL SELECT j, 100000, o.v - m.v - {alpha} * beta[j - 1] FROM cx_seen o JOIN (SELECT j, SUM(d * mean) AS v FROM cx_a{r} GROUP BY j) m USING (j), cx_b{r}),
  cx_m{r} AS (SELECT 1 AS one, list(line ORDER BY j) AS m FROM (SELECT j, list(v ORDER BY k) AS line FROM cx_l{r} GROUP BY j)),
  {eliminated(f"cx_e{r}", f"cx_m{r}", "one")},
  cx_b{r + 1} AS (SELECT one, list_transform(list_zip(beta, m), lambda z: z[1] + z[2][{width + 1}]) AS beta FROM cx_e{r} JOIN cx_b{r} USING (one) WHERE i = {width})""")
    return ",".join(parts)
