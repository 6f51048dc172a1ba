"""SQL of the curve fits: the same sums of cross products, solved by elimination over lists.

A recursive step k clears column k of every system at once. Hinges and waves are spelled out from
the design, so the SQL follows it.
"""

from __future__ import annotations

import math

from shelfline.operators.curves import BLOCKED, FREE, WEEK, YEAR, Z90, Design


def row_sql(design: Design, day: str, regressors: str = "") -> str:
    u = f"(({day} - s) / greatest(e - s, 1)::DOUBLE)"
    waves = [(WEEK, k) for k in range(1, design.weekly + 1)] + [(YEAR, k) for k in range(1, design.yearly + 1)]
    columns = ["1.0::DOUBLE", u, *[f"greatest(0.0::DOUBLE, {u} - {k!r}::DOUBLE)" for k in design.knots]]
    columns += [f"{f}({day} * {2 * math.pi * k / period!r}::DOUBLE)" for period, k in waves for f in ("sin", "cos")]
    return "[" + ", ".join(columns + ([regressors] if regressors else [])) + "]"


def ridge_sql(design: Design, seen: str) -> str:
    season, extra = 1 / 10.0, 1 / 10.0
    parts = [repr(FREE), repr(FREE), *[f"CASE WHEN {k!r}::DOUBLE <= 0.8::DOUBLE * {seen} THEN {1 / 0.05!r}::DOUBLE ELSE {BLOCKED!r}::DOUBLE END" for k in design.knots]]
    parts += [repr(season)] * (2 * (design.weekly + design.yearly)) + [repr(extra)] * len(design.regressors)
    return "[" + ", ".join(f"{p}::DOUBLE" for p in parts) + "]"


def points_sql(design: Design, minimum: int, regressor: str = "", source: str = "daily_sales") -> str:
    x = row_sql(design, "day", f"CAST({regressor} AS INT)::DOUBLE" if regressor else "")
    return f"""
known AS (SELECT product_id, date, date_diff('day', DATE '1970-01-01', date) AS day, quantity::DOUBLE AS y FROM {source} WHERE quantity IS NOT NULL),
spans AS (SELECT product_id, min(day) AS s, max(day) AS e, count(*) AS n FROM known GROUP BY 1 HAVING count(*) >= {minimum}),
pts AS (SELECT product_id, day, s, e, n, y, {x} AS x, row_number() OVER (PARTITION BY product_id ORDER BY day DESC) AS b FROM known JOIN spans USING (product_id))"""


def solve_sql(design: Design, seen: str) -> str:
    """CTEs from ``cuts`` (product_id, cut, s, e) and ``seg`` (product_id, cut, x, y) to ``fits`` (product_id, cut, beta, half)."""
    p = design.size
    return f"""
cells AS (SELECT product_id, cut, i, j, sum(list_extract(r, i) * list_extract(r, j)) AS v
  FROM (SELECT product_id, cut, list_append(x, y) AS r FROM seg), range(1, {p + 2}) a(i), range(1, {p + 2}) b(j) WHERE j <= i GROUP BY ALL),
sizes AS (SELECT product_id, cut, count(*) AS n FROM seg GROUP BY ALL),
axis AS (SELECT product_id, cut FROM cuts UNION SELECT product_id, cut FROM sizes),
summed AS (SELECT product_id, cut, i, j, sum(coalesce(v, 0)) OVER (PARTITION BY product_id, i, j ORDER BY cut DESC) AS v
  FROM axis CROSS JOIN range(1, {p + 2}) a(i) JOIN range(1, {p + 2}) b(j) ON j <= i LEFT JOIN cells USING (product_id, cut, i, j)),
every AS (SELECT summed.* FROM summed JOIN (SELECT product_id, cut FROM cuts) USING (product_id, cut)),
trained AS (SELECT product_id, cut, sum(coalesce(n, 0)) OVER (PARTITION BY product_id ORDER BY cut DESC) AS n_train FROM axis LEFT JOIN sizes USING (product_id, cut)),
mirrored AS (SELECT product_id, cut, i, j, v FROM every UNION ALL SELECT product_id, cut, j, i, v FROM every WHERE i <> j),
lists AS (SELECT product_id, cut, i, list(v ORDER BY j) AS r FROM mirrored GROUP BY ALL),
gram AS (SELECT product_id, cut, list(r ORDER BY i) AS g FROM lists GROUP BY ALL),
ridged AS (SELECT gram.*, n_train, {ridge_sql(design, seen)} AS rid FROM gram JOIN cuts USING (product_id, cut) JOIN trained USING (product_id, cut)),
start AS (SELECT product_id, cut, list_transform(range(1, {p + 1}), lambda i:
    list_transform(range(1, {p + 2}), lambda j: CASE WHEN j = {p + 1} THEN g[{p + 1}][i] ELSE g[i][j] + CASE WHEN i = j THEN rid[i] ELSE 0 END END)) AS m FROM ridged),
cleared(product_id, cut, k, m) AS (SELECT product_id, cut, 1, m FROM start UNION ALL
  SELECT product_id, cut, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
    ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM cleared WHERE k <= {p}),
betas AS (SELECT product_id, cut, n_train, rid, g, list_transform(m, lambda r: r[{p + 1}]) AS beta, len(list_filter(rid, lambda v: v < {BLOCKED!r})) AS free
  FROM ridged JOIN cleared USING (product_id, cut) WHERE k = {p + 1}),
fits AS (SELECT product_id, cut, beta, {Z90!r}::DOUBLE * sqrt(1 + free / greatest(n_train, 1)::DOUBLE) * sqrt(greatest(g[{p + 1}][{p + 1}]
    - list_inner_product(g[{p + 1}][1:{p}], beta) - list_inner_product(rid, list_transform(beta, lambda v: v * v)), 0) / greatest(n_train - free, 1)) AS half FROM betas)"""


def seasonal(design: Design, regressor: str, horizon: int = 30, initial: int = 180, period: int = 30, minimum: int = 60) -> str:
    future = row_sql(design, "day", f"CAST({regressor} AS INT)::DOUBLE")
    return f"""
WITH RECURSIVE {points_sql(design, minimum, regressor)},
lasts AS (SELECT *, greatest(floor((e - {horizon} - s - {initial}) / {period}::DOUBLE)::INT, -1) AS lc FROM spans),
cuts AS (SELECT product_id, s, e, unnest(range(-1, lc + 1))::INT AS cut FROM lasts),
seg AS (SELECT product_id, x, y, CASE WHEN lc >= 0 AND floor((pts.e - {horizon} - day) / {period}::DOUBLE) >= 0
  THEN least(floor((pts.e - {horizon} - day) / {period}::DOUBLE)::INT, lc) ELSE -1 END AS cut FROM pts JOIN lasts USING (product_id)),
{solve_sql(design, f"(CASE WHEN cut = -1 THEN 1.0::DOUBLE ELSE (e - {horizon} - cut * {period} - s) / greatest(e - s, 1)::DOUBLE END)")},
tests AS (SELECT pts.product_id, cuts.cut, y, x FROM pts JOIN cuts ON pts.product_id = cuts.product_id AND cuts.cut >= 0
  AND day > cuts.e - {horizon} - cuts.cut * {period} AND day <= cuts.e - cuts.cut * {period}),
held AS (SELECT product_id, y, list_inner_product(x, beta) AS m, half AS h FROM tests JOIN fits USING (product_id, cut)),
scores AS (SELECT product_id, avg(abs(y - m) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS mape, sqrt(avg((y - m) * (y - m))) AS rmse,
  avg(abs(y - m)) AS mae, avg(CASE WHEN y >= m - h AND y <= m + h THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS coverage FROM held GROUP BY 1),
days AS (SELECT product_id, s, e, e + unnest(range(1, {horizon + 1})) AS day FROM spans),
dated AS (SELECT *, DATE '1970-01-01' + CAST(day AS INT) AS date FROM days),
ahead AS (SELECT product_id, date, {future} AS x FROM dated),
drawn AS (SELECT product_id, date AS ds, list_inner_product(x, beta) AS m, half AS h FROM ahead JOIN fits USING (product_id) WHERE cut = -1)
SELECT product_id, ds, round(m, 4) AS yhat, round(m - h, 4) AS yhat_lower, round(m + h, 4) AS yhat_upper,
  round(mape, 4) AS mape, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(coverage, 4) AS coverage FROM drawn LEFT JOIN scores USING (product_id)"""


def by_horizon(design: Design, horizons: list[int], minimum: int) -> str:
    passed = ", ".join(f"CASE WHEN b > {h} THEN {h} ELSE -1 END" for h in horizons)
    return f"""
WITH RECURSIVE {points_sql(design, 2)},
tasks AS (SELECT product_id, s, e, n, unnest({horizons})::INT AS cut FROM spans),
cuts AS (SELECT * FROM tasks WHERE n >= cut + {minimum}),
seg AS (SELECT product_id, x, y, greatest({passed}) AS cut FROM pts),
{solve_sql(design, "1.25::DOUBLE")},
measured AS (SELECT product_id, cut, avg(abs(y - list_inner_product(x, beta)) / CASE WHEN abs(y) < 1e-8 THEN 1.0::DOUBLE ELSE abs(y) END) AS mape
  FROM pts JOIN cuts USING (product_id) JOIN fits USING (product_id, cut) WHERE b <= cut GROUP BY ALL)
SELECT product_id, cut AS h, round(mape, 4) AS mape FROM tasks LEFT JOIN measured USING (product_id, cut)"""


def bands(design: Design, source: str, horizon: int, minimum: int = 60) -> str:
    """CTEs up to ``qf`` (product_id, date, p10, p50, p90): the curve moved by the quantiles of its residuals."""
    x = row_sql(design, "day")
    value = lambda i: f"round(greatest(0, m + q[2] + (q[{i}] - q[2]) * wide), 4)"
    return f"""{points_sql(design, minimum, source=source)},
cuts AS (SELECT product_id, s, e, -1 AS cut FROM spans),
seg AS (SELECT product_id, -1 AS cut, x, y FROM pts),
{solve_sql(design, "1.25::DOUBLE")},
edges AS (SELECT product_id, quantile_cont(y - list_inner_product(x, beta), [0.1, 0.5, 0.9]) AS q FROM pts JOIN fits USING (product_id) GROUP BY 1),
days AS (SELECT product_id, s, e, unnest(range(1, {horizon + 1})) AS step FROM spans),
dated AS (SELECT product_id, s, e, step, e + step AS day FROM days),
ahead AS (SELECT product_id, step, DATE '1970-01-01' + CAST(day AS INT) AS date, {x} AS x FROM dated),
drawn AS (SELECT product_id, date, sqrt(1 + step / 30.0::DOUBLE) AS wide, list_inner_product(x, beta) AS m, q FROM ahead JOIN fits USING (product_id) JOIN edges USING (product_id)),
qf AS (SELECT product_id, date, {value(1)} AS p10, {value(2)} AS p50, {value(3)} AS p90 FROM drawn)"""
