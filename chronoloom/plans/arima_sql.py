"""ARIMA(1,1,1) and the filling of gaps as SQL text, for the SQL counterparts."""

from __future__ import annotations


def solve_ctes(name: str, src: str, keys: str, m: str, q: int) -> str:
    """CTE ``name`` (keys, x): solution of a q x q system by elimination.

    ``m`` is a list of rows [a_1, ..., a_q, right-hand side].  Needs WITH RECURSIVE.
    """
    return f"""{name}_j AS (SELECT {keys}, 0 AS k, {m} AS m FROM {src}
  UNION ALL SELECT {keys}, k + 1, [CASE WHEN i = k + 1 THEN [v / m[k + 1][k + 1] FOR v IN m[k + 1]]
    ELSE [m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] FOR j IN range(1, {q + 2})] END FOR i IN range(1, {q + 1})]
  FROM {name}_j WHERE k < {q}),
{name} AS (SELECT {keys}, [m[i][{q + 1}] FOR i IN range(1, {q + 1})] AS x FROM {name}_j WHERE k = {q})"""


def arma11_ctes(src: str, lags: int) -> str:
    """CTE ar_f: priority, phi, theta, n, sse, s2 and the sums of the two-term regression on the differences of ``src``."""
    back = ", ".join(f"lag(x, {k}) OVER p AS x{k}" for k in range(1, lags + 1))
    sums = ", ".join(["sum(x * x)", *[f"coalesce(sum(x * x{k}), 0)" for k in range(1, lags + 1)]])
    toeplitz = "[" + ", ".join("[" + ", ".join([*[f"c[{abs(i - j) + 1}]" for j in range(lags)], f"c[{i + 2}]"]) + "]" for i in range(lags)) + "]"
    fit = " - ".join(["l.x", *[f"s.x[{k}] * x{k}" for k in range(1, lags + 1)]])
    return f"""ar_w AS (SELECT priority, t, y - lag(y) OVER (PARTITION BY priority ORDER BY t) AS w FROM {src}),
ar_x AS (SELECT priority, t, w, w - avg(w) OVER (PARTITION BY priority) AS x FROM ar_w WHERE w IS NOT NULL),
ar_l AS (SELECT *, {back} FROM ar_x WINDOW p AS (PARTITION BY priority ORDER BY t)),
ar_c AS (SELECT priority, [{sums}] AS c FROM ar_l GROUP BY priority),
{solve_ctes("ar_s", "ar_c", "priority", toeplitz, lags)},
ar_i AS (SELECT l.priority, t, w, {fit} AS e FROM ar_l l JOIN ar_s s USING (priority)),
ar_p AS (SELECT priority, w, lag(w) OVER p AS a, lag(e) OVER p AS b FROM ar_i WINDOW p AS (PARTITION BY priority ORDER BY t)),
ar_g AS (SELECT priority, count(*) AS n, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a * w) AS saw, sum(b * w) AS sbw, sum(w * w) AS sww
  FROM ar_p WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY priority),
ar_f AS (SELECT * REPLACE (least(greatest(phi, -1 / 1.001), 1 / 1.001) AS phi, least(greatest(theta, -1 / 1.001), 1 / 1.001) AS theta), sse / (n - 2) AS s2 FROM (SELECT *, sww - phi * saw - theta * sbw AS sse FROM (
  SELECT *, saa * sbb - sab * sab AS det, (saw * sbb - sbw * sab) / (saa * sbb - sab * sab) AS phi, (sbw * saa - saw * sab) / (saa * sbb - sab * sab) AS theta FROM ar_g)))"""


def innovation_ctes(src: str) -> str:
    """CTE ar_e: priority, t, month, y, w, e under the coefficients of ar_f, one row after the other."""
    return f"""ar_y AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i, lag(w) OVER (PARTITION BY priority ORDER BY t) AS w1
  FROM (SELECT priority, t, month, y, y - lag(y) OVER (PARTITION BY priority ORDER BY t) AS w FROM {src})),
ar_r AS (SELECT priority, i, 0.0::DOUBLE AS e FROM ar_y WHERE i = 2
  UNION ALL SELECT r.priority, y.i, y.w - phi * y.w1 - theta * r.e FROM ar_r r JOIN ar_y y ON y.priority = r.priority AND y.i = r.i + 1 JOIN ar_f f ON f.priority = r.priority),
ar_e AS (SELECT y.priority, t, month, y, w, CASE WHEN y.i > 2 THEN r.e END AS e FROM ar_y y LEFT JOIN ar_r r ON r.priority = y.priority AND r.i = y.i)"""


def gap_sql(src: str, key: str, index: str) -> str:
    """ARIMA(1,1,0) through the known neighbours, then both recursions through every row, and their weighted mean in gaps."""
    def way(name: str, order: str) -> str:
        return f"""{name}_n AS (SELECT {key}, t, y, row_number() OVER (PARTITION BY {key} ORDER BY t {order}) AS i FROM {src}),
{name}_h AS (SELECT {key}, list(y ORDER BY i) AS h FROM {name}_n WHERE y IS NOT NULL GROUP BY {key}),
{name} AS (SELECT {key}, 0 AS i, h[1] AS f, CASE WHEN len(h) > 1 THEN h[2] ELSE h[1] END AS f1 FROM {name}_h
  UNION ALL SELECT r.{key}, n.i, coalesce(n.y, r.f + phi * (r.f - r.f1)), r.f FROM {name} r JOIN {name}_n n ON n.{key} = r.{key} AND n.i = r.i + 1
  JOIN g_f f ON f.{key} = r.{key}),
{name}_t AS (SELECT {key}, t, f FROM {name} JOIN {name}_n USING ({key}, i))"""
    variance = lambda n: f"list_sum([pow(list_sum([pow(phi, l) FOR l IN range(0, j + 1)]), 2) FOR j IN range(0, {n})])"
    return f"""g_w AS (SELECT {key}, t, w, lag(w) OVER (PARTITION BY {key} ORDER BY t) AS w1 FROM (
  SELECT {key}, t, y - lag(y) OVER (PARTITION BY {key} ORDER BY t) AS w FROM {src})),
g_f AS (SELECT {key}, sum(w * w1) / sum(w1 * w1) AS phi FROM g_w WHERE w IS NOT NULL AND w1 IS NOT NULL GROUP BY {key}),
{way("g_a", "ASC")},
{way("g_b", "DESC")},
g_e AS (SELECT {key}, {index}, t, y, t - max(CASE WHEN y IS NOT NULL THEN t END) OVER (PARTITION BY {key} ORDER BY t) AS i,
  min(CASE WHEN y IS NOT NULL THEN t END) OVER (PARTITION BY {key} ORDER BY t DESC) - t AS j FROM {src})
SELECT {key}, {index}, CASE WHEN y IS NOT NULL THEN y WHEN i IS NULL THEN b.f WHEN j IS NULL THEN a.f
  ELSE (a.f / {variance("i")} + b.f / {variance("j")}) / (1 / {variance("i")} + 1 / {variance("j")}) END AS filled
FROM g_e JOIN g_f USING ({key}) JOIN g_a_t a USING ({key}, t) JOIN g_b_t b USING ({key}, t)"""
