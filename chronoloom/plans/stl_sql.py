"""SQL counterparts of the loess decompositions: every local line is a sum over a self-join."""

from __future__ import annotations

from itertools import count

from chronoloom.operators.decompose import centred_weights, henderson_weights, next_odd


def _loess(points: str, grid: str, k: str, q: int, keep: str = "") -> str:
    """Local lines at grid(k.., pos, lo, hi, keep..) through points(k.., p, v, w)."""
    names = [c for c in keep.split(", ") if c]
    kept = "".join(f", {c}" for c in names)
    on = " AND ".join(f"x.{c} = g.{c}" for c in k.split(", "))
    cols = ", ".join(f"g.{c}" for c in [*k.split(", "), *names])
    return f"""SELECT {k}{kept}, pos, CASE WHEN s0 * s2 - s1 * s1 > 1e-6 * s0 * s0 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / nullif(s0, 0) END AS fit
  FROM (SELECT {k}{kept}, pos, sum(kw) AS s0, sum(kw * d) AS s1, sum(kw * d * d) AS s2, sum(kw * v) AS t0, sum(kw * v * d) AS t1
    FROM (SELECT *, w * CASE WHEN r > 0.999 THEN 0 WHEN r <= 0.001 THEN 1 ELSE pow(1 - pow(r, 3), 3) END AS kw
      FROM (SELECT {cols}, g.pos, x.p - g.pos AS d, x.v, x.w, abs(x.p - g.pos) / CAST(greatest(g.pos - l, r - g.pos) + greatest(({q} - (hi - lo + 1)) // 2, 0) AS DOUBLE) AS r
        FROM (SELECT *, CASE WHEN hi - lo + 1 <= {q} THEN lo ELSE least(greatest(pos - {q // 2}, lo), hi - {q} + 1) END AS l,
                CASE WHEN hi - lo + 1 <= {q} THEN hi ELSE least(greatest(pos - {q // 2}, lo), hi - {q} + 1) + {q} - 1 END AS r FROM ({grid})) g
        JOIN ({points}) x ON {on} AND x.p BETWEEN g.l AND g.r))
    GROUP BY ALL)"""


class StlSql:
    """Named steps of a decomposition; ``ctes`` collects them in order."""

    def __init__(self, key: str):
        self.k, self.ctes, self._n = key, [], count()

    def add(self, sql: str) -> str:
        name = f"z{next(self._n)}"
        self.ctes.append(f"{name} AS MATERIALIZED ({sql})")
        return name

    def start(self, source: str, y: str) -> str:
        """(k, t, y, w, lo, hi, tr, se) of a series table."""
        return self.add(f"""SELECT {self.k}, t, CAST({y} AS DOUBLE) AS y, 1.0::DOUBLE AS w, min(t) OVER o AS lo, max(t) OVER o AS hi, 0.0::DOUBLE AS tr, 0.0::DOUBLE AS se
  FROM {source} WINDOW o AS (PARTITION BY {self.k})""")

    def one_pass(self, cur: str, m: int, s_window, t_window: int | None = None) -> str:
        k = self.k
        s = 10 ** 6 if s_window == "periodic" else s_window
        t_window = t_window or next_odd(1.5 * m / (1 - 1.5 / s))
        b = self.add(f"""SELECT *, y - tr AS d, t % {m} AS ph, t // {m} AS c, CAST(ceil((lo - t % {m}) / {m}) AS BIGINT) AS cl,
  CAST(floor((hi - t % {m}) / {m}) AS BIGINT) AS ch FROM {cur}""")
        ends = f"unnest(CASE WHEN t < lo + {m} AND t > hi - {m} THEN [-1, 0, 1] WHEN t < lo + {m} THEN [-1, 0] WHEN t > hi - {m} THEN [0, 1] ELSE [0] END)"
        if s_window == "periodic":
            cyc = self.add(f"""SELECT {k}, t + e * {m} AS t, f AS cyc FROM (SELECT *, {ends} AS e FROM (
  SELECT *, sum(d * w) OVER o / nullif(sum(w) OVER o, 0) AS f FROM {b} WINDOW o AS (PARTITION BY {k}, ph)))""")
        else:
            grid = f"SELECT {k}, ph, c + e AS pos, cl AS lo, ch AS hi FROM (SELECT *, {ends} AS e FROM {b})"
            fits = self.add(_loess(f"SELECT {k}, ph, c AS p, d AS v, w FROM {b}", grid, f"{k}, ph", s_window))
            cyc = self.add(f"SELECT {k}, pos * {m} + ph AS t, fit AS cyc FROM {fits}")
        w = f"OVER (PARTITION BY {k} ORDER BY t ROWS BETWEEN {{}} PRECEDING AND CURRENT ROW)"
        ma1 = self.add(f"SELECT {k}, t, avg(cyc) {w.format(m - 1)} AS a FROM {cyc}")
        ma2 = self.add(f"SELECT {k}, t, avg(a) {w.format(m - 1)} AS a FROM {ma1}")
        low = self.add(f"SELECT {k}, t - {m} AS t, avg(a) {w.format(2)} AS low FROM {ma2}")
        key_t = f"({k}, t)"
        span = self.add(f"SELECT {k}, t, low, lo, hi FROM {low} JOIN {cur} USING {key_t}")
        lp = self.add(_loess(f"SELECT {k}, t AS p, low AS v, 1.0::DOUBLE AS w FROM {span}", f"SELECT {k}, t AS pos, lo, hi FROM {span}", k, next_odd(m)))
        se = self.add(f"""SELECT {k}, t, y, w, lo, hi, cyc - fit AS se FROM {cur} JOIN {cyc} USING {key_t}
  JOIN (SELECT {k}, pos AS t, fit FROM {lp}) USING {key_t}""")
        tr = self.add(_loess(f"SELECT {k}, t AS p, y - se AS v, w FROM {se}", f"SELECT {k}, t AS pos, lo, hi FROM {se}", k, t_window))
        return self.add(f"SELECT {k}, t, y, w, lo, hi, fit AS tr, se FROM {se} JOIN (SELECT {k}, pos AS t, fit FROM {tr}) USING {key_t}")

    def weights(self, cur: str) -> str:
        """Bisquare weights of the remainders."""
        return self.add(f"""SELECT * EXCLUDE (u) REPLACE (CASE WHEN u IS NULL OR u <= 0.001 THEN 1.0 WHEN u > 0.999 THEN 0.0 ELSE pow(1 - u * u, 2) END AS w)
  FROM (SELECT *, abs(y - tr - se) / nullif(6 * quantile_cont(abs(y - tr - se), 0.5) OVER (PARTITION BY {self.k}), 0) AS u FROM {cur})""")

    def stl(self, source: str, y: str, m: int, s_window=11, robust: bool = False, inner: int = 2, outer: int = 5) -> str:
        cur = self.start(source, y)
        for _ in range(1 if robust else inner):
            cur = self.one_pass(cur, m, s_window)
        for _ in range(outer if robust else 0):
            cur = self.one_pass(self.weights(cur), m, s_window)
        return self.add(f"SELECT {self.k}, t, y, tr AS trend, se AS season, y - tr - se AS remainder, y - se AS season_adjust FROM {cur}")

    def multi(self, source: str, y: str, periods: list[int], rounds: int = 2, robust: bool = False, outer: int = 3) -> str:
        k = self.k
        seasons = [f"season_{p}" for p in sorted(periods)]
        total = " + ".join(seasons)
        base = self.add(f"""SELECT {k}, t, CAST({y} AS DOUBLE) AS yy, 1.0::DOUBLE AS w, min(t) OVER o AS lo, max(t) OVER o AS hi, 0.0::DOUBLE AS tr,
  {', '.join(f'0.0::DOUBLE AS {s}' for s in seasons)} FROM {source} WINDOW o AS (PARTITION BY {k})""")
        for r in range(1 + outer if robust else rounds):
            if robust and r:
                base = self.add(f"SELECT * EXCLUDE (y, se) FROM {self.weights(f'(SELECT *, yy AS y, {total} AS se FROM {base})')}")
            for i, (p, s) in enumerate(zip(sorted(periods), seasons)):
                others = " + ".join(["0.0", *[o for o in seasons if o != s]])
                cur = self.add(f"SELECT {k}, t, yy - ({others}) AS y, w, lo, hi, tr, 0.0::DOUBLE AS se FROM {base}")
                got = self.one_pass(cur, p, 11 + 4 * i)
                base = self.add(f"SELECT b.* REPLACE (g.tr AS tr, g.se AS {s}) FROM {base} b JOIN (SELECT {k}, t, tr, se FROM {got}) g USING ({k}, t)")
        return self.add(f"SELECT {k}, t, yy AS y, tr AS trend, {', '.join(seasons)}, yy - tr - ({total}) AS remainder, yy - ({total}) AS season_adjust FROM {base}")


def stl_query(prefix: str, source: str, key: str, index: str = "month", m: int = 12, body: str | None = None, more: tuple[str, ...] = (), **kw) -> str:
    """The decomposition of ``y`` in ``source`` (a step of ``prefix``) as rows, or what ``more`` steps and ``body`` make of {d}."""
    sql = StlSql(key)
    d = sql.stl(source, "y", m, **kw)
    body = body or f"""SELECT {key}, {index}, {source}.y, trend, season, remainder, season_adjust
FROM {source} JOIN (SELECT * EXCLUDE (y) FROM {{d}}) USING ({key}, t)"""
    return "WITH " + ",\n".join([prefix, *sql.ctes, *more]).replace("{d}", d) + "\n" + body.replace("{d}", d)


def multi_query(prefix: str, source: str, key: str, index: str, y: str, periods: list[int], **kw) -> str:
    sql = StlSql(key)
    d = sql.multi(source, y, periods, **kw)
    return "WITH " + ",\n".join([prefix, *sql.ctes]) + f"\nSELECT {key}, {index}, {{d}}.* EXCLUDE ({key}) RENAME (y AS {y}) FROM {{d}} JOIN (SELECT {key}, t, {index} FROM {source}) USING ({key}, t)".replace("{d}", d)


#: Features of the decomposition {d} of monthly series.
STRENGTHS = ("""zn AS (SELECT priority, avg(remainder) AS rm, min(t) AS t0, count(*)::DOUBLE AS n FROM {d} GROUP BY priority)""",
    """zc AS (SELECT *, remainder - rm AS r, t - t0 - (n - 1) / 2 AS c FROM {d} JOIN zn USING (priority))""",
    """zs AS (SELECT priority, greatest(0, 1 - var_samp(remainder) / nullif(var_samp(trend + remainder), 0)) AS trend_strength,
  greatest(0, 1 - var_samp(remainder) / nullif(var_samp(season + remainder), 0)) AS seasonal_strength,
  var_samp(r * r) / pow(any_value(n) - 2, 2) AS spikiness,
  sum(trend * c) / sqrt(any_value(n * (n * n - 1) / 12)) AS linearity,
  sum(trend * (c * c - (n * n - 1) / 12)) / sqrt(any_value(n * (n * n - 1) * (n * n - 4) / 180)) AS curvature FROM zc GROUP BY priority)""",
    """zp AS (SELECT priority, max_by(p, s) AS seasonal_peak, min_by(p, s) AS seasonal_trough
  FROM (SELECT priority, t % 12 + 1 AS p, avg(season) AS s FROM {d} GROUP BY ALL) GROUP BY priority)""",
    """za AS (SELECT a.priority AS priority, b.t - a.t AS lag, sum(a.r * b.r) / any_value(v) AS r FROM zc a JOIN zc b ON a.priority = b.priority AND b.t - a.t BETWEEN 1 AND 10
  JOIN (SELECT priority, sum(r * r) AS v FROM zc GROUP BY priority) q ON q.priority = a.priority GROUP BY ALL)""",
    """ze AS (SELECT priority, max(r) FILTER (lag = 1) AS stl_e_acf1, sum(r * r) AS stl_e_acf10 FROM za GROUP BY priority)""")


def _weighted(source: str, v: str, weights: list[float], m: int = 1, full: bool = False) -> str:
    """Centred weighted means over every m-th period; at the ends the weights that are left count (or none, with ``full``)."""
    half = len(weights) // 2
    w = "([" + ", ".join(repr(float(x)) for x in weights) + "]::DOUBLE[])"
    mean = f"sum(x.{v} * {w}[(x.t - g.t) // {m} + {half + 1}]) / sum(CASE WHEN x.{v} IS NOT NULL THEN {w}[(x.t - g.t) // {m} + {half + 1}] END)"
    if full:
        mean = f"CASE WHEN count(x.{v}) = {len(weights)} THEN {mean} END"
    return f"""SELECT g.priority, g.t, any_value(g.y) AS y, {mean} AS f FROM {source} g
  JOIN {source} x ON x.priority = g.priority AND x.t - g.t BETWEEN {-half * m} AND {half * m} AND (x.t - g.t) % {m} = 0 GROUP BY g.priority, g.t"""


def x11_query(prefix: str, source: str, m: int = 12, n_h: int = 13) -> str:
    ctes = [prefix]

    def add(name, sql):
        ctes.append(f"{name} AS MATERIALIZED ({sql})")
        return name

    trend = add("x0", _weighted(source, "y", centred_weights(m), full=True))
    for i, weights in enumerate(([1, 2, 3, 2, 1], [1, 2, 3, 3, 3, 2, 1])):
        si = add(f"xa{i}", f"SELECT priority, t, y, y - f AS v FROM {trend}")
        raw = add(f"xb{i}", _weighted(si, "v", [x / sum(weights) for x in weights], m))
        lvl = add(f"xc{i}", _weighted(raw, "f", centred_weights(m)))
        sa = add(f"xd{i}", f"SELECT r.priority, r.t, r.y, r.f - l.f AS season, r.y - (r.f - l.f) AS v FROM {raw} r JOIN {lvl} l USING (priority, t)")
        trend = add(f"xe{i}", _weighted(sa, "v", henderson_weights(n_h)))
    return "WITH " + ",\n".join(ctes) + f"""
SELECT priority, month, {source}.y, f AS trend, season, {source}.y - f - season AS remainder, {source}.y - season AS season_adjust
FROM {source} JOIN (SELECT priority, t, f FROM {trend}) USING (priority, t) JOIN (SELECT priority, t, season FROM {sa}) USING (priority, t)"""


#: Last adjusted value, last cycle's season, naive errors.
STL_NAIVE = """SELECT e.priority, 'stl_naive' AS model, make_date((t1 + h) // 12, (t1 + h) % 12 + 1, 1) AS month, h, a1 + season AS mean, sqrt(s1 * h) AS sigma
FROM (SELECT priority, max(t) AS t1, max_by(season_adjust, t) AS a1, avg(pow(season_adjust - l, 2)) AS s1
      FROM (SELECT *, lag(season_adjust) OVER (PARTITION BY priority ORDER BY t) AS l FROM {d}) GROUP BY priority) e,
  (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS h) JOIN {d} s ON s.priority = e.priority AND s.t = t1 + h - 12"""
