"""Least squares as SQL text, for the SQL counterparts of regressions.

The normal equations are solved by Gauss-Jordan elimination in a recursive
query on lists; the engine's own solver (a pseudo-inverse in Arrow batches) has
nothing in common with it.
"""

from __future__ import annotations


def ols_ctes(name: str, src: str, keys: str, xs: list[str], y: str) -> str:
    """CTEs that end in ``name``: keys, n, beta, inv (inverse cross product), sse, sst.

    ``xs`` are SQL expressions of the predictors after the intercept; rows in
    which any is NULL are left out.  Needs WITH RECURSIVE.
    """
    q = len(xs) + 1
    cells = ", ".join("[" + ", ".join(f"sum(x[{i}] * x[{j}])" for j in range(1, q + 1)) + f", sum(x[{i}] * y), "
                      + ", ".join("1.0::DOUBLE" if i == j else "0.0::DOUBLE" for j in range(1, q + 1)) + "]" for i in range(1, q + 1))
    known = " AND ".join(f"({e}) IS NOT NULL" for e in [*xs, y])
    on = ", ".join(keys.split(", "))
    return f"""{name}_x AS (SELECT {keys}, [1.0::DOUBLE, {", ".join(f"({e})::DOUBLE" for e in xs)}] AS x, ({y})::DOUBLE AS y FROM {src} WHERE {known}),
{name}_g AS (SELECT {keys}, count(*) AS n, sum(y * y) AS yy, sum(y) AS sy, [{cells}] AS m FROM {name}_x GROUP BY {on}),
{name}_j AS (SELECT {keys}, 0 AS k, m FROM {name}_g
  UNION ALL SELECT {keys}, k + 1, [CASE WHEN i = k + 1 THEN [v / m[k + 1][k + 1] FOR v IN m[k + 1]]
    ELSE [m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] FOR j IN range(1, {2 * q + 2})] END FOR i IN range(1, {q + 1})]
  FROM {name}_j WHERE k < {q}),
{name}_b AS (SELECT g.*, [j.m[i][{q + 1}] FOR i IN range(1, {q + 1})] AS beta, [j.m[i][{q + 2}:{2 * q + 1}] FOR i IN range(1, {q + 1})] AS inv
  FROM {name}_g g JOIN {name}_j j USING ({keys}) WHERE j.k = {q}),
{name}_r AS (SELECT {keys}, sum(pow(y - list_dot_product(x, beta), 2)) AS sse FROM {name}_x JOIN {name}_b USING ({keys}) GROUP BY {on}),
{name} AS (SELECT {keys}, n, beta, inv, sse, yy - sy * sy / n AS sst FROM {name}_b JOIN {name}_r USING ({keys}))"""


def t_tail_sql(stat: str, dof: str, steps: int = 2000) -> str:
    """Two-sided Student-t tail by Simpson's rule on the angle form."""
    def area(low: str) -> str:
        point = f"({low} + (pi() / 2 - {low}) * i / {steps})"
        weight = f"(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
        return f"(list_sum([{weight} * pow(greatest(cos({point}), 0), {dof} - 1) FOR i IN range(0, {steps + 1})]) * (pi() / 2 - {low}))"
    return f"{area(f'atan(abs({stat}) / sqrt({dof}))')} / {area('0')}"


def tidy_sql(name: str, keys: str, terms: list[str], model: str = "tslm") -> str:
    """keys, model, term, estimate, std_error, statistic, p_value of the fit ``name``."""
    q = len(terms) + 1
    names = ", ".join(f"'{t}'" for t in ["intercept", *terms])
    return f"""SELECT {keys}, model, term, estimate, std_error, statistic, {t_tail_sql('statistic', 'dof')} AS p_value FROM (
  SELECT {keys}, '{model}' AS model, [{names}][i] AS term, beta[i] AS estimate, sqrt(inv[i][i] * sse / (n - {q})) AS std_error,
    beta[i] / nullif(sqrt(inv[i][i] * sse / (n - {q})), 0) AS statistic, (n - {q})::DOUBLE AS dof
  FROM {name}, (SELECT unnest(range(1, {q + 1})) AS i))"""
