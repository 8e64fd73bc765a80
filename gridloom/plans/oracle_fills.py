"""DuckDB SQL of the curved and spatial fills: linear systems solved step by step in recursive queries.

Each function returns CTEs that turn a source table (ts, date, grid_id, columns) into one with the same
columns filled.  The SQL works on its own formulations (second derivatives for cubic splines, collocation
for the others, the full system with unit rows for missing nodes), not on those of the Spark code.
"""

from __future__ import annotations


def solve(name: str, src: str) -> str:
    """``name`` (id, x) from ``src`` (id, n, m): m is the n x (n + 1) augmented matrix; elimination in order."""
    return f"""{name}_steps AS (
  SELECT id, n, 0 AS k, m FROM {src}
  UNION ALL
  SELECT id, n, k + 1, list_transform(range(n), lambda i: CASE WHEN i = k THEN p ELSE
    list_transform(range(n + 1), lambda j: m[i + 1][j + 1] - m[i + 1][k + 1] * p[j + 1]) END)
  FROM (SELECT *, list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1]) AS p FROM {name}_steps WHERE k < n)),
{name} AS (SELECT id, list_transform(m, lambda r: r[n + 1]) AS x FROM {name}_steps WHERE k = n)"""


def _series(p: str, src: str, col: str) -> str:
    """Series of one column that pass the gate: all values by position, the known positions (xs) and values (ys)."""
    return f"""{p}_s AS (
  SELECT date, grid_id, date || '/' || grid_id AS id, list({col} ORDER BY ts) AS v,
         list(hour(ts)::DOUBLE ORDER BY ts) FILTER (WHERE {col} IS NOT NULL) AS xs,
         list({col} ORDER BY ts) FILTER (WHERE {col} IS NOT NULL) AS ys
  FROM {src} GROUP BY date, grid_id HAVING count({col}) BETWEEN 0.8 * count(*) AND count(*) - 1)"""


def _edges(est: str) -> str:
    """The estimate inside the known positions, the nearest known value outside; ``x`` is the position."""
    return f"CASE WHEN x < xs[1] THEN ys[1] WHEN x > xs[len(xs)] THEN ys[len(ys)] ELSE {est} END"


def _cubic(p: str, src: str, col: str) -> str:
    """Not-a-knot cubic through its second derivatives; CTE ``p`` (date, grid_id, x, est)."""
    h = "(xs[{0} + 1] - xs[{0}])".format
    inner = (f"CASE WHEN j = i - 1 THEN {h('i')} WHEN j = i THEN 2 * ({h('i')} + {h('(i + 1)')}) WHEN j = i + 1 THEN {h('(i + 1)')} "
             f"WHEN j = n THEN 6 * ((ys[i + 2] - ys[i + 1]) / {h('(i + 1)')} - (ys[i + 1] - ys[i]) / {h('i')}) ELSE 0 END")
    first = f"CASE j WHEN 0 THEN {h('2')} WHEN 1 THEN -({h('1')} + {h('2')}) WHEN 2 THEN {h('1')} ELSE 0 END"
    last = f"CASE j WHEN n - 3 THEN {h('(n - 1)')} WHEN n - 2 THEN -({h('(n - 2)')} + {h('(n - 1)')}) WHEN n - 1 THEN {h('(n - 2)')} ELSE 0 END"
    est = (f"ms[q] * pow(xs[q + 1] - x, 3) / (6 * {h('q')}) + ms[q + 1] * pow(x - xs[q], 3) / (6 * {h('q')}) "
           f"+ (ys[q] / {h('q')} - ms[q] * {h('q')} / 6) * (xs[q + 1] - x) + (ys[q + 1] / {h('q')} - ms[q + 1] * {h('q')} / 6) * (x - xs[q])")
    return f"""{_series(p, src, col)},
{p}_m AS (
  SELECT id, n, list_transform(range(n), lambda i: list_transform(range(n + 1), lambda j: (
    CASE WHEN i = 0 THEN {first} WHEN i = n - 1 THEN {last} ELSE {inner} END)::DOUBLE)) AS m
  FROM (SELECT *, len(xs) AS n FROM {p}_s)),
{solve(p + '_x', p + '_m')},
{p}_p AS (
  SELECT date, grid_id, xs, ys, s.x AS ms, g.x AS x, len(list_filter(xs[1:len(xs) - 1], lambda k: k <= g.x)) AS q
  FROM {p}_s JOIN {p}_x s USING (id), LATERAL (SELECT unnest(range(24))::DOUBLE AS x) g),
{p} AS (SELECT date, grid_id, x, {_edges(est)} AS est FROM {p}_p)"""


def _quadratic(p: str, src: str, col: str) -> str:
    """Interpolating spline of order 2 with inner knots at midpoints, by collocation; CTE ``p`` (date, grid_id, x, est)."""
    step = ("CASE WHEN tk[j + {d} + 1] > tk[j + 1] THEN (x - tk[j + 1]) / (tk[j + {d} + 1] - tk[j + 1]) * b{e}[j + 1] ELSE 0 END + "
            "CASE WHEN tk[j + {d} + 2] > tk[j + 2] THEN (tk[j + {d} + 2] - x) / (tk[j + {d} + 2] - tk[j + 2]) * b{e}[j + 2] ELSE 0 END").format
    return f"""{_series(p, src, col)},
{p}_t AS (
  SELECT *, len(xs) AS n, list_concat([xs[1], xs[1], xs[1]], list_transform(range(2, len(xs) - 1), lambda k: (xs[k] + xs[k + 1]) / 2),
    [xs[len(xs)], xs[len(xs)], xs[len(xs)]]) AS tk FROM {p}_s),
{p}_0 AS (
  SELECT t.*, g.x, list_transform(range(n + 2), lambda j: CASE WHEN g.x = xs[n] THEN (j = n - 1) ELSE tk[j + 1] <= g.x AND g.x < tk[j + 2] END::DOUBLE) AS b0
  FROM {p}_t t, LATERAL (SELECT unnest(range(24))::DOUBLE AS x) g),
{p}_1 AS (SELECT *, list_transform(range(n + 1), lambda j: {step(d=1, e=0)}) AS b1 FROM {p}_0),
{p}_2 AS (SELECT *, list_transform(range(n), lambda j: {step(d=2, e=1)}) AS b2 FROM {p}_1),
{p}_m AS (
  SELECT id, any_value(n) AS n, list(list_append(b2, v[x::INT + 1]) ORDER BY x) AS m FROM {p}_2 WHERE v[x::INT + 1] IS NOT NULL GROUP BY id),
{solve(p + '_x', p + '_m')},
{p} AS (
  SELECT date, grid_id, b.x, {_edges('list_sum(list_transform(range(n), lambda j: b2[j + 1] * s.x[j + 1]))').replace('x <', 'b.x <').replace('x >', 'b.x >')} AS est
  FROM {p}_2 b JOIN {p}_x s USING (id))"""


def temporal(name: str, src: str, columns: dict[str, str], keep: list[str], linear_expr) -> str:
    """``name``: ``src`` with its ``columns`` (column -> cubic, quadratic or linear) filled along each day; ``keep`` passes."""
    parts, picks, joins, before = [], [], [], list(keep)
    for c, how in columns.items():
        if how == "linear":
            before.append(linear_expr(c, c.startswith("rain")))
            picks.append(f"f.{c}")
            continue
        p = f"{name}_{c}"
        before.append(c)
        parts.append((_cubic if how == "cubic" else _quadratic)(p, src, c))
        joins.append(f"LEFT JOIN {p} ON {p}.date = f.date AND {p}.grid_id = f.grid_id AND {p}.x = hour(f.ts)")
        picks.append(f"coalesce(f.{c}, {p}.est) AS {c}")
    return ",\n".join([*parts, f"""{name}_f AS (SELECT *, CAST(row_number() OVER (PARTITION BY date, grid_id ORDER BY ts) AS DOUBLE) AS pos
  FROM (SELECT * FROM {src})),
{name}_l AS (SELECT {', '.join(before)} FROM {name}_f),
{name} AS (SELECT {', '.join('f.' + k for k in keep)}, {', '.join(picks)} FROM {name}_l f {' '.join(joins)})"""])


def spatial(name: str, src: str, columns: list[str], keep: list[str], n: int, centers: str) -> str:
    """``name``: ``src`` with ``columns`` filled per time by a multiquadric over the z-scored ``centers`` of n grids."""
    parts = [f"""{name}_c AS (SELECT grid_id, (lon_center - avg(lon_center) OVER ()) / CASE WHEN stddev_pop(lon_center) OVER () = 0 THEN 1 ELSE stddev_pop(lon_center) OVER () END AS x,
    (lat_center - avg(lat_center) OVER ()) / CASE WHEN stddev_pop(lat_center) OVER () = 0 THEN 1 ELSE stddev_pop(lat_center) OVER () END AS y FROM {centers}),
{name}_r AS (SELECT a.grid_id, list(sqrt((pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) / 4 + 1) ORDER BY b.grid_id) AS r FROM {name}_c a, {name}_c b GROUP BY a.grid_id),
{name}_phi AS (SELECT list(r ORDER BY grid_id) AS phi FROM {name}_r)"""]
    picks, joins = [], []
    for c in columns:
        p = f"{name}_{c}"
        parts.append(f"""{p}_v AS (SELECT ts, list({c} ORDER BY grid_id) AS v FROM {src} GROUP BY ts HAVING count({c}) BETWEEN 0.8 * {n} AND {n} - 1),
{p}_m AS (
  SELECT ts AS id, {n} AS n, list_transform(range({n}), lambda i: list_transform(range({n} + 1), lambda j: (
    CASE WHEN v[i + 1] IS NULL THEN (i = j)::INT WHEN j = {n} THEN v[i + 1] WHEN v[j + 1] IS NULL THEN 0
         ELSE phi[i + 1][j + 1] - CASE WHEN i = j THEN 1e-6 ELSE 0 END END)::DOUBLE)) AS m FROM {p}_v, {name}_phi),
{solve(p + '_x', p + '_m')},
{p} AS (SELECT id AS ts, grid_id, list_sum(list_transform(range({n}), lambda j: r[j + 1] * x[j + 1])) AS est FROM {p}_x, {name}_r)""")
        joins.append(f"LEFT JOIN {p} ON {p}.ts = f.ts AND {p}.grid_id = f.grid_id")
        picks.append(f"coalesce(f.{c}, {p}.est) AS {c}")
    parts.append(f"{name} AS (SELECT {', '.join('f.' + k for k in keep)}, {', '.join(picks)} FROM {src} f {' '.join(joins)})")
    return ",\n".join(parts)
