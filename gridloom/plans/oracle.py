"""DuckDB SQL equivalents of the queries in ``gridloom.plans.queries``.

Written independently of the Spark code (window functions and plain aggregates
where the Spark side uses aggregate-based forms), against the pre-registered
views of the driver's tables.  Every float is rounded to 6 places, every count
cast to BIGINT, every time formatted as text, as ``present`` does on the Spark side.
"""

from __future__ import annotations

from gridloom.functions.physics import GRAVITY_KM
from gridloom.plans import oracle_fills
from gridloom.sources.schemas import FLOW_CELLS


def ts_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"


def day_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d')"


def obs_cte(n: int) -> str:
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    return f"""obs AS (
  SELECT date_trunc('hour', ts) AS ts,
         CAST(user_id % {n} AS BIGINT) AS grid_id,
         value / 10.0 AS t,
         CAST({k} AS DOUBLE) AS rh,
         CASE WHEN {k} = 99 THEN 0.0::DOUBLE ELSE 990.0::DOUBLE + {k} * 0.3::DOUBLE END AS slp,
         value AS speed,
         {k} * 3.6::DOUBLE AS dir,
         CASE WHEN event_type = 'error' THEN value ELSE 0.0::DOUBLE END AS rain,
         CAST(floor(event_id / 1000) AS BIGINT) AS page,
         event_id AS row_ord
  FROM events)"""


def dedup_cte(n: int) -> str:
    return obs_cte(n) + """,
spans AS (SELECT page, min(ts) AS span_start FROM obs GROUP BY page),
dedup AS (
  SELECT ts, grid_id, t, rh, slp, speed, dir, rain, page, row_ord FROM (
    SELECT o.*, row_number() OVER (PARTITION BY o.ts, o.grid_id
                                   ORDER BY s.span_start, o.page, o.row_ord) AS rn
    FROM obs o JOIN spans s ON o.page = s.page) WHERE rn = 1)"""


OBS_COLS = "ts, grid_id, t, rh, slp, speed, dir, rain, page, row_ord"


def obs_select(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (f"{ts_text(p + 'ts')} AS ts, {p}grid_id AS grid_id, round({p}t, 6) AS t, round({p}rh, 6) AS rh, "
            f"round({p}slp, 6) AS slp, round({p}speed, 6) AS speed, round({p}dir, 6) AS dir, "
            f"round({p}rain, 6) AS rain, {p}page AS page, {p}row_ord AS row_ord")


def hour_labels() -> str:
    return "[" + ", ".join(f"'{h:02d}:00'" for h in range(24)) + "]"


def completeness_sql(n: int) -> str:
    g = n
    return f"""WITH {dedup_cte(n)},
pc AS (
  SELECT CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS time_point, count(*) AS rows,
         count(DISTINCT grid_id) AS grids_present
  FROM dedup WHERE grid_id BETWEEN 0 AND {g - 1} GROUP BY 1, 2)
SELECT {day_text('date')} AS date,
       CAST(24 AS BIGINT) AS total_time_points,
       CAST(count(*) - count(*) FILTER (WHERE grids_present < {g}) AS BIGINT) AS complete_time_points,
       CAST(count(*) FILTER (WHERE grids_present < {g}) AS BIGINT) AS incomplete_time_points_count,
       CAST(24 - count(*) AS BIGINT) AS missing_time_points_count,
       CAST({24 * g} AS BIGINT) AS expected_points,
       CAST(sum(rows) AS BIGINT) AS actual_points,
       round(sum(rows) / {24 * g}.0, 6) AS completeness_ratio,
       array_to_string(list_sort(list_filter({hour_labels()}, lambda x: NOT list_contains(list(time_point), x))), ',')
         AS missing_time_points,
       coalesce(string_agg(time_point || '=' || CAST({g} - grids_present AS VARCHAR), ',' ORDER BY time_point)
                FILTER (WHERE grids_present < {g}), '') AS incomplete_time_points
FROM pc GROUP BY date"""


def missing_cells_cte(n: int) -> str:
    return f"""{dedup_cte(n)},
sdays AS (SELECT DISTINCT grid_id, CAST(ts AS DATE) AS date FROM dedup),
expected AS (
  SELECT s.grid_id, s.date, CAST(s.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts
  FROM sdays s, range(24) r(h)),
missing AS (
  SELECT e.* FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM dedup d WHERE d.grid_id = e.grid_id AND d.ts = e.ts))"""


def q03() -> str:
    return f"""WITH {missing_cells_cte(8)}
SELECT grid_id, {day_text('date')} AS date, {ts_text('ts')} AS ts FROM missing"""


def q04() -> str:
    return f"""WITH {missing_cells_cte(8)},
marked AS (
  SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY grid_id, date ORDER BY ts) = 3600
                 THEN 0 ELSE 1 END AS brk
  FROM missing),
runs AS (
  SELECT *, sum(brk) OVER (PARTITION BY grid_id, date ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM marked)
SELECT grid_id, {day_text('date')} AS date, CAST(run AS BIGINT) AS run,
       {ts_text('min(ts)')} AS run_start, {ts_text('max(ts)')} AS run_end,
       CAST(count(*) AS BIGINT) AS run_length, count(*) > 1 AS adjacent
FROM runs GROUP BY grid_id, date, run"""


def q05() -> str:
    return f"""WITH {dedup_cte(8)},
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM dedup),
sc AS (SELECT d.date, CAST(d.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts, CAST(g AS BIGINT) AS grid_id
       FROM days d, range(24) r(h), range(8) gg(g)),
gridd AS (
  SELECT grid_id, 113.75::DOUBLE + 0.05::DOUBLE * (grid_id % 4) AS lon_min,
         22.45::DOUBLE + 0.05::DOUBLE * floor(grid_id / 4) AS lat_min
  FROM (SELECT DISTINCT grid_id FROM dedup))
SELECT {ts_text('sc.ts')} AS ts, sc.grid_id AS grid_id, {day_text('sc.date')} AS date,
       round(d.t, 6) AS t, round(d.rh, 6) AS rh, round(d.slp, 6) AS slp, round(d.speed, 6) AS speed,
       round(d.dir, 6) AS dir, round(d.rain, 6) AS rain, d.ts IS NOT NULL AS observed,
       round(g.lon_min, 6) AS lon_min, round(g.lat_min, 6) AS lat_min,
       round(g.lon_min + 0.05::DOUBLE, 6) AS lon_max, round(g.lat_min + 0.05::DOUBLE, 6) AS lat_max,
       round((g.lon_min + g.lon_min + 0.05::DOUBLE) / 2.0, 6) AS lon_center,
       round((g.lat_min + g.lat_min + 0.05::DOUBLE) / 2.0, 6) AS lat_center
FROM sc LEFT JOIN dedup d ON d.ts = sc.ts AND d.grid_id = sc.grid_id
LEFT JOIN gridd g ON g.grid_id = sc.grid_id"""


def q06() -> str:
    return f"""WITH {dedup_cte(4)},
ratio AS (
  SELECT CAST(ts AS DATE) AS date, count(*) / 96.0 AS r FROM dedup GROUP BY 1)
SELECT {obs_select('d')} FROM dedup d JOIN ratio r ON CAST(d.ts AS DATE) = r.date WHERE r.r >= 0.95"""


def q07() -> str:
    return """WITH have AS (SELECT DISTINCT l_orderkey AS page FROM lineitem),
mx AS (SELECT max(page) AS m FROM have)
SELECT CAST(r AS BIGINT) AS page FROM mx, range(1, mx.m + 1) t(r)
WHERE r NOT IN (SELECT page FROM have)"""


MISSING_ORDER_DATES = """o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
b AS (SELECT min(date) AS s, max(date) AS e FROM o),
missing AS (
  SELECT CAST(g.d AS DATE) AS date FROM b, generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY) g(d)
  WHERE CAST(g.d AS DATE) NOT IN (SELECT date FROM o))"""


def q08() -> str:
    return f"WITH {MISSING_ORDER_DATES} SELECT {day_text('date')} AS date FROM missing"


def q09() -> str:
    return f"""WITH {MISSING_ORDER_DATES},
c AS (SELECT m.date, CAST(floor((m.date - b.s) / 15) AS BIGINT) AS chunk, b.s, b.e FROM missing m, b)
SELECT chunk, {day_text('s + CAST(chunk * 15 AS INTEGER)')} AS chunk_start,
       {day_text('least(s + CAST(chunk * 15 + 14 AS INTEGER), e, current_date)')} AS chunk_end,
       CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
       string_agg(strftime(date, '%d'), ',' ORDER BY date) AS days, CAST(count(*) AS BIGINT) AS n_days
FROM c GROUP BY chunk, s, e, year(date), month(date)"""


def q10() -> str:
    return f"""WITH spans AS (
  SELECT l_orderkey AS page, min(l_shipdate) AS span_start, max(l_shipdate) AS span_end FROM lineitem GROUP BY 1),
named AS (
  SELECT *, 'page' || CAST(page AS VARCHAR) || '_rows10000_' || strftime(span_start, '%Y%m%d_%H%M%S') || 'to'
            || strftime(span_end, '%Y%m%d_%H%M%S') || '.csv' AS file_name FROM spans),
per_day AS (
  SELECT n.*, CAST(g.d AS DATE) AS date FROM named n,
  generate_series(CAST(CAST(n.span_start AS DATE) AS TIMESTAMP), CAST(CAST(n.span_end AS DATE) AS TIMESTAMP), INTERVAL 1 DAY) g(d))
SELECT {day_text('date')} AS date, CAST(count(*) AS BIGINT) AS n_files,
       first(file_name ORDER BY span_start, page) AS first_file
FROM per_day GROUP BY date"""


def q11() -> str:
    return f"""WITH {dedup_cte(4)}
SELECT {day_text('CAST(ts AS DATE)')} AS date,
       CAST(count(*) FILTER (WHERE slp = 0) AS BIGINT) AS slp_abnormal,
       CAST(count(*) FILTER (WHERE rh = 0) AS BIGINT) AS rh_abnormal,
       CAST(count(nullif(slp, 0)) AS BIGINT) AS slp_valid, CAST(count(nullif(rh, 0)) AS BIGINT) AS rh_valid,
       round(sum(nullif(slp, 0)), 6) AS slp_sum, round(sum(nullif(rh, 0)), 6) AS rh_sum
FROM dedup GROUP BY CAST(ts AS DATE)"""


FILL = ["t", "rh", "slp", "speed", "dir", "rain"]


def scaffold_filled_cte(n: int) -> str:
    return f"""{dedup_cte(n)},
nulled AS (SELECT ts, grid_id, t, nullif(rh, 0) AS rh, nullif(slp, 0) AS slp, speed, dir, rain FROM dedup),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM nulled),
sc AS (SELECT d.date, CAST(d.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts, CAST(g AS BIGINT) AS grid_id
       FROM days d, range(24) r(h), range({n}) gg(g)),
a AS (
  SELECT sc.date, sc.ts, sc.grid_id, n.t, n.rh, n.slp, n.speed, n.dir, n.rain, n.ts IS NOT NULL AS observed,
         CAST(row_number() OVER (PARTITION BY sc.date, sc.grid_id ORDER BY sc.ts) AS DOUBLE) AS pos
  FROM sc LEFT JOIN nulled n ON n.ts = sc.ts AND n.grid_id = sc.grid_id)"""


def fill_expr(c: str, threshold: float = 0.2, clip0: bool = False, rounded: bool = True) -> str:
    w = "PARTITION BY date, grid_id ORDER BY ts"
    up = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    on = f"OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    kp = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    pv, pp = f"last_value({c} IGNORE NULLS) {up}", f"last_value({kp} IGNORE NULLS) {up}"
    nv, np_ = f"first_value({c} IGNORE NULLS) {on}", f"first_value({kp} IGNORE NULLS) {on}"
    filled = (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN ({pv}) IS NOT NULL AND ({nv}) IS NOT NULL "
              f"THEN ({pv}) + (({nv}) - ({pv})) * ((pos - ({pp})) / (({np_}) - ({pp}))) ELSE coalesce({pv}, {nv}) END")
    if clip0:
        filled = f"CASE WHEN ({filled}) < 0 THEN 0.0::DOUBLE ELSE ({filled}) END"
    share = f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY date, grid_id)"
    body = f"CASE WHEN ({share}) > 0 AND ({share}) <= {threshold} THEN {filled} ELSE {c} END"
    return f"round({body}, 6) AS {c}" if rounded else f"{body} AS {c}"


def fill_query(n: int) -> str:
    cols = ",\n       ".join(fill_expr(c, 0.2, c == "rain") for c in FILL)
    return f"""WITH {scaffold_filled_cte(n)}
SELECT {ts_text('ts')} AS ts, grid_id, {day_text('date')} AS date, observed,
       {cols}
FROM a"""


def density_expr(t: str = "t", slp: str = "slp", rh: str = "rh") -> str:
    return (f"(({slp} * 100.0) / (287.05 * ({t} + 273.15))) * (1.0 - ((({rh} / 100.0) * "
            f"(6.112 * exp((17.62 * {t}) / ({t} + 243.12))) * 100.0) / ({slp} * 100.0)) * (1.0 - 287.05 / 461.495))")


def q13() -> str:
    cols = ", ".join(f"round(avg({c}), 6) AS {c}" for c in FILL + ["air_density"])
    cols2 = ", ".join(f"round({c}, 6) AS {c}" for c in FILL + ["air_density"])
    return f"""WITH {dedup_cte(4)},
d AS (SELECT ts, grid_id, t, nullif(rh, 0) AS rh, nullif(slp, 0) AS slp, speed, dir, rain FROM dedup),
d2 AS (SELECT *, {density_expr()} AS air_density FROM d)
SELECT {ts_text('ts')} AS ts, CAST(NULL AS BIGINT) AS grid_id, {cols}, true AS is_mean_field FROM d2 GROUP BY ts
UNION ALL
SELECT {ts_text('ts')} AS ts, grid_id, {cols2}, false AS is_mean_field FROM d2"""


def q14() -> str:
    sx, sy = "sin(radians(dir)) * speed", "cos(radians(dir)) * speed"
    return f"""WITH {dedup_cte(4)}
SELECT {ts_text('ts')} AS ts, grid_id, round({sx}, 6) AS speed_x, round({sy}, 6) AS speed_y,
       round(sqrt(({sx}) * ({sx}) + ({sy}) * ({sy})), 6) AS ws FROM dedup"""


def q15() -> str:
    return f"""WITH {dedup_cte(4)},
d AS (SELECT ts, grid_id, t, nullif(rh, 0) AS rh, nullif(slp, 0) AS slp FROM dedup)
SELECT {ts_text('ts')} AS ts, grid_id, round({density_expr()}, 6) AS air_density FROM d"""


LI_ORDER = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")

REAN = f"""rean AS (
  SELECT l_shipdate AS ts, CAST((l_suppkey % 8) * 5 AS DOUBLE) AS lon, CAST(l_linenumber * 5 AS DOUBLE) AS lat,
         CASE WHEN l_linestatus <> 'F' THEN 273.15::DOUBLE + l_quantity END AS t2m,
         (273.15::DOUBLE + l_quantity) - l_discount * 200.0::DOUBLE AS d2m,
         CAST((l_partkey % 21) - 10 AS DOUBLE) AS u10,
         CAST((l_orderkey % 17) - 8 AS DOUBLE) AS v10,
         CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS sp,
         l_tax / 100.0::DOUBLE AS tp,
         {LI_ORDER}
  FROM lineitem)"""


def clip_sql(x: str, lo: str | None, hi: str | None) -> str:
    out = x
    if lo is not None:
        out = f"CASE WHEN ({x}) < {lo} THEN {lo} ELSE {out} END"
    if hi is not None:
        out = f"CASE WHEN ({x}) > {hi} THEN {hi} ELSE {out} END"
    return out


def rh_sql(t: str = "t2m", d: str = "d2m") -> str:
    es = f"(6.112 * exp((17.67 * ({t} - 273.15)) / (({t} - 273.15) + 243.5)))"
    e = f"(6.112 * exp((17.67 * ({d} - 273.15)) / (({d} - 273.15) + 243.5)))"
    return f"({clip_sql(f'{e} / {es}', '0.0', '1.0')}) * 100.0"


def q16() -> str:
    return f"""WITH {REAN}
SELECT {ts_text('ts')} AS ts, round(lon, 6) AS lon, round(lat, 6) AS lat, round({rh_sql()}, 6) AS rh FROM rean"""


def q17() -> str:
    tp = clip_sql("tp * 1000.0", "0.0", None)
    return f"""WITH {REAN}
SELECT {ts_text('ts')} AS ts, round(lon, 6) AS lon, round(lat, 6) AS lat,
       round(t2m - 273.15, 6) AS t2m, round(d2m - 273.15, 6) AS d2m, round(u10, 6) AS u10, round(v10, 6) AS v10,
       round(sp / 1000.0, 6) AS sp, round(ln(1 + ({tp})), 6) AS tp,
       round({rh_sql()}, 6) AS rh, round(sqrt(u10 * u10 + v10 * v10), 6) AS ws
FROM rean"""


def merged_cte() -> str:
    cols = ",\n         ".join(
        f"first({c} ORDER BY {LI_ORDER}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ["t2m", "d2m", "u10", "v10", "sp", "tp"])
    return f"""{REAN},
merged AS (
  SELECT ts, lon, lat,
         {cols}
  FROM rean GROUP BY ts, lon, lat)"""


def q18() -> str:
    cols = ", ".join(f"round({c}, 6) AS {c}" for c in ["lon", "lat", "t2m", "d2m", "u10", "v10", "sp", "tp"])
    return f"WITH {merged_cte()} SELECT {ts_text('ts')} AS ts, {cols} FROM merged"


def coords_cte(table: str = "customer", name: str = "c") -> str:
    k = {"customer": "c_custkey", "supplier": "s_suppkey"}[table]
    return (f"{name} AS (SELECT CAST({k} AS BIGINT) AS id, CAST(({k} * 7) % 360 AS DOUBLE) AS lon, "
            f"CAST(({k} * 11) % 181 - 90 AS DOUBLE) AS lat FROM {table})")


def q19() -> str:
    return f"""WITH {coords_cte()},
g AS (SELECT lon, lat, row_number() OVER (ORDER BY lat, lon) - 1 AS grid_id FROM (SELECT DISTINCT lon, lat FROM c))
SELECT c.id, round(c.lon, 6) AS lon, round(c.lat, 6) AS lat, CAST(g.grid_id AS BIGINT) AS grid_id
FROM c LEFT JOIN g ON c.lon = g.lon AND c.lat = g.lat"""


def q20() -> str:
    return f"""WITH {merged_cte()},
r AS (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, lon DESC, lat DESC) AS rn FROM merged)
SELECT {ts_text('ts')} AS ts, round(lon, 6) AS lon, round(lat, 6) AS lat, round(t2m, 6) AS t2m FROM r WHERE rn <= 16"""


def wrapped_cte() -> str:
    lon = clip_sql("CASE WHEN lon > 180.0 THEN lon - 360.0 ELSE lon END", "-180.0", "180.0")
    lat = clip_sql("lat", "-89.9999", "89.9999")
    return f"""{coords_cte()},
cw AS (SELECT id, {lon} AS lon, {lat} AS lat FROM c)"""


def q21() -> str:
    return f"WITH {wrapped_cte()} SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM cw"


def q22() -> str:
    return f"""WITH {coords_cte()},
ab AS (SELECT id, lat AS a, lon AS b FROM c),
s AS (SELECT max(abs(a)) AS ma, max(abs(b)) AS mb FROM ab)
SELECT id, round(CASE WHEN s.ma <= 90 AND s.mb > 90 THEN b ELSE a END, 6) AS lon,
           round(CASE WHEN s.ma <= 90 AND s.mb > 90 THEN a ELSE b END, 6) AS lat
FROM ab, s"""


def q23() -> str:
    return f"""WITH {wrapped_cte()},
p AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM cw)
SELECT CAST(pos // 80 AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n_points,
       string_agg(printf('%.4f,%.4f', lat, lon), '|' ORDER BY pos) AS locations
FROM p GROUP BY 1"""


def q24() -> str:
    return f"""WITH {coords_cte('supplier')},
s AS (SELECT min(lon) AS a, max(lon) AS b, min(lat) AS c2, max(lat) AS d FROM c)
SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat,
       round(CASE WHEN b - a = 0 THEN 0.0 ELSE (lon - a) / (b - a) END, 6) AS lon_norm,
       round(CASE WHEN d - c2 = 0 THEN 0.0 ELSE (lat - c2) / (d - c2) END, 6) AS lat_norm
FROM c, s"""


def q25() -> str:
    return f"""WITH {coords_cte('supplier')}
SELECT id, round(cos(radians(lat)) * cos(radians(lon)), 6) AS sx, round(cos(radians(lat)) * sin(radians(lon)), 6) AS sy,
       round(sin(radians(lat)), 6) AS sz FROM c"""


def q26() -> str:
    return f"""WITH {coords_cte('supplier')},
j AS (SELECT c.*, e.s_acctbal AS elevation FROM c LEFT JOIN supplier e ON CAST(e.s_suppkey AS BIGINT) = c.id),
s AS (SELECT min(elevation) AS a, max(elevation) AS b FROM j)
SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(elevation, 6) AS elevation,
       round(CASE WHEN b - a = 0 THEN 0.0 ELSE (elevation - a) / (b - a) END, 6) AS elevation_norm
FROM j, s"""


def q27() -> str:
    wrap = clip_sql("CASE WHEN x > 180.0 THEN x - 360.0 ELSE x END", "-180.0", "180.0")
    return f"""WITH {wrapped_cte()},
area AS (SELECT max(lat) AS north, min(lon) AS west, min(lat) AS south, max(lon) AS east FROM cw),
sh AS (SELECT *, CAST(round_even((north - south) / 5.0, 0) + 1 AS INTEGER) AS n_lat,
              CASE WHEN east < west THEN east + 360.0 - west ELSE east - west END AS span FROM area),
sh2 AS (SELECT *, CAST(CASE WHEN abs(span - 360.0) < 1e-6 THEN round_even(span / 5.0, 0)
                            ELSE round_even(span / 5.0, 0) + 1 END AS INTEGER) AS n_lon FROM sh),
cells AS (SELECT sh2.*, i, j, west + j * 5.0 AS x FROM sh2, range(n_lat) a(i), range(n_lon) b(j))
SELECT CAST(i * n_lon + j AS BIGINT) AS grid_id, round(south + i * 5.0, 6) AS lat, round({wrap}, 6) AS lon,
       CAST(n_lat AS BIGINT) AS n_lat, CAST(n_lon AS BIGINT) AS n_lon
FROM cells"""


def q28() -> str:
    return """WITH ex AS (
  SELECT vec_id, label, CAST(i AS BIGINT) AS pos, embedding[i + 1] AS x
  FROM embeddings, range(len(embedding)) r(i)),
st AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s FROM ex GROUP BY pos),
gs AS (SELECT label, pos, avg(x) AS gm, stddev_pop(x) AS gsd FROM ex GROUP BY label, pos)
SELECT ex.vec_id, ex.pos, round((ex.x - st.m) / CASE WHEN st.s = 0 THEN 1.0 ELSE st.s END, 6) AS z,
       round((ex.x - gs.gm) / CASE WHEN gs.gsd = 0 THEN 1.0 ELSE gs.gsd END, 6) AS x_z
FROM ex JOIN st ON ex.pos = st.pos LEFT JOIN gs ON ex.label = gs.label AND ex.pos = gs.pos"""


def filled_cte(n: int = 4) -> str:
    cols = ",\n         ".join(fill_expr(c, 0.2, c == "rain", rounded=False) for c in FILL)
    return f"""{scaffold_filled_cte(n)},
f AS (
  SELECT date, ts, grid_id, CAST(hour(ts) AS BIGINT) AS step,
         {cols}
  FROM a)"""


SAMPLE_F = ["t", "rh", "speed"]


def q35() -> str:
    parts = ", ".join(f"CAST({fn}(ts) AS BIGINT) AS {n}" for fn, n in
                      [("year", "year"), ("month", "month"), ("day", "day"), ("hour", "hour"), ("minute", "minute")])
    sel = "\nUNION ALL\n".join(
        f"SELECT {day_text('date')} AS date, step, grid_id AS node_pos, CAST({i} AS BIGINT) AS feature, "
        f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS value, {parts} FROM f"
        for i, c in enumerate(SAMPLE_F))
    return f"WITH {filled_cte(4)}\n{sel}"


def q29() -> str:
    sid = "(CAST(date - (SELECT min(date) FROM f) AS BIGINT) * 24 + step)"
    mask = f"CAST('0x' || substr(md5('7|' || {sid} || '|' || grid_id), 1, 8) AS BIGINT) < 1073741824"
    sel = "\nUNION ALL\n".join(
        f"SELECT {sid} AS sample_id, grid_id, {mask} AS masked, CAST({i} AS BIGINT) AS feature, "
        f"round(CAST(CASE WHEN {mask} THEN CAST(0.0 AS FLOAT) ELSE CAST({c} AS FLOAT) END AS DOUBLE), 6) AS data, "
        f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS target FROM f"
        for i, c in enumerate(SAMPLE_F))
    return f"WITH {filled_cte(4)}\n{sel}"


def q30() -> str:
    return f"""WITH {filled_cte(4)}
SELECT {day_text('date')} AS date, CAST(w.s AS BIGINT) AS window_start, CAST(f.step - w.s AS BIGINT) AS k,
       CASE WHEN f.step - w.s < 4 THEN 'input' ELSE 'target' END AS part, f.grid_id, round(f.t, 6) AS t
FROM f JOIN range(0, 19, 2) w(s) ON f.step BETWEEN w.s AND w.s + 5"""


def q31() -> str:
    return f"""WITH {filled_cte(4)}
SELECT {day_text('date')} AS date, CAST(step // 6 AS BIGINT) AS window_id, CAST(step % 6 AS BIGINT) AS k,
       CASE WHEN step % 6 < 4 THEN 'input' ELSE 'target' END AS part, grid_id, round(t, 6) AS t
FROM f"""


SERIES = """agg AS (
  SELECT CAST(l_shipdate AS DATE) AS day, CAST(l_suppkey % 8 AS BIGINT) AS node,
         sum(l_quantity) AS qty, sum(l_extendedprice) AS price
  FROM lineitem GROUP BY 1, 2),
series AS (
  SELECT CAST(day - (SELECT min(day) FROM agg) AS BIGINT) AS step, day, node, CAST(0 AS BIGINT) AS channel, qty AS value FROM agg
  UNION ALL
  SELECT CAST(day - (SELECT min(day) FROM agg) AS BIGINT) AS step, day, node, CAST(1 AS BIGINT) AS channel, price AS value FROM agg),
m AS (SELECT max(step) + 1 AS n FROM series)"""


def q32() -> str:
    return f"""WITH {SERIES}
SELECT CAST(w.ws AS BIGINT) AS window_start, CAST(s.step - w.ws AS BIGINT) AS k,
       CASE WHEN s.step - w.ws < 3 THEN 'input' ELSE 'target' END AS part, s.node, s.channel, round(s.value, 6) AS value
FROM series s, m, range(greatest(0, s.step - 3), least(s.step, m.n - 4) + 1) w(ws)"""


def q33() -> str:
    return f"""WITH {SERIES}
SELECT CAST(s.step // 7 AS BIGINT) AS window_id, CAST(s.step % 7 AS BIGINT) AS k,
       CASE WHEN s.step % 7 < 5 THEN 'input' ELSE 'target' END AS part,
       s.node, s.channel, round(s.value, 6) AS value
FROM series s, m WHERE s.step // 7 < m.n // 7"""


def q34() -> str:
    sel = "\nUNION ALL\n".join(
        f"SELECT {day_text('date')} AS date, CAST({i} AS BIGINT) AS channel, round({c}, 6) AS value FROM w"
        for i, c in enumerate(["qty", "price", "discount", "tax"]))
    return f"""WITH w AS (
  SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS qty, sum(l_extendedprice) AS price,
         sum(l_discount) AS discount, sum(l_tax) AS tax
  FROM lineitem GROUP BY 1)
{sel}"""


def q36() -> str:
    return f"""WITH s AS (SELECT min(date_trunc('minute', ts)) AS st FROM events)
SELECT event_id, {ts_text('st + to_minutes(CAST(event_id * 5 AS BIGINT))')} AS regular_ts FROM events, s"""


def q37() -> str:
    return f"""SELECT o_orderkey,
       strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 48 + 1 AS VARCHAR), 2, '0') AS slot_code,
       {ts_text("make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), CAST((o_orderkey % 48) // 2 AS BIGINT), CAST(((o_orderkey % 48) % 2) * 30 AS BIGINT), 0.0)")} AS ts
FROM orders"""


MIXED_STRPTIME = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M:%S",
                  "%Y/%m/%d %H:%M", "%Y-%m-%d", "%Y/%m/%d", "%Y%m%d"]


def q38() -> str:
    parsed = "coalesce(" + ", ".join(f"try_strptime(trim(text), '{f}')" for f in MIXED_STRPTIME) + ")"
    return f"""WITH t AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                               + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS t FROM orders),
x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
                                           WHEN 1 THEN strftime(t, '%Y/%m/%d %H:%M')
                                           WHEN 2 THEN strftime(t, '%Y-%m-%d')
                                           WHEN 3 THEN strftime(t, '%Y%m%d') ELSE 'n/a' END AS text FROM t)
SELECT o_orderkey, text, {ts_text(parsed)} AS parsed FROM x"""


def q39() -> str:
    return f"""WITH {SERIES},
cat(name, reader, step_minutes, nodes, channels, length, present) AS (VALUES
  ('lineitem_daily', 'node_frame', 1440, 8, 2, NULL, true), ('lineitem_half_daily', 'node_frame', 720, 8, 2, NULL, true),
  ('lineitem_short', 'node_frame', 1440, 8, 2, 5, true), ('lineitem_off_slot', 'node_frame', 1440, 8, 2, NULL, true),
  ('lineitem_absent', 'wide_channels', 60, 3, 1, 24, false)),
rows AS (
  SELECT cat.name, step_minutes, node, channel,
         CAST(day AS TIMESTAMP) + CASE WHEN name = 'lineitem_off_slot' AND step % 5 = 1 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS ts
  FROM cat JOIN series ON cat.present),
f AS (SELECT name, min(ts) AS first FROM rows GROUP BY name),
act AS (
  SELECT rows.name, count(DISTINCT ts) AS n, count(DISTINCT node) AS nn, count(DISTINCT channel) AS nc, count(*) AS cells,
         count(DISTINCT ts) FILTER (WHERE date_diff('minute', first, ts) % step_minutes <> 0) AS off_slot,
         max(date_diff('minute', first, ts)) // any_value(step_minutes) + 1 AS span
  FROM rows JOIN f ON f.name = rows.name GROUP BY rows.name)
SELECT cat.name, reader, CAST(step_minutes AS BIGINT) AS step_minutes, CAST(nodes AS BIGINT) AS nodes,
       CAST(channels AS BIGINT) AS channels, CAST(length AS BIGINT) AS length, n AS actual_length, nn AS actual_nodes,
       nc AS actual_channels, cells AS actual_rows, off_slot, CAST(span AS BIGINT) AS span_steps,
       CASE WHEN n IS NULL THEN 'absent'
            WHEN nn <> nodes OR nc <> channels OR cells <> n * nodes * channels OR n <> length THEN 'mismatch'
            WHEN n <> span OR off_slot > 0 THEN 'irregular' ELSE 'ok' END AS status
FROM cat LEFT JOIN act ON cat.name = act.name"""


def grid_centers(src: str = "dedup") -> str:
    lon_min = "(113.75::DOUBLE + 0.05::DOUBLE * (grid_id % 4))"
    lat_min = "(22.45::DOUBLE + 0.05::DOUBLE * floor(grid_id / 4))"
    return (f"SELECT grid_id, ({lon_min} + ({lon_min} + 0.05::DOUBLE)) / 2.0 AS lon_center, "
            f"({lat_min} + ({lat_min} + 0.05::DOUBLE)) / 2.0 AS lat_center FROM (SELECT DISTINCT grid_id FROM {src})")


def q40() -> str:
    w = "1.0 / pow(greatest(p.dist, 1e-12), 2.0)"
    return f"""WITH {dedup_cte(8)},
d AS (SELECT ts, grid_id, t, speed FROM dedup),
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM d),
sc AS (SELECT CAST(dd.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts, CAST(g AS BIGINT) AS grid_id
       FROM days dd, range(24) r(h), range(8) gg(g)),
a AS (SELECT sc.ts, sc.grid_id, d.t, d.speed FROM sc LEFT JOIN d ON d.ts = sc.ts AND d.grid_id = sc.grid_id),
gc AS ({grid_centers('d')}),
pairs AS (
  SELECT x.grid_id, y.grid_id AS nb,
         sqrt(pow(x.lon_center - y.lon_center, 2) + pow(x.lat_center - y.lat_center, 2)) AS dist
  FROM gc x, gc y WHERE x.grid_id <> y.grid_id
    AND sqrt(pow(x.lon_center - y.lon_center, 2) + pow(x.lat_center - y.lat_center, 2)) <= 0.08),
share AS (SELECT ts, avg(CASE WHEN t IS NULL THEN 1.0 ELSE 0.0 END) AS sh_t,
                 avg(CASE WHEN speed IS NULL THEN 1.0 ELSE 0.0 END) AS sh_s FROM a GROUP BY ts),
est AS (
  SELECT h.ts, h.grid_id,
         sum(CASE WHEN k.t IS NOT NULL THEN {w} * k.t END) / sum(CASE WHEN k.t IS NOT NULL THEN {w} END) AS e_t,
         sum(CASE WHEN k.speed IS NOT NULL THEN {w} * k.speed END)
           / sum(CASE WHEN k.speed IS NOT NULL THEN {w} END) AS e_s
  FROM (SELECT ts, grid_id FROM a WHERE t IS NULL OR speed IS NULL) h
  JOIN pairs p ON p.grid_id = h.grid_id JOIN a k ON k.ts = h.ts AND k.grid_id = p.nb
  GROUP BY h.ts, h.grid_id)
SELECT {ts_text('a.ts')} AS ts, a.grid_id,
       round(CASE WHEN a.t IS NULL AND s.sh_t <= 0.2 THEN e.e_t ELSE a.t END, 6) AS t,
       round(CASE WHEN a.speed IS NULL AND s.sh_s <= 0.2 THEN e.e_s ELSE a.speed END, 6) AS speed
FROM a LEFT JOIN est e ON e.ts = a.ts AND e.grid_id = a.grid_id LEFT JOIN share s ON s.ts = a.ts"""


def q49() -> str:
    numeric = [c for c in FLOW_CELLS.columns if c not in ("cell_id", "cell_type", "cell_type_name", "nverts")]
    pos = {c: i for i, c in enumerate(numeric)}
    cols = ", ".join(f"round(CAST(embedding[{pos[c] + 1}] AS DOUBLE), 6) AS {c}" for c in FLOW_CELLS.features)
    return f"SELECT CAST(vec_id AS BIGINT) AS cell_id, {cols} FROM embeddings"


def q50() -> str:
    return f"""WITH {obs_cte(4)},
spans AS (SELECT page, min(ts) AS s, max(ts) AS e FROM obs GROUP BY page),
r AS (SELECT min(s) AS mn, max(e) AS mx FROM spans)
SELECT {ts_text('ts')} AS ts, grid_id, row_ord, {ts_text('mn')} AS min_time, {ts_text('mx')} AS max_time
FROM obs, r
WHERE ts >= CAST(CAST(mn AS DATE) + 1 AS TIMESTAMP) AND ts < CAST(CAST(mn AS DATE) + 2 AS TIMESTAMP)"""


def q51() -> str:
    cols2 = ", ".join(f"round({c}, 6) AS {c}" for c in FILL + ["air_density"])
    return f"""WITH {dedup_cte(4)},
d AS (SELECT ts, grid_id, t, nullif(rh, 0) AS rh, nullif(slp, 0) AS slp, speed, dir, rain FROM dedup),
d2 AS (SELECT *, {density_expr()} AS air_density FROM d)
SELECT {ts_text('ts')} AS ts, grid_id, {cols2} FROM d2"""


def q52() -> str:
    anyn = " OR ".join(f"{c} IS NULL" for c in FILL)
    shares = ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {c}_null_share" for c in FILL)
    return f"""WITH {scaffold_filled_cte(8)}
SELECT {day_text('date')} AS date, bool_or({anyn}) AS any_null, {shares} FROM a GROUP BY date"""


def q53() -> str:
    return f"""WITH {dedup_cte(8)},
pd AS (SELECT CAST(ts AS DATE) AS date, count(*) AS rows, count(DISTINCT ts) AS steps FROM dedup GROUP BY 1)
SELECT {day_text('date')} AS date, CAST(rows AS BIGINT) AS rows, CAST(steps AS BIGINT) AS steps,
       CASE WHEN rows <> 192 OR steps <> 24 THEN 'error' ELSE 'success' END AS status,
       CASE WHEN rows <> 192 THEN 'expected 192 rows, got ' || CAST(rows AS VARCHAR)
            WHEN steps <> 24 THEN 'expected 24 time steps, got ' || CAST(steps AS VARCHAR) END AS reason
FROM pd"""


def q54() -> str:
    return f"""WITH {dedup_cte(4)},
times AS (SELECT DISTINCT ts FROM dedup),
st AS (SELECT ts, dense_rank() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts) - 1 AS step,
              count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS n_times FROM times)
SELECT {ts_text('d.ts')} AS ts, d.grid_id, CAST(st.step AS BIGINT) AS step, CAST(st.n_times AS BIGINT) AS n_times
FROM dedup d JOIN st ON d.ts = st.ts"""


def q55() -> str:
    return f"""WITH {REAN}
SELECT {ts_text('ts')} AS ts, round(lon, 6) AS lon, round(lat, 6) AS lat, round(t2m, 6) AS t2m, round(d2m, 6) AS d2m,
       round(u10, 6) AS u10, round(v10, 6) AS v10, round(sp, 6) AS sp, 0.0::DOUBLE AS msl, round(tp, 6) AS tp
FROM rean"""


def q56() -> str:
    return f"""WITH {filled_cte(4)},
f0 AS (SELECT min(date) AS d0 FROM f),
gc AS ({grid_centers('dedup')})
SELECT CAST((f.date - f0.d0) * 24 + f.step AS BIGINT) AS sample_id, f.step, {ts_text('f.ts')} AS ts, f.grid_id,
       round(gc.lon_center, 6) AS lon_center, round(gc.lat_center, 6) AS lat_center
FROM f, f0, gc WHERE gc.grid_id = f.grid_id"""


def q57() -> str:
    return f"""WITH {dedup_cte(4)},
rep AS (SELECT CAST(ts AS DATE) AS date, count(*) / 96.0 AS ratio FROM dedup WHERE grid_id BETWEEN 0 AND 3 GROUP BY 1),
b AS (SELECT min(date) AS s, max(date) + 1 AS e FROM rep)
SELECT {day_text('CAST(g.d AS DATE)')} AS date, round(rep.ratio, 6) AS completeness_ratio
FROM b, generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY) g(d)
LEFT JOIN rep ON rep.date = CAST(g.d AS DATE)"""


def q58() -> str:
    return f"""WITH {dedup_cte(8)},
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM dedup),
sc AS (SELECT CAST(d.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts, CAST(g AS BIGINT) AS grid_id
       FROM days d, range(24) r(h), range(8) gg(g)),
gc AS ({grid_centers('dedup')}),
fs AS (SELECT sc.grid_id, gc.lon_center, gc.lat_center FROM sc LEFT JOIN gc ON gc.grid_id = sc.grid_id
       WHERE hour(sc.ts) = 0)
SELECT grid_id, round(min(lon_center), 6) AS lon, round(min(lat_center), 6) AS lat,
       CAST(count(DISTINCT (lon_center, lat_center)) AS BIGINT) AS n_variants, CAST(count(*) AS BIGINT) AS n_days
FROM fs GROUP BY grid_id"""


def q60() -> str:
    return f"""WITH {dedup_cte(8)},
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM dedup),
sc AS (SELECT CAST(d.date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts, CAST(g AS BIGINT) AS grid_id
       FROM days d, range(24) r(h), range(8) gg(g))
SELECT {ts_text('ts')} AS ts, grid_id FROM (SELECT ts, grid_id FROM sc EXCEPT ALL SELECT ts, grid_id FROM dedup)"""


def q64() -> str:
    return f"""WITH {obs_cte(4)},
days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM obs),
t AS (SELECT date, CAST(date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS ts FROM days, range(24) r(h))
SELECT {day_text('date')} AS date, {ts_text('ts')} AS ts, strftime(ts, '%H:%M') AS label,
       strftime(ts, '%Y%m%d_%H%M%S') AS compact FROM t"""


def q47() -> str:
    return f"""WITH {obs_cte(4)}
SELECT {day_text('ts')} AS date, strftime(ts, '%H:%M') AS time_point, count(*) AS arrived, count(DISTINCT grid_id) AS cells
FROM obs GROUP BY 1, 2"""


def q67() -> str:
    return f"""WITH {obs_cte(4)}, m AS (SELECT (epoch(min(ts)) + epoch(max(ts))) / 2 AS middle FROM obs)
SELECT {day_text('ts')} AS date, grid_id, count(*) AS late_rows FROM obs, m WHERE epoch(ts) < middle GROUP BY 1, 2"""


def q48() -> str:
    sel = "\nUNION ALL\n".join(
        f"SELECT {day_text('date')} AS date, step, f.grid_id AS node_pos, CAST({i} AS BIGINT) AS feature, "
        f"'{c}' AS feature_name, round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS value, {ts_text('ts')} AS ts, "
        f"round(CAST(CAST(gc.lon_center AS FLOAT) AS DOUBLE), 6) AS lon, "
        f"round(CAST(CAST(gc.lat_center AS FLOAT) AS DOUBLE), 6) AS lat FROM f JOIN gc ON gc.grid_id = f.grid_id"
        for i, c in enumerate(SAMPLE_F))
    return f"WITH {filled_cte(4)},\ngc AS ({grid_centers('dedup')})\n{sel}"


def node_cte() -> str:
    """Nodes of the 4-grid view in tensor order with coordinates and elevation."""
    return f"""gc AS ({grid_centers('dedup')}),
nd AS (
  SELECT gc.grid_id AS node, round(CAST(CAST(lon_center AS FLOAT) AS DOUBLE), 6) AS lon,
         round(CAST(CAST(lat_center AS FLOAT) AS DOUBLE), 6) AS lat, round(CAST(CAST(s_acctbal AS FLOAT) AS DOUBLE), 6) AS elevation
  FROM gc LEFT JOIN supplier ON s_suppkey = gc.grid_id + 1)"""


def q68() -> str:
    sel = "\nUNION ALL\n".join(
        f"SELECT (SELECT count(DISTINCT d.date) FROM f d WHERE d.date < f.date) * 10 + w.s // 2 AS sample_id, {day_text('date')} AS date, "
        f"w.s AS start, step - w.s AS k, CASE WHEN step - w.s < 4 THEN 'input' ELSE 'target' END AS part, {ts_text('ts')} AS ts, "
        f"nd.node, CAST({i} AS BIGINT) AS feature, round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS value, lon, lat, elevation "
        f"FROM f JOIN nd ON nd.node = f.grid_id JOIN range(0, 19, 2) w(s) ON step BETWEEN w.s AND w.s + 5"
        for i, c in enumerate(SAMPLE_F))
    return f"WITH {filled_cte(4)},\n{node_cte()}\n{sel}"


def q69() -> str:
    sid = "(SELECT count(DISTINCT d.date) FROM f d WHERE d.date < f.date) * 24 + step"
    mask = f"CAST('0x' || substr(md5('7|' || ({sid}) || '|' || node), 1, 8) AS BIGINT) < 1073741824"
    sel = "\nUNION ALL\n".join(
        f"SELECT {sid} AS sample_id, {day_text('date')} AS date, step, {ts_text('ts')} AS ts, node, {mask} AS masked, "
        f"CAST({i} AS BIGINT) AS feature, round(CAST(CASE WHEN {mask} THEN 0.0::FLOAT ELSE CAST({c} AS FLOAT) END AS DOUBLE), 6) AS data, "
        f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS target, lon, lat, elevation FROM f JOIN nd ON nd.node = f.grid_id"
        for i, c in enumerate(SAMPLE_F))
    return f"WITH {filled_cte(4)},\n{node_cte()}\n{sel}"


def q70() -> str:
    sel = "\nUNION ALL\n".join(
        f"SELECT date, step, grid_id AS node_pos, CAST({i} AS BIGINT) AS feature, CAST(CAST({c} AS FLOAT) AS DOUBLE) AS x FROM f"
        for i, c in enumerate(SAMPLE_F))
    return f"""WITH {filled_cte(4)},
v AS ({sel}),
b AS (SELECT min(CAST(ts AS DATE)) + CAST(floor((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) + 1) * 0.7) AS INTEGER) AS day FROM events),
st AS (SELECT feature, avg(x) AS m, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd FROM v, b WHERE date < b.day GROUP BY 1)
SELECT {day_text('date')} AS date, step, date < b.day AS train, node_pos, v.feature, round((x - m) / sd, 4) AS z, round(x, 4) AS back
FROM v JOIN st ON st.feature = v.feature, b"""


def q72() -> str:
    return f"""WITH {merged_cte()},
b AS (SELECT *, CASE WHEN day(ts) = 7 THEN t2m + 1 ELSE t2m END AS other, lat <= 20 AS first FROM merged)
SELECT {ts_text('ts')} AS ts, lon, lat, round(coalesce(CASE WHEN first THEN t2m END, other), 6) AS t2m, round(d2m, 6) AS d2m,
       round(sp, 6) AS sp, round(tp, 6) AS tp, CASE WHEN first AND other <> t2m THEN 't2m' ELSE '' END AS conflicts
FROM b"""


def q73() -> str:
    return f"""WITH {obs_cte(4)},
p AS (
  SELECT page, CASE WHEN page % 5 = 2 THEN 'no time column' ELSE 'read' END AS status, count(*) AS n,
         count(*) FILTER (WHERE page % 7 = 3 AND row_ord % 10 = 0) AS bad, sum(t) AS t_sum, max(grid_id) AS max_grid
  FROM obs GROUP BY page)
SELECT page, status, CASE WHEN status = 'read' THEN n ELSE 0 END AS rows, CAST(0 AS BIGINT) AS skipped,
       CASE WHEN status = 'read' THEN bad ELSE 0 END AS rows_without_time,
       CASE WHEN status = 'read' THEN round(t_sum, 4) END AS t_sum, CASE WHEN status = 'read' THEN max_grid END AS max_grid FROM p
UNION ALL SELECT NULL, 'not a page', 0, 0, 0, NULL, NULL"""


SPLINE_KEEP = ["ts", "date", "grid_id", "observed"]


def _linear(c: str, clip: bool) -> str:
    return fill_expr(c, 0.2, clip, rounded=False)


def q41() -> str:
    rest = ["rh", "dir", "rain"]
    fill = oracle_fills.temporal("r", "a", {"t": "cubic", "slp": "cubic", "speed": "cubic"}, SPLINE_KEEP + rest, _linear)
    cols = ", ".join(f"round({c}, 4) AS {c}" for c in FILL)
    return f"WITH RECURSIVE {scaffold_filled_cte(8)},\n{fill}\nSELECT {ts_text('ts')} AS ts, grid_id, {day_text('date')} AS date, observed, {cols} FROM r"


def q42() -> str:
    rest = ["slp", "speed", "dir", "rain"]
    fill = oracle_fills.temporal("r", "a", {"rh": "quadratic", "t": "cubic"}, SPLINE_KEEP + rest, _linear)
    cols = ", ".join(f"round({c}, 4) AS {c}" for c in FILL)
    return f"WITH RECURSIVE {scaffold_filled_cte(8)},\n{fill}\nSELECT {ts_text('ts')} AS ts, grid_id, {day_text('date')} AS date, observed, {cols} FROM r"


def located_select(src: str, cols: list[str], digits: int = 4) -> str:
    lon_min, lat_min = "113.75::DOUBLE + 0.05::DOUBLE * (g.grid_id % 4)", "22.45::DOUBLE + 0.05::DOUBLE * floor(g.grid_id / 4)"
    values = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return (f"SELECT {ts_text('g.ts')} AS ts, g.grid_id, {day_text('g.date')} AS date, {values}, round({lon_min}, {digits}) AS lon_min, "
            f"round({lat_min}, {digits}) AS lat_min, round({lon_min} + 0.05, {digits}) AS lon_max, round({lat_min} + 0.05, {digits}) AS lat_max, "
            f"round({lon_min} + 0.025, {digits}) AS lon_center, round({lat_min} + 0.025, {digits}) AS lat_center")


def q43() -> str:
    fill = oracle_fills.spatial("r", "a", ["t", "rh", "slp", "speed"], SPLINE_KEEP + ["dir", "rain"], 8, "gc")
    return (f"WITH RECURSIVE {scaffold_filled_cte(8)},\ngc AS ({grid_centers('dedup')}),\n{fill}\n"
            f"{located_select('r', FILL)}, observed FROM r g")


ST_COLS = {"t": "cubic", "slp": "cubic", "rh": "quadratic", "rain": "linear", "speed_x": "linear", "speed_y": "linear"}


def q44(n: int = 4) -> str:
    """Two rounds of the spatial and the temporal fill, complete days, air density, mean rows."""
    keep = ["ts", "date", "grid_id"]
    rounds, src = [], "w"
    for k in (1, 2):
        rounds.append(oracle_fills.spatial(f"s{k}", src, list(ST_COLS), keep, n, "gc"))
        rounds.append(oracle_fills.temporal(f"t{k}", f"s{k}", ST_COLS, keep, _linear))
        src = f"t{k}"
    gaps = " OR ".join(f"{c} IS NULL" for c in ST_COLS)
    cols = [*ST_COLS, "air_density"]
    nulls = ", ".join(f"NULL AS {c}" for c in ("lon_min", "lat_min", "lon_max", "lat_max", "lon_center", "lat_center"))
    means = ", ".join(f"round(avg({c}), 6) AS {c}" for c in cols)
    return f"""WITH RECURSIVE {scaffold_filled_cte(n)},
gc AS ({grid_centers('dedup')}),
w AS (SELECT ts, date, grid_id, t, slp, rh, rain, sin(radians(dir)) * speed AS speed_x, cos(radians(dir)) * speed AS speed_y FROM a),
{(','+chr(10)).join(rounds)},
ok AS (SELECT date FROM t2 GROUP BY date HAVING NOT bool_or({gaps})),
d AS (SELECT *, {density_expr()} AS air_density FROM t2 WHERE date IN (SELECT date FROM ok))
{located_select('d', cols, 6)}, false AS is_mean_field FROM d g
UNION ALL BY NAME
SELECT {ts_text('ts')} AS ts, NULL AS grid_id, NULL AS date, {nulls}, {means}, true AS is_mean_field FROM d GROUP BY ts"""


def q74() -> str:
    ssrd = clip_sql("(l_quantity * 36000 - 100000) / 3600.0", "0.0", None)
    tp = clip_sql("(l_discount / 100 - 0.0002) * 1000", "0.0", None)
    return f"""SELECT l_orderkey, l_linenumber, round(l_quantity + 250 - 273.15, 6) AS skt, round(l_extendedprice * 2 / 1000, 6) AS sp,
  round(l_extendedprice * 3 / 1000, 6) AS msl, round((l_extendedprice * 10 - 5000) / {GRAVITY_KM}, 6) AS z, round(l_quantity * 40, 6) AS blh,
  round({clip_sql('l_discount * 20 - 0.5', '0.0', '1.0')}, 6) AS lcc, round({clip_sql('l_tax * 15', '0.0', '1.0')}, 6) AS tcc,
  round(ln(1 + ({tp})), 6) AS tp, round(ln(1 + ({ssrd})), 6) AS ssrd, round(ln(1 + l_quantity * 20), 6) AS cape, round(ln(1 + l_quantity / 2), 6) AS i10fg,
  round(l_extendedprice / 30 / 10, 6) AS slp, round(ln(1 + greatest(l_quantity - 10, 0)), 6) AS rain01h, round(ln(1 + l_quantity / 5), 6) AS v
FROM lineitem"""


def q75() -> str:
    return f"""WITH {dedup_cte(4)},
r AS (SELECT CAST(ts AS DATE) AS date, count(*) / 96.0 AS ratio FROM dedup GROUP BY 1)
SELECT {day_text('date')} AS date, CASE WHEN day(date) % 7 <> 0 THEN round(ratio, 6) END AS completeness_ratio
FROM r WHERE day(date) % 7 = 0 OR ratio < 0.95"""


def q77() -> str:
    return """WITH g AS (SELECT DISTINCT CAST(user_id % 8 AS BIGINT) AS grid_id FROM events)
SELECT grid_id, round(113.75 + 0.05 * (grid_id % 4), 6) AS lon_min, round(22.45 + 0.05 * floor(grid_id / 4), 6) AS lat_min,
       round(113.75 + 0.05 * (grid_id % 4) + 0.05, 6) AS lon_max, round(22.45 + 0.05 * floor(grid_id / 4) + 0.05, 6) AS lat_max FROM g"""


def q78() -> str:
    return f"""WITH {filled_cte(4)}
SELECT {day_text('date')} AS date, count(*) AS rows, round(sum(t), 6) AS t, round(sum(speed), 6) AS speed, true AS in_order FROM f GROUP BY 1"""


def q79() -> str:
    return f"""WITH {filled_cte(4)}
SELECT count(*) * 3 AS rows_written, count(*) * 3 AS rows_read, true AS equal FROM f"""


def q61() -> str:
    return f"""WITH {dedup_cte(4)},
pc AS (
  SELECT CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS time_point, count(*) AS rows,
         count(DISTINCT grid_id) AS grids_present
  FROM dedup WHERE grid_id BETWEEN 0 AND 3 GROUP BY 1, 2)
SELECT strftime(date, '%Y%m%d') AS date,
       CAST(24 AS BIGINT) AS total_time_points,
       CAST(count(*) - count(*) FILTER (WHERE grids_present < 4) AS BIGINT) AS complete_time_points,
       CAST(count(*) FILTER (WHERE grids_present < 4) AS BIGINT) AS incomplete_time_points_count,
       CAST(24 - count(*) AS BIGINT) AS missing_time_points_count,
       CAST(96 AS BIGINT) AS expected_points,
       CAST(sum(rows) AS BIGINT) AS actual_points,
       round(sum(rows) / 96.0, 6) AS completeness_ratio,
       CAST((SELECT count(DISTINCT user_id % 4) FROM events) AS BIGINT) AS n_grids,
       CAST((SELECT count(DISTINCT event_id // 1000) FROM events) AS BIGINT) AS n_files
FROM pc GROUP BY date"""


def q62() -> str:
    return f"""WITH {SERIES},
days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
dstep AS (SELECT day, dense_rank() OVER (ORDER BY day) - 1 AS step FROM days),
qn AS (SELECT CAST(l_shipdate AS DATE) AS day, CAST(l_suppkey % 8 AS BIGINT) AS node, sum(l_quantity) AS v
       FROM lineitem GROUP BY 1, 2),
ch AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS c0, sum(l_extendedprice) AS c1,
              sum(l_discount) AS c2, sum(l_tax) AS c3 FROM lineitem GROUP BY 1),
first_day AS (SELECT min(day) AS d0 FROM agg)
SELECT 'lineitem_nodes' AS dataset, CAST(d.step AS BIGINT) AS step, {ts_text('CAST(d.day AS TIMESTAMP)')} AS ts,
       CAST(n.n AS BIGINT) AS node, CAST(0 AS BIGINT) AS channel, round(q.v, 6) AS value
FROM dstep d CROSS JOIN range(8) n(n) LEFT JOIN qn q ON q.day = d.day AND q.node = n.n
UNION ALL
SELECT 'lineitem_channels', CAST(d.step AS BIGINT), {ts_text('CAST(d.day AS TIMESTAMP)')}, CAST(0 AS BIGINT),
       CAST(k.k AS BIGINT), round(CASE k.k WHEN 0 THEN c.c0 WHEN 1 THEN c.c1 WHEN 2 THEN c.c2 ELSE c.c3 END, 6)
FROM dstep d JOIN ch c ON c.day = d.day CROSS JOIN range(4) k(k)
UNION ALL
SELECT 'embedding_frames', CAST(vec_id AS BIGINT), CAST(NULL AS VARCHAR), CAST(i % 32 AS BIGINT),
       CAST(i // 32 AS BIGINT), round(CAST(embedding[i + 1] AS DOUBLE), 6)
FROM embeddings, range(64) r(i)
UNION ALL
SELECT 'lineitem_array', c.step, {ts_text('CAST(f.d0 AS TIMESTAMP) + to_days(CAST(c.step AS INTEGER))')}, c.node, c.channel,
       round(CAST(CAST(s.value AS FLOAT) AS DOUBLE), 6)
FROM (SELECT unnest(range(lo, hi + 1)) AS step, n.n AS node, k.k AS channel
      FROM (SELECT min(step) AS lo, max(step) AS hi FROM series GROUP BY step // 32) w, range(8) n(n), range(2) k(k)) c
     LEFT JOIN series s ON s.step = c.step AND s.node = c.node AND s.channel = c.channel, first_day f"""


ORACLE = {
    "q01_completeness_daily": completeness_sql(4),
    "q02_dedup_keep_first": f"WITH {dedup_cte(4)} SELECT {obs_select()} FROM dedup",
    "q03_missing_times": q03(),
    "q04_gap_runs": q04(),
    "q05_scaffold_join": q05(),
    "q06_completeness_filter": q06(),
    "q07_missing_pages": q07(),
    "q08_missing_dates": q08(),
    "q09_chunk_plan": q09(),
    "q10_span_overlap": q10(),
    "q11_sentinel_null": q11(),
    "q12_linear_fill": fill_query(4),
    "q65_temporal_fill_linear": fill_query(8),
    "q13_mean_field": q13(),
    "q14_wind_components": q14(),
    "q15_air_density": q15(),
    "q16_relative_humidity": q16(),
    "q17_units_log": q17(),
    "q18_first_non_null": q18(),
    "q19_grid_ids": q19(),
    "q20_tail_truncate": q20(),
    "q21_wrap_lonlat": q21(),
    "q22_axis_order": q22(),
    "q23_location_batches": q23(),
    "q24_coords_min_max": q24(),
    "q25_coords_sphere": q25(),
    "q26_elevation_join": q26(),
    "q27_grid_generate": q27(),
    "q28_normalise": q28(),
    "q70_train_split": q70(),
    "q29_step_samples_masked": q29(),
    "q30_sliding_in_day": q30(),
    "q31_tumbling_in_day": q31(),
    "q32_sliding_series": q32(),
    "q33_tumbling_series": q33(),
    "q34_wide_to_long": q34(),
    "q35_pack_day": q35(),
    "q36_regular_timestamps": q36(),
    "q37_slot_timestamp": q37(),
    "q38_parse_mixed": q38(),
    "q39_series_shape": q39(),
    "q40_spatial_fill_local": q40(),
    "q49_feature_groups": q49(),
    "q50_date_range_day_filter": q50(),
    "q51_drop_mean_field": q51(),
    "q52_null_report": q52(),
    "q53_file_status": q53(),
    "q54_step_index": q54(),
    "q55_conform_schema": q55(),
    "q56_sample_context": q56(),
    "q57_key_lookup": q57(),
    "q58_first_step_coords": q58(),
    "q59_union_dedup": f"WITH {dedup_cte(4)} SELECT {obs_select()} FROM dedup",
    "q60_set_difference": q60(),
    "q64_time_labels": q64(),
    "q45_json_pages": f"WITH {obs_cte(4)} SELECT {obs_select()} FROM obs",
    "q46_stream_dedup": f"WITH {dedup_cte(4)} SELECT {obs_select()} FROM dedup",
    "q47_stream_completeness": q47(),
    "q66_stream_report": completeness_sql(4),
    "q67_stream_late": q67(),
    "q48_tensor_roundtrip": q48(),
    "q68_prediction_samples": q68(),
    "q69_masked_samples": q69(),
    "q72_cube_conflicts": q72(),
    "q74_unit_rules": q74(),
    "q75_ignored_days": q75(),
    "q76_series_check": f"SELECT dataset, count(*) AS n, count(*) AS n_back, true AS equal FROM ({q62()}) GROUP BY dataset",
    "q77_grid_info": q77(),
    "q78_daily_order": q78(),
    "q79_tensor_check": q79(),
    "q73_page_report": q73(),
    "q41_cubic_fill": q41(),
    "q42_spline_fill": q42(),
    "q43_spatial_fill": q43(),
    "q71_spatial_fill_tiled": q43(),
    "q44_st_fill": q44(8),
    "q61_page_file_roundtrip": q61(),
    "q62_catalog_dispatch": q62(),
    "q63_merge_cubes": f"WITH {merged_cte()} SELECT {ts_text('ts')} AS ts, "
                       + ", ".join(f"round({c}, 6) AS {c}" for c in ["lon", "lat", "t2m", "d2m", "u10", "v10", "sp", "tp"])
                       + " FROM merged",
}
