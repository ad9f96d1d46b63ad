"""Common table expressions of the SQL twins (DuckDB)."""

from ..dimensions import COLOUR_ANCHORS

NAMES = "['dwd','shmu','chmi','omsz','arso','imgw']"

STAMPED = f"""stamped AS (
 SELECT event_id, user_id, event_type, value, ts AS instant, source, minute AS ts,
        CASE WHEN source IN ('dwd','omsz') THEN strftime(minute,'%Y%m%d_%H%M') ELSE strftime(minute,'%Y%m%d%H%M%S') END AS ts_raw
 FROM (SELECT *, list_extract({NAMES}, CAST(event_id % 6 AS INT) + 1) AS source, date_trunc('minute', ts) AS minute FROM events))"""
CATALOG = STAMPED + """,
catalog AS (SELECT DISTINCT source, ts, ts_raw FROM stamped)"""
STEPS = CATALOG + """,
steps AS (SELECT source, lag(ts) OVER (PARTITION BY source ORDER BY ts) AS a, ts AS b FROM (SELECT DISTINCT source, ts FROM catalog)),
gaps AS (SELECT source, a, b, date_diff('second', a, b) / 60.0::DOUBLE AS minutes FROM steps WHERE a IS NOT NULL)"""
ATTEMPTS = """attempts AS (SELECT user_id AS key, ts, event_id, event_type <> 'error' AS ok FROM events),
islands AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, event_id) AS isl FROM attempts),
streaks AS (SELECT key, ts, event_id, ok,
  CASE WHEN ok THEN 0 ELSE sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY key, isl ORDER BY ts, event_id) END AS streak FROM islands)"""

RAW = f"""raw_cells AS (
 SELECT vec_id, CAST(vec_id % 6 AS INT) AS source_id, list_extract({NAMES}, CAST(vec_id % 6 AS INT) + 1) AS source,
        CAST(vec_id // 6 AS INT) AS slot, CAST((p - 1) // 8 AS INT) AS "row", CAST((p - 1) % 8 AS INT) AS col,
        CAST(least(255, greatest(0, floor((CAST(embedding[p] AS DOUBLE) + 0.5) * 255))) AS INT) AS raw
 FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings))"""
CELLS = RAW + """,
cells AS (SELECT *, raw * 0.5::DOUBLE - 32 AS dbz FROM raw_cells WHERE raw NOT IN (0, 255))"""
BIG = f"""big_raw AS (
 SELECT CAST(l_orderkey % 6 AS INT) AS source_id, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS slot,
        CAST(l_partkey % 16 AS INT) AS "row", CAST(l_suppkey % 16 AS INT) AS col, max(CAST(trunc(l_quantity * 5) AS INT)) AS raw
 FROM lineitem GROUP BY ALL),
big AS (SELECT *, list_extract({NAMES}, source_id + 1) AS source, raw * 0.5::DOUBLE - 32 AS dbz FROM big_raw WHERE raw >= 25)"""


def target(n: int) -> str:
    return f"""bounds AS (SELECT 10.0::DOUBLE * 20037508.34 / 180 AS x0, 17.0::DOUBLE * 20037508.34 / 180 AS x1,
   ln(tan((90.0::DOUBLE + 45) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y0,
   ln(tan((90.0::DOUBLE + 50.1) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y1),
tgt AS (SELECT CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col, x0 + (c + 0.5::DOUBLE) * ((x1 - x0) / {n}) AS x,
   y1 - (r + 0.5::DOUBLE) * ((y1 - y0) / {n}) AS y FROM bounds, range({n}) t(r), range({n}) u(c)),
tll AS (SELECT *, x / 20037508.34 * 180 AS lon, atan(exp(y / 20037508.34 * pi())) * 360 / pi() - 90 AS lat FROM tgt)"""


def gmap(n: int, px: float, size: int) -> str:
    return target(n) + f""",
gmap AS (SELECT * FROM (SELECT CAST(id AS INT) AS source_id, dst_row, dst_col, lon, lat,
   CAST(floor((50 - 0.25::DOUBLE * id - lat) / {px}::DOUBLE) AS INT) AS "row",
   CAST(floor((lon - (10 + 0.5::DOUBLE * id)) / {px}::DOUBLE) AS INT) AS col FROM tll, range(6) g(id))
   WHERE "row" BETWEEN 0 AND {size - 1} AND col BETWEEN 0 AND {size - 1})"""


SMALL_PLACED = CELLS + ",\n" + gmap(14, 0.5, 8) + """,
placed AS (SELECT c.source_id, c.source, c.slot, m.dst_row, m.dst_col, m.lon, m.lat, c.dbz
  FROM cells c JOIN gmap m USING (source_id, "row", col))"""
BIG_PLACED = BIG + ",\n" + gmap(28, 0.25, 16) + """,
placed AS (SELECT c.source_id, c.source, c.slot, m.dst_row, m.dst_col, m.lon, m.lat, c.dbz
  FROM big c JOIN gmap m USING (source_id, "row", col))"""


def nearest(tolerance: int) -> str:
    """Nearest scan of every source for every candidate minute, as a plain theta join."""
    return CATALOG + f""",
cand AS (SELECT DISTINCT ts AS candidate FROM catalog),
nearest AS (SELECT candidate, source, min(abs(date_diff('minute', ts, candidate))) AS gap,
   arg_min(ts, abs(date_diff('minute', ts, candidate)) * 100000000000 + epoch(ts)) AS ts
   FROM cand JOIN catalog ON ts BETWEEN candidate - INTERVAL {tolerance} MINUTE AND candidate + INTERVAL {tolerance} MINUTE GROUP BY ALL),
slots AS (SELECT candidate, count(*) AS n FROM nearest GROUP BY candidate)"""


SCALE = (
    "anchors(d, r, g, b) AS (VALUES " + ", ".join(str(a) for a in COLOUR_ANCHORS) + """),
steps AS (SELECT CAST(s AS INT) AS dbz, (s + 35) // 5 * 5 - 35 AS lo FROM range(-35, 86) t(s)),
scale AS (SELECT dbz, CAST(trunc(a.r + (dbz - lo) / 5.0::DOUBLE * (coalesce(z.r, a.r) - a.r)) AS INT) AS r, CAST(trunc(a.g + (dbz - lo) / 5.0::DOUBLE * (coalesce(z.g, a.g) - a.g)) AS INT) AS g,
  CAST(trunc(a.b + (dbz - lo) / 5.0::DOUBLE * (coalesce(z.b, a.b) - a.b)) AS INT) AS b FROM steps JOIN anchors a ON a.d = lo LEFT JOIN anchors z ON z.d = lo + 5),
lut AS (SELECT CAST(i AS INT) AS idx, r, g, b FROM range(256) t(i) JOIN scale ON dbz = CAST(floor(-35 + i * (120 / 255.0::DOUBLE) + 0.5) AS INT))"""
)
