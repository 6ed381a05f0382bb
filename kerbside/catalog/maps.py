"""Map and density queries: orders stand for ways, their line items for edges and points, parts
for nodes, customers and suppliers for points and sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import register, with_sql
from kerbside.functions import times
from kerbside.operators import aggregates, joins
from kerbside.operators.nearest import nearest_site
from kerbside.plans.mapview import density_map, map_summary, matched_features
from kerbside.sources.maps import features_without_lines, map_features

# --- fixed values: order priorities as road classes, statuses without a name ---
HIGHWAYS = {"1-URGENT": "trunk", "2-HIGH": "primary", "3-MEDIUM": "residential", "5-LOW": "footway"}
UNNAMED_STATUS = "F"
# --- end of fixed values ---


def points(spark, sf_dir):
    c = base.table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("point_id"),
        (21.0 + (F.col("c_custkey") % 1000) / 10000.0).alias("lat"),
        (105.8 + (F.col("c_custkey") % 777) / 10000.0).alias("lon"),
    )


def sites(spark, sf_dir):
    key = F.col("s_suppkey") * 37
    return base.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("site_id"),
        (21.0 + (key % 1000) / 10000.0).alias("lat"),
        (105.8 + (key % 777) / 10000.0).alias("lon"),
    )


def edges(spark, sf_dir):
    items = base.table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_returnflag") == "R", "-").otherwise("")
    edge = F.concat(sign, F.col("l_orderkey").cast("string"), F.lit("#"), F.col("l_linenumber").cast("string"))
    return items.select(edge.alias("id"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")


def ways(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders")
    items = base.table(spark, sf_dir, "lineitem")
    listed = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("r"))
    refs = listed.select("l_orderkey", F.transform("r", lambda x: x["l_partkey"].cast("string")).alias("refs"))
    named = F.when(F.col("o_orderstatus") != UNNAMED_STATUS, F.concat(F.lit("Street "), F.col("o_custkey").cast("string")))
    classes = F.create_map(*[F.lit(x) for pair in HIGHWAYS.items() for x in pair])
    return orders.join(refs, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("way_id"),
        named.alias("name"),
        F.try_element_at(classes, F.col("o_orderpriority")).alias("highway"),
        F.coalesce("refs", F.array().cast("array<string>")).alias("refs"),
    )


def nodes(spark, sf_dir):
    return base.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("node_id"),
        (21.0 + F.col("p_partkey") / 10000.0).alias("lat"),
        (105.8 + F.col("p_size") / 1000.0).alias("lon"),
    )


def features(spark, sf_dir, make=map_features):
    return make(ways(spark, sf_dir), nodes(spark, sf_dir), edges(spark, sf_dir))


WAYS = """
w AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS way_id, CASE WHEN o_orderstatus <> 'F' THEN 'Street ' || o_custkey END AS name,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'trunk' WHEN '2-HIGH' THEN 'primary' WHEN '3-MEDIUM' THEN 'residential'
           WHEN '5-LOW' THEN 'footway' END AS highway FROM orders),
e AS (SELECT CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || l_orderkey || '#' || l_linenumber AS id, l_orderkey,
             l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem),
p AS (SELECT CAST(l_orderkey AS VARCHAR) AS way_id, l_linenumber, l_partkey, 21.0 + p_partkey / 10000.0 AS lat, 105.8 + p_size / 1000.0 AS lon,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos
      FROM lineitem JOIN part ON l_partkey = p_partkey),
f AS (SELECT w.* FROM w JOIN (SELECT way_id, count(*) AS n FROM p GROUP BY way_id) c USING (way_id)
      WHERE name IS NOT NULL AND highway IS NOT NULL AND n >= 2)"""


@register("j07_edge_road_names", with_sql(WAYS, "SELECT e.id, w.name AS road_name FROM e LEFT JOIN w ON e.l_orderkey = w.o_orderkey"))
def edge_names(spark, sf_dir):
    return joins.with_road_names(edges(spark, sf_dir), ways(spark, sf_dir)).select("id", "road_name")


@register("j08_a20_way_edges", with_sql(WAYS, """
SELECT w.way_id, coalesce(string_agg(d.id, '|' ORDER BY d.id), '') AS edge_ids
FROM w LEFT JOIN (SELECT DISTINCT l_orderkey, id FROM e) d ON d.l_orderkey = w.o_orderkey GROUP BY w.way_id"""))
def way_edges(spark, sf_dir):
    joined = joins.with_edge_ids(ways(spark, sf_dir), edges(spark, sf_dir))
    return joined.select("way_id", F.array_join("edge_ids", "|").alias("edge_ids"))


@register("j09_w06_polylines", with_sql(WAYS, "SELECT way_id, CAST(pos AS INTEGER) AS pos, lat, lon FROM p"))
def polylines(spark, sf_dir):
    lines = joins.polylines(ways(spark, sf_dir), nodes(spark, sf_dir))
    points_ = lines.select("way_id", F.posexplode("coordinates").alias("pos", "at"))
    return points_.select("way_id", "pos", F.col("at")[0].alias("lat"), F.col("at")[1].alias("lon"))


@register("p19_map_features", with_sql(WAYS, """
SELECT way_id, name, highway, (SELECT count(DISTINCT id) FROM e WHERE e.l_orderkey = f.o_orderkey) AS edges,
       (SELECT count(*) FROM p WHERE p.way_id = f.way_id) AS points FROM f"""))
def drawable(spark, sf_dir):
    found = features(spark, sf_dir)
    return found.select(
        "way_id", "name", "highway",
        F.size("edge_ids").cast("bigint").alias("edges"), F.size("coordinates").cast("bigint").alias("points"),
    )


@register("a21_bounding_box", with_sql(WAYS, """
SELECT min(lat) AS min_lat, min(lon) AS min_lon, max(lat) AS max_lat, max(lon) AS max_lon FROM p JOIN f USING (way_id)"""))
def box(spark, sf_dir):
    return aggregates.bounding_box(features(spark, sf_dir))


def records(spark, sf_dir):
    """Density records of line items: by edge, or only by street name where returns are none."""
    minute = F.floor(F.col("l_quantity") * 28).cast("int")
    items = edges(spark, sf_dir).join(
        base.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    by_name = F.col("l_returnflag") == "N"
    frame = items.select(
        F.when(~by_name, F.col("id")).alias("edge_id"),
        F.concat(F.lit("Street "), F.col("o_custkey").cast("string")).alias("road_name"),
        F.concat(F.lit("2024-01-01T"), times.minutes_to_clock(minute)).alias("recordDatetime"),
        (F.col("l_partkey") % 100).cast("double").alias("avg_density"),
    )
    return aggregates.density_records(frame)


# A record's keys: its edge as is, without direction and without part; or its street's name,
# which the lower-case and the normalised form both give.
RECORDS = WAYS + """,
r AS (SELECT id, split_part(ltrim(id, '-'), '#', 1) AS way, 'street ' || o_custkey AS street, l_returnflag = 'N' AS by_name,
             CAST(floor(l_quantity * 28) AS INTEGER) AS minute, CAST(l_partkey % 100 AS DOUBLE) AS density
      FROM e JOIN orders ON l_orderkey = o_orderkey),
k AS (SELECT id AS key, minute, density FROM r WHERE NOT by_name UNION ALL
      SELECT ltrim(id, '-'), minute, density FROM r WHERE NOT by_name AND id LIKE '-%' UNION ALL
      SELECT way, minute, density FROM r WHERE NOT by_name UNION ALL
      SELECT street, minute, density FROM r, range(2) WHERE by_name)"""


@register("a17_density_at_minute", with_sql(RECORDS, """
SELECT key, avg(density) AS density, count(*) AS rows FROM k WHERE floor(minute / 3.0 + 0.5) * 3 = 840 GROUP BY key"""))
def at_minute(spark, sf_dir):
    return aggregates.density_by_key(records(spark, sf_dir), 840)


@register("a17_density_all_day", with_sql(RECORDS, "SELECT key, avg(density) AS density, count(*) AS rows FROM k GROUP BY key"))
def all_day(spark, sf_dir):
    return aggregates.density_by_key(records(spark, sf_dir), None)


@register("a18_density_range", with_sql(RECORDS, 'SELECT key, min(density) AS min, max(density) AS max FROM k GROUP BY key'))
def density_range(spark, sf_dir):
    return aggregates.density_range_by_key(records(spark, sf_dir))


@register("a19_available_minutes", with_sql(RECORDS, "SELECT DISTINCT CAST(floor(minute / 3.0 + 0.5) * 3 AS INTEGER) AS minute FROM r"))
def minutes(spark, sf_dir):
    return aggregates.available_minutes(records(spark, sf_dir))


_MAP = RECORDS + """,
now AS (SELECT key, avg(density) AS density, count(*) AS rows FROM k WHERE floor(minute / 3.0 + 0.5) * 3 = 840 GROUP BY key),
day AS (SELECT key, min(density) AS lo, max(density) AS hi FROM k GROUP BY key),
m AS (SELECT f.way_id, f.name, f.highway, coalesce(a.density, b.density) AS density, coalesce(a.rows, b.rows, 0) AS rows,
             coalesce(c.lo, d.lo) AS lo, coalesce(c.hi, d.hi) AS hi
      FROM f LEFT JOIN now a ON a.key = f.way_id LEFT JOIN now b ON b.key = lower(f.name)
             LEFT JOIN day c ON c.key = f.way_id LEFT JOIN day d ON d.key = lower(f.name)),
c AS (SELECT *, CASE highway WHEN 'trunk' THEN [1.5, 3, 5] WHEN 'primary' THEN [3, 7, 11] WHEN 'residential' THEN [3, 6, 10] ELSE [4, 8, 12] END AS t FROM m)"""


@register("j10_density_map", with_sql(_MAP, """
SELECT way_id, name, highway, density, rows, lo AS day_min_density, hi AS day_max_density,
       CASE WHEN density IS NULL THEN 'no data' WHEN density < t[1] THEN 'free' WHEN density < t[2] THEN 'busy'
            WHEN density < t[3] THEN 'heavy' ELSE 'jammed' END AS density_class,
       density IS NOT NULL AS matched FROM c"""))
def on_map(spark, sf_dir):
    return density_map(features(spark, sf_dir, features_without_lines), records(spark, sf_dir), 840)


@register("a19_map_summary", with_sql(_MAP, """
SELECT count(*) FILTER (density IS NOT NULL) AS matched_features, (SELECT max(density) FROM now) AS max_density FROM m"""))
def summary(spark, sf_dir):
    seen = records(spark, sf_dir)
    return map_summary(matched_features(features(spark, sf_dir, features_without_lines), seen, 840), aggregates.density_by_key(seen, 840))


@register("j11_nearest_site", """
WITH p AS (SELECT c_custkey AS point_id, 21.0 + (c_custkey % 1000) / 10000.0 AS lat, 105.8 + (c_custkey % 777) / 10000.0 AS lon FROM customer),
s AS (SELECT s_suppkey AS site_id, 21.0 + (s_suppkey * 37 % 1000) / 10000.0 AS lat, 105.8 + (s_suppkey * 37 % 777) / 10000.0 AS lon FROM supplier),
d AS (SELECT point_id, site_id, sqrt(pow((s.lat - p.lat) * 111000, 2) + pow((s.lon - p.lon) * 111000 * cos(radians(p.lat)), 2)) AS m FROM p, s)
SELECT point_id, arg_min(site_id, (m, site_id)) AS site_id FROM d GROUP BY point_id""")
def nearest(spark, sf_dir):
    """Site only: distances differ in their last digits between maths libraries."""
    return nearest_site(points(spark, sf_dir), sites(spark, sf_dir)).select("point_id", "site_id")
