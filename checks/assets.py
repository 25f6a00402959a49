"""Assets: newest, stale, expired, first."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, table
from corpusloom.functions.text import suffix_of, to_billions, to_gib
from corpusloom.operators.retention import expired, first_asset, latest_asset, newest, preview, stale

ASSETS_SQL = """assets AS (
  SELECT event_id, event_type, ts AS mtime,
         event_type || '_' || event_id || CASE event_id % 3 WHEN 0 THEN '.wav' WHEN 1 THEN '.MP3' ELSE '.txt' END AS path
  FROM events)"""


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 3
    suffix = F.when(kind == 0, ".wav").when(kind == 1, ".MP3").otherwise(".txt")
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").alias("mtime"), F.concat_ws("", F.concat_ws("_", "event_type", "event_id"), suffix).alias("path")
    )


@query("SELECT user_id, arg_max(event_id, ts) AS latest FROM events GROUP BY user_id")
def e5_latest_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_asset(table(spark, sf_dir, "events"), ["user_id"], path="event_id", mtime="ts")


_RANKED = f"""WITH {ASSETS_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY mtime DESC, path) AS r FROM assets)"""


@query(f"{_RANKED} SELECT event_type, path FROM ranked WHERE r <= 10")
def g1_keep_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(_assets(spark, sf_dir), 10, ["event_type"], "mtime").select("event_type", "path")


@query(f"{_RANKED} SELECT event_type, path FROM ranked WHERE r > 10")
def g1_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale(_assets(spark, sf_dir), 10, ["event_type"], "mtime").select("event_type", "path")


@query(
    f"WITH {ASSETS_SQL} SELECT path FROM (SELECT *, row_number() OVER (ORDER BY mtime DESC, path) AS r FROM assets) WHERE r > 10"
)
def g1_stale_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale(_assets(spark, sf_dir), 10, mtime="mtime").select("path")


@query(
    f"""WITH {ASSETS_SQL} SELECT event_id, path FROM assets
        WHERE lower(path) SIMILAR TO '.*\\.(wav|mp3)' AND epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(mtime) > 3600"""
)
def g2_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return expired(_assets(spark, sf_dir), now, mtime="mtime").select("event_id", "path")


@query(f"WITH {ASSETS_SQL} SELECT path, event_id FROM assets ORDER BY path LIMIT 1")
def g3_first_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_asset(_assets(spark, sf_dir)).select("path", "event_id")


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name LIMIT 5")
def g4_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_name")


@query(
    """SELECT page_id, lower(regexp_extract(url, '(\\.[^./]+)$', 1)) AS suffix,
       lower(regexp_extract(split_part(url, '/', 3) || '/a.b/page.HTML', '(\\.[^./]+)$', 1)) AS file_suffix FROM pages"""
)
def h8_suffix_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.split_part("url", F.lit("/"), F.lit(3))
    return table(spark, sf_dir, "pages").select(
        "page_id", suffix_of("url").alias("suffix"), suffix_of(F.concat(host, F.lit("/a.b/page.HTML"))).alias("file_suffix")
    )


@query(
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * 1000000 / 1073741824, 2) AS gib,
       round(l_extendedprice * 1000000 / 1e9, 1) AS billions FROM lineitem"""
)
def h11_size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("l_extendedprice") * 1_000_000
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", to_gib(size).alias("gib"), to_billions(size).alias("billions")
    )
