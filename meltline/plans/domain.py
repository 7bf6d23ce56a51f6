"""The domain tables as views of a star schema, in Spark and in SQL, so that every operator can run on either."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of_water_year, water_year
from ..operators.masks import snow_window

YEARS = list(range(1995, 2003))
ORDER = ("time", "l_orderkey", "l_partkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from lineitem: a pixel is a supplier, an orbit a line number."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("pixel"), F.col("l_linenumber").cast("int").alias("orbit"), F.col("l_shipdate").alias("time"),
        (F.col("l_extendedprice") / 1e5).alias("vv"), F.col("l_discount").alias("vh"), "l_orderkey", "l_partkey",
    )
    return rows.withColumns({"latitude": (F.col("pixel") % 40 - 20) / 10.0, "water_year": water_year("time"), "dowy": day_of_water_year("time")})


OBS = """
obs AS (SELECT *, date_diff('day', make_date(water_year - 1, 10, 1), CAST(time AS DATE)) + 1 AS dowy FROM (
  SELECT l_suppkey AS pixel, CAST(l_linenumber AS INT) AS orbit, l_shipdate AS time, l_extendedprice / 1e5 AS vv, l_discount AS vh, l_orderkey, l_partkey,
    (l_suppkey % 40 - 20) / 10.0::DOUBLE AS latitude, CAST(year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END AS INT) AS water_year FROM lineitem))"""


def phenology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snow phenology of each supplier and year, with some values missing."""
    years = spark.createDataFrame([(y,) for y in YEARS], "water_year int")
    s, wy = F.col("s_suppkey"), F.col("water_year")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey").crossJoin(F.broadcast(years))
    sad = 1 + (s * 7 + wy) % 60
    consec = 40 + (s * 13 + wy * 5) % 160
    return rows.select(
        s.alias("pixel"), "water_year", sad.cast("double").alias("SAD_DOWY"), F.when((s + wy) % 23 != 0, sad + consec + s % 20).cast("double").alias("SDD_DOWY"),
        F.when((s + wy) % 29 != 0, consec).cast("double").alias("max_consec_snow_days"),
    )


PHENOLOGY = """
pheno AS (SELECT s_suppkey AS pixel, CAST(wy AS INT) AS water_year, CAST(1 + (s_suppkey * 7 + wy) % 60 AS DOUBLE) AS sad,
  CAST(CASE WHEN (s_suppkey + wy) % 23 <> 0 THEN 1 + (s_suppkey * 7 + wy) % 60 + 40 + (s_suppkey * 13 + wy * 5) % 160 + s_suppkey % 20 END AS DOUBLE) AS sdd,
  CAST(CASE WHEN (s_suppkey + wy) % 29 <> 0 THEN 40 + (s_suppkey * 13 + wy * 5) % 160 END AS DOUBLE) AS consec
  FROM supplier CROSS JOIN range(1995, 2003) AS y(wy)),
win AS (SELECT pixel, water_year, sad + consec / 2 AS ws, CASE WHEN sdd + 16 <= 366 THEN sdd + 16 ELSE 366 END AS we,
  CASE WHEN sdd + 16 <= 366 THEN sdd + 16 ELSE 366 END - (sad + consec / 2) AS wl, coalesce(consec >= 56, false) AS seasonal FROM pheno)"""


def window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snow_window(phenology(spark, sf_dir))


#: Observations after the noise and season masks; in SQL with the same thresholds.
THRESHOLD, UNTIL = 0.2, "1998-03-14"
MASKED = (
    OBS + "," + PHENOLOGY + """,
noise AS (SELECT * REPLACE (CASE WHEN vv > CASE WHEN time < TIMESTAMP '1998-03-14' THEN 0.2 ELSE 0 END THEN vv END AS vv,
  CASE WHEN vh > CASE WHEN time < TIMESTAMP '1998-03-14' THEN 0.2 ELSE 0 END THEN vh END AS vh) FROM obs),
masked AS (SELECT o.* REPLACE (CASE WHEN coalesce(dowy BETWEEN ws AND we AND seasonal, false) THEN vv END AS vv,
  CASE WHEN coalesce(dowy BETWEEN ws AND we AND seasonal, false) THEN vh END AS vh), ws, we, wl, seasonal
  FROM noise o LEFT JOIN win w ON o.pixel = w.pixel AND o.water_year = w.water_year)"""
)


def masked_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.masks import noise_mask, seasonal_mask

    return seasonal_mask(noise_mask(obs(spark, sf_dir), threshold=THRESHOLD, until=UNTIL), window(spark, sf_dir))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile catalogue from customers: 200 tiles."""
    c = table(spark, sf_dir, "customer")
    return c.groupBy((F.col("c_custkey") % 50).cast("int").alias("row"), (F.col("c_custkey") % 40).cast("int").alias("col")).agg(
        F.max(F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))).alias("percent_valid_snow_pixels")
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result log from orders."""
    o = table(spark, sf_dir, "orders")
    ok = F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False)
    return o.select(
        (F.col("o_custkey") % 50).cast("int").alias("row"), (F.col("o_custkey") % 40).cast("int").alias("col"), ok.alias("success"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("start_time"), F.col("o_orderkey").alias("sequence"), F.col("o_totalprice").alias("total_time"),
    )


TILES = """
tiles AS (SELECT CAST(c_custkey % 50 AS INT) AS "row", CAST(c_custkey % 40 AS INT) AS col, max(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END) AS percent_valid_snow_pixels FROM customer GROUP BY 1, 2),
results AS (SELECT CAST(o_custkey % 50 AS INT) AS "row", CAST(o_custkey % 40 AS INT) AS col, CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS success,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS start_time, o_orderkey AS sequence, o_totalprice AS total_time FROM orders)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart cells from parts, with the lines' mean shipping day as the onset."""
    p, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    onset = line.groupBy("l_partkey").agg(F.median(F.dayofyear("l_shipdate")).alias("runoff_onset_median"), F.stddev_pop("l_quantity").alias("runoff_onset_mad"))
    rows = p.join(onset, p.p_partkey == onset.l_partkey, "left")
    return rows.select(
        F.col("p_partkey").alias("pixel"), (F.col("p_size") * 170.0).alias("dem"), ((F.col("p_partkey") % 1000) / 1000.0).alias("chili"),
        ((F.col("p_partkey") % 161 - 80) / 1.0).alias("original_lat"), F.when(F.col("p_partkey") % 13 != 0, F.col("p_retailprice") % 100).alias("forest_cover_fraction"),
        "runoff_onset_median", "runoff_onset_mad",
    )


CELLS = """
onset AS (SELECT l_partkey, median(dayofyear(l_shipdate)) AS runoff_onset_median, stddev_pop(l_quantity) AS runoff_onset_mad FROM lineitem GROUP BY 1),
cells AS (SELECT p_partkey AS pixel, p_size * 170.0::DOUBLE AS dem, CAST(p_partkey % 1000 AS DOUBLE) / 1000 AS chili, CAST(p_partkey % 161 - 80 AS DOUBLE) AS original_lat,
  CASE WHEN p_partkey % 13 <> 0 THEN p_retailprice % 100 END AS forest_cover_fraction, runoff_onset_median, runoff_onset_mad FROM part LEFT JOIN onset ON p_partkey = l_partkey)"""


def swe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station series from orders: a nation's sum of the day, dense, missing where there was no order."""
    from ..operators.stations import dense_days

    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    days = o.join(c, o.o_custkey == c.c_custkey).groupBy((F.col("c_nationkey") % 5).cast("int").alias("station"), F.to_date("o_orderdate").alias("date"))
    rows = dense_days(days.agg((F.sum(F.round(F.col("o_totalprice")).cast("long")) / 2_500_000.0).alias("swe")))
    return rows.withColumns({"wy": water_year("date"), "dowy": day_of_water_year("date")})


SWE = """
days AS (SELECT CAST(c_nationkey % 5 AS INT) AS station, CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) / 2500000 AS swe FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
span AS (SELECT station, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM days GROUP BY station),
swe AS (SELECT s.station, s.date, d.swe, CAST(year(s.date) + CASE WHEN month(s.date) >= 10 THEN 1 ELSE 0 END AS INT) AS wy,
  date_diff('day', make_date(CAST(year(s.date) + CASE WHEN month(s.date) >= 10 THEN 1 ELSE 0 END AS INT) - 1, 10, 1), s.date) + 1 AS dowy FROM span s LEFT JOIN days d USING (station, date))"""
