"""Sites near each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewcast.functions.geo import cell, haversine_km, reachable_cells
from crewcast.session import materialise


def located_sites(jobs: DataFrame) -> DataFrame:
    """One row per site with coordinates; differing coordinates are settled by the smallest."""
    known = jobs.select("customer_id", "SiteCode", "Latitude", "Longitude").dropna()
    point = F.min(F.struct("Latitude", "Longitude"))
    return known.groupBy("customer_id", "SiteCode").agg(point.alias("p")).select(
        "customer_id", "SiteCode", "p.Latitude", "p.Longitude"
    )


#: Sites of one customer in a cell that one key holds; a more crowded cell is cut into parts.
CELL_SITES = 512


def crowded_cells(placed: DataFrame) -> DataFrame:
    """``(customer_id, cell, parts)`` of the cells with more than ``CELL_SITES`` sites."""
    counted = placed.groupBy("customer_id", "cell").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > CELL_SITES).select("customer_id", "cell", F.ceil(F.col("n") / CELL_SITES).cast("int").alias("parts"))


def near_sites(sites: DataFrame, km: float) -> DataFrame:
    """``(customer_id, site_a, site_b, km)`` for pairs of one customer nearer than ``km``.

    Each pair appears once, ``site_a < site_b``. A grid-cell equi-join finds the
    candidates, so only sites of neighbouring cells are compared. A crowded cell is cut
    into parts by a hash of its sites; the sites around it look into each part, so that one
    customer with all sites in a cell is still compared by many tasks.
    """
    sites = materialise(sites.select("customer_id", "SiteCode", "Latitude", "Longitude"), "sites")  # looked at three times
    placed = sites.select(
        "customer_id",
        F.col("SiteCode").alias("site_b"),
        F.col("Latitude").alias("lat_b"),
        F.col("Longitude").alias("lon_b"),
        cell(F.col("Latitude"), F.col("Longitude"), km).alias("cell"),
    )
    looking = sites.select(
        "customer_id",
        F.col("SiteCode").alias("site_a"),
        F.col("Latitude").alias("lat_a"),
        F.col("Longitude").alias("lon_a"),
        F.explode(reachable_cells(F.col("Latitude"), F.col("Longitude"), km)).alias("cell"),
    )
    left, right, keys = looking, placed, ["customer_id", "cell"]
    if not crowded_cells(placed).isEmpty():
        crowded = materialise(crowded_cells(placed), "crowded-cells")
        parts = F.coalesce("parts", F.lit(1))
        right = placed.join(crowded, keys, "left").withColumn("part", F.pmod(F.xxhash64("site_b"), parts)).drop("parts")
        left = looking.join(crowded, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        keys = [*keys, "part"]
    distance = haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    pairs = left.join(right, keys).where("site_a < site_b")
    return pairs.select("customer_id", "site_a", "site_b", distance.alias("km")).where(F.col("km") < km)


def distance_to(sites: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """Distance of every site from one point."""
    return sites.withColumn(
        "km", haversine_km(F.col("Latitude"), F.col("Longitude"), F.lit(latitude), F.lit(longitude))
    )
