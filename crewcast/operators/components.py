"""Groups of jobs that cannot influence each other's placement.

Two jobs interact only through a shared crew or, with neighbour locks on, through
sites of one customer close to each other. Nodes are pools, booked crews and crew
classes rather than jobs, so the graph stays small next to the job table. Node ids are
64-bit hashes; a collision could only merge two groups, which keeps results exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewcast.functions.geo import cell, reachable_cells
from crewcast.operators.joins import join_null_safe
from crewcast.operators.matching import crew_classes, pools_of, skill_pairs
from crewcast.operators.triage import BOOKED
from crewcast.session import materialise


def _node(kind: str, *columns: str) -> Column:
    marked = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(kind), *marked)


def job_node() -> Column:
    return F.when(F.col("phase") == BOOKED, _node("crew", "LockVendor", "CrewIdBooked")).otherwise(
        _node("pool", "Market", "VendorBooked", "need_key")
    )


def class_node() -> Column:
    return _node("class", "Market", "VendorID", "have_key")


def crew_node() -> Column:
    return _node("crew", "VendorID", "crew_name")


def _edges(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(a.alias("a"), b.alias("b")).where("a <> b").distinct()


def crew_edges(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Links pools to the classes they may draw on, and classes to their crews."""
    pools = pools_of(jobs.where(F.col("phase") > BOOKED))
    classes = crew_classes(crews)
    sets = join_null_safe(skill_pairs(pools, classes), pools, ["Market", "need_key"])
    sets = sets.select("Market", "need_key", "VendorBooked", F.col("have_key").alias("_have"))
    pool = _node("pool", "Market", "VendorBooked", "need_key").alias("pool")
    any_vendor = sets.where(F.col("VendorBooked").isNull()).select(
        pool, F.col("Market").alias("_m"), "_have"
    )
    kept = any_vendor.select("_m", "_have").distinct()
    same = (F.col("Market") == F.col("_m")) & F.col("have_key").eqNullSafe(F.col("_have"))
    one_vendor = sets.where(F.col("VendorBooked").isNotNull()).select(
        pool, F.col("Market").alias("_m"), "_have", F.col("VendorBooked").alias("_v")
    )
    held = _node("set", "_m", "_have")
    parts = [
        _edges(any_vendor, F.col("pool"), held),
        _edges(classes.join(kept, same), held, class_node()),
        _edges(classes.join(one_vendor, same & (F.col("VendorID") == F.col("_v"))), F.col("pool"), class_node()),
        _edges(crews.where(F.col("Market").isNotNull()), class_node(), crew_node()),
    ]
    return _union(parts)


def site_edges(jobs: DataFrame, sites: DataFrame, km: float) -> DataFrame:
    """Links the nodes whose sites may lock each other.

    All nodes of one grid cell are linked to the smallest of them, then occupied cells
    within reach to each other; no pairs of sites are formed. That may link a little
    more than needed, never less.
    """
    used = jobs.select("customer_id", "SiteCode", job_node().alias("node")).distinct()
    placed = used.join(sites, ["customer_id", "SiteCode"], "left")
    here = F.struct(
        F.when(F.col("Latitude").isNull(), F.col("SiteCode")).alias("s"),
        cell(F.col("Latitude"), F.col("Longitude"), km).alias("cell"),
    )
    rows = placed.select("customer_id", F.to_json(here).alias("here"), "node").distinct()
    heads = rows.groupBy("customer_id", "here").agg(F.min("node").alias("head"))
    within = _edges(rows.join(heads, ["customer_id", "here"]), F.col("node"), F.col("head"))

    known = placed.where(F.col("Latitude").isNotNull())
    reach = known.select(
        "customer_id",
        F.to_json(here).alias("here"),
        F.explode(reachable_cells(F.col("Latitude"), F.col("Longitude"), km)).alias("cell"),
    )
    reach = reach.select(
        "customer_id",
        "here",
        F.to_json(F.struct(F.lit(None).cast("string").alias("s"), "cell")).alias("there"),
    ).where("here <> there").distinct()
    there = heads.select("customer_id", F.col("here").alias("there"), F.col("head").alias("other"))
    across = reach.join(heads, ["customer_id", "here"]).join(there, ["customer_id", "there"])
    return _union([within, _edges(across, F.col("head"), F.col("other"))])


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _hang_on_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: neighbours of a node are re-linked to its smallest neighbour."""
    if larger_only:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        moved = around.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        smallest = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = (
            down.join(smallest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(smallest.select("a", F.col("m").alias("b")))
        )
    return moved.where("a <> b").distinct()


def _only_stars(edges: DataFrame) -> bool:
    """One smaller centre per node, and no centre below another one."""
    lower = edges.select(F.col("a").alias("n"), F.lit(1).alias("below"), (F.col("a") < F.col("b")).alias("wrong"))
    centres = edges.select(F.col("b").alias("n"), F.lit(0).alias("below"), F.lit(False).alias("wrong"))
    roles = lower.unionByName(centres).groupBy("n")
    roles = roles.agg(F.sum("below").alias("below"), F.count("*").alias("n_ends"), F.bool_or("wrong").alias("wrong"))
    return roles.where("wrong or below > 1 or (below = 1 and n_ends > 1)").isEmpty()


def label_nodes(edges: DataFrame) -> DataFrame:
    """``(node, label)``: every linked node with the smallest node of its component.

    Alternates the two star steps of Kiveris et al. (SoCC 2014), each round written to
    the shared folder, until the edges form stars: one smallest node per other node,
    and no centre that hangs on another one.
    """
    current = materialise(edges.distinct(), "edges")
    while not _only_stars(current):
        current = materialise(_hang_on_smallest(_hang_on_smallest(current, True), False), "edges")
    heads = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(heads)


def components(
    jobs: DataFrame, crews: DataFrame, sites: DataFrame | None, km: float | None
) -> tuple[DataFrame, DataFrame]:
    """Jobs and crews with their component in ``comp``; other crews are dropped."""
    edges = crew_edges(jobs, crews)
    if km is not None and sites is not None:
        edges = edges.unionByName(site_edges(jobs, sites, km))
    labels = label_nodes(edges)
    nodes = jobs.select(job_node().alias("node")).distinct()
    comps = materialise(
        nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("comp")), "components"
    )
    tagged = jobs.withColumn("node", job_node()).join(comps, "node").drop("node")
    by_label = labels.join(comps.select("comp").distinct(), F.col("label") == F.col("comp"), "left_semi")
    listed = crews.where(F.col("Market").isNotNull()).withColumn("node", class_node())
    owned = listed.join(by_label.withColumnRenamed("label", "comp"), "node").drop("node")
    return tagged, owned


def component_sizes(jobs: DataFrame, crews: DataFrame) -> DataFrame:
    """Jobs and crew rows per component that has jobs."""
    n_jobs = jobs.groupBy("comp").agg(F.count("*").alias("n_jobs"))
    n_crews = crews.groupBy("comp").agg(F.count("*").alias("n_crews"))
    return n_jobs.join(n_crews, "comp", "left").fillna(0, ["n_crews"])
