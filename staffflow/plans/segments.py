"""Queries of the clustering family."""

from pyspark.sql import functions as F

from staffflow.operators import clustering as ops
from staffflow.operators.distributions import rounded
from staffflow.operators.preparation import standardise
from staffflow.plans.registry import query
from staffflow.schema import CLUSTER_FEATURES, STATUSES
from staffflow.sources.tables import on_panel, panel

KEY = ["employee_id", "year", "month"]
SCALED = [f"z_{c}" for c in CLUSTER_FEATURES]

SEGMENT_SQL = [
    "scaled AS (SELECT *, " + ", ".join(
        f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z_{c}" for c in CLUSTER_FEATURES
    ) + " FROM panel)",
    "centre AS (SELECT " + ", ".join(
        f"avg({z}) FILTER (status = '{g}') AS {g}_{z}" for g in STATUSES for z in SCALED
    ) + " FROM scaled)",
    "gaps AS (SELECT scaled.*, " + ", ".join(
        "(" + " + ".join(f"({z} - {g}_{z}) * ({z} - {g}_{z})" for z in SCALED) + f") AS gap_{g}" for g in STATUSES
    ) + " FROM scaled, centre)",
    """assigned AS (SELECT *, least(gap_Active, gap_Left, gap_Retired) AS gap,
      CASE WHEN gap_Active <= gap_Left AND gap_Active <= gap_Retired THEN 'Active'
           WHEN gap_Left <= gap_Retired THEN 'Left' ELSE 'Retired' END AS cluster FROM gaps)""",
]


def assigned(spark, sf_dir):
    """Every row at the nearest of three given centres: the mean of each status."""
    scaled = standardise(panel(spark, sf_dir, [*KEY, *CLUSTER_FEATURES, "status"]), CLUSTER_FEATURES)
    centres = ops.group_centres(scaled, SCALED, "status", STATUSES)
    return ops.assign_to_centroids(scaled, SCALED, centres)


def segments(spark, sf_dir):
    return ops.kmeans_segments(panel(spark, sf_dir, [*KEY, *CLUSTER_FEATURES]), CLUSTER_FEATURES)


@query(
    "kmeans_segments",
    on_panel("SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest FROM panel"),
)
def kmeans_segments(spark, sf_dir):
    """Rows and clusters found, and how many rows are not with their nearest centre."""
    out, centres = segments(spark, sf_dir)
    scaled = [f"z_{c}" for c in CLUSTER_FEATURES]
    gaps = [sum((F.col(c) - m) * (F.col(c) - m) for c, m in zip(scaled, centre)) for centre in centres]
    own = F.element_at(F.array(*gaps), F.col("cluster").cast("int") + 1)
    far = F.count(F.when(own > F.least(*gaps) + 1e-9, 1))
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster").alias("n_clusters"), far.alias("n_not_nearest"))


@query("assign_to_centroids", on_panel("SELECT employee_id, year, month, cluster, round(gap, 6) AS gap FROM assigned", *SEGMENT_SQL))
def assign_to_centroids(spark, sf_dir):
    return rounded(assigned(spark, sf_dir).select(*KEY, "cluster", "gap"), 6, ["gap"])


@query(
    "cluster_profile",
    on_panel("SELECT cluster, count(*) AS n_rows, "
             + ", ".join(f"round(avg({c}), 4) AS mean_{c}" for c in CLUSTER_FEATURES)
             + " FROM assigned GROUP BY cluster", *SEGMENT_SQL),
)
def cluster_profile(spark, sf_dir):
    out = ops.cluster_profile(assigned(spark, sf_dir), CLUSTER_FEATURES)
    return rounded(out, 4, [f"mean_{c}" for c in CLUSTER_FEATURES])


NORM = " + ".join(f"{z} * {z}" for z in SCALED)
SILHOUETTE_SQL = [
    "sums AS (SELECT cluster AS other, count(*) AS n, sum(" + NORM + ") AS q, "
    + ", ".join(f"sum({z}) AS s_{z}" for z in SCALED) + " FROM assigned GROUP BY cluster)",
    "means AS (SELECT employee_id, year, month, cluster, other, n, n * (" + NORM + ") + q - 2 * ("
    + " + ".join(f"{z} * s_{z}" for z in SCALED) + ") AS total FROM assigned, sums)",
    """ab AS (SELECT employee_id, year, month, cluster,
      max(total / nullif(n - 1, 0)) FILTER (cluster = other) AS a, min(total / n) FILTER (cluster <> other) AS b
      FROM means GROUP BY ALL)""",
]


@query(
    "silhouette_rows",
    on_panel("""SELECT employee_id, year, month, cluster, round(CASE WHEN a IS NULL OR b IS NULL THEN 0
      ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab""", *SEGMENT_SQL, *SILHOUETTE_SQL),
)
def silhouette_rows(spark, sf_dir):
    out = ops.silhouette_rows(assigned(spark, sf_dir), SCALED, STATUSES)
    return rounded(out.select(*KEY, "cluster", "silhouette"), 6, ["silhouette"])


