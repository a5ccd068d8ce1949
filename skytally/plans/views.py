"""Views derived from the read queries: what a dashboard would show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values.
MIN_CONCENTRATION = 0.55
MIN_TRACK_SAMPLES = 3
DENSITY_STEPS = 6
DENSITY_EXPONENT = 0.55
LARGEST_CELL = 1.0
FRESH_SECONDS = 360
STALE_SECONDS = 3600
HEADLINE_HOURS = 24
RECENT_HOURS = 12


def flow_arrows(grid: DataFrame) -> DataFrame:
    """Cells whose headings agree well enough, and are many enough, to mean a direction."""
    agreement = F.coalesce("track_concentration", F.lit(0.0))
    return grid.where((agreement >= MIN_CONCENTRATION) & (F.col("track_sample_count") >= MIN_TRACK_SAMPLES))


def density_bins(grid: DataFrame) -> DataFrame:
    """Shade of every cell, relative to the busiest one."""
    busiest = grid.agg(F.max("observation_count")).scalar()
    share = F.pow(F.col("observation_count") / busiest, F.lit(DENSITY_EXPONENT))
    step = F.floor(share * DENSITY_STEPS)
    return grid.withColumn("density_bin", F.least(F.lit(DENSITY_STEPS - 1), step).cast("int"))


def cell_size(grid: DataFrame) -> DataFrame:
    """Smallest gap between neighbouring latitudes, at most 1; 1 when there is no gap.

    Only gaps up to 1 matter, so neighbours share a whole degree or sit in adjoining
    ones: gaps are taken within each degree, and between the top of one and the
    bottom of the next. No task has to sort all latitudes.
    """
    rows = grid.select("grid_lat").distinct().withColumn("_degree", F.floor("grid_lat"))
    within = rows.withColumn(
        "_gap", F.col("grid_lat") - F.lag("grid_lat").over(Window.partitionBy("_degree").orderBy("grid_lat"))
    )
    ends = within.groupBy("_degree").agg(
        F.min("_gap").alias("_inner"), F.min("grid_lat").alias("_low"), F.max("grid_lat").alias("_high")
    )
    above = ends.select((F.col("_degree") - 1).alias("_degree"), F.col("_low").alias("_next"))
    gaps = ends.join(above, "_degree", "left").select(
        F.least("_inner", F.col("_next") - F.col("_high")).alias("_gap")
    )
    return gaps.agg(
        F.least(F.lit(LARGEST_CELL), F.coalesce(F.min("_gap"), F.lit(LARGEST_CELL))).alias("cell_degrees")
    )


def altitude_share(profile: DataFrame) -> DataFrame:
    """Each band's part of all observations, in percent."""
    total = profile.agg(F.sum("observation_count")).scalar()
    share = F.round(F.lit(100.0) * F.col("observation_count") / F.nullif(total, F.lit(0)), 1)
    return profile.withColumn("share_pct", F.coalesce(share, F.lit(0.0)))


def headline(totals: DataFrame, health: DataFrame) -> DataFrame:
    """Observations of the last 24 listed hours; runs, failures and credits of the health window."""
    latest = totals.orderBy(F.desc("activity_hour")).limit(HEADLINE_HOURS)
    observations = latest.agg(F.coalesce(F.sum("observation_count"), F.lit(0))).scalar()
    return health.agg(
        *[
            F.coalesce(F.sum(source), F.lit(0)).alias(name)
            for source, name in (
                ("run_count", "run_count"),
                ("failed_count", "failed_count"),
                ("credits_consumed", "credits_consumed"),
            )
        ]
    ).select(observations.alias("observations_24h"), "run_count", "failed_count", "credits_consumed")


def freshness_class(age_seconds: Column) -> Column:
    return (
        F.when(age_seconds < FRESH_SECONDS, "ok")
        .when(age_seconds < STALE_SECONDS, "warn")
        .when(age_seconds.isNotNull(), "bad")
    )


def classified_freshness(freshness: DataFrame) -> DataFrame:
    return freshness.withColumn("freshness_class", freshness_class(F.col("age_seconds")))


def recent_health(health: DataFrame) -> DataFrame:
    """The newest hours first, marked where a run failed."""
    return (
        health.orderBy(F.desc("health_hour"))
        .limit(RECENT_HOURS)
        .withColumn("failure_class", F.when(F.col("failed_count") > 0, "bad").otherwise("ok"))
    )
