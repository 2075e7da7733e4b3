"""Feature adoption (M-16 ... M-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import pct1
from uptake.operators.common import Segment, bounded_broadcast, day_weeks, not_null, pivot_values, seg_list, user_feature_activity
from uptake.operators.population import eligible_users
from uptake.tables import Tables


def adopter_pairs(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct (user_id, feature_name) with an adoption event on a known feature."""
    return user_feature_activity(t, cfg).where("n_adoptions > 0").select("user_id", "feature_name").distinct()


def feature_list(t: Tables, core_only: bool = False):
    """The catalog's feature names as a scalar array (dimension-sized)."""
    f = t.features.where(F.col("core_feature_flag")) if core_only else t.features
    return f.agg(F.array_sort(F.collect_set("feature_name")).alias("f")).scalar()


def feature_adoption(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """Per (segment x catalog feature): eligible users, eligible adopters, rate.

    Zero rows are kept. Adopters are counted per (segment, feature) before
    meeting the grid; the grid itself is segments x catalog features, built by
    exploding the catalog's (bounded) feature array on each segment row.
    """
    cols = seg_list(segment)
    el = eligible_users(t).select("user_id", *cols).where(not_null(cols))
    denom = el.groupBy(*cols).agg(F.count(F.lit(1)).alias("eligible_users"))
    adopted = (
        adopter_pairs(t, cfg).join(el, "user_id")
        .groupBy(*cols, "feature_name").agg(F.count(F.lit(1)).alias("adopted_users"))
    )
    grid = denom.select(*cols, "eligible_users", F.explode(feature_list(t)).alias("feature_name"))
    return (
        grid.join(adopted, [*cols, "feature_name"], "left")
        .withColumn("adopted_users", F.coalesce("adopted_users", F.lit(0)).cast("long"))
        .withColumn("feature_adoption_rate_pct", pct1("adopted_users", "eligible_users"))
        .select(*cols, "feature_name", "eligible_users", "adopted_users", "feature_adoption_rate_pct")
    )


def core_feature_adoption(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """% of eligible users who adopted at least one core feature."""
    cols = seg_list(segment)
    el = eligible_users(t).select("user_id", *cols).where(not_null(cols))
    core = t.features.where(F.col("core_feature_flag")).select("feature_name")
    adopters = adopter_pairs(t, cfg).join(bounded_broadcast(core, t.features), "feature_name", "left_semi").select("user_id").distinct()
    flagged = el.join(adopters.withColumn("adopted", F.lit(True)), "user_id", "left")
    return flagged.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("eligible_users"), F.count_if(F.col("adopted").isNotNull()).alias("core_adopters")
    ).withColumn("core_feature_adoption_rate_pct", pct1("core_adopters", "eligible_users"))


def role_feature_matrix(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, row: str = "role") -> DataFrame:
    """Adoption rate (%) with one row per ``row`` value and one column per feature (the listed, then all others of the catalog)."""
    long = feature_adoption(t, cfg, [row])
    names = pivot_values(t.features, "feature_name", list(cfg.feature_names))
    return long.groupBy(row).pivot("feature_name", names).agg(
        F.first("feature_adoption_rate_pct")
    )


def feature_usage_trend(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct adopting users per week x feature (adoption events, known feature)."""
    return (
        user_feature_activity(t, cfg).where("n_adoptions > 0").join(day_weeks(t), "date")
        .groupBy("week_number", "feature_name")
        .agg(F.count_distinct("user_id").alias("adopting_users"))
    )
