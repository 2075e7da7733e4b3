"""Training completion and its association with activation (M-29 ... M-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import pct1
from uptake.operators.common import Segment, not_null, seg_list
from uptake.operators.population import activation_users
from uptake.tables import Tables


def training_completion(t: Tables, segment: Segment = None) -> DataFrame:
    """Completed / assigned; a completion without an assignment is not counted."""
    cols = seg_list(segment)
    assigned = t.users.where(F.col("training_assigned_date").isNotNull() & not_null(cols))
    return assigned.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("users_assigned"),
        F.count_if(F.col("training_completed_date").isNotNull()).alias("users_completed"),
    ).withColumn("training_completion_rate_pct", pct1("users_completed", "users_assigned"))


def training_vs_activation(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Activation rate split by training status (an association only)."""
    status = F.when(F.col("completed_training"), F.lit("Completed Training")).otherwise(F.lit("Did Not Complete Training"))
    return (
        activation_users(t, cfg).groupBy(status.alias("training_status"))
        .agg(F.count(F.lit(1)).alias("eligible_users"), F.count_if("activated").alias("activated_users"))
        .withColumn("activation_rate_pct", pct1("activated_users", "eligible_users"))
    )


def training_attendance(t: Tables, segment: Segment = "business_unit") -> DataFrame:
    """Session funnel per segment: registered -> attended -> completed."""
    cols = seg_list(segment)
    return (
        t.training.where(not_null(cols)).groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("sessions"),
             F.sum("registered_count").cast("long").alias("registered"),
             F.sum("attended_count").cast("long").alias("attended"),
             F.sum("completion_count").cast("long").alias("completed"))
        .withColumn("attendance_rate_pct", pct1("attended", "registered"))
        .withColumn("completion_rate_pct", pct1("completed", "attended"))
    )
