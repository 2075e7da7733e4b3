"""Bind the shipped TPC-H-style test tables to the canonical adoption tables.

The mapping (FIXTURES.md §3) is expressed once here as DataFrame plans and
once as SQL text in :mod:`uptake.plans.bind_sql` for the DuckDB oracle. Every
derived table is a projection / join of the given parquet tables, so its size
grows with theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.config import CANONICAL_FEATURES, FEATURE_CATALOG, TESTDATA_CONFIG, AdoptionConfig
from uptake.operators.common import user_day_rows, user_feature_rows
from uptake.tables import Tables

# Fixed values of the binding.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ROLES = ("Analyst", "Associate", "Manager", "Developer")  # by user_id % 4
TRAINING_FORMATS = ("Live Virtual", "Self-Paced eLearning", "In-Person Workshop")  # by id % 3
SESSION_TOPICS = ("Prompt Writing Basics", "Responsible AI & Approved Use Cases",
                  "Advanced Data Analysis Features", "Knowledge Search Deep Dive")  # by id % 4
PLATFORMS = ("Web", "Desktop", "Mobile")  # by event_id % 3
SOURCE_SYSTEMS = ("web_app", "desktop_client", "mobile_app")  # by event_id % 3, as the platform
PROMPT_CATEGORIES = ("General Q&A", "Summaries", "Drafting", "Data Questions")  # by event_id % 4, none for event_id % 11 = 3
EVENT_TYPE_MAP = {"view": "prompt_submitted", "click": "output_generated",
                  "signup": "app_opened", "error": "error_encountered"}
BARRIER_BY_PRIORITY = {
    "1-URGENT": "No time to learn",
    "2-HIGH": "Low output quality",
    "3-MEDIUM": "Lack of relevant training",
    "4-NOT SPECIFIED": "No barrier reported",
    "5-LOW": "Tool performance issue",
}
# users with user_id % 4 = 0 stop using the product after this instant
USAGE_CUTOFF = "2024-01-22 00:00:00"
BACKGROUND_EVENT_TYPE = "app_opened"  # raw events outside the usage pattern


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values, idx: Column) -> Column:
    """values[idx] for a 0-based integer column (null when out of range)."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def _day(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int"))


def bind_users(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    k = F.col("c_custkey")
    role = _pick(ROLES, k % 4)
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left").select(
        k.alias("user_id"),
        F.col("c_mktsegment").alias("business_unit"),
        role.alias("role"),
        F.col("r_name").alias("region"),
        F.when(k % 4 == 2, F.lit("People Manager")).otherwise(F.lit("Individual Contributor")).alias("manager_level"),
        _day("2018-01-01", k % 2000).alias("hire_date"),
        F.when(k % 41 != 7, _day("2024-01-01", k % 21)).alias("assigned_access_date"),
        (k % 6 + 1).cast("int").alias("rollout_wave"),
        F.when(k % 23 != 5, _day("2023-12-28", k % 21)).alias("training_assigned_date"),
        F.when((k % 3 != 0) & (k % 23 != 5), _day("2023-12-31", k % 21 + k % 19)).alias("training_completed_date"),
        _pick(TRAINING_FORMATS, k % 3).alias("training_format"),
        F.when(k % 97 != 3, k % 5 == 0).alias("manager_champion_flag"),
        (k % 19 != 4).alias("eligible_for_access_flag"),
    )


def map_events(events: DataFrame) -> DataFrame:
    """Map the raw stream to usage events.

    Every raw event is kept. Raw activity is dense (every user on every day),
    so only a fixed pattern of user-days carries usage actions; the other
    events become background ``app_opened`` rows with no feature, no export
    and no estimate. Activation, dormancy and retention stay informative and
    every query still processes the whole events table.
    """
    uid, eid, ts, et = F.col("user_id"), F.col("event_id"), F.col("ts"), F.col("event_type")
    usage = ((uid * 7 + F.dayofmonth(ts) * 11) % 10 < uid % 3 + 3) & (
        (uid % 4 != 0) | (ts < F.lit(USAGE_CUTOFF).cast("timestamp_ntz"))
    )
    j = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    mapped = F.when(usage, F.coalesce(
        F.try_element_at(F.create_map(*[x for kv in EVENT_TYPE_MAP.items() for x in map(F.lit, kv)]), et),
        F.when(et == "purchase", F.when(eid % 4 == 0, F.lit("output_exported")).otherwise(F.lit("feature_completed"))),
        et,
    )).otherwise(F.lit(BACKGROUND_EVENT_TYPE))
    ok = (et != "error") & (eid % 14 != 0)
    return events.select(
        eid.alias("event_id"),
        uid.alias("user_id"),
        ts.alias("event_timestamp"),
        F.concat_ws("-", F.lit("S"), uid.cast("string"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.when(usage & (j % 9 < 8), _pick(CANONICAL_FEATURES, j % 9)).alias("feature_name"),
        mapped.alias("event_type"),
        F.when(eid % 11 != 3, _pick(PROMPT_CATEGORIES, eid % 4)).alias("prompt_category"),
        (mapped == "output_exported").alias("output_exported_flag"),
        ok.alias("successful_completion_flag"),
        F.when(usage & et.isin("click", "purchase") & (eid % 14 != 0), F.col("value").cast("decimal(18,2)"))
        .alias("estimated_minutes_saved"),
        (eid % 600 + 5).cast("int").alias("session_duration_seconds"),
        (usage & (et == "error")).alias("error_flag"),
        _pick(PLATFORMS, eid % 3).alias("platform"),
        _pick(SOURCE_SYSTEMS, eid % 3).alias("source_system"),
    )


def after_access(rows: DataFrame, users: DataFrame, day: Column) -> DataFrame:
    """Rows of a user's days before their access date dropped (the cleaning rule)."""
    access = users.select("user_id", "assigned_access_date")
    cols = rows.columns
    return rows.join(access, "user_id", "left").where(
        F.col("assigned_access_date").isNull() | (day >= F.col("assigned_access_date"))).select(cols)


def bind_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Usage events of the raw stream, without those before access."""
    return after_access(map_events(events), users, F.to_date("event_timestamp"))


def bind_feedback(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rating = F.when(k % 97 != 0, (k % 5 + 1).cast("int"))
    fdate = _day("2024-01-01", k % 30)
    return orders.select(
        k.alias("feedback_id"),
        F.col("o_custkey").alias("user_id"),
        (fdate.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"))).alias("feedback_timestamp"),
        rating.alias("rating_1_to_5"),
        F.when(rating >= 4, F.lit("Positive")).when(rating <= 2, F.lit("Negative")).otherwise(F.lit("Neutral"))
        .alias("sentiment_label"),
        F.try_element_at(
            F.create_map(*[x for kv in BARRIER_BY_PRIORITY.items() for x in map(F.lit, kv)]), F.col("o_orderpriority")
        ).alias("barrier_category"),
        F.when(k % 13 != 0, F.concat(F.lit("Order feedback, status "), F.col("o_orderstatus"))).alias("free_text_feedback"),
        F.when(k % 10 < 8, _pick(CANONICAL_FEATURES, k % 10)).alias("feature_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).when(F.col("o_orderstatus") == "O", F.lit(False))
        .alias("would_recommend_flag"),
    )


def bind_calendar(events: DataFrame) -> DataFrame:
    """Monday-start calendar covering every week that has an event."""
    b = events.agg(
        F.date_trunc("week", F.min("ts")).cast("date").alias("s"),
        F.date_add(F.date_trunc("week", F.max("ts")).cast("date"), 6).alias("e"),
    )
    return calendar_from_bounds(b)


def calendar_from_bounds(bounds: DataFrame) -> DataFrame:
    """Days between columns s and e (one-row frame) with week attributes."""
    days = bounds.select("s", F.explode(F.sequence("s", "e")).alias("date"))
    d = F.datediff("date", "s")
    return days.select(
        "date",
        F.date_add("s", (d - d % 7).cast("int")).alias("week_start_date"),
        (F.floor(d / 7) + 1).cast("int").alias("week_number"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
    )


FEATURE_SCHEMA = T.StructType([
    T.StructField("feature_id", T.StringType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("feature_category", T.StringType()),
    T.StructField("target_persona", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("core_feature_flag", T.BooleanType()),
])


def feature_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEATURE_CATALOG), FEATURE_SCHEMA).withColumn(
        "release_date", F.col("release_date").cast("date")
    )


def bind_raw_features(part: DataFrame) -> DataFrame:
    """A raw, all-string feature catalog of the parts: one row for each last digit of a part number.

    Digits 0 to 7 are the canonical features, 8 has no name and 9 is one more feature, named after a brand; category,
    persona, release date and flag come from the parts, with the odd spellings that the cleaning has to mend."""
    k = (F.col("p_partkey") % 10).cast("int")
    rows = part.groupBy(k.alias("k")).agg(
        F.min("p_brand").alias("brand"), F.max("p_type").alias("kind"), F.max("p_size").alias("size"), F.min("p_type").alias("persona"))
    k = F.col("k")
    return rows.select(
        F.concat(F.lit(" P"), F.lpad(k.cast("string"), 2, "0")).alias("Feature ID"),
        F.when(k == 9, F.col("brand")).when(k < 8, F.concat(F.lit(" "), _pick(CANONICAL_FEATURES, k), F.lit("\t"))).alias("feature_name"),
        F.col("kind").alias("feature_category"), F.col("persona").alias("target_persona"),
        F.when(k == 5, F.lit("2024-1-5")).otherwise(F.date_format(_day("2024-01-01", F.col("size")), "yyyy-MM-dd")).alias("release_date"),
        F.when(k % 3 == 0, F.lit(" YES")).when(k % 3 == 1, F.lit("0")).otherwise(F.lit("maybe")).alias("core_feature_flag"))


def bind_training(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    reg = (s % 100 + 20).cast("int")
    bad = s % 50 == 9
    att = F.when(bad, reg + 2).otherwise(F.floor(reg * 3 / 4)).cast("int")
    return supplier.select(
        s.alias("training_session_id"),
        _day("2024-01-01", s % 30).alias("session_date"),
        _pick(SEGMENTS, s % 5).alias("business_unit"),
        _pick(TRAINING_FORMATS, s % 3).alias("training_format"),
        reg.alias("registered_count"),
        att.alias("attended_count"),
        F.when(bad, att + 1).otherwise(F.floor(att * 4 / 5)).cast("int").alias("completion_count"),
        F.col("s_name").alias("facilitator"),
        _pick(SESSION_TOPICS, s % 4).alias("session_topic"),
    )


def bind_testdata(spark: SparkSession, sf_dir: str, cfg: AdoptionConfig = TESTDATA_CONFIG) -> Tables:
    """The canonical tables. The summaries that metrics share are aggregated from the raw stream before anything is
    joined to it: a user's days before access are dropped as days, so no raw event is shuffled to its user."""
    users = bind_users(read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation"), read(spark, sf_dir, "region"))
    raw_events = read(spark, sf_dir, "events")
    mapped, day = map_events(raw_events), F.col("date")
    t = Tables(
        users=users,
        events=after_access(mapped, users, F.to_date("event_timestamp")),
        feedback=bind_feedback(read(spark, sf_dir, "orders")),
        calendar=bind_calendar(raw_events),
        features=feature_catalog(spark),
        training=bind_training(read(spark, sf_dir, "supplier")),
    )
    known = users.select("user_id", "assigned_access_date")

    def of_known_users(rows: DataFrame) -> DataFrame:
        return rows.join(known, "user_id").where(
            F.col("assigned_access_date").isNull() | (day >= F.col("assigned_access_date"))).drop("assigned_access_date")

    return t.replace(user_day=of_known_users(user_day_rows(mapped, cfg)), user_feature=of_known_users(user_feature_rows(mapped, cfg)))
