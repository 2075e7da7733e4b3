"""Star schema (ST-01 ... ST-14) and its integrity checks.

Surrogate keys: on its own, ``star`` numbers the tiny dimensions (units, roles,
features) with row_number over their name and keeps the natural id of users as
``user_key``; facts then only need a semi join to prove the user exists. With
key maps (``keyed_star``), units, roles and users take the persisted keys of
``operators.keys``, which stay the same between loads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.config import UNKNOWN_FEATURE
from uptake.functions import date_key
from uptake.operators.common import bounded_broadcast
from uptake.operators.keys import extend_key_map
from uptake.tables import Tables


def dim_business_unit(t: Tables) -> DataFrame:
    names = (
        t.users.select(F.col("business_unit").alias("business_unit_name"))
        .union(t.training.select(F.col("business_unit").alias("business_unit_name")))
        .where(F.col("business_unit_name").isNotNull())
        .distinct()
    )
    return names.select(
        F.row_number().over(Window.orderBy("business_unit_name")).cast("int").alias("business_unit_key"),
        "business_unit_name",
    )


def dim_role(t: Tables) -> DataFrame:
    roles = t.users.where(F.col("role").isNotNull()).select(F.col("role").alias("role_name"), "manager_level").distinct()
    return roles.select(
        F.row_number().over(Window.orderBy("role_name", "manager_level")).cast("int").alias("role_key"),
        "role_name", "manager_level",
    )


def dim_feature(t: Tables) -> DataFrame:
    known = t.features.select(
        F.row_number().over(Window.orderBy("feature_id")).cast("int").alias("feature_key"),
        "feature_id", "feature_name", "feature_category", "target_persona", "release_date", "core_feature_flag",
    )
    k, fid, name, cat, persona, rel, core = UNKNOWN_FEATURE
    unknown = t.features.agg(F.count(F.lit(1)).alias("_n")).select(  # exactly one literal row
        F.lit(k).cast("int").alias("feature_key"), F.lit(fid).alias("feature_id"), F.lit(name).alias("feature_name"),
        F.lit(cat).alias("feature_category"), F.lit(persona).alias("target_persona"),
        F.lit(rel).cast("date").alias("release_date"), F.lit(core).cast("boolean").alias("core_feature_flag"),
    )
    return unknown.unionByName(known)


def dim_date(t: Tables) -> DataFrame:
    return t.calendar.select(
        date_key("date").alias("date_key"), F.col("date").alias("full_date"), "week_start_date", "week_number",
        "month", "month_name", "quarter", "year",
    )


def dim_user(t: Tables) -> DataFrame:
    bu = dim_business_unit(t)  # small, but data-derived: AQE broadcasts it when the measured size allows
    role = dim_role(t).select("role_key", "role_name")
    u = t.users
    return (
        u.join(bu, u.business_unit == bu.business_unit_name, "left")
        .join(role, u.role == role.role_name, "left")
        .select(
            F.col("user_id").alias("user_key"), "user_id", "business_unit_key", "role_key", "region", "hire_date",
            "assigned_access_date", date_key("assigned_access_date").alias("assigned_access_date_key"),
            "rollout_wave", "training_assigned_date", "training_completed_date", "training_format",
            "manager_champion_flag", "eligible_for_access_flag",
        )
    )


def _feature_key(df: DataFrame, t: Tables) -> DataFrame:
    f = bounded_broadcast(dim_feature(t).where(F.col("feature_key") > 0).select("feature_key", F.col("feature_name").alias("_fn")),
                          t.features)
    return df.join(f, df.feature_name == f._fn, "left").withColumn(
        "feature_key", F.coalesce("feature_key", F.lit(-1)).cast("int")
    )


def fact_usage_events(t: Tables) -> DataFrame:
    """Events of known users (orphans dropped), unknown feature -> key -1."""
    ev = t.events.join(t.users.select("user_id"), "user_id", "left_semi")
    return _feature_key(ev, t).select(
        "event_id", F.col("user_id").alias("user_key"), date_key("event_timestamp").alias("date_key"), "feature_key",
        "event_timestamp", "event_type", "prompt_category", "output_exported_flag", "successful_completion_flag",
        "estimated_minutes_saved", "session_duration_seconds", "error_flag", "platform", "source_system", "session_id",
    )


def fact_feedback(t: Tables) -> DataFrame:
    fb = t.feedback.join(t.users.select("user_id"), "user_id", "left_semi")
    return _feature_key(fb, t).select(
        "feedback_id", F.col("user_id").alias("user_key"), date_key("feedback_timestamp").alias("date_key"),
        "feature_key", "feedback_timestamp", "rating_1_to_5", "sentiment_label", "barrier_category",
        "free_text_feedback", "would_recommend_flag",
    )


def fact_training(t: Tables) -> DataFrame:
    bu = dim_business_unit(t)
    tr = t.training
    return tr.join(bu, tr.business_unit == bu.business_unit_name, "left").select(
        "training_session_id", "business_unit_key", date_key("session_date").alias("date_key"), "training_format",
        "registered_count", "attended_count", "completion_count", "facilitator", "session_topic",
    )


def star(t: Tables) -> dict[str, DataFrame]:
    return {
        "dim_business_unit": dim_business_unit(t), "dim_role": dim_role(t), "dim_feature": dim_feature(t),
        "dim_date": dim_date(t), "dim_user": dim_user(t), "fact_usage_events": fact_usage_events(t),
        "fact_feedback": fact_feedback(t), "fact_training_attendance": fact_training(t),
    }


# natural keys of the dimensions whose surrogate keys persist: key map -> (natural key, surrogate key)
KEY_MAPS = {
    "key_business_unit": ("business_unit_name", "business_unit_key"),
    "key_role": ("role_name", "role_key"),
    "key_user": ("user_id", "user_key"),
}


def key_maps(t: Tables, known: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The key maps of a load: those of the load before (``known``) and its new members."""
    members = {
        "key_business_unit": t.users.select(F.col("business_unit").alias("business_unit_name")).union(
            t.training.select("business_unit")),
        "key_role": t.users.select(F.col("role").alias("role_name")),
        "key_user": t.users.select("user_id"),
    }
    return {name: extend_key_map(members[name], [natural], key, (known or {}).get(name))
            for name, (natural, key) in KEY_MAPS.items()}


def keyed_star(t: Tables, maps: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star schema with the persisted keys of ``maps`` (see ``key_maps``)."""
    unit, role, user = (maps[n] for n in KEY_MAPS)
    ids = user.select("user_id", "user_key")
    plain = star(t)
    unit_of = dim_business_unit(t).select(F.col("business_unit_key").alias("_k"), "business_unit_name").join(unit, "business_unit_name")

    def keyed(df: DataFrame) -> DataFrame:
        u = ids.select(F.col("user_id").alias("_id"), F.col("user_key").alias("_key"))
        return df.join(u, df["user_key"] == u["_id"]).withColumn("user_key", F.col("_key")).drop("_id", "_key")

    # a role that comes with two manager levels is one member; the least level stands for it
    roles = t.users.where(F.col("role").isNotNull()).groupBy(F.col("role").alias("role_name")).agg(F.min("manager_level").alias("manager_level"))
    u = t.users
    out = dict(plain)
    out["dim_business_unit"] = unit_of.select("business_unit_key", "business_unit_name")
    out["dim_role"] = roles.join(role, "role_name").select("role_key", "role_name", "manager_level")
    out["dim_user"] = (
        u.join(ids, "user_id").join(unit, u["business_unit"] == unit["business_unit_name"], "left")
        .join(role, u["role"] == role["role_name"], "left")
        .select(F.col("user_key"), "user_id", "business_unit_key", "role_key",
                *[c for c in plain["dim_user"].columns if c not in ("user_key", "user_id", "business_unit_key", "role_key")
                  and c != "assigned_access_date_key"],
                date_key("assigned_access_date").alias("assigned_access_date_key"))
        .select(plain["dim_user"].columns))
    out["fact_usage_events"] = keyed(plain["fact_usage_events"])
    out["fact_feedback"] = keyed(plain["fact_feedback"])
    training = t.training.join(unit, t.training["business_unit"] == unit["business_unit_name"], "left")
    out["fact_training_attendance"] = training.select(
        "training_session_id", "business_unit_key", date_key("session_date").alias("date_key"), "training_format",
        "registered_count", "attended_count", "completion_count", "facilitator", "session_topic")
    return out


PRIMARY_KEYS = {
    "dim_business_unit": "business_unit_key", "dim_role": "role_key", "dim_feature": "feature_key",
    "dim_date": "date_key", "dim_user": "user_key", "fact_usage_events": "event_id",
    "fact_feedback": "feedback_id", "fact_training_attendance": "training_session_id",
}
UNIQUE_KEYS = {"dim_business_unit": "business_unit_name", "dim_role": "role_name", "dim_feature": "feature_name",
               "dim_date": "full_date", "dim_user": "user_id"}
FOREIGN_KEYS = [  # (table, column, referenced table, referenced column)
    ("dim_user", "business_unit_key", "dim_business_unit", "business_unit_key"),
    ("dim_user", "role_key", "dim_role", "role_key"),
    ("dim_user", "assigned_access_date_key", "dim_date", "date_key"),
    ("fact_usage_events", "user_key", "dim_user", "user_key"),
    ("fact_usage_events", "date_key", "dim_date", "date_key"),
    ("fact_usage_events", "feature_key", "dim_feature", "feature_key"),
    ("fact_feedback", "user_key", "dim_user", "user_key"),
    ("fact_feedback", "date_key", "dim_date", "date_key"),
    ("fact_feedback", "feature_key", "dim_feature", "feature_key"),
    ("fact_training_attendance", "business_unit_key", "dim_business_unit", "business_unit_key"),
    ("fact_training_attendance", "date_key", "dim_date", "date_key"),
]
NOT_NULL = [
    ("dim_business_unit", "business_unit_name"), ("dim_role", "role_name"), ("dim_feature", "feature_name"),
    ("dim_date", "full_date"), ("dim_user", "user_id"), ("fact_usage_events", "user_key"),
    ("fact_usage_events", "date_key"), ("fact_usage_events", "feature_key"), ("fact_usage_events", "event_timestamp"),
    ("fact_feedback", "user_key"), ("fact_feedback", "date_key"), ("fact_feedback", "feature_key"),
    ("fact_feedback", "feedback_timestamp"), ("fact_training_attendance", "date_key"),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pk_violations(tabs: dict[str, DataFrame]) -> DataFrame:
    """Per key rule: keys seen more than once and the rows carrying them."""
    rules = [(tb, c, "primary key") for tb, c in PRIMARY_KEYS.items()] + [(tb, c, "unique") for tb, c in UNIQUE_KEYS.items()]
    parts = []
    for tb, c, kind in rules:
        d = tabs[tb].groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(d.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"))
                     .select(F.lit(tb).alias("table_name"), F.lit(c).alias("key_column"), F.lit(kind).alias("rule"),
                             "duplicate_keys", "duplicate_rows"))
    return _union(parts)


def _by_table(rules: list[tuple]) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for rule in rules:
        out.setdefault(rule[0], []).append(rule)
    return out


def fk_violations(tabs: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: non-null values with no parent row.

    All foreign keys of a table are checked in one pass over it: one expansion gives a row per key and value, counted
    map-side, and the few different values left are looked up among the keys of all parents at once.
    """
    parents = _union([tabs[ref].select(F.lit(f"{ref}.{rc}").alias("references"), F.col(rc).cast("string").alias("k")).distinct()
                      for ref, rc in sorted({(ref, rc) for _, _, ref, rc in FOREIGN_KEYS})])
    parts = []
    for tb, rules in _by_table(FOREIGN_KEYS).items():
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(f"{ref}.{rc}").alias("references"), F.col(c).cast("string").alias("k"))
            for _, c, ref, rc in rules])).alias("p")
        values = tabs[tb].select(pairs).select("p.*").groupBy("column_name", "references", "k").agg(F.count(F.lit(1)).alias("n"))
        found = values.join(parents.withColumn("known", F.lit(True)), ["references", "k"], "left")
        bad = F.col("k").isNotNull() & F.col("known").isNull()
        counts = found.groupBy("column_name", "references").agg(F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n"))
        # an empty table has no values, but its rules hold
        zero = tabs[tb].sparkSession.createDataFrame([(c, f"{ref}.{rc}") for _, c, ref, rc in rules], "column_name string, references string")
        parts.append(zero.join(counts, ["column_name", "references"], "left").select(
            F.lit(tb).alias("table_name"), "column_name", "references", F.coalesce("n", F.lit(0)).cast("long").alias("violations")))
    return _union(parts)


def null_violations(tabs: dict[str, DataFrame]) -> DataFrame:
    """Null rows per column that must not be null: one aggregate a table carries all its rules."""
    parts = []
    for tb, rules in _by_table(NOT_NULL).items():
        counts = tabs[tb].agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, (_, c) in enumerate(rules)])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(tb).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"))
            for i, (_, c) in enumerate(rules)]))))
    return _union(parts)


def violations(tabs: dict[str, DataFrame]) -> list[str]:
    """All rules that a star schema breaks, in words (a few dozen rules)."""
    out = [f"{r['table_name']}.{r['key_column']}: {r['duplicate_keys']} keys repeat ({r['rule']})"
           for r in pk_violations(tabs).where("duplicate_keys > 0").collect()]
    out += [f"{r['table_name']}.{r['column_name']}: {r['violations']} rows without {r['references']}"
            for r in fk_violations(tabs).where("violations > 0").collect()]
    return out + [f"{r['table_name']}.{r['column_name']}: {r['null_rows']} nulls"
                  for r in null_violations(tabs).where("null_rows > 0").collect()]


def table_row_counts(tabs: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                   for n, df in tabs.items()])


def calendar_from_start(bounds: DataFrame) -> DataFrame:
    """ST-14 over a one-row frame (start: date, weeks: int)."""
    days = bounds.select("start", "weeks", F.explode(
        F.sequence("start", F.date_add("start", F.col("weeks") * 7 - 1))).alias("date"))
    ws = F.date_trunc("week", "date").cast("date")
    n = F.floor(F.datediff(ws, F.date_trunc("week", "start").cast("date")) / 7) + 1
    return days.select(
        "date", ws.alias("week_start_date"),
        F.least(F.greatest(n, F.lit(1)), F.col("weeks")).cast("int").alias("week_number"),
        F.month("date").alias("month"), F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"), F.year("date").alias("year"),
    )
