"""The bundle of canonical tables every operator reads."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class Tables:
    """Clean canonical tables (see FIXTURES.md §1 for the column lists).

    users      one row per user_id
    events     one row per usage event (event_timestamp: TIMESTAMP_NTZ)
    feedback   one row per feedback submission
    calendar   one row per date, Monday-start weeks numbered from 1
    features   feature catalog (feature_id, feature_name, ..., core_feature_flag)
    training   one row per scheduled training session (aggregate counts)
    """

    users: DataFrame
    events: DataFrame
    feedback: DataFrame
    calendar: DataFrame
    features: DataFrame
    training: DataFrame
    # optional precomputed per-(user, day) event summary (see
    # operators.common.precompute); must be built with the same config
    user_day: DataFrame | None = None
    user_day_stored: bool = False
    # optional per-(user, date, feature) summary, see common.user_feature_rows
    user_feature: DataFrame | None = None

    def where(
        self,
        users: Column | str | None = None,
        events: Column | str | None = None,
        feedback: Column | str | None = None,
    ) -> "Tables":
        """Filter context (report slicers): restrict users and their facts.

        A user filter also restricts events and feedback to the kept users
        (semi join), so every metric computed on the result sees one
        consistent population.
        """
        t = self
        if users is not None:
            kept = t.users.where(users)
            ids = kept.select("user_id")
            t = replace(
                t,
                users=kept,
                events=t.events.join(ids, "user_id", "left_semi"),
                feedback=t.feedback.join(ids, "user_id", "left_semi"),
                user_day=None, user_day_stored=False, user_feature=None,
            )
        if events is not None:
            t = replace(t, events=t.events.where(events), user_day=None, user_day_stored=False, user_feature=None)
        if feedback is not None:
            t = replace(t, feedback=t.feedback.where(feedback))
        return t

    def replace(self, **kw) -> "Tables":
        return replace(self, **kw)
