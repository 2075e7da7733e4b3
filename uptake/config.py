"""Metric definitions as one frozen, overridable configuration object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source definitions for results to match;
# they are domain vocabularies, not tuning knobs.
# ---------------------------------------------------------------------------
MEANINGFUL_EVENT_TYPES = ("prompt_submitted", "output_generated", "feature_completed", "output_exported")
VALUE_EVENT_TYPES = ("feature_completed", "output_exported", "output_generated")
ADOPTION_EVENT_TYPES = ("feature_completed", "output_exported")
ALL_EVENT_TYPES = (
    "access_granted", "app_opened", "prompt_submitted", "output_generated", "output_exported",
    "feature_completed", "help_opened", "error_encountered", "feedback_submitted",
)
NO_BARRIER = "No barrier reported"
BARRIER_CATEGORIES = (
    "No time to learn", "Unsure what use cases are allowed", "Low output quality",
    "Hard to find the right feature", "Privacy or compliance concern", "Lack of relevant training",
    "Tool performance issue", "No barrier reported",
)
QUALIFYING_FEATURE = "Prompt Library"

CANONICAL_FEATURES = (
    "Chat and Research", "Knowledge Search", "Document Summarization", "Meeting Notes",
    "Prompt Library", "Drafting Assistant", "Data Analysis", "Code Assistant",
)
FEATURE_LABEL_MAP = {
    "chat and research": "Chat and Research",
    "chat & research": "Chat and Research",
    "doc summarization": "Document Summarization",
    "document summarization": "Document Summarization",
    "knowledge search": "Knowledge Search",
}
# feature catalog rows: feature_id, feature_name, feature_category, target_persona, release_date, core_feature_flag
FEATURE_CATALOG = (
    ("F01", "Chat and Research", "Research & Knowledge", "All Employees", "2026-01-05", True),
    ("F02", "Knowledge Search", "Research & Knowledge", "All Employees", "2026-01-05", True),
    ("F03", "Document Summarization", "Productivity", "All Employees", "2026-01-05", True),
    ("F04", "Meeting Notes", "Productivity", "All Employees", "2026-01-05", True),
    ("F05", "Prompt Library", "Enablement", "All Employees", "2026-01-05", True),
    ("F06", "Drafting Assistant", "Productivity", "Client-Facing Roles & Managers", "2026-01-19", True),
    ("F07", "Data Analysis", "Technical / Analytical", "Technical Roles (Analysts, Developers)", "2026-02-02", False),
    ("F08", "Code Assistant", "Technical / Analytical", "Technical Roles (Developers)", "2026-02-16", False),
)
UNKNOWN_FEATURE = (-1, "F00", "Unknown / Not Captured", "Unknown", "Unknown", None, None)

CANONICAL_BUSINESS_UNITS = (
    "Retail Banking", "Commercial Banking", "Capital Markets", "Wealth Management",
    "Operations", "Technology", "Risk and Compliance", "Corporate Functions",
)
BUSINESS_UNIT_LABEL_MAP = {
    "retail banking": "Retail Banking",
    "retail  banking": "Retail Banking",
    "risk & compliance": "Risk and Compliance",
    "risk and compliance": "Risk and Compliance",
    "tech": "Technology",
    "technology": "Technology",
}
TRUE_TOKENS = ("true", "1", "yes")
FALSE_TOKENS = ("false", "0", "no")
# tokens pandas.read_csv turns into NaN by default (besides the empty string)
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_SAVED_DISCLAIMER = "MODELED ESTIMATE — synthetic data, not validated ROI"
WEEKLY_DISCLAIMER = "Estimated hours saved is a MODELED assumption from synthetic data, not validated ROI."


@dataclass(frozen=True)
class AdoptionConfig:
    """Parameters of every metric. Defaults are the source definitions."""

    meaningful_event_types: tuple[str, ...] = MEANINGFUL_EVENT_TYPES
    value_event_types: tuple[str, ...] = VALUE_EVENT_TYPES
    adoption_event_types: tuple[str, ...] = ADOPTION_EVENT_TYPES
    qualifying_feature: str = QUALIFYING_FEATURE
    activation_window_days: int = 14
    activation_min_actions: int = 3
    trailing_window_days: int = 28
    retention_max_weeks: int = 8
    low_adoption_threshold: float = 0.70
    no_barrier_label: str = NO_BARRIER
    barrier_categories: tuple[str, ...] = BARRIER_CATEGORIES
    feature_names: tuple[str, ...] = CANONICAL_FEATURES
    canonical_business_units: tuple[str, ...] = CANONICAL_BUSINESS_UNITS
    business_unit_label_map: dict = field(default_factory=lambda: dict(BUSINESS_UNIT_LABEL_MAP))
    feature_label_map: dict = field(default_factory=lambda: dict(FEATURE_LABEL_MAP))
    # "date": the whole last day of the activation window counts (SQL rule);
    # "instant": only up to access + N days at midnight (pandas rule).
    activation_boundary: str = "date"
    # time-to-value population: False = anyone with an access date (SQL), True = eligible only
    ttv_eligible_only: bool = False
    ttv_bin_hours: int = 12
    # as-of date for dormancy / trailing windows; None = last event date in the data
    as_of_date: str | None = None

    def with_(self, **kw) -> "AdoptionConfig":
        return replace(self, **kw)

    def __hash__(self):  # dict fields make the generated hash fail
        return hash((self.activation_window_days, self.trailing_window_days, self.as_of_date))


DEFAULT_CONFIG = AdoptionConfig()

# The shipped test tables span 30 days, so the 14/28-day defaults make
# activation and dormancy near-degenerate there; registered queries use
# shorter windows over the same definitions (reference defaults also have keys).
TESTDATA_CONFIG = AdoptionConfig(
    activation_window_days=5,
    trailing_window_days=7,
    canonical_business_units=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    business_unit_label_map={
        "automobile": "AUTOMOBILE", "auto": "AUTOMOBILE", "building": "BUILDING",
        "furniture": "FURNITURE", "household": "HOUSEHOLD", "machinery": "MACHINERY",
    },
)
