"""uptake — product-adoption analytics as lazy Spark DataFrame operators.

Raw user / usage-event / feedback / training / feature / calendar tables go
in; cleaned tables with a counted data-quality log, a star schema with
integrity checks, and adoption metrics (activation, WAU/MAU, stickiness,
feature adoption, time-to-value, cohort retention, dormancy, training,
feedback barriers, weekly report tables) come out.

Every operator takes a :class:`~uptake.tables.Tables` bundle and an
:class:`~uptake.config.AdoptionConfig` and returns a lazy DataFrame; nothing
is collected on the driver.
"""

from uptake.config import AdoptionConfig, DEFAULT_CONFIG, TESTDATA_CONFIG
from uptake.tables import Tables

__all__ = ["AdoptionConfig", "DEFAULT_CONFIG", "TESTDATA_CONFIG", "Tables"]
