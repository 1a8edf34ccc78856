"""strata — layered (Bronze -> Silver -> Gold) lakehouse operators on Apache Spark.

Common entry points::

    from strata import (FileSource, Flow, Lakehouse, VersionedTable, run_flow, run_pipeline,
                        clean_trips, zone_metrics, enrich_trips, expect_all_or_drop, drop_duplicates)
"""

from .operators.aggregates import driver_metrics, user_metrics, zone_metrics
from .operators.cleaning import clean_drivers, clean_trips, clean_users
from .operators.dedup import drop_duplicates
from .operators.enrich import enrich_trips, match_report, row_preservation, top_drivers
from .operators.quality import expect_all_or_drop, observe_rules, rule_metrics, violations
from .sources.files import FileSource
from .streaming.flows import Flow, run_flow, run_pipeline, stop_all
from .tables.versioned import Lakehouse, VersionedTable

__version__ = "0.1.0"

__all__ = [
    "FileSource", "Flow", "Lakehouse", "VersionedTable", "run_flow", "run_pipeline", "stop_all",
    "clean_trips", "clean_drivers", "clean_users", "zone_metrics", "driver_metrics", "user_metrics",
    "enrich_trips", "match_report", "row_preservation", "top_drivers", "drop_duplicates",
    "expect_all_or_drop", "observe_rules", "rule_metrics", "violations",
]
