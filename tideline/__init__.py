"""tideline: incremental data-quality checks and root-cause analysis on Spark."""

from tideline.operators.checks import (
    Check,
    ExpressionCheck,
    NullRateCheck,
    ReferentialCheck,
    VolumeCheck,
    orphan_rows,
)
from tideline.operators.rca import Analysis, analyze
from tideline.plans.fused import check_results
from tideline.plans.runner import DatasetSpec, QualityRunner, RunOutcome, run_summary
from tideline.sources.lineage import LineageGraph
from tideline.sources.store import ResultStore

__all__ = [
    "Check",
    "ExpressionCheck",
    "NullRateCheck",
    "ReferentialCheck",
    "VolumeCheck",
    "orphan_rows",
    "Analysis",
    "analyze",
    "check_results",
    "DatasetSpec",
    "QualityRunner",
    "RunOutcome",
    "run_summary",
    "LineageGraph",
    "ResultStore",
]
