"""Listing price analytics on Spark: cleaning rules, features, price models and market benchmarks."""

import sys

from pyspark import cloudpickle

from .errors import DataError, RuleError
from .plans.analysis import Analysis, analysis_run
from .plans.findings import market_findings, market_job
from .plans.scoring import prediction_run, price_apartments, pricing_report
from .plans.snapshots import add_counts, add_moments, drop_snapshot, fitted_from_counts, merged_moments, snapshot_names
from .plans.training import Fitted, clean_listings, inference_run, training_run
from .plans.versions import Version, drop_versions, load_version, publish_version, version_names
from .rules import Rules
from .session import tune
from .sources.staging import drop_staged
from .streaming.scorer import score_rows, stream_refreshed, stream_score

__all__ = [
    "Analysis", "DataError", "Fitted", "RuleError", "Rules", "Version", "add_counts", "add_moments", "analysis_run", "clean_listings", "drop_snapshot",
    "drop_staged", "drop_versions", "fitted_from_counts", "inference_run", "load_version", "market_findings", "market_job", "merged_moments",
    "prediction_run", "price_apartments", "pricing_report", "publish_version", "score_rows", "snapshot_names", "stream_refreshed", "stream_score",
    "training_run", "tune", "version_names",
]

# the few Python tasks (cross products, normal equations) carry their code with them, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])
