"""Layer loads and KPI queries."""

from terrace.plans.history import DriftError, HistoryGate, bounds_for_next, metric_history
from terrace.plans.kpi import (
    category_grain,
    largest_first,
    popular_categories,
    share_within_state,
    states_for_category,
    total_by,
)
from terrace.plans.ledger import ledger, load_new_pages, open_files, page_states
from terrace.plans.loads import (
    Load,
    TruncatedLoadError,
    UnnumberedPageError,
    load_bronze,
    gold_layer,
    load_gold,
    load_gold_changes,
    load_landing,
    load_silver,
    mask,
    read_gold,
    read_silver,
    record_metrics,
    refine,
    run_loads,
    silver_layer,
)
from terrace.plans.profiles import profile_over_runs, store_profile
from terrace.plans.replay import quarantined, replay_quarantine
from terrace.plans.runs import finished_runs

__all__ = [
    "DriftError",
    "HistoryGate",
    "Load",
    "TruncatedLoadError",
    "UnnumberedPageError",
    "bounds_for_next",
    "category_grain",
    "finished_runs",
    "gold_layer",
    "largest_first",
    "ledger",
    "load_bronze",
    "load_gold",
    "load_gold_changes",
    "load_landing",
    "load_new_pages",
    "load_silver",
    "mask",
    "metric_history",
    "open_files",
    "page_states",
    "popular_categories",
    "profile_over_runs",
    "quarantined",
    "read_gold",
    "read_silver",
    "record_metrics",
    "refine",
    "replay_quarantine",
    "run_loads",
    "share_within_state",
    "silver_layer",
    "states_for_category",
    "store_profile",
    "total_by",
]
