"""Generic DataFrame operators. They take column names as arguments and
know nothing of the league domain."""

from courtside.operators.topk import top_k, order_columns
from courtside.operators.aggregate import conditional_rate, rate_by_group, share_of_total
from courtside.operators.ranking import seed_within
from courtside.operators.extremes import arg_extreme, display_key, first_in_order
from courtside.operators.snapshot import latest_snapshot

__all__ = [
    "top_k", "order_columns", "conditional_rate", "rate_by_group", "share_of_total",
    "seed_within", "arg_extreme", "display_key", "first_in_order", "latest_snapshot",
]
