from sparecost.operators.allocate import Pool, allocate_pool, rate_by_group
from sparecost.operators.cascade import Rule, rule_cascade
from sparecost.operators.hot import SALT, hot_keys, replicated, salted
from sparecost.operators.latest import latest_per_key
from sparecost.operators.merge import (
    merge_update,
    unique_source,
    with_spread,
)
from sparecost.operators.packed import with_rest_packed
from sparecost.operators.waterfall import Step, waterfall_lookup

__all__ = [
    "SALT", "hot_keys", "replicated", "salted",
    "Pool", "Rule", "Step", "allocate_pool", "latest_per_key",
    "merge_update", "rate_by_group", "rule_cascade", "unique_source", "waterfall_lookup", "with_rest_packed", "with_spread",
]
