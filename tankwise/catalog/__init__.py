"""Named queries over the test tables, each with an equivalent SQL text where SQL can express it."""

from tankwise.catalog import analysis, detection, learning, preparation, proofs
from tankwise.catalog.registry import ORACLES, QUERIES, register_sliced

# Once more with small slices: 2,500 rows of the whole table, or 60 of a tank.
for _name in ("anom_all", "cp_cusum", "cp_window", "feat_all", "missing_both", "rolling_stats", "golden_similarity"):
    register_sliced(_name, 2_500)
for _name in ("feat_lag_by_tank", "missing_by_tank", "resample_by_tank"):
    register_sliced(_name, 60)

__all__ = ["ORACLES", "QUERIES", "analysis", "detection", "learning", "preparation", "proofs"]
