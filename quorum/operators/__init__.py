from quorum.operators.membership import explode_members, missing_members
from quorum.operators.nearest import nearest_join
from quorum.operators.partial import merge_partial_sums
from quorum.operators.participation import participation
from quorum.operators.ranking import first_per_group
from quorum.operators.reconcile import (crossed_sightings, other_roots,
                                        outer_chain, precedence_rows, source_rollup)
from quorum.operators.rollup import distinct_rows, rollup, union_all, union_distinct
from quorum.operators.unanimity import CLIENTS, top_variant, unanimity
from quorum.operators.versioned import (append, compact, current_rows, latest_by_key,
                                        read_current)

__all__ = [
    "explode_members", "missing_members", "nearest_join", "merge_partial_sums",
    "participation", "first_per_group", "crossed_sightings", "precedence_rows", "other_roots", "outer_chain",
    "source_rollup", "distinct_rows", "rollup", "union_all", "union_distinct", "CLIENTS",
    "top_variant", "unanimity", "append", "compact", "current_rows", "latest_by_key",
    "read_current",
]
