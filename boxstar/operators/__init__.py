"""Distributed operators built from DataFrame primitives."""

from boxstar.operators.keys import through_keys  # noqa: F401
from boxstar.operators.ordered import (  # noqa: F401
    default_parts,
    dense_key,
    dense_rank_by,
    exact_quantiles,
    numbered,
    ordered,
    percentile_rank_by,
    prefix_before,
    value_ranks,
)
from boxstar.operators.shaping import (  # noqa: F401
    latest_per_key,
    top_n_per_group,
)
