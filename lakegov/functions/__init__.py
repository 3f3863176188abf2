from lakegov.functions.expr import (
    as_rate,
    fill_rate,
    flag_sum,
    max_edits_for,
    norm_name,
    record_hash,
    similarity,
)

__all__ = [
    "as_rate",
    "fill_rate",
    "flag_sum",
    "max_edits_for",
    "norm_name",
    "record_hash",
    "similarity",
]
