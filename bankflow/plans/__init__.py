from bankflow.plans.skew import (
    DEFAULT_CHUNK,
    fan_out_left,
    key_counts,
    layout_of,
    left_join,
    may_be_crowded,
    split_layout,
)
from bankflow.plans.workspace import materialize, materialize_counted, new_path, shared_dir

__all__ = [
    "DEFAULT_CHUNK", "fan_out_left", "key_counts", "layout_of", "left_join", "materialize", "materialize_counted",
    "may_be_crowded", "new_path", "shared_dir", "split_layout",
]
