from flowtide.functions.distance import (
    euclidean, nearest, one_sided, one_sided_by_sign, squared_distance,
)
from flowtide.functions.flow import block_network, l4_port, rule_path
from flowtide.functions.stats import sigma_steps, vector_columns, zero_guard
from flowtide.functions.time import day_of, stamp

__all__ = [
    "block_network", "day_of", "euclidean", "l4_port", "nearest", "one_sided", "one_sided_by_sign",
    "rule_path", "sigma_steps", "stamp", "squared_distance", "vector_columns", "zero_guard",
]
