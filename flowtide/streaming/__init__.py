from flowtide.streaming.counts import FlowCounts
from flowtide.streaming.features import join_windows, joined_features, rejected_stream, valid_stream, windowed_features, windowed_sketches
from flowtide.streaming.late import keep_every_flow, read_aside, read_mark, read_open, read_windows
from flowtide.streaming.run import (
    dropped_as_late, each_arrival, print_batches, run_available, score_stream, score_windows, store_features, store_rules,
    write_table,
)

__all__ = [
    "FlowCounts", "dropped_as_late", "each_arrival", "join_windows", "joined_features", "keep_every_flow", "print_batches", "read_aside", "read_mark", "read_open",
    "read_windows", "rejected_stream", "run_available", "score_stream", "score_windows", "store_features", "store_rules", "valid_stream",
    "windowed_features", "windowed_sketches", "write_table",
]
