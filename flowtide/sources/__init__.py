from flowtide.sources.features import checked_feature_csv, read_feature_csv, read_rules, read_store
from flowtide.sources.flows import decode, read_flow_json, read_kafka, read_lines
from flowtide.sources.hosts import host_table, read_hosts

__all__ = [
    "checked_feature_csv", "decode", "host_table", "read_feature_csv", "read_flow_json", "read_hosts",
    "read_kafka", "read_lines", "read_rules", "read_store",
]
