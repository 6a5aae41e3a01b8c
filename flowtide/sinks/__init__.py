from flowtide.sinks.folders import Folders
from flowtide.sinks.tables import append_features, append_rules, compact_day, export_csv

__all__ = ["Folders", "append_features", "append_rules", "compact_day", "export_csv"]
