"""Which parts of the feature store are live: one small file per compaction, resolved by readers.

A compaction of a day and writer leaves ``_commits/day=/writer=/merged-<n>``, a list of the parts that the merged part
replaces. The file appears in one step, and with it the merged part becomes live and those parts cease to be. A merged
part without its file is unfinished work and passed over.
"""

from __future__ import annotations

from flowtide.sinks.folders import Folders

COMMITS = "_commits"


class Parts:
    """The parts of one ``day=/writer=`` folder."""

    def __init__(self, folders: Folders, own: str) -> None:
        self.folders, self.own = folders, own
        self.commits = _names(folders, f"{COMMITS}/{own}/merged-*")
        self.present = [p.partition("=")[2] for p in _names(folders, f"{own}/part=*")]
        self.replaced = sorted({p for c in self.commits for p in _lines(folders, f"{COMMITS}/{own}/{c}")} & set(self.present))
        self.live = [p for p in self.present if p not in self.replaced and (
            not p.startswith("merged-") or p in self.commits)]

    def next_merged(self) -> str:
        return f"merged-{max((int(c.partition('-')[2]) for c in self.commits), default=0) + 1}"

    def commit(self, name: str, held: list[str]) -> None:
        self.folders.write_line_file(f"{COMMITS}/{self.own}/{name}", held)


def _names(folders: Folders, pattern: str) -> list[str]:
    return [p.rpartition("/")[2] for p in folders.matching(pattern) if not p.endswith(".part")]


def _lines(folders: Folders, name: str) -> list[str]:
    spark = folders.spark
    return [r["value"] for r in spark.read.text(f"{folders.base}/{name}").collect()]  # as many lines as batches merged


def live_folders(folders: Folders, day: str) -> list[str]:
    """What a reader of one ``day=`` folder has to read: the whole folder, or its live parts once it was compacted."""
    compacted = folders.matching(f"{COMMITS}/{day}/writer=*")
    if not compacted and not folders.matching(f"{day}/writer=*/part=merged-*"):
        return [day]
    return [f"{own}/part={p}" for own in folders.matching(f"{day}/writer=*") for p in Parts(folders, own).live]
