"""A small capture of flow records and the results expected from it."""

from __future__ import annotations

import json

KEYS = ("srcaddr_s", "srcport", "dstaddr_s", "dstport", "proto", "tcp_flags", "dOctets", "count",
        "timestamp", "first", "last")

# 18 captured records, one row each in the order of KEYS.
RECORDS = (
    ("10.0.0.2", 37390, "10.0.0.1", 8000, 6, 17, 198, 1, 1523417467487, 1523417407025, 1523417407025),
    ("10.0.0.1", 8000, "10.0.0.2", 37392, 6, 25, 1980, 2, 1523417471563, 1523417461526, 1523417461531),
    ("10.0.0.2", 37392, "10.0.0.1", 8000, 6, 21, 252, 2, 1523417471563, 1523417461530, 1523417461532),
    ("10.0.0.1", 8000, "10.0.0.2", 37394, 6, 27, 2054, 2, 1523417782504, 1523417782496, 1523417782504),
    ("10.0.0.2", 37394, "10.0.0.1", 8000, 6, 27, 481, 2, 1523417782504, 1523417782487, 1523417782500),
    ("10.0.0.1", 0, "10.0.0.2", 0, 1, 0, 98, 2, 1523418178386, 1523418177880, 1523418177880),
    ("10.0.0.2", 0, "10.0.0.1", 2048, 1, 0, 98, 2, 1523418178386, 1523418177867, 1523418177867),
    ("10.0.0.1", 0, "10.0.0.2", 0, 1, 0, 1274, 2, 1523418201452, 1523418178865, 1523418191155),
    ("10.0.0.2", 0, "10.0.0.1", 2048, 1, 0, 1274, 2, 1523418201452, 1523418178865, 1523418191155),
    ("10.0.0.1", 0, "10.0.0.2", 0, 1, 0, 108730, 3, 1523418230524, 1523418203223, 1523418220342),
    ("10.0.0.2", 0, "10.0.0.1", 2048, 1, 0, 15140, 3, 1523418230524, 1523418203223, 1523418220342),
    ("10.0.0.2", 0, "10.0.0.1", 0, 1, 0, 93590, 3, 1523418230524, 1523418203223, 1523418220342),
    ("10.0.0.2", 0, "10.0.0.1", 2048, 1, 0, 1514, 2, 1523418236108, 1523418235966, 1523418235966),
    ("10.0.0.2", 0, "10.0.0.1", 0, 1, 0, 49650, 2, 1523418236108, 1523418235966, 1523418236047),
    ("10.0.0.1", 0, "10.0.0.2", 0, 1, 0, 45420, 1, 1523418236109, 1523418236106, 1523418236109),
    ("10.0.0.1", 0, "10.0.0.2", 0, 1, 0, 210400, 3, 1523418250378, 1523418236113, 1523418239989),
    ("10.0.0.2", 0, "10.0.0.1", 2048, 1, 0, 6056, 3, 1523418250378, 1523418236944, 1523418239989),
    ("10.0.0.2", 0, "10.0.0.1", 0, 1, 0, 198600, 3, 1523418250378, 1523418236944, 1523418239989),
)

# Fixed values: (source, flows, bytes, addresses, ports, records) of the capture as one batch.
WHOLE = {
    ("10.0.0.1", 15, 369956, 1, 3, 7),
    ("10.0.0.2", 25, 366853, 1, 3, 11),
}

# The same per minute of export time.
MINUTES = {
    ("03:31", "10.0.0.1", 2, 1980, 1, 1, 1), ("03:31", "10.0.0.2", 3, 450, 1, 1, 2),
    ("03:36", "10.0.0.1", 2, 2054, 1, 1, 1), ("03:36", "10.0.0.2", 2, 481, 1, 1, 1),
    ("03:42", "10.0.0.1", 2, 98, 1, 1, 1), ("03:42", "10.0.0.2", 2, 98, 1, 1, 1),
    ("03:43", "10.0.0.1", 6, 155424, 1, 1, 3), ("03:43", "10.0.0.2", 12, 161168, 1, 2, 5),
    ("03:44", "10.0.0.1", 3, 210400, 1, 1, 1), ("03:44", "10.0.0.2", 6, 204656, 1, 2, 2),
}


def as_dicts() -> list[dict]:
    return [dict(zip(KEYS, record)) for record in RECORDS]


def as_lines() -> list[str]:
    return [json.dumps(record) for record in as_dicts()]


def without(record: dict, *keys: str) -> dict:
    return {k: v for k, v in record.items() if k not in keys}
