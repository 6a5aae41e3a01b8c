"""Schemas shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The 40 keys of a NetFlow v5 JSON record.
LONG_KEYS = (
    "srcaddr", "dstaddr", "nexthop", "srcport", "dstport", "proto", "tcp_flags", "tos",
    "dPkts", "dOctets", "count", "flowseq", "first", "last", "raw_first", "raw_last",
    "timestamp", "seconds", "nanos", "uptime", "length", "version", "engineid", "enginetype",
    "snmpinput", "snmponput", "srcas", "dstas", "src_mask", "dst_mask",
    "samplingint", "samplingmode", "raw_sampling",
)
STRING_KEYS = ("srcaddr_s", "dstaddr_s", "nexthop_s", "id", "packetid", "readerId", "sender")

RAW_FLOW = T.StructType(
    [T.StructField(name, T.LongType()) for name in LONG_KEYS]
    + [T.StructField(name, T.StringType()) for name in STRING_KEYS]
)

# Projected column -> record key.
FLOW_COLUMNS = {
    "srcAddr": "srcaddr_s",
    "srcPort": "srcport",
    "dstAddr": "dstaddr_s",
    "dstPort": "dstport",
    "tcpFlags": "tcp_flags",
    "protocol": "proto",
    "timestampStart": "first",
    "timestampEnd": "last",
    "numBytes": "dOctets",
    "numFlows": "count",
}

# The record keys the pipeline reads: those above and the export time.
READ_KEYS = (*FLOW_COLUMNS.values(), "timestamp")

# The per-source features, and the subset the models are trained on.
FEATURES = ("sumOfFlows", "sumOfBytes", "uniqDstIPs", "uniqDstPorts")
MODEL_FEATURES = ("sumOfBytes", "uniqDstIPs", "uniqDstPorts")

STORE = T.StructType([
    T.StructField("sumOfFlows", T.LongType()),
    T.StructField("sumOfBytes", T.LongType()),
    T.StructField("uniqDstIPs", T.IntegerType()),
    T.StructField("uniqDstPorts", T.IntegerType()),
    T.StructField("batch", T.LongType()),
    T.StructField("day", T.DateType()),
    T.StructField("writer", T.StringType()),
    T.StructField("part", T.StringType()),
])

FEATURE_CSV = T.StructType([T.StructField(name, T.DoubleType()) for name in MODEL_FEATURES])

HOSTS = T.StructType([
    T.StructField("hosts", T.ArrayType(T.StructType([
        T.StructField("ipAddresses", T.ArrayType(T.StringType())),
        T.StructField("locations", T.ArrayType(T.StructType([
            T.StructField("elementId", T.StringType()),
        ]))),
    ]))),
])

MODEL = T.StructType([
    T.StructField("cluster", T.IntegerType()),
    T.StructField("center", T.ArrayType(T.DoubleType())),
    T.StructField("feature_max", T.ArrayType(T.DoubleType())),
    T.StructField("mean", T.ArrayType(T.DoubleType())),
    T.StructField("stddev", T.ArrayType(T.DoubleType())),
    T.StructField("threshold", T.DoubleType()),
])
