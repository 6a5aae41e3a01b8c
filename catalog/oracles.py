"""DuckDB SQL for the queries whose result SQL can state."""

from __future__ import annotations

FEATURES = ("sumOfFlows", "sumOfBytes", "uniqDstIPs", "uniqDstPorts")
MODEL = ("sumOfBytes", "uniqDstIPs", "uniqDstPorts")
# The keys of a record, and those the event view fills.
LONG_KEYS = tuple(
    "srcaddr dstaddr nexthop srcport dstport proto tcp_flags tos dPkts dOctets count flowseq first last raw_first "
    "raw_last timestamp seconds nanos uptime length version engineid enginetype snmpinput snmponput srcas dstas "
    "src_mask dst_mask samplingint samplingmode raw_sampling".split())
STRING_KEYS = ("srcaddr_s", "dstaddr_s", "nexthop_s", "id", "packetid", "readerId", "sender")
EVENT_KEYS = ("srcaddr_s", "srcport", "dstaddr_s", "dstport", "proto", "tcp_flags", "dOctets", "count", "first", "last",
              "timestamp")

# Common table expressions, used by name.
CTES = {
    "raw": """
        SELECT '10.0.0.' || CAST(user_id % 12 + 1 AS VARCHAR) AS srcaddr_s,
               CAST(32768 + event_id % 1000 AS BIGINT) AS srcport,
               '10.0.1.' || CAST(event_id % 251 AS VARCHAR) AS dstaddr_s,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS dstport,
               CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 17 ELSE 6 END AS BIGINT)
                   AS proto,
               CAST(event_id % 32 AS BIGINT) AS tcp_flags,
               CAST(round(value * 100) AS BIGINT) AS "dOctets",
               CAST(1 + event_id % 3 AS BIGINT) AS "count",
               epoch_us(ts) // 1000 AS "first",
               epoch_us(ts) // 1000 + event_id % 5000 AS "last",
               epoch_us(ts) // 1000 AS "timestamp",
               ts
        FROM events""",
    "flows": """
        SELECT srcaddr_s AS "srcAddr", srcport AS "srcPort", dstaddr_s AS "dstAddr",
               dstport AS "dstPort", tcp_flags AS "tcpFlags", proto AS protocol,
               "first" AS "timestampStart", "last" AS "timestampEnd",
               "dOctets" AS "numBytes", "count" AS "numFlows", ts
        FROM raw""",
    # What a parser sees of the messages: the cut ones are gone, two kinds lack a field.
    "decoded": """
        SELECT CASE WHEN "dstPort" IN (13, 15) THEN NULL ELSE "srcAddr" END AS "srcAddr",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "srcPort" END AS "srcPort",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "dstAddr" END AS "dstAddr",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "dstPort" END AS "dstPort",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "tcpFlags" END AS "tcpFlags",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE protocol END AS protocol,
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "timestampStart" END AS "timestampStart",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "timestampEnd" END AS "timestampEnd",
               CASE WHEN "dstPort" = 13 THEN NULL ELSE "numBytes" END AS "numBytes",
               CASE WHEN "dstPort" IN (13, 14) THEN NULL ELSE "numFlows" END AS "numFlows",
               ts
        FROM flows""",
    "valid": """
        SELECT * FROM decoded WHERE "srcAddr" IS NOT NULL AND "numFlows" IS NOT NULL""",
    "texts": """
        SELECT dstport,
               '{' || CASE WHEN dstport = 15 THEN '' ELSE '"srcaddr_s":"' || srcaddr_s || '",' END
               || '"srcport":' || srcport || ',"dstaddr_s":"' || dstaddr_s
               || '","dstport":' || dstport || ',"proto":' || proto
               || ',"tcp_flags":' || tcp_flags || ',"dOctets":' || "dOctets"
               || CASE WHEN dstport = 14 THEN '' ELSE ',"count":' || "count" END
               || ',"first":' || "first" || ',"last":' || "last"
               || ',"timestamp":' || "timestamp" || '}' AS body
        FROM raw""",
    "messages": """
        SELECT dstport, CASE WHEN dstport = 13 THEN substr(body, 1, length(body) - 10)
                             ELSE body END AS value
        FROM texts""",
    "volume_flows": """
        SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS win,
               CAST(l_suppkey AS VARCHAR) AS "srcAddr", CAST(l_partkey AS VARCHAR) AS "dstAddr",
               CAST(l_linenumber * 100 + CAST(floor(l_quantity) AS INTEGER) AS BIGINT) AS "dstPort",
               CAST(round(l_extendedprice) AS BIGINT) AS "numBytes", CAST(1 AS BIGINT) AS "numFlows"
        FROM lineitem""",
    "hosts": """
        SELECT '10.0.0.' || CAST(s_suppkey * 2 + 1 AS VARCHAR) AS ip,
               'of:' || lpad(lower(to_hex(s_nationkey)), 16, '0') AS device
        FROM supplier""",
}

AGGREGATES = """
    CAST(sum("numFlows") AS BIGINT) AS "sumOfFlows", CAST(sum("numBytes") AS BIGINT) AS "sumOfBytes",
    count(DISTINCT "dstAddr") AS "uniqDstIPs", count(DISTINCT "dstPort") AS "uniqDstPorts",
    count(*) AS "numRecords\""""


def grouped(win: str, source: str = "flows") -> str:
    return f'SELECT {win} AS win, "srcAddr", {AGGREGATES} FROM {source} GROUP BY 1, 2'


MINUTE = "date_trunc('minute', ts)"
DAY = "CAST(date_trunc('day', ts) AS TIMESTAMP)"
WEEK = "time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01')"

CTES["minutes"] = grouped(MINUTE)
CTES["days"] = grouped(DAY)
CTES["weeks"] = grouped(WEEK)
CTES["volume"] = grouped("win", "volume_flows")
CTES["stream_minutes"] = grouped(MINUTE, "valid")
CTES["stream_hours"] = grouped("date_trunc('hour', ts)", "valid")
CTES["stream_days"] = grouped(DAY, "valid")
CTES["stream_weeks"] = grouped(WEEK, "valid")
# The newest event time less the allowed delay, in milliseconds as messages carry it.
CTES["closed"] = "SELECT max(date_trunc('milliseconds', ts)) - INTERVAL '2 minutes' AS upto FROM valid"


def each(template: str, columns=FEATURES, sep: str = ", ") -> str:
    return sep.join(template.replace("$c", c) for c in columns)


def union(template: str, columns=FEATURES) -> str:
    return each(template, columns, " UNION ALL ")


def guarded(value: str) -> str:
    return f"CASE WHEN coalesce({value}, 0) = 0 THEN 1 ELSE {value} END"


def steps(largest: str, mean: str, sigma: str) -> str:
    return (f"CASE WHEN {sigma} = 0 THEN 2 "
            f"ELSE greatest(2, CAST(ceil(({largest} - {mean}) / {sigma}) AS BIGINT)) END")


CTES["limits"] = union("""
    SELECT '$c' AS feature, m AS mean, s AS stddev, x AS max, n, m + n * s AS upper
    FROM (SELECT *, """ + steps("x", "m", "s") + """ AS n
          FROM (SELECT avg("$c") AS m, coalesce(stddev_samp("$c"), 0) AS s,
                       CAST(max("$c") AS DOUBLE) AS x FROM $t))""")
CTES["day_limits"] = CTES["limits"].replace("$t", "days")
CTES["drawn"] = """
    SELECT l_orderkey, l_linenumber,
           CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) / 4294967296.0 AS draw
    FROM lineitem"""
CTES["volume_moments"] = f"""
    SELECT {each('avg("$c") AS "m_$c"', MODEL)}, {each('stddev_samp("$c") AS "s_$c"', MODEL)} FROM volume"""
CTES["one_center"] = f"""
    SELECT count(*) AS rows, round(sum(d), 4) AS wssse, round(avg(sqrt(d)), 4) AS distortion FROM (
      SELECT {each('pow(("$c" - "m_$c") / "s_$c", 2)', MODEL, " + ")} AS d FROM volume, volume_moments)"""
CTES["gapped"] = 'SELECT win, "srcAddr", ' + each(
    'CASE WHEN "$c" % 5 = 0 THEN NULL ELSE CAST("$c" AS DOUBLE) END AS "$c"') + " FROM volume"
CTES["gapped_limits"] = CTES["limits"].replace("$t", "gapped")
CTES["volume_limits"] = CTES.pop("limits").replace("$t", "volume")
CTES["exceeding"] = ('SELECT win, "srcAddr", ' + each("""
    CASE WHEN "$c" > (SELECT upper FROM day_limits WHERE feature = '$c') THEN "$c" END AS "$c\"""", MODEL)
    + " FROM weeks")
CTES["flagged"] = "SELECT * FROM exceeding WHERE " + each('"$c" IS NOT NULL', MODEL, " OR ")

# Detector of the day features, on scaled (prepared) or raw columns.
CTES["raw_moments"] = "SELECT " + each(
    'avg("$c") AS "m_$c", coalesce(stddev_samp("$c"), 0) AS "s_$c"', MODEL) + " FROM days"
CTES["scaled"] = 'SELECT win, "srcAddr", ' + each(
    'CASE WHEN "s_$c" > 0 THEN "$c" / "s_$c" ELSE 0 END AS "$c"', MODEL) + " FROM days, raw_moments"
CTES["unscaled"] = 'SELECT win, "srcAddr", ' + each('CAST("$c" AS DOUBLE) AS "$c"', MODEL) + " FROM days"


def detector(name: str, prepared: str) -> None:
    """Centres, assignment, statistics and thresholds on one prepared table."""
    CTES[f"{name}_moments"] = "SELECT " + each(
        'avg("$c") AS "am_$c", coalesce(stddev_samp("$c"), 0) AS "as_$c"', MODEL) + f" FROM {prepared}"
    CTES[f"{name}_centers"] = "SELECT z + 1 AS cluster, " + each(
        '"am_$c" + z * "as_$c" AS "c_$c"', MODEL) + (
        f" FROM {name}_moments, (SELECT unnest([-1, 0, 1]) AS z)")
    CTES[f"{name}_assigned"] = """
        SELECT win, "srcAddr", """ + each('"$c"', MODEL) + """, cluster, distance
        FROM (SELECT *, row_number() OVER (PARTITION BY win, "srcAddr"
                                           ORDER BY distance, cluster) AS place
              FROM (SELECT p.*, cluster, sqrt(""" + each(
        'pow("$c" - "c_$c", 2)', MODEL, " + ") + f""") AS distance
                    FROM {prepared} p, {name}_centers))
        WHERE place = 1"""
    CTES[f"{name}_stats"] = 'SELECT cluster, count(*) AS "rows", ' + each("""
        CAST(max("$c") AS DOUBLE) AS "x_$c", avg("$c") AS "m_$c",
        coalesce(stddev_samp("$c"), 0) AS "s_$c\"""", MODEL) + f" FROM {name}_assigned GROUP BY cluster"
    CTES[f"{name}_uppers"] = "SELECT cluster, " + each(
        '"x_$c" + 2 * "as_$c" AS "u_$c"', MODEL) + f" FROM {name}_stats, {name}_moments"
    CTES[f"{name}_thresholds"] = "SELECT *, sqrt(" + each(
        'pow("u_$c", 2)', MODEL, " + ") + f") AS threshold FROM {name}_uppers"
    CTES[f"{name}_uppers_v1"] = "SELECT cluster, " + each(
        'ceil("m_$c" + ' + steps('"x_$c"', '"m_$c"', '"s_$c"') + ' * "s_$c") AS "u_$c"',
        MODEL) + f" FROM {name}_stats"
    CTES[f"{name}_thresholds_v1"] = "SELECT *, sqrt(" + each(
        'pow("u_$c", 2)', MODEL, " + ") + f") AS threshold FROM {name}_uppers_v1"


detector("d", "scaled")
detector("r", "unscaled")


def scored(points: str, name: str, version: str = "") -> str:
    """Nearest centre of the points by one-sided distance. ``points`` has columns p_*."""
    return f"""
        SELECT win, "srcAddr", cluster, distance, coalesce(distance > threshold, false) AS anomaly
        FROM (SELECT *, row_number() OVER (PARTITION BY win, "srcAddr"
                                           ORDER BY distance, c.cluster) AS place
              FROM (SELECT p.*, k.cluster,
                           CASE WHEN """ + each(
        f'"p_$c" < (SELECT max("c_$c") FROM {name}_centers)', MODEL, " AND ") + """ THEN 0
                           ELSE sqrt(""" + each('pow("p_$c" - "c_$c", 2)', MODEL, " + ") + f""") END
                           AS distance
                    FROM ({points}) p, {name}_centers k) c
              LEFT JOIN {name}_thresholds{version} t ON t.cluster = c.cluster)
        WHERE place = 1"""


def live(center: bool, source: str = "weeks") -> str:
    move = ' - "m_$c"' if center else ""
    return ('SELECT win, "srcAddr", ' + each(
        f'("$c"{move}) / ({guarded(chr(34) + "s_$c" + chr(34))}) AS "p_$c"', MODEL)
        + f" FROM {source}, raw_moments")


CTES["scored_centred"] = scored(live(True), "d")
CTES["scored_uncentred"] = scored(live(False), "d")
CTES["scored_unscaled"] = scored(
    'SELECT win, "srcAddr", ' + each('CAST("$c" AS DOUBLE) AS "p_$c"', MODEL) + " FROM weeks", "r")
CTES["scored_stream"] = scored(live(False, "stream_days"), "d")
CTES["scored_stream_weeks"] = scored(live(False, "stream_weeks"), "d")
CTES["scored_v1"] = """
    SELECT win, "srcAddr", cluster, distance, coalesce(distance > threshold, false) AS anomaly
    FROM (SELECT *, row_number() OVER (PARTITION BY win, "srcAddr"
                                       ORDER BY distance, c.cluster) AS place
          FROM (SELECT p.win, p."srcAddr", p.cluster, CASE WHEN """ + each("""
                  (("p_$c" > 0 AND "p_$c" < (SELECT max("c_$c") FROM r_centers))
                   OR ("p_$c" < 0 AND "p_$c" > (SELECT min("c_$c") FROM r_centers)))""",
                  MODEL, " AND ") + """
                  THEN 0 ELSE sqrt(""" + each('pow("p_$c" - "c_$c", 2)', MODEL, " + ") + """) END AS distance
                FROM (SELECT w.win, w."srcAddr", k.*, """ + each(
    '("$c" - coalesce("m_$c", 0)) / (' + guarded('"s_$c"') + ') AS "p_$c"', MODEL) + """
                      FROM weeks w, r_centers k LEFT JOIN r_stats s ON s.cluster = k.cluster) p) c
          LEFT JOIN r_thresholds_v1 t ON t.cluster = c.cluster)
    WHERE place = 1"""


def rule(source: str) -> str:
    body = ("""'{"priority":40000,"timeout":0,"isPermanent":"true","deviceId":"' || device || '","""
            """"treatment":{},"selector":{"criteria":[{"type":"ETH_TYPE","ethType":"0x0800"},"""
            """{"type":"IPV4_SRC","ip":"' || "srcAddr" || '/32"}]}}'""")
    return f"""SELECT win, "srcAddr", device,
        CASE WHEN device IS NULL THEN 'unmapped' ELSE 'mapped' END AS status,
        '/flows/' || device || '?appId=org.onosproject.fwd' AS path, {body} AS body
        FROM ({source}) LEFT JOIN hosts ON ip = "srcAddr\""""


def closed(source: str, length: str, what: str = "*") -> str:
    return f"SELECT {what} FROM {source}, closed WHERE win + INTERVAL '{length}' <= upto"


FLOW = ('"srcAddr", "srcPort", "dstAddr", "dstPort", "tcpFlags", protocol, '
        '"timestampStart", "timestampEnd", "numBytes", "numFlows"')
L4 = FLOW.replace('"srcPort"', 'CASE WHEN protocol IN (6, 17) THEN "srcPort" ELSE 0 END AS "srcPort"')
L4 = L4.replace('"dstPort"', 'CASE WHEN protocol IN (6, 17) THEN "dstPort" ELSE 0 END AS "dstPort"')
WHOLE = f'SELECT "srcAddr", {AGGREGATES} FROM flows GROUP BY 1'
ALL = '"sumOfFlows", "sumOfBytes", "uniqDstIPs", "uniqDstPorts", "numRecords"'
THREE = '"sumOfBytes", "uniqDstIPs", "uniqDstPorts"'
STORED = '"sumOfFlows", "sumOfBytes", "uniqDstIPs", "uniqDstPorts"'

CTES["l4_flows"] = f"SELECT {L4} FROM flows"
CTES["labelled"] = """
    SELECT win, "srcAddr", s_nationkey AS label,
           CAST("sumOfBytes" AS DOUBLE) AS "sumOfBytes", CAST("uniqDstIPs" AS DOUBLE) AS "uniqDstIPs",
           CAST("uniqDstPorts" AS DOUBLE) AS "uniqDstPorts",
           CAST("sumOfBytes" AS DOUBLE) * "uniqDstIPs" AS "sumOfBytes_uniqDstIPs",
           CAST("sumOfBytes" AS DOUBLE) * "uniqDstPorts" AS "sumOfBytes_uniqDstPorts",
           CAST("uniqDstIPs" AS DOUBLE) * "uniqDstPorts" AS "uniqDstIPs_uniqDstPorts"
    FROM volume JOIN supplier ON CAST(s_suppkey AS VARCHAR) = "srcAddr\""""
LABELLED = (*MODEL, "sumOfBytes_uniqDstIPs", "sumOfBytes_uniqDstPorts", "uniqDstIPs_uniqDstPorts")
CTES["f_values"] = union("""
    SELECT '$c' AS feature,
           (sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f_value
    FROM (SELECT label, count(*) AS n, avg("$c") AS m, var_pop("$c") AS v,
                 (SELECT avg("$c") FROM labelled) AS g
          FROM labelled GROUP BY label)""", LABELLED)
CTES["numbered"] = "SELECT row_number() OVER () AS i, * FROM d_assigned"
CTES["d_middle"] = "SELECT " + each('avg("$c") AS "c_$c"', MODEL) + " FROM scaled"
CTES["axis"] = """
    SELECT CAST(i AS INTEGER) AS bin, lo + i * (hi - lo) / 10 AS low, lo + (i + 1) * (hi - lo) / 10 AS high,
           lo, hi
    FROM (SELECT unnest(range(10)) AS i),
         (SELECT CAST(min("uniqDstIPs") AS DOUBLE) AS lo, CAST(max("uniqDstIPs") AS DOUBLE) AS hi
          FROM volume)"""
CTES["filled"] = """
    SELECT CAST(least(9, floor(("uniqDstIPs" - lo) / ((hi - lo) / 10))) AS INTEGER) AS bin,
           count(*) AS "rows"
    FROM volume, (SELECT DISTINCT lo, hi FROM axis) GROUP BY 1"""


def standardized(sigma: str) -> str:
    return ('SELECT win, "srcAddr", ' + each(
        f'round(("$c" - (SELECT avg("$c") FROM days)) / (SELECT {sigma}("$c") FROM days), 6) AS "$c"')
        + " FROM days")


def array_columns(prefix: str, name: str, digits: int) -> str:
    return each(f'round("{prefix}_$c", {digits}) AS "{name}_$c"', MODEL)


CTES["found_rules"] = rule("SELECT * FROM flagged")


def store_rows() -> str:
    """The rows of the filled feature store."""
    return " UNION ALL ".join(
        f"""SELECT '{writer}' AS writer, CAST({batch} AS BIGINT) AS batch, strftime(win, '%Y-%m-%d') AS day, {STORED}
            FROM {source}""" for writer, batch, source in (
            ("a", 0, "minutes"), ("b", 0, "days"), ("a", 1, "days"), ("c", 0, "days WHERE win < TIMESTAMP '2024-01-10'")))


BODIES = {
    "flow_projection": f"SELECT {FLOW} FROM flows",
    "flow_decode": f"SELECT {FLOW} FROM valid",
    "flow_rejects": """
        SELECT value, CASE dstport WHEN 13 THEN 'unreadable' WHEN 14 THEN 'missing numFlows'
                                   ELSE 'missing srcAddr' END AS reason
        FROM messages WHERE dstport IN (13, 14, 15)""",
    "flow_l4_ports": "SELECT * FROM l4_flows",
    "flow_json_lines": """
        SELECT (SELECT count(*) FROM messages) AS lines,
               (SELECT CAST(sum(length(value)) AS BIGINT) FROM messages) AS characters,
               (SELECT count(*) FROM valid) AS records,
               (SELECT CAST(sum("numBytes") AS BIGINT) FROM valid) AS bytes""",
    "features_by_source": "SELECT * FROM minutes",
    "features_whole_batch": WHOLE,
    "features_volume": "SELECT * FROM volume",
    "features_l4_ports": WHOLE.replace("FROM flows", "FROM l4_flows"),
    "features_inner_join": f'SELECT win, "srcAddr", {STORED} FROM volume',
    "features_outer_join": f'SELECT win, "srcAddr", {THREE} FROM volume',
    "pair_counts": 'SELECT "srcAddr", "dstAddr", count(*) AS records FROM flows GROUP BY 1, 2',
    "bytes_per_flow": """
        SELECT "srcAddr", round(sum("numBytes") / CAST(sum("numFlows") AS DOUBLE), 4) AS "bytesPerFlow"
        FROM flows GROUP BY 1""",
    "comm_time": """
        SELECT "srcAddr", CAST(sum("timestampEnd" - "timestampStart") AS BIGINT) AS "commTime",
               round(sum("timestampEnd" - "timestampStart") / CAST(sum("numFlows") AS DOUBLE), 4)
                   AS "avgCommTime"
        FROM flows GROUP BY 1""",
    "column_stats": union("""
        SELECT '$c' AS feature, count("$c") AS "count", round(avg("$c"), 3) AS mean,
               CAST(min("$c") AS DOUBLE) AS "min", CAST(max("$c") AS DOUBLE) AS "max",
               round(var_samp("$c"), 0) AS variance, round(stddev_samp("$c"), 3) AS stddev
        FROM volume"""),
    "describe": union("""
        SELECT '$c' AS feature, count("$c") AS "count", round(avg("$c"), 3) AS mean,
               round(stddev_samp("$c"), 3) AS stddev, CAST(min("$c") AS DOUBLE) AS "min",
               round(quantile_cont(CAST("$c" AS DOUBLE), 0.25), 3) AS q25,
               round(quantile_cont(CAST("$c" AS DOUBLE), 0.5), 3) AS q50,
               round(quantile_cont(CAST("$c" AS DOUBLE), 0.75), 3) AS q75,
               CAST(max("$c") AS DOUBLE) AS "max"
        FROM volume"""),
    "value_counts": 'SELECT "uniqDstPorts" AS value, count(*) AS "count" FROM volume GROUP BY 1',
    "value_counts_top": """
        SELECT "uniqDstPorts" AS value, count(*) AS "count" FROM volume GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 10""",
    "histogram": """
        SELECT bin, round(low, 6) AS low, round(high, 6) AS high, coalesce("rows", 0) AS "count"
        FROM axis LEFT JOIN filled USING (bin)""",
    "correlation": " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
            round(corr("{a}", "{b}"), 6) AS correlation FROM volume"""
        for a in FEATURES for b in FEATURES),
    "quality_report": union("""
        SELECT '$c' AS feature, count(*) AS "rows",
               count(*) FILTER (WHERE "$c" IS NULL) AS null_rows,
               count(*) FILTER (WHERE "$c" = 0) AS zero_rows
        FROM decoded""", ("numBytes", "numFlows", "dstPort", "tcpFlags")),
    "null_rows": """
        SELECT "srcAddr", "dstAddr", "dstPort", "numFlows" FROM decoded WHERE "numFlows" IS NULL""",
    "zero_rows": """
        SELECT "srcAddr", "dstAddr", "dstPort", "tcpFlags", "timestampStart" FROM decoded
        WHERE "tcpFlags" = 0""",
    "outlier_filter": """
        SELECT win, "srcAddr", "uniqDstPorts" FROM volume WHERE "uniqDstPorts" NOT IN (1, 2, 3)""",
    "shape": 'SELECT count(*) AS "rows", 7 AS "columns" FROM volume',
    "standardize_sample": standardized("stddev_samp"),
    "standardize_pop": standardized("stddev_pop"),
    "scale_only": 'SELECT win, "srcAddr", ' + each('round("$c", 6) AS "$c"', MODEL) + " FROM scaled",
    "interactions": """
        SELECT CAST("srcAddr" AS BIGINT) AS id, "sumOfBytes", "uniqDstIPs", "uniqDstPorts",
               CAST("sumOfBytes" AS DOUBLE) * "uniqDstIPs" AS "sumOfBytes_uniqDstIPs",
               CAST("sumOfBytes" AS DOUBLE) * "uniqDstPorts" AS "sumOfBytes_uniqDstPorts",
               CAST("uniqDstIPs" AS DOUBLE) * "uniqDstPorts" AS "uniqDstIPs_uniqDstPorts"
        FROM volume""",
    "feature_scores": "SELECT feature, round(f_value, 4) AS f_value FROM f_values",
    "feature_select": "SELECT * FROM (" + union(
        """SELECT '$c' AS feature, count("$c") AS "count", round(avg("$c"), 2) AS mean
           FROM labelled""", LABELLED)
        + ") WHERE feature IN (SELECT feature FROM f_values ORDER BY f_value DESC LIMIT 3)",
    "labelled_rows": 'SELECT win, "srcAddr", CAST(a.cluster AS INTEGER) AS cluster, '
        + each('d."$c"', MODEL) + ' FROM d_assigned a JOIN unscaled d USING (win, "srcAddr")',
    "silhouette_days": """
        SELECT count(DISTINCT cluster) AS clusters, count(*) AS "rows",
               round(avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
        FROM (SELECT i, cluster, max(n) FILTER (WHERE mine) AS own,
                     max(s / (n - 1)) FILTER (WHERE mine AND n > 1) AS a,
                     min(s / n) FILTER (WHERE NOT mine) AS b
              FROM (SELECT p.i, p.cluster, q.cluster = p.cluster AS mine, count(*) AS n,
                           sum(""" + each('pow(p."$c" - q."$c", 2)', MODEL, " + ") + """) AS s
                    FROM numbered p, numbered q GROUP BY p.i, p.cluster, q.cluster)
              GROUP BY i, cluster)""",
    "model_costs": " UNION ALL ".join(f"""
        SELECT {k} AS k, round(sum(d), 6) AS wssse, round(avg(sqrt(d)), 6) AS distortion
        FROM (SELECT min({each('pow(p."$c" - c."c_$c", 2)', MODEL, " + ")}) AS d
              FROM scaled p, {centers} c GROUP BY p.win, p."srcAddr")"""
        for k, centers in ((1, "d_middle"), (3, "d_centers"))),
    "sigma_thresholds": """
        SELECT feature, round(mean, 3) AS mean, round(stddev, 3) AS stddev, max, n,
               round(upper, 3) AS upper
        FROM volume_limits""",
    "sigma_detector": "SELECT * FROM flagged",
    "sigma_detector_join": "SELECT * FROM flagged",
    "nearest_center": """
        SELECT win, "srcAddr", CAST(cluster AS INTEGER) AS cluster, round(distance, 6) AS distance
        FROM d_assigned""",
    "cluster_sizes": 'SELECT cluster, count(*) AS "rows" FROM d_assigned GROUP BY 1',
    "cluster_stats": 'SELECT cluster, "rows", ' + ", ".join(
        array_columns(p, n, 6) for p, n in (("x", "feature_max"), ("m", "mean"), ("s", "stddev")))
        + " FROM d_stats",
    "overall_stats": " UNION ALL ".join(
        f"SELECT '{name}' AS data, {array_columns('am', 'mean', digits)}, "
        f"{array_columns('as', 'stddev', digits)} FROM {prefix}_moments"
        for name, prefix, digits in (("raw", "r", 3), ("scaled", "d", 6))),
    "cluster_thresholds": f"""
        SELECT cluster, {array_columns("u", "upper", 6)}, round(threshold, 6) AS threshold
        FROM d_thresholds""",
    "cluster_thresholds_v1": f"""
        SELECT cluster, {array_columns("u", "upper", 6)}, round(threshold, 6) AS threshold
        FROM d_thresholds_v1""",
    "anomalies": " UNION ALL ".join(
        f"""SELECT '{s}' AS setting, win, "srcAddr", cluster, round(distance, 6) AS distance, anomaly
            FROM scored_{s}""" for s in ("centred", "uncentred")),
    "anomalies_unscaled": """
        SELECT win, "srcAddr", cluster, round(distance, 3) AS distance, anomaly FROM scored_unscaled""",
    "anomalies_v1": """
        SELECT win, "srcAddr", cluster, round(distance, 3) AS distance, anomaly FROM scored_v1""",
    "host_lookup": """
        SELECT win, "srcAddr", device,
               CASE WHEN device IS NULL THEN 'unmapped' ELSE 'mapped' END AS status
        FROM days LEFT JOIN hosts ON ip = "srcAddr\"""",
    "drop_rules": rule("SELECT * FROM flagged"),
    "anomaly_rules": rule("SELECT * FROM scored_uncentred WHERE anomaly"),
    "csv_roundtrip": "SELECT " + each('CAST("$c" AS DOUBLE) AS "$c"', MODEL) + " FROM volume",
    "sample_split": " UNION ALL ".join(f"""
        SELECT '{part}' AS part, count(*) AS rows, CAST(sum(l_orderkey * 10 + l_linenumber) AS BIGINT) AS keys
        FROM drawn WHERE {condition}""" for part, condition in (
            ("sample", "draw < 0.1"), ("train", "draw < 0.8"), ("test", "draw >= 0.8"))),
    "row_ids": "SELECT count(*) AS rows, count(*) AS ids FROM flows",
    "kmeans_fit": " UNION ALL ".join(f"""
        SELECT '{training}' AS training, 3 AS clusters, count(*) AS rows, 0 AS empty, 0 AS centers_off,
               0 AS thresholds_off, {each('round(avg("$c"), 3) AS "mean_$c"', MODEL)},
               {each('round(stddev_samp("$c"), 3) AS "stddev_$c"', MODEL)}
        FROM volume""" for training in ("scaled", "raw", "by_spread")),
    "silhouette": "SELECT 3 AS k, count(*) AS rows, true AS agrees FROM volume",
    "elbow_wssse": f"""
        SELECT CAST(k AS INTEGER) AS k, rows, wssse AS one_center, true AS below, true AS agrees FROM one_center, range(2, 20) r(k)""",
    "elbow_distortion": f"""
        SELECT CAST(k AS INTEGER) AS k, rows, distortion AS one_center, true AS below, true AS agrees,
               CASE k WHEN 1 THEN distortion END AS first FROM one_center, range(1, 10) r(k)""",
    "elbow_iterations": f"""
        SELECT CAST(n AS INTEGER) AS max_iter, CAST(k AS INTEGER) AS k, rows, wssse AS one_center, true AS below,
               CASE k WHEN 1 THEN wssse END AS first
        FROM one_center, range(1, 50) r(k), range(300, 1000, 100) s(n)""",
    "feature_store_append": f"""
        SELECT * FROM ({store_rows()}) WHERE day >= '2024-01-05' AND day < '2024-01-20'""",
    "feature_store_compacted": store_rows(),
    "rule_store_append": """
        SELECT w.writer, CAST(0 AS BIGINT) AS batch, f.* FROM found_rules f, (VALUES ('a'), ('b')) w(writer)
        WHERE f.win < TIMESTAMP '2024-01-14'
        UNION ALL
        SELECT 'new' AS writer, CAST(-1 AS BIGINT) AS batch, f.* FROM found_rules f
        WHERE path IS NULL OR path NOT IN (
          SELECT path FROM found_rules WHERE win < TIMESTAMP '2024-01-14' AND path IS NOT NULL)""",
    "value_counts_gaps": """
        SELECT "uniqDstPorts" AS value, count(*) AS "count" FROM gapped WHERE "uniqDstPorts" IS NOT NULL GROUP BY 1""",
    "correlation_gaps": " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
            round(corr("{a}", "{b}"), 6) AS correlation FROM gapped""" for a in FEATURES for b in FEATURES),
    "quality_report_text": union("""
        SELECT '$c' AS feature, count(*) AS "rows", count(*) FILTER (WHERE "$c" IS NULL) AS null_rows, 0 AS zero_rows
        FROM decoded""", ("srcAddr", "dstAddr")) + " UNION ALL " + union("""
        SELECT '$c' AS feature, count(*) AS "rows", count(*) FILTER (WHERE "$c" IS NULL) AS null_rows,
               count(*) FILTER (WHERE "$c" = 0) AS zero_rows FROM gapped"""),
    "sigma_thresholds_gaps": """
        SELECT feature, round(mean, 3) AS mean, round(stddev, 3) AS stddev, max, n, round(upper, 3) AS upper
        FROM gapped_limits""",
    "standardize_gaps": 'SELECT win, "srcAddr", ' + each("""
        round(("$c" - avg("$c") OVER ()) / stddev_samp("$c") OVER (), 6) AS "$c\"""") + " FROM gapped",
    "flow_decode_all": "SELECT " + ", ".join(
        f'"{k}"' if k in EVENT_KEYS else f"'{k}' || srcport AS \"{k}\"" if k in STRING_KEYS
        else f'srcport * 100 + {i} AS "{k}"' for i, k in enumerate((*LONG_KEYS, *STRING_KEYS))) + " FROM raw",
    "event_stamp": """
        SELECT "srcAddr", "srcPort", "timestampStart", strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM flows""",
    "host_files": "SELECT ip, device FROM hosts",
    "vector_columns": "SELECT win, \"srcAddr\", " + each('CAST("$c" AS DOUBLE) AS "$c"', MODEL) + " FROM days",
    "stream_features": closed("stream_minutes", "60 seconds", f'win, "srcAddr", {ALL}'),
    "stream_joined": closed("stream_hours", "1 hour", f'win, "srcAddr", {ALL}'),
    "stream_anomalies": closed("scored_stream", "1 day", """
        win, "srcAddr", cluster, round(distance, 6) AS distance, anomaly"""),
    "stream_rules": rule(closed("scored_stream_weeks", "7 days") + " AND anomaly"),
    "stream_arrival": f"""
        SELECT CAST(0 AS BIGINT) AS batch, {STORED} FROM ({WHOLE.replace("FROM flows", "FROM valid")})""",
}

BODIES["rows_of_cluster"] = f'SELECT win, "srcAddr", cluster FROM ({BODIES["nearest_center"]}) n WHERE cluster = 1'
BODIES["stream_arrival_seconds"] = BODIES["stream_arrival"]


# Messages in the parts they arrive in: every 50th a part late, every 501st dated 400 days ahead.
CTES["arrived"] = """
    SELECT r.*, date_trunc('milliseconds', r.ts) + CASE WHEN event_id % 501 = 7 THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS stamped,
           date_diff('day', DATE '2024-01-01', CAST(r.ts AS DATE)) // 8 + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS part
    FROM (SELECT *, '10.0.0.' || CAST(user_id % 12 + 1 AS VARCHAR) AS "srcAddr", '10.0.1.' || CAST(event_id % 251 AS VARCHAR) AS "dstAddr",
                 CAST(json_extract_string(props, '$.k') AS BIGINT) AS "dstPort", CAST(round(value * 100) AS BIGINT) AS "numBytes",
                 1 + event_id % 3 AS "numFlows" FROM events) r"""
CTES["sorted_out"] = """
    SELECT *, CAST(date_trunc('day', stamped) AS TIMESTAMP) AS win,
           CASE "dstPort" WHEN 13 THEN 'unreadable' WHEN 14 THEN 'missing numFlows' WHEN 15 THEN 'missing srcAddr'
           ELSE CASE WHEN stamped > TIMESTAMP '2024-01-01' + INTERVAL 8 DAY * (part + 1) + INTERVAL 10 MINUTE
                     THEN 'ahead of arrival' END END AS reason
    FROM arrived"""
CTES["part_marks"] = """
    SELECT p.part, max(s.stamped) - INTERVAL 6 HOUR AS mark
    FROM (SELECT DISTINCT part FROM sorted_out UNION SELECT 1000000) p
    JOIN sorted_out s ON s.part < p.part AND s.reason IS NULL GROUP BY p.part"""
CTES["told_apart"] = """
    SELECT s.*, CASE WHEN reason IS NOT NULL THEN 'rejected'
                     WHEN win + INTERVAL 1 DAY <= m.mark THEN 'late' ELSE 'timely' END AS kind
    FROM sorted_out s LEFT JOIN part_marks m USING (part)"""
CTES["timely_days"] = grouped("win", "told_apart WHERE kind = 'timely'")
CTES["many_flows"] = """
    SELECT win, "srcAddr", row_number() OVER (PARTITION BY "srcAddr" ORDER BY win) AS i FROM timely_days
    WHERE "sumOfFlows" > 5 AND win + INTERVAL 1 DAY <= (SELECT mark FROM part_marks WHERE part = 1000000)"""
# Day by day per source: the last kept day, which is this one if three days have passed.
CTES["held_off"] = """
    SELECT * FROM (WITH RECURSIVE walk AS (
        SELECT win, "srcAddr", i, win AS last FROM many_flows WHERE i = 1
        UNION ALL
        SELECT m.win, m."srcAddr", m.i, CASE WHEN m.win >= w.last + INTERVAL 3 DAY THEN m.win ELSE w.last END
        FROM walk w JOIN many_flows m ON m."srcAddr" = w."srcAddr" AND m.i = w.i + 1)
      SELECT win, "srcAddr" FROM walk WHERE last = win)"""
BODIES["stream_hold_off"] = rule("SELECT * FROM held_off")
BODIES["stream_late"] = f"""
    SELECT CASE WHEN win + INTERVAL 1 DAY <= (SELECT mark FROM part_marks WHERE part = 1000000) THEN 'window' ELSE 'open' END AS kind,
           win, "srcAddr", {ALL}, CAST(NULL AS VARCHAR) AS reason
    FROM ({grouped("win", "told_apart WHERE kind = 'timely'")}) w
    UNION ALL
    SELECT 'late', win, "srcAddr", CAST(sum("numFlows") AS BIGINT), CAST(sum("numBytes") AS BIGINT), NULL, NULL, count(*), NULL
    FROM told_apart WHERE kind = 'late' GROUP BY win, "srcAddr"
    UNION ALL
    SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, NULL, count(*), reason FROM told_apart WHERE kind = 'rejected' GROUP BY reason
    UNION ALL
    SELECT 'count', NULL, NULL, NULL, NULL, NULL, NULL, n, c
    FROM (SELECT count(*) AS read, count(*) FILTER (kind = 'timely') AS timely, count(*) FILTER (kind = 'late') AS late,
                 count(*) FILTER (kind = 'rejected') AS rejected FROM told_apart)
    UNPIVOT (n FOR c IN (read, timely, late, rejected))"""
def given_centers(k: int, centers: list) -> str:
    away = ", ".join(f'pow("uniqDstIPs" - {a}, 2) + pow("uniqDstPorts" - {b}, 2)' for a, b in centers)
    return f"""
        SELECT {k} AS k, round(sum(d), 6) AS wssse, round(avg(sqrt(d)), 6) AS distortion,
               count(DISTINCT ("uniqDstIPs", "uniqDstPorts")) AS vectors, count(*) AS rows
        FROM (SELECT *, least({away}) AS d FROM volume)"""


BODIES["csv_rejects"] = f"""
    SELECT {each('CAST("$c" AS DOUBLE) AS "$c"', MODEL)}, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
    FROM volume WHERE "sumOfBytes" % 7 > 3
    UNION ALL
    SELECT NULL, NULL, NULL,
           CASE "sumOfBytes" % 7 WHEN 0 THEN 'abc,' || "uniqDstIPs" || ',' || "uniqDstPorts"
                WHEN 1 THEN "sumOfBytes" || ',' || "uniqDstIPs" WHEN 2 THEN "sumOfBytes" || ',' || "uniqDstIPs" || ',' || "uniqDstPorts" || ',9'
                ELSE "sumOfBytes" || ',,' || "uniqDstPorts" END,
           CASE "sumOfBytes" % 7 WHEN 0 THEN 'not a number' WHEN 1 THEN '2 fields' WHEN 2 THEN '4 fields' ELSE 'empty field' END
    FROM volume WHERE "sumOfBytes" % 7 <= 3"""
BODIES["weighted_costs"] = given_centers(1, [(2, 3)]) + " UNION ALL " + given_centers(3, [(1, 1), (4, 4), (9, 10)])
CTES["repeated"] = """
    SELECT "srcAddr", protocol, count(*) AS n,
           CAST('0x' || substr(md5('42|' || "srcAddr" || '|' || protocol), 1, 8) AS BIGINT) / 4294967296.0 AS draw
    FROM flows GROUP BY 1, 2"""
BODIES["sample_repeated"] = " UNION ALL ".join(f"""
    SELECT '{part}' AS part, "srcAddr", protocol, CAST({n} AS BIGINT) AS rows FROM repeated WHERE {n} > 0""" for part, n in (
        ("sample", "floor(n * 0.1::DOUBLE + draw)"), ("train", "floor(n * 0.8::DOUBLE + draw)"),
        ("test", "n - floor(n * 0.8::DOUBLE + draw)")))
BODIES["flow_counts"] = """
    SELECT unnest(['batch', 'stream']) AS job, count(*) AS read, count(*) FILTER ("dstPort" NOT IN (13, 14, 15)) AS valid,
           count(*) FILTER ("dstPort" = 13) AS unreadable, count(*) FILTER ("dstPort" IN (14, 15)) AS missing,
           CAST(0 AS BIGINT) AS ahead
    FROM raw_ports"""
CTES["raw_ports"] = """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS "dstPort" FROM events"""


def scored_by_version(source: str) -> str:
    """Days of ``source`` scored by the given versions, in SQL."""
    # Fixed values, as in the query: since, (centre, threshold) of each cluster, mean, deviation.
    given = (
        ("2024-01-03", (((0.5, 0.5, 0.5), 0.5), ((2.0, 1.0, 1.0), 1.5)), (20000.0, 10.0, 3.0), (20000.0, 10.0, 1.0)),
        ("2024-01-12", (((0.0, 1.0, 0.0), 0.25), ((1.0, 0.0, 1.0), None)), (1000.0, 2.0, 1.0), (50000.0, 5.0, 2.0)),
        ("2024-01-19", (((0.1, 0.1, 0.1), 2.0),), (5000.0, 4.0, 2.0), (9000.0, 3.0, 2.0)),
    )
    parts = [f"""
        SELECT win, "srcAddr", CAST(NULL AS TIMESTAMP) AS since, CAST(NULL AS INTEGER) AS cluster,
               CAST(NULL AS DOUBLE) AS distance, false AS anomaly FROM ({source}) s WHERE win < TIMESTAMP '2024-01-03'"""]
    for (since, clusters, mean, stddev), upto in zip(given, ("2024-01-12", "2024-01-19", "2999-01-01")):
        z = [f'(("{c}" - {m}::DOUBLE) / {d}::DOUBLE)' for c, m, d in zip(MODEL, mean, stddev)]
        below = " AND ".join(f"{x} < {max(c[i] for c, _ in clusters)}::DOUBLE" for i, x in enumerate(z))
        for number, (middle, limit) in enumerate(clusters):
            away = " + ".join(f"pow({x} - {v}::DOUBLE, 2)" for x, v in zip(z, middle))
            parts.append(f"""
                SELECT win, "srcAddr", TIMESTAMP '{since}' AS since, {number}::INTEGER AS cluster,
                       CASE WHEN {below} THEN 0.0::DOUBLE ELSE sqrt({away}) END AS distance,
                       {"false" if limit is None else f"CASE WHEN {below} THEN 0.0::DOUBLE ELSE sqrt({away}) END > {limit}::DOUBLE"} AS anomaly
                FROM ({source}) s WHERE win >= TIMESTAMP '{since}' AND win < TIMESTAMP '{upto}'""")
    return f"""
        SELECT win, "srcAddr", since, cluster, round(distance, 6) AS distance, anomaly
        FROM ({" UNION ALL ".join(parts)}) a
        QUALIFY row_number() OVER (PARTITION BY win, "srcAddr" ORDER BY a.distance, cluster) = 1"""


BODIES["anomalies_by_version"] = scored_by_version("SELECT * FROM days")
BODIES["stream_model_change"] = scored_by_version(
    "SELECT * FROM timely_days WHERE win + INTERVAL 1 DAY <= (SELECT mark FROM part_marks WHERE part = 1000000)")
BODIES["features_merged"] = """
    SELECT win, "srcAddr", "sumOfFlows", "sumOfBytes", "numRecords", "uniqDstIPs" AS "exact_uniqDstIPs",
           "uniqDstPorts" AS "exact_uniqDstPorts", true AS "near_uniqDstIPs", true AS "near_uniqDstPorts" FROM days"""
BODIES["stream_sketches"] = f"""
    SELECT CAST(date_trunc('day', win) AS TIMESTAMP) AS win, "srcAddr",
           CAST(sum("sumOfFlows") AS BIGINT) AS "sumOfFlows", CAST(sum("sumOfBytes") AS BIGINT) AS "sumOfBytes",
           CAST(sum("numRecords") AS BIGINT) AS "numRecords"
    FROM ({closed("stream_minutes", "60 seconds")}) m GROUP BY 1, 2"""


def with_tables(body: str) -> str:
    """Put the common table expressions the body needs in front of it, in order."""
    import re

    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?<![\w'\"]){name}(?![\w'\"(])", sql):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {head}\n{body}"


ORACLES = {name: with_tables(body) for name, body in BODIES.items()}
