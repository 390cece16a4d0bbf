"""SQL counterparts of the registered queries."""

from __future__ import annotations

from checks.tables import EVENTS_SQL, FLOWS_SQL

KEY = "flow_id, src_port, dst, src, price"
BIGKEY = "flow_id, CAST(src_port AS BIGINT) AS src_port, dst, src, price"
ORDER = "duration, flow_id, src_port, dst, src, price"


def _flows(body: str, more: str = "") -> str:
    return f"WITH {FLOWS_SQL.strip()}{more} {body}"


def _events(body: str, more: str = "") -> str:
    return f"WITH {EVENTS_SQL.strip()}{more} {body}"


def _flow_counts(key: str, limit: int | None = None) -> str:
    tail = f" ORDER BY count(*) DESC, {key} NULLS FIRST LIMIT {limit}" if limit else ""
    return _flows(f'SELECT {key}, count(*) AS "count" FROM flows GROUP BY {key}{tail}')


NUMERIC = (
    "flow_id", "src", "dst", "src_port", "dst_port", "price", "duration", "src_bytes",
    "dst_bytes", "load_bytes", "label", "conn_count", "srv_count", "dst_host_count",
    "serror_rate", "rerror_rate",
)
TEXT = ("proto", "state", "service", "attack_cat", "category", "attack_type")
ALL = (
    "flow_id", "src", "dst", "src_port", "dst_port", "proto", "state", "service", "price",
    "duration", "src_bytes", "dst_bytes", "load_bytes", "ts", "attack_cat", "category",
    "attack_type", "label", "conn_count", "srv_count", "dst_host_count", "serror_rate",
    "rerror_rate",
)
CODED = ("proto", "service", "attack_cat")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _numeric(name: str) -> str:
    return (
        f"SELECT '{name}' AS \"column\", round(favg({name}), 9) AS mean, "
        f"round(stddev_samp({name}), 4) AS std, CAST(min({name}) AS DOUBLE) AS \"min\", "
        f"CAST(max({name}) AS DOUBLE) AS \"max\", count({name}) AS \"count\" FROM flows"
    )


def _top_values(columns: tuple[str, ...], k: int) -> str:
    counted = _union(
        [
            f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" "
            f"FROM flows GROUP BY {c}"
            for c in columns
        ]
    )
    return _flows(
        f'SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" '
        f'ORDER BY "count" DESC, value NULLS FIRST) AS rank FROM ({counted})) WHERE rank <= {k}'
    )


def _missing(name: str) -> str:
    return f"SELECT '{name}' AS \"column\", count(*) - count({name}) AS missing FROM flows"


def _codes(name: str) -> str:
    """Codes by falling frequency as a common table ``code_<name>``."""
    return (
        f", code_{name} AS (SELECT {name} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, "
        f"CAST({name} AS VARCHAR)) - 1 AS DOUBLE) AS i FROM flows WHERE {name} IS NOT NULL "
        f"GROUP BY {name})"
    )


def _code(name: str) -> str:
    return (
        f"coalesce((SELECT i FROM code_{name} WHERE v = {name}), "
        f"(SELECT CAST(count(*) AS DOUBLE) FROM code_{name}))"
    )


def _indexed(names: dict[str, str]) -> str:
    columns = ", ".join(f"{_code(name)} AS {out}" for name, out in names.items())
    return _flows(f"SELECT {BIGKEY}, {columns} FROM flows", "".join(map(_codes, names)))


def _one_hot(names: tuple[str, ...]) -> str:
    codes = ", ".join(
        f"{_code(n)} AS i_{n}, (SELECT count(*) FROM code_{n}) AS n_{n}" for n in names
    )
    columns = ", ".join(
        f"array_to_string(list_transform(range(n_{n}), "
        f"lambda k: CASE WHEN k = i_{n} THEN 1 ELSE 0 END), ',') AS {n}_encoded"
        for n in names
    )
    return _flows(
        f"SELECT {BIGKEY}, {columns} FROM (SELECT *, {codes} FROM flows)",
        "".join(map(_codes, names)),
    )


def _iqr(source: str, name: str) -> str:
    q1 = f"(SELECT quantile_disc({name}, 0.25) FROM {source})"
    q3 = f"(SELECT quantile_disc({name}, 0.75) FROM {source})"
    return (
        f"SELECT * FROM {source} WHERE {name} >= {q1} - 1.5 * ({q3} - {q1}) "
        f"AND {name} <= {q3} + 1.5 * ({q3} - {q1})"
    )


def _sketched(name: str) -> str:
    """Rows within the narrowest and the widest whiskers of quartiles a hundredth of the ranks away."""
    q = {r: f"(SELECT quantile_disc({name}, {r}) FROM flows)" for r in (0.24, 0.26, 0.74, 0.76)}
    inner, outer = f"1.5 * ({q[0.74]} - {q[0.26]})", f"1.5 * ({q[0.76]} - {q[0.24]})"
    return (
        f"SELECT '{name}' AS \"column\", count({name}) AS n, "
        f"count(*) FILTER ({name} >= {q[0.26]} - {inner} AND {name} <= {q[0.74]} + {inner}) AS kept_least, "
        f"count(*) FILTER ({name} >= {q[0.24]} - {outer} AND {name} <= {q[0.76]} + {outer}) AS kept_most, "
        "true AS near FROM flows"
    )


SEGMENT = """CASE WHEN src_bytes + dst_bytes < 1000 THEN '小流量(<1KB)'
 WHEN src_bytes + dst_bytes < 10000 THEN '中流量(1-10KB)'
 WHEN src_bytes + dst_bytes < 100000 THEN '大流量(10-100KB)' ELSE '超大流量(>100KB)' END"""

INDEXED = f"""
, indexed AS (
  SELECT {KEY}, duration, src_bytes + dst_bytes AS total_bytes,
         row_number() OVER (ORDER BY {ORDER}) AS time_index FROM flows)
, averaged AS (
  SELECT *, avg(total_bytes) OVER (ORDER BY time_index
         ROWS BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS bytes_moving_avg FROM indexed)
"""

SEQUENCED = """
, sequenced AS (
  SELECT event_id, src, array_to_string(list(attack_type) OVER (PARTITION BY src
         ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), '->')
         AS attack_sequence FROM evt)
"""

WINDOWED = """
, slid AS (
  SELECT unnest([time_bucket(INTERVAL 30 MINUTES, ts),
                 time_bucket(INTERVAL 30 MINUTES, ts) - INTERVAL 30 MINUTES]) AS window_start,
         attack_type, src_bytes, dst_bytes, duration FROM evt)
, windowed AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, attack_type,
         count(*) AS connection_count, CAST(sum(src_bytes) AS BIGINT) AS total_src_bytes,
         CAST(sum(dst_bytes) AS BIGINT) AS total_dst_bytes, avg(duration) AS avg_duration,
         sum(src_bytes) / count(*) AS bytes_per_connection
  FROM slid GROUP BY window_start, attack_type
  HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECONDS FROM evt))
, alerts AS (
  SELECT window_start, window_end, attack_type, connection_count,
         CASE WHEN connection_count > 4 AND avg_duration < 40 THEN 'HIGH'
              WHEN bytes_per_connection > 60 AND connection_count > 2 THEN 'MEDIUM'
              ELSE 'LOW' END AS alert_level FROM windowed)
"""

ALERTS = """SELECT *, CASE alert_level WHEN 'HIGH' THEN 'Possible DDoS attack detected'
  WHEN 'MEDIUM' THEN 'Suspicious traffic pattern' ELSE 'Normal' END AS alert_reason FROM alerts"""


def _finding(name: str, value: str) -> str:
    return (
        f"(SELECT '{name}' AS finding, CAST({value} AS VARCHAR) AS value, count(*) AS \"count\", "
        f"count(*) / (SELECT count(*) FROM evt) AS share FROM evt GROUP BY {value} "
        f"ORDER BY count(*) DESC, {value} LIMIT 1)"
    )


CHARTS = """
(SELECT 'label' AS series, CAST(label AS VARCHAR) AS "key", count(*) AS "count"
 FROM flows GROUP BY label ORDER BY count(*) DESC, label LIMIT 10)
UNION ALL
(SELECT 'hour', CAST(hour(ts) AS VARCHAR), count(*) FROM evt GROUP BY hour(ts))
UNION ALL
(SELECT 'host', CAST(src AS VARCHAR), count(*) FROM flows GROUP BY src
 ORDER BY count(*) DESC, src LIMIT 10)
"""

HIGH = "(SELECT quantile_disc(conn_count, 0.95) FROM flows)"
TOP = 'SELECT max(n) AS top FROM (SELECT count(*) AS n FROM flows GROUP BY label)'

CLUSTERED = """
, clustered AS (
  SELECT *, src_bytes + CASE WHEN label = 1 THEN 1000000000 ELSE 0 END AS far_bytes,
         CAST(label AS BIGINT) AS prediction FROM flows)
"""

CSV_SQL = (
    "SELECT CAST(src AS VARCHAR) AS srcip, CAST(src_port AS BIGINT) AS sport, "
    "CAST(dst AS VARCHAR) AS dstip, CAST(dst_port AS BIGINT) AS dsport, proto, state, "
    "duration AS dur, src_bytes AS sbytes, dst_bytes AS dbytes, service, price AS sload, "
    "flow_id AS stcpb, CAST(label AS BIGINT) AS label, CASE WHEN attack_cat IS NULL "
    "OR attack_cat = 'Normal' THEN 'normal' ELSE attack_cat END AS attack_category FROM flows"
)

ORACLES: dict[str, str] = {
    "overview": _flows(
        f"SELECT count(*) AS records, CAST({len(ALL)} AS BIGINT) AS columns FROM flows"
    ),
    "numeric_profile": _flows(_union([_numeric(n) for n in NUMERIC])),
    "categorical_top": _top_values(TEXT, 10),
    "missing_counts": _flows(_union([_missing(n) for n in ALL])),
    "data_stats": _flows(
        "SELECT count(*) AS total, count(*) FILTER (category <> 'normal') AS attacks, "
        "count(*) FILTER (category = 'normal') AS normal, "
        "count(*) FILTER (category <> 'normal') / count(*) AS attack_ratio, "
        f"CAST({len(ALL) - 1} AS BIGINT) AS features FROM flows"
    ),
    "attack_type_counts": _flow_counts("attack_type"),
    "hour_distribution": _events(
        'SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS "count" FROM evt GROUP BY ALL'
    ),
    "weekday_distribution": _events(
        'SELECT CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week, count(*) AS "count" '
        "FROM evt GROUP BY ALL"
    ),
    "attack_hours": _events(
        'SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS "count" FROM evt '
        "WHERE category <> 'normal' GROUP BY ALL"
    ),
    "protocol_distribution": _flow_counts("proto"),
    "protocol_attack_relation": _flow_counts("proto, category"),
    "service_distribution": _flow_counts("service", 20),
    "port_distribution": _top_values(("src_port", "dst_port"), 10),
    "label_distribution": _flows(
        'SELECT CAST(label AS BIGINT) AS label, count(*) AS "count" FROM flows GROUP BY label'
    ),
    "category_distribution": _flow_counts("category"),
    "segment_distribution": _flows(
        f'SELECT {SEGMENT} AS traffic_segment, count(*) AS "count" FROM flows GROUP BY ALL'
    ),
    "dos_profile": _flows(
        "SELECT avg(src_bytes) AS avg_src_bytes, avg(dst_bytes) AS avg_dst_bytes, "
        'avg(duration) AS avg_duration, count(*) AS "count" FROM flows '
        "WHERE category = 'DoS' OR attack_type = 'neptune.' HAVING count(*) > 0"
    ),
    "probe_profile": _flows(
        "SELECT avg(conn_count) AS avg_count, avg(srv_count) AS avg_srv_count, "
        'avg(dst_host_count) AS avg_dst_host_count, count(*) AS "count" FROM flows '
        "WHERE category = 'Reconnaissance' OR attack_type = 'ipsweep.' HAVING count(*) > 0"
    ),
    "attack_rows": _flows(f"SELECT {BIGKEY}, category FROM flows WHERE category <> 'normal'"),
    "top_sources": _flows(
        "SELECT src, count(*) AS connection_count, "
        "CAST(sum(src_bytes) AS BIGINT) AS total_src_bytes, "
        "CAST(sum(dst_bytes) AS BIGINT) AS total_dst_bytes "
        "FROM flows GROUP BY src ORDER BY count(*) DESC, src LIMIT 10"
    ),
    "top_destinations": _flows(
        "SELECT dst, count(*) AS connection_count, "
        "CAST(sum(dst_bytes) AS BIGINT) AS total_dst_bytes "
        "FROM flows GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 10"
    ),
    "top_pairs": _flows(
        "SELECT src, dst, count(*) AS connection_count, avg(duration) AS avg_duration "
        "FROM flows GROUP BY src, dst ORDER BY count(*) DESC, src, dst LIMIT 10"
    ),
    "high_frequency": _flows(
        f'SELECT CAST({HIGH} AS DOUBLE) AS threshold, count(*) FILTER (conn_count > {HIGH}) '
        f'AS "count", count(*) FILTER (conn_count > {HIGH}) / count(*) AS share FROM flows'
    ),
    "high_error": _flows(
        'SELECT count(*) FILTER (serror_rate > 0.065 OR rerror_rate > 0.065) AS "count", '
        "count(*) FILTER (serror_rate > 0.065 OR rerror_rate > 0.065) / count(*) AS share "
        "FROM flows"
    ),
    "binary_label": _flows(
        f"SELECT {BIGKEY}, attack_type, CAST(CASE WHEN attack_type IN ('normal', 'normal.') "
        "THEN 0 ELSE 1 END AS BIGINT) AS label FROM flows"
    ),
    "attack_category": _flows(f"SELECT {BIGKEY}, category AS attack_category FROM flows"),
    "time_features": _events(
        "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, "
        "CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week, "
        "CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend "
        "FROM evt"
    ),
    "hour_of_epoch": _events(
        "SELECT CAST(hour(make_timestamp(stime * 1000000)) AS BIGINT) AS hour, "
        'count(*) AS "count" FROM evt GROUP BY ALL'
    ),
    "total_bytes": _flows(f"SELECT {BIGKEY}, src_bytes + dst_bytes AS total_bytes FROM flows"),
    "bytes_ratio": _flows(
        f"SELECT {BIGKEY}, CASE WHEN dst_bytes > 0 THEN src_bytes / dst_bytes ELSE 0.0::DOUBLE END "
        "AS bytes_ratio FROM flows"
    ),
    "connection_intensity": _flows(
        f"SELECT {BIGKEY}, CAST(conn_count + srv_count AS BIGINT) AS connection_intensity "
        "FROM flows"
    ),
    "traffic_segment": _flows(f"SELECT {BIGKEY}, {SEGMENT} AS traffic_segment FROM flows"),
    "ipv4_check": _flows(
        f"SELECT {BIGKEY}, address, len(o) = 4 AS shaped, "
        "len(o) = 4 AND list_max(o) < 256 AS valid, "
        "CASE WHEN len(o) = 4 AND list_max(o) < 256 "
        "THEN ((o[1] * 256 + o[2]) * 256 + o[3]) * 256 + o[4] END AS number "
        "FROM (SELECT *, CAST(string_split(address, '.') AS BIGINT[]) AS o FROM (SELECT *, "
        "CASE WHEN proto = 'A' THEN concat_ws('.', src, dst) "
        "ELSE concat_ws('.', src % 300, dst % 700, src_port, conn_count) END AS address "
        "FROM flows))"
    ),
    "drop_unlabelled": _flows(
        f"SELECT {BIGKEY}, attack_type FROM flows WHERE attack_type IS NOT NULL"
    ),
    "impute_mean": _flows(
        f"SELECT {BIGKEY}, CAST(coalesce(load_bytes, "
        "(SELECT CAST(trunc(avg(load_bytes)) AS BIGINT) FROM flows)) AS BIGINT) AS load_bytes, "
        "duration FROM flows"
    ),
    "iqr_filter": _flows(
        f"SELECT {BIGKEY}, dst_bytes FROM ({_iqr('flows', 'dst_bytes')})"
    ),
    "iqr_filter_sketched": _flows(
        _union([_sketched(n) for n in ("src_bytes", "dst_bytes", "duration")])
    ),
    "remove_outliers": _flows(
        f"SELECT {BIGKEY}, src_bytes, dst_bytes, duration FROM ({_iqr('f2', 'duration')})",
        f", f1 AS ({_iqr('flows', 'src_bytes')}), f2 AS ({_iqr('f1', 'dst_bytes')})",
    ),
    "index_categories": _indexed(
        {n: f"{n}_indexed" for n in ("proto", "service", "state")}
    ),
    "index_categories_keep": _indexed({n: f"{n}_index" for n in CODED}),
    "one_hot": _one_hot(CODED),
    "index_labels": _indexed({"label": "label_index", "category": "attack_category_index"}),
    "class_balance": _flows(
        "SELECT count(*) AS classes, max(n) AS largest, min(n) AS smallest, "
        "max(n) / min(n) AS ratio, count(*) >= 2 AND max(n) / min(n) > 5 AS oversample "
        "FROM (SELECT count(*) AS n FROM flows GROUP BY label)"
    ),
    "oversample": _flows(
        f"SELECT {BIGKEY}, CAST(label AS BIGINT) AS label, src_bytes FROM (SELECT *, "
        "unnest(range(top // n + CASE WHEN rn <= top % n THEN 1 ELSE 0 END)) AS copy FROM ranked)",
        f", biggest AS ({TOP}), ranked AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, "
        f"row_number() OVER (PARTITION BY label ORDER BY {KEY}) AS rn, "
        "(SELECT top FROM biggest) AS top FROM flows)",
    ),
    "time_index": _flows(
        "SELECT duration, flow_id, CAST(src_port AS BIGINT) AS src_port, dst, src, price, "
        f"row_number() OVER (ORDER BY {ORDER}) AS time_index FROM flows"
    ),
    "moving_average": _flows(
        "SELECT time_index, total_bytes, bytes_moving_avg FROM averaged", INDEXED
    ),
    "trend_points": _flows(
        "SELECT time_index, bytes_moving_avg FROM averaged "
        "WHERE time_index % 10 = 0 AND time_index <= 1000",
        INDEXED,
    ),
    "gaps": _events(
        "SELECT event_id, prev_time, CAST(floor(epoch(ts)) - floor(epoch(prev_time)) AS BIGINT) "
        "AS time_diff FROM (SELECT *, lag(ts) OVER (PARTITION BY src ORDER BY ts, event_id) "
        "AS prev_time FROM evt)"
    ),
    "rolling_sequence": _events("SELECT event_id, src, attack_sequence FROM sequenced", SEQUENCED),
    "frequent_sequences": _events(
        "SELECT attack_sequence, count(*) AS frequency, count(DISTINCT src) AS source_count, "
        "array_to_string(list_sort(list(DISTINCT src)), ',') AS source_ips FROM sequenced "
        "WHERE length(attack_sequence) > 10 GROUP BY attack_sequence",
        SEQUENCED,
    ),
    "enrich_geo": _flows(
        f"SELECT {BIGKEY}, concat_ws('.', 10, dst // 65536 % 256, dst // 256 % 256, dst % 256) "
        "AS dst_ip, n_name AS country, s_name AS city, s_acctbal AS latitude, "
        "CAST(n_regionkey AS DOUBLE) AS longitude FROM flows LEFT JOIN (supplier JOIN nation "
        "ON s_nationkey = n_nationkey) ON dst BETWEEN s_suppkey * 20 AND s_suppkey * 20 + 14"
    ),
    "enrich_owner": _flows(
        f"SELECT {BIGKEY}, 'AS' || s_suppkey AS asn, s_name AS organization, n_name AS isp "
        "FROM flows LEFT JOIN (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        "WHERE s_acctbal >= 0) ON src = s_suppkey"
    ),
    "flag_threats": _flows(
        f"SELECT {BIGKEY}, src IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) "
        "AS is_malicious_ip FROM flows"
    ),
    "enrich_owner_nested": _flows(
        f"SELECT {BIGKEY}, CASE WHEN dst // 64 NOT IN (SELECT s_suppkey FROM supplier) THEN 'all' "
        "WHEN dst % 64 BETWEEN 20 AND 27 THEN 'inner-' || dst // 64 "
        "WHEN dst % 64 BETWEEN 4 AND 51 THEN 'middle-' || dst // 64 "
        "ELSE 'outer-' || dst // 64 END AS asn FROM flows"
    ),
    "categorize": _flows(
        f"SELECT {BIGKEY}, attack_type, CASE attack_type WHEN 'neptune.' THEN 'dos' "
        "WHEN 'ipsweep.' THEN 'probe' WHEN 'normal' THEN 'normal' "
        "WHEN 'normal.' THEN 'normal' END AS attack_category FROM flows"
    ),
    "categorize_default": _flows(
        f"SELECT {BIGKEY}, attack_type, CASE attack_type WHEN 'neptune.' THEN 'dos' "
        "WHEN 'ipsweep.' THEN 'probe' WHEN 'normal' THEN 'normal' "
        "WHEN 'normal.' THEN 'normal' ELSE 'unknown' END AS attack_category FROM flows"
    ),
    "windowed_traffic": _events(
        "SELECT window_start, window_end, attack_type, connection_count, total_src_bytes, "
        "total_dst_bytes, round(avg_duration, 9) AS avg_duration, "
        "round(bytes_per_connection, 9) AS bytes_per_connection FROM windowed",
        WINDOWED,
    ),
    "windowed_counts": _events(
        "SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, is_attack, "
        'count(*) AS "count" FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, '
        "category <> 'normal' AS is_attack FROM evt) GROUP BY window_start, is_attack "
        "HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 SECONDS FROM evt)"
    ),
    "alert_rules": _events(ALERTS, WINDOWED),
    "alert_json": _events(ALERTS, WINDOWED),
    "key_findings": _events(
        _union(
            [
                _finding("top_label", "attack_type"),
                _finding("peak_hour", "hour(ts)"),
                _finding("main_protocol", "category"),
            ]
        )
    ),
    "summary": _flows(
        "SELECT count(*) AS records, count(DISTINCT label) AS labels, "
        f"CAST({len(ALL)} AS BIGINT) AS features FROM flows"
    ),
    "kpis": _flows(
        "SELECT 'total' AS kpi, CAST(count(*) AS DOUBLE) AS value FROM flows UNION ALL "
        "SELECT 'attacks', CAST(count(*) AS DOUBLE) FROM flows WHERE category <> 'normal' "
        "UNION ALL SELECT 'attack_ratio', count(*) FILTER (category <> 'normal') / count(*) "
        "FROM flows UNION ALL SELECT 'high_frequency_ratio', "
        f"count(*) FILTER (conn_count > {HIGH}) / count(*) FROM flows"
    ),
    "chart_series": _flows(CHARTS, "," + EVENTS_SQL),
}

_CONNECTIONS = (
    "SELECT duration, proto AS protocol_type, service, state AS flag, CAST(src_bytes AS DOUBLE) AS src_bytes, "
    "CAST(dst_bytes AS DOUBLE) AS dst_bytes, CAST(conn_count AS DOUBLE) AS \"count\", serror_rate, "
    "regexp_replace(attack_type, '[.]$', '') AS attack_type FROM flows WHERE src NOT IN (7, 9)"
)
_CLEANED = (
    f", f1 AS ({_iqr('flows', 'src_bytes')}), f2 AS ({_iqr('f1', 'dst_bytes')}), f3 AS ({_iqr('f2', 'duration')})"
)


def _codes_in(source: str, name: str) -> str:
    return _codes(name).replace("FROM flows", f"FROM {source}")


ORACLES |= {
    "csv_connections": _flows(
        "SELECT *, CAST(CASE WHEN attack_type = 'normal' THEN 0 ELSE 1 END AS BIGINT) AS label "
        f"FROM ({_CONNECTIONS})"
    ),
    "rejected_connections": _flows(
        'SELECT src = 7 AS text_for_number, count(*) AS "count" FROM flows WHERE src IN (7, 9) GROUP BY src'
    ),
    "prepare_connections": _flows(
        "SELECT duration, src_bytes, dst_bytes, \"count\", serror_rate, attack_type, "
        "CAST(CASE WHEN attack_type = 'normal' THEN 0 ELSE 1 END AS BIGINT) AS label, "
        f"{_code('protocol_type')} AS protocol_type_indexed, {_code('service')} AS service_indexed, "
        f"{_code('flag')} AS flag_indexed, CASE attack_type WHEN 'neptune' THEN 'dos' WHEN 'ipsweep' THEN 'probe' "
        "WHEN 'normal' THEN 'normal' END AS attack_category FROM named",
        f", named AS (SELECT * FROM ({_CONNECTIONS}) WHERE attack_type IS NOT NULL)"
        + "".join(_codes_in("named", c) for c in ("protocol_type", "service", "flag")),
    ),
    "prepare_flows": _flows(
        "SELECT src AS srcip, CAST(src_port AS BIGINT) AS sport, dst AS dstip, CAST(dst_port AS BIGINT) AS dsport, "
        "src_bytes AS sbytes, dst_bytes AS dbytes, duration AS dur, flow_id AS stcpb, price AS load, "
        "category AS attack_category, CAST(label AS BIGINT) AS label, src_bytes + dst_bytes AS total_bytes, "
        "CASE WHEN dst_bytes > 0 THEN src_bytes / dst_bytes ELSE 0.0::DOUBLE END AS bytes_ratio, "
        f"{_code('service')} AS service_index, {_code('label')} AS label_index, "
        f"{_code('category')} AS attack_category_index FROM f3",
        _CLEANED + "".join(_codes_in("f3", c) for c in ("service", "label", "category")),
    ),
    "taxonomy_file": _flows(
        f"SELECT {BIGKEY}, attack_type, CASE attack_type WHEN 'neptune.' THEN 'DoS' WHEN 'mystery' THEN 'Exploits' "
        "WHEN 'ipsweep.' THEN 'Reconnaissance' WHEN 'normal' THEN 'normal' WHEN 'normal.' THEN 'normal' END "
        "AS attack_category FROM flows"
    ),
    "blocklist_file": _flows(
        f"SELECT {BIGKEY}, src IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0 AND s_suppkey % 3 < 2) "
        "AS is_malicious_ip FROM flows"
    ),
    "two_sinks": _events(f"SELECT sink, a.* FROM ({ALERTS}) a, (SELECT unnest(['json', 'table']) AS sink)", WINDOWED),
    "windowed_traffic_hot_source": _events(
        "SELECT window_start, window_end, attack_type, connection_count, total_src_bytes, "
        "total_dst_bytes, round(avg_duration, 9) AS avg_duration, "
        "round(bytes_per_connection, 9) AS bytes_per_connection FROM windowed",
        WINDOWED.replace(
            "attack_type, src_bytes, dst_bytes, duration FROM evt",
            "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE attack_type END AS attack_type, "
            "src_bytes, dst_bytes, duration FROM evt",
        ),
    ),
    "late_rows": _events(
        "SELECT part, event_id, part = 0 OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > "
        "date_trunc('milliseconds', (SELECT max(p.ts) FROM parts p WHERE p.part < parts.part)) - INTERVAL 10 SECONDS "
        "AS counted FROM parts",
        ", ends AS (SELECT min(ts) AS low, max(ts) AS high FROM evt), parts AS (SELECT event_id, ts, "
        "CAST(CASE WHEN event_id % 10 = 0 THEN 2 WHEN ts >= low + (high - low) / 2 THEN 1 ELSE 0 END AS BIGINT) AS part "
        "FROM evt, ends)",
    ),
    "score_stream_apart": _events(
        "SELECT window_start, window_end, attack_type, connection_count, attack_type = 'error' AS far FROM windowed",
        WINDOWED,
    ),
    "report_moving_average": ORACLES["moving_average"],
}

# Other plans, or another form, of queries above.
for _name, _same in {
    "enrich_geo_shuffled": "enrich_geo",
    "enrich_owner_shuffled": "enrich_owner",
    "flag_threats_shuffled": "flag_threats",
    "flag_threats_filtered": "flag_threats",
    "enrich_owner_nested_shuffled": "enrich_owner_nested",
    "categorize_shuffled": "categorize",
    "gaps_of_hot_sources": "gaps",
    "rolling_sequence_of_hot_sources": "rolling_sequence",
    "index_categories_joined": "index_categories",
    "oversample_in_pieces": "oversample",
}.items():
    ORACLES[_name] = ORACLES[_same]

ORACLES |= {
    "cluster_profile": _flows(
        'SELECT prediction, count(*) AS "count", avg(far_bytes) AS avg_src_bytes, '
        "avg(dst_bytes) AS avg_dst_bytes FROM clustered GROUP BY prediction",
        CLUSTERED,
    ),
    "anomaly_report": _flows(
        "SELECT count(*) FILTER (label = 1) AS anomaly_count, "
        "count(*) FILTER (label = 1) / count(*) AS anomaly_ratio, "
        "avg(far_bytes) FILTER (label = 1) AS avg_src_bytes, "
        "avg(dst_bytes) FILTER (label = 1) AS avg_dst_bytes, "
        "avg(duration) FILTER (label = 1) AS avg_duration FROM clustered",
        CLUSTERED,
    ),
    "anomalies": _flows(
        f"SELECT {BIGKEY}, prediction FROM clustered WHERE label = 1", CLUSTERED
    ),
    "attack_rows_by_name": _flows(
        f"SELECT {BIGKEY}, attack_type FROM flows "
        "WHERE attack_type = 'mystery' OR category <> 'normal'"
    ),
    "oversample_drawn": _flows(
        f"SELECT {BIGKEY}, category, src_bytes FROM ranked WHERE n = top UNION ALL "
        "SELECT r.flow_id, CAST(r.src_port AS BIGINT), r.dst, r.src, r.price, r.category, "
        "r.src_bytes FROM draws d JOIN ranked r ON r.category = d.category AND r.rn = d.place",
        ", sizes AS (SELECT category, count(*) AS n, max(count(*)) OVER () AS top FROM flows "
        "GROUP BY category), ranked AS (SELECT f.*, n, top, row_number() OVER (PARTITION BY "
        f"f.category ORDER BY {KEY}) - 1 AS rn FROM flows f JOIN sizes USING (category)), "
        "draws AS (SELECT category, (j % 2147483647 * 1103515245 + 42 * 12345) % 2147483647 % n "
        "AS place FROM (SELECT category, n, unnest(range(top)) AS j FROM sizes WHERE n < top))",
    ),
    "sequence_totals": _events(
        "SELECT attack_sequence, count(*) AS frequency, count(DISTINCT src) AS source_count "
        "FROM sequenced WHERE length(attack_sequence) > 10 GROUP BY attack_sequence",
        SEQUENCED,
    ),
    "sequence_sources": _events(
        "SELECT attack_sequence, src, count(*) AS frequency FROM sequenced "
        "WHERE length(attack_sequence) > 10 GROUP BY attack_sequence, src",
        SEQUENCED,
    ),
    "trend_points_all": _flows(
        "SELECT time_index, bytes_moving_avg FROM averaged, (SELECT count(*) AS rows FROM flows) "
        "WHERE time_index IN (SELECT k * (SELECT count(*) FROM flows) // 100 "
        "FROM range(1, 101) t(k))",
        INDEXED,
    ),
    "enrich_both_ends": _flows(
        f"SELECT {BIGKEY}, a.n_name AS src_country, b.n_name AS dst_country FROM flows "
        "LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) a "
        "ON src * 20 BETWEEN a.s_suppkey * 20 AND a.s_suppkey * 20 + 14 "
        "LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) b "
        "ON dst BETWEEN b.s_suppkey * 20 AND b.s_suppkey * 20 + 14"
    ),
    "csv_flows": _flows(CSV_SQL),
    "csv_flows_header": _flows(CSV_SQL),
    "written_reports": _flow_counts("service"),
}
ORACLES |= {
    f"report_{name}": ORACLES[name]
    for name in (
        "overview", "numeric_profile", "missing_counts", "data_stats", "categorical_top",
        "trend_points", "protocol_distribution", "protocol_attack_relation",
        "service_distribution", "port_distribution", "label_distribution",
        "category_distribution", "attack_type_counts", "dos_profile", "probe_profile",
        "cluster_profile", "anomaly_report", "top_sources", "top_destinations", "top_pairs",
        "segment_distribution", "high_frequency", "summary",
    )
}
