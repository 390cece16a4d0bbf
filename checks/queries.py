"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    EVENT,
    FLOW,
    FLOW_ORDER,
    SCHEMAS,
    event_columns,
    events,
    flows,
    table,
)
from flowlens import Roles
from flowlens.functions.columns import byte_sum, ip_number, is_ipv4
from flowlens.operators import (
    anomaly,
    balance,
    behavior,
    clean,
    derive,
    distribution,
    encode,
    enrich,
    prepare,
    profile,
    report,
    sequence,
)
from flowlens.plans.quantiles import exact_quantiles, sketched_quantiles
from flowlens.plans.small import small_table
from flowlens.plans.staging import fresh_path, stage
from flowlens.sinks import publish_reports, read_reports
from flowlens.sources import (
    parse_events,
    read_blocklist,
    read_connections,
    read_flows,
    read_taxonomy,
    rejected_connections,
)
from flowlens.sources.flows import FLOW_TYPES
from flowlens.sources.reference import default_taxonomy
from flowlens.streaming import alerts, progress, traffic

Query = Callable[[SparkSession, str], DataFrame]

FLOW_KEY = ("flow_id", "src_port", "dst", "src", "price")
EVENT_WINDOW, EVENT_SLIDE = "1 hour", "30 minutes"
EVENT_RULES = alerts.Rules(
    flood_connections=4, flood_duration=40.0, heavy_bytes=60.0, heavy_connections=2
)
# Events by type instead of by user, so that windows hold several of them.
TYPED_EVENT = Roles(
    src="attack_type", ts="ts", src_bytes="src_bytes", dst_bytes="dst_bytes", duration="duration"
)


def as_long(df: DataFrame) -> DataFrame:
    """Whole-number columns as bigint, the type the SQL side uses."""
    kinds = ("tinyint", "smallint", "int")
    return df.select(*(F.col(c).cast("bigint").alias(c) if t in kinds else c for c, t in df.dtypes))


def _flow_query(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: as_long(build(flows(spark, sf)))


def _event_query(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: as_long(build(events(spark, sf)))


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*FLOW_KEY, *columns)


# --- profiles -------------------------------------------------------------


def numeric_profile(df: DataFrame) -> DataFrame:
    rounded = {"mean": 9, "std": 4}
    report_ = profile.numeric_profile(df)
    return report_.select(
        *(F.round(c, rounded[c]).alias(c) if c in rounded else c for c in report_.columns)
    )


# --- derived columns ------------------------------------------------------


def dotted(number: Column) -> Column:
    """A number as a dotted address."""
    parts = [F.shiftright(number, bits) % 256 for bits in (24, 16, 8, 0)]
    return F.concat_ws(".", *(part.cast("string") for part in parts))


def ipv4_check(df: DataFrame) -> DataFrame:
    """Addresses made of row values, some with an octet beyond 255 or a part missing."""
    text = F.when(F.col("proto") == "A", F.concat_ws(".", "src", "dst")).otherwise(
        F.concat_ws(".", F.col("src") % 300, F.col("dst") % 700, "src_port", "conn_count")
    )
    checked = df.withColumn("address", text)
    address = F.col("address")
    return checked.select(
        *FLOW_KEY,
        "address",
        is_ipv4(address).alias("shaped"),
        is_ipv4(address, strict=True).alias("valid"),
        ip_number(address).alias("number"),
    )


# --- sketches -------------------------------------------------------------

SKETCHED = ("src_bytes", "dst_bytes", "duration")
RANK_ERROR = 0.01


def iqr_filter_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Whether sketched quartiles, and what their whiskers keep, are as near as the rank error allows.

    The bounds are those of exact quartiles at ranks moved by the error; ``kept_least`` and ``kept_most``
    are the rows within the narrowest and the widest whiskers these allow.
    """
    # Many passes follow: the flows are joined once, and three columns of them written.
    df = stage(flows(spark, sf).select(*SKETCHED), "sketched")
    found = sketched_quantiles(df, {c: [0.25, 0.75] for c in SKETCHED}, RANK_ERROR)
    rows = []
    for name in SKETCHED:
        ranks = [p + side for p in (0.25, 0.75) for side in (-RANK_ERROR, RANK_ERROR)]
        a, b, c, d = exact_quantiles(df, name, ranks)
        inner, outer = clean.WHISKER * (c - b), clean.WHISKER * (d - a)
        low, high = clean.whiskers([q.value for q in found[name]])
        x = F.col(name)
        kept = df.agg(
            F.count(name),
            F.count_if((x >= b - inner) & (x <= c + inner)),
            F.count_if((x >= a - outer) & (x <= d + outer)),
            F.count_if((x >= low) & (x <= high)),
        ).first()
        near = all(q.error <= RANK_ERROR for q in found[name]) and kept[1] <= kept[3] <= kept[2]
        rows.append((name, *kept[:3], near))
    return small_table(spark, rows, "column string, n bigint, kept_least bigint, kept_most bigint, near boolean")


# --- encoding -------------------------------------------------------------

CODED = ("proto", "service", "attack_cat")


def one_hot(df: DataFrame) -> DataFrame:
    coded = encode.one_hot(df, CODED)
    arrays = {
        f"{c}_encoded": F.array_join(
            F.transform(vector_to_array(F.col(f"{c}_encoded")), lambda x: x.cast("int")), ","
        )
        for c in CODED
    }
    return _keyed(coded.withColumns(arrays), *(f"{c}_encoded" for c in CODED))


# --- order and sequences --------------------------------------------------


def with_total(df: DataFrame) -> DataFrame:
    return df.select(*FLOW_ORDER, byte_sum(FLOW).alias("total_bytes"))


def flows_by_class(df: DataFrame) -> DataFrame:
    """Flows whose source bytes tell the classes apart, so that two clusters must be the two labels."""
    far = F.when(F.col("label") == 1, 10**9).otherwise(0)
    return df.withColumn("src_bytes", F.col("src_bytes") + far)


def without_category(df: DataFrame) -> DataFrame:
    """Flows in which an attack that no taxonomy lists has no category."""
    listed = F.coalesce(F.col("attack_type") != "mystery", F.lit(True))
    return df.withColumn("category", F.when(listed, F.col("category")))


def drawn(df: DataFrame) -> DataFrame:
    rows = df.select(*FLOW_KEY, "category", "src_bytes")
    return balance.oversample(
        rows, "category", "drawn", FLOW_KEY, True, only_if_imbalanced=False, copies_per_task=1000
    )


def _sequenced(df: DataFrame) -> DataFrame:
    return sequence.rolling_sequence(df, EVENT, tiebreak=["event_id"])


def frequent_sequences(df: DataFrame) -> DataFrame:
    found = sequence.frequent_sequences(_sequenced(df), EVENT)
    return found.withColumn("source_ips", F.array_join("source_ips", ","))


# --- reference tables -----------------------------------------------------


def geo_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier owns 15 of 20 consecutive addresses of 10.0.0.0/8."""
    low = F.lit(10 << 24) + F.col("s_suppkey") * 20
    nation = table(spark, sf, "nation")
    suppliers = table(spark, sf, "supplier")
    return suppliers.join(nation, suppliers.s_nationkey == nation.n_nationkey).select(
        low.alias("lo"),
        (low + 14).alias("hi"),
        F.col("n_name").alias("country"),
        F.col("s_name").alias("city"),
        F.col("s_acctbal").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
    )


def enrich_geo(spark: SparkSession, sf: str, **bound: int) -> DataFrame:
    addressed = flows(spark, sf).withColumn("dst_ip", dotted(F.lit(10 << 24) + F.col("dst")))
    located = enrich.enrich_geo(addressed, geo_ranges(spark, sf), "dst_ip", **bound)
    return as_long(_keyed(located, "dst_ip", *enrich.GEO_COLUMNS))


def enrich_both_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Countries of source and destination, by two look-ups of one table."""
    base = F.lit(10 << 24)
    addressed = flows(spark, sf).withColumns(
        {"src_ip": dotted(base + F.col("src") * 20), "dst_ip": dotted(base + F.col("dst"))}
    )
    ranges = geo_ranges(spark, sf)
    located = enrich.enrich_geo(addressed, ranges, "src_ip", prefix="src_")
    located = enrich.enrich_geo(located, ranges, "dst_ip", prefix="dst_")
    return as_long(_keyed(located, "src_country", "dst_country"))


def owners(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    suppliers = table(spark, sf, "supplier").filter(F.col("s_acctbal") >= 0)
    return suppliers.join(nation, suppliers.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("ip"),
        F.concat(F.lit("AS"), "s_suppkey").alias("asn"),
        F.col("s_name").alias("organization"),
        F.col("n_name").alias("isp"),
    )


def enrich_owner(spark: SparkSession, sf: str, **bound: int) -> DataFrame:
    owned = enrich.enrich_owner(flows(spark, sf), owners(spark, sf), "src", **bound)
    return as_long(_keyed(owned, *enrich.OWNER_COLUMNS))


def flag_threats(spark: SparkSession, sf: str, **bound: int) -> DataFrame:
    listed = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0)
    blocklist = listed.select(F.col("s_suppkey").alias("ip"))
    flagged = enrich.flag_threats(flows(spark, sf), blocklist, "src", **bound)
    return as_long(_keyed(flagged, "is_malicious_ip"))


def flag_threats_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """A block-list that is mostly of addresses that never occur, and too long to be broadcast whole."""
    listed = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("ip"))
    others = table(spark, sf, "orders").select((F.col("o_orderkey") + 10**9).alias("ip"))
    flagged = enrich.flag_threats(flows(spark, sf), listed.unionByName(others), "src", 1_000)
    return as_long(_keyed(flagged, "is_malicious_ip"))


def nested_owners(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of 10.0.0.0/8: one range of all, one of 64 addresses a supplier, with two within each other inside."""
    base, key = F.lit(10 << 24), F.col("s_suppkey")
    suppliers = table(spark, sf, "supplier")
    sizes = {"outer": (0, 63), "middle": (4, 51), "inner": (20, 27)}
    parts = [
        suppliers.select(
            (base + key * 64 + low).alias("lo"),
            (base + key * 64 + high).alias("hi"),
            F.concat(F.lit(f"{name}-"), key.cast("string")).alias("asn"),
        )
        for name, (low, high) in sizes.items()
    ]
    everything = [((10 << 24), (10 << 24) + (1 << 24) - 1, "all")]
    listed = small_table(spark, everything, "lo bigint, hi bigint, asn string")
    for part in parts:
        listed = listed.unionByName(part)
    return listed.select("lo", "hi", "asn", F.col("asn").alias("organization"), F.col("asn").alias("isp"))


def enrich_owner_nested(spark: SparkSession, sf: str, **bound: int) -> DataFrame:
    addressed = flows(spark, sf).withColumn("dst_ip", dotted(F.lit(10 << 24) + F.col("dst")))
    owned = enrich.enrich_owner(addressed, nested_owners(spark, sf), "dst_ip", nested=True, **bound)
    return as_long(_keyed(owned, "asn"))


def categorize(df: DataFrame, default: str | None = None, **bound: int) -> DataFrame:
    known = enrich.categorize(df, default_taxonomy(df.sparkSession), FLOW, default, **bound)
    return _keyed(known, "attack_type", "attack_category")


# --- streams --------------------------------------------------------------


MICROSECONDS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table as a stream of JSON lines, parsed like one from a broker."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    lines = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
        .select(F.to_json(F.struct("*"), MICROSECONDS).alias("value"))
    )
    parsed = parse_events(lines, SCHEMAS["events"])
    return traffic.with_late_bound(parsed.select(*event_columns()), "ts")


def run_stream(df: DataFrame, name: str, sink: str = "parquet") -> DataFrame:
    """Run a stream over all there is into a fresh folder, and read the result."""
    spark = df.sparkSession
    out = fresh_path(spark, name)
    query = alerts.write_alerts(df, sink, f"{out}-state", available_now=True, path=out)
    query.awaitTermination()
    if sink == "text":
        return spark.read.text(out)
    return spark.read.schema(df.schema).parquet(out)


def _windows(df: DataFrame) -> DataFrame:
    return traffic.windowed_traffic(df, TYPED_EVENT, EVENT_WINDOW, EVENT_SLIDE)


def _bounds(df: DataFrame) -> DataFrame:
    """Window ends as the naive time stamps of the event table."""
    named = traffic.window_bounds(df) if "window" in df.columns else df
    ends = ("window_start", "window_end")
    return named.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ends})


def windowed_traffic(spark: SparkSession, sf: str) -> DataFrame:
    out = _bounds(run_stream(_windows(event_stream(spark, sf)), "windowed-traffic"))
    return out.withColumns(
        {c: F.round(c, 9) for c in ("avg_duration", "bytes_per_connection")}
    )


def windowed_counts(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("category") != "normal"
    counted = traffic.windowed_counts(event_stream(spark, sf), "ts", flag, EVENT_WINDOW)
    return _bounds(run_stream(counted, "windowed-counts"))


def alert_rules(spark: SparkSession, sf: str) -> DataFrame:
    raised = alerts.alert_rules(_windows(event_stream(spark, sf)), EVENT_RULES)
    return _bounds(run_stream(raised, "alerts")).select(
        "window_start", "window_end", "attack_type", "connection_count", "alert_level",
        "alert_reason",
    )


def alert_json(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts as JSON text, parsed back."""
    raised = alerts.alert_rules(_windows(event_stream(spark, sf)), EVENT_RULES)
    text = run_stream(traffic.window_bounds(raised), "alert-json", "text")
    fields = "window_start timestamp, window_end timestamp, attack_type string, "
    fields += "connection_count bigint, alert_level string, alert_reason string"
    return _bounds(parse_events(text, fields))


def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Stream windows scored by a pipeline fitted and saved on the table."""
    features = ["connection_count", "total_src_bytes", "avg_duration"]
    model = anomaly.cluster_pipeline(features).fit(_windows(events(spark, sf)))
    path = fresh_path(spark, "model")
    model.save(path)
    scored = alerts.score_stream(_windows(event_stream(spark, sf)), path).drop("features")
    return as_long(_bounds(run_stream(scored, "scored")))


def two_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of one query in two sinks."""
    raised = alerts.alert_rules(_windows(event_stream(spark, sf)), EVENT_RULES).drop("alert_time")
    raised = traffic.window_bounds(raised)
    out = fresh_path(spark, "two-sinks")
    sinks = {"json": "json", "table": "parquet"}
    writers = {name: alerts.file_sink(kind, f"{out}/{name}") for name, kind in sinks.items()}
    alerts.write_to_all(raised, writers, f"{out}/state", available_now=True).awaitTermination()
    parts = [
        alerts.read_batches(raised, kind, f"{out}/{name}").select(F.lit(name).alias("sink"), "*")
        for name, kind in sinks.items()
    ]
    return _bounds(parts[0].unionByName(parts[1])).select(
        "sink", "window_start", "window_end", "attack_type", "connection_count", "alert_level", "alert_reason"
    )


def hot_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of a stream of which one source has a third and more, each source summed in eight parts."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("attack_type"))
    stream = event_stream(spark, sf).withColumn("attack_type", hot)
    found = traffic.windowed_traffic(stream, TYPED_EVENT, EVENT_WINDOW, EVENT_SLIDE, spread=8)
    out = _bounds(run_stream(found, "hot-windows"))
    return out.withColumns({c: F.round(c, 9) for c in ("avg_duration", "bytes_per_connection")})


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A stream in three parts, the last of them rows held back: what it counts, and the rows it drops.

    Rows (``part``, ``event_id``, ``counted``): counted if their window was open when the part came. The
    windows the stream wrote must hold exactly the counted rows of closed windows, and it must report
    drops if any row is late; else the query fails.
    """
    everything = events(spark, sf)
    low, high = everything.agg(F.min("ts"), F.max("ts")).first()
    held_back, second = F.col("event_id") % 10 == 0, F.col("ts") >= F.lit(low + (high - low) / 2)
    part = F.when(held_back, 2).when(second, 1).otherwise(0)
    folder, out = fresh_path(spark, "parts"), fresh_path(spark, "late")
    columns = ["event_id", "ts", "category"]
    found, drops = None, 0
    for number in range(3):
        rows = everything.where(part == number).select(*columns)
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        counted = traffic.windowed_counts(
            traffic.with_late_bound(stream, "ts"), "ts", F.col("category") != "normal", EVENT_WINDOW
        )
        query = alerts.write_alerts(counted, "parquet", f"{out}-state", available_now=True, path=out)
        query.awaitTermination()
        (mark,) = progress.watermarks(query).values()
        drops += progress.dropped(query)
        late = progress.late_rows(rows, "ts", EVENT_WINDOW, mark).select("event_id", F.lit(False).alias("in_time"))
        told = rows.join(late, "event_id", "left").select(
            F.lit(number).cast("bigint").alias("part"), "event_id", "ts", F.coalesce("in_time", F.lit(True)).alias("counted")
        )
        found = told if found is None else found.unionByName(told)
    found = stage(found, "told")
    written = spark.read.schema(counted.schema).parquet(out).agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("window.end")).first()
    expected = found.where(F.col("counted") & (F.window("ts", EVENT_WINDOW).getField("end") <= F.lit(written[1]))).count()
    if written[0] != expected or (drops > 0) != (not found.where("NOT counted").isEmpty()):
        raise AssertionError(f"{written[0]} rows counted, {expected} expected, {drops} drops reported")
    return found.drop("ts")


def score_stream_apart(spark: SparkSession, sf: str) -> DataFrame:
    """Stream windows scored by a model of windows whose two kinds lie far apart: which kind each is of."""
    far = F.when(F.col("attack_type") == "error", 10**9).otherwise(0)
    apart = lambda df: _windows(df.withColumn("src_bytes", F.col("src_bytes") + far))
    model = anomaly.cluster_pipeline(["bytes_per_connection", "connection_count", "avg_duration"]).fit(apart(events(spark, sf)))
    path = fresh_path(spark, "model")
    model.save(path)
    centres = [c[0] for c in model.stages[-1].clusterCenters()]
    scored = alerts.score_stream(apart(event_stream(spark, sf)), path).drop("features")
    kind = (F.col("prediction") == centres.index(max(centres))).alias("far")
    return _bounds(run_stream(scored, "scored")).select("window_start", "window_end", "attack_type", "connection_count", kind)


# --- summary --------------------------------------------------------------


def kpis(df: DataFrame) -> DataFrame:
    return report.kpis(
        profile.data_stats(df, FLOW), behavior.high_frequency(df, "conn_count", rel_error=0)
    )


def chart_series(spark: SparkSession, sf: str) -> DataFrame:
    flow = flows(spark, sf)
    return report.chart_series(
        distribution.label_distribution(flow, FLOW),
        distribution.hour_distribution(events(spark, sf), EVENT),
        behavior.top_sources(flow, FLOW),
    )


# Reports of the full set, by the section that holds them.
REPORTS = {
    "basic": ("overview", "numeric_profile", "missing_counts", "data_stats", "categorical_top"),
    "temporal": ("trend_points", "moving_average"),
    "protocol": (
        "protocol_distribution", "protocol_attack_relation", "service_distribution",
        "port_distribution",
    ),
    "attack": (
        "label_distribution", "category_distribution", "attack_type_counts", "dos_profile",
        "probe_profile",
    ),
    "anomaly": ("cluster_profile", "anomaly_report"),
    "hosts": ("top_sources", "top_destinations", "top_pairs"),
    "traffic": ("segment_distribution", "high_frequency"),
    "summary": ("summary",),
}


def report_of(section: str, name: str) -> Query:
    """One report read from the full report set of its section."""

    def build(spark: SparkSession, sf: str) -> DataFrame:
        df = flows(spark, sf)
        df = flows_by_class(df) if section == "anomaly" else df
        found = report.analyze(df, FLOW, [section], FLOW_ORDER, rel_error=0, total_order=True)[name]
        if name == "numeric_profile":
            found = found.withColumns({"mean": F.round("mean", 9), "std": F.round("std", 4)})
        return as_long(found)

    return build


def _findings(spark: SparkSession, sf: str) -> DataFrame:
    """Findings over events, whose time stamps have hours; the type plays the label."""
    roles = Roles(label="attack_type", proto="category", ts="ts")
    return report.key_findings(events(spark, sf), roles)


def _cluster_flows(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.cluster(flows_by_class(flows(spark, sf)), FLOW)


# --- files ----------------------------------------------------------------

CSV_FIELDS = {
    "srcip": "src", "sport": "src_port", "dstip": "dst", "dsport": "dst_port", "proto": "proto",
    "state": "state", "dur": "duration", "sbytes": "src_bytes", "dbytes": "dst_bytes",
    "service": "service", "sload": "price", "stcpb": "flow_id", "attack_cat": "attack_cat",
    "label": "label",
}


def csv_flows(spark: SparkSession, sf: str, header: bool = False) -> DataFrame:
    """Flows written as 49-column CSV and read back."""
    fields = [
        (F.col(CSV_FIELDS[name]) if name in CSV_FIELDS else F.lit(None)).cast(kind).alias(name)
        for name, kind in FLOW_TYPES.items()
    ]
    path = fresh_path(spark, "csv")
    flows(spark, sf).select(*fields).write.csv(path, header=header)
    kept = [c for c in CSV_FIELDS if c != "attack_cat"]
    return as_long(read_flows(spark, path).select(*kept, "attack_category"))


def written_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports published as a set and read back through its manifest."""
    flow = flows(spark, sf)
    found = {
        "services": distribution.service_distribution(flow, FLOW, None),
        "overview": profile.overview(flow),
    }
    folder = fresh_path(spark, "reports")
    publish_reports(found, folder, formats={"services": "csv"})
    return read_reports(spark, folder)["services"]


def write_lines(lines: DataFrame, name: str) -> str:
    """Text files with one line a row, in the column ``line``."""
    path = fresh_path(lines.sparkSession, name)
    lines.select("line").write.text(path)
    return path


CONNECTION_COLUMNS = {
    "duration": "duration", "protocol_type": "proto", "service": "service", "flag": "state",
    "src_bytes": "src_bytes", "dst_bytes": "dst_bytes", "count": "conn_count", "serror_rate": "serror_rate",
}
SYMBOLIC = ("protocol_type", "service", "flag")


def connection_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Flows as connection CSV with a names file; lines of source 7 have a text for a number, those of 9 lack columns."""
    listed = [f"{c}: {'symbolic' if c in SYMBOLIC else 'continuous'}." for c in CONNECTION_COLUMNS]
    header = small_table(spark, [("back,neptune,normal.\n" + "\n".join(listed),)], "line string")
    fields = [F.col(c).cast("string") for c in CONNECTION_COLUMNS.values()]
    duration = F.when(F.col("src") == 7, F.lit("long")).otherwise(fields[0])
    known = F.coalesce("attack_type", F.lit(""))
    whole = F.concat_ws(",", duration, *fields[1:], known)
    lines = F.when(F.col("src") == 9, F.concat_ws(",", *fields[:3])).otherwise(whole)
    return write_lines(flows(spark, sf).select(lines.alias("line")), "connections"), write_lines(header, "names")


def csv_connections(spark: SparkSession, sf: str) -> DataFrame:
    return as_long(read_connections(spark, *connection_files(spark, sf)))


def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = rejected_connections(spark, *connection_files(spark, sf))
    return lines.groupBy(F.col("line").startswith("long,").alias("text_for_number")).count()


def prepared_connections(spark: SparkSession, sf: str) -> DataFrame:
    """Connections from file to codes and categories."""
    path, names = connection_files(spark, sf)
    prepared = prepare.prepare_connections(read_connections(spark, path, names), default_taxonomy(spark))
    return as_long(prepared)


def prepared_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows through the usual chain, under the names of flow files."""
    columns = {
        "srcip": "src", "sport": "src_port", "dstip": "dst", "dsport": "dst_port", "proto": "proto",
        "service": "service", "sbytes": "src_bytes", "dbytes": "dst_bytes", "dur": "duration",
        "stcpb": "flow_id", "load": "price", "attack_category": "category", "label": "label",
    }
    renamed = flows(spark, sf).select(*(F.col(c).alias(n) for n, c in columns.items()))
    prepared = prepare.prepare_flows(renamed, rel_error=0)
    return as_long(prepared.drop("service_encoded", "proto", "service"))


def taxonomy_file(spark: SparkSession, sf: str) -> DataFrame:
    """Attack names of the flows categorized by a taxonomy file made of them."""
    named = flows(spark, sf).where("attack_type IS NOT NULL AND NOT attack_type LIKE 'normal%'")
    lines = named.select(F.concat_ws(" ", "attack_type", "category").alias("line")).distinct()
    taxonomy = read_taxonomy(spark, write_lines(lines, "taxonomy"))
    found = enrich.categorize(flows(spark, sf), taxonomy, FLOW)
    return as_long(_keyed(found, "attack_type", "attack_category"))


def blocklist_file(spark: SparkSession, sf: str) -> DataFrame:
    """Flows from listed addresses, by a feed with comments, notes and lines that are no address."""
    address = dotted(F.lit(10 << 24) + F.col("s_suppkey"))
    negative, shape = F.col("s_acctbal") < 0, F.col("s_suppkey") % 3
    line = F.when(~negative, F.concat(F.lit("# "), address)).when(shape == 0, F.concat(F.lit("  "), address, F.lit(" seen twice")))
    line = line.when(shape == 1, address).otherwise(F.concat(F.lit("host-"), address))
    feed = write_lines(table(spark, sf, "supplier").select(line.alias("line")), "feed")
    addressed = flows(spark, sf).withColumn("src_ip", dotted(F.lit(10 << 24) + F.col("src")))
    return as_long(_keyed(enrich.flag_threats(addressed, read_blocklist(spark, feed)), "is_malicious_ip"))


QUERIES: dict[str, Query] = {
    # profiles
    "overview": _flow_query(profile.overview),
    "numeric_profile": _flow_query(numeric_profile),
    "categorical_top": _flow_query(profile.categorical_top),
    "missing_counts": _flow_query(profile.missing_counts),
    "data_stats": _flow_query(lambda df: profile.data_stats(df, FLOW)),
    "attack_type_counts": _flow_query(lambda df: profile.attack_type_counts(df, FLOW)),
    # distributions
    "hour_distribution": _event_query(lambda df: distribution.hour_distribution(df, EVENT)),
    "weekday_distribution": _event_query(lambda df: distribution.weekday_distribution(df, EVENT)),
    "attack_hours": _event_query(lambda df: distribution.attack_hours(df, EVENT)),
    "protocol_distribution": _flow_query(lambda df: distribution.protocol_distribution(df, FLOW)),
    "protocol_attack_relation": _flow_query(
        lambda df: distribution.protocol_attack_relation(df, FLOW)
    ),
    "service_distribution": _flow_query(lambda df: distribution.service_distribution(df, FLOW)),
    "port_distribution": _flow_query(lambda df: distribution.port_distribution(df, FLOW)),
    "label_distribution": _flow_query(lambda df: distribution.label_distribution(df, FLOW)),
    "category_distribution": _flow_query(lambda df: distribution.category_distribution(df, FLOW)),
    "segment_distribution": _flow_query(lambda df: distribution.segment_distribution(df, FLOW)),
    # behaviour
    "dos_profile": _flow_query(lambda df: behavior.dos_profile(df, FLOW)),
    "probe_profile": _flow_query(lambda df: behavior.probe_profile(df, FLOW)),
    "attack_rows": _flow_query(lambda df: _keyed(behavior.attack_rows(df, FLOW), "category")),
    "attack_rows_by_name": _flow_query(
        lambda df: _keyed(behavior.attack_rows(without_category(df), FLOW), "attack_type")
    ),
    "top_sources": _flow_query(lambda df: behavior.top_sources(df, FLOW)),
    "top_destinations": _flow_query(lambda df: behavior.top_destinations(df, FLOW)),
    "top_pairs": _flow_query(lambda df: behavior.top_pairs(df, FLOW)),
    "high_frequency": _flow_query(
        lambda df: behavior.high_frequency(df, "conn_count", rel_error=0)
    ),
    "high_error": _flow_query(
        lambda df: behavior.high_error(df, ["serror_rate", "rerror_rate"], 0.065)
    ),
    # derived columns
    "binary_label": _flow_query(
        lambda df: _keyed(derive.binary_label(df), "attack_type", "label")
    ),
    "attack_category": _flow_query(
        lambda df: _keyed(
            derive.attack_category(df, Roles(category="attack_cat")), "attack_category"
        )
    ),
    "time_features": _event_query(
        lambda df: derive.time_features(df, EVENT).select(
            "event_id", "hour", "day_of_week", "is_weekend"
        )
    ),
    "hour_of_epoch": _event_query(
        lambda df: distribution.hour_distribution(df, Roles(epoch="stime"))
    ),
    "total_bytes": _flow_query(lambda df: _keyed(derive.total_bytes(df, FLOW), "total_bytes")),
    "bytes_ratio": _flow_query(lambda df: _keyed(derive.bytes_ratio(df, FLOW), "bytes_ratio")),
    "connection_intensity": _flow_query(
        lambda df: _keyed(derive.connection_intensity(df, FLOW), "connection_intensity")
    ),
    "traffic_segment": _flow_query(
        lambda df: _keyed(derive.traffic_segment(df, FLOW), "traffic_segment")
    ),
    "ipv4_check": _flow_query(ipv4_check),
    # cleaning
    "drop_unlabelled": _flow_query(
        lambda df: _keyed(
            clean.drop_unlabelled(df, Roles(attack="attack_type")), "attack_type"
        )
    ),
    "impute_mean": _flow_query(
        lambda df: _keyed(
            clean.impute_mean(df, ["load_bytes", "duration"]), "load_bytes", "duration"
        )
    ),
    "iqr_filter": _flow_query(
        lambda df: _keyed(clean.iqr_filter(df, "dst_bytes", rel_error=0), "dst_bytes")
    ),
    "iqr_filter_sketched": iqr_filter_sketched,
    "remove_outliers": _flow_query(
        lambda df: _keyed(
            clean.remove_outliers(df, FLOW, rel_error=0), "src_bytes", "dst_bytes", "duration"
        )
    ),
    # encoding and balance
    "index_categories": _flow_query(
        lambda df: _keyed(
            encode.index_categories(df, ["proto", "service", "state"]),
            "proto_indexed", "service_indexed", "state_indexed",
        )
    ),
    "index_categories_keep": _flow_query(
        lambda df: _keyed(
            encode.index_categories(df, CODED, keep=True), *(f"{c}_index" for c in CODED)
        )
    ),
    "one_hot": _flow_query(one_hot),
    "index_labels": _flow_query(
        lambda df: _keyed(encode.index_labels(df, FLOW), "label_index", "attack_category_index")
    ),
    "class_balance": _flow_query(lambda df: balance.class_balance(df, "label")),
    "oversample": _flow_query(
        lambda df: balance.oversample(
            df.select(*FLOW_KEY, "label", "src_bytes"), "label", order=FLOW_KEY, total_order=True
        )
    ),
    "oversample_drawn": _flow_query(drawn),
    "oversample_in_pieces": _flow_query(
        lambda df: balance.oversample(
            df.select(*FLOW_KEY, "label", "src_bytes"), "label", order=FLOW_KEY, total_order=True,
            copies_per_task=3,
        )
    ),
    "index_categories_joined": _flow_query(
        lambda df: _keyed(
            encode.index_categories(df, ["proto", "service", "state"], max_labels=0),
            "proto_indexed", "service_indexed", "state_indexed",
        )
    ),
    # clustering
    "cluster_profile": lambda spark, sf: as_long(
        anomaly.cluster_profile(_cluster_flows(spark, sf), FLOW)
    ),
    "anomaly_report": lambda spark, sf: as_long(
        anomaly.anomaly_report(_cluster_flows(spark, sf), FLOW)
    ),
    "anomalies": lambda spark, sf: as_long(
        _keyed(anomaly.anomalies(_cluster_flows(spark, sf), FLOW), "prediction")
    ),
    # order and sequences
    "time_index": _flow_query(
        lambda df: sequence.time_index(df.select(*FLOW_ORDER), FLOW_ORDER, total_order=True)
    ),
    "moving_average": _flow_query(
        lambda df: sequence.moving_average(
            with_total(df), "total_bytes", FLOW_ORDER, total_order=True
        ).select("time_index", "total_bytes", "bytes_moving_avg")
    ),
    "trend_points": _flow_query(
        lambda df: sequence.trend_points(with_total(df), "total_bytes", FLOW_ORDER)
    ),
    "gaps": _event_query(
        lambda df: sequence.gaps(df, EVENT, tiebreak=["event_id"]).select(
            "event_id", F.col("prev_time").cast("timestamp_ntz").alias("prev_time"), "time_diff"
        )
    ),
    "rolling_sequence": _event_query(
        lambda df: _sequenced(df).select("event_id", "src", "attack_sequence")
    ),
    "frequent_sequences": _event_query(frequent_sequences),
    "sequence_totals": _event_query(lambda df: sequence.sequence_totals(_sequenced(df), EVENT)),
    "sequence_sources": _event_query(lambda df: sequence.sequence_sources(_sequenced(df), EVENT)),
    "trend_points_all": _flow_query(
        lambda df: sequence.trend_points(
            with_total(df), "total_bytes", FLOW_ORDER, span="all", total_order=True
        )
    ),
    "gaps_of_hot_sources": _event_query(
        lambda df: sequence.gaps(df, EVENT, ["event_id"], hot_rows=20).select(
            "event_id", F.col("prev_time").cast("timestamp_ntz").alias("prev_time"), "time_diff"
        )
    ),
    "rolling_sequence_of_hot_sources": _event_query(
        lambda df: sequence.rolling_sequence(
            df, EVENT, tiebreak=["event_id"], hot_rows=20
        ).select("event_id", "src", "attack_sequence")
    ),
    # enrichment
    "enrich_geo": enrich_geo,
    "enrich_owner": enrich_owner,
    "flag_threats": flag_threats,
    "flag_threats_filtered": flag_threats_filtered,
    "enrich_owner_nested": enrich_owner_nested,
    "enrich_owner_nested_shuffled": lambda spark, sf: enrich_owner_nested(spark, sf, broadcast_rows=0),
    "categorize": _flow_query(categorize),
    "enrich_both_ends": enrich_both_ends,
    "enrich_geo_shuffled": lambda spark, sf: enrich_geo(spark, sf, broadcast_rows=0),
    "enrich_owner_shuffled": lambda spark, sf: enrich_owner(spark, sf, broadcast_rows=0),
    "flag_threats_shuffled": lambda spark, sf: flag_threats(spark, sf, broadcast_rows=0),
    "categorize_shuffled": _flow_query(lambda df: categorize(df, broadcast_rows=0)),
    # files
    "csv_flows": csv_flows,
    "csv_flows_header": lambda spark, sf: csv_flows(spark, sf, True),
    "written_reports": written_reports,
    "csv_connections": csv_connections,
    "rejected_connections": rejected_lines,
    "prepare_connections": prepared_connections,
    "prepare_flows": prepared_flows,
    "taxonomy_file": taxonomy_file,
    "blocklist_file": blocklist_file,
    "categorize_default": _flow_query(lambda df: categorize(df, "unknown")),
    # streams
    "windowed_traffic": windowed_traffic,
    "windowed_counts": windowed_counts,
    "alert_rules": alert_rules,
    "alert_json": alert_json,
    "score_stream": score_stream,
    "score_stream_apart": score_stream_apart,
    "two_sinks": two_sinks,
    "windowed_traffic_hot_source": hot_windows,
    "late_rows": late_rows,
    # summary
    **{f"report_{name}": report_of(s, name) for s, names in REPORTS.items() for name in names},
    "key_findings": _findings,
    "summary": _flow_query(lambda df: report.summary(df, FLOW)),
    "kpis": _flow_query(kpis),
    "chart_series": chart_series,
}
