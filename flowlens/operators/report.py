"""Summary reports, and the full report set over one table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import byte_sum
from flowlens.operators import anomaly, behavior, distribution, profile
from flowlens.operators.balance import oversample
from flowlens.operators.clean import REL_ERROR
from flowlens.operators.distribution import ROWS, TOP_HOSTS, TOP_VALUES
from flowlens.operators.sequence import moving_average, trend_points
from flowlens.plans.measures import measure_together
from flowlens.plans.staging import stage
from flowlens.roles import Roles

FINDINGS = {"label": "top_label", "hour": "peak_hour", "proto": "main_protocol"}


def key_findings(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    """Most frequent label, busiest hour and main protocol, with count and share.

    All three come from one set of cell counts.
    """
    if weight is not None:
        cells = df.withColumnRenamed(weight, ROWS)
    else:
        narrow = Roles(
            label=roles.label, proto=roles.proto, hour=roles.hour, ts=roles.ts, epoch=roles.epoch
        )
        cells = distribution.cell_counts(df, narrow)
    sources = {"label": roles.label, "hour": "hour", "proto": roles.proto}
    present = {k: c for k, c in sources.items() if c is not None and c in cells.columns}
    values = cells.select(
        *(F.col(c).cast("string").alias(FINDINGS[k]) for k, c in present.items()), ROWS
    ).unpivot([ROWS], [FINDINGS[k] for k in present], "finding", "value")
    best = Window.partitionBy("finding").orderBy(
        F.desc("count"), F.expr("try_cast(value AS bigint)"), "value"
    )
    everything = Window.partitionBy("finding")
    # Few rows by now: one per distinct label, hour and protocol.
    return (
        values.groupBy("finding", "value")
        .agg(F.sum(ROWS).alias("count"))
        .withColumn("total", F.sum("count").over(everything))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") == 1)
        .select("finding", "value", "count", (F.col("count") / F.col("total")).alias("share"))
    )


def summary(
    df: DataFrame, roles: Roles, features: int | None = None, weight: str | None = None
) -> DataFrame:
    """Records, columns and number of distinct labels."""
    (label,) = roles.need("label")
    columns = len(df.columns) if features is None else features
    return (
        distribution.counts(df, {label: label}, weight)
        .agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("records"),
            F.count("*").alias("labels"),
        )
        .withColumn("features", F.lit(columns).cast("bigint"))
    )


def _kpi(row: DataFrame, columns: dict[str, str]) -> DataFrame:
    values = [F.col(c).cast("double").alias(kpi) for kpi, c in columns.items()]
    return row.select(*values).unpivot([], list(columns), "kpi", "value")


def kpis(
    stats: DataFrame,
    high_frequency: DataFrame | None = None,
    anomaly_report: DataFrame | None = None,
) -> DataFrame:
    """Headline figures (``kpi``, ``value``) from the one-row reports."""
    table = _kpi(stats, {c: c for c in ("total", "attacks", "attack_ratio")})
    if anomaly_report is not None:
        table = table.unionByName(_kpi(anomaly_report, {"anomaly_ratio": "anomaly_ratio"}))
    if high_frequency is not None:
        table = table.unionByName(_kpi(high_frequency, {"high_frequency_ratio": "share"}))
    return table


def chart_series(
    labels: DataFrame | None, hours: DataFrame | None, hosts: DataFrame | None, k: int = TOP_HOSTS
) -> DataFrame:
    """Series for charts (``series``, ``key``, ``count``): top labels, hours, top hosts."""

    def series(name: str, report: DataFrame, count: str) -> DataFrame:
        key = F.col(report.columns[0]).cast("string").alias("key")
        return report.select(F.lit(name).alias("series"), key, F.col(count).alias("count"))

    parts = []
    if labels is not None:
        (label, *_) = labels.columns
        top = distribution.top_k(labels.filter(F.col("count") > 0), "count", [label], k)
        parts.append(series("label", top, "count"))
    if hours is not None:
        parts.append(series("hour", hours, "count"))
    if hosts is not None:
        (host, *_) = hosts.columns
        top = distribution.top_k(hosts, "connection_count", [host], k)
        parts.append(series("host", top, "connection_count"))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


@dataclass
class ReportSet(Mapping[str, DataFrame]):
    """Reports by name, and the small shared aggregates they are read from."""

    reports: dict[str, DataFrame]
    held: list[DataFrame] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        return self.reports[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.reports)

    def __len__(self) -> int:
        return len(self.reports)

    def release(self) -> None:
        """Drop the cached aggregates."""
        for df in self.held:
            df.unpersist()


# Sections of the full report set.
SECTIONS = ("basic", "temporal", "protocol", "attack", "anomaly", "hosts", "traffic", "summary")


def analyze(
    df: DataFrame,
    roles: Roles,
    sections: Sequence[str] = SECTIONS,
    order: Sequence[str] | None = None,
    rel_error: float = REL_ERROR,
    balanced: bool = False,
    total_order: bool = False,
) -> ReportSet:
    """Every report the table has the columns for, by name.

    Reports are not computed from the rows one by one. One aggregation serves
    all scalar reports, one set of cell counts all distributions, one set of
    host pairs all host rankings, and one count by bucket all lists of
    frequent texts. Only these aggregates are cached or, for host pairs, written, never
    the rows. The frequency quantile, the clustering and the trend (by
    ``order``, or else by duration) read the rows on their own. The reports
    are lazy, but profiles, frequent texts, host pairs, quantiles and clusters
    are computed, and rows are numbered for the moving average, before this
    returns. ``total_order`` states that no two rows tie on ``order``. ``balanced`` analyses the oversampled table instead.
    """
    if order is None and roles.has("duration"):
        order = [roles.duration]
    unknown = set(sections) - set(SECTIONS)
    if unknown:
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    if balanced:
        df = oversample(df, roles.need("label")[0], "drawn")
    wanted = set(sections)
    held: list[DataFrame] = []

    def hold(part: DataFrame) -> DataFrame:
        kept = part.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(kept)
        return kept

    reports: dict[str, DataFrame] = {}
    bytes_known = roles.has("total_bytes") or roles.has("src_bytes", "dst_bytes")
    measured = roles.has("src_bytes", "dst_bytes", "duration")
    named = roles.has("category") or roles.has("attack")

    scalars = {}
    if "basic" in wanted:
        scalars["overview"] = profile.overview_measure(df)
        if profile.numeric_columns(df):
            scalars["numeric_profile"] = profile.numeric_measure(df)
        scalars["missing_counts"] = profile.missing_measure(df)
    if named and wanted & {"basic", "summary"}:
        scalars["data_stats"] = profile.data_stats_measure(df, roles)
    if named and measured and "attack" in wanted:
        scalars["dos_profile"] = behavior.dos_measure(df, roles)
        if any(roles.has(n) for n in ("count", "srv_count", "dst_host_count")):
            scalars["probe_profile"] = behavior.probe_measure(df, roles)
    if roles.has("serror_rate", "rerror_rate") and "traffic" in wanted:
        scalars["high_error"] = behavior.high_error_measure([roles.serror_rate, roles.rerror_rate])
    if scalars:
        reports |= measure_together(df, scalars, hold)

    cells = hold(distribution.cell_counts(df, roles))
    cell_roles = Roles.resolve(
        cells,
        **{
            role: getattr(roles, role)
            for role in ("proto", "service", "label", "category", "attack")
            if roles.has(role)
        },
    )
    if cell_roles.has("hour") and "temporal" in wanted:
        reports["hour_distribution"] = distribution.hour_distribution(cells, cell_roles, weight=ROWS)
    if cell_roles.has("day_of_week") and "temporal" in wanted:
        reports["weekday_distribution"] = distribution.weekday_distribution(cells, cell_roles, weight=ROWS)
    if roles.has("proto") and "protocol" in wanted:
        reports["protocol_distribution"] = distribution.protocol_distribution(cells, cell_roles, weight=ROWS)
        if roles.has("category"):
            relation = distribution.protocol_attack_relation(cells, cell_roles, weight=ROWS)
            reports["protocol_attack_relation"] = relation
    if roles.has("service") and "protocol" in wanted:
        reports["service_distribution"] = distribution.service_distribution(cells, cell_roles, weight=ROWS)
    if "attack" in wanted:
        if roles.has("label"):
            reports["label_distribution"] = distribution.label_distribution(cells, cell_roles, weight=ROWS)
        if roles.has("category"):
            reports["category_distribution"] = distribution.category_distribution(cells, cell_roles, weight=ROWS)
        if roles.has("attack"):
            reports["attack_type_counts"] = profile.attack_type_counts(cells, cell_roles, ROWS)
        if named and cell_roles.has("hour"):
            reports["attack_hours"] = distribution.attack_hours(cells, cell_roles, weight=ROWS)
    if bytes_known and "traffic" in wanted:
        reports["segment_distribution"] = distribution.segment_distribution(cells, cell_roles, weight=ROWS)

    texts = profile.categorical_columns(df) if "basic" in wanted else []
    ports = [p for p in (roles.src_port, roles.dst_port) if p is not None]
    ports = ports if "protocol" in wanted else []
    if texts:
        reports["categorical_top"] = distribution.top_values(df, texts, TOP_VALUES)
    if ports:
        reports["port_distribution"] = hold(distribution.port_distribution(df, roles))

    hosts = None
    if roles.has("src", "dst") and measured and wanted & {"hosts", "summary"}:
        # As many rows as there are host pairs: written, not cached.
        pairs = stage(behavior.host_pairs(df, roles), "pairs")
        hosts = behavior.top_sources(pairs, roles, paired=True)
        if "hosts" in wanted:
            reports["top_sources"] = hosts
            reports["top_destinations"] = behavior.top_destinations(pairs, roles, paired=True)
            reports["top_pairs"] = behavior.top_pairs(pairs, roles, paired=True)

    if roles.has("count") and "traffic" in wanted:
        frequency = behavior.high_frequency(df, roles.count, rel_error=rel_error)
        reports["high_frequency"] = hold(frequency)
    if measured and "anomaly" in wanted:
        clustered = anomaly.cluster(df, roles)
        sums = hold(anomaly.cluster_sums(clustered, roles))
        reports["cluster_profile"] = anomaly.profile_of(sums)
        reports["anomaly_report"] = anomaly.anomaly_report_of(sums)
        reports["anomalies"] = anomaly.anomalies(clustered, roles)
    if order and bytes_known and "temporal" in wanted:
        totals = df.withColumn("_total", byte_sum(roles))
        reports["trend_points"] = trend_points(totals, "_total", order)
        averaged = moving_average(totals.select(*order, "_total"), "_total", order, total_order=total_order)
        reports["moving_average"] = averaged.select("time_index", F.col("_total").alias("total_bytes"), "bytes_moving_avg")

    if "summary" in wanted:
        if roles.has("label"):
            reports["summary"] = summary(cells, cell_roles, len(df.columns), ROWS)
        if roles.has("label") or roles.has("proto") or cell_roles.has("hour"):
            reports["key_findings"] = key_findings(cells, cell_roles, ROWS)
        if "data_stats" in reports:
            reports["kpis"] = kpis(
                reports["data_stats"], reports.get("high_frequency"), reports.get("anomaly_report")
            )
        series = (reports.get("label_distribution"), reports.get("hour_distribution"), hosts)
        if any(part is not None for part in series):
            reports["chart_series"] = chart_series(*series)
    return ReportSet(reports, held)
