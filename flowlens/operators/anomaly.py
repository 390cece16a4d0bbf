"""Clusters of rows, and the smallest one as anomalies."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import share
from flowlens.plans.staging import stage
from flowlens.roles import Roles

CLUSTERS, SEED = 2, 42
# Layout of the training rows (least number of tasks, most rows of one), ending of the fit.
PARTITIONS, ROWS_PER_PARTITION, TOLERANCE, ROUNDS = 16, 100_000, 1e-9, 100
MIN_FEATURES = 3
PREDICTION, WEIGHT = "prediction", "_weight"


def feature_columns(roles: Roles) -> list[str]:
    names = ("src_bytes", "dst_bytes", "duration", "count", "srv_count")
    columns = [getattr(roles, name) for name in names if roles.has(name)]
    if len(columns) < MIN_FEATURES:
        raise ValueError(f"clustering needs {MIN_FEATURES} feature columns, found {columns}")
    return columns


def _assembler(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features")


def feature_vector(df: DataFrame, roles: Roles) -> DataFrame:
    """``features``: bytes, duration and, where present, connection counters."""
    return _assembler(feature_columns(roles)).transform(df)


def _means(k: int, seed: int, scale: bool) -> KMeans:
    source = "scaled" if scale else "features"
    return KMeans(k=k, seed=seed, featuresCol=source, tol=TOLERANCE, maxIter=ROUNDS)


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True)


def cluster_pipeline(
    columns: list[str], k: int = CLUSTERS, seed: int = SEED, scale: bool = False
) -> Pipeline:
    stages = [_assembler(columns), *([_scaler()] if scale else []), _means(k, seed, scale)]
    return Pipeline(stages=stages)


def _placed(counted: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """Distinct rows, dealt out and sorted by value, in ``partitions`` tasks at least.

    Training starts from rows it picks by place. This gives each row the same
    place whatever files and cores there are. A frequent row is one row with a
    weight, however often it occurs.
    """
    partitions = max(partitions, -(-counted.count() // ROWS_PER_PARTITION))
    return counted.repartition(partitions, *columns).sortWithinPartitions(*columns)


def fit_clusters(
    df: DataFrame,
    roles: Roles,
    k: int = CLUSTERS,
    seed: int = SEED,
    scale: bool = False,
    partitions: int = PARTITIONS,
) -> PipelineModel:
    """The fitted pipeline, trained on distinct feature rows weighted by their number."""
    return _fitted(df, roles, k, seed, scale, partitions)[0]


def _fitted(df, roles, k, seed, scale, partitions) -> tuple[PipelineModel, list[int]]:
    """The fitted pipeline, and its cluster numbers from the largest cluster to the smallest."""
    columns = feature_columns(roles)
    features = df.select(*columns)
    stages = [_assembler(columns)]
    if scale:
        # The scaler knows no weights: its means and deviations come from the rows themselves.
        stages.append(_scaler().fit(stages[0].transform(features)))
    counted = stage(features.groupBy(*columns).agg(F.count("*").cast("double").alias(WEIGHT)), "feature-counts")
    prepared = PipelineModel(list(stages))
    means = _means(k, seed, scale).setWeightCol(WEIGHT)
    # The fit keeps its own copy of the rows while it runs.
    placed = prepared.transform(_placed(counted, columns, partitions))
    stages.append(means.fit(placed.select(means.getFeaturesCol(), WEIGHT)))
    # At most k rows.
    sizes = dict(stages[-1].transform(prepared.transform(counted)).groupBy(PREDICTION).agg(F.sum(WEIGHT)).collect())
    return PipelineModel(stages), sorted(range(k), key=lambda c: (-sizes.get(c, 0), c))


def cluster(
    df: DataFrame,
    roles: Roles,
    k: int = CLUSTERS,
    seed: int = SEED,
    scale: bool = False,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Every row with the number of its k-means cluster in ``prediction``, 0 for the largest."""
    model, by_size = _fitted(df, roles, k, seed, scale, partitions)
    found = model.transform(df).drop("features", "scaled")
    place = {number: rank for rank, number in enumerate(by_size)}
    numbers = F.create_map(*(F.lit(x) for pair in place.items() for x in pair))
    return found.withColumn(PREDICTION, numbers[F.col(PREDICTION)])


def cluster_sums(clustered: DataFrame, roles: Roles) -> DataFrame:
    """Rows and means per cluster, from which the reports below follow."""
    src, dst, duration = roles.need("src_bytes", "dst_bytes", "duration")
    return clustered.groupBy(PREDICTION).agg(
        F.count("*").alias("count"),
        F.avg(src).alias("avg_src_bytes"),
        F.avg(dst).alias("avg_dst_bytes"),
        F.avg(duration).alias("avg_duration"),
    )


def profile_of(sums: DataFrame) -> DataFrame:
    return sums.drop("avg_duration")


def _smallest(sums: DataFrame, k: int) -> DataFrame:
    """The cluster with fewest rows (lowest number on a tie) if all k are in use.

    Works on the at most k rows left after the aggregation.
    """
    low = F.min(F.struct("count", PREDICTION, "avg_src_bytes", "avg_dst_bytes", "avg_duration"))
    found = sums.agg(low.alias("low"), F.sum("count").alias("total"), F.count("*").alias("used"))
    return found.filter(F.col("used") == k).select("low.*", "total")


def anomaly_report_of(sums: DataFrame, k: int = CLUSTERS) -> DataFrame:
    return _smallest(sums, k).select(
        F.col("count").alias("anomaly_count"),
        share(F.col("count"), F.col("total")).alias("anomaly_ratio"),
        "avg_src_bytes",
        "avg_dst_bytes",
        "avg_duration",
    )


def cluster_profile(clustered: DataFrame, roles: Roles) -> DataFrame:
    """Rows and mean bytes per cluster."""
    return profile_of(cluster_sums(clustered, roles))


def anomaly_report(clustered: DataFrame, roles: Roles, k: int = CLUSTERS) -> DataFrame:
    """Count, share and means of the smallest cluster, from one pass over the rows."""
    return anomaly_report_of(cluster_sums(clustered, roles), k)


def anomalies(clustered: DataFrame, roles: Roles, k: int = CLUSTERS) -> DataFrame:
    """Rows of the smallest cluster; none unless every cluster has rows."""
    # At most one row.
    smallest = _smallest(cluster_sums(clustered, roles), k).select(PREDICTION)
    return clustered.join(F.broadcast(smallest), PREDICTION, "left_semi")
