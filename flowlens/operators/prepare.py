"""The usual preparation of the two kinds of tables before analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowlens.operators.balance import oversample
from flowlens.operators.clean import REL_ERROR, drop_unlabelled, impute_mean, remove_outliers
from flowlens.operators.derive import features
from flowlens.operators.encode import index_categories, index_labels, one_hot
from flowlens.operators.enrich import categorize
from flowlens.plans.staging import stage
from flowlens.roles import Roles

# Categorical columns that are encoded where present.
ENCODED = ("protocol_type", "service", "flag")


def prepare_flows(df: DataFrame, rel_error: float = REL_ERROR, balance: bool = False) -> DataFrame:
    """Cleaned flow table with derived features and encodings.

    ``balance`` also oversamples the small classes, for model training.
    """
    roles = Roles.resolve(df)
    # Written copies, so that the quantile and encoding passes do not go back to the CSV.
    labelled = stage(drop_unlabelled(df, roles), "labelled")
    clean = remove_outliers(impute_mean(labelled, roles=roles), roles, rel_error)
    clean = stage(clean, "clean")
    derived = features(clean, roles)
    encoded = [c for c in ENCODED if c in derived.columns]
    if encoded:
        derived = one_hot(derived, encoded)
    indexed = index_labels(derived, roles)
    return oversample(indexed, "label_index", "drawn") if balance else indexed


def prepare_connections(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Connection table with imputed measures, coded categories and attack categories."""
    roles = Roles.resolve(df)
    measures = [name for name, kind in df.dtypes if kind in ("float", "double")]
    named = df.dropna(subset=list(roles.need("attack")))
    coded = index_categories(impute_mean(named, measures), [c for c in ENCODED if c in df.columns])
    return categorize(coded, taxonomy, roles)
