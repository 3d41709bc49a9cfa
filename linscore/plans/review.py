"""Review samples from a predictions file to a sample file, with the sample's score report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from linscore.functions.labels import parse_labels
from linscore.operators.sampling import sample_by_score_bins, stratified_sample
from linscore.operators.summary import score_distribution
from linscore.session import checkpointed
from linscore.sources.sinks import write_table
from linscore.sources.tables import read_predictions


def _stem(path: str) -> str:
    return path.rstrip("/").removesuffix(".csv")


def _finish(sample: DataFrame, path: str, bins: int, score_column: str) -> dict[str, DataFrame]:
    sample = checkpointed(sample)
    write_table(sample, path, "csv")
    return {"sample": sample, **score_distribution(sample, bins, score_column)}


def review_by_score(
    spark: SparkSession,
    predictions: str,
    n: int,
    output_path: str | None = None,
    *,
    score_column: str = "score",
    bins: int = 10,
    seed: int = 42,
    summary_bins: int = 10,
    id_columns: Sequence[str] | str | None = None,
) -> dict[str, DataFrame]:
    """Sample balanced over the score range."""
    ids = parse_labels(id_columns) if isinstance(id_columns, str) else id_columns
    sample = sample_by_score_bins(read_predictions(spark, predictions), n, score_column, bins, seed, ids)
    path = output_path or f"{_stem(predictions)}_score_uniform_binned_n{n}.csv"
    return _finish(sample, path, max(1, summary_bins), score_column)


def review_by_site_and_day(
    spark: SparkSession,
    predictions: str,
    output_path: str | None = None,
    *,
    n: int = 1,
    max_items: int = 500,
    seed: int = 42,
    score_column: str = "score",
    id_columns: Sequence[str] | str | None = None,
) -> dict[str, DataFrame]:
    """Sample spread over sites and days, uncertain scores first, capped at ``max_items``."""
    ids = parse_labels(id_columns) if isinstance(id_columns, str) else id_columns
    sample = stratified_sample(read_predictions(spark, predictions), n, max_items, seed, score_column, ids)
    path = output_path or f"{_stem(predictions)}_stratified_n{n}.csv"
    return _finish(sample, path, 10, score_column)
