"""Reproducible samples for human review.

Rows are drawn by a seeded hash of their identity: the same seed draws the same rows whatever the
partitioning, and a lost task redraws the same. To take the n smallest draws of very many rows the
draws are first counted per cell (a small, map-side combined count); only rows up to the cell where
the n-th lies go on, so no task sorts or collects more than about the sample itself.

With ``id_columns`` these alone decide; they must tell rows apart. An id that repeats among the rows up to the cell where the
sample ends is an error, be it twice or a million times, since its copies would win or lose together. Without, a row is known by all its columns, and exact copies are numbered first, so
that each is drawn for itself; which of the two holds is the caller's choice, never the data's.

Each operator reads small facts first (one aggregated row or one row per cell) and raises
``ValueError`` for inputs no sample can be drawn from.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linscore.functions.datetimes import utc_date
from linscore.functions.scores import (
    draw_cell,
    draw_hash,
    draw_uniform,
    finite_number,
    half_gaussian_weight,
    is_text,
    right_closed_bin,
)
from linscore.operators.copies import number_copies
from linscore.session import checkpointed

# up to here Spark limits groups before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold);
# it decides the plan only, never which rows are drawn
GROUP_LIMIT = 1000
SALTS = 1024


def _need(df: DataFrame, *columns: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"input lacks {', '.join(absent)}")


def _at_least_one(name: str, value: int) -> None:
    if value < 1:
        raise ValueError(f"{name} must be >= 1")


def round_robin_quotas(sizes: Mapping[int, int], n: int) -> dict[int, int]:
    """Rows each bin gives when n rows are picked in turns, bins in order, until they run out."""
    quotas = dict.fromkeys(sizes, 0)
    left = min(n, sum(sizes.values()))
    while left:
        open_bins = sorted(b for b in sizes if quotas[b] < sizes[b])
        rounds = min(left // len(open_bins), min(sizes[b] - quotas[b] for b in open_bins))
        takers = open_bins if rounds else open_bins[:left]
        for b in takers:
            quotas[b] += max(rounds, 1)
        left -= len(takers) * max(rounds, 1)
    return quotas


def _smallest_draws(rows: DataFrame, counts: list, quotas: Mapping[int, int], id_columns: Sequence[str]) -> DataFrame:
    """Rows with the ``quotas[bin]`` smallest draws of their bin; ``rows`` has _bin and _draw."""
    cells = defaultdict(list)
    for row in counts:
        cells[row["_bin"]].append((row["_cell"], row["n"]))
    last_cell, needed = {}, {}
    for b, found in cells.items():
        left = quotas[b]
        for cell, n in sorted(found):
            if not left:
                break
            last_cell[b], needed[b] = cell, left
            left -= min(left, n)
    last, need = (
        F.try_element_at(F.create_map(*[F.lit(x) for pair in m.items() for x in pair]), F.col("_bin"))
        for m in (last_cell, needed)
    )
    near = rows.withColumn("_cell", draw_cell(F.col("_draw")))
    # equal draws are equal ids; of the rows that the draw comes to see, about as many as the sample has, none may share one
    shared = near.where(F.col("_cell") <= last).groupBy("_draw").count().where("count > 1")
    if not shared.isEmpty():
        raise ValueError("id_columns do not tell rows apart: several of the rows to draw from share their ids")
    # only in a bin's last cell, a small part of the sample, is there anything to choose
    order = Window.partitionBy("_bin").orderBy("_draw", *[F.col(f"`{c}`") for c in id_columns])
    ranked = near.where(F.col("_cell") == last).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= need)
    return near.where(F.col("_cell") < last).unionByName(ranked.drop("_rank"))


def _cell_counts(rows: DataFrame) -> list:
    # at most bins x some hundred cells, whatever the number of rows
    return rows.groupBy("_bin", draw_cell(F.col("_draw")).alias("_cell")).agg(F.count("*").alias("n")).collect()


def sample_max_items(
    df: DataFrame, max_items: int, seed: int = 42, id_columns: Sequence[str] | None = None
) -> DataFrame:
    """Exactly ``max_items`` rows drawn evenly; a table with no more rows is returned as it is."""
    _at_least_one("max_items", max_items)

    rows, ids = _told_apart(df, id_columns)
    drawn = rows.withColumn("_bin", F.lit(0)).withColumn("_draw", draw_hash(seed, ids))
    counts = _cell_counts(drawn)
    if sum(row["n"] for row in counts) <= max_items:
        return df
    return _smallest_draws(drawn, counts, {0: max_items}, ids).select(*df.columns)


def _told_apart(df: DataFrame, id_columns: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """The rows and the columns that tell them apart: the given ids, or all columns and a copy's number."""
    if id_columns:
        return df, list(id_columns)
    return number_copies(df, "_copy"), [*df.columns, "_copy"]


def sample_by_score_bins(
    df: DataFrame,
    n: int,
    score_column: str = "score",
    bins: int = 10,
    seed: int = 42,
    id_columns: Sequence[str] | None = None,
) -> DataFrame:
    """``n`` rows balanced over equal-width score bins (right-closed), negatives included.

    Bins are served in turns until n rows are picked; a bin that runs out leaves its turns to the
    others. Rows without a finite score take no part; if there are no more than n rows with one,
    all of them are returned.
    """
    _at_least_one("bins", bins)
    _at_least_one("n", n)
    _need(df, score_column)
    valid = df.withColumn("_score", finite_number(F.col(score_column), is_text(df, score_column))).where("_score is not null")
    facts = valid.agg(F.count("*").alias("n"), F.min("_score").alias("lo"), F.max("_score").alias("hi")).first()
    if not facts["n"]:
        raise ValueError(f"column {score_column!r} has no valid numbers")
    if facts["n"] <= n:
        return valid.select(*df.columns)
    lo, hi = facts["lo"], facts["hi"]
    binned = F.lit(0) if lo == hi else right_closed_bin(F.col("_score"), lo, hi, bins)

    rows, ids = _told_apart(valid, id_columns)
    drawn = rows.withColumn("_bin", binned).withColumn("_draw", draw_hash(seed, ids))
    counts = _cell_counts(drawn)
    sizes = defaultdict(int)
    for row in counts:
        sizes[row["_bin"]] += row["n"]
    return _smallest_draws(drawn, counts, round_robin_quotas(sizes, n), ids).select(*df.columns)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each group, a group of any size.

    For small n Spark cuts each group to n rows within every map task before the shuffle; for large
    n the group is first cut within salted parts.
    """
    def cut(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")

    if n <= GROUP_LIMIT:
        return cut(df, keys)
    # the partition's number spreads exact copies; whatever the salt, the first n of all are among the
    # first n of each part
    salt = F.xxhash64(*order) + F.spark_partition_id()
    salted = df.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
    return cut(cut(salted, [*keys, "_salt"]).drop("_salt"), keys)


def sample_by_site_and_day(
    df: DataFrame,
    n: int,
    seed: int = 42,
    score_column: str = "score",
    id_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Up to ``n`` rows per (site_id, UTC day), scores near zero preferred, sorted by site and time.

    Drawing without replacement with half-Gaussian weights ``exp(-s²/2σ²)``, as an exponential race:
    the rows with the smallest ``-ln(u)/w`` win, here in logarithms. σ is the population deviation
    of the finite scores >= 0 (1 if that is zero). Negative scores are never drawn; if no row can be
    drawn at all, the whole input comes back.
    """
    _at_least_one("n", n)
    _need(df, "site_id", "start_datetime", score_column)
    rows, ids = _told_apart(df, id_columns)
    working = rows.withColumn("_number", finite_number(F.col(score_column), is_text(df, score_column))).withColumn(
        "_date", utc_date(F.col("start_datetime").cast("string"))
    )
    number = F.when(F.col("_number") >= 0, F.col("_number"))
    facts = working.agg(F.count("_date").alias("dated"), F.stddev_pop(number).alias("sigma")).first()
    if not facts["dated"]:
        raise ValueError("no start_datetime can be read")
    sigma = facts["sigma"] if facts["sigma"] and facts["sigma"] > 0 else 1.0
    if not is_text(df, score_column):
        working = working.where(F.col(score_column) >= 0)  # reaches the scan
    eligible = working.where(half_gaussian_weight(F.col("_number"), sigma) > 0)
    if eligible.isEmpty():
        return df
    race = race_key(draw_hash(seed, ids), F.col("_number"), sigma)
    order = ["_race", *[f"`{c}`" for c in ids]]
    drawn = first_per_group(eligible.withColumn("_race", race), ["site_id", "_date"], order, n)
    place = [F.asc_nulls_last(c) for c in ("site_id", "_date", "start_datetime")]
    return drawn.orderBy(*place, "_race").select(*df.columns)


def race_key(draw: Column, score: Column, sigma: float) -> Column:
    """Logarithm of ``-ln(u)/w``; smaller wins."""
    return F.log(-F.log(draw_uniform(draw))) + score * score / F.lit(2.0 * sigma * sigma)


def stratified_sample(
    df: DataFrame,
    n: int = 1,
    max_items: int = 500,
    seed: int = 42,
    score_column: str = "score",
    id_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Sample per site and day, then an even cap over the whole.

    The first sample is read twice by the second, so it is written out once in between.
    """
    per_day = checkpointed(sample_by_site_and_day(df, n, seed, score_column, id_columns))
    return sample_max_items(per_day, max_items, seed, id_columns)
