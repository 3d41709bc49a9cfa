"""Score summaries: counts, exact quantiles, histogram. All take finite scores only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linscore.functions.scores import bin_edge, finite_number, is_text, left_closed_bin

# fixed values: the quantiles of a score report
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)

RANKED, PARTS = 50_000, 1024


def finite_scores(df: DataFrame, score_column: str = "score") -> DataFrame:
    """The table with its score as a finite double; rows without one are left out."""
    score = finite_number(F.col(score_column), is_text(df, score_column))
    return df.withColumn(score_column, score).where(F.col(score_column).isNotNull())


def score_summary(df: DataFrame, score_column: str = "score") -> DataFrame:
    """One row: count, min, max and mean."""
    score = F.col(score_column)
    return finite_scores(df, score_column).agg(
        F.count("*").alias("count"), F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean")
    )


def _cell(value: Column) -> Column:
    """Whole number that never falls as the value grows, some 180 to each doubling."""
    scaled = F.floor(F.lit(256.0) * F.log1p(F.abs(value) * F.lit(1e6))).cast("int")
    return F.when(value < 0, -scaled - 1).otherwise(scaled)


def score_quantiles(
    df: DataFrame, quantiles: Sequence[float] = QUANTILES, score_column: str = "score", exact: bool = True
) -> DataFrame:
    """Quantiles with linear interpolation, one row per ``quantile``.

    Exact without sorting or gathering the scores: they are counted per cell (a bounded number of
    cells), the cells that hold the wanted ranks are found and counted in finer parts until each holds at most
    ``RANKED`` scores or one value, and only the distinct values of those are ranked. ``exact=False`` gives
    Spark's approximate quantiles (no interpolation).
    """
    score = finite_scores(df, score_column).select(F.col(score_column).alias("value"))
    if not exact:
        found = score.agg(F.percentile_approx("value", [float(q) for q in quantiles], 10_000).alias("values"))
        wanted = F.array(*[F.lit(float(q)) for q in quantiles])
        return found.where("values is not null").select(
            F.inline(F.arrays_zip(wanted.alias("quantile"), F.col("values").alias("value")))
        )

    cell = _cell(F.col("value"))
    counts = [F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    found = score.groupBy(cell.alias("cell")).agg(*counts).orderBy("cell").collect()
    total = sum(r["n"] for r in found)
    schema = "quantile double, low bigint, high bigint, share double"
    places = [(float(q), int(q * (total - 1)), min(int(q * (total - 1)) + 1, total - 1)) for q in quantiles if total]
    wanted = df.sparkSession.createDataFrame([(q, lo, hi, q * (total - 1) - lo) for q, lo, hi in places], schema)
    ranks = sorted({r for _, lo, hi in places for r in (lo, hi)})

    def holding(rows: list, before: int) -> list[tuple[float, float, int, int]]:
        """Of value ranges in order those that hold a wanted rank: low, high, scores before them, scores in them."""
        held = []
        for row in rows:
            if any(before <= r < before + row["n"] for r in ranks):
                held.append((row["lo"], row["hi"], before, row["n"]))
            before += row["n"]
        return held

    spans = holding(found, 0)
    # a range with too many scores is counted again in finer parts, until few are left or all are equal
    while wide := [s for s in spans if s[3] > RANKED and s[0] < s[1]]:
        part = F.lit(None).cast("int")
        for k, (lo, hi, _, _) in enumerate(wide):
            share = F.least(F.floor((F.col("value") - lo) / (hi - lo) * PARTS), F.lit(PARTS - 1)).cast("int")
            part = F.when(F.col("value").between(lo, hi), share + k * PARTS).otherwise(part)
        finer = score.withColumn("part", part).where("part is not null").groupBy("part").agg(*counts).orderBy("part").collect()
        spans = [s for s in spans if s not in wide]
        for k, (_, _, before, _) in enumerate(wide):
            spans += holding([r for r in finer if r["part"] // PARTS == k], before)

    start, inside = F.lit(None).cast("bigint"), F.lit(False)
    for lo, hi, before, _ in spans:
        start = F.when(F.col("value").between(lo, hi), F.lit(before).cast("bigint")).otherwise(start)
        inside = inside | F.col("value").between(lo, hi)
    values = score.where(inside).groupBy("value").agg(F.count("*").alias("n"))
    running = Window.partitionBy("start").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        values.withColumn("start", start)
        .withColumn("end", F.col("start") + F.sum("n").over(running))
        .select("value", (F.col("end") - F.col("n")).alias("begin"), "end")
    )
    # each wanted rank as a short literal list: the ranked values are met without a join
    hits = ranked.select(
        "value",
        F.explode(
            F.filter(
                F.array(*[F.lit(r).cast("bigint") for r in ranks] or [F.lit(None).cast("bigint")]),
                lambda r: (r >= F.col("begin")) & (r < F.col("end")),
            )
        ).alias("rank"),
    )
    low = hits.select(F.col("rank").alias("low"), F.col("value").alias("low_value"))
    high = hits.select(F.col("rank").alias("high"), F.col("value").alias("high_value"))
    joined = wanted.join(low, "low").join(high, "high")
    value = F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("share")
    return joined.select("quantile", value.alias("value")).orderBy("quantile")


def score_histogram(df: DataFrame, bins: int = 10, score_column: str = "score") -> DataFrame:
    """Equal-width histogram, left-closed with the last bin closed; empty bins are listed too.

    When all scores are equal the range is widened by 0.5 to both sides.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    scores = finite_scores(df, score_column)
    score = F.col(score_column)
    facts = scores.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    lo, hi = facts["lo"], facts["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, low double, high double, count bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    counted = scores.groupBy(left_closed_bin(score, lo, hi, bins).alias("bin")).agg(F.count("*").alias("n"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counted, "bin", "left")
        .select(
            "bin",
            bin_edge(F.col("bin"), lo, hi, bins).alias("low"),
            bin_edge(F.col("bin") + 1, lo, hi, bins).alias("high"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def score_distribution(df: DataFrame, bins: int = 10, score_column: str = "score") -> dict[str, DataFrame]:
    """The score report of a sample: summary, quantiles and histogram."""
    return {
        "summary": score_summary(df, score_column),
        "quantiles": score_quantiles(df, score_column=score_column),
        "histogram": score_histogram(df, bins, score_column),
    }
