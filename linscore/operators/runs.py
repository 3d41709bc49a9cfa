"""What is to be scored, and what came of it: one row per (input, classifier)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linscore.registry import ClassifierSet

def expected_pairs(inputs: DataFrame, classifiers: ClassifierSet) -> DataFrame:
    """Each input once per classifier, with the classifier's settings and its place in the set."""
    each = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("classifier"),
                F.lit(c.save_empty).alias("save_empty"),
                F.lit(c.skip_existing).alias("skip_existing"),
                F.lit(k).alias("place"),
            )
            for k, c in enumerate(classifiers)
        ]
    )
    kind = "array<struct<classifier:string,save_empty:boolean,skip_existing:boolean,place:int>>"
    return inputs.select("*", F.inline(each.cast(kind)))


def worklist(pairs: DataFrame, completed: DataFrame) -> DataFrame:
    """Pairs still to be done: those completed earlier fall out where the classifier skips existing."""
    done = completed.select("input", "classifier", F.lit(True).alias("skip_existing"))
    return pairs.join(done, ["input", "classifier", "skip_existing"], "left_anti").select(*pairs.columns)


def completed_pairs(report: DataFrame) -> DataFrame:
    """Pairs of a report that have output; an empty result has one only if it is to be saved."""
    return report.where("status = 'ok' or (status = 'empty' and output_saved)").select("input", "classifier").distinct()


def run_report(pairs: DataFrame, completed: DataFrame | None, counts: DataFrame) -> DataFrame:
    """Status of each pair: skipped, failed, empty or ok, with its number of detections and of unusable rows.

    ``pairs`` has input, error, classifier, save_empty and skip_existing, and may name an output and have the number of
    ``unusable`` rows; ``counts`` has input, classifier and rows. Skipped and failed pairs have null unusable rows.
    """
    todo = pairs.withColumn("earlier", F.lit(False))
    if completed is not None:
        done = completed.select("input", "classifier", F.lit(True).alias("earlier"))
        todo = pairs.join(done, ["input", "classifier"], "left")
    earlier = F.coalesce(F.col("earlier") & F.col("skip_existing"), F.lit(False))
    # detections of an input that could not be read to its end do not count
    found = F.when(F.col("error").isNull(), F.coalesce(F.col("rows"), F.lit(0))).otherwise(F.lit(0).cast("bigint"))
    unusable = F.coalesce(F.col("unusable"), F.lit(0)) if "unusable" in pairs.columns else F.lit(0)
    unusable = unusable.cast("bigint")
    status = (
        F.when(earlier, "skipped").when(F.col("error").isNotNull(), "failed").when(found == 0, "empty").otherwise("ok")
    )
    message = (
        F.when(F.col("status") == "skipped", "output exists already")
        .when((F.col("status") == "empty") & ~F.col("save_empty"), "no score passed, no output")
        .when(F.col("status") == "empty", "no score passed")
        .otherwise("")
    )
    return (
        todo.join(counts.select("input", "classifier", "rows"), ["input", "classifier"], "left")
        .withColumn("status", status)
        .select(
            "input",
            *[c for c in pairs.columns if c == "output"],
            "classifier",
            "status",
            found.alias("rows"),
            F.when(F.col("status").isin("ok", "empty"), unusable).alias("unusable"),
            message.alias("message"),
            F.when(F.col("status") == "failed", F.col("error")).alias("error"),
            ((F.col("status") == "ok") | ((F.col("status") == "empty") & F.col("save_empty"))).alias("output_saved"),
        )
    )


def run_counts(report: DataFrame) -> DataFrame:
    """Number of pairs per status."""
    return report.groupBy("status").agg(F.count("*").alias("n"))


def run_inputs(report: DataFrame) -> DataFrame:
    """One row: inputs processed, without any failure, and with one."""
    per_input = report.groupBy("input").agg(F.max((F.col("status") == "failed").cast("int")).alias("failed"))
    return per_input.agg(
        F.count("*").alias("processed"),
        F.coalesce(F.sum(1 - F.col("failed")), F.lit(0)).alias("succeeded"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    )
