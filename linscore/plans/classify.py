"""Scoring of whole inputs: a file, a folder, a manifest or a table in hand.

A run writes its detections into a folder of its own, then its report. The report is what makes a
run's output count: ``read_results`` takes each (input, classifier) from the last run that reported
it, so a run that dies leaves nothing behind that would be read, and a repeated one replaces.

Each task writes a file per classifier. Where these are too many small ones they are merged, before the report,
into a folder that the report then names.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from linscore.functions.names import path_stem, sanitise_name
from linscore.functions.urls import url_to_output_path
from linscore.operators.manifest import collisions
from linscore.operators.runs import completed_pairs, expected_pairs, run_report, worklist
from linscore.operators.scoring import (
    BYTES_PER_TASK,
    INPUT_ROWS,
    RESULT_SCHEMA,
    FileScoring,
    check_dims,
    pack_features,
    score,
    usable,
)
from linscore.registry import ClassifierSet, load_classifiers, path_part
from linscore.sources.dialect import CSV_READ
from linscore.sources.files import check_footers, parquet_footers
from linscore.sources.sinks import FILE_BYTES, SPARE_FILES, empty_table, merge_files, part_sizes, write_table
from linscore.sources.storage import FileSystems, as_uri, bases, by_scheme, check_storage, list_files, uri_column
from linscore.sources.tables import is_line_form, read_manifest, recording_of

SCORING_TASKS = 100_000
WRITTEN, MERGED = "detections", "merged"
REPORT_SCHEMA = (
    "input string, output string, classifier string, status string, rows bigint, unusable bigint, message string, "
    "error string, output_saved boolean, output_format string, folder string, run string"
)


def classify_table(
    table: DataFrame | pa.Table | pd.DataFrame,
    config: Any,
    output_path: str | None = None,
    spark: SparkSession | None = None,
    output_format: str = "csv",
    name: str = "table",
    file_bytes: int = FILE_BYTES,
    spare_files: int = SPARE_FILES,
) -> DataFrame:
    """Detections of a wide table in hand, one ``classifier`` column telling them apart.

    With an ``output_path`` they are also written there, as a run of its own whose report names the table as
    input ``name``: earlier runs stay, and classifiers that skip existing output and have one for this input are
    not written again. ``read_results`` and ``report_of`` read them back.
    """
    classifiers = load_classifiers(config, spark)
    if isinstance(table, (pa.Table, pd.DataFrame)):
        table = (spark or SparkSession.active()).createDataFrame(table)
    elif not isinstance(table, DataFrame):
        raise TypeError(f"expected a DataFrame or Arrow table, got {type(table).__name__}")
    if output_path is not None:
        classifiers.check_path_parts()
    packed = table if "features" in table.columns else pack_features(table)
    if packed is not table:
        check_dims(len(table.columns) - len(packed.columns) + 1, classifiers)
    detections = score(packed, classifiers)
    if output_path is not None:
        _write_table_run(packed, classifiers, output_path, output_format, name, (file_bytes, spare_files))
    return detections


def _new_run() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _write_table_run(
    packed: DataFrame, classifiers: ClassifierSet, output_path: str, output_format: str, name: str, sizes: tuple[int, int]
) -> None:
    spark, run, folder = packed.sparkSession, _new_run(), WRITTEN
    inputs = spark.createDataFrame([(name, None)], "input string, error string")
    pairs, completed = expected_pairs(inputs, classifiers), _completed(spark, output_path, run)
    todo = pairs if completed is None else worklist(pairs, completed)
    wanted = {r["classifier"] for r in todo.select("classifier").collect()}  # a row per classifier
    counts = spark.createDataFrame([], "input string, classifier string, rows bigint")
    seen = Observation()
    if wanted:
        watched = packed.observe(seen, F.count_if(~usable("features", classifiers.embedding_dim)).alias("unusable"))
        detections = score(watched, ClassifierSet(tuple(c for c in classifiers if c.name in wanted)))
        detections = _with_path_part(detections.withColumn("input", F.lit(name)), classifiers)
        absent = [c for c in ("source", "channel", "offset") if c not in detections.columns]
        detections = detections.withColumns({c: F.lit(None) for c in absent}).select(
            *[F.col(c.split()[0]).cast(c.split()[1]) for c in RESULT_SCHEMA.split(", ")]
        )
        path = f"{output_path}/{WRITTEN}/run={run}"
        write_table(detections, path, output_format, ["classifier_path"])
        written = _read(spark, path, output_format, RESULT_SCHEMA)
        counts = written.groupBy("input", "classifier").agg(F.count("*").alias("rows"))
        folder = _merged(written, output_path, run, output_format, sizes)
    unusable = seen.get["unusable"] if wanted else 0
    facts = {"output": F.lit(None).cast("string"), "unusable": F.lit(unusable)}
    _write_report(run_report(pairs.withColumns(facts), completed, counts), output_path, run, output_format, folder)


def _merged(written: DataFrame, output_path: str, run: str, output_format: str, sizes: tuple[int, int]) -> str:
    """The folder whose files of a run count: those its tasks wrote, or fewer that these are merged into."""
    of_classifiers = part_sizes(written.sparkSession, f"{output_path}/{WRITTEN}/run={run}", "classifier_path").where(
        F.col("classifier_path") != INPUT_ROWS
    )
    merged = merge_files(written, of_classifiers, f"{output_path}/{MERGED}/run={run}", output_format, "classifier_path", *sizes)
    return MERGED if merged else WRITTEN


def _write_report(report: DataFrame, output_path: str, run: str, output_format: str, folder: str) -> DataFrame:
    """Writes a run's report, a table of its own in the folder of reports, and reads it back."""
    report = report.withColumns({"output_format": F.lit(output_format), "folder": F.lit(folder)})
    report.write.mode("overwrite").parquet(f"{output_path}/report/run={run}")
    if folder != WRITTEN:
        empty_table(report.sparkSession, f"{output_path}/{WRITTEN}/run={run}")
    return _reports(report.sparkSession, output_path).where(F.col("run") == run)


def report_of(spark: SparkSession, output_path: str) -> DataFrame:
    """What came of each input and classifier in every run: status, rows, message, error."""
    reports = _reports(spark, output_path)
    if reports is None:
        raise FileNotFoundError(f"no report under {output_path}")
    return reports


def classify_dataframe(
    dataframe: pd.DataFrame, config: Any, output_path: str | None = None, spark: SparkSession | None = None
) -> DataFrame:
    """``classify_table`` for pandas input only."""
    if not isinstance(dataframe, pd.DataFrame):
        raise TypeError(f"expected a pandas DataFrame, got {type(dataframe).__name__}")
    return classify_table(dataframe, config, output_path, spark)


def by_classifier(detections: DataFrame, classifiers: ClassifierSet) -> dict[str, DataFrame]:
    """The detections of each classifier on its own."""
    return {c.name: detections.where(F.col("classifier") == c.name).drop("classifier") for c in classifiers}


def _with_path_part(detections: DataFrame, classifiers: ClassifierSet) -> DataFrame:
    return detections.withColumn("classifier_path", sanitise_name(F.col("classifier")))


def classify(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    config: Any,
    *,
    output_format: str = "parquet",
    fail: bool = True,
    file_systems: FileSystems | None = None,
    file_bytes: int = FILE_BYTES,
    spare_files: int = SPARE_FILES,
) -> DataFrame:
    """Score a Parquet file, a folder of them or a JSON manifest; returns the run's report.

    Inputs that cannot be read, or have another number of features, are reported and do not stop
    the others; rows without usable features are counted. Once all is written, ``fail`` raises if any input failed.
    Names of inputs stay in tables, from the listing to the report. ``file_systems`` opens storages that pyarrow does not know.
    Detections are merged into files of about ``file_bytes`` where the tasks wrote ``spare_files`` more than those would be.
    """
    classifiers = load_classifiers(config, spark)
    classifiers.check_path_parts()
    find, run = file_systems or by_scheme(), _new_run()
    inputs = _inputs(spark, input_path, find)
    doubled = collisions(inputs, "output").limit(5).collect() if input_path.endswith(".json") else []
    if doubled:
        raise ValueError(f"outputs named more than once: {', '.join(sorted({r['output'] for r in doubled}))}")
    report = score_inputs(spark, inputs, output_path, classifiers, run, output_format, find, (file_bytes, spare_files))
    if report is None:
        raise RuntimeError(f"no parquet files found in {input_path}")
    failures = report.where("status = 'failed'").select("input").distinct().count() if fail else 0
    if failures:
        raise RuntimeError(f"{failures} inputs failed; see {output_path}/report, run {run}")
    return report


def score_inputs(
    spark: SparkSession,
    inputs: DataFrame,
    output_path: str,
    classifiers: ClassifierSet,
    run: str,
    output_format: str,
    find: FileSystems,
    sizes: tuple[int, int] = (FILE_BYTES, SPARE_FILES),
) -> DataFrame | None:
    """Scores files (``input, output``) as run ``run`` and reports each; None where there is no file.

    A run of the same name replaces all that an earlier one left. Footers give each file's row groups; these are the units of
    work, dealt over tasks together with the classifiers that their file still needs.
    """
    # written, not cached: a folder listed again later might hold other files
    inputs_path, detections_path = f"{output_path}/inputs/run={run}", f"{output_path}/{WRITTEN}/run={run}"
    folder = WRITTEN
    listed = parquet_footers(inputs.select("input").distinct(), find)
    listed.join(inputs, "input").write.mode("overwrite").parquet(inputs_path)
    footers = spark.read.parquet(inputs_path)
    if footers.isEmpty():
        return None
    checked = check_footers(footers, classifiers.embedding_dim) if len(classifiers) else footers
    pairs = expected_pairs(checked.select("input", "output", "error"), classifiers)
    completed = _completed(spark, output_path, run)
    todo = (pairs if completed is None else worklist(pairs, completed)).where("error is null")
    open_ = todo.groupBy("input").agg(F.array_sort(F.collect_set("place")).alias("open"))
    files = footers.select("input", "rows", "groups").distinct().join(open_, "input")
    size = files.agg(F.sum("rows").alias("rows"), F.sum("groups").alias("groups")).first()
    counts = spark.createDataFrame([], "input string, classifier string, rows bigint")
    told = spark.createDataFrame([], "input string, read bigint, unusable bigint, broken string")
    if size["groups"] and len(classifiers):
        bytes_ = size["rows"] * classifiers.embedding_dim * 4
        tasks = min(size["groups"], max(bytes_ // BYTES_PER_TASK, spark.sparkContext.defaultParallelism), SCORING_TASKS)
        work = files.select("input", "open", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))
        scoring = FileScoring(spark, classifiers, path_part)
        detections = scoring.detections(work.where("groups > 0").repartition(tasks), find)
        write_table(detections, detections_path, output_format, ["classifier_path"])
        scoring.close()
        written = _read(spark, detections_path, output_format, RESULT_SCHEMA)
        counts = written.where(F.col("classifier_path") != INPUT_ROWS).groupBy("input", "classifier").agg(F.count("*").alias("rows"))
        told = written.where(F.col("classifier_path") == INPUT_ROWS).groupBy("input").agg(
            F.sum("channel").alias("read"), F.sum("offset").cast("bigint").alias("unusable"), F.min("label").alias("broken")
        )
        folder = _merged(written, output_path, run, output_format, sizes)
    useless = F.when((F.col("read") > 0) & (F.col("unusable") == F.col("read")), F.lit("no row has usable features"))
    facts = pairs.join(told, "input", "left").withColumn("error", F.coalesce("error", "broken", useless)).drop("read", "broken")
    return _write_report(run_report(facts, completed, counts), output_path, run, output_format, folder)


def _inputs(spark: SparkSession, input_path: str, find: FileSystems) -> DataFrame:
    """Inputs, each with the relative path its detections go by in the report.

    A manifest names these outputs or has them made from its sources; a folder has its tree mirrored.
    """
    base = bases(spark)
    if input_path.endswith(".json"):
        named = read_manifest(spark, input_path, multiline=not is_line_form(spark, input_path))
        rows = named.select(uri_column(F.col("source"), base).alias("input"), "output")
        # one source of each storage, of which there are few, tells whether it can be used
        scheme = F.regexp_extract("input", "^([^:]*:/*[^/]*)", 1)
        each = rows.groupBy(F.when(F.startswith("input", F.lit("file:")), F.lit("file:")).otherwise(scheme)).agg(F.min("input").alias("one"))
        check_storage([r["one"] for r in each.collect()], find)
        by_stem = F.concat(path_stem(F.url_decode(F.col("input"))), F.lit(".csv"))
        made = F.coalesce("output", url_to_output_path(F.col("input")), by_stem)
        # a source may have several outputs: it is scanned once, and each output reported
        return rows.select("input", made.alias("output")).distinct()
    files = list_files(spark, input_path, "*.parquet", find)
    root = as_uri(input_path, base).rstrip("/") + "/"
    inside = F.when(F.startswith("input", F.lit(root)), F.substring("input", len(root) + 1, 1 << 30))
    path = F.coalesce(inside, F.regexp_extract("input", "([^/]*)$", 1))
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return files.select("input", F.regexp_replace(path, r"\.parquet$", ".csv").alias("output"))


def _read(spark: SparkSession, path: str, output_format: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.options(**CSV_READ).csv(path) if output_format == "csv" else reader.parquet(path)


def _reports(spark: SparkSession, output_path: str) -> DataFrame | None:
    try:
        # reports of earlier versions have no folder
        return spark.read.schema(REPORT_SCHEMA).parquet(f"{output_path}/report")
    except AnalysisException:
        return None


def _completed(spark: SparkSession, output_path: str, run: str) -> DataFrame | None:
    """Pairs done by other runs than this one, which may be the repetition of one that broke off."""
    reports = _reports(spark, output_path)
    return None if reports is None else completed_pairs(reports.where(F.col("run") != run))


def read_results(spark: SparkSession, output_path: str) -> DataFrame:
    """All detections under an output path, each (input, classifier) from its last reported run."""
    reports = _reports(spark, output_path)
    if reports is None:
        raise FileNotFoundError(f"no report under {output_path}")
    last = Window.partitionBy("input", "classifier").orderBy(F.desc("run"))
    current = (
        reports.where("output_saved")
        .withColumn("rank", F.row_number().over(last))
        .where("rank = 1")
        .select("input", "classifier", "run")
    )
    runs = reports.where("status = 'ok'").select("run", "output_format", "folder").distinct().collect()
    parts = [
        _read(spark, f"{output_path}/{r['folder'] or WRITTEN}/run={r['run']}", r["output_format"], RESULT_SCHEMA).withColumn(
            "run", F.lit(r["run"])
        )
        for r in runs
    ]
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA).drop("classifier_path")
    return (
        reduce(DataFrame.unionByName, parts)
        .where(F.col("classifier_path") != INPUT_ROWS)
        .join(current, ["input", "classifier", "run"], "left_semi")
        .drop("run", "classifier_path")
    )


def recordings_of_runs(spark: SparkSession, output_path: str) -> tuple[DataFrame, DataFrame] | None:
    """Detections with the recording each belongs to, and all recordings with output; None where no run reported.

    A recording's id is the stem of the output that the report names for its input.
    """
    reports = _reports(spark, output_path)
    if reports is None:
        return None
    named = reports.select("input", recording_of(F.col("output")).alias("audio_recording_id"))
    named = named.where("audio_recording_id is not null").distinct()
    saved = reports.where("output_saved").select("input").distinct()
    completed = named.join(saved, "input", "left_semi").select("audio_recording_id").distinct()
    detections = read_results(spark, output_path).join(named, "input").drop("input")
    return detections, completed
