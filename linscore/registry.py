"""Linear classifiers: read, checked and set out as a registry.

A classifier is small (dims x classes weights) and comes as JSON in one of several shapes. Reading
and checking it is driver work done once; what scoring gets is a ``ClassifierSet``, whose weights
are stacked side by side so that one pass over the embeddings serves all classifiers.
"""

from __future__ import annotations

import base64
import json
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property
from numbers import Real
from os import PathLike
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The keys of a classifier's JSON form and their defaults.
NAME_KEYS = ("classifier_name", "name", "recognizer_name")
RUN_KEYS = ("threshold", "threshold_array", "save_empty", "skip_existing")
DEFAULT_THRESHOLD = 0.0
NO_THRESHOLD = float(np.finfo(np.float32).min)

# Embedding models told by hub version, else by embedding width.
MODEL_BY_HUB_VERSION = {"4": "perch_8", "8": "perch_8"}
MODEL_BY_DIM = {1280: "perch_8", 1536: "perch_v2", 1024: "birdnet_v2.4"}

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("classifier", T.StringType(), False),
        T.StructField("class_idx", T.IntegerType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("beta", T.ArrayType(T.FloatType(), False), False),
        T.StructField("bias", T.FloatType(), False),
        T.StructField("threshold", T.FloatType(), False),
        T.StructField("save_empty", T.BooleanType(), False),
        T.StructField("skip_existing", T.BooleanType(), False),
        T.StructField("embedding_dim", T.IntegerType(), False),
        T.StructField("embedding_model", T.StringType(), True),
    ]
)


def path_part(name: str) -> str:
    """Classifier name as a path part (the driver-side twin of ``functions.names.sanitise_name``)."""
    return re.sub(r"[^A-Za-z0-9_-]", "", re.sub(r"\s+", "_", name))


def decode_floats(text: str) -> np.ndarray:
    """Base64 of little-endian float32 values."""
    return np.frombuffer(base64.b64decode(text.strip().encode("ascii"), validate=True), dtype="<f4")


def resolve_thresholds(labels: list[str], threshold: Any) -> np.ndarray:
    """One float32 per class from a number, None, a list or a dict.

    None stands for "no threshold"; a class missing from a dict gets 0.
    """
    if isinstance(threshold, Mapping):
        values = [threshold.get(label, DEFAULT_THRESHOLD) for label in labels]
    elif isinstance(threshold, list):
        if len(threshold) != len(labels):
            raise ValueError(f"{len(threshold)} thresholds given for {len(labels)} classes")
        values = threshold
    elif threshold is None or isinstance(threshold, Real):
        values = [threshold] * len(labels)
    else:
        raise TypeError("a threshold is a number, None, a list with one per class or a dict by class")
    wrong = [type(v).__name__ for v in values if not (v is None or isinstance(v, Real))]
    if wrong:
        raise TypeError(f"a class threshold must be a number or None, not {wrong[0]}")
    return np.array([NO_THRESHOLD if v is None else v for v in values], dtype=np.float64).astype(np.float32)


def _frozen(values: Any) -> np.ndarray:
    array = np.array(values, dtype=np.float32)
    array.setflags(write=False)
    return array


@dataclass(frozen=True, eq=False)
class Classifier:
    """One linear classifier, checked: ``weights`` is (dims, classes), the rest one per class."""

    name: str
    labels: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    thresholds: np.ndarray
    save_empty: bool = True
    skip_existing: bool = True
    model_config: Any = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "name", str(self.name).strip())
        object.__setattr__(self, "labels", tuple(self.labels))
        for attribute in ("weights", "bias", "thresholds"):
            object.__setattr__(self, attribute, _frozen(getattr(self, attribute)))
        object.__setattr__(self, "bias", self.bias.reshape(-1))
        if not self.name:
            raise ValueError("a classifier needs a name")
        if self.weights.ndim != 2:
            raise ValueError(f"beta must be a matrix of dims x classes, its shape is {self.weights.shape}")
        found = {
            "beta columns": self.weights.shape[1],
            "beta_bias values": self.bias.size,
            "thresholds": self.thresholds.size if self.thresholds.ndim == 1 else -1,
        }
        for what, count in found.items():
            if count != len(self.labels):
                raise ValueError(f"{len(self.labels)} classes do not match {count} {what}")

    @property
    def embedding_dim(self) -> int:
        return self.weights.shape[0]

    @property
    def embedding_model(self) -> str | None:
        outer = self.model_config if isinstance(self.model_config, Mapping) else {}
        inner = outer.get("model_config") or {}
        by_version = MODEL_BY_HUB_VERSION.get(str(inner.get("tfhub_version")))
        return by_version or MODEL_BY_DIM.get(self.embedding_dim)


@dataclass(frozen=True, eq=False)
class ClassifierSet:
    """Classifiers that run together: names differ, embedding width and model agree."""

    classifiers: tuple[Classifier, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "classifiers", tuple(self.classifiers))
        twice = sorted(n for n, k in Counter(c.name for c in self).items() if k > 1)
        if twice:
            raise ValueError(f"classifier names used more than once: {', '.join(twice)}")
        dims = sorted({c.embedding_dim for c in self})
        if len(dims) > 1:
            raise ValueError(f"classifiers of different embedding dims cannot run together: {dims}")
        models = sorted({c.embedding_model for c in self} - {None})
        if len(models) > 1:
            raise ValueError(f"classifiers of different embedding models cannot run together: {models}")

    def __iter__(self) -> Iterator[Classifier]:
        return iter(self.classifiers)

    def __len__(self) -> int:
        return len(self.classifiers)

    @property
    def embedding_dim(self) -> int | None:
        return self.classifiers[0].embedding_dim if self.classifiers else None

    @property
    def embedding_model(self) -> str | None:
        return next((c.embedding_model for c in self if c.embedding_model), None)

    @cached_property
    def columns(self) -> list[tuple[str, str]]:
        """(classifier, label) of every column of the stacked weights."""
        return [(c.name, str(label)) for c in self for label in c.labels]

    @cached_property
    def weights(self) -> np.ndarray:
        return np.concatenate([c.weights for c in self], axis=1)

    @cached_property
    def bias(self) -> np.ndarray:
        return np.concatenate([c.bias for c in self])

    @cached_property
    def thresholds(self) -> np.ndarray:
        return np.concatenate([c.thresholds for c in self])

    def check_path_parts(self) -> None:
        """Names that fall together as path parts would overwrite each other's output."""
        parts = Counter(path_part(c.name) for c in self)
        clashes = sorted(part for part, k in parts.items() if k > 1)
        if clashes:
            raise ValueError(f"several classifiers would write to the same output: {', '.join(clashes)}")

    def registry(self, spark: SparkSession) -> DataFrame:
        """The set as a table, one row per (classifier, class)."""
        rows = [
            (
                c.name,
                k,
                str(label),
                c.weights[:, k].tolist(),
                float(c.bias[k]),
                float(c.thresholds[k]),
                c.save_empty,
                c.skip_existing,
                c.embedding_dim,
                c.embedding_model,
            )
            for c in self
            for k, label in enumerate(c.labels)
        ]
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def path_part_clashes(registry: DataFrame) -> DataFrame:
    """Registry view of ``check_path_parts``: output names that several classifiers share."""
    from linscore.functions.names import sanitise_name

    return (
        registry.select("classifier")
        .distinct()
        .groupBy(sanitise_name(F.col("classifier")).alias("path_part"))
        .agg(F.count("*").alias("classifiers"))
        .where("classifiers > 1")
    )


# ---- reading -------------------------------------------------------------------------------


def _find(spec: Mapping, section: str, keys: tuple[str, ...]) -> Any:
    """Value under any of ``keys``: the named section decides if it has one, else the outer object."""
    nested = spec.get(section)
    place = nested if isinstance(nested, Mapping) and not keys_absent(nested, keys) else spec
    hits = {key: place[key] for key in keys if key in place}
    values = list(hits.values())
    if any(value != values[0] for value in values[1:]):
        raise ValueError(f"these keys disagree: {', '.join(hits)}")
    return values[0] if values else None


def keys_absent(mapping: Mapping, keys: tuple[str, ...]) -> bool:
    return not any(key in mapping for key in keys)


def _run_settings(spec: Mapping) -> dict[str, Any]:
    """Run settings present in an override, a null kept as null; a nested ``run_config`` wins."""
    nested = spec.get("run_config")
    layers = [spec, nested if isinstance(nested, Mapping) else {}]
    return {key: layer[key] for layer in layers for key in RUN_KEYS if key in layer}


def _fallback_name(labels: Any, index: int) -> str:
    if isinstance(labels, list) and len(labels) == 1:
        return re.sub(r"\s+", "_", str(labels[0]).strip().lower()) or f"classifier_{index}"
    if isinstance(labels, list) and labels:
        return f"classifier_{index}_{len(labels)}class"
    return f"classifier_{index}"


def resolve_name(spec: Mapping, index: int = 0, required: bool = False) -> str:
    """Name of a classifier object; without one it is made from the classes and the position."""
    given = _find(spec, "classifier", NAME_KEYS)
    if isinstance(given, str) and given.strip():
        return given.strip()
    if required:
        raise ValueError("the classifier has no name")
    return _fallback_name(_find(spec, "classifier", ("classes",)), index)


def _tensors(labels: list[str], beta: Any, bias: Any) -> tuple[np.ndarray, np.ndarray]:
    encoded = [isinstance(part, str) for part in (beta, bias)]
    if not any(encoded):
        return np.asarray(beta, dtype=np.float32), np.asarray(bias, dtype=np.float32)
    if not all(encoded):
        raise TypeError("beta and beta_bias must both be encoded or both be arrays")
    if not labels:
        raise ValueError("a classifier needs at least one class")
    try:
        flat = decode_floats(beta)
        return flat.reshape(-1, len(labels)), decode_floats(bias)
    except ValueError as problem:
        raise ValueError(f"the classifier's weights cannot be decoded: {problem}") from problem


def classifier_from_dict(spec: Mapping, index: int = 0, override: Mapping[str, Any] | None = None) -> Classifier:
    """Build a classifier from one JSON object; ``override`` are the settings an enclosing container has for it."""
    if not isinstance(spec, Mapping):
        raise ValueError(f"classifier {index} must be an object")
    needed = {key: _find(spec, "classifier", (key,)) for key in ("classes", "beta", "beta_bias")}
    missing = [key for key, value in needed.items() if value is None]
    if missing:
        raise ValueError(f"classifier {index} lacks {', '.join(missing)}")
    labels = list(needed["classes"])
    name = resolve_name(spec, index)

    # a null setting on the classifier itself counts as not given, on the container it is a value
    own = {key: _find(spec, "run_config", (key,)) for key in RUN_KEYS}
    settings = {key: value for key, value in own.items() if value is not None}
    settings |= override or {}

    weights, bias = _tensors(labels, needed["beta"], needed["beta_bias"])
    thresholds = settings.get("threshold_array")
    if thresholds is None:
        thresholds = resolve_thresholds(labels, settings.get("threshold", DEFAULT_THRESHOLD))
    return Classifier(
        name=name,
        labels=labels,
        weights=weights,
        bias=bias,
        thresholds=thresholds,
        save_empty=bool(settings.get("save_empty", True)),
        skip_existing=bool(settings.get("skip_existing", True)),
        model_config=_find(spec, "classifier", ("model_config",)),
    )


def _expanded(overrides: Any, names: list[str]) -> list[dict[str, Any]]:
    """A container's run_config as one settings dict per classifier; forms that mean nothing are errors."""

    def settings(given: Any, name: str) -> dict[str, Any]:
        if not (given is None or isinstance(given, Mapping)):
            raise ValueError(f"run_config of classifier {name!r} must be an object or null")
        return _run_settings(given or {})

    if overrides is None:
        given = [None] * len(names)
    elif isinstance(overrides, list):
        if len(overrides) != len(names):
            raise ValueError(f"{len(overrides)} run_config entries given for {len(names)} classifiers")
        given = overrides
    elif isinstance(overrides, Mapping):
        by_name = {key: settings(value, key) for key, value in overrides.items() if key not in RUN_KEYS}
        if by_name and len(by_name) < len(overrides):
            raise ValueError("run_config mixes run settings with classifier names")
        return [by_name.get(name, {}) if by_name else _run_settings(overrides) for name in names]
    else:
        raise ValueError("run_config must be an object or a list")
    return [settings(one, name) for one, name in zip(given, names)]


def read_json(path: str | PathLike, spark: SparkSession | None = None) -> Any:
    """JSON document at a local path, or through Spark at any path it can read."""
    if spark is not None and "://" in str(path):
        return json.loads(spark.read.text(str(path), wholetext=True).first()[0])
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def load_classifier(source: Any, index: int = 0, spark: SparkSession | None = None) -> Classifier:
    """One classifier from an object, a JSON path or a ready classifier."""
    if isinstance(source, Classifier):
        return source
    if isinstance(source, (str, PathLike)):
        source = read_json(source, spark)
        if isinstance(source, list):
            raise ValueError("the file holds a list of classifiers; use load_classifiers")
    elif not isinstance(source, Mapping):
        raise TypeError(f"no classifier can be made from {type(source).__name__}")
    return classifier_from_dict(source, index)


def load_classifiers(source: Any, spark: SparkSession | None = None) -> ClassifierSet:
    """Classifiers from an object, a list, a container with ``recognizers``, or a JSON path."""
    if isinstance(source, ClassifierSet):
        return source
    if isinstance(source, Classifier):
        return ClassifierSet((source,))
    if isinstance(source, (str, PathLike)):
        return load_classifiers(read_json(source, spark))
    if isinstance(source, Mapping) and "recognizers" in source:
        return _from_container(source)
    if isinstance(source, Mapping):
        return ClassifierSet((classifier_from_dict(source),))
    if isinstance(source, (list, tuple)):
        return ClassifierSet(
            tuple(s if isinstance(s, Classifier) else classifier_from_dict(s, i) for i, s in enumerate(source))
        )
    raise TypeError(f"no classifiers can be made from {type(source).__name__}")


def _from_container(spec: Mapping) -> ClassifierSet:
    members = spec["recognizers"]
    if isinstance(members, Mapping):
        members = [members]
    if not isinstance(members, list):
        raise ValueError("recognizers must be an object or a list")
    override = spec.get("run_config")
    if override is None:
        override = _run_settings(spec) or None
    names = [resolve_name(m, i) if isinstance(m, Mapping) else "" for i, m in enumerate(members)]
    settings = _expanded(override, names)
    return ClassifierSet(tuple(classifier_from_dict(m, i, s) for i, (m, s) in enumerate(zip(members, settings))))
