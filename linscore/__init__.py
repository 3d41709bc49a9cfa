"""Linear scoring of embeddings on Spark, and work with the detections that come of it."""

from linscore.operators.scoring import pack_features, score
from linscore.plans.classify import by_classifier, classify, classify_dataframe, classify_table, read_results
from linscore.plans.manifests import make_manifest
from linscore.plans.postprocess import postprocess
from linscore.plans.review import review_by_score, review_by_site_and_day
from linscore.registry import Classifier, ClassifierSet, load_classifier, load_classifiers
from linscore.session import configure

__version__ = "0.1.0"

__all__ = [
    "Classifier",
    "ClassifierSet",
    "by_classifier",
    "classify",
    "classify_dataframe",
    "classify_table",
    "configure",
    "load_classifier",
    "load_classifiers",
    "make_manifest",
    "pack_features",
    "postprocess",
    "read_results",
    "review_by_score",
    "review_by_site_and_day",
    "score",
]
