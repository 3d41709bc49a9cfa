import base64
import dataclasses
import json

import numpy as np
import pytest

from linscore.registry import (
    NO_THRESHOLD,
    Classifier,
    ClassifierSet,
    classifier_from_dict,
    load_classifier,
    load_classifiers,
    path_part_clashes,
    resolve_name,
    resolve_thresholds,
)


def encoded(values) -> str:
    return base64.b64encode(np.asarray(values, dtype="<f4").tobytes()).decode()


def spec(classes=("a", "b"), dim=4, **more):
    rng = np.random.default_rng(42)
    return {
        "classes": list(classes),
        "beta": encoded(rng.standard_normal((dim, len(classes)))),
        "beta_bias": encoded(rng.standard_normal(len(classes))),
        **more,
    }


def test_encoded_weights_are_row_major():
    weights, bias = np.arange(6, dtype="f4").reshape(3, 2), np.array([5, 6], "f4")
    made = classifier_from_dict({"classes": ["x", "y"], "beta": encoded(weights), "beta_bias": encoded(bias)})
    np.testing.assert_array_equal(made.weights, weights)
    np.testing.assert_array_equal(made.bias, bias)
    assert made.embedding_dim == 3 and made.weights.dtype == np.float32


def test_plain_arrays_and_bias_layouts():
    made = classifier_from_dict({"classes": ["x", "y"], "beta": [[1, 2], [3, 4]], "beta_bias": [[1], [2]]})
    assert made.bias.tolist() == [1, 2]


@pytest.mark.parametrize(
    "change",
    [
        {"beta": "not base64!"},
        {"beta": encoded([1, 2, 3])},
        {"beta_bias": encoded([1, 2, 3])},
        {"beta": None},
        {"beta_bias": None},
        {"classes": None},
        {"classes": []},
        {"beta": [[1, 2, 3]], "beta_bias": [0, 0]},
        {"beta": [1, 2], "beta_bias": [0, 0]},
        {"threshold_array": [0.5]},
        {"threshold": [0.5]},
    ],
)
def test_bad_classifiers_are_refused(change):
    with pytest.raises(ValueError):
        classifier_from_dict({**spec(), **change})


def test_half_encoded_weights_are_refused():
    with pytest.raises(TypeError):
        classifier_from_dict({**spec(), "beta_bias": [0.0, 0.0]})


def test_missing_parts_and_bad_json(tmp_path):
    with pytest.raises(ValueError):
        load_classifiers({"other": "data"})
    broken = tmp_path / "broken.json"
    broken.write_text("{ not json }")
    with pytest.raises(json.JSONDecodeError):
        load_classifiers(broken)
    with pytest.raises(TypeError):
        load_classifiers(3)
    with pytest.raises(TypeError):
        load_classifier(3)
    with pytest.raises(FileNotFoundError):
        load_classifiers(str(tmp_path / "none.json"))


def test_thresholds():
    labels = ["a", "b", "c"]
    assert resolve_thresholds(labels, 0.5).tolist() == [0.5] * 3
    assert resolve_thresholds(labels, None).tolist() == [NO_THRESHOLD] * 3
    assert resolve_thresholds(labels, [1, None, -2]).tolist() == [1, NO_THRESHOLD, -2]
    assert resolve_thresholds(labels, {"a": 1, "b": None}).tolist() == [1, NO_THRESHOLD, 0]
    assert resolve_thresholds(labels, 0.1).dtype == np.float32
    for wrong in ("0.5", {"a": "0.5"}, ["x", 0, 0]):
        with pytest.raises(TypeError):
            resolve_thresholds(labels, wrong)


def test_null_threshold_means_zero_on_a_classifier_and_none_on_a_container():
    assert load_classifiers({**spec(), "threshold": None}).thresholds.tolist() == [0, 0]
    container = {"recognizers": [spec()], "run_config": {"threshold": None, "save_empty": None}}
    made = load_classifiers(container)
    assert made.thresholds.tolist() == [NO_THRESHOLD] * 2
    assert made.classifiers[0].save_empty is False and made.classifiers[0].skip_existing is True


def test_threshold_array_wins_and_null_in_it_passes_nothing():
    made = classifier_from_dict({**spec(), "threshold": 0.5, "threshold_array": [1.5, None]})
    assert made.thresholds[0] == 1.5 and np.isnan(made.thresholds[1])


def test_nested_keys_win_over_outer_ones():
    nested = {"classifier": spec(name="inner"), "classes": ["no"], "name": "outer", "threshold": 1, "run_config": {"threshold": 2}}
    made = classifier_from_dict(nested)
    assert made.name == "inner" and made.labels == ("a", "b") and made.thresholds.tolist() == [2, 2]


def test_names():
    assert resolve_name({"recognizer_name": "  r  "}) == "r"
    assert resolve_name({"name": "n", "classifier_name": "n"}) == "n"
    with pytest.raises(ValueError):
        resolve_name({"name": "n", "classifier_name": "m"})
    with pytest.raises(ValueError):
        resolve_name({"classes": ["x"]}, required=True)
    assert resolve_name({"classes": ["Big  Bird"]}, 3) == "big_bird"
    assert resolve_name({"classes": [" "]}, 3) == "classifier_3"
    assert resolve_name({"classes": ["a", "b", "c"]}, 1) == "classifier_1_3class"
    assert resolve_name({}, 2) == "classifier_2"


def test_container_overrides():
    members = [spec(name="one", threshold=0.3), spec(name="two", skip_existing=False)]

    def thresholds(run_config, **more):
        made = load_classifiers({"recognizers": members, "run_config": run_config, **more})
        return [c.thresholds[0] for c in made]

    third = np.float32(0.3)
    assert thresholds({"threshold": 0.9}) == [np.float32(0.9)] * 2
    assert thresholds({"two": {"threshold": 2}, "three": {"threshold": 3}}) == [third, 2]
    assert thresholds({"one": None}) == [third, 0]
    assert thresholds([{"threshold": 1}, None]) == [1, 0]
    assert thresholds([{"run_config": {"threshold": 4}}, {}]) == [4, 0]
    assert thresholds(None, threshold=7) == [7, 7]
    assert thresholds({"save_empty": False}, threshold=7) == [third, 0]
    assert load_classifiers({"recognizers": members[0]}).classifiers[0].name == "one"
    for wrong in ({"threshold": 1, "one": {}}, [{}], {"one": 5}, "text", [1, 2]):
        with pytest.raises(ValueError):
            thresholds(wrong)
    with pytest.raises(ValueError):
        load_classifiers({"recognizers": 5})


def test_sets_must_agree():
    with pytest.raises(ValueError, match="more than once"):
        load_classifiers([spec(name="x"), spec(name="x")])
    with pytest.raises(ValueError, match="dims"):
        load_classifiers([spec(name="x"), spec(name="y", dim=5)])
    models = [spec(name="x", dim=1024), spec(name="y", dim=1024, model_config={"model_config": {"tfhub_version": 4}})]
    with pytest.raises(ValueError, match="models"):
        load_classifiers(models)
    assert load_classifiers([]).embedding_dim is None
    assert len(load_classifiers([load_classifier(spec(name="x")), spec(name="y")])) == 2


def test_embedding_models():
    def model(dim, config=None):
        return classifier_from_dict(spec(dim=dim, model_config=config)).embedding_model

    assert model(128) is None
    assert [model(d) for d in (1280, 1536, 1024)] == ["perch_8", "perch_v2", "birdnet_v2.4"]
    assert model(7, {"model_config": {"tfhub_version": "8"}}) == "perch_8"
    assert model(7, {"model_config": {"tfhub_version": 3}}) is None
    both = load_classifiers([spec(name="x", dim=7), spec(name="y", dim=7, model_config={"model_config": {"tfhub_version": 8}})])
    assert both.embedding_model == "perch_8" and both.embedding_dim == 7


def test_classifiers_are_frozen_and_inputs_untouched():
    source = spec(threshold_array=[1.0, 2.0])
    before = json.dumps(source)
    made = load_classifiers(source).classifiers[0]
    assert json.dumps(source) == before
    with pytest.raises(dataclasses.FrozenInstanceError):
        made.name = "other"
    with pytest.raises(ValueError):
        made.weights[0, 0] = 1


def test_json_files(tmp_path, spark):
    single, many = tmp_path / "single.json", tmp_path / "many.json"
    single.write_text(json.dumps({"classifier": spec(name="solo")}))
    many.write_text(json.dumps([spec(name="x"), spec(name="y")]))
    assert load_classifier(single).name == "solo"
    assert [c.name for c in load_classifiers(str(many))] == ["x", "y"]
    assert [c.name for c in load_classifiers(many.as_uri(), spark)] == ["x", "y"]
    with pytest.raises(ValueError):
        load_classifier(many)


def test_output_names_may_not_fall_together(spark):
    clash = load_classifiers([spec(name="a b"), spec(name="a_b!"), spec(name="c")])
    with pytest.raises(ValueError, match="a_b"):
        clash.check_path_parts()
    assert [tuple(r) for r in path_part_clashes(clash.registry(spark)).collect()] == [("a_b", 2)]
    load_classifiers([spec(name="a b"), spec(name="ab")]).check_path_parts()


def test_registry_table(spark):
    made = load_classifiers({"recognizers": [spec(name="x"), spec(("only",), name="y")], "threshold": 0.25})
    rows = made.registry(spark).orderBy("classifier", "class_idx").collect()
    assert [(r.classifier, r.class_idx, r.label, r.threshold) for r in rows] == [
        ("x", 0, "a", 0.25),
        ("x", 1, "b", 0.25),
        ("y", 0, "only", 0.25),
    ]
    np.testing.assert_array_equal(np.float32(rows[1].beta), made.classifiers[0].weights[:, 1])
    assert isinstance(made, ClassifierSet) and isinstance(made.classifiers[0], Classifier)
