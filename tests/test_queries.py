import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry_module.REGISTERED)
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    found = entry_module.entry(spark)
    assert found.columns == ["vec_id", "classifier", "label", "score"] and found.count() > 0


def test_every_query_has_sql():
    assert all(sql for _, sql in entry_module.REGISTERED.values())
    assert entry_module.REGISTERED.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("names", [[""], ["/part-0.parquet", "/part-1.parquet", "/000000_0"], ["/label=1/a.parquet", "/label=2/a.parquet"]])
def test_incremental_scores_all_files_of_the_table(spark, tmp_path, names):
    (tmp_path / "other.parquet").write_text("no table")
    for k, name in enumerate(names):
        path = tmp_path / f"embeddings.parquet{name}"
        path.parent.mkdir(parents=True, exist_ok=True)
        vectors = [[x] + [0.0] * 63 for x in (4, 8 * (k + 1), 0)]
        pq.write_table(pa.table({"vec_id": [k, k, None], "embedding": pa.array(vectors, pa.list_(pa.float32()))}), path)
    found = [tuple(r) for r in entry_module.queries()["score_incremental"](spark, str(tmp_path)).collect()]
    # the first weight of the classes is -8/16, 5/16 and 1/16, their bias 0.125, -0.25 and 0
    wanted = [r for k in range(len(names)) for r in ((k, "c1", 1.0), (k, "c1", 2.5 * (k + 1) - 0.25), (k, "c2", 0.5 * (k + 1)))]
    assert sorted(found) == sorted((k, "first", label, score) for k, label, score in wanted)
