"""A third of all lines in one order, a third of them for one part, most orders in one class."""

import duckdb
import pytest
from oracle_check import TABLES, differences, duck

from workloads.oracle import ORACLE
from workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    changes = {
        "lineitem": "* replace (case when l_linenumber % 3 = 0 then 1 else l_orderkey end as l_orderkey, "
        "case when (l_suppkey + l_linenumber) % 3 = 0 then 5 else l_partkey end as l_partkey)",
        "orders": "* replace (case when o_custkey % 4 > 0 then 'O' else o_orderstatus end as o_orderstatus)",
    }
    for name in TABLES:
        columns = changes.get(name, "*")
        duckdb.sql(f"copy (select {columns} from '{SF}/{name}.parquet') to '{folder}/{name}.parquet'")
    return str(folder)


def test_the_data_is_skewed(skewed):
    sizes = duckdb.sql(f"select count(*) from '{skewed}/lineitem.parquet' group by l_orderkey").fetchall()
    assert max(n for (n,) in sizes) > 0.25 * sum(n for (n,) in sizes)


@pytest.mark.parametrize(
    "name",
    [
        "forward_pass_sparse",
        "weight_gradient_sparse",
        "train_step_sparse",
        "sample_stratified",
        "assign_batches",
        "inline_values",
        "confusion_matrix_lines",
    ],
)
def test_skewed_results_are_whole(spark, skewed, name):
    assert differences(duck(skewed), QUERIES[name](spark, skewed), ORACLE[name]) is None
