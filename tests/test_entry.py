import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from corpusloom.oracle import ORACLE
from corpusloom.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FAST = [
    "read_corpus_lang", "pretokenize_gpt2", "pretokenize_gpt4", "pretoken_counts", "top_pair", "merge_trace",
    "encode_text", "encode_pretoken", "tokenize_documents", "pack_small_shards", "epochs", "choice_accuracy_by_rank",
    "step_log_report",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert [r["token_id"] for r in rows] == list(range(256, 268))


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    with duckdb.connect() as tables:
        for path in glob.glob(f"{SF_DIR}/*.parquet"):
            view = os.path.basename(path).removesuffix(".parquet")
            tables.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
        found = tables.execute(contract.oracle_sql()[name])
        columns = [column[0] for column in found.description]
        expected = [tuple(row[columns.index(n)] for n in names) for row in found.fetchall()]
    ours = [tuple(row[n] for n in names) for row in df.collect()]
    assert sorted(columns) == names
    assert sorted(ours, key=repr) == sorted(expected, key=repr)
