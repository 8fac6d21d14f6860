"""The corpus queries: registered, and equal to their SQL on the smallest table."""

import __spark_entry__ as E
import pytest
from oracle_check import digest, duck
from rankfold.llm.oracle import ORACLE
from rankfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{k}" for k in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"op3_language_mixture", "op5_layout_text", "op7_bottom_k_fingerprints", "op8_best_fit_packing", "op9_skip_chain_pii"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SF).execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]
