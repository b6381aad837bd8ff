"""Every query that has SQL against it: rows, columns and values, exactly."""

from collections import Counter

import duckdb
import pytest

from daybook.llm.oracles import ORACLE
from daybook.llm.queries import QUERIES


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name, sf):
    folder = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    rows = QUERIES[name](spark, folder)
    assert sorted(rows.columns) == sorted(columns)
    assert Counter(map(tuple, rows.select(columns).collect())) == Counter(found.fetchall())
