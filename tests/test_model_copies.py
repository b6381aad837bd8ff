"""The models of the model tests are computed once, also where rows are doubled."""

import datetime as dt
import os

from conftest import plan_text, rows
from daybook import catalog


def test_doubled_models_are_computed_once(spark, tmp_dir, monkeypatch):
    day = dt.datetime(2000, 5, 1)
    spark.createDataFrame([(k, 1, "F", 1.0, day, "1-URGENT") for k in (1, 2, 41, 82)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
                          ).write.parquet(os.path.join(tmp_dir, "orders.parquet"))
    spark.createDataFrame([(k, 7, n, 2.0, 10.0, day) for k in (1, 2, 41, 82) for n in (1, 2)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
                          ).write.parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    monkeypatch.setattr(catalog, "_written", lambda _spark, _name, df: df)
    facts = catalog._defective_star(spark, tmp_dir, "fact_order_items")["fact_order_items"]
    want = [(k, n) for k in (1, 2, 41, 82) for n in (1, 2)] + [(k, n) for k in (41, 82) for n in (1, 2)]
    assert rows(facts, "order_number", "order_line_number") == sorted(want)
    assert plan_text(facts).count("lineitem.parquet]") == 1
