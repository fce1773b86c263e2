import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    df = _entry().entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert "sum_qty" in df.columns and "count_order" in df.columns


def test_every_oracle_has_a_query():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
