import __spark_entry__ as entry


def test_registry_consistent():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    from quarry.plans.catalog import CATALOG
    rows_only = set(CATALOG) - set(sql)
    assert rows_only == {"kmeans_ml_k2", "kmeans_ml_k10", "kmeans_ml_k20", "cluster_report"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["query_id", "status", "n_terms", "n_hits"]
    assert {r.status for r in rows} <= {"hits", "empty", "missing_term", "invalid"}
    assert len(rows) > 9
