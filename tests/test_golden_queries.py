"""Golden hit counts for the fixed query set on the driver's ``documents`` tables."""

import os

import pytest

from quarry.plans import catalog

EXPECTED = {   # query_id: (status, hits at sf0.001, hits at sf0.01)
    1: ("hits", 75, 360), 2: ("hits", 32, 177), 3: ("hits", 8, 50), 4: ("hits", 127, 624),
    5: ("empty", 0, 0), 6: ("missing_term", 0, 0), 7: ("invalid", 0, 0), 8: ("invalid", 0, 0),
    9: ("invalid", 0, 0),
}


@pytest.mark.parametrize("sf,col", [("/root/testdata/sf0.001", 1), ("/root/testdata/sf0.01", 2)])
def test_fixed_query_set(spark, sf, col):
    if not os.path.exists(f"{sf}/documents.parquet"):
        pytest.skip("driver tables not present")
    rows = catalog.q_query_status(spark, sf).filter("query_id < 100").collect()
    got = {r.query_id: (r.status, r.n_hits) for r in rows}
    assert got == {q: (e[0], e[col]) for q, e in EXPECTED.items()}
