"""Each query of the engine against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from lodestone.plans.catalogue import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, DATA)
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(got.columns)) for r in got.collect())))
    if name in SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        want = con.execute(SQL[name])
        names = [x[0] for x in want.description]
        order = [names.index(c) for c in sorted(got.columns)]
        assert len(names) == len(got.columns)
        assert rows == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
