"""Every registered query against its SQL on the smallest test tables, and the package's layout."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from corpuskit.plans import core_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def canonical(names, records):
    order = sorted(names)
    at = [names.index(n) for n in order]

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(v)
        return v

    return order, sorted((tuple(cell(r[i]) for i in at) for r in records), key=lambda r: [str(v) for v in r])


def check(spark, name, query, sql):
    import duckdb

    df = query(spark, DATA)
    assert len(set(df.columns)) == len(df.columns)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert canonical(df.columns, got) == canonical(names, found.fetchall())


@pytest.mark.parametrize("name", sorted(core_queries.queries()))
def test_core_query(spark, name):
    check(spark, name, core_queries.queries()[name], core_queries.oracle_sql().get(name))


def test_entry(spark):
    assert callable(entry.entry) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core_queries.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["q_cosine_neighbours", "q_semantic_edges", "q_semantic_prune", "q_tight_units"])
def test_repeated_vectors(spark, tmp_path, monkeypatch, name):
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 8))
    base[10:14] = base[:4] + rng.normal(size=(4, 8)) * 0.2
    of = [*range(20), *rng.integers(0, 20, 25), *[3] * 12]
    of = [of[i] for i in rng.permutation(len(of))]
    data = [(i, int(v) % 2, [float(x) for x in base[v]]) for i, v in enumerate(of)]
    spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/t")
    os.rename(glob.glob(f"{tmp_path}/t/*.parquet")[0], f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr("tests.test_queries.DATA", str(tmp_path))
    check(spark, name, core_queries.queries()[name], core_queries.oracle_sql()[name])
