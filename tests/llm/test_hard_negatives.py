"""Table look-ups against plain inner products, mined rows against brute force and SQL, odd vectors."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import hard_negatives as H
from tickforge.llm import queries

VECTORS = "id long, label int, vector array<float>"


@pytest.mark.parametrize("dims,most", [(1, 1), (5, 300), (8, 255), (64, 146), (67, 1 << 20)])
def test_scores_are_inner_products(dims, most):
    r = np.random.RandomState(dims)
    a, c = (r.randint(-most, most + 1, (n, dims)).astype(np.int64) for n in (7, 50))
    a[0], c[0], c[1] = -most, most, -most
    planes = H.pack(c, most.bit_length() + 1)
    assert (H.unpack(planes, dims) == c).all()
    assert (H.scores(H.subset_sums(a, np.int64), planes) == c @ a.T).all()


def brute(rows, is_anchor, low=30, high=90, positives=5, negatives=10):
    one = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        one[i] = min(one.get(i, (label, q)), (label, q))
    out = []
    for a, (la, va) in one.items():
        if not is_anchor(a):
            continue
        s = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, (label, v) in one.items() if i != a)
        for ps, p, _ in [x for x in s if x[2] == la][:positives]:
            hits = [x for x in s if x[2] != la and low * -ps <= 100 * -x[0] <= high * -ps][:negatives]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 40)])
def test_mined_rows_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(H, "ANCHORS", blocks[0])
    monkeypatch.setattr(H, "CANDIDATES", blocks[1])
    r = np.random.RandomState(2)
    # Coarse components make ties, one label holds half of the rows, and one vector stands for many ids.
    v = np.round(r.randn(400, 6) * 2) / 16
    v[50:90] = v[50]
    label = np.where(r.rand(400) < 0.5, 0, r.randint(0, 4, 400))
    rows = [(int(i), int(k), [float(x) for x in w]) for i, k, w in zip(range(-20, 380), label, v)]
    d = spark.createDataFrame(rows, VECTORS)
    got = sorted(map(tuple, H.mine(d, F.col("id") % 10 == 0).collect()))
    want = brute(rows, lambda i: i % 10 == 0)
    assert got == want and len(want) > 500


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [9.0, 9.0]), (1, 1, [0.9, 0.5]), (2, 1, [0.8]), (3, 2, [0.5, 0.1]), (3, 2, [0.5, 0.1]), (4, 2, []), (5, None, [1.0, 1.0]), (6, 2, None),
        (7, 2, [None, 1.0]), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (None, 2, [0.6, 0.1]), (100, 3, [0.2, 0.1]), (200, 4, [0.1, -5.0]), (201, 4, [0.1, 5.0]), (11, 5, [0.7, 0.1]),
    ]
    d = spark.createDataFrame(rows, VECTORS).withColumn("planes", F.lit("clash")).withColumn("score", F.lit(1))
    want = brute([(i, k, v and [*v, 0.0, 0.0][:2] if v is not None and v != [] else ([0.0, 0.0] if v == [] else v)) for i, k, v in rows], lambda i: i % 100 == 0)
    got = sorted(map(tuple, H.mine(d, F.col("id") % 100 == 0).collect()))
    assert got == want and {x[0] for x in got} == {0}
    assert H.mine(d.limit(0), F.col("id") % 100 == 0).collect() == []
    assert H.mine(d, F.lit(False)).collect() == []
    assert H.mine(d.where("vector is null"), F.lit(True)).collect() == []
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([(1, 1, [1e9])], VECTORS), F.lit(True))


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    r = con.execute(queries.ORACLE_SQL["op11_hard_negatives"])
    df = queries.op11_hard_negatives(spark, sf_dir)
    assert df.columns == [x[0] for x in r.description]
    want = sorted(r.fetchall())
    assert sorted(map(tuple, df.collect())) == want and want
