"""Centroid clustering, whitening and near-duplicate vectors against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagecat.llm import neighbours, vafile, whitening
from pagecat.llm.common import written

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v string, k1 string, node string, cluster int, row long, block long"


def vectors(dims=64, n=150, seed=1):
    """Rows with every odd case: null, empty, short, zero, null and non-finite components, copies, no id."""
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, dims)).astype("f4")
    near = [base[3] + rnd.normal(size=dims).astype("f4") * 0.05 * k for k in range(1, 9)]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near])]
    rows += [(500, base[7].tolist()), (501, base[7].tolist()), (501, base[7].tolist()), (None, base[9].tolist()), (None, base[9].tolist())]
    rows += [(502, (2 * base[9]).tolist()), (600, None), (601, []), (602, base[0].tolist()[:-1]), (603, [0.0] * dims)]
    rows += [(604, [None] + base[0].tolist()[1:]), (605, [math.nan] + base[0].tolist()[1:]), (606, [math.inf] + base[0].tolist()[1:])]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "v", "k", "n", 2, 3, 4) for r in rows], SCHEMA).repartition(3)


def whole(rows, dims):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]


def kmeans(rows, dims, scale=1024, count=8, rounds=10):
    rows = whole(rows, dims)
    if not rows:
        return []
    x = np.floor(np.array([v for _, v in rows], "f4").astype("f8") * scale).astype(np.int64).reshape(len(rows), dims)
    order = sorted(range(len(rows)), key=lambda k: (hashlib.sha256(f"3:{'' if rows[k][0] is None else rows[k][0]}".encode()).hexdigest(), x[k].astype("<i4").tobytes()))
    c = x[order[:count]]
    for turn in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        own = d.argmin(axis=1)
        if turn < rounds:
            c = np.array([x[own == k].sum(axis=0) // (own == k).sum() if (own == k).any() else c[k] for k in range(len(c))])
    best = d.min(axis=1)
    digest = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in c]
    return sorted(
        ((rows[k][0], int(own[k]), int(best[k]), int(best[own == own[k]].sum()), int(best.sum()), digest[own[k]]) for k in range(len(rows))), key=str
    )


@pytest.mark.parametrize("rows", [vectors(), vectors()[:3], [(1, [0.5] * 64)] * 40, [], [(1, None)]], ids=["odd", "few", "ties", "empty", "null"])
def test_clusters_like_plain_rounds(spark, rows):
    out = vafile.clustered(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in out), key=str) == kmeans(rows, 64)


def test_clusters_fetch_less_than_all(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(8, 64))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = [(i, (centres[i % 8] + rnd.normal(size=64) * 0.06).tolist()) for i in range(2000)]
    kept = written(vafile.kept(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), "kept")
    model = vafile.fit(kept)
    assert model.rows == model.fetched[0] == 2000 and model.fetched[-1] < 500
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_vectors")]


def test_intervals_hold_the_distances():
    rnd = np.random.default_rng(3)
    x = rnd.integers(-500, 500, (400, 6))
    edges = np.array([[-500, -200, 0, 0, 90, 500]] * 6)
    centroids = rnd.integers(-300, 300, (5, 6))
    cells = np.stack([np.searchsorted(edges[d, 1:-1], x[:, d], side="right") for d in range(6)], axis=1)
    tables = vafile.lookup(edges, centroids)
    bounds = sum(tables[d][cells[:, d]] for d in range(6))
    mean = centroids.sum(axis=0) // 5
    true = ((x[:, None] - centroids) ** 2).sum(axis=2) - ((x - mean) ** 2).sum(axis=1)[:, None]
    assert (bounds[:, :5] <= true).all() and (true <= bounds[:, 5:]).all()
    found = vafile.decided(cells, tables)
    assert (found >= 0).any() and (found[found >= 0] == true.argmin(axis=1)[found >= 0]).all()


def test_too_large_components_stop_the_job(spark):
    with pytest.raises(Exception, match="beyond"):
        vafile.clustered(table(spark, [(1, [1e30] * 64)])).collect()
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(table(spark, [(1, [1e30] * 64)])).collect()


def plain_whitening(rows, dims, components=32):
    rows = whole(rows, dims)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n, total = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, total)] for v in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:components]
    return [i for i, _ in rows], deviation, centred @ u[:, order] / np.sqrt(e[order]), e[order] / e.sum()


def test_whitening_like_local_algebra(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 16)  # many blocks, the last of each partition not full
    rows = vectors()
    out = whitening.whitened(table(spark, rows)).orderBy("component", "vec_id", "deviation").collect()
    ids, deviation, white, explained = plain_whitening(rows, 64)
    assert len(out) == 32 * len(ids) and {r["n"] for r in out} == {len(ids)}
    for k in range(32):
        mine = sorted(((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"], r["whitened"]) for r in out if r["component"] == k + 1))
        true = sorted((-1 if i is None else i, d, float(w)) for i, d, w in zip(ids, deviation, white[:, k]))
        assert [m[:2] for m in mine] == [t[:2] for t in true]
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in true])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert {round(r["explained"], 12) for r in out} == {round(float(x), 12) for x in explained}
    assert 0 <= out[0]["identity_error"] < 1e-8


def test_whitening_of_flat_and_small_tables(spark):
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, [(1, None), (2, [])])).collect() == []
    flat = whitening.whitened(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert {(r["vec_id"], r["component"], r["deviation"], r["whitened"], r["identity_error"]) for r in flat} == {(i, k, 0, None, 0.0) for i in (1, 2) for k in (1, 2)}
    line = whitening.whitened(table(spark, [(i, [i / 2, 0.0, 1.0]) for i in range(5)])).orderBy("component", "vec_id").collect()
    assert [r["component"] for r in line] == [1] * 5 + [2] * 5 + [3] * 5
    assert np.allclose(np.abs([r["whitened"] for r in line[:5]]), np.abs(np.arange(5) - 2) / math.sqrt(2)) and line[0]["explained"] == 1.0
    assert all(r["whitened"] is None and r["explained"] == 0 for r in line[5:])
    large = whitening.whitened(table(spark, [(1, [-1e9]), (2, [1e9])])).collect()
    assert {r["deviation"] for r in large} == {None}  # (2 * x - S)^2 is beyond 2^63


def plain_links(rows, cosine=0.9):
    """n_links and component_id of every row by comparing all pairs."""
    clean = [v if v and all(c is not None and math.isfinite(c) for c in v) and any(v) else None for _, v in rows]
    unit = [None if v is None else np.array(v, "f4").astype("f8") / np.linalg.norm(np.array(v, "f4").astype("f8")) for v in clean]
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for i in range(n):
            for j in near[i]:
                root[i] = root[j] = min(root[i], root[j])
        if before == root:
            break
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [neighbours.BLOCK, 3])
@pytest.mark.parametrize("dims", [64, 3, 1])
def test_links_like_all_pairs(spark, dims, block):
    rows = vectors(dims, 60)
    if dims > 1:
        rows += [(700, [0.3] * (dims - 1)), (701, [0.6] * (dims - 1)), (702, [1e-30] * dims), (703, [2e-30] * dims)]
    out = neighbours.near_duplicates(table(spark, rows), block=block, per_cell=1).collect()
    assert sorted((tuple(r) for r in out), key=str) == plain_links(rows)


def test_links_of_large_groups_and_no_rows(spark):
    rnd = np.random.default_rng(4)
    centre = rnd.normal(size=64)
    rows = [(i, (centre + rnd.normal(size=64) * (0.1 if i % 3 else 0.45)).tolist()) for i in range(300)] + [(900, centre.tolist())] * 200
    out = sorted((tuple(r) for r in neighbours.near_duplicates(table(spark, rows), block=32).collect()), key=str)
    true = plain_links(rows)
    assert [(r[0], *r[2:]) for r in out] == [(r[0], *r[2:]) for r in true]
    assert all(a[1] <= b[1] for a, b in zip(out, true))  # no link that isn't there
    assert sum(r[1] for r in out) > 0.999 * sum(r[1] for r in true)
    assert neighbours.near_duplicates(table(spark, [])).collect() == []
    assert [tuple(r) for r in neighbours.near_duplicates(table(spark, [(5, None)])).collect()] == [(5, 0, 5, True)]


def test_recall_at_the_threshold(spark):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    w = rnd.normal(size=(1500, 64))
    w -= (w * x[:1500]).sum(axis=1)[:, None] * x[:1500]
    w /= np.linalg.norm(w, axis=1)[:, None]
    c = rnd.uniform(0.9, 0.92, 1500)[:, None]
    every = np.concatenate([x, c * x[:1500] + np.sqrt(1 - c * c) * w]).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<float>")
    found = neighbours.near_duplicates(df, per_cell=4).agg(F.sum("n_links")).first()[0]
    u = every.astype("f8") / np.linalg.norm(every.astype("f8"), axis=1)[:, None]
    true = int((u @ u.T >= 0.9).sum()) - len(u)
    assert 0.99 * true <= found <= true
