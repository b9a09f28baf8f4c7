from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from casefile.operators import cluster_scores as scores
from casefile.operators import clustering, embedding, pairs
from casefile.operators.features import build_matrix
from casefile.plans import run_quick_demo, run_unsupervised
from casefile.session import scratch_folder


def frame_of(spark, x, **more):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "vec": np.asarray(x, dtype=float).tolist(), **more}))


def brute_dbscan(x, eps, least):
    """Scan order as defined: clusters by smallest core point, borders to the first."""
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)) <= eps
    core = d.sum(axis=1) >= least
    label = np.full(len(x), -1)
    number = 0
    for start in range(len(x)):
        if not core[start] or label[start] >= 0:
            continue
        todo = [start]
        label[start] = number
        while todo:
            i = todo.pop()
            if not core[i]:
                continue
            for j in np.flatnonzero(d[i] & (label == -1)):
                label[j] = number
                todo.append(j)
        number += 1
    return label


def labels(df):
    return df.orderBy("id").toPandas()["cluster"].to_numpy()


def clumps(seed, dims, n=260):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-3, 3, (4, dims))
    x = centres[rng.integers(0, 4, n)] + rng.normal(0, 0.25, (n, dims))
    x[: n // 3] = x[0]  # a third of all points in one place
    x[-40:] = rng.uniform(-4, 4, (40, dims))
    return x


@pytest.mark.parametrize("dims, eps", [(1, 0.05), (2, 0.2), (2, 0.45), (3, 0.4), (8, 0.8)])
def test_dbscan_matches_brute_force(spark, dims, eps):
    x = clumps(dims, dims)
    got = labels(clustering.dbscan(frame_of(spark, x).repartition(3), "id", "vec", eps, 6))
    assert (got == brute_dbscan(x, eps, 6)).all()


def test_dbscan_by_ever_smaller_boxes(spark, monkeypatch):
    """Nothing is compared pair by pair until a pair of boxes is tiny, and full cells
    are spread over several tasks."""
    monkeypatch.setattr(clustering, "DIRECT_PAIRS", 2)
    monkeypatch.setattr(clustering, "SALT_ROWS", 5)
    rng = np.random.default_rng(5)
    # two dense bars whose gap is just above and just below eps
    bar = np.column_stack([rng.uniform(0, 0.3, 60), rng.uniform(0, 0.02, 60)])
    for gap, clusters in ((0.099, 1), (0.1001, 2)):
        left, right = bar + [0, 0], bar + [0, 0]
        right[:, 1] += gap + left[:, 1].max() - right[:, 1].min()
        x = np.vstack([left, right])
        got = labels(clustering.dbscan(frame_of(spark, x), "id", "vec", 0.1, 5))
        assert (got == brute_dbscan(x, 0.1, 5)).all()
    x = clumps(11, 6, 90)
    assert (labels(clustering.dbscan(frame_of(spark, x), "id", "vec", 0.7, 4)) == brute_dbscan(x, 0.7, 4)).all()


def test_dbscan_in_many_dimensions_lists_no_pairs(spark, monkeypatch):
    """Counts, links and borders come from blocks; no list of boxes or spots within reach is made."""

    def listed(*args):
        raise AssertionError("pairs were listed")

    monkeypatch.setattr(clustering, "_tree_pairs", listed)
    for block_rows, dims, eps in ((32, 16, 1.2), (65_536, 24, 1.6)):
        monkeypatch.setattr(pairs.block_pairs, "__defaults__", (block_rows,))
        x = clumps(dims, dims)
        x[200:210] = x[0] + 0.2 * np.arange(10)[:, None] / np.sqrt(dims)
        want = brute_dbscan(x, eps, 6)
        assert len(set(want)) > 2
        assert (labels(clustering.dbscan(frame_of(spark, x), "id", "vec", eps, 6)) == want).all()
    # distances of exactly eps count, as they do when measured one by one
    line = np.zeros((40, 16))
    line[:, 3] = 0.5 * np.arange(40)
    assert set(labels(clustering.dbscan(frame_of(spark, line), "id", "vec", 0.5, 3))) == {0}


def test_blocks_give_all_cores_work_and_move_few_copies(spark):
    """A row is copied to as many pairs of blocks as the cores need, not to one for every 2,048 points."""
    rows = spark.range(60_000).select("id", F.array(F.col("id").cast("double")).alias("x"))
    met = pairs.block_pairs(rows, "id").applyInPandas(lambda a, b: pd.DataFrame({"n": [len(a) + len(b)]}), "n long").toPandas()["n"]
    cores = spark.sparkContext.defaultParallelism
    assert len(met) >= 2 * cores and met.sum() <= 60_000 * 2 * np.ceil(np.sqrt(4 * cores))


def test_nearest_of_many_copies_are_those_with_the_smallest_ids(spark):
    x = np.vstack([np.zeros((60, 3)), np.ones((5, 3))])
    got = embedding.knn_graph(frame_of(spark, x), "id", k=4).toPandas().groupby("src")["dst"].apply(sorted)
    assert got[30] == [0, 1, 2, 3] and got[1] == [0, 2, 3, 4] and got[64] == [60, 61, 62, 63]


def test_dbscan_edges(spark):
    same = np.zeros((12, 2))
    assert set(labels(clustering.dbscan(frame_of(spark, same), "id", "vec", 0.1, 10))) == {0}
    far = np.arange(12)[:, None] * np.ones((1, 2))
    assert set(labels(clustering.dbscan(frame_of(spark, far), "id", "vec", 0.1, 2))) == {-1}


def test_components_of_a_long_chain(spark):
    nodes = spark.range(60).withColumnRenamed("id", "id")
    order = np.random.default_rng(0).permutation(50)
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(order, order[1:])], "a long, b long")
    got = clustering.connected_components(nodes, edges).toPandas().set_index("id")["label"]
    assert (got.loc[list(range(50))] == 0).all() and (got.loc[list(range(50, 60))] == list(range(50, 60))).all()


def test_kmeans_finds_blobs(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.1, (30, 2)) for c in (0, 5, 10)])
    got = labels(clustering.kmeans(frame_of(spark, x), "id", "vec", 3, starts=3))
    assert all(len(set(got[i : i + 30])) == 1 for i in (0, 30, 60)) and len(set(got)) == 3


def test_svd_of_wide_sparse_rows(spark):
    """Thousands of one-hot slots: leading values and projections as numpy has them."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(6)
    width = 1200
    weight = 1.0 / np.arange(1, 401)
    rows = []
    for _ in range(900):
        a, b = rng.choice(400, p=weight / weight.sum()), rng.integers(400, width)
        rows.append({0: float(rng.normal()) * 5 + 2} | {int(1 + a) % 400 or 1: 1.0} | {int(b): 1.0})
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        for j, v in r.items():
            x[i, j] = v
    df = spark.createDataFrame([(i, Vectors.sparse(width, r)) for i, r in enumerate(rows)], ["id", "features"]).repartition(5)
    basis = embedding.svd_basis(df, components=4)
    values, want = np.linalg.svd(x, full_matrices=False)[1:]
    assert np.allclose(basis.T @ basis, np.eye(4), atol=1e-9)
    assert np.allclose(np.linalg.norm(x @ basis, axis=0), values[:4], rtol=1e-5)
    assert np.abs(basis[:, 0] @ want[0]) > 1 - 1e-6
    got = np.stack(embedding.pca2(df, components=3).orderBy("id").toPandas()["vec"].to_numpy())
    centred = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[1]
    assert np.allclose(np.linalg.norm(got, axis=0), centred[:3], rtol=1e-5)


def test_svd_and_pca_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 6)) @ np.diag([5, 4, 3, 1, 0.5, 0.1]) + 2
    df = frame_of(spark, x).withColumn("features", array_to_vector("vec")).drop("vec")
    got = np.stack(embedding.truncated_svd(df, components=3).orderBy("id").toPandas()["vec"].to_numpy())
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :3] * s[:3]), atol=1e-6)
    got = np.stack(embedding.pca2(df).orderBy("id").toPandas()["vec"].to_numpy())
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :2] * s[:2]), atol=1e-6)


def test_neighbours_exact_and_along_curves(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)) * np.linspace(3, 0.2, 8)
    x[:100] = x[0]
    df = frame_of(spark, x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :5]
    exact = embedding.knn_graph(df, "id", k=5).toPandas().groupby("src")["dist"].apply(sorted)
    assert np.allclose(np.stack(exact.sort_index().to_numpy()), want)
    near = embedding.knn_graph(df, "id", k=5, method="curves").toPandas()
    assert (near.groupby("src").size() == 5).all() and (near["src"] != near["dst"]).all()
    found = np.stack(near.groupby("src")["dist"].apply(sorted).sort_index().to_numpy())
    assert np.isclose(found, want).mean() > 0.98


def test_graph_embedding_separates_blobs(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.5, (40, 5)) for c in (0, 2.5)])
    got = embedding.graph_embedding(frame_of(spark, x), "id", neighbours=8)
    y = np.stack(got.orderBy("id").toPandas()["vec"].to_numpy())
    assert y.shape == (80, 2) and np.isfinite(y).all()
    assert abs(y[:40, 0].mean() - y[40:, 0].mean()) > 2 * (y[:40, 0].std() + y[40:, 0].std()) / 2


def brute_scores(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    s = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        if not own.any():
            s.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, c == o].mean() for o in set(c) - {c[i]})
        s.append((b - a) / max(a, b))
    ks = sorted(set(c))
    m = np.stack([x[c == k].mean(axis=0) for k in ks])
    n = np.array([(c == k).sum() for k in ks])
    within = sum(((x[c == k] - m[i]) ** 2).sum() for i, k in enumerate(ks))
    between = (n[:, None] * (m - x.mean(axis=0)) ** 2).sum()
    spread = np.array([np.sqrt(((x[c == k] - m[i]) ** 2).sum(axis=1)).mean() for i, k in enumerate(ks)])
    gap = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    np.fill_diagonal(gap, np.inf)
    return np.mean(s), between / (len(ks) - 1) / (within / (len(x) - len(ks))), ((spread[:, None] + spread) / gap).max(axis=1).mean()


def test_scores_match_brute_force(spark):
    x = clumps(3, 4, 120)
    c = np.arange(120) % 4 - 1
    c[5] = 77  # a cluster of one
    got = scores.cluster_scores(frame_of(spark, x, cluster=c))
    assert (got["silhouette"], got["calinski_harabasz"], got["davies_bouldin"]) == pytest.approx(brute_scores(x, c), rel=1e-6)
    assert got["n_clusters"] == 4 and got["n_noise"] == int((c == -1).sum())
    kept = c != -1
    got = scores.cluster_scores(frame_of(spark, x, cluster=c), noise_as_cluster=False)
    assert got["calinski_harabasz"] == pytest.approx(brute_scores(x[kept], c[kept])[1], rel=1e-6)


def test_pairs_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs.block_pairs, "__defaults__", (32,))
    x = clumps(4, 3, 150)
    c = np.arange(150) % 50
    df = frame_of(spark, x, cluster=c)
    got = scores.cluster_scores(df)
    assert (got["silhouette"], got["davies_bouldin"]) == pytest.approx((brute_scores(x, c)[0], brute_scores(x, c)[2]), rel=1e-6)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    near = embedding.knn_graph(df, "id", k=5).toPandas()
    assert np.allclose(np.stack(near.groupby("src")["dist"].apply(sorted).sort_index().to_numpy()), np.sort(d, axis=1)[:, :5])
    assert not near.duplicated(["src", "dst"]).any()


def test_measures_are_chosen_by_name(spark):
    x, c = clumps(3, 2, 60), np.arange(60) % 3
    df = frame_of(spark, x, cluster=c)
    assert scores.cluster_scores(df, measure="squared")["silhouette"] == pytest.approx(scores.silhouette_squared(df))
    with pytest.raises(ValueError, match="no silhouette"):
        scores.cluster_scores(df, measure="guess")
    with pytest.raises(ValueError, match="no search"):
        embedding.knn_graph(df, "id", method="guess")


def test_scores_without_clusters(spark):
    x = np.zeros((10, 2))
    for value, noise in ((0, 0), (-1, 10)):
        got = scores.cluster_scores(frame_of(spark, x, cluster=np.full(10, value)))
        assert got == {"silhouette": None, "calinski_harabasz": None, "davies_bouldin": None, "n_clusters": 1, "n_noise": noise}


def test_matrix_leaves_out_key_constants_and_wide_text(spark):
    rows = [(i, float(i), 1, f"t{i}", "ab"[i % 2], i % 2 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, one int, wide string, kind string, flag boolean")
    width = build_matrix(df, key="id").first()["features"].size
    assert width == 2 + 2  # x and flag, and two kinds


def test_labels_of_combinations(spark):
    df = spark.createDataFrame([("SVD2", "DBSCAN", "eps=0.3_min=10"), ("PCA2", "KMeans", "k=4")], "e string, a string, c string")
    joined = df.select(scores.combination_label(F.col("e"), F.col("a"), F.col("c")).alias("t"))
    parts = scores.parse_combination(F.col("t"))
    got = joined.select(*[v.alias(k) for k, v in parts.items()]).collect()
    assert tuple(got[0]) == ("SVD2", "DBSCAN", "eps=0.3_min=10", None, 0.3, 10)
    assert (got[1]["k"], got[1]["eps"]) == (4, None)


FAST = {"kmeans_sizes": (2, 4), "kmeans_starts": 1, "dbscan_radii": (0.5,), "embeddings": ("SVD50", "SVD2")}


def test_full_analysis_on_the_demo_table(spark):
    out = scratch_folder(spark)
    found = run_quick_demo(spark, out, 200, **FAST)
    results = found["results"].toPandas()
    assert len(results) == 6 and set(results["embedding_dim"]) == {2, 17}
    assert found["labels"].count() == 200
    assert found["best"].first()["embedding_dim"] == 2
    back = spark.read.option("header", True).csv(f"{out}/all_combinations_results")
    assert back.count() == 6
    assert found["high"].filter("silhouette < 0.6").count() == 0


def test_interpretation_index(spark):
    df = spark.range(120).select("id", F.expr("id % 3").cast("string").alias("kind"), (F.col("id") % 10).cast("double").alias("x"))
    out = scratch_folder(spark)
    found = run_unsupervised(spark, df, "id", out, max_samples=100, interpret=True, top_n=2, **{**FAST, "embeddings": ("SVD2",)})
    assert found["index"].count() == 2
    assert set(spark.read.json(f"{out}/cluster_interpretations_index").columns) == {"combo", "silhouette"}


def test_a_curve_in_stretches_finds_what_the_whole_curve_finds(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(size=(290, 5)), np.zeros((10, 5))])
    points = spark.createDataFrame(pd.DataFrame({"id": np.arange(300), "x": x.tolist()}))
    basis = np.linalg.qr(rng.normal(size=(5, 5)))[0][:, :3]
    found = []
    for rows in (1, 4096):
        monkeypatch.setattr(embedding, "STRETCH_ROWS", rows)
        found.append(embedding._curve_neighbours(points, basis, 4, 1).orderBy("src", "dst").toPandas())
    assert found[0].equals(found[1]) and len(found[0]) == 300 * 4


def test_curves_find_the_neighbours_of_clumps(spark):
    x = clumps(12, 6, 400)[140:]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    near = embedding.knn_graph(frame_of(spark, x), "id", k=5, method="curves").toPandas()
    got = np.stack(near.groupby("src")["dist"].apply(sorted).sort_index().to_numpy())
    assert (np.abs(got - np.sort(d, axis=1)[:, :5]) < 1e-9).mean() > 0.99


def test_batches_of_vectors_are_multiplied_in_strips():
    """No strip has more entries times columns than a task should hold at once."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    dense, sparse = rng.normal(size=(3000, 64)), [([5, 900], [1.0, 2.0])] * 1000
    rows = [{"type": 1, "size": None, "indices": None, "values": v} for v in dense.tolist()]
    rows += [{"type": 0, "size": 1000, "indices": i, "values": v} for i, v in sparse]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    some = list(embedding._strips(pa.array(rows, kind), 64))
    entries = [embedding._entries(s) for s in some]
    assert len(some) > 1 and sum(len(s) for s in some) == 4000
    assert max(len(x) * 64 for _, _, x in entries) <= 2 * pairs.STRIP_NUMBERS
    assert np.array_equal(np.concatenate([x for _, _, x in entries]), np.concatenate([dense.ravel(), [1.0, 2.0] * 1000]))


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_silhouette_in_few_dimensions_adds_distances_up_by_boxes(spark, monkeypatch, dims):
    rng = np.random.default_rng(dims)
    # flat, in a far smaller clump, repeated, and far out; a cluster of one point and one of noise
    x = np.vstack([rng.uniform(size=(1500, dims)), 3 + 1e-7 * rng.normal(size=(1500, dims)), np.ones((300, dims)), 90 * rng.normal(size=(5, dims))])
    c = np.floor(x[:, 0] * 7).astype(int) % 4 - 1
    c[7] = 77
    monkeypatch.setattr(scores, "block_pairs", lambda *_: pytest.fail("all pairs were compared"))
    df = spark.createDataFrame([(p.tolist(), int(k)) for p, k in zip(x, c)], "vec array<double>, cluster int")
    d = np.sqrt(np.square(x[:, None] - x[None]).sum(axis=-1))
    names, sizes = np.unique(c, return_counts=True)
    sums = np.stack([d[:, c == k].sum(axis=1) for k in names], axis=1)
    at, row = np.searchsorted(names, c), np.arange(len(x))
    a, others = sums[row, at] / np.maximum(sizes[at] - 1, 1), sums / sizes
    others[row, at] = np.inf
    b = others.min(axis=1)
    wanted = np.where(sizes[at] > 1, (b - a) / np.maximum(a, b), 0.0).mean()
    assert scores.silhouette(df) == pytest.approx(wanted, rel=1e-9)


def test_circles_of_many_homes_meet_like_those_of_one(spark, monkeypatch):
    """Vectors travel narrow, once for each home; shuffle files are dropped round by round, and the setting is put back."""
    from casefile import session

    x = clumps(12, 6, 400)[140:].astype(np.float32).astype(float)
    used, met = [], embedding._refined

    def seen(points, homes, graph, k):
        used.append((homes.select("_home").distinct().count(), points.schema["x"].dataType.elementType.typeName(), spark.conf.get(session.DROP_SHUFFLES)))
        return met(points, homes, graph, k)

    monkeypatch.setattr(embedding, "_refined", seen)
    before, found = spark.conf.get(session.DROP_SHUFFLES, None), []
    for numbers in (1, 64 << 20):
        monkeypatch.setattr(embedding, "MEMBER_NUMBERS", numbers * 6 * 21 * 20)
        found.append(embedding.knn_graph(frame_of(spark, x), "id", k=5, method="curves").orderBy("src", "dst").toPandas())
    assert found[0].equals(found[1]) and used[0][0] > used[1][0] and {u[1:] for u in used} == {("float", "true")}
    assert spark.conf.get(session.DROP_SHUFFLES, None) == before


def test_vectors_are_narrowed_only_without_loss(spark):
    for value, kind in ((0.5, "float"), (0.1, "double")):
        df = spark.createDataFrame([(1, [value, -0.0]), (2, None)], "id long, x array<double>")
        got = embedding._narrow(df)
        assert got.schema["x"].dataType.elementType.typeName() == kind
        assert got.orderBy("id").first()["x"] == [value, 0.0]


def test_met_pairs_are_the_nearest_of_each_member():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x, ids = rng.normal(size=(12, 3)), np.arange(12).repeat(1)
    ids[11] = 10  # one id with two vectors
    links = pa.table({"host": [0] * 6 + [1] * 6, "guest": [0, 1, 2, 3, 4, 5, 1, 0, 6, 8, 9, 10], "fresh": [True] * 11 + [False]})
    members = pa.table({"id": ids, "edge": np.full(12, 2.0), "x": pa.array(x.tolist(), pa.list_(pa.float64()))})
    want = {}
    for circle in ((0, 1, 2, 3, 4, 5), (1, 0, 6, 8, 9, 10, 11)):
        for a, b in ((a, b) for a in circle for b in circle if ids[a] != ids[b]):
            dist = np.sqrt(((x[a] - x[b]) ** 2).sum())
            if dist <= 2.0:
                key = (int(ids[a]), int(ids[b]))
                want[key] = min(dist, want.get(key, np.inf))
    for k in (2, 20):
        got = embedding._met(links, members, k).to_pandas()
        nearest = {a: sorted((d, b) for (s, b), d in want.items() if s == a)[:k] for a, _ in want}
        assert {a: list(zip(g["dist"], g["dst"])) for a, g in got.groupby("src")} == nearest
