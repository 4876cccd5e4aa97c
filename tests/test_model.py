"""Clustering, embeddings and the segmentation run."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from merkato.operators import blocks, clustering, density, kmeans, summaries
from merkato.operators import features as feat
from merkato.plans.segmentation import Settings, run_segmentation
from merkato.session import new_path
from merkato.sources.tables import read_csv, read_csv_checked, scan, upsert_segments, write_csv
from merkato.sources.tpch import TpchWarehouse


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")


def reference_dbscan(points, eps, least):
    points = np.asarray(points, dtype=float)
    near = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= eps
    core, labels, k = near.sum(1) >= least, -np.ones(len(points), int), 0
    for i in range(len(points)):
        if core[i] and labels[i] < 0:
            stack, labels[i] = [i], k
            while stack:
                at = stack.pop()
                if core[at]:
                    for j in np.flatnonzero(near[at] & (labels < 0)):
                        labels[j] = k
                        stack.append(j)
            k += 1
    return labels.tolist()


def labels_of(df):
    return [r.cluster for r in df.orderBy("id").collect()]


def test_dbscan_line_border_and_duplicates(spark):
    line = [[0.0], [0.4], [0.8], [10.0], [20.0], [20.0], [20.0], [1.2]]
    assert labels_of(density.dbscan(frame(spark, line), "v", "id", 0.5, 2)) == reference_dbscan(line, 0.5, 2)
    # A border point between two clusters goes to the lower one.
    border = [[0.0], [0.1], [0.2], [0.3], [1.0], [1.7], [1.8], [1.9], [2.0]]
    found = labels_of(density.dbscan(frame(spark, border), "v", "id", 0.7, 4))
    assert found == reference_dbscan(border, 0.7, 4)


@pytest.mark.parametrize("rows", [7, 2048])
def test_dbscan_equals_brute_force(spark, monkeypatch, rows):
    """Small blocks force every cell to be split; a third of the points are copies."""
    monkeypatch.setattr(blocks.pack, "__defaults__", (rows,))
    rng = np.random.default_rng(4)
    points = rng.normal(size=(120, 3))
    points[80:] = points[0]
    for eps, least in ((0.6, 3), (0.9, 4)):
        assert labels_of(density.dbscan(frame(spark, points), "v", "id", eps, least)) == reference_dbscan(points, eps, least)


def reference_silhouette(points, labels):
    points, labels = np.asarray(points, dtype=float), np.asarray(labels)
    distance, scores = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)), []
    if len(set(labels)) < 2:
        return 0.0
    for i, label in enumerate(labels):
        own = labels == label
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = distance[i][own].sum() / (own.sum() - 1)
        b = min(distance[i][labels == other].mean() for other in set(labels) - {label})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


@pytest.mark.parametrize("labels", ["mixed", "one"])
def test_silhouette_equals_brute_force(spark, monkeypatch, labels):
    monkeypatch.setattr(blocks.pack, "__defaults__", (9,))
    rng = np.random.default_rng(5)
    points = rng.normal(size=(60, 2))
    points[40:] = points[3]
    tags = rng.integers(-1, 3, 60) if labels == "mixed" else np.zeros(60, int)
    tags[0] = 7 if labels == "mixed" else 0
    df = frame(spark, points).join(spark.createDataFrame([(i, int(t)) for i, t in enumerate(tags)], "id long, t int"), "id")
    assert clustering.silhouette(df, "v", "t", "id").first()[0] == pytest.approx(reference_silhouette(points, tags))


def test_kmeans_keeps_the_cheapest_start(spark):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(c, 0.2, size=(30, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = frame(spark, points)
    best = kmeans.fit(df, "v", 3, starts=4)
    labelled = clustering.kmeans_labels(df, "v", 3, starts=4).toPandas()
    assert sorted(labelled.cluster.unique()) == [0, 1, 2] and best.sizes == sorted(best.sizes, reverse=True)
    centres = np.stack(labelled.groupby("cluster")["v"].apply(lambda v: np.mean(np.stack(v), axis=0)))
    assert centres == pytest.approx(best.centres, abs=1e-9)
    distances = ((np.stack(labelled.v)[:, None] - centres[None]) ** 2).sum(-1)
    assert distances.argmin(1).tolist() == labelled.cluster.tolist()
    assert distances.min(1).sum() == pytest.approx(best.cost, rel=1e-8)
    more = kmeans.fit(df, "v", 11, starts=2)
    assert len(more.centres) == 11 and sum(more.sizes) == 90 and more.cost < best.cost
    with pytest.raises(ValueError):
        kmeans.fit(df, "v", 0)


def test_kmeans_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(12)
    points = rng.normal(size=(900, 3)) * [1e4, 1.0, 1e-3]
    points[600:] = points[0]  # a third are copies
    sparse = F.struct(F.array(F.lit(4), F.lit(0), F.lit(2)).alias("at"), F.col("v").alias("value"))
    base = frame(spark, points).withColumn("s", sparse)
    for column in ("v", "s"):
        models = [kmeans.fit(df, column, 4, starts=3) for df in (
            base.repartition(3), base.repartition(41, "id").sortWithinPartitions(F.desc("id")), base.coalesce(1).orderBy(F.rand(5)))]
        labels = [kmeans.assign(df, column, models[0]).select("id", "cluster") for df in (base.repartition(2), base.repartition(37))]
        assert all((m.centres == models[0].centres).all() and m.sizes == models[0].sizes and m.cost == models[0].cost for m in models)
        assert sorted(map(tuple, labels[0].collect())) == sorted(map(tuple, labels[1].collect()))
    nothing = kmeans.assign(base.withColumn("v", F.when(F.col("id") > 5, F.col("v"))), "v", kmeans.fit(base, "v", 2, starts=1))
    assert nothing.where("cluster IS NULL").count() == 6


def test_sparse_vectors_are_clustered_like_dense_ones(spark):
    rng = np.random.default_rng(13)
    points = rng.normal(size=(200, 5)) + rng.integers(0, 3, 200)[:, None] * 9
    points[rng.random(points.shape) < 0.3] = 0
    rows = [(i, p.tolist(), (np.flatnonzero(p).tolist(), p[p != 0].tolist())) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, v array<double>, s struct<at:array<int>,value:array<double>>")
    dense, sparse = kmeans.fit(df, "v", 3, starts=2), kmeans.fit(df, "s", 3, starts=2)
    assert sum(sparse.sizes) == 200
    for model, column in ((dense, "v"), (sparse, "s")):
        found = kmeans.assign(df, column, model).orderBy("id").toPandas()
        distances = ((points[:, None] - model.centres[None]) ** 2).sum(-1)
        assert distances.argmin(1).tolist() == found.cluster.tolist()


def test_wide_categories_stay_rows(spark):
    df = spark.createDataFrame([(i, f"v{i:04}", "ab"[i % 2], i % 3) for i in range(1500)] + [(1500, None, "a", 0)], "id long, c string, d string, cluster int")
    table = {(r.feature, r.category): (r.position, r.rows) for r in feat.category_table(df, ["c", "d"]).collect()}
    assert sorted(p for p, _ in table.values()) == list(range(1501)) and ("c", "__UNKNOWN__") not in table
    entries = {(r.id, r.feature): r.position for r in feat.one_hot_entries(df, ["id"], ["c", "d"]).collect()}
    assert entries[7, "c"] == table["c", "v0007"][0] and entries[7, "d"] == table["d", "b"][0] and (8, "d") not in entries and (1500, "c") not in entries
    with pytest.raises(ValueError):
        feat.one_hot_columns(df, ["c"])
    means = {(r.cluster, r.feature, r.category): r.mean for r in summaries.encoded_mean_rows(df, ["id"], ["c", "d"]).collect()}
    assert means[1, "d", "b"] == pytest.approx(250 / 500) and means[0, "c", "v0003"] == pytest.approx(1 / 501)
    assert means[2, "id", None] == pytest.approx(sum(i for i in range(1500) if i % 3 == 2) / 500)


def test_centres_come_back_in_units(spark):
    rng = np.random.default_rng(14)
    df = spark.createDataFrame([(float(rng.normal() + 40 * (i % 2)), "xyz"[i % 3], "same") for i in range(300)], "n double, c string, e string")
    found, centres, model = clustering.fitted_rows(df, ["n", "c", "e"], 3, starts=2)
    own = found.toPandas()
    for r in centres.collect():
        members = own[own.cluster == r.cluster]
        expected = members.n.mean() if r.feature == "n" else (members.c == r.category).mean()
        assert r.centre == pytest.approx(expected, abs=1e-6)
    assert {r.category for r in centres.collect() if r.feature == "c"} == {"y", "z"}


def test_projection_equals_singular_vectors(spark):
    points = np.random.default_rng(7).normal(size=(50, 4)) @ np.diag([3, 2, 1, 0.5])
    found = clustering.project(frame(spark, points), "v").orderBy("id").toPandas()
    centred = points - points.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(np.stack(found.pc)) == pytest.approx(np.abs(centred @ vt[:2].T))
    assert found.explained[0] == pytest.approx((s**2 / (s**2).sum())[:2])


def test_segmentation_run_is_stored_and_repeatable(spark, small):
    warehouse = TpchWarehouse.of(spark, small)
    target = new_path(spark, "segments")
    settings = Settings(clusters=3)
    result = run_segmentation(warehouse, settings, dt.date(2024, 5, 6), target)
    stored = scan(spark, target).toPandas()
    assert sorted(stored.MarketNameKey) == sorted(r.market for r in result.segments.collect())
    assert set(stored.SegmentID) == {0, 1, 2} and set(stored.ModelVersion) == {"lstm_hybrid_v2.0_20240506"}
    assert all(t.startswith("[") for t in stored.EmbeddingJSON)
    run_segmentation(warehouse, settings, dt.date(2024, 5, 7), target)
    again = scan(spark, target).toPandas()
    assert len(again) == len(stored) and set(again.ModelVersion) == {"lstm_hybrid_v2.0_20240507"}
    with pytest.raises(ValueError):
        run_segmentation(warehouse, Settings(sequence_length=99))


def test_segmentation_by_density(spark, small):
    settings = Settings(method="dbscan")
    found = run_segmentation(TpchWarehouse.of(spark, small), settings).segments
    assert found.count() > 0 and found.where("segment < -1").count() == 0


def test_row_segmentation(spark):
    df = spark.createDataFrame(
        [(float(i % 2) * 100 + i * 0.01, "a" if i % 2 else "b", 2020) for i in range(60)], "x double, c string, order_year int")
    found = clustering.segment_rows(df, k=2, starts=2)
    assert found.columns == ["x", "c", "order_year", "cluster"]
    assert found.groupBy("c").agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0


def test_upsert_rewrites_only_touched_days(spark):
    path = new_path(spark, "upsert")
    schema = "DateKey long, MarketNameKey string, SegmentID int, Revenue double, Quantity long, ProductRange string, " \
             "ModelVersion string, EmbeddingJSON string, ConfidenceScore double, n int"

    def rows(*items):
        return spark.createDataFrame(
            [(d, m, s, 1.0, 1, "Low", "v", "[]", 0.5, i) for i, (d, m, s) in enumerate(items)], schema)

    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    upsert_segments(spark, path, rows((20240101, "Côte d'Ivoire", 1), (20240102, "b", 1)), at, "n")
    later = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    upsert_segments(spark, path, rows((20240102, "b", 5), (20240102, "b", 4), (20240102, "c", 2)), later, "n")
    found = {(r.DateKey, r.MarketNameKey): (r.SegmentID, str(r.CreatedAt)[:7]) for r in scan(spark, path).collect()}
    assert found == {(20240101, "Côte d'Ivoire"): (1, "2024-01"), (20240102, "b"): (4, "2024-02"),
                     (20240102, "c"): (2, "2024-02")}


def test_csv_round_trip(spark):
    df = spark.createDataFrame([("a,b", 1.5), ("c", None)], "name string, value double")
    path = write_csv(df, new_path(spark, "csv"), "result", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("result_20240102_030405.csv")
    assert sorted(map(str, read_csv(spark, path).collect())) == sorted(map(str, df.collect()))


def test_broken_csv_records_come_back_with_their_reason(spark):
    from pyspark.sql import types as T

    path = new_path(spark, "broken-csv")
    text = ['id,name,amount', '1,"a ""b"", c",1.5', '2,b', '3,c,many', ',d,4', '5,,', '6,e,7,8', '7,"x']
    spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])
    good, rejects = read_csv_checked(spark, path, schema)
    assert sorted(map(tuple, good.collect())) == [(1, 'a "b", c', 1.5), (5, None, None)]
    reasons = {r.record: r.reason for r in rejects.collect()}
    assert reasons['2,b'] == reasons['6,e,7,8'] == "wrong number of values"
    assert reasons['3,c,many'] == "amount is not double: many" and reasons[',d,4'] == "id is empty"
    assert len(reasons) == 5


def test_a_csv_file_without_line_breaks_in_quotes_is_split(spark):
    path = write_csv(spark.range(60_000).select("id", F.repeat(F.lit("x"), 40).alias("t")).coalesce(1), new_path(spark, "split"), "big")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert read_csv(spark, path).rdd.getNumPartitions() > 3 and read_csv(spark, path).count() == 60_000
        assert read_csv(spark, path, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
