"""Plans whose cost must grow with the rows: what the driver collects, and what tasks send each other."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from merkato import session
from merkato.functions import ordering
from merkato.operators import blocks, density, kmeans, loading, star
from merkato.operators.cube import MonthCube
from merkato.sources import batches, dimensions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def folder(spark, tmp_path):
    def written(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    return written


@pytest.mark.parametrize("rows, merged", [(200_000, True), (1_000, False)])
def test_many_keys_in_a_small_file_are_not_broadcast(spark, folder, rows, merged):
    customer = folder(spark.range(rows).select(
        F.col("id").alias("CustomerSuggorateKey"), F.lit("F").alias("Gender"), F.lit(1).alias("LifeTimeValue"),
        F.lit("Gold").alias("LoyaltyStatus"), F.lit(True).alias("IsActive")), "customer")
    facts = spark.range(300_000).select((F.col("id") % 7).alias("DimCustomerKey"), F.col("id").alias("Revenue"))
    joined = star.join_customer(folder(facts, "facts"), customer)
    assert ("BroadcastHashJoin" in plan(joined)) != merged
    assert joined.count() == 300_000


def test_products_orphans_and_versions_with_many_keys_are_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    keys = folder(spark.range(50).select(F.col("id").alias("BrdgProductSpecialOfferKey"), F.lit("x").alias("ProductName")), "keys")
    facts = folder(spark.range(60).select(F.col("id").alias("BrdgProductSpecialOfferKey")), "facts")
    joined = star.join_products(facts, keys)
    assert "Broadcast" not in plan(joined) and joined.count() == 50
    assert star.orphans(facts, "BrdgProductSpecialOfferKey", keys, "BrdgProductSpecialOfferKey").first()[0] == 10
    at = "timestamp_ntz'{}-01-01 00:00:00'"
    dim = folder(spark.range(50).select(
        F.col("id").alias("nk"), (F.col("id") + 100).alias("sk"), F.expr(at.format(1990)).alias("ValidFrom"),
        F.expr(at.format(9999)).alias("ValidTo")), "dim")
    found = star.as_of_lookup(facts.withColumn("at", F.expr(at.format(2000))), dim, "BrdgProductSpecialOfferKey", "nk", "at", "sk")
    assert "BroadcastHashJoin" not in plan(found)
    assert found.where("sk = BrdgProductSpecialOfferKey + 100").count() == 50 and found.where("sk IS NULL").count() == 10


def test_keys_of_a_batch_are_merged(spark, folder, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    at = "timestamp_ntz'{}-01-01 00:00:00'"
    rows = spark.range(50).select("id", F.lit("a").alias("name"), F.expr(at.format(1990)).alias("effective"))
    first = folder(loading.scd2_merge(None, rows, ["id"], ["name"], "sk"), "first")
    changes = rows.where("id >= 25").select("id", F.lit("b").alias("name"), F.expr(at.format(2000)).alias("effective"))
    merged = loading.scd2_merge(first, changes, ["id"], ["name"], "sk")
    assert "BroadcastHashJoin [id" not in plan(merged)
    assert merged.count() == 75 and merged.where("IsActive AND name = 'b'").count() == 25
    fixed = loading.scd0_load(folder(rows.where("id < 40").withColumn("sk", F.col("id") + 1), "fixed"), rows, ["id"], "sk")
    assert "BroadcastHashJoin [id" not in plan(fixed) and fixed.agg(F.max("sk")).first()[0] == fixed.count() == 50
    joins = []
    monkeypatch.setattr(batches, "store", lambda df, label: joins.append(plan(df)) or session.store(df, label))
    monkeypatch.setattr(dimensions, "store", lambda df, label: joins.append(plan(df)) or session.store(df, label))
    stored = dimensions.VersionedDimension(spark, str(tmp_path / "stored"), spark.createDataFrame(
        [], "sk long, id long, name string, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean").schema, ["id"], "sk")
    stored.apply(1, rows)
    stored.apply(2, changes)
    assert joins and not [p for p in joins if "BroadcastHashJoin [id" in p]
    assert stored.rows().count() == 75


def test_group_starts_are_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    rows = folder(spark.range(300).select((F.col("id") % 40).alias("g"), F.col("id").alias("v")), "rows")
    numbered = ordering.number_within(rows, "g", ["v"], "n")
    assert "BroadcastHashJoin [g" not in plan(numbered)
    assert [tuple(r) for r in numbered.orderBy("n").limit(9).select("g", "v", "n").collect()] == [
        (0, 40 * i, i + 1) for i in range(8)] + [(1, 1, 9)]


def test_tasks_send_numbers_and_not_bitmaps(spark, folder):
    placed = folder(spark.range(0, 4000, 1, 8).select(
        F.lit(199801).alias("SaleMonth"), (F.col("id") % 5).cast("string").alias("market"), F.lit("ordercount").alias("kind"),
        (F.col("id") * 40 + 40).alias("number")), "placed")
    bitmaps = MonthCube._bitmaps(placed, ["SaleMonth", "market"])
    lines = plan(bitmaps).split("\n")
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert not any("bitmap_construct_agg" in line for line in lines[exchange:]), "\n".join(lines)
    assert bitmaps.select(F.sum(F.bitmap_count("bits"))).first()[0] == 4000
    assert bitmaps.count() == bitmaps.select("market", "bucket").distinct().count() == 25


def test_values_are_numbered_by_hashing_and_looked_up_by_one_key(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    rows = [("ordercount", i, None, 199800 + i % 3 + m, market) for i in range(30) for m in (1, 2) for market in ("a", None)]
    rows += [("uniquesubcategories", None, name, 199805, "b") for name in ("x", "", "30")]
    values = folder(spark.createDataFrame(rows, "kind string, id long, name string, SaleMonth int, market string"), "values")
    seen = MonthCube._first_seen(values)
    assert "SortAggregate" not in plan(seen)
    assert {(r.kind, r.id, r.name): r.first >> 32 for r in seen.collect()} == {
        **{("ordercount", i, None): 199801 + i % 3 for i in range(30)},
        **{("uniquesubcategories", None, name): 199805 for name in ("x", "", "30")}}
    numbers = folder(seen.select("kind", "id", "name", F.xxhash64("kind", "id", "name").alias("number")), "numbers")
    placed = MonthCube._placed(values, numbers, {"ordercount": "id", "uniquesubcategories": "name"})
    joins = [line for line in plan(placed).split("\n") if "Join" in line]
    assert len(joins) == 2 and all("SortMergeJoin [" in line and line.count(", ") == 2 for line in joins), joins
    assert placed.count() == len(rows) and placed.where("number <> xxhash64(kind, id, name)").count() == 0


def test_distances_by_products_equal_those_by_differences():
    rng = np.random.default_rng(7)
    points = rng.normal(size=(300, 16))
    points[200:250] = points[:50] + 1e-7  # nearly the same
    points[250:260] = points[:10]
    points[260:290] = points[:30] + np.eye(16)[0] * 0.75  # at the border, but for rounding
    for shift in (0.0, 1e6):
        a, b = points + shift, points[::-1] + shift
        wanted = np.array([np.einsum("ij,ij->i", b - row, b - row) for row in a])
        found = blocks.squared_distances(a, b, 0.75 ** 2)
        assert ((found <= 0.75 ** 2) == (wanted <= 0.75 ** 2)).all()
        assert (np.abs(found - wanted) <= 1e-9 * wanted).all()
    points[3, 2], points[5, 1], points[9, 0] = np.nan, np.inf, 1e200
    with np.errstate(all="ignore"):
        wanted = np.array([np.einsum("ij,ij->i", points - row, points - row) for row in points])
        found = blocks.squared_distances(points, points, 0.75 ** 2)
    assert np.allclose(found, wanted, rtol=1e-9, atol=0, equal_nan=True)


def test_pairs_of_blocks_leave_out_what_lies_within_one():
    def side(prefix, ids, values):
        return {f"{prefix}id": ids, f"{prefix}w": [1] * len(ids), f"{prefix}core": [True] * len(ids), f"{prefix}v": values}

    pair = pd.DataFrame([{"same": False, **side("l_", [1, 2], [0.0, 0.1]), **side("r_", [3, 4], [9.0, 0.2])}])
    edges = pd.concat(density._edges(0.5)([pair]))
    assert set(edges["src"]) | set(edges["dst"]) == {1, 2, 4} and len(edges) == 2
    apart = pd.DataFrame([{"same": False, **side("l_", [1, 2], [0.0, 0.1]), **side("r_", [3, 4], [9.0, 9.1])}])
    assert pd.concat(density._edges(0.5)([apart])).empty


@pytest.mark.parametrize("joined", [64, 0])
def test_bridge_rows_are_found_with_one_exchange_of_the_lines(spark, folder, monkeypatch, joined):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(loading, "VERSIONS_JOINED", joined)

    def versions(rows, natural, surrogate):
        made = spark.createDataFrame(rows, f"{natural} long, {surrogate} long, a int, b int")
        year = lambda c: F.concat(c.cast("string"), F.lit("-01-01")).cast("timestamp_ntz")
        return folder(made.select(natural, surrogate, year(F.col("a")).alias("ValidFrom"), year(F.col("b")).alias("ValidTo")), natural)

    products = versions([(1, 10, 1990, 1998), (1, 11, 1998, 9999), (2, 12, 1990, 9999), (3, 13, 1999, 9999)], "Product_ID", "ProductSuggorateKey")
    offers = versions([(0, 20, 1990, 9999), (5, 21, 1990, 9999)], "SpecialOffer_ID", "SpecialOfferSuggorateKey")
    bridge = folder(spark.createDataFrame([(100, 10, 20), (101, 11, 20), (102, 12, 21), (103, 12, 21)],
                                          "BrdgProductSpecialOfferKey long, ProductSuggorateKey long, SpecialOfferSuggorateKey long"), "bridge")
    wanted = {1: {100}, 2: {101}, 3: {102, 103}, 4: {None}, 5: {None}, 6: {None}, 7: {None}}
    lines = folder(spark.createDataFrame(
        [(1, 1, 0, 1995), (2, 1, 0, 1998), (3, 2, 5, 2000), (4, 3, 0, 1995), (5, 2, 0, 2000), (6, None, 0, 2000), (7, 1, None, 2000)],
        "detail_id long, product_id long, offer_id long, y int").withColumn(
        "order_date", F.concat(F.col("y").cast("string"), F.lit("-01-01")).cast("timestamp_ntz")), "lines")
    found = loading.lookup_bridge(lines, bridge, products, offers)
    got = {}
    for row in found.collect():
        got.setdefault(row.detail_id, set()).add(row.BrdgProductSpecialOfferKey)
    assert got == wanted and found.count() == 8


def test_blocks_of_vectors_hold_what_rows_held(monkeypatch):
    monkeypatch.setattr(kmeans, "ROWS", 3)
    rows = [{"at": [0, 4], "value": [1.5, -2.0]}, {"at": [], "value": []}, {"at": [2], "value": [7.0]}, {"at": [0], "value": [1.0]}]
    column = pa.array(rows, pa.struct([("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))]))
    made = list(kmeans._blocks([pa.RecordBatch.from_arrays([column], names=["v"])]))
    assert [b.column("rows")[0].as_py() for b in made] == [3, 1]
    assert max(b.column("width")[0].as_py() for b in made) == 5 and max(b.column("largest")[0].as_py() for b in made) == 7.0
    whole = kmeans.Vectors(column, 5)
    stored = list(kmeans._stored(made, 5))
    assert np.array_equal(np.concatenate([s.matrix(list(range(s.rows))) for s in stored]), whole.matrix([0, 1, 2, 3]))
    assert [s.digest(r, 1) for s in stored for r in range(s.rows)] == [whole.digest(r, 1) for r in range(4)]
    dense = pa.array([[1.0, 2.0], [3.0, 4.0]], pa.list_(pa.float64())).slice(1)
    (own,) = kmeans._stored(kmeans._blocks([pa.RecordBatch.from_arrays([dense], names=["v"])]), 2)
    assert own.dense.tolist() == [[3.0, 4.0]]


def _sparse_rows(rng, rows, width, entries):
    return [(np.sort(rng.choice(width, n, replace=False)).tolist(), rng.normal(size=n).tolist()) for n in entries[:rows]]


def test_blocks_of_vectors_stay_small_where_readers_hold_thousands():
    rng = np.random.default_rng(3)
    wide = _sparse_rows(rng, 3000, 200, [14 - i % 3 for i in range(3000)])
    sparse = pa.array([{"at": a, "value": v} for a, v in wide], pa.struct([("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))]))
    narrow = pa.array(rng.normal(size=(3000, 4)).tolist(), pa.list_(pa.float64()))
    for column, width in ((sparse, 200), (narrow, 4)):
        made = list(kmeans._blocks([pa.RecordBatch.from_arrays([column], names=["v"])]))
        taken = [sum(len(x or b"") for x in row) for b in made for row in zip(*(b.column(c).to_pylist() for c in ("value", "at", "sizes")))]
        assert max(taken) <= 2 * kmeans.BYTES and 4096 * max(taken) <= 32 << 20 and sum(sum(b.column("rows").to_pylist()) for b in made) == 3000
        # Cut and joined otherwise, as a reader does: the same vectors.
        again = pa.Table.from_batches(made).combine_chunks().to_batches()[0]
        whole, stored = kmeans.Vectors(column, width), list(kmeans._stored([again.slice(0, 7), again.slice(7)], width))
        assert max(s.rows for s in stored) <= kmeans.ROWS
        assert np.array_equal(np.concatenate([s.matrix(list(range(s.rows))) for s in stored]), whole.matrix(list(range(3000))))
        assert [d for s in stored for d in s.digests(5)] == whole.digests(5)


def test_distances_of_long_and_short_rows():
    rng = np.random.default_rng(4)
    rows = _sparse_rows(rng, 400, 900, [0 if i % 50 == 0 else 800 if i == 333 else 3 + i % 4 for i in range(400)])
    column = pa.array([{"at": a, "value": v} for a, v in rows], pa.struct([("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))]))
    starts = [rng.normal(size=(n, 900)) for n in (3, 1)]
    own = kmeans.Vectors(column, 900)
    dense = own.matrix(list(range(400)))
    expected = ((dense[:, None] - np.concatenate(starts)[None]) ** 2).sum(-1)
    assert own.distances(kmeans.Held(starts), 0, 400) == pytest.approx(expected, rel=1e-9)
    sums = [np.zeros((len(c), 900), np.int64) for c in starts]
    labels = [rng.integers(0, 3, 200), np.zeros(200, np.int64)]
    own.add(sums, labels, 100, 300, 1000.0)
    whole = np.rint(dense[100:300] * 1000)
    assert all(np.array_equal(total[k], whole[label == k].sum(axis=0)) for total, label in zip(sums, labels) for k in range(len(total)))


def test_starts_of_wide_vectors_run_in_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # Two positions are common, and each row has one of its own out of a million.
    rows = [([0, 1, 1000 * (i + 1)], [float(rng.normal() + 60 * (i % 3)), float(rng.normal()), 1.0]) for i in range(90)]
    df = spark.createDataFrame([(r,) for r in rows], "v struct<at:array<int>,value:array<double>>")
    vectors = df.mapInArrow(kmeans._blocks, kmeans._BLOCK)
    used, points = kmeans._reservoir(vectors, 90_001, 1, 20)
    assert points.shape == (20, len(used)) and len(used) == 22 and used.max() <= 90_000
    seen, real = [], kmeans._round
    monkeypatch.setattr(kmeans, "_round", lambda vectors, starts, largest: seen.append(len(starts)) or real(vectors, starts, largest))
    together = kmeans.fit(df, "v", 3, starts=3)
    assert max(seen) == 3
    seen.clear()
    monkeypatch.setattr(kmeans, "HELD", 1)
    apart = kmeans.fit(df, "v", 3, starts=3)
    assert max(seen) == 1 and together.centres.shape == (3, 90_001)
    assert (apart.centres == together.centres).all() and apart.sizes == together.sizes and apart.cost == together.cost
