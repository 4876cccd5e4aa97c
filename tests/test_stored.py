"""Stored dimensions, as-of lookups over overlapping versions, and the month cube."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from merkato.functions import ordering
from merkato.operators import loading, series, star
from merkato.operators.cube import MonthCube
from merkato.session import new_path
from merkato.plans.refresh import StoredWarehouse
from merkato.sources.batches import StagedTable
from merkato.sources.dimensions import VersionedDimension
from merkato.sources.tables import Warehouse
from merkato.sources.tpch import TpchWarehouse

D = dt.datetime.fromisoformat
INCOMING = "id long, name string, effective timestamp_ntz"
STORED = "sk long, id long, name string, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean"


def batch(spark, *rows):
    return spark.createDataFrame([(i, n, e and D(e)) for i, n, e in rows], INCOMING)


def dimension(spark, path=None):
    return VersionedDimension(spark, path or new_path(spark, "versions"), spark.createDataFrame([], STORED).schema, ["id"], "sk")


def rows(stored):
    return sorted(map(str, stored.rows().collect()))


FIRST = [(k, "a", "2020-01-01") for k in range(1, 9)]
SECOND = [(1, "b", "2021-03-01"), (2, "b", "2021-03-15"), (3, "a", "2021-03-15"), (9, "x", "2021-04-01"), (9, "y", "2021-05-01")]
LATE = [(1, "c", "2020-06-01"), (4, "c", "2022-01-01")]


def test_stored_batches_equal_merges_in_memory(spark):
    stored, merged = dimension(spark), None
    for number, changes in enumerate((FIRST, SECOND, LATE, []), start=1):
        assert stored.apply(number, batch(spark, *changes))
        merged = loading.scd2_merge(merged, batch(spark, *changes), ["id"], ["name"], "sk")
        columns = merged.columns
        assert sorted(map(str, stored.rows().select(*columns).collect())) == sorted(map(str, merged.collect()))
    assert all((r.ClosedMonth == 0) == r.IsActive for r in stored.rows().collect())
    assert stored.current().count() == 9


def files(stored):
    return {f.split("/")[-2]: f for f in sorted(stored.rows().inputFiles())}


def test_only_changed_months_are_replaced(spark):
    stored = dimension(spark)
    for number, changes in enumerate((FIRST, SECOND), start=1):
        stored.apply(number, batch(spark, *changes))
    before = files(stored)
    assert set(before) == {"ClosedMonth=0", "ClosedMonth=202103", "ClosedMonth=202105"}
    stored.apply(3, batch(spark, (1, "c", "2022-01-01")))
    after = files(stored)
    assert {k for k in before if before[k] == after[k]} == {"ClosedMonth=202103", "ClosedMonth=202105"}
    stored.apply(4, batch(spark, (1, "c", "2022-01-01"), (5, "a", "2023-01-01")))  # nothing new
    assert files(stored) == after
    assert [r.parts for r in stored.log().where("batch = 4").collect()] == [[], []]


@pytest.mark.parametrize("at", ["copy", "note", "half", "applied"])
def test_a_failed_batch_is_repeated_with_the_same_rows(spark, monkeypatch, at):
    whole, broken = dimension(spark), dimension(spark)
    for stored in (whole, broken):
        stored.apply(1, batch(spark, *FIRST))
    whole.apply(2, batch(spark, *SECOND))
    overwrite, note = VersionedDimension._overwrite, VersionedDimension._note

    def fail_overwrite(self, found):
        if at == "half":  # the active versions are replaced, the closed months are not there yet
            overwrite(self, found.where("ClosedMonth = 0"))
        if at in ("half", "copy"):
            raise OSError("lost")
        overwrite(self, found)

    def fail_note(self, number, state, *rest):
        if (at, state) in (("note", "prepared"), ("applied", "applied")):
            raise OSError("lost")
        note(self, number, state, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(VersionedDimension, "_overwrite", fail_overwrite)
        patch.setattr(VersionedDimension, "_note", fail_note)
        with pytest.raises(OSError):
            broken.apply(2, batch(spark, *SECOND))
    again = dimension(spark, broken.path)  # a later session
    if at == "half":  # the next batch finishes the one before it
        again.apply(3, batch(spark, *LATE))
        whole.apply(3, batch(spark, *LATE))
        assert not again.apply(2, batch(spark, *SECOND))
    else:
        assert again.apply(2, batch(spark, *SECOND))
        assert not again.apply(2, batch(spark, (1, "ignored", "2024-01-01")))
    assert rows(again) == rows(whole)
    assert again.apply(7, batch(spark)) and rows(again) == rows(whole)
    with pytest.raises(ValueError):
        again.apply(5, batch(spark, *FIRST))


def test_rows_without_key_or_instant_are_left_out(spark):
    stored = dimension(spark)
    stored.apply(1, batch(spark, (None, "a", "2020-01-01"), (1, "a", None), (2, None, "2020-01-01"), (2, None, "2020-01-01")))
    assert [(r.id, r.name, r.sk) for r in stored.rows().collect()] == [(2, None, 1)]


# As-of lookups


def planted(seed, keys=6, versions=200, events=600):
    rng = random.Random(seed)
    day = lambda: D("2020-01-01") + dt.timedelta(days=rng.randrange(900))
    key = lambda: 0 if rng.random() < 0.5 else rng.randrange(keys)
    dim = [(key(), n, start := day(), start + dt.timedelta(days=rng.choice([-3, 0, 5, 60, 900]))) for n in range(versions)]
    dim += [(1, 9001, None, D("2021-01-01")), (None, 9002, D("2020-01-01"), D("2030-01-01")), (1, 9003, D("2020-01-01"), None)]
    rows = [(n, key() if n % 50 else None, day() if n % 70 else None) for n in range(events)]
    return dim, rows


def looked_up(dim, rows):
    out = Counter()
    for n, key, at in rows:
        started = [(start, sk, end) for k, sk, start, end in dim if None not in (k, start, end, at, key) and k == key and start <= at]
        last = max(started, default=None)
        out[n, last[1] if last and at < last[2] else None] += 1
    return out


@pytest.mark.parametrize("way", ["join", "merge", "slices"])
def test_overlapping_versions_never_multiply_rows(spark, monkeypatch, way):
    dim, events = planted(way)
    # A version that ends before it starts hides earlier ones as long as it is the last one started: it is simply over.
    versions = spark.createDataFrame(dim, "nk long, sk long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz")
    facts = spark.createDataFrame(events, "n long, k long, at timestamp_ntz").repartition(5)
    if way == "slices":
        monkeypatch.setattr(ordering, "ROWS_PER_TASK", 20)
    found = star.as_of_lookup(facts, versions, "k", "nk", "at", "sk", joined=0 if way != "join" else 10_000)
    assert found.columns == ["n", "k", "at", "sk"]
    assert Counter((r.n, r.sk) for r in found.collect()) == looked_up(dim, events)


def test_as_of_merge_of_a_key_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 1)
    versions = spark.createDataFrame([(5, 77, D("2020-01-01"), D("2030-01-01")), (6, 78, D("2020-01-01"), D("2021-01-01"))],
                                     "nk long, sk long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz")
    facts = spark.range(4000).select("id", (F.lit(5) + (F.col("id") % 4 == 0).cast("long")).alias("k"), F.expr(
        "timestamp_ntz'2020-01-02 00:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("at"))
    found = star.as_of_lookup(facts, versions, "k", "nk", "at", "sk", joined=0)
    valid = F.when(F.col("k") == 5, F.when(F.col("at") < "2030-01-01", 77)).when(F.col("at") < "2021-01-01", 78)
    assert found.count() == 4000 and found.where(~F.col("sk").eqNullSafe(valid)).count() == 0


# The month cube


def test_cube_equals_direct_counts(spark, small):
    wh = TpchWarehouse.of(spark, small)
    cube = MonthCube.of(wh)
    text = lambda df: sorted(map(str, df.select(*[F.col(c).cast("string") for c in direct.columns]).collect()))
    direct = series.period_metrics(series.market_rows(wh))
    assert text(cube.metrics()) == text(direct)
    months = cube.months()
    assert text(cube.metrics(months[3:5])) == text(direct.where((F.col("year") * 100 + F.col("month")).isin(months[3:5])))
    rows = series.market_rows(wh)
    expected = {r.market: (r.o, r.c) for r in rows.where((F.col("year") * 100 + F.col("month")).isin(months[-5:])).groupBy("market").agg(
        F.count_distinct("SalesOrderID").alias("o"), F.count_distinct("DimCustomerKey").alias("c")).collect()}
    assert {r.market: (r.ordercount, r.customercount) for r in cube.distinct_counts(["market"], months[-5:]).collect()} == expected
    whole = cube.distinct_counts([]).first()
    assert whole.ordercount == rows.select("SalesOrderID").distinct().count()


def test_cube_computes_new_months_only(spark, small):
    source = TpchWarehouse.of(spark, small)
    wh = Warehouse(spark, new_path(spark, "grown"))
    for name in ("BridgeProductSpecialOffer", "DimProduct", "DimTerritory", "DimTime"):
        wh.save(name, source.table(name))
    facts = source.table("FactSale").drop("SaleMonth")
    months = sorted(r.m for r in facts.select((F.col("DimTimeKey") / 100).cast("int").alias("m")).distinct().collect())
    month = (F.col("DimTimeKey") / 100).cast("int")
    wh.save("FactSale", facts.where(month.isin(months[:14])))
    cube = MonthCube(wh)
    assert cube.refresh() == months[:14] and cube.refresh() == []
    before = {f for f in cube.sets().inputFiles() if f"SaleYear={months[0] // 100}" in f}
    assert before and months[13] // 100 > months[0] // 100
    numbers = {(r.kind, r.id, r.name): r.number for r in cube.numbers().collect()}
    facts.where(month.isin(months[14:16])).withColumn("SaleMonth", month).write.mode("append").partitionBy("SaleMonth").parquet(wh.path("FactSale"))
    assert cube.refresh() == months[14:16]
    assert before <= set(cube.sets().inputFiles())
    after = {(r.kind, r.id, r.name): r.number for r in cube.numbers().collect()}
    assert all(after[k] == n for k, n in numbers.items()) and len(set(after.values())) == len(after) == max(after.values())
    direct = series.period_metrics(series.market_rows(wh))
    key = lambda df: sorted(map(str, df.select("market", "year", "month", "ordercount", "customercount", "uniquesubcategories").collect()))
    assert key(cube.metrics()) == key(direct)
    cube.refresh(months[2:3])  # again: the same months, the same rows
    assert key(cube.metrics()) == key(direct)


def test_derived_tables_follow_the_files(spark, small):
    source = TpchWarehouse.of(spark, small)
    first, other = (Warehouse(spark, new_path(spark, "shared")) for _ in range(2))
    other.root = first.root
    for name in ("BridgeProductSpecialOffer", "DimProduct"):
        first.save(name, source.table(name))
    every = star.offered_products(first).count()
    assert every > 0
    product = source.table("DimProduct").limit(1)
    product.write.mode("overwrite").parquet(other.path("DimProduct"))  # by someone else
    assert star.offered_products(first).count() < every


def sales_inputs(spark):
    at = dt.datetime(1990, 1, 1)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    dated = "effective timestamp_ntz"
    return dict(
        products=frame([(p, f"p{p}", "s", "m", "l", "c", "t", at) for p in (1, 2)], "Product_ID long, ProductName string, "
                       f"Subcategory string, Model string, ProductLine string, Class string, Style string, {dated}"),
        offers=frame([(0, None, "none", "x", at)], f"SpecialOffer_ID long, DiscountPct decimal(5,2), Type string, Category string, {dated}"),
        customers=frame([(7, "F", None, "Low", "Gold", at)], "Customer_ID long, Gender string, LifeTimeValue decimal(18,2), "
                        f"LtvTier string, LoyaltyStatus string, {dated}"),
        territories=frame([(3, "PERU")], "Territory_ID long, CountryRegion string"),
        lines=frame([(o, o, dt.datetime(1995, 1, 1 + o), c, 3, p, 0, None, 5) for o, c, p in
                     ((1, 7, 1), (2, 7, 2), (3, 8, 1), (4, 7, 9), (5, None, None))],
                    "order_id long, detail_id long, order_date timestamp_ntz, customer_id long, territory_id long, product_id long, "
                    "offer_id long, line_total decimal(18,2), order_qty long"))


def test_lines_of_a_batch_are_looked_up_once(spark, monkeypatch):
    stored, inputs, joins, looked = StoredWarehouse(spark, new_path(spark, "grown")), sales_inputs(spark), [], []
    upsert, lookup = StagedTable.upsert, loading.lookup_product_offer

    def seen(table, number, found, keys):
        joins.append(found._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return upsert(table, number, found, keys)

    monkeypatch.setattr(StagedTable, "upsert", seen)
    monkeypatch.setattr(loading, "lookup_product_offer", lambda *found: looked.append(1) or lookup(*found))
    stored.apply(1, **inputs)
    kept = [sorted(map(str, stored.table("FactSale").collect())), sorted(map(str, stored.rejects.rows().collect()))]
    assert sorted(r.SalesOrderID for r in stored.table("FactSale").collect()) == [1, 2]
    assert {r.order_id: (r.no_bridge, r.no_territory, r.no_day, r.no_customer) for r in stored.rejects.rows().collect()} == {
        3: (False, False, False, True), 4: (True, False, False, False), 5: (True, False, False, True)}
    assert joins == [0, 0]  # facts and rejects are both read from the lines with their keys
    stored.apply(1, **inputs)
    assert len(looked) == 1 and len(joins) == 2
    assert kept == [sorted(map(str, stored.table("FactSale").collect())), sorted(map(str, stored.rejects.rows().collect()))]
