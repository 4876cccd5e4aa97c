"""Checks on rows with defects."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from merkato.operators import quality, star

D = dt.datetime.fromisoformat
VERSION = "nk long, sk long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean"
END = "9999-12-31 23:59:59"


def history(spark, *rows):
    return spark.createDataFrame(
        [(nk, i, f and D(f), t and D(t), a) for i, (nk, f, t, a) in enumerate(rows)], VERSION)


def pairs(rows):
    count = 0
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[0] == b[0] and None not in (a[0], a[1], a[2], b[1], b[2]) and a[1] < b[2] and a[2] > b[1]:
                count += 1
    return count


def issues(df):
    return df.first()["issues"]


def test_version_defects(spark):
    dim = history(
        spark,
        (1, "2020-01-01", "2021-01-01", False), (1, "2021-01-01", END, True),  # touching
        (2, "2020-01-01", "2021-06-01", False), (2, "2021-01-01", END, True),  # overlapping
        (3, "2020-01-01", "2023-01-01", False), (3, "2021-01-01", "2024-01-01", False),
        (3, "2022-01-01", END, True),  # three ways
        (4, "2020-01-01", None, True), (4, "2020-06-01", END, True),  # unknown end, two active
        (5, "2020-01-01", "2030-01-01", True),  # active with an end
    )
    assert issues(quality.overlapping_pairs(dim, ["nk"])) == 4
    assert issues(quality.several_active(dim, ["nk"])) == 1
    assert issues(quality.wrong_open_end(dim)) == 1


@pytest.mark.parametrize("seed", range(3))
def test_overlap_count_equals_brute_force(spark, seed):
    """Includes instants, reversed intervals, copies, NULL bounds and one dominant key."""
    rng = random.Random(seed)
    base = dt.datetime(2020, 1, 1)

    def moment():
        return None if rng.random() < 0.05 else base + dt.timedelta(hours=rng.randrange(120))

    rows = [(1 if rng.random() < 0.5 else rng.choice([2, 3, None]), moment(), moment()) for _ in range(150)]
    rows += [(r[0], r[1], r[1]) for r in rows[:10]] + rows[:15]
    df = spark.createDataFrame([(k, i, f, t, True) for i, (k, f, t) in enumerate(rows)], VERSION)
    assert issues(quality.overlapping_pairs(df, ["nk"])) == pairs(rows)


def test_orphans_count_rows_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    assert star.orphans(child, "k", parent, "p").first()[0] == 4
    assert star.orphans(child.where("k = 1"), "k", parent, "p").first()[0] == 0


def test_time_dimension_defects(spark):
    time = spark.createDataFrame([(20200101,), (20200101,), (2020011,), (None,)], "DateKey long")
    assert quality.date_key_format(time).first()["issues"] == 1
    assert quality.duplicate_date_keys(time).first()["status"] == "ISSUE"
    cover = quality.date_coverage(time).first()
    assert (cover.first_date, cover.last_date, cover.dates) == (2020011, 20200101, 4)


def test_empty_tables_give_zero(spark):
    empty = spark.createDataFrame([], "IsActive boolean")
    assert [r.issues for r in quality.bridge_activity(empty).collect()] == [0, 0]
    assert issues(quality.overlapping_pairs(history(spark).limit(0), ["nk"])) == 0


def test_null_counts_and_domains(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, b string")
    assert {r.column_name: r.nulls for r in quality.null_counts(df, "t").collect()} == {"a": 1, "b": 2}
    customer = spark.createDataFrame([("Gold", 1), ("Tin", -1), (None, None)], "LoyaltyStatus string, LifeTimeValue long")
    offer = spark.createDataFrame([(0.5,), (1.5,), (-0.1,)], "DiscountPct double")
    assert [r.issues for r in quality.domain_checks(customer, offer).collect()] == [1, 1, 2]


def test_verdict(spark):
    ok = spark.createDataFrame([("a", 0, "OK"), ("b", 5, "INFO")], "check_name string, issues long, status string")
    assert quality.any_issue(ok).first()[0] is False
    assert quality.any_issue(ok.withColumn("status", F.lit("ISSUE"))).first()[0] is True
    assert quality.any_issue(ok.limit(0)).first()[0] is False


def test_compiled_rules_equal_the_single_checks(spark, small):
    from merkato.operators import report
    from merkato.plans.catalog.quality import FaultyWarehouse
    from merkato.sources.tpch import TpchWarehouse

    wh = FaultyWarehouse(TpchWarehouse.of(spark, small))
    single = [
        quality.fact_to_bridge(wh), quality.bridge_to_product(wh), quality.fact_to_dimensions(wh), quality.bridge_to_offer(wh),
        quality.active_checks(wh), quality.overlap_checks(wh), quality.open_end_checks(wh), quality.date_key_format(wh.table("DimTime")),
        quality.duplicate_date_keys(wh.table("DimTime")), quality.bridge_activity(wh.table("BridgeProductSpecialOffer")),
        quality.duplicate_surrogates(wh), quality.domain_checks(wh.table("DimCustomer"), wh.table("DimSpecialOffer"))]
    expected = sorted(tuple(r) for df in single for r in df.collect())
    found = sorted(tuple(r) for r in quality.full_report(wh).collect())
    assert found == expected and all(n > 0 for _, n, _ in found)
    with pytest.raises(ValueError):
        report.run_rules(wh, [report.Unique("wide", "DimTime", ["Day", "Month", "Year"])])


@pytest.mark.parametrize("seed", [1, 2])
def test_sketches_merge_within_their_error(spark, seed):
    rng = random.Random(seed)
    rows = [(i % 7, rng.gauss(0, 1) if i % 3 else 0.25, None if i % 5 else i) for i in range(30_000)]
    df = spark.createDataFrame(rows, "g int, x double, n long")
    merged = quality.merged_sketches(quality.quantile_sketches(df, ["x", "n"], ["g"]), ["x", "n"])
    for sketches in (merged, quality.quantile_sketches(df.repartition(5), ["x", "n"])):
        found = quality.sketched_quantiles(sketches, ["x", "n"], probabilities=(0.01, 0.25, 0.5, 0.9))
        assert {(r.column_name, r["values"]) for r in found.collect()} == {("x", 30_000), ("n", 6_000)}
        assert all(r.error <= quality.RANK_ERROR for r in quality.rank_errors(df, found).collect())
    empty = quality.quantile_sketches(df.limit(0), ["x"])
    assert [r.quantile for r in quality.sketched_quantiles(empty, ["x"]).collect()] == [None] * 3
