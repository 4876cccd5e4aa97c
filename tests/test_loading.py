"""Dimension loading, numbering and neighbours on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from merkato.functions import ordering
from merkato.operators import loading, star
from merkato.schemas import OPEN_END

D = dt.datetime.fromisoformat
SCHEMA = "id long, name string, effective timestamp_ntz"


def batch(spark, *rows):
    return spark.createDataFrame([(i, n, D(e)) for i, n, e in rows], SCHEMA)


def merge(current, incoming):
    return loading.scd2_merge(current, incoming, ["id"], ["name"], "sk")


def versions(df):
    return sorted((r.id, r.name, str(r.ValidFrom)[:10], str(r.ValidTo)[:10], r.IsActive) for r in df.collect())


FIRST = [(1, "a", "2020-01-01"), (2, "b", "2020-01-01"), (3, None, "2020-01-01")]
SECOND = [(1, "a", "2021-01-01"), (2, "B", "2021-01-01"), (3, "c", "2021-01-01"), (4, "d", "2021-01-01")]
AFTER = [
    (1, "a", "2020-01-01", "9999-12-31", True),
    (2, "B", "2021-01-01", "9999-12-31", True), (2, "b", "2020-01-01", "2021-01-01", False),
    (3, None, "2020-01-01", "2021-01-01", False), (3, "c", "2021-01-01", "9999-12-31", True),
    (4, "d", "2021-01-01", "9999-12-31", True),
]


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0], str(r[1]), r[2]))


def test_new_changed_and_unchanged_keys(spark):
    first = merge(None, batch(spark, *FIRST))
    second = merge(first, batch(spark, *SECOND))
    assert by_key([(r.id, r.name, str(r.ValidFrom)[:10], str(r.ValidTo)[:10], r.IsActive)
                   for r in second.collect()]) == by_key(AFTER)
    keys = {(r.id, r.name): r.sk for r in second.collect()}
    assert [keys[k] for k in ((1, "a"), (2, "b"), (3, None))] == [1, 2, 3]
    assert [keys[k] for k in ((2, "B"), (3, "c"), (4, "d"))] == [4, 5, 6]
    assert str(second.where("id = 1").first().ValidTo) == OPEN_END


def test_replay_changes_nothing(spark):
    second = merge(merge(None, batch(spark, *FIRST)), batch(spark, *SECOND))
    again = merge(second, batch(spark, *SECOND))
    assert sorted(map(str, again.collect())) == sorted(map(str, second.collect()))


def test_two_changes_of_one_key_in_a_batch(spark):
    first = merge(None, batch(spark, (1, "a", "2020-01-01")))
    found = versions(merge(first, batch(spark, (1, "c", "2022-01-01"), (1, "b", "2021-01-01"))))
    assert found == [
        (1, "a", "2020-01-01", "2021-01-01", False), (1, "b", "2021-01-01", "2022-01-01", False),
        (1, "c", "2022-01-01", "9999-12-31", True)]


def test_late_change_splits_history(spark):
    first = merge(None, batch(spark, (1, "a", "2020-01-01"), (1, "c", "2022-01-01")))
    found = versions(merge(first, batch(spark, (1, "b", "2021-01-01"))))
    assert [v[2:4] for v in found] == [
        ("2020-01-01", "2021-01-01"), ("2021-01-01", "2022-01-01"), ("2022-01-01", "9999-12-31")]


def test_absent_keys_stay_active(spark):
    first = merge(None, batch(spark, *FIRST))
    assert merge(first, batch(spark, (9, "z", "2021-01-01"))).where("IsActive").count() == 4


def test_fixed_dimension_never_changes(spark):
    first = loading.scd0_load(None, spark.createDataFrame([(7, "x"), (3, "y")], "id long, name string"), ["id"], "sk")
    more = spark.createDataFrame([(7, "changed"), (1, "z")], "id long, name string")
    found = {r.id: (r.sk, r.name) for r in loading.scd0_load(first, more, ["id"], "sk").collect()}
    assert found == {3: (1, "y"), 7: (2, "x"), 1: (3, "z")}


def test_numbers_are_dense_and_ordered(spark):
    values = [random.Random(1).randrange(10**6) for _ in range(5000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long").repartition(7)
    rows = ordering.number_rows(df, [F.col("v"), F.col("i")], "n", 5).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(5, 5005))
    assert [(r.v, r.i) for r in rows] == sorted((v, i) for i, v in enumerate(values))


def test_copies_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(ordering, "COPIES_PER_TASK", 7)
    values = [random.Random(5).randrange(40) for _ in range(300)] + [17] * 150
    df = spark.createDataFrame([(v, str(v)) for v in values], "v long, t string").repartition(5)
    rows = ordering.number_copies(df, ["v"], "n").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 451))
    assert [r.v for r in rows] == sorted(values)


@pytest.mark.parametrize("step", [-1, 1])
def test_sliced_neighbours_equal_the_plain_window(spark, step):
    rng = random.Random(2)
    rows = [(0 if rng.random() < 0.6 else rng.randrange(5), i, rng.choice([None, "x", "y"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, at long, v string")
    plain = ordering.neighbour(df, ["k"], ["at"], ["v", "at"], step, largest=1)
    sliced = ordering.neighbour(df, ["k"], ["at"], ["v", "at"], step, largest=ordering.ROWS_PER_TASK + 1)
    assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))


def test_exact_quantiles_interpolate(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=2000), np.full(1500, 0.25)])
    df = spark.createDataFrame([(float(v), 4.0) for v in values] + [(None, None)], "a double, b double")
    found = {(r.column_name, r.probability): r.quantile
             for r in ordering.exact_quantiles(df, ["a", "b"], [0.0, 0.25, 0.5, 0.8, 1.0]).collect()}
    for p in (0.0, 0.25, 0.5, 0.8, 1.0):
        assert found["a", p] == pytest.approx(np.quantile(values, p))
        assert found["b", p] == 4.0


def test_as_of_lookup_is_half_open(spark):
    dim = spark.createDataFrame(
        [(1, 10, D("2020-01-01"), D("2021-01-01")), (1, 11, D("2021-01-01"), D("9999-12-31"))],
        "nk long, sk long, ValidFrom timestamp_ntz, ValidTo timestamp_ntz")
    rows = spark.createDataFrame(
        [(1, D("2020-12-31")), (1, D("2021-01-01")), (1, D("2019-01-01")), (2, D("2021-01-01"))],
        "k long, at timestamp_ntz")
    found = {(r.k, str(r.at)[:10]): r.sk for r in star.as_of_lookup(rows, dim, "k", "nk", "at", "sk").collect()}
    assert found == {(1, "2020-12-31"): 10, (1, "2021-01-01"): 11, (1, "2019-01-01"): None, (2, "2021-01-01"): None}
