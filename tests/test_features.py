"""Series, features, summaries and decisions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import clustering, decisions, series, summaries
from merkato.operators import features as feat

METRIC = "market string, year int, month int, datekey long, revenue double, quantity long"


def metrics(spark, *rows):
    return spark.createDataFrame([(m, y, n, y and y * 10000 + n * 100 + 1, r, 1) for m, y, n, r in rows], METRIC)


def test_growth_uses_the_previous_available_period(spark):
    df = metrics(spark, ("a", 2020, 1, 10.0), ("a", 2020, 3, 15.0), ("a", 2020, 4, 0.0), ("a", 2020, 5, 2.0))
    rows = series.with_growth(series.with_previous(df)).orderBy("month").collect()
    assert [r.prevrevenue for r in rows] == [None, 10.0, 15.0, 0.0]
    assert rows[0].revenuegrowth == 0.0
    assert rows[1].revenuegrowth == pytest.approx(5 / (10 + 1e-6))
    assert rows[3].revenuegrowth == pytest.approx(2 / 1e-6)


def test_unknown_periods_take_no_slot(spark):
    df = metrics(spark, ("a", None, None, 1.0), ("a", 2020, 1, 1.0), ("b", 2019, 12, 1.0), ("b", 2019, 11, 1.0))
    found = {(r.year, r.month) for r in series.recent_periods(df, 2).collect()}
    assert found == {(2020, 1), (2019, 12)}


def test_short_markets_are_skipped_and_steps_are_ordered(spark):
    df = metrics(spark, *[("a", 2020, m, float(m)) for m in range(1, 9)], ("b", 2020, 1, 1.0))
    steps = series.last_steps(df, 3)
    assert [(r.month, r.step) for r in steps.orderBy("step").collect()] == [(6, 1), (7, 2), (8, 3)]
    assert [r.market for r in series.short_markets(df, 3).collect()] == ["b"]
    sequence = series.assemble_sequences(steps, ["revenue", "quantity"]).first().sequence
    assert sequence == [[6.0, 1.0], [7.0, 1.0], [8.0, 1.0]]


def test_product_range_treats_missing_as_high(spark):
    df = spark.createDataFrame([(9999.0,), (10000.0,), (50000.0,), (None,), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(X.product_range(F.col("v"))).collect()] == ["Low", "Medium", "High", "High", "High"]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double")
    assert [r[0] for r in df.select(X.half_even(F.col("v"), 0)).collect()] == [0.0, 2.0, 2.0, 0.0]


FRAME = [(1, None, 2020, "x", 5), (1, None, 2021, "y", None), (1, None, 2020, None, 7)]
FRAME_SCHEMA = "same long, nothing string, order_year int, text string, number long"


def test_feature_selection(spark):
    df = spark.createDataFrame(FRAME, FRAME_SCHEMA)
    assert feat.constant_columns(df) == ["same", "nothing"]
    assert feat.narrow_time_columns(df) == ["order_year"]
    assert feat.select_features(df) == ["text", "number"]
    with pytest.raises(ValueError):
        feat.select_features(df, ["same", "number"])
    constant_and_null = spark.createDataFrame([(1,), (None,)], "v long")
    assert feat.constant_columns(constant_and_null) == []


def test_fill_and_types(spark):
    df = spark.createDataFrame(FRAME, FRAME_SCHEMA)
    row = feat.fill_unknown(df).collect()
    assert [r.text for r in row] == ["x", "y", "__UNKNOWN__"] and [r.number for r in row] == [5, 0, 7]
    assert feat.split_types(df) == (["same", "order_year", "number"], ["nothing", "text"])
    assert feat.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a__dup1", "a__dup2"]


def test_rare_categories_and_null_become_other(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbc"] + [(None,)], "v string")
    counts = {r.v: r["count"] for r in feat.collapse_rare(df, "v", 2).groupBy("v").count().collect()}
    assert counts == {"a": 3, "b": 2, "Other": 2}


def test_scores_of_one_and_several_categories(spark):
    one = spark.createDataFrame([("a", 1.0)], "c string, r double")
    assert feat.category_scores(one, "c", "r").first().score == 1.0
    many = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 1.0), (None, 9.0)], "c string, r double")
    assert {r.c: r.score for r in feat.category_scores(many, "c", "r").collect()} == {"b": 1.0, "a": 0.5, "c": 0.0}


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "a double, b double")
    rows = feat.standardize(df, ["a", "b"]).orderBy("a").collect()
    assert rows[0].a == pytest.approx(-1.5 / 1.25**0.5) and rows[0].b == 0.0
    vector = df.select(F.array("a", "b").alias("v"))
    assert sorted(r.v[0] for r in feat.standardize_vectors(vector, "v").collect()) == pytest.approx([r.a for r in rows])


def test_wide_categories_are_encoded(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    wide = feat.one_hot_columns(df, ["c"])
    assert len(wide.columns) == 49 and sum(sum(r) for r in wide.collect()) == 49
    assert feat.few_values(df, ["c"], 60).collect() == [("c", 50)]


def test_encoded_means_count_gaps(spark):
    df = spark.createDataFrame([(0, 1.0, "x"), (0, None, None), (1, 3.0, "y")], "cluster int, n double, c string")
    found = {r.cluster: r.asDict() for r in summaries.encoded_means(df, ["n"], ["c"]).collect()}
    assert found[0]["n"] == 0.5 and found[1]["n"] == 3.0
    assert sum(v for k, v in found[0].items() if k.startswith("c_")) in (0.5, 1.0)


def test_names_repeat_with_a_number():
    assert feat.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a__dup1", "a__dup2"]


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    from merkato.sources.tables import find_column, read_csv, write_csv

    (tmp_path / "in.csv").write_text('a,b\n1,"x ""y"", z"\n2,"two\nlines"\n3,plain\n')
    rows = read_csv(spark, str(tmp_path / "in.csv"), spark.createDataFrame([], "a int, b string").schema, multi_line=True)
    wanted = [(1, 'x "y", z'), (2, "two\nlines"), (3, "plain")]
    assert sorted(map(tuple, rows.collect())) == wanted
    out = write_csv(rows, str(tmp_path), "out")
    assert sorted(map(tuple, read_csv(spark, out, rows.schema).collect())) == wanted
    assert find_column(rows.toDF(" A ", "b"), "x", "a") == " A " and find_column(rows, "z") is None


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "cluster int, Revenue double, customers long, country string")


def test_ties_go_to_the_lowest(spark):
    df = rows_of(spark, (1, 5.0, 1, "x"), (0, 5.0, 1, "x"), (2, 5.0, 1, "y"))
    by_country = summaries.country_clusters(df, "country")
    assert {r.country: r.dominant_cluster for r in summaries.dominant_cluster(by_country).collect()} == {"x": 0, "y": 2}
    summary = decisions.priority_score(summaries.cluster_summary(df, 3))
    assert decisions.top_revenue_cluster(summary).first()[0] == 0
    assert [r.cluster for r in decisions.top_priority(summary).collect()] == [0, 1, 2]
    modes = summaries.representatives(df, ["country"]).orderBy("cluster").collect()
    assert [m.value for m in modes] == ["x", "x", "y"] and modes[0].share_pct == 100.0


def test_empty_clusters_zero_revenue_and_zero_customers(spark):
    df = rows_of(spark, (0, 0.0, 0, "x"), (1, 0.0, 0, "y"))
    summary = summaries.cluster_summary(df, 3, customers="customers")
    assert [r.size for r in summary.orderBy("cluster").collect()] == [1, 1, 0]
    rated = decisions.value_flag(decisions.priority_score(decisions.revenue_per_customer(summary))).collect()
    assert all(r.revenue_per_customer is None and r.value_flag is None for r in rated)
    assert max(r.priority_score for r in rated) == 0.5
    actions = decisions.platform_actions(decisions.priority_score(summary)).collect()
    assert [(a.kind, a.cluster) for a in actions] == [("focus", 0), ("focus", 1), ("focus", 2), ("top_revenue", 0)]


def test_segment_record_confidence(spark):
    df = spark.createDataFrame([(0.123456,)], "s double")
    assert str(df.select(clustering.confidence(F.col("s"))).first()[0]) == "0.1235"
