"""The dashboard over fitted clusters, against pandas over the same labelled rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from merkato.operators import decisions, star
from merkato.plans.dashboard import Shown, run_dashboard
from merkato.sources.tpch import TpchWarehouse

COLUMNS, K = ["Revenue", "ProductQuantity", "LoyaltyStatus", "ProductLine"], 4


@pytest.fixture(scope="module")
def board(spark, small):
    return run_dashboard(star.sales_star(TpchWarehouse.of(spark, small)), COLUMNS, K, starts=2)


@pytest.fixture(scope="module")
def rows(board):
    found = board.rows.toPandas()
    for c in ("Revenue", "LifeTimeValue"):
        found[c] = found[c].astype(float)
    return found


def by_cluster(df):
    return df.toPandas().set_index("cluster").sort_index()


def test_counts_and_revenue(board, rows):
    groups = rows.groupby("cluster")
    summary = by_cluster(board.summary)
    assert summary["size"].tolist() == groups.size().tolist() and len(summary) == K
    assert np.allclose(summary.total_revenue, groups.Revenue.sum())
    assert np.allclose(by_cluster(board.metrics()).pct_of_total, 100 * groups.size() / len(rows), atol=0.051)
    size, revenue = groups.size(), groups.Revenue.sum()
    assert np.allclose(summary.priority_score, 0.5 * size / size.max() + 0.5 * revenue / revenue.max())


def test_countries(board, rows):
    table = rows.groupby(["CountryRegion", "cluster"]).size().unstack(fill_value=0)
    shown = board.composition(5).toPandas().set_index("country")
    largest = sorted(table.index, key=lambda c: (-table.loc[c].sum(), c))[:5]
    assert sorted(shown.index) == sorted(largest)
    for country in largest:
        assert shown.loc[country, [str(k) for k in range(K)]].tolist() == table.loc[country].reindex(range(K), fill_value=0).tolist()
    dominant = board.dominant().toPandas().set_index("country").dominant_cluster
    assert all(dominant[c] == table.loc[c].idxmax() for c in table.index)


def test_means_are_the_fitted_centres(board, rows):
    means = {(r.cluster, r.feature, r.category): r["mean"] for r in board.means().collect()}
    for r in board.centres.collect():
        assert r.centre == pytest.approx(means.get((r.cluster, r.feature, r.category), 0.0), rel=1e-6, abs=1e-9)
    for k, own in rows.groupby("cluster"):
        assert means[k, "Revenue", None] == pytest.approx(own.Revenue.mean())
        for category, share in own.LoyaltyStatus.value_counts(normalize=True).items():
            if category != rows.LoyaltyStatus.min():
                assert means[k, "LoyaltyStatus", category] == pytest.approx(share)


def test_profile_and_representatives(board, rows):
    groups = rows.groupby("cluster")
    profile = by_cluster(board.profile())
    assert np.allclose(profile.avg_ltv, groups.LifeTimeValue.mean())
    assert np.allclose(profile.avg_ltv_to_max, groups.LifeTimeValue.mean() / groups.LifeTimeValue.mean().max())
    for r in board.representatives.collect():
        counts = rows[rows.cluster == r.cluster][r.feature].value_counts()
        assert counts[r.value] == counts.max() and r.share_pct == pytest.approx(100 * counts.max() / counts.sum())


def test_decisions(board):
    decided = by_cluster(board.decided())
    assert decided.priority_weight.sum() == pytest.approx(1) and decided.pct_of_flexible_budget.sum() == pytest.approx(70, abs=0.5)
    bands = np.select([decided.priority_score >= decisions.HIGH_PRIORITY, decided.priority_score >= decisions.MEDIUM_PRIORITY], ["High", "Medium"], "Low")
    assert decided.priority_band.tolist() == bands.tolist()
    order = sorted(decided.index, key=lambda k: (-decided.priority_score[k], k))
    focus = [r.cluster for r in board.actions().where("kind = 'focus'").orderBy("position").collect()]
    assert focus == order[:3]
    kinds = board.recommendations().groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in kinds if r.kind != "value"} == {"priority": K, "drivers": K, "categories": K}


def test_without_revenue_and_country(spark, small):
    rows = star.sales_star(TpchWarehouse.of(spark, small)).select("ProductQuantity", "LoyaltyStatus", "ProductLine")
    board = run_dashboard(rows, k=3, starts=1)
    assert board.shown == Shown(None, "ProductQuantity", None, None, "LoyaltyStatus", None)
    decided = by_cluster(board.decided())
    assert np.allclose(decided.priority_score, decided["size"] / decided["size"].max()) and decided.value_flag.isna().all()
    assert {r.kind for r in board.actions().collect()} == {"focus"}
    assert board.profile().where(F.col("total_revenue") > 0).isEmpty() and board.potential().isEmpty()
    with pytest.raises(ValueError):
        board.composition()
