"""Decision support (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.operators import decisions, summaries
from merkato.plans.catalog.registry import K, labelled, query, r, rounded
from merkato.plans.catalog.windows import DEVIATIONS, _NUMERIC
from merkato.session import store

_CATEGORIES = ["Subcategory", "ProductLine", "Gender", "LoyaltyStatus"]
REPRESENTATIVES = "representatives AS (SELECT cluster, feature, value, 100.0::DOUBLE * n / CAST(size AS DOUBLE) AS share_pct " \
    "FROM (SELECT *, row_number() OVER (PARTITION BY cluster, feature ORDER BY n DESC, value) AS k, sum(n) OVER (PARTITION " \
    "BY cluster, feature) AS size FROM (" + " UNION ALL ".join(
        f"SELECT cluster, '{c}' AS feature, {c} AS value, count(*) AS n FROM labelled GROUP BY 1, 2, 3"
        for c in _CATEGORIES) + ")) WHERE k = 1)"


def _scored(rows):
    return decisions.priority_score(decisions.revenue_per_customer(summaries.cluster_summary(rows, K)))


def _summary(wh):
    return _scored(labelled(wh))


@query("D1_revenue_per_customer", f"SELECT cluster, {r('revenue_per_customer')} AS revenue_per_customer FROM scored")
def _(wh):
    value = decisions.revenue_per_customer(summaries.cluster_summary(labelled(wh), K))
    return rounded(value.select("cluster", "revenue_per_customer"), ["revenue_per_customer"])


@query("D2_priority_score", f"SELECT cluster, {r('priority_score')} AS priority_score FROM scored")
def _(wh):
    return rounded(_summary(wh).select("cluster", "priority_score"), ["priority_score"])


@query("D2_priority_score_by_size", f"SELECT cluster, {r('size / CAST(max(size) OVER () AS DOUBLE)')} AS priority_score "
       "FROM summary")
def _(wh):
    sizes = summaries.cluster_summary(labelled(wh), K, revenue=None)
    return rounded(decisions.priority_score(sizes).select("cluster", "priority_score"), ["priority_score"])


@query("D3_priority_band", "SELECT cluster, priority_band FROM flagged")
def _(wh):
    return decisions.priority_band(_summary(wh)).select("cluster", "priority_band")


@query("D4_value_flag", "SELECT cluster, value_flag FROM flagged")
def _(wh):
    return decisions.value_flag(_summary(wh)).select("cluster", "value_flag")


@query("D5_drivers", f"SELECT cluster, rank, feature, {r('diff')} AS diff FROM deviations WHERE rank <= 4", ctes=DEVIATIONS)
def _(wh):
    listed = decisions.drivers(summaries.deviations(labelled(wh), _NUMERIC))
    return rounded(listed.select("cluster", F.explode("drivers").alias("d")).select("cluster", "d.*"), ["diff"])


@query("D6_category_indicators", f"SELECT cluster, feature, value, {r('share_pct')} AS share_pct FROM representatives",
       ctes=REPRESENTATIVES)
def _(wh):
    return rounded(summaries.representatives(labelled(wh), _CATEGORIES), ["share_pct"])


@query("D7_recommendations", "SELECT cluster, 'priority' AS kind, priority_band AS text FROM flagged UNION ALL "
       "SELECT cluster, 'value', value_flag FROM flagged WHERE value_flag IS NOT NULL UNION ALL "
       "SELECT cluster, 'drivers', string_agg(format('{} ({:+.2f})', feature, diff), ', ' ORDER BY rank) FROM deviations "
       "WHERE rank <= 4 GROUP BY 1 UNION ALL SELECT cluster, 'categories', string_agg(format('{}={} ({:.0f}%)', feature, "
       "value, share_pct), ', ' ORDER BY feature) FROM representatives GROUP BY 1",
       ctes=f"{DEVIATIONS}, {REPRESENTATIVES}")
def _(wh):
    rows = store(labelled(wh), "labelled")
    return decisions.recommendations(
        _scored(rows), summaries.deviations(rows, _NUMERIC), summaries.representatives(rows, _CATEGORIES))


@query("D8_platform_actions", "SELECT 'focus' AS kind, CAST(position AS INTEGER) AS position, cluster FROM (SELECT cluster, "
       "row_number() OVER (ORDER BY priority_score DESC, cluster) AS position FROM scored) WHERE position <= 3 UNION ALL "
       "(SELECT 'top_revenue', 1, cluster FROM scored ORDER BY total_revenue DESC, cluster LIMIT 1)")
def _(wh):
    return decisions.platform_actions(_summary(wh))


_FLEXIBLE = "round_even(priority_score / sum(priority_score) OVER () * 100 * 0.7 * 10.0, 0) / 10.0"


@query("D9_budget", f"SELECT cluster, {r('priority_score / sum(priority_score) OVER ()')} AS priority_weight, "
       f"{r(_FLEXIBLE)} AS pct_of_flexible_budget, {r(_FLEXIBLE + ' * 0.8')} AS pct_of_total_budget FROM scored")
def _(wh):
    shares = ["priority_weight", "pct_of_flexible_budget", "pct_of_total_budget"]
    return rounded(decisions.budget(_summary(wh)).select("cluster", *shares), shares)


def _q(column, share):
    return f"(SELECT quantile_cont({column}, {share}) FROM scored)"


@query("D10_strategy_bucket", f"""SELECT cluster, CASE
  WHEN revenue_per_customer >= {_q('revenue_per_customer', 0.75)} THEN
    CASE WHEN size / (SELECT max(size) FROM scored) < 0.25 THEN '{decisions.NICHE_VIP}' ELSE '{decisions.HIGH_VALUE}' END
  WHEN revenue_per_customer <= {_q('revenue_per_customer', 0.25)} THEN
    CASE WHEN size / (SELECT max(size) FROM scored) > 0.4 THEN '{decisions.MASS_LOW_VALUE}'
      ELSE '{decisions.UNDERPERFORMING}' END
  WHEN size >= {_q('size', 0.75)} THEN '{decisions.LARGE}'
  WHEN size <= {_q('size', 0.25)} THEN '{decisions.SMALL}' ELSE '{decisions.BALANCED}' END AS strategy_bucket FROM scored""")
def _(wh):
    return decisions.strategy_bucket(_summary(wh)).select("cluster", "strategy_bucket")


@query("D11_potential", f"SELECT cluster, CASE WHEN total_revenue > {_q('total_revenue', 0.8)} THEN 'high' ELSE 'low' END AS "
       f"potential FROM scored WHERE total_revenue > {_q('total_revenue', 0.8)} OR total_revenue < "
       f"{_q('total_revenue', 0.2)}")
def _(wh):
    return decisions.potential(_summary(wh)).select("cluster", "potential")
