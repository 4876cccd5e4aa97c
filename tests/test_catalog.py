"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import check
from merkato.plans.catalog import QUERIES, SQL

# One or two of each kind by default; MERKATO_ALL_QUERIES=1 runs every one.
USUAL = [
    "S1_table_scan", "S4_schema_discovery", "S8_segment_upsert", "S9_csv_export", "P3_product_range", "P8_null_fill",
    "P15_narrow_categories", "P16_rare_categories", "J1_star_current", "J2_star_as_recorded", "J5_orphans",
    "J6_overlapping_validity", "J11_as_of_version", "A1_market_month_metrics", "A1_market_day_metrics",
    "A2_static_features", "A6_cluster_summary", "A13_dominant_cluster", "A14_country_composition",
    "A19_quantiles_of_rows", "A22_cluster_profile", "W3_last_steps", "W6_sequences", "W7_top_deviations",
    "R4_dense_clusters", "M1_standardize", "M4_hybrid_vector", "M6_dbscan_wide", "M7_silhouette", "M9_representatives",
    "D7_recommendations", "D8_platform_actions", "D10_strategy_bucket", "Q_full_report", "Q14_distribution",
    "L1_stored_batches", "J11_as_of_overlaps", "J11_as_of_merge", "L9_second_batch", "L7_second_batch", "A1_distinct_over_months",
    "J7_recent_periods", "Q_planted_faults", "Q13_table_profiles", "Q14_sketched_quantiles", "S2_csv_rejects", "S3_replaced_table", "M3_one_hot_entries",
    "A18_encoded_mean_rows", "M5_cost_identity", "M8_fitted_centres", "M10_projection_total", "M13_embedding_total",
    "M15_stored_segments", "M15_segment_statistics", "M15_segment_projection", "M16_segmented_rows", "A6_fitted_summary",
    "A14_fitted_countries", "A16_fitted_shares", "A22_fitted_profile", "D8_fitted_decisions", "L1_versioned_merge", "L2_fixed_load", "L7_customer_dimension", "L9_sales_facts", "L9_rejected_sales",
]
NAMES = sorted(SQL) if os.environ.get("MERKATO_ALL_QUERIES") else USUAL


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, small, duck, name):
    assert check.differences(QUERIES[name](spark, small), duck, SQL[name]) is None


def test_every_group_is_registered():
    sizes = {"S": 13, "P": 20, "J": 11, "A": 27, "W": 11, "R": 4, "M": 16, "D": 11, "Q": 16, "L": 9}
    known = {name.split("_")[0] for name in QUERIES}
    re_aimed = {"M11", "M12"}  # the principal embedding stands for the trained encoder
    assert {f"{g}{i}" for g, n in sizes.items() for i in range(1, n + 1)} - re_aimed <= known
