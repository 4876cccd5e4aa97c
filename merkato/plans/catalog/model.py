"""Feature engineering, clustering and evaluation (M)."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from merkato import schemas
from merkato.operators import clustering, density, encoder, kmeans, series, star, summaries
from merkato.operators import features as feat
from merkato.plans.catalog.decide import REPRESENTATIVES, _CATEGORIES
from merkato.plans.catalog.registry import labelled, query, r, rounded
from merkato.plans.catalog.windows import _NUMERIC
from merkato.plans.segmentation import Settings, market_sequences, run_segmentation
from merkato.session import new_path, store
from merkato.sources.tables import scan
from merkato.sources.tpch import source


def _scaled(columns, table):
    return ", ".join(
        r(f"coalesce((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
          f"nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 0)") + f" AS {c}" for c in columns) + f" FROM {table}"


@query("M1_standardize", f"SELECT market, {_scaled(feat.STATIC_FEATURES, 'static')}")
def _(wh):
    static = feat.static_features(feat.static_rows(wh))
    return rounded(feat.standardize(static, feat.STATIC_FEATURES), feat.STATIC_FEATURES)


@query("M2_standardize_steps", f"SELECT market, CAST(step AS INTEGER) AS step, {_scaled(series.STEP_FEATURES, 'steps')}")
def _(wh):
    steps = series.last_steps(series.market_series(wh)).select("market", "step", *series.STEP_FEATURES)
    return rounded(feat.scale_steps(steps, series.STEP_FEATURES), series.STEP_FEATURES)


_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("M3_one_hot", "SELECT c_custkey, c_acctbal, " + ", ".join(
    f"CAST(c_mktsegment = '{v}' AS INTEGER) AS c_mktsegment_{v.lower()}" for v in _SEGMENTS) + " FROM customer", source=True)
def _(spark, folder):
    return feat.one_hot_columns(
        source(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), ["c_mktsegment"])


@query("M4_hybrid_vector", "SELECT market, CAST(pos AS INTEGER) AS position, value FROM (" + " UNION ALL ".join(
    [f"SELECT market, {i} AS pos, {r(f'CAST({c} AS DOUBLE)')} AS value FROM latest"
     for i, c in enumerate(("revenue", "quantity"))] +
    [f"SELECT market, {i + 2} AS pos, {_scaled([c], 'static').replace(' AS ' + c, ' AS value')}"
     for i, c in enumerate(feat.STATIC_FEATURES)]) + ")")
def _(wh):
    latest = series.latest_period(series.market_series(wh))
    embedded = latest.select("market", F.array(F.col("revenue").cast("double"), F.col("quantity").cast("double")).alias("embedding"))
    vectors = feat.hybrid_vectors(embedded, feat.static_features(feat.static_rows(wh)))
    return rounded(vectors.select("market", F.posexplode("vector").alias("position", "value")), ["value"])


_PART_CATEGORIES = ["p_name", "p_brand", "p_type"]


@query("M3_one_hot_entries", """
SELECT p_partkey, feature, position FROM c JOIN t USING (feature, category)""", source=True, ctes="""
c AS (SELECT p_partkey, unnest(['p_brand', 'p_name', 'p_type']) AS feature, unnest([p_brand, p_name, p_type]) AS category FROM part),
first AS (SELECT feature, min(category) AS f FROM c GROUP BY 1),
t AS (SELECT feature, category, row_number() OVER (ORDER BY feature, category) - 1 AS position
      FROM (SELECT DISTINCT feature, category FROM c JOIN first USING (feature) WHERE category > f))""")
def _(spark, folder):
    return feat.one_hot_entries(source(spark, folder, "part"), ["p_partkey"], _PART_CATEGORIES)


def _points(spark, folder):
    return source(spark, folder, "embeddings")


@query("M5_kmeans", source=True)
def _(spark, folder):
    points = _points(spark, folder).select("vec_id", "embedding")
    return clustering.kmeans_labels(points, "embedding", 5).select("vec_id", "cluster")


@query("M5_cost_identity", f"""
SELECT count(*) AS points, CAST(5 AS BIGINT) AS clusters, {r('sum(total)', 4)} AS total, {r('sum(total)', 4)} AS within_and_between FROM (
  SELECT list_sum(list_transform(list_zip(embedding, mean), lambda x: (CAST(x[1] AS DOUBLE) - x[2]) ** 2)) AS total
  FROM embeddings, (SELECT list(m ORDER BY i) AS mean FROM (
    SELECT i, avg(CAST(e AS DOUBLE)) AS m FROM (SELECT unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY 1)))""", source=True)
def _(spark, folder):
    points = _points(spark, folder).select("vec_id", "embedding")
    model = kmeans.fit(points, "embedding", 5)
    labelled_points = kmeans.assign(points, "embedding", model)
    entries = labelled_points.select("cluster", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    by_cluster = entries.groupBy("cluster", "i").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
    squares = entries.agg(F.sum(F.col("x") * F.col("x")).alias("q"))
    whole = by_cluster.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"))
    own = by_cluster.agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"))
    counted = labelled_points.agg(F.count("*").alias("points"), F.count_distinct("cluster").alias("clusters"))
    # The model's own cost is the part within clusters.
    between = own.scalar() - whole.scalar()
    return rounded(counted.select("points", "clusters", (squares.scalar() - whole.scalar()).alias("total"),
                                  (F.lit(model.cost) + between).alias("within_and_between")), ["total", "within_and_between"], 4)


_PAIRS = """distances AS (
  SELECT a.vec_id AS a, b.vec_id AS b, b.label AS label,
    sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
      lambda x: (CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE)) ** 2))) AS d
  FROM embeddings a, embeddings b),
near AS (SELECT a, b FROM distances WHERE d <= {eps}),
counted AS (SELECT a AS vec_id, count(*) AS neighbours FROM near GROUP BY 1)"""


def _dbscan_ctes(eps, min_samples):
    return _PAIRS.format(eps=eps) + f""",
core AS (SELECT vec_id FROM counted WHERE neighbours >= {min_samples}),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM core
  UNION SELECT n.b, reach.root FROM reach JOIN near n ON n.a = reach.vec_id JOIN core c ON c.vec_id = n.b
    WHERE reach.root < n.b),
rooted AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY 1),
core_label AS (SELECT vec_id, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM rooted),
border AS (SELECT n.a AS vec_id, min(c.cluster) AS cluster FROM near n JOIN core_label c ON c.vec_id = n.b GROUP BY 1)"""


def _dbscan_sql(eps, min_samples):
    return ("SELECT vec_id AS id, coalesce(c.cluster, b.cluster, -1) AS cluster FROM embeddings LEFT JOIN core_label c "
            "USING (vec_id) LEFT JOIN border b USING (vec_id)"), _dbscan_ctes(eps, min_samples)


@query("M6_neighbour_counts", "SELECT vec_id AS id, neighbours FROM counted", ctes=_PAIRS.format(eps=1.1), source=True)
def _(spark, folder):
    return density.neighbour_counts(_points(spark, folder), "embedding", "vec_id", 1.1)


@query("M6_dbscan_default", *_dbscan_sql(0.5, 2), source=True)
def _(spark, folder):
    return density.dbscan(_points(spark, folder), "embedding", "vec_id")


@query("M6_dbscan_wide", *_dbscan_sql(1.1, 3), source=True)
def _(spark, folder):
    return density.dbscan(_points(spark, folder), "embedding", "vec_id", 1.1, 3)


def _silhouette_sql(distance):
    return f"""
SELECT count(*) AS points,
  {r('avg(CASE WHEN own_size = 1 THEN 0 ELSE (nearest - own) / greatest(nearest, own) END)')} AS silhouette FROM (
  SELECT a, max(CASE WHEN label = mine THEN total / nullif(n - 1, 0) END) AS own,
    max(CASE WHEN label = mine THEN n END) AS own_size, min(CASE WHEN label <> mine THEN total / n END) AS nearest
  FROM (SELECT a, label, sum({distance}) AS total, count(*) AS n FROM distances GROUP BY 1, 2)
  JOIN (SELECT vec_id, label AS mine FROM embeddings) ON vec_id = a GROUP BY 1)"""


@query("M7_silhouette", f"SELECT silhouette FROM ({_silhouette_sql('d')})", ctes=_PAIRS.format(eps=0), source=True)
def _(spark, folder):
    return rounded(clustering.silhouette(_points(spark, folder), "embedding", "label", "vec_id"), ["silhouette"])


@query("M7_silhouette_squared", _silhouette_sql("d * d"), ctes=_PAIRS.format(eps=0), source=True)
def _(spark, folder):
    points = _points(spark, folder).select("label", array_to_vector("embedding").alias("features"))
    value = clustering.silhouette_squared(points, "features", "label")
    return rounded(points.agg(F.count("*").alias("points"), F.lit(value).alias("silhouette")), ["silhouette"])


@query("M8_cluster_centres", "SELECT cluster, " + ", ".join(
    f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {c.lower()}" for c in _NUMERIC) + " FROM labelled GROUP BY 1")
def _(wh):
    return summaries.cluster_means(labelled(wh), _NUMERIC)


_FITTED = ["Revenue", "ProductQuantity", "LoyaltyStatus", "ProductLine"]


def _fitted(wh):
    rows = store(star.sales_star(wh).select(*_FITTED), "fitted-rows")
    return clustering.fitted_rows(rows, _FITTED, 4, starts=3)


@query("M8_fitted_centres", "SELECT feature, category, " + r("mean", 5) + """ AS mean, true AS are_cluster_means FROM (
  SELECT 'Revenue' AS feature, NULL::VARCHAR AS category, CAST(sum(Revenue) AS DOUBLE) / count(*) AS mean FROM star_current
  UNION ALL SELECT 'ProductQuantity', NULL, CAST(sum(ProductQuantity) AS DOUBLE) / count(*) FROM star_current
  UNION ALL SELECT 'LoyaltyStatus', LoyaltyStatus, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM star_current) FROM star_current
    WHERE LoyaltyStatus > (SELECT min(LoyaltyStatus) FROM star_current) GROUP BY 2
  UNION ALL SELECT 'ProductLine', ProductLine, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM star_current) FROM star_current
    WHERE ProductLine > (SELECT min(ProductLine) FROM star_current) GROUP BY 2)""")
def _(wh):
    found, centres, model = _fitted(wh)
    means = summaries.encoded_mean_rows(found, _FITTED[:2], _FITTED[2:]).select(
        F.col("cluster").alias("_cluster"), F.col("feature").alias("_feature"), F.col("category").alias("_category"), "mean")
    sizes = wh.spark.createDataFrame(list(enumerate(model.sizes)), "_of int, size long")
    beside = centres.join(means, (F.col("cluster") == F.col("_cluster")) & (F.col("feature") == F.col("_feature"))
                          & F.col("category").eqNullSafe(F.col("_category")), "left").join(sizes, F.col("cluster") == F.col("_of"))
    near = F.abs(F.col("centre") - F.coalesce("mean", F.lit(0.0))) <= 1e-6 * (1 + F.abs("centre"))
    return rounded(beside.groupBy("feature", "category").agg(
        (F.sum(F.col("centre") * F.col("size")) / F.sum("size")).alias("mean"), F.bool_and(near).alias("are_cluster_means")), ["mean"], 5)


@query("M9_representatives", "SELECT cluster, feature, value FROM representatives", ctes=REPRESENTATIVES)
def _(wh):
    return summaries.representatives(labelled(wh), _CATEGORIES).select("cluster", "feature", "value")


@query("M10_projection", source=True)
def _(spark, folder):
    placed = clustering.project(_points(spark, folder).select("vec_id", "embedding"), "embedding")
    return placed.select("vec_id", *[F.col(c)[i].alias(f"{c}{i + 1}") for c in ("pc", "explained") for i in range(2)])


@query("M10_projection_total", f"""
SELECT count(*) AS points, {r('sum(total)', 4)} AS total, 1.0::DOUBLE AS explained FROM (
  SELECT list_sum(list_transform(list_zip(embedding, mean), lambda x: (CAST(x[1] AS DOUBLE) - x[2]) ** 2)) AS total
  FROM embeddings, (SELECT list(m ORDER BY i) AS mean FROM (
    SELECT i, avg(CAST(e AS DOUBLE)) AS m FROM (SELECT unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY 1)))""", source=True)
def _(spark, folder):
    # All components together keep every distance from the mean.
    points = _points(spark, folder).select("vec_id", "embedding")
    width = points.agg(F.max(F.size("embedding"))).first()[0]
    placed = clustering.project(points, "embedding", width)
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    squares = add(F.transform("pc", lambda x: x * x))
    return rounded(placed.agg(F.count("*").alias("points"), F.sum(squares).alias("total"), F.max(add(F.col("explained"))).alias("explained")),
                   ["total", "explained"], 4)


def sequences_of(wh):
    static = feat.static_features(feat.static_rows(wh))
    return store(market_sequences(series.market_series(wh), static, Settings()), "sequences")


def _exploded(embedded):
    return embedded.select("market", F.posexplode("embedding").alias("position", "value"))


@query("M13_principal_embedding")
def _(wh):
    return _exploded(encoder.principal_embedding(sequences_of(wh)))


@query("M13_embedding_total", f"""
SELECT count(DISTINCT market) AS markets, {r('sum((v - m) ** 2)', 2)} AS total FROM (
  SELECT market, v, avg(v) OVER (PARTITION BY step, feature) AS m FROM (
    UNPIVOT (SELECT market, step, {_scaled(series.STEP_FEATURES, '(SELECT * FROM steps SEMI JOIN static USING (market))')})
    ON {', '.join(series.STEP_FEATURES)} INTO NAME feature VALUE v))""")
def _(wh):
    # There are fewer markets than numbers in an embedding, so it keeps every distance from the mean.
    squares = F.aggregate(F.transform("embedding", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    embedded = encoder.principal_embedding(sequences_of(wh))
    return rounded(embedded.agg(F.count_distinct("market").alias("markets"), F.sum(squares).alias("total")), ["total"], 2)


@query("M14_confidence", "SELECT round(avg(CASE WHEN own_size = 1 THEN 0 ELSE (nearest - own) / greatest(nearest, own) END), 4)"
       """ AS confidence FROM (
  SELECT a, max(CASE WHEN label = mine THEN total / nullif(n - 1, 0) END) AS own,
    max(CASE WHEN label = mine THEN n END) AS own_size, min(CASE WHEN label <> mine THEN total / n END) AS nearest
  FROM (SELECT a, label, sum(d) AS total, count(*) AS n FROM distances GROUP BY 1, 2)
  JOIN (SELECT vec_id, label AS mine FROM embeddings) ON vec_id = a GROUP BY 1)""", ctes=_PAIRS.format(eps=0), source=True)
def _(spark, folder):
    score = clustering.silhouette(_points(spark, folder), "embedding", "label", "vec_id")
    return score.select(clustering.confidence(F.col("silhouette")).alias("confidence"))


@query("M15_market_segmentation")
def _(wh):
    return run_segmentation(wh, Settings()).segments


@query("M15_stored_segments", "SELECT datekey, market AS marketnamekey, CAST(revenue AS DOUBLE) AS revenue, quantity, "
       "CASE WHEN revenue < 10000 THEN 'Low' WHEN revenue < 50000 THEN 'Medium' ELSE 'High' END AS productrange, true AS known_segment, "
       "true AS scored, 'lstm_hybrid_v2.0_20240507' AS modelversion FROM latest SEMI JOIN steps USING (market) SEMI JOIN static USING (market)")
def _(wh):
    target = new_path(wh.spark, "segments")
    for day in (6, 7):  # the second run takes the place of the first
        run_segmentation(wh, Settings(), dt.date(2024, 5, day), target)
    return scan(wh.spark, target, schemas.TABLES["FactMarketSegmentation"]).select(
        "DateKey", "MarketNameKey", "Revenue", "Quantity", "ProductRange", F.col("SegmentID").between(0, 4).alias("known_segment"),
        F.col("ConfidenceScore").between(-1, 1).alias("scored"), "ModelVersion")


_CLUSTERED = "latest SEMI JOIN steps USING (market) SEMI JOIN static USING (market)"


@query("M15_segment_statistics", "SELECT CAST(5 AS BIGINT) AS segments, count(*) AS markets, true AS same_markets, CAST(sum(revenue) AS DOUBLE) "
       f"AS revenue, CAST(sum(quantity) AS DOUBLE) AS quantity FROM {_CLUSTERED}")
def _(wh):
    result = run_segmentation(wh, Settings())
    beside = result.statistics().join(result.distribution().select("segment", F.col("markets").alias("listed")), "segment")
    return rounded(beside.agg(
        F.count("*").alias("segments"), F.sum("markets").alias("markets"), F.bool_and(F.col("markets") == F.col("listed")).alias("same_markets"),
        F.sum("revenue_sum").alias("revenue"), F.sum("quantity_sum").alias("quantity")), ["revenue", "quantity"], 2)


@query("M15_segment_projection", "SELECT count(*) AS markets, CAST(sum(revenue) AS DOUBLE) AS revenue, 0.0::DOUBLE AS pc1, 0.0::DOUBLE AS pc2, "
       f"true AS widest_first FROM {_CLUSTERED}")
def _(wh):
    placed = run_segmentation(wh, Settings()).projection()
    wide = (F.var_samp("pc1") >= F.var_samp("pc2")) & (F.max("explained1") >= F.max("explained2"))
    return rounded(placed.agg(F.count("*").alias("markets"), F.sum("revenue").cast("double").alias("revenue"), F.avg("pc1").alias("pc1"),
                              F.avg("pc2").alias("pc2"), wide.alias("widest_first")), ["pc1", "pc2"], 3)


@query("M16_row_segmentation")
def _(wh):
    return _segmented(wh)


def _segmented(wh):
    found = clustering.segment_rows(store(star.sales_star(wh), "sales-rows"))
    return found.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("Revenue").alias("revenue"))


@query("M16_segmented_rows", "SELECT CAST(6 AS BIGINT) AS clusters, true AS larger_first, CAST(count(*) AS BIGINT) AS size, "
       "CAST(sum(Revenue) AS DOUBLE) AS revenue FROM star_current")
def _(wh):
    sizes = _segmented(wh)
    ordered = F.array_sort(F.collect_list(F.struct("cluster", "size")))["size"]  # one row per cluster
    return sizes.agg(
        F.count("*").alias("clusters"), (ordered == F.reverse(F.array_sort(ordered))).alias("larger_first"),
        F.sum("size").alias("size"), F.sum("revenue").alias("revenue"))
