"""SQL over the registered views equals the DataFrame operators."""

from shelfwise.operators import recommend
from shelfwise.plans.queries import _p
from shelfwise.plans.views import register_views


def test_sql_over_views(spark, sf_small):
    p = _p(spark, sf_small)
    names = register_views(p)
    assert "gold_feature_mart" in names
    sql = spark.sql("SELECT action, count(*) AS count FROM pricing_recommendations GROUP BY action")
    df = recommend.action_counts(p.price_flags)
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, df.collect()))
    n = spark.sql("SELECT count(*) FROM gold_feature_mart").collect()[0][0]
    assert n == spark.sql("SELECT count(DISTINCT sku_id) FROM gold_pricing_features").collect()[0][0]
