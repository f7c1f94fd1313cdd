"""Where shuffles and Python are allowed."""

from cases import fixture_docs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_quality_is_one_projection(spark):
    from textkiln.llm.queries import op1_quality_rules

    p = plan(op1_quality_rules(spark, SF))
    assert "Exchange" not in p and "Python" not in p and "Arrow" not in p


def test_sharding_is_native(spark):
    from textkiln.llm.queries import op9_sharding

    p = plan(op9_sharding(spark, SF))
    assert "Python" not in p and "Arrow" not in p and "Pandas" not in p


def test_features_are_evaluated_once(spark):
    from textkiln.llm.quality import quality_filter

    assert plan(quality_filter(fixture_docs(spark))).count("xxhash64") <= 3


def test_listed_rules_and_sql_have_the_same_names(spark):
    from textkiln.llm.queries import ORACLE_SQL, QUERIES

    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) == 13
