"""What Spark does with the plans: scans, joins, pushdown, hot keys."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trendloom.operators import aggregate, joins, periods, series
from trendloom.plans import census, near_transit, transit, vehicles
from trendloom.sources import buckets, readers
from trendloom.workload import operators, plans
from trendloom.workload.views import transit_wide, view

FOLDER = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """The adapted plan after a run, without the initial ones."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", text, flags=re.S)


def nodes(df, under: str = "") -> list[tuple[str, str]]:
    """Name and one-line text of every node that ran, each shuffle's source once however often it is read.

    With ``under`` only what feeds the node of which the text begins so, without subqueries.
    """
    df.collect()
    found = []

    def visit(node, inside: bool):
        name, text = node.nodeName(), node.simpleString(10_000)
        if inside:
            found.append((name, text))
        here = inside or text.startswith(under)
        if name.startswith("AdaptiveSparkPlan"):
            visit(node.executedPlan(), here)
        elif name in ("ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage", "ResultQueryStage"):
            visit(node.plan(), here)
        elif name != "ReusedExchange" and name != "ReusedSubquery":
            children = node.children()
            for i in range(children.size()):
                visit(children.apply(i), here)
        inner = node.subqueries()
        for i in range(0 if under else inner.size()):
            visit(inner.apply(i), here)

    visit(df._jdf.queryExecution().executedPlan(), not under)
    return found


def scans(df, table: str) -> int:
    return sum(name.startswith("Scan") and f"/{table}.parquet" in text for name, text in nodes(df))


@pytest.mark.parametrize("name", sorted({**operators.QUERIES, **plans.QUERIES}))
def test_no_python_and_no_product_join(spark, name):
    plan = entry_point.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name, table, most",
    [
        ("title_transactions", "lineitem", 1),
        ("titles_by_make", "lineitem", 1),
        ("titles_by_tract", "lineitem", 1),
        ("vehicle_trends", "lineitem", 1),
        ("vehicle_trends", "orders", 1),
        ("near_transit_population", "lineitem", 1),
        ("latest_vintage", "lineitem", 1),
        ("transit_trends", "lineitem", 1),
        ("registrations_by_fuel", "orders", 1),
        ("region_rollup", "orders", 1),
        ("share_of_total", "lineitem", 1),
        ("annual_and_ytd", "orders", 2),
    ],
)
def test_source_is_not_read_again(spark, name, table, most):
    assert 1 <= scans(entry_point.queries()[name](spark, FOLDER), table) <= most


def test_parts_of_the_titles_share_one_shuffle(spark):
    """The cube's shuffle feeds the county and make sums and the newest months."""
    ran = nodes(entry_point.queries()["vehicle_trends"](spark, FOLDER))
    reused = [text for name, text in ran if name == "ReusedExchange" and "transaction_month" in text and "level" in text]
    assert len(reused) >= 2


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "titles")
    view(spark, FOLDER, "titles").write.parquet(path)
    titles = spark.read.parquet(path)
    plan = vehicles.title_transactions(titles)._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "EqualTo(transaction_type,Original Title)" in pushed and "new_or_used" in pushed
    assert "make" not in re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    makes = vehicles.titles_by_make(titles)._jdf.queryExecution().executedPlan().toString()
    read = "ReadSchema: struct<transaction_month:string,electrification_level:string,make:string,transactions:"
    assert read in makes and makes.count("ReadSchema") == makes.count(read)


def test_complete_year_limit_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "months")
    spark.range(100).selectExpr("date_add(date'2019-01-01', cast(id * 20 AS int)) AS date", "cast(id AS double) AS estimate").write.parquet(path)
    plan = periods.annual_summary(spark.read.parquet(path), [], 2020)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(date,2021-01-01)" in plan


def test_large_sides_are_not_shuffled_by_a_handful_of_keys(spark, tmp_path):
    """Planned for sources whose size rules out any broadcast found by estimates."""
    for name in ("acs_estimates", "acs_metro", "acs_counties", "agencies", "titles"):
        view(spark, FOLDER, name).write.parquet(str(tmp_path / name))
    read = {p.name: spark.read.parquet(str(p)) for p in tmp_path.iterdir()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        census_plan = census.acs_trends(read["acs_estimates"], read["acs_metro"], read["acs_counties"], [1998])
        transit_plan = transit.transit_trends(transit_wide(spark, FOLDER), read["agencies"])
        titles_plan = vehicles.titles_by_tract(read["titles"])
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (census_plan, transit_plan, titles_plan)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan, key in zip(plans, ("variable", "metric", "year")):
        assert not re.search(rf"(SortMerge|ShuffledHash)Join \[{key}#\d+L?\]", plan)


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS double) AS estimate")
    for built in (aggregate.sum_by(df, ["k"]), aggregate.moe_sum(df.withColumn("moe", F.lit(1.0)), ["k"])):
        plan = built._jdf.queryExecution().executedPlan().toString()
        before = plan[plan.index("Exchange"):]
        assert "partial_sum" in before


@pytest.fixture
def shuffled_joins(spark):
    """Small skew limits and no broadcasting, as if every side were large."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_parcel_reaches_the_join_summed(spark, shuffled_joins, tmp_path):
    """A third of all facts belong to one parcel; without splitting, it joins as one row a year."""
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    facts = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 0, id % 997) AS parcel_dim_id", "cast(2010 + id % 15 AS int) AS estimate_year",
        "cast(id % 7 AS double) AS total_pop", "cast(rand(1) AS double) + 1 AS housing_units", "cast(id % 4 AS int) AS ofm_vintage",
    )
    parcels = spark.range(0, 997, 1, 4).selectExpr(
        "id AS parcel_dim_id", "if(id % 2 = 0, 'in station area', 'not in station area') AS hct_station_area_vision_2050")
    facts.write.parquet(str(tmp_path / "f"))
    parcels.write.parquet(str(tmp_path / "p"))
    facts, parcels = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "p"))
    got = near_transit.near_transit_population(facts, parcels)
    plan = final_plan(got)
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert "skewed" not in plan and "skew=true" not in plan
    join = plan.index("SortMergeJoin")
    assert re.search(r"HashAggregate\(keys=\[parcel_dim_id", plan[join:])
    levels = got.filter("grouping = 'Annual' AND metric = 'Population near HCT' AND year < '2020'")
    want = facts.filter("estimate_year < 2020").agg(F.sum("total_pop")).first()[0]
    assert levels.agg(F.sum("estimate")).first()[0] == want


def test_bucketed_parcels_join_where_they_lie(spark, shuffled_joins, rows):
    """A third of all facts belong to one parcel, whose rows are copies; it lies in several buckets, and nothing is shuffled to the join."""
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    facts = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 0, if(id % 991 = 0, null, id % 997)) AS parcel_dim_id", "cast(2010 + id % 15 AS int) AS estimate_year",
        "cast(id % 7 AS double) AS total_pop", "cast(1 AS double) AS housing_units", "cast(id % 4 AS int) AS ofm_vintage",
    )
    facts = facts.withColumns({c: F.when(F.col("parcel_dim_id") == 0, F.lit(v)).otherwise(F.col(c)) for c, v in (("total_pop", 2.0), ("ofm_vintage", 3))})
    parcels = spark.range(0, 990, 1, 4).selectExpr(
        "id AS parcel_dim_id", "if(id % 2 = 0, 'in station area', 'not in station area') AS hct_station_area_vision_2050")
    buckets.write_pair(facts, parcels, "parcel_dim_id", ("shape_facts", "shape_parcels"), buckets=12)
    lain = spark.table("shape_facts")
    sizes = [r[0] for r in lain.filter("parcel_dim_id = 0").groupBy("salt").count().select("count").collect()]
    assert lain.count() == 30_000 and len(sizes) >= 4 and max(sizes) < 30_000 / 11
    got = near_transit.near_transit_population(lain, spark.table("shape_parcels"), bucketed=True)
    below = nodes(got, under="SortMergeJoin [parcel_dim_id")
    assert sum(name.startswith("Scan") for name, _ in below) == 2
    assert not any("Exchange" in name for name, _ in below)
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    assert rows(got, "year", "variable", "metric", "grouping", "estimate") == rows(
        near_transit.near_transit_population(facts, parcels), "year", "variable", "metric", "grouping", "estimate")


def test_lookup_prunes_the_folders(spark, tmp_path):
    spark.range(800).selectExpr("concat('B', id % 40, '_001') AS variable", "id AS estimate", "concat('B', id % 40) AS acs_table", "2020 AS year").write.partitionBy(
        "acs_table", "year").parquet(str(tmp_path / "acs"))
    spark.range(40).selectExpr("concat('B', id, '_001') AS variable", "concat('t', id % 20) AS topic").write.parquet(str(tmp_path / "lookup"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))
    got = readers.read_acs_by_lookup(spark, str(tmp_path / "acs"), lookup.filter("topic = 't3'"))
    assert got.count() == 40
    assert any(name.startswith("Scan") and "dynamicpruning" in text for name, text in nodes(got))
    assert got._jdf.queryExecution().executedPlan().toString().count("dynamicpruningexpression") >= 1


def test_share_of_a_hot_group_gathers_no_rows(spark, shuffled_joins):
    df = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS k", "cast(1 AS double) AS estimate")
    got = series.share_of_total(df, ["k"])
    plan = final_plan(got)
    assert "Window" not in plan
    assert got.count() == 90_000
    assert got.filter("k = -1").agg(F.sum("share")).first()[0] == pytest.approx(1.0)


def test_staged_groups_are_broadcast_by_their_size(spark):
    df = spark.range(0, 90_000, 1, 8).selectExpr("id % 3 AS k", "id AS u", "cast(1 AS double) AS estimate")
    few = final_plan(series.share_of_total(df, ["k"], staged=True))
    assert "BroadcastHashJoin" in few and "Exchange hashpartitioning" not in few
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        many = final_plan(series.share_of_total(df, ["u"], staged=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in many


def test_lookup_is_broadcast_only_when_small(spark):
    df = spark.range(1000).selectExpr("id AS k")
    lookup = spark.createDataFrame([(1, "a")], "code long, label string")
    small = joins.lookup_join(df, lookup, "k", "code")._jdf.queryExecution().executedPlan().toString()
    big = joins.lookup_join(df, spark.range(10**9).selectExpr("id AS code", "id AS label"), "k", "code")
    assert "BroadcastHashJoin" in small or "SortMergeJoin" in small
    assert "BroadcastHashJoin" not in big._jdf.queryExecution().executedPlan().toString()
