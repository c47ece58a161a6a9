"""Properties that hold for any input."""

from pyspark.sql import functions as F

from plugsites.catalog.feeds import checked_feeds
from plugsites.catalog.frames import LAST_YEAR, stations
from plugsites.operators.checks import accepted, check, rejected
from plugsites.operators.consolidate import consolidate, distinct_tokens, site_first
from plugsites.operators.shape import align_schema, union_sources
from plugsites.plans.registry import ORDER, feed_sites, registry
from plugsites.schema import CANONICAL, SITE_KEY


def as_set(frame):
    return {tuple(row) for row in frame.collect()}


def test_accepted_and_rejected_split_the_distinct_rows(spark, folder):
    rows = stations(spark, folder)
    checked = check(rows, LAST_YEAR)
    good = accepted(checked)
    assert good.count() == good.distinct().count()
    good_rows, bad_rows = as_set(good), as_set(rejected(checked).drop("reason"))
    assert not good_rows & bad_rows
    assert good_rows | bad_rows == as_set(rows)


def test_consolidation_does_not_depend_on_partitioning(spark, folder):
    feeds = checked_feeds(spark, folder)
    few = registry([feed.coalesce(1) for feed in feeds])
    many = registry([feed.repartition(13, "street") for feed in reversed(feeds)])
    assert as_set(few) == as_set(many)
    assert few.groupBy(*SITE_KEY).count().where("count > 1").isEmpty()


def test_grouping_accepted_rows_gives_the_same_sites(spark, folder):
    """Leaving duplicates in before grouping changes nothing."""
    checked = checked_feeds(spark, folder)[0]
    direct = align_schema(feed_sites(checked), CANONICAL, tuple(ORDER))
    deduplicated = align_schema(site_first(accepted(checked, "row_key"), ORDER), CANONICAL, tuple(ORDER))
    assert {str(row) for row in direct.collect()} == {str(row) for row in deduplicated.collect()}


def test_one_site_with_most_rows(spark):
    """A third of all rows at one place, with few distinct values."""
    k = F.col("id")
    hot = k % 3 == 0
    rows = spark.range(60000).select(
        F.when(hot, 50.0).otherwise(47.5 + (k % 100) / 100).alias("latitude"),
        F.when(hot, 9.0).otherwise(6.0 + (k % 70) / 10).alias("longitude"),
        (k % 2).cast("int").alias("src"),
        k.alias("row_key"),
        F.lit(1).alias("number_of_charging_points"),
        F.array(F.concat(F.lit("p"), (k % 5).cast("string"))).alias("plug_types"),
        F.array((k % 4).cast("double")).alias("power_capacities_kw"),
        F.concat(F.lit("o"), k.cast("string")).alias("operator"),
    )
    sites = consolidate(align_schema(rows, CANONICAL, tuple(ORDER)), ORDER)
    site = sites.where("latitude = 50.0 and longitude = 9.0").first()
    assert site.number_of_charging_points == 20000
    assert site.plug_types == "p0,p1,p2,p3,p4"
    assert site.power_capacities_kw == "0,1,2,3"
    assert site.operator == "o0"


def test_ties_on_the_order_key_are_settled_by_the_values(spark):
    rows = [(50.0, 9.0, 1, 7, text) for text in "dbca"]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "latitude double, longitude double, src int, row_key long, street string")
        assert site_first(frame.repartition(4), ORDER).first().street == "a"


def test_union_fills_absent_columns(spark):
    left = spark.createDataFrame([(1, "a")], "n int, t string")
    right = spark.createDataFrame([(2,)], "n int")
    assert as_set(union_sources([left, right])) == {(1, "a"), (2, None)}


def test_blank_text_and_markers_do_not_hide_values(spark):
    rows = [
        (50.0, 9.0, 1, 1, " ", "UNKNOWN", "N.A"),
        (50.0, 9.0, 2, 1, " Weg 2 ", "", "Mainz"),
        (50.0, 9.0, 3, 1, "Weg 3", "Hessen", None),
    ]
    names = "latitude double, longitude double, src int, row_key long, street string, state string, city string"
    site = consolidate(align_schema(spark.createDataFrame(rows, names), CANONICAL, tuple(ORDER)), ORDER).first()
    assert (site.street, site.state, site.city, site.district_city) == ("Weg 2", "Hessen", "Mainz", "UNKNOWN")


def test_the_last_year_may_be_that_of_the_run(spark):
    rows = spark.sql(
        """SELECT 50D AS latitude, 9D AS longitude, 1 AS number_of_charging_points,
            explode(array(current_date(), add_months(current_date(), 12), DATE'2000-01-01', NULL)) AS commissioning_date"""
    )
    reasons = check(rows, F.year(F.current_date())).select("commissioning_date", "violations").collect()
    assert [row.violations for row in reasons] == [[], ["year"], [], []]


def test_bounds_are_valid_and_nothing_is_said_about_null(spark):
    rows = spark.createDataFrame(
        [(47.2, 5.5, 1), (55.1, 15.1, 20), (47.19, 5.5, None), (None, 15.2, 0), (float("nan"), 9.0, 21)],
        "latitude double, longitude double, number_of_charging_points int",
    ).withColumn("commissioning_date", F.lit(None).cast("date"))
    found = [row.violations for row in check(rows, 2026).collect()]
    assert found == [[], [], ["bbox"], ["bbox", "count_range", "missing_coordinates"], ["bbox", "count_range"]]


def test_distinct_elements_of_any_number_of_lists(spark):
    rows = [(1, ["b", "a"], [2.0]), (1, ["a", "c", None], None), (2, None, None), (3, [], [1.0, 1.0])]
    many = [(4, [f"x{n % 7}", f"y{n}"], [float(n % 3)]) for n in range(500)]
    df = spark.createDataFrame(rows + many, "site int, plugs array<string>, powers array<double>")
    found = {r.site: (r.plugs, r.powers) for r in distinct_tokens(df, ["site"], ["plugs", "powers"]).collect()}
    expected = sorted({f"x{n}" for n in range(7)} | {f"y{n}" for n in range(500)})
    assert found.pop(4) == (expected, [0.0, 1.0, 2.0])
    assert found == {1: (["a", "b", "c"], [2.0]), 2: ([], []), 3: ([], [1.0])}
    empty = spark.createDataFrame([], df.schema)
    assert distinct_tokens(empty, ["site"], ["plugs"]).collect() == []
