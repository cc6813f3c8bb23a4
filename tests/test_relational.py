import pytest
from pyspark.sql import functions as F

from fieldtally import operators as op


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "A", "x,y", 1000.0), (2, "B", "s", 1000.01), (3, "C", "t", 5000.0), (4, "D", "u", 9000.0), (5, "E", "v", 10.0)],
        "custkey LONG, name STRING, address STRING, acctbal DOUBLE",
    )


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10.0, "1995-01-02"), (2, 10.0, "1995-01-01"), (2, 30.0, "1995-01-02"),
            (3, 50.0, "1994-12-31"), (5, 70.0, "1996-01-01"), (9, 90.0, "1996-01-01"),
        ],
        "custkey LONG, price DOUBLE, orderdate STRING",
    ).withColumn("orderdate", F.to_date("orderdate"))


STRICT = [(2, "B", "s", 30.0)]
INCLUSIVE = [(1, "A", "x,y", 10.0), (2, "B", "s", 20.0)]


def sides(customers, orders, inclusive):
    return (
        op.filter_above(customers, "acctbal", 1000, inclusive),
        op.filter_since(orders, "orderdate", "1995-01-01", inclusive),
    )


@pytest.mark.parametrize(("inclusive", "expected"), [(False, STRICT), (True, INCLUSIVE)])
@pytest.mark.parametrize("unique", [False, True])
def test_average_per_entity(customers, orders, rows, inclusive, expected, unique):
    who, what = sides(customers, orders, inclusive)
    mean = op.avg_per_entity(
        who, what, "custkey", "custkey", F.col("price"), ["name", "address"], unique_entities=unique
    )
    assert rows(mean) == expected


@pytest.mark.parametrize(("inclusive", "expected"), [(False, STRICT), (True, INCLUSIVE)])
def test_tagged_average(customers, orders, rows, inclusive, expected):
    who, what = sides(customers, orders, inclusive)
    assert rows(op.tagged_avg(who, what, "custkey", "custkey", F.col("price"), ["name", "address"])) == expected


def test_repeated_customer_gives_one_row(spark, customers, orders, rows):
    again = customers.unionByName(
        spark.createDataFrame([(2, "B2", "s2", 2000.0)], "custkey LONG, name STRING, address STRING, acctbal DOUBLE")
    )
    who, what = sides(again, orders, True)
    expected = [(1, "A", "x,y", 10.0), (2, "B2", "s2", 20.0)]
    assert rows(op.avg_per_entity(who, what, "custkey", "custkey", F.col("price"), ["name", "address"])) == expected
    assert rows(op.tagged_avg(who, what, "custkey", "custkey", F.col("price"), ["name", "address"])) == expected


def test_null_keys_never_match(spark, customers, orders, rows):
    nobody = spark.createDataFrame([(None, "N", "n", 5000.0)], customers.schema)
    stray = spark.createDataFrame([(None, 5.0)], "custkey LONG, price DOUBLE").withColumn("orderdate", F.to_date(F.lit("1996-01-01")))
    who, what = sides(customers.unionByName(nobody), orders.unionByName(stray), True)
    assert rows(op.avg_per_entity(who, what, "custkey", "custkey", F.col("price"), ["name", "address"])) == INCLUSIVE
    assert rows(op.tagged_avg(who, what, "custkey", "custkey", F.col("price"), ["name", "address"])) == INCLUSIVE
    without = op.entities_without(customers.unionByName(nobody), orders.unionByName(stray), "custkey", "custkey", ["name"])
    assert rows(without) == [(4, "D"), (None, "N")]


def test_sum_and_count(orders, rows):
    assert rows(op.sum_and_count(orders, "custkey", F.col("price"))) == [
        (1, 10.0, 1), (2, 40.0, 2), (3, 50.0, 1), (5, 70.0, 1), (9, 90.0, 1),
    ]


def test_joined_rows(customers, orders, rows):
    who, what = sides(customers, orders, True)
    joined = op.facts_with_entities(what, who, "custkey", "custkey")
    assert rows(joined, "name", "price") == [("A", 10.0), ("B", 10.0), ("B", 30.0)]


@pytest.mark.parametrize("unique", [False, True])
def test_customers_without_orders(customers, orders, rows, unique):
    assert rows(op.entities_without(customers, orders, "custkey", "custkey", ["name"], unique)) == [(4, "D")]


def test_existence_flags(customers, orders, rows):
    assert rows(op.existence_flags(customers, orders, "custkey", "custkey")) == [
        (1, True), (2, True), (3, True), (4, False), (5, True),
    ]


def test_hot_key_is_combined_before_the_shuffle(spark):
    facts = spark.range(3000).select((F.when(F.col("id") < 1000, 7).otherwise(F.col("id"))).alias("custkey"), F.lit(2.0).alias("price"))
    who = spark.range(3000).select(F.col("id").alias("custkey"), F.lit("n").alias("name"))
    for mean in (
        op.avg_per_entity(who, facts, "custkey", "custkey", F.col("price"), ["name"], unique_entities=True),
        op.tagged_avg(who, facts, "custkey", "custkey", F.col("price"), ["name"]),
    ):
        assert mean.agg(F.count(F.lit(1)), F.min("avg_value"), F.max("avg_value")).first()[:] == (2001, 2.0, 2.0)
        plan = mean._jdf.queryExecution().executedPlan().toString()
        shuffle = plan.index("Exchange hashpartitioning(custkey")
        assert "partial_sum" in plan[shuffle:]
