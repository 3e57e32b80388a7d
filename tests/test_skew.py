import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import same_rows

from tidemark.operators import skew

KEYS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows over many stretches; times tie, times and values may be null."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        a = "hot" if i % 3 == 0 else rng.choice(["x", "y", f"k{i}"])
        t = rng.choice([None, *range(0, 40 * skew.STRETCH_MS, skew.STRETCH_MS // 3)])
        data.append((a, 1, t, i, rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(data, "a string, b int, t long, id int, v int").cache()


def order():
    return [F.col("t"), F.col("id")]


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("value", ["struct(id, v)", "v"])
def test_neighbours_are_those_of_a_plain_window(spark, rows, step, value):
    shift, value = (F.lead if step > 0 else F.lag), F.expr(value)
    want = rows.withColumn("n", shift(value).over(Window.partitionBy(*KEYS).orderBy(*order())))
    got = skew.with_neighbour(rows, KEYS, order(), "n", value, step, F.col("t"))
    assert got.columns == want.columns
    same_rows(got, want)


def test_running_sums_are_those_of_a_plain_window(spark, rows):
    sums = {"n": F.lit(1).cast("bigint"), "s": F.col("v").cast("decimal(18,0)")}
    before = Window.partitionBy(*KEYS).orderBy(*order()).rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumns({k: F.coalesce(F.sum(c).over(before), F.lit(0)) for k, c in sums.items()})
    got = skew.with_running_before(rows, KEYS, order(), sums, F.col("t"))
    same_rows(got.select(want.columns), want)


def test_a_window_holds_one_stretch_of_a_key(spark, rows):
    plan = skew.with_neighbour(rows, KEYS, order(), "n", F.col("v"), 1, F.col("t"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" in text and "_stretch" in text.split("hashpartitioning(a")[1][:80]
    stretches = skew._cut(rows.where("a = 'hot'"), F.col("t")).groupBy("_stretch").count()
    assert stretches.agg(F.max("count")).first()[0] < rows.where("a = 'hot'").count() / 5


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_key_filters_are_the_plain_joins(spark, rows, how):
    lookup = rows.where("a not like '%7'").select("a").distinct().withColumn("w", F.length("a"))
    facts = rows.select("a", "id").unionByName(spark.createDataFrame([(None, -1)], "a string, id int"))
    got = skew.filter_by_keys(facts, lookup, "a", how, ["id"])
    same_rows(got, facts.join(lookup, "a", how))


def test_other_join_kinds_are_refused(spark, rows):
    with pytest.raises(ValueError):
        skew.filter_by_keys(rows, rows, "a", "inner", ["id"])


@pytest.mark.parametrize("step", [1, -1])
def test_neighbours_read_their_input_once_and_join_nothing(spark, rows, step):
    plan = skew.with_neighbour(rows, KEYS, order(), "n", F.col("v"), step, F.col("t"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("InMemoryTableScan") == 1
    assert text.count("Exchange hashpartitioning") == 2
    counted = plan.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in counted and "hashpartitioning" not in counted
