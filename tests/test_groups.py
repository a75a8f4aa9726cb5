"""Split ranking must equal plain windows, whatever the skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelmill.operators import groups
from panelmill.operators.groups import with_group_standing


def skewed(spark):
    """Group 'hot' holds a third of the rows, half of them on one value."""
    rows = spark.range(6000).withColumns({
        "g": F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))),
        "v": F.when(F.col("id") % 6 == 0, 0.0)
        .when(F.col("id") % 97 == 0, None)
        .otherwise(F.round(F.sin("id") * 50, 1)),
        "n": (F.col("id") * 7919 % 1013).cast("bigint"),
    })
    return rows


def expected(df):
    w = Window.partitionBy("g")
    return df.withColumns({
        "rv": F.rank().over(w.orderBy(F.desc_nulls_last("v"))).cast("bigint"),
        "rn": F.rank().over(w.orderBy(F.desc_nulls_last("n"))).cast("bigint"),
        "total": F.sum("n").over(w),
    })


@pytest.mark.parametrize("slots", [None, 2, 5, 16, 100, 1000])
def test_split_ranks_are_exact(spark, slots):
    df = skewed(spark)
    got = with_group_standing(df, ["g"], ["id"], {"rv": "v", "rn": "n"}, {"total": "n"}, slots=slots)
    assert got.columns == ["id", "g", "v", "n", "rv", "rn", "total"]
    assert got.count() == 6000
    assert got.exceptAll(expected(df)).isEmpty()


def test_large_input_is_split_without_being_told(spark, monkeypatch):
    df = skewed(spark)
    monkeypatch.setattr(groups, "TASK_BYTES", 0)
    got = with_group_standing(df, ["g"], ["id"], {"rv": "v", "rn": "n"}, {"total": "n"})
    assert "_piece_0" in got._jdf.queryExecution().analyzed().toString()
    assert got.exceptAll(expected(df)).isEmpty() and got.count() == 6000


def test_only_totals(spark):
    df = skewed(spark)
    got = with_group_standing(df, ["g"], ["id"], {}, {"total": "n"}, slots=10)
    assert got.exceptAll(expected(df).drop("rv", "rn")).isEmpty()


@pytest.mark.parametrize("slots", [None, 8])
def test_no_job_before_the_action(spark, slots):
    """The plan is lazy; a small input is evaluated once."""
    df = skewed(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    got = with_group_standing(df, ["g"], ["id"], {"rv": "v", "rn": "n"}, {"total": "n"}, slots=slots)
    assert len(tracker.getJobIdsForGroup()) == before
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert slots or plan.count("Range") == 1
    assert got.exceptAll(expected(df)).isEmpty()


@pytest.mark.parametrize("keys", [["g"], ["g", "h"]])
def test_null_group_is_ranked_too(spark, keys):
    df = skewed(spark).withColumns({"g": F.when(F.col("g") != "hot", F.col("g")), "h": F.lit(None).cast("date")})
    got = with_group_standing(df, keys, ["id"], {"rv": "v", "rn": "n"}, {"total": "n"}, slots=50)
    assert got.count() == 6000
    assert got.exceptAll(expected(df)).isEmpty()


def test_sized_by_and_small_groups_only(spark):
    df = spark.range(3000).select("id", (F.col("id") % 1000).cast("string").alias("g"), F.sin("id").alias("v"), F.col("id").alias("n"))
    got = with_group_standing(df, ["g"], ["id"], {"rv": "v", "rn": "n"}, {"total": "n"}, sized_by=df.select("g"), slots=20)
    assert got.exceptAll(expected(df)).isEmpty() and got.count() == 3000


@pytest.mark.parametrize("value", [
    "sin(id)",                              # all different
    "if(id % 3 = 0, 0.0D, sin(id))",        # a third on one value
    "if(id % 3 = 0, null, sin(id))",        # a third null
    "cast(id % 4 as double)",               # four values
    "exp(-id / 500.0)",                     # far apart and very close
    "cast(null as double)",                 # nothing but nulls
])
def test_no_task_gets_a_large_share(spark, value):
    n, slots = 40_000, 20
    df = spark.range(n).select("id", F.lit("one").alias("g"), F.expr(value).alias("v"))
    placed = groups._placed(df, ["g"], ["id"], {"r": "v"}, None, slots)
    pieces = placed.groupBy("_slot_0", "_piece_0").agg(
        F.count("*").alias("n"), F.count_distinct("v").alias("values"))
    assert pieces.agg(F.sum("n")).first()[0] == n
    assert pieces.agg(F.max("n")).first()[0] <= 1.5 * n / slots
    got = with_group_standing(df, ["g"], ["id"], {"r": "v"}, slots=slots)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))).cast("bigint"))
    assert got.exceptAll(want).isEmpty()


def test_one_exchange_for_each_rank(spark):
    """Counts meet the ranked rows by their piece: the rows of the main branch move once for each rank."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = with_group_standing(skewed(spark), ["g"], ["id"], {"rv": "v", "rn": "n"}, {"total": "n"}, slots=8)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    main, last = [], None
    for line in plan.splitlines():  # the leftmost branch only
        if last is not None and depth(line) < last:
            break
        last = depth(line)
        main.append(line)
    assert sum("Exchange hashpartitioning" in x for x in main) == 2, plan


def test_nothing_is_shuffled_for_large_groups_that_do_not_exist(spark, tmp_path):
    """One branch holds the small groups; in all others a filter lies below the window along a series."""
    path = str(tmp_path / "rows")
    spark.range(3000).select(
        (F.col("id") % 30).alias("e"), (F.col("id") % 100).cast("string").alias("g"),
        F.floor(F.col("id") / 30).alias("d"), F.sin("id").alias("v"), F.col("id").alias("n"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    df = rows.withColumn("u", F.col("v") - F.coalesce(F.lag("v").over(Window.partitionBy("e").orderBy("d")), F.lit(0.0)))
    got = with_group_standing(df, ["g"], ["e"], {"rv": "u", "rn": "n"}, {"total": "n"}, sized_by=rows, slots=20)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    free = guarded = 0
    for i, line in enumerate(lines):
        if "Window [lag(" in line:
            below = []
            for x in lines[i + 1:]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            if any("Filter" in x and "pmod(xxhash64(" in x for x in below):
                guarded += 1
            else:
                free += 1
    assert (free, guarded > 0) == (1, True)
    want = expected(df.withColumn("x", F.col("v")).withColumn("v", F.col("u"))).withColumn("v", F.col("x")).drop("x")
    assert got.exceptAll(want).isEmpty() and got.count() == 3000
