import random

from authweave.operators.ids import number_rows, running_total


def test_numbers_follow_the_order(spark):
    random.seed(3)
    rows = [(random.randrange(50), random.choice("abc")) for _ in range(5_000)]
    table = spark.createDataFrame(rows, "k int, v string").repartition(7)
    numbered = number_rows(table, ["k", "v"], "id", 1).orderBy("id").collect()
    assert [row.id for row in numbered] == list(range(1, 5_001))
    assert [(row.k, row.v) for row in numbered] == sorted(rows)


def test_a_run_of_equal_keys_is_cut(spark):
    table = spark.range(20_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(table, ["k"], "id", 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_partition = numbered.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(per_partition) == 20_000 and max(per_partition) < 6_000
    ids = sorted(row.id for row in numbered.collect())
    assert ids == list(range(20_000))


def test_numbers_survive_union_filter_and_join(spark):
    table = number_rows(spark.range(1_000).toDF("k"), ["k"], "id", 0)
    other = spark.range(5).selectExpr("id AS id", "id AS k")
    both = other.unionAll(table).filter("id = k")
    assert both.count() == 1_005
    assert table.join(table.withColumnRenamed("k", "j"), "id").filter("j = k AND id = k").count() == 1_000


def test_empty_table(spark):
    empty = spark.range(0).toDF("k")
    assert number_rows(empty, ["k"], "id", 1).count() == 0
    assert running_total(empty, ["k"], "k", "sum").count() == 0


def test_running_total(spark):
    random.seed(4)
    values = {k: random.randrange(100) for k in range(3_000)}
    table = spark.createDataFrame(list(values.items()), "k int, v long").repartition(5)
    expected, total = {}, 0
    for k in sorted(values):
        total += values[k]
        expected[k] = total
    rows = running_total(table, ["k"], "v", "sum").collect()
    assert {row.k: row["sum"] for row in rows} == expected
