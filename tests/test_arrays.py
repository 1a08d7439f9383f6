"""Golden values stated in the reference's array notebook."""
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.functions import arrays


def test_add_and_scale(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5, 6])], "a array<bigint>, b array<bigint>")
    r = df.select(arrays.add("a", "b").alias("s"), arrays.scale("a", 2).alias("m")).first()
    # The stated array results; whole numbers stay whole numbers
    assert r["s"] == [5, 7, 9] and r["m"] == [2, 4, 6]
    assert all(type(x) is int for x in r["s"] + r["m"])
    big = spark.createDataFrame([([9007199254740993], [0])], "a array<bigint>, b array<bigint>")
    assert big.select(arrays.add("a", "b").alias("s")).first()["s"] == [9007199254740993]
    assert df.select(arrays.scale("a", 0.5).alias("h")).first()["h"] == [0.5, 1.0, 1.5]


def test_unequal_lengths_raise(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5])], "a array<bigint>, b array<bigint>")
    with pytest.raises(Exception):
        df.select(arrays.add("a", "b")).collect()
    r = df.select(arrays.add("a", "b", strict=False).alias("s")).first()
    assert r["s"] == [5, 7, None]


def test_index_slice_reverse(spark):
    df = spark.createDataFrame([([0, 1, 2, 3, 4, 5],)], "a array<bigint>")
    r = df.select(arrays.element("a", 0).alias("e"), arrays.slice0("a", 1, 4).alias("s"),
                  arrays.reverse("a").alias("r"), arrays.element("a", 9, strict=False)
                  .alias("g")).first()
    assert (r["e"], r["s"], r["r"], r["g"]) == (0, [1, 2, 3], [5, 4, 3, 2, 1, 0], None)
    with pytest.raises(PySparkException):
        df.select(arrays.element("a", 9)).collect()


def test_shape_of_2x3(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],)], "a array<bigint>")
    m = arrays.reshape("a", 3)
    r = df.select(F.size(m).alias("rows"), F.size(m[0]).alias("cols"),
                  F.typeof(m[0][0]).alias("t"), m.alias("m")).first()
    assert (r["rows"], r["cols"], r["t"]) == (2, 3, "bigint")
    assert r["m"] == [[1, 2, 3], [4, 5, 6]]


def test_constructors(spark):
    r = spark.range(1).select(arrays.zeros(5).alias("z"), arrays.ones(2, 3).alias("o"),
                              arrays.arange(0, 10, 2).alias("a"),
                              arrays.arange(5, 5).alias("e")).first()
    assert r["z"] == [0.0] * 5 and r["o"] == [[1.0] * 3] * 2
    assert r["a"] == [0, 2, 4, 6, 8] and r["e"] == []


def test_square_and_ratio(spark):
    df = spark.range(1, 1_000_000).select(arrays.square("id").alias("sq"))
    assert df.agg(F.max("sq")).first()[0] == 999_999 ** 2
    bmi = spark.createDataFrame([(1.68, 54), (1.78, 71), (1.65, 60)], "h double, w int")
    got = [r[0] for r in bmi.select(F.col("w") / (F.col("h") * F.col("h"))).collect()]
    assert got == [54 / 1.68 ** 2, 71 / 1.78 ** 2, 60 / 1.65 ** 2]


def test_axis_mean(spark):
    df = spark.createDataFrame([([10, 20, 60, 30, 0, 0],)], "a array<int>")
    assert df.select(arrays.axis_mean("a", 3)).first()[0] == [30.0, 10.0]


def test_coin_is_partition_independent(spark):
    a = spark.range(0, 5000, numPartitions=1).select("id", arrays.coin(F.col("id"), 42).alias("c"))
    b = spark.range(0, 5000, numPartitions=7).select("id", arrays.coin(F.col("id"), 42).alias("c"))
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {r["c"]: r["count"] for r in a.groupBy("c").count().collect()}
    assert set(counts) == {0, 1} and sum(counts.values()) == 5000
    assert 2200 < counts[0] < 2800


def test_series_and_table_literals(spark):
    from tessera.sources import literals
    s = literals.series(spark, [10, 20, 30, 40, 50])
    assert [tuple(r) for r in s.orderBy("idx").collect()] == [(0, 10), (1, 20), (2, 30), (3, 40),
                                                              (4, 50)]
    df = literals.from_columns(spark, {"Name": ["Alice", "Bob", "Charlie"], "Age": [25, 30, 28],
                                       "City": ["New York", "London", "Paris"]})
    assert df.columns == ["Name", "Age", "City"] and dict(df.dtypes)["Age"] == "bigint"
    assert df.count() == 3


def test_randint_range_and_reproducible(spark):
    a = spark.range(0, 3000, numPartitions=3).select(arrays.randint(F.col("id"), 5, 9, 1).alias("r"))
    b = spark.range(0, 3000, numPartitions=1).select(arrays.randint(F.col("id"), 5, 9, 1).alias("r"))
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert {r[0] for r in a.collect()} == {5, 6, 7, 8}


def test_empty_and_uneven_arrays(spark):
    df = spark.createDataFrame([([],), ([1.0, 2.0, 3.0, 4.0],), (None,)], "a array<double>")
    got = df.select(arrays.axis_mean("a", 2).alias("m"), arrays.reshape("a", 2).alias("r")).collect()
    assert [list(r) for r in got] == [[[], []], [[1.5, 3.5], [[1.0, 2.0], [3.0, 4.0]]], [None, None]]
    uneven = spark.createDataFrame([([1.0] * 5,)], "a array<double>")
    for f in (arrays.axis_mean, arrays.reshape):
        with pytest.raises(Exception, match="cannot reshape array of size 5 into rows of 4"):
            uneven.select(f("a", 4)).collect()
        with pytest.raises(ValueError):
            f("a", 0)
    empty = spark.range(1).select(arrays.float_grid(0, 2, 100).alias("g"), arrays.float_grid(-1, 2, 100).alias("h")).first()
    assert list(empty) == [[], []]
