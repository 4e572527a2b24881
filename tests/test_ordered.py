"""Hot-group paths against plain windows and hand-made orders."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from stintwise.operators.assembly import asof_join
from stintwise.operators.hot import join_back
from stintwise.operators.ordered import in_chunks, in_ranges, neighbours, rank_within, running

KEYS = ["season", "race_name", "driver"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def close(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, nan_ok=True), (x, y)


@pytest.fixture(scope="module")
def skewed(spark):
    """One driver holds most rows, with gaps, repeats, exact copies and null laps."""
    base = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("D"), (F.col("id") % 7).cast("string"))).otherwise("HOT").alias("driver"),
        F.when(F.col("id") % 61 != 0, (F.col("id") * 7919 % 1009).cast("double")).alias("lap"),
        (F.col("id") * 31 % 101).cast("double").alias("position"),
    )
    copies = spark.range(200).select(F.lit("HOT").alias("driver"), F.lit(500.0).alias("lap"), F.lit(3.0).alias("position"))
    nobody = spark.range(150).select(F.lit(None).cast("string").alias("driver"), F.col("id").cast("double").alias("lap"), (F.col("id") % 5).cast("double").alias("position"))
    return base.unionByName(copies).unionByName(nobody)


COLUMNS = {
    "before": lambda w: F.lag("position", 1).over(w),
    "later": lambda w: F.lead("position", 10).over(w),
    "mean": lambda w: F.avg("position").over(w.rowsBetween(-4, 0)),
}


@pytest.mark.parametrize("nulls_last", [False, True])
@pytest.mark.parametrize("chunk_rows", [3, 40, 10_000])
def test_neighbours_in_chunks_equal_one_window(skewed, chunk_rows, nulls_last):
    options = dict(back=4, ahead=10, nulls_last=nulls_last)
    plain = neighbours(skewed, ["driver"], ["lap"], COLUMNS, **options)
    split = neighbours(skewed, ["driver"], ["lap"], COLUMNS, hot_rows=100, chunk_rows=chunk_rows, **options)
    assert "__chunk" in split._jdf.queryExecution().toString()
    close(plain, split)


@pytest.mark.parametrize("nulls_last", [False, True])
@pytest.mark.parametrize("odd", [1e12, 0.001, float("nan"), float("inf"), float("-inf"), None])
def test_neighbours_with_odd_order_values(spark, odd, nulls_last):
    """An outlier, small steps, NaN, infinities and nulls: as one window, and cut into chunks of alike many rows."""
    step = odd if odd == 0.001 else 1.0
    values = [(i * step, float(i)) for i in range(300)] + [(odd, -1.0), (odd, -2.0)]
    df = spark.createDataFrame([("g", *v) for v in values], "driver string, lap double, position double")
    columns = {"before": COLUMNS["before"], "after": lambda w: F.lead("position", 1).over(w)}
    plain = neighbours(df, ["driver"], ["lap"], columns, 1, 1, nulls_last=nulls_last)
    split = neighbours(df, ["driver"], ["lap"], columns, 1, 1, nulls_last=nulls_last, hot_rows=100, chunk_rows=50)
    close(plain, split)


@pytest.mark.parametrize("chunk_rows", [30, 1000])
def test_chunks_are_of_one_size_however_rows_lie(spark, chunk_rows):
    """Even values, few values and equal rows: chunks are full, and hold at most the rows in reach besides."""
    n, back, ahead = 20_000, 4, 10
    for value in (F.col("id"), F.col("id") % 7, F.lit(1)):
        df = spark.range(n).select(F.lit("g").alias("k"), value.alias("v"))
        placed = in_ranges(df, ["k"], [F.asc("v")], n, 1000)
        parts = [r["count"] for r in placed.groupBy("__part").count().collect()]
        assert sum(parts) == n and max(parts) < 3000
        chunks = in_chunks(placed, ["k"], back, ahead, chunk_rows).groupBy("__chunk").agg(F.count_if("__own").alias("own"), F.count("*").alias("rows")).collect()
        assert len(chunks) == -(-n // chunk_rows) and sorted(c.own for c in chunks)[1:] == [chunk_rows] * (len(chunks) - 1)
        assert max(c.rows for c in chunks) <= chunk_rows + back + ahead


def test_neighbours_keep_the_plan_of_ordinary_data_small(skewed):
    plan = neighbours(skewed, ["driver"], ["lap"], COLUMNS, 4, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("hot_rows", [3, 300, 1_000_000])
def test_running_equals_windows(spark, hot_rows):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        (F.col("user_id") % 2).alias("k"), "ts", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("v")
    )
    got = running(
        events, ["k"], ["ts", "event_id"],
        position="nth", totals={"total": F.col("v")}, previous={"prev": F.col("v")}, latest={"known": F.col("v")},
        hot_rows=hot_rows, per_range=70,
    )
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    expected = events.select(
        "*", F.row_number().over(w).cast("long").alias("nth"), F.sum("v").over(upto).alias("total"),
        F.lag("v").over(w).alias("prev"), F.last("v", ignorenulls=True).over(upto).alias("known"),
    )
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("dense", [False, True])
def test_rank_of_hot_group_equals_window(skewed, descending, dense):
    split = rank_within(skewed, ["driver"], "lap", "r", descending, dense, hot_rows=50)
    order = F.desc_nulls_last("lap") if descending else F.asc_nulls_first("lap")
    w = Window.partitionBy("driver").orderBy(order)
    plain = skewed.withColumn("r", (F.dense_rank() if dense else F.rank()).over(w))
    assert rows(split) == rows(plain)


def test_asof_edges(spark):
    left = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00"), (1, "2024-01-01 09:59:59.999999"), (1, "2024-01-03 00:00:00"), (2, "2024-01-01 10:00:00"), (None, "2024-01-01 10:00:00"), (1, None)],
        "k int, t string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    right = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", "a", None), (1, "2024-01-01 10:05:00", "b", 2), (None, "2024-01-01 09:00:00", "n", 1)],
        "k int, s string, name string, extra int",
    ).withColumn("s", F.col("s").cast("timestamp_ntz"))
    for hot in (1, 1_000_000):
        got = asof_join(left, right, ["k"], "t", "s", ["name", "extra"], hot_rows=hot)
        found = sorted(((r.k, str(r.t), r.name, r.extra) for r in got.collect()), key=repr)
        assert found == sorted(
            [
                (1, "2024-01-01 10:00:00", "a", None), (1, "2024-01-01 10:00:00", "a", None),
                (1, "2024-01-01 09:59:59.999999", None, None), (1, "2024-01-03 00:00:00", "b", 2),
                (2, "2024-01-01 10:00:00", None, None), (None, "2024-01-01 10:00:00", None, None), (1, "None", None, None),
            ],
            key=repr,
        )


def test_join_back_splits_a_skewed_group(spark):
    """AQE divides the hot key of the row side between tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.col("id") % 500).otherwise(7).alias("k"), "id")
        joined = join_back(many, many.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"])
        assert len(joined.toArrow()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["long", "double"])
def test_hot_ranks_keep_the_values_own_type(spark, kind, descending):
    """Longs beyond 2^53, NaN and infinities rank alike in the plain and in the hot path."""
    if kind == "long":
        values = [2**53, 2**53 + 1, 2**53 + 2, -(2**63), 2**63 - 1, None, 5, 5]
    else:
        values = [float("nan"), float("inf"), float("-inf"), None, 1.5, 1.5, -2.0, float("nan")]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", v) for v in values[:2]], f"g string, v {kind}")
    rows = [
        sorted((repr(r.g), repr(r.v), r.r) for r in rank_within(df, ["g"], "v", "r", descending=descending, hot_rows=n).collect())
        for n in (3, 1_000_000)
    ]
    assert rows[0] == rows[1]
