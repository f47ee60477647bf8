"""Column helpers: zone-free epoch ms, money rounding, exact sums."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from utxoflow.functions import array_sum, epoch_ms, money, ms_to_minute


def test_epoch_ms_ignores_session_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append(df.select(epoch_ms("ts")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1704067207179] * 3  # floor, not round


def test_money_half_even_and_exact_sums(spark):
    df = spark.createDataFrame([(0.123456785, 0.123456775, 1.5)], "a double, b double, c double")
    r = df.select(money("a").alias("a"), money("b").alias("b"), money("c").alias("c")).first()
    assert (r.a, r.b, r.c) == (Decimal("0.12345678"), Decimal("0.12345678"), Decimal("1.50000000"))
    arr = spark.sql("SELECT array(named_struct('value', CAST(39.99999999 AS DECIMAL(18,8))),"
                    " named_struct('value', CAST(0.00000001 AS DECIMAL(18,8)))) AS xs, "
                    "CAST(array() AS array<struct<value:decimal(18,8)>>) AS e")
    s = arr.select(array_sum("xs").alias("s"), array_sum("e").alias("z")).first()
    assert s.s == Decimal("40.00000000") and s.z == Decimal("0")


def test_minute_buckets(spark):
    df = spark.createDataFrame([(1704067207179,), (60000,), (59999,)], "t long")
    assert [r.m for r in df.select(ms_to_minute("t").alias("m")).collect()] == [1704067200000, 60000, 0]
    assert df.select(F.max(ms_to_minute("t"))).first()[0] % 60000 == 0


def test_scale_conf_sizes_partitions():
    from utxoflow.session import scale_conf

    conf = scale_conf(100 * 2**40, executors_cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 << 20))
    assert conf["spark.sql.adaptive.enabled"] == "true"
    small = scale_conf(10 << 20, executors_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # at least two waves of tasks
