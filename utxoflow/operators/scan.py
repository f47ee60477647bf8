"""Skew-safe ordered scans (running sums / running maxima / lags).

A window ``partitionBy(key).orderBy(...)`` puts every row of a key in one
task.  With one address holding a third of all rows that task is the whole
job.  The scans here are two level:

1. ``with_buckets`` counts rows per key (one partial aggregation).  Rows of keys
   with at least ``hot_key_rows`` rows are range-partitioned by (key, order) into
   pieces of about ``rows_per_bucket`` rows and written to the shared folder
   with their piece as the bucket.  Spark's range partitioner cuts at sampled
   quantiles of the whole order, so pieces hold equal numbers of rows however
   the order's values are spread (bursts, dust), and no number of keys is too
   large.  There are at most four pieces per shuffle partition (or ``MIN_PIECES``):
   every piece is a task and a file, and its sampled rows and result pass the
   driver, so smaller ones cost more than they spread.  All other keys keep a single
   bucket.
2. The running aggregate is computed inside ``(key, bucket)``; bucket totals
   of hot keys only are prefix-scanned (a window per key over its buckets) and
   joined back (AQE broadcasts that side at runtime when it is small).  With
   no hot key the plan is a single window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utxoflow.options import DEFAULT, LedgerOptions
from utxoflow.session import staged

BUCKET = "_bkt"
MIN_PIECES = 64


def hot_keys(df: DataFrame, by: str, opts: LedgerOptions = DEFAULT) -> DataFrame | None:
    """Keys with at least ``hot_key_rows`` rows and their counts, as a written
    table; None when there is none.  One aggregation job."""
    hot = staged(df.groupBy(F.col(by).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
                   .filter(F.col("_n") >= F.lit(opts.hot_key_rows)), "hot-keys")
    return None if hot.isEmpty() else hot


def with_buckets(df: DataFrame, by: str, order: list[str], opts: LedgerOptions = DEFAULT,
                 hot: DataFrame | None = None, known: bool = False) -> tuple[DataFrame, bool]:
    """Add ``_bkt`` (0 for ordinary keys, the piece of a hot key's rows, from 1)
    and ``_hot``; returns the frame and whether any key is hot.  ``hot`` is the
    result of ``hot_keys`` when it is ``known`` already."""
    hot = hot if known else hot_keys(df, by, opts)
    if hot is None:
        return df.withColumn("_hot", F.lit(False)).withColumn(BUCKET, F.lit(0)), False
    wanted = -(-int(hot.agg(F.sum("_n")).first()[0]) // opts.rows_per_bucket)
    pieces = min(wanted, max(MIN_PIECES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    match = F.col(by).eqNullSafe(F.col("_key"))
    rows = df.join(hot, match, "left_semi").repartitionByRange(max(1, pieces), by, *order)
    rows = staged(rows.withColumn("_hot", F.lit(True)).withColumn(BUCKET, F.spark_partition_id() + 1), "hot-rows")
    rest = df.join(hot, match, "left_anti").withColumn("_hot", F.lit(False)).withColumn(BUCKET, F.lit(0))
    return rest.unionByName(rows), True


def prefix_scan(df: DataFrame, by: str, order: list[str | Column], hot: bool,
                sums: dict[str, Column] | None = None, maxes: dict[str, Column] | None = None,
                exclusive: bool = False) -> DataFrame:
    """Running ``sum``/``max`` per ``by`` in ``order`` over a bucketed frame.

    ``df`` must carry ``_bkt`` (see ``with_buckets``).  Ordinary keys have a
    single bucket, so only hot keys need the bucket-total prefix; with no hot
    key the plan is one window.  With ``exclusive`` the current row is left
    out (a lag, for a max of a struct whose first field is the order)."""
    sums = sums or {}
    maxes = maxes or {}
    end = -1 if exclusive else Window.currentRow
    frame = Window.partitionBy(by, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    # Explicit: an input already hash-partitioned by the key alone would
    # satisfy the window's clustering and keep a hot key in one task.
    out = df.repartition(by, BUCKET) if hot else df
    for name, expr in sums.items():
        out = out.withColumn(f"_l_{name}", F.sum(expr).over(frame))
    for name, expr in maxes.items():
        out = out.withColumn(f"_l_{name}", F.max(expr).over(frame))

    if hot:
        # Bucket totals of hot keys only, prefix-scanned per key over its
        # buckets -- one row per piece and key.
        aggs = [F.sum(e).alias(f"_t_{n}") for n, e in sums.items()] + \
               [F.max(e).alias(f"_t_{n}") for n, e in maxes.items()]
        totals = df.filter(F.col(BUCKET) > 0).groupBy(by, BUCKET).agg(*aggs)
        before = Window.partitionBy(by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        prefix = totals.select(
            F.col(by).alias("_pk"), F.col(BUCKET).alias("_pb"),
            *[F.sum(f"_t_{n}").over(before).alias(f"_p_{n}") for n in sums],
            *[F.max(f"_t_{n}").over(before).alias(f"_p_{n}") for n in maxes],
        )
        out = out.join(prefix, F.col(by).eqNullSafe(F.col("_pk")) & (F.col(BUCKET) == F.col("_pb")), "left").drop("_pk", "_pb")
    else:
        for n in [*sums, *maxes]:
            out = out.withColumn(f"_p_{n}", F.lit(None))
    for name, expr in sums.items():
        # Back to the input type before adding: sum() widens decimals, and two
        # widened decimals added together would lose scale.
        dtype = df.select(expr.alias("x")).schema["x"].dataType
        zero = F.lit(0).cast(dtype)
        out = out.withColumn(name, (F.coalesce(F.col(f"_p_{name}").cast(dtype), zero)
                                    + F.coalesce(F.col(f"_l_{name}").cast(dtype), zero)).cast(dtype))
    for name in maxes:
        out = out.withColumn(name, F.coalesce(F.greatest(F.col(f"_p_{name}"), F.col(f"_l_{name}")),
                                              F.col(f"_l_{name}")))
    drop = [f"_{p}_{n}" for p in ("l", "p") for n in [*sums, *maxes]]
    return out.drop(*drop)


def global_prefix_max(df: DataFrame, value: str, order: list[str], name: str,
                      partitions: int, exclusive: bool = True) -> DataFrame:
    """Running max of ``value`` over the *whole* frame in ``order``.

    An unpartitioned window would move everything to one task.  Instead ``order``
    and ``value`` alone are range-partitioned by the order into ``partitions``
    pieces of equal size (bursts on one leading value are cut by the columns after
    it) and written with their piece; the running max is taken inside each
    piece, the piece maxima (one row per piece) are prefix-scanned, and the
    result is joined to the rows by their place in the order.  Whole rows are
    dealt once and written never.  Rows at one place get what the first got."""
    pieces = df.select(*order, value).repartitionByRange(int(partitions), *order)
    ranged = staged(pieces.withColumn("_rp", F.spark_partition_id()), "arrival")
    within = Window.partitionBy("_rp").orderBy(*order)
    place = F.struct(*order)
    local = ranged.withColumns({
        "_lmax": F.max(value).over(within.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)),
        "_again": F.lag(place).over(within).eqNullSafe(place)})
    per_range = ranged.groupBy("_rp").agg(F.max(value).alias("_rmax"))
    before = Window.orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    prefix = per_range.select("_rp", F.max("_rmax").over(before).alias("_pmax"))
    first = local.filter(~F.col("_again")).join(F.broadcast(prefix), on="_rp", how="left")  # at most ``partitions`` rows
    found = first.select(*[F.col(c).alias(f"_o_{c}") for c in order], F.greatest("_pmax", "_lmax").alias(name))
    same = F.lit(True)
    for c in order:
        same = same & df[c].eqNullSafe(found[f"_o_{c}"])
    return df.join(found, same, "left").drop(*[f"_o_{c}" for c in order])
