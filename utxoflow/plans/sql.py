"""The dashboard panels as Spark SQL over views of the analytic tables, for
users who run the panels' SQL today.  ``now64()`` becomes the ``as_of``
parameter (default: the table's latest ``timestamp_ms``); ``argMax`` becomes
``max_by`` with the arrival order as tie-breaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("transactions", "alerts", "balance_updates", "metrics")

_AS_OF = "coalesce({as_of}, (SELECT max(timestamp_ms) FROM {table}))"

PANELS = {
    "tps": """
        SELECT count(*) / 60.0D AS tps FROM transactions
        WHERE timestamp_ms >= {as_of_tx} - 60000""",
    "alerts_last_hour": """
        SELECT count(*) AS alerts_last_hour FROM alerts
        WHERE timestamp_ms >= {as_of_alerts} - 3600000""",
    "transaction_volume": """
        SELECT timestamp_ms - pmod(timestamp_ms, 60000) AS minute, count(*) AS txs FROM transactions
        WHERE timestamp_ms >= {as_of_tx} - 3600000
        GROUP BY 1 ORDER BY minute""",
    "top_addresses": """
        SELECT address, max_by(balance, struct(timestamp_ms, arrival_ms, seq, tx_id, pos)) AS balance
        FROM balance_updates GROUP BY address ORDER BY balance DESC, address LIMIT 10""",
    "balance_distribution": """
        SELECT bucket, addresses FROM (
          SELECT address, floor(max_by(balance, struct(timestamp_ms, arrival_ms, seq, tx_id, pos))) AS bucket,
                 count(*) AS addresses
          FROM balance_updates GROUP BY address)
        WHERE bucket >= 0 ORDER BY bucket, address LIMIT 30""",
    "alert_rates": """
        SELECT timestamp_ms - pmod(timestamp_ms, 60000) AS minute, alert_type, count(*) AS total FROM alerts
        WHERE timestamp_ms >= {as_of_alerts} - 3600000
        GROUP BY 1, 2 ORDER BY minute, alert_type""",
}


def register_tables(spark: SparkSession, paths: dict[str, str]) -> None:
    """Temp views ``transactions``, ``alerts``, ``balance_updates``, ``metrics``."""
    for name in TABLES:
        if name in paths:
            spark.read.parquet(paths[name]).createOrReplaceTempView(name)


def panel(spark: SparkSession, name: str, as_of_ms: int | None = None) -> DataFrame:
    lit = "CAST(NULL AS BIGINT)" if as_of_ms is None else str(int(as_of_ms))
    sql = PANELS[name].format(as_of_tx=_AS_OF.format(as_of=lit, table="transactions"),
                              as_of_alerts=_AS_OF.format(as_of=lit, table="alerts"))
    return spark.sql(sql)
