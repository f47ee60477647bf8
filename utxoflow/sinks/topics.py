"""Exactly-once topics (K2, K3) over an at-least-once publisher.

Spark publishes a micro-batch again when the run dies before the batch is
committed, so a topic holds records of deliveries that were given up.  Two means
tell them apart:

* every record carries an ``occurrence`` id, which is the same however often it is
  delivered: alerts ``alert_id:seq:pos`` (an alert id alone is not unique, the
  offset and the place of the update are), transaction metrics ``tx_id:seq``,
  balances ``address:tx_id:seq:pos``;
* every record names its ``origin``, the delivery it belongs to: query, batch and a
  delivery number of its own.  A ``TopicLog`` holds, per query, topic and batch, the
  one delivery that counts, put in place at once after its records were
  published.  A batch that is logged is not published again.

``committed`` drops the records of all other deliveries.  A consumer without
the log drops repeated occurrence ids (``first_occurrences``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.sinks.versions import VersionTaken, file_names, write_once

#: ``publish(topic, records, batch_id)`` writes the records of a batch to a topic.
Publish = Callable[[str, DataFrame, "int | None"], None]

ORIGIN = "query string, batch_id bigint, delivery string"


def occurrence(*parts: str):
    """Id of a record by the columns that make it one of a kind."""
    return F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]).alias("occurrence")


class TopicLog:
    """The deliveries that count, as small files ``path/query/topic/batch.json``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def is_committed(self, query: str, topic: str, batch_id: int) -> bool:
        return f"{int(batch_id)}.json" in file_names(self.spark, f"{self.path}/{query}/{topic}")

    def exactly_once(self, query: str, publish: Publish) -> Publish:
        """``publish`` with origins, logged; a batch that is logged is skipped."""
        def deliver(topic: str, records: DataFrame, batch_id: int | None) -> None:
            if batch_id is None:  # a batch run has no replay of its own: consumers go by the occurrence
                publish(topic, records, None)
                return
            if self.is_committed(query, topic, batch_id):
                return
            delivery = uuid.uuid4().hex
            origin = F.struct(F.lit(query).alias("query"), F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(delivery).alias("delivery"))
            publish(topic, records.withColumn("origin", origin), batch_id)
            said = {"query": query, "topic": topic, "batch_id": int(batch_id), "delivery": delivery}
            try:
                write_once(self.spark, f"{self.path}/{query}/{topic}/{int(batch_id)}.json", json.dumps(said))
            except VersionTaken:  # a run that was thought dead got there first: its delivery counts
                pass
        return deliver

    def read(self, topic: str) -> DataFrame:
        """query, batch_id and delivery of every batch that counts."""
        return (self.spark.read.schema("topic string, " + ORIGIN).json(f"{self.path}/*/{topic}/*.json")
                .filter(F.col("topic") == topic).drop("topic"))

    def committed(self, topic: str, records: DataFrame) -> DataFrame:
        """The records (with ``origin``) of the deliveries that count, each once.
        The log has a row per batch; Spark broadcasts it while it is small."""
        log = self.read(topic).select(*[F.col(c).alias(f"_{c}") for c in ("query", "batch_id", "delivery")])
        same = [F.col(f"origin.{c}") == F.col(f"_{c}") for c in ("query", "batch_id", "delivery")]
        return records.join(log, same[0] & same[1] & same[2], "left_semi")


def first_occurrences(records: DataFrame) -> DataFrame:
    """Each occurrence once, for consumers without the log."""
    return records.dropDuplicates(["occurrence"])


def kafka_record(records: DataFrame) -> DataFrame:
    """Key, value and headers as the Kafka sink takes them."""
    names = [c for c in ("occurrence", "origin") if c in records.columns]
    text = {"occurrence": F.col("occurrence"), "origin": F.to_json("origin") if "origin" in names else None}
    headers = [F.struct(F.lit(n).alias("key"), F.encode(text[n], "UTF-8").alias("value")) for n in names]
    return records.select("key", "value", *([F.array(*headers).alias("headers")] if headers else []))
