"""``python -m utxoflow batch|stream|compact`` -- run the pipeline on a source.

  batch  --source parquet|json|kafka --path P --out OUT
  stream --source parquet|json|kafka --path P --out OUT --checkpoint CK [--initial-state S]
  compact --out OUT   (merge the micro-batch folders of a stream's tables)
Kafka takes --servers and --topic instead of --path.  Options of
``LedgerOptions`` are passed as --late-tolerance-ms 30000 etc.
"""

from __future__ import annotations

import argparse
import dataclasses

from utxoflow.options import DEFAULT


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="utxoflow")
    ap.add_argument("mode", choices=["batch", "stream", "compact"])
    ap.add_argument("--source", choices=["parquet", "json", "kafka"])
    ap.add_argument("--path")
    ap.add_argument("--servers")
    ap.add_argument("--topic")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--initial-state", help="ledger_state folder of a batch run to continue from")
    ap.add_argument("--no-dedupe", action="store_true", help="every transaction is known to come once")
    ap.add_argument("--split", action="store_true", help="stream: the ledger in two stages, for hot addresses")
    for f in dataclasses.fields(DEFAULT):
        if isinstance(f.default, bool):
            ap.add_argument("--" + f.name.replace("_", "-"), action="store_true", default=f.default)
        else:
            ap.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), default=f.default)
    a = ap.parse_args(argv)
    opts = DEFAULT.with_(**{f.name: getattr(a, f.name) for f in dataclasses.fields(DEFAULT)})

    if a.mode != "compact" and not a.source:
        ap.error(f"{a.mode} needs --source")

    from utxoflow.jobs import batch_job, compact_job, stream_job
    from utxoflow.session import get_spark
    from utxoflow.sources import read_with_quarantine

    spark = get_spark("utxoflow-" + a.mode)
    if a.mode == "compact":
        for name, merges in compact_job(spark, a.out).items():
            print(name, merges)
        return
    src = {"path": a.path} if a.source != "kafka" else {"servers": a.servers, "topic": a.topic}
    tx, rejected = read_with_quarantine(spark, a.source, streaming=a.mode == "stream", **src)
    if a.mode == "batch":
        for name, path in batch_job(tx, a.out, opts, rejected, dedupe=not a.no_dedupe).items():
            print(name, path)
    else:
        if not a.checkpoint:
            ap.error("stream needs --checkpoint")
        for q in stream_job(spark, tx, a.out, a.checkpoint, opts, initial_state=a.initial_state, rejected=rejected, split=a.split,
                            dedupe=not a.no_dedupe):
            print("started", q.id)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
