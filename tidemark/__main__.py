"""``python -m tidemark --config FILE [--generate-ch-ddl]``

Replicates the tables of the configuration, or prints the definitions of their targets.
The ``source`` section of the configuration names what stands for the source: ``catalog``
(a JSON file), ``capture`` (a folder of WAL segments), ``snapshot`` (a folder with COPY
text in ``schema.table.copy``) and ``snapshot_lsn``.
"""

from __future__ import annotations

import argparse
import os
import signal

from tidemark.plans.config import Config, load
from tidemark.plans.ddl import target_ddl
from tidemark.sources.catalog import Catalog, load_catalog


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def definitions(config: Config, catalog: Catalog) -> str:
    return "\n\n".join(f"{text};" for name, t in config.tables.items() for text in target_ddl(catalog.tables[name].columns, t))


def replicate(config: Config, catalog: Catalog, once: bool) -> None:
    from pyspark.sql import SparkSession

    from tidemark.functions.lsn import from_text
    from tidemark.sources.wal import register
    from tidemark.streaming.control import Control
    from tidemark.streaming.replicator import Replicator

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    register(spark)
    r = Replicator(spark, config, catalog)
    control = Control(r.state, config.redis_bind) if config.redis_bind else None
    folder = config.source.get("snapshot")
    if r.needs_sync() and folder:
        found = {name: path for name in r.tables if os.path.exists(path := f"{folder}/{name[0]}.{name[1]}.copy")}
        r.sync(found, from_text(str(config.source.get("snapshot_lsn", "0/0"))))
    most = min((t.max_buffer_length for t in config.tables.values()), default=1000)
    stream = spark.readStream.format("wal_capture").option("start_lsn", r.min_lsn()).option("max_buffer_length", most).load(config.source["capture"])
    query = r.start(stream, once=False)
    stop = lambda *_: query.stop()
    for s in (signal.SIGINT, signal.SIGTERM, signal.SIGABRT, signal.SIGQUIT):
        signal.signal(s, stop)
    try:
        if once:
            query.processAllAvailable()
        else:
            query.awaitTermination()
    finally:
        r.stop(query)
        if control:
            control.close()


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--generate-ch-ddl", action="store_true", help="print the target definitions and end")
    parser.add_argument("--once", action="store_true", help="end when all that the capture holds is applied")
    own = parser.parse_args(args)
    config = load(read(own.config))
    catalog = load_catalog(read(config.source["catalog"]))
    if own.generate_ch_ddl:
        print(definitions(config, catalog))
    else:
        replicate(config, catalog, own.once)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
