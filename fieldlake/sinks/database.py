"""Full reload of a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldlake.contracts import PUBLISH_ORDER, ROLLUPS, STAR, conform
from fieldlake.sources.tables import Database


def write_options(target: Database, table: str, connections: int, batch_rows: int) -> dict[str, str]:
    return {
        "url": target.url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
        **target.properties,
    }


def reload_database(
    tables: dict[str, DataFrame],
    target: Database,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> list[str]:
    """Empty the tables, dependants first, then append in dependency order.

    The tables must exist. They are truncated, never dropped, so their declared
    types and keys stay; each frame is conformed to its contract before it goes
    out. `connections` bounds the parallel writers the database has to accept.
    Returns the order of the appends.
    """
    contracts = {**STAR, **ROLLUPS}
    order = [name for name in PUBLISH_ORDER if name in tables]
    conformed = {name: conform(tables[name], contracts[name]) for name in order}

    def write(name: str, df: DataFrame, mode: str, **extra: str) -> None:
        options = write_options(target, name, connections, batch_rows)
        df.write.format("jdbc").mode(mode).options(**options, **extra).save()

    for name in reversed(order):
        write(name, conformed[name].limit(0), "overwrite", truncate="true", cascadeTruncate="true")
    for name in order:
        write(name, conformed[name], "append")
    return order
