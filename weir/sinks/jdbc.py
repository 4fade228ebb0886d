"""Batched JDBC insert. Delivery is at least once: a retried micro-batch may insert
rows again, so give the table a key if that matters.

Only failures that may pass are tried again: a lost or refused connection, a deadlock or
a lock timeout, an overloaded server. A wrong table, type or key fails at once."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


#: SQL states of connection failures (08), rollbacks by the server (40), resources (53),
#: intervention (57), timeouts of the client (HYT), and what drivers and the network say.
TRANSIENT = re.compile(
    r"SQLTransient|SQLRecoverable|SQLTimeout|(?:SQLState|SQLSTATE)[^0-9A-Za-z]{0,3}(?:08|40|53|57|HYT)"
    r"|ConnectException|SocketException|SocketTimeout|NoRouteToHost|UnknownHost|EOFException"
    r"|[Cc]ommunications link failure|[Cc]onnection (?:refused|reset|closed|timed out)|[Dd]eadlock|[Ll]ock.{0,20}timeout"
    r"|[Tt]oo many (?:connections|clients)"
)


def is_transient(error: BaseException) -> bool:
    """Whether trying again may help, by the error and its causes."""
    seen: list[BaseException] = []
    while error is not None and error not in seen:
        if isinstance(error, (ConnectionError, TimeoutError)) or TRANSIENT.search(f"{type(error).__name__}: {error}"):
            return True
        seen.append(error)
        error = error.__cause__ or error.__context__
    return False


class JdbcInsert:
    """Append each micro-batch to ``table`` over at most ``connections`` parallel
    connections, ``batch_rows`` rows per statement; up to ``retries`` new attempts."""

    def __init__(
        self,
        url: str,
        table: str,
        properties: dict[str, str] | None = None,
        batch_rows: int = 1000,
        retries: int = 5,
        connections: int = 16,
        sleep: Callable[[float], None] = time.sleep,
    ):
        self.url, self.table = url, table
        self.properties = properties or {}
        self.batch_rows, self.retries, self.connections = batch_rows, retries, connections
        self.sleep = sleep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for attempt in range(self.retries + 1):
            try:
                return self._insert(batch)
            except Exception as error:
                if attempt == self.retries or not is_transient(error):
                    raise
                self.sleep(min(2.0**attempt, 30.0))

    def _insert(self, batch: DataFrame) -> None:
        (
            batch.write.format("jdbc")
            .mode("append")
            .options(**self.properties)
            .option("url", self.url)
            .option("dbtable", self.table)
            .option("batchsize", self.batch_rows)
            .option("numPartitions", self.connections)
            .save()
        )


def write_jdbc(
    rows: DataFrame, insert: JdbcInsert, interval: str | None = "2 seconds"
) -> DataStreamWriter:
    writer = rows.writeStream.foreachBatch(insert)
    return writer if interval is None else writer.trigger(processingTime=interval)
