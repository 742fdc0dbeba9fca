"""A node as a data source: spark.read.format("node") and spark.readStream.format("node").

Rows are (height, value), value a block in JSON with its transactions decoded. Ranges of heights are the partitions: they are
fetched by the tasks, each on its own, so a lost task fetches its range anew and nothing is gathered. A stream's offset
is the next height, so that a restarted query goes on where its checkpoint ends.

Options: url (with the node's credentials); start (0) and end (the node's tip), the latter for batches; chunk, the heights of
a partition; confirmations, the blocks above one that a stream waits for, so that those that the node may still drop are not
read; tries and wait (seconds, doubled each time) of a request.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from walletgraph.sources.blocks import CHUNK, TRIES, call


@dataclass
class Heights(InputPartition):
    """From the first height up to, but without, the last."""

    first: int
    last: int


class Node:
    """What the options say, and the requests."""

    def __init__(self, options: dict[str, str]):
        if "url" not in options:
            raise ValueError("option url is missing")
        self.url, self.start, self.end = options["url"], int(options.get("start", 0)), options.get("end")
        self.chunk, self.confirmations = int(options.get("chunk", CHUNK)), int(options.get("confirmations", 0))
        self.tries, self.wait = int(options.get("tries", TRIES)), float(options.get("wait", 1.0))

    def ask(self, method: str, *params):
        return call(self.url, method, list(params), self.tries, self.wait)

    def next_height(self) -> int:
        """Above the last block that is to be read."""
        return max(self.start, self.ask("getblockcount") + 1 - self.confirmations)

    def ranges(self, first: int, last: int) -> list[Heights]:
        return [Heights(x, min(last, x + self.chunk)) for x in range(first, last, self.chunk)]

    def blocks(self, part: Heights | None) -> Iterator[tuple[int, str]]:
        """None stands for no range at all."""
        for height in range(part.first, part.last) if part else ():  # one block in memory at a time
            yield height, json.dumps(self.ask("getblock", self.ask("getblockhash", height), 2))


class NodeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.node = Node(options)
        self.first = self.node.start
        self.last = None if self.node.end is None else int(self.node.end) + 1

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds of the height cut the ranges; other filters stay Spark's."""
        for f in filters:
            if getattr(f, "attribute", None) != ("height",) or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            low = f.value + isinstance(f, GreaterThan)
            high = f.value + isinstance(f, (EqualTo, LessThanOrEqual))
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, low)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.last = high if self.last is None else min(self.last, high)

    def partitions(self) -> list[Heights]:
        tip = self.node.next_height()
        return self.node.ranges(self.first, tip if self.last is None else min(self.last, tip))

    def read(self, partition: Heights) -> Iterator[tuple[int, str]]:
        return self.node.blocks(partition)


class NodeStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.node = Node(options)

    def initialOffset(self) -> dict:
        return {"height": self.node.start}

    def latestOffset(self) -> dict:
        return {"height": self.node.next_height()}

    def partitions(self, start: dict, end: dict) -> list[Heights]:
        return self.node.ranges(start["height"], end["height"])

    def read(self, partition: Heights) -> Iterator[tuple[int, str]]:
        return self.node.blocks(partition)


class NodeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "node"

    def schema(self) -> str:
        return "height long, value string"

    def reader(self, schema) -> NodeReader:
        return NodeReader(self.options)

    def streamReader(self, schema) -> NodeStream:
        return NodeStream(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known; heights are pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NodeSource)
