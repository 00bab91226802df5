"""Bulk document sink.

Each task sends its rows in requests of at most ``batch_size`` documents through a function
the caller supplies; nothing passes through the driver.

:func:`write_once` also survives lost tasks. What belongs to which request is written down
first, under (batch id, partition, request), so whoever sends a request again sends the same.
A task that is through leaves the requests it has sent in a ledger, which a repeated batch
reads: these are not sent again. A request of a task that was lost halfway is; the ids of its
documents are derived from the same numbers, so the second writing replaces the first.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import batched, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import exists, folders, remove_folder
from millrace.sinks.files import batch_folder

BATCH_SIZE = 100

Writer = Callable[[list[str]], None]

_SENT = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("request", T.LongType())])


@dataclass(frozen=True)
class Request:
    """Documents of one request, and the numbers that name it for good."""

    batch: int
    part: int
    number: int
    documents: tuple[str, ...]

    @property
    def ids(self) -> list[str]:
        return [f"{self.batch}-{self.part}-{self.number}-{i}" for i in range(len(self.documents))]

    def body(self, index: str, type: str | None = None) -> str:
        return bulk_body(self.documents, index, type, self.ids)


Sender = Callable[[Request], None]


def bulk_body(
    documents: Iterable[str], index: str, type: str | None = None, ids: Iterable[str] | None = None
) -> str:
    """A newline-delimited bulk request: an index action before every document, with its id if there are ``ids``."""
    target = {"_index": index} if type is None else {"_index": index, "_type": type}
    if ids is None:
        action = json.dumps({"index": target})
        return "".join(f"{action}\n{document}\n" for document in documents)
    actions = (json.dumps({"index": {**target, "_id": i}}) for i in ids)
    return "".join(f"{action}\n{document}\n" for action, document in zip(actions, documents, strict=True))


def write_documents(df: DataFrame, document: Column, writer: Writer, batch_size: int = BATCH_SIZE) -> None:
    """Sends one JSON text per row. A retried task sends its documents again; see :func:`write_once`."""

    def send(rows: Iterator) -> None:
        for rows_of_request in batched((row[0] for row in rows), batch_size):
            writer(list(rows_of_request))

    df.select(document.alias("document")).filter(F.col("document").isNotNull()).foreachPartition(send)


def document_batches(
    document: Column, writer: Writer, batch_size: int = BATCH_SIZE
) -> Callable[[DataFrame, int], None]:
    """The same for every micro-batch of a stream."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_documents(rows, document, writer, batch_size)

    return write


def _numbered(df: DataFrame, document: Column, batch_size: int) -> DataFrame:
    """(part, request, at, document): which request of its partition a document belongs to."""
    # The lower 33 bits count the rows of a partition.
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    texts = df.select(document.alias("document")).filter(F.col("document").isNotNull())
    numbered = texts.select(F.spark_partition_id().alias("part"), at.alias("at"), "document")
    return numbered.select("part", F.floor(F.col("at") / batch_size).alias("request"), "at", "document")


def request_bodies(df: DataFrame, document: Column, index: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """(part, request, body): the bulk requests themselves as rows, for a sink of texts or a queue."""
    lists = _numbered(df, document, batch_size).groupBy("part", "request").agg(
        F.sort_array(F.collect_list(F.struct("at", "document"))).alias("documents")
    )
    action = json.dumps({"index": {"_index": index}})
    lines = F.transform("documents", lambda d: F.concat(F.lit(f"{action}\n"), d["document"], F.lit("\n")))
    return lists.select("part", "request", F.array_join(lines, "").alias("body"))


def write_once(
    df: DataFrame, document: Column, send: Sender, ledger: str, batch_id: int = 0, batch_size: int = BATCH_SIZE
) -> None:
    """Sends one JSON text per row so that, with the ids of :class:`Request`, each is stored once.

    ``ledger`` is a folder all executors reach. Called again with the same ``batch_id`` after
    a failure, it takes up what is left of that batch, not ``df``.
    """
    spark, folder = df.sparkSession, batch_folder(ledger, batch_id)
    staged, sent = f"{folder}/staged", f"{folder}/sent"
    if not exists(spark, f"{staged}/_SUCCESS"):
        _numbered(df, document, batch_size).write.mode("overwrite").parquet(staged)
    requests = spark.read.parquet(staged)
    if exists(spark, sent):
        done = spark.read.schema(_SENT).parquet(sent)
        requests = requests.join(done, ["part", "request"], "left_anti")
    dealt = requests.repartition("part", "request").sortWithinPartitions("part", "request", "at")
    through = dealt.mapInArrow(_sending(send, batch_id), _SENT)
    # A task's records become visible when the task is through, not only when all are.
    writer = through.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.parquet(sent)
    for name in folders(spark, ledger):
        if name != f"batch={batch_id}":
            remove_folder(spark, f"{ledger.rstrip('/')}/{name}")


def _sending(send: Sender, batch_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("part", "request", "document")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, number), group in groupby(rows(batches), key=lambda row: row[:2]):
            send(Request(batch_id, part, number, tuple(row[2] for row in group)))
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "request": [number]}, schema=pa.schema([("part", pa.int32()), ("request", pa.int64())])
            )

    return run


def once_batches(
    document: Column, send: Sender, ledger: str, batch_size: int = BATCH_SIZE
) -> Callable[[DataFrame, int], None]:
    """:func:`write_once` for every micro-batch of a stream, a repeated one included."""

    def write(rows: DataFrame, batch_id: int) -> None:
        write_once(rows, document, send, ledger, batch_id, batch_size)

    return write
