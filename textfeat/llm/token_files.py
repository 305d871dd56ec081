"""Token-id files: documents in ascending id order as independent rANS blocks.

A file set is a folder of two Parquet tables. ``frequencies`` (``token, freq``) is shared by all
blocks; ``blocks`` has one row per block: ``start`` (ids before it), ``n_tokens``, ``payload``,
``checkpoints``, ``ids_crc32`` and its documents as ``doc_ids``, ``lengths``. A block holds whole
documents and at least ``block_tokens`` ids, so its size is bounded by that and one document.

Null texts count as empty; every document has its end id, so none is without ids. Null ids come
first; rows with equal ids are ordered by the hash of their text, and equal rows are kept. An empty
table gives files without blocks. Other columns are not written.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.llm import rans
from textfeat.llm.shared import keep, rows_of
from textfeat.llm.tokens import encoder
from textfeat.plans import sizing
from textfeat.plans.staging import release

BLOCK_TOKENS = 1 << 20


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_tokens: int = BLOCK_TOKENS, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every text, append ``end_id`` to each and write the files below ``path``.

    Texts are shuffled once, into id ranges, and their ids staged in blocks, as the table of all
    frequencies must be there before the first block is coded. Each block carries the counts of its ids,
    so the ids are read once more only, to be coded.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    tie = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    ordered = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    fields = f"part long, block long, first long, n_tokens long, ids binary, counts binary, doc_ids array<{id_type}>, lengths array<long>"
    raw = keep(ordered.mapInArrow(_to_blocks(tokenizer, end_id, block_tokens), fields), "token-blocks", compression="lz4")

    table = _frequencies(raw)
    starts = raw.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min("part").alias("p"))
    starts = starts.selectExpr("part", "sum(n) OVER (ORDER BY p) - n AS before")
    placed = raw.join(sizing.broadcast_if_small(starts), "part").withColumn("start", F.col("before") + F.col("first"))

    fields = f"start long, n_tokens long, payload binary, checkpoints binary, ids_crc32 long, doc_ids array<{id_type}>, lengths array<long>"
    keep(placed.select("start", "n_tokens", "ids", "doc_ids", "lengths").mapInArrow(_coded(table), fields), "", f"{path}/blocks", "none")
    rows = [(int(i), int(table.freq[i])) for i in np.flatnonzero(table.freq)]  # bounded by the vocabulary
    docs.sparkSession.createDataFrame(rows, "token long, freq long").coalesce(1).write.parquet(f"{path}/frequencies")
    release(raw)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` (little-endian unsigned 32-bit) of every document in the files.

    Raises where a block does not decode to ids of its checksum.
    """
    rows = spark.read.parquet(f"{path}/frequencies").collect()  # bounded by the vocabulary
    freq = np.zeros(max((r.token for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r.token] = r.freq
    table = rans.Frequencies(int(freq.sum()).bit_length() - 1, freq)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    columns = ("start", "n_tokens", "payload", "checkpoints", "ids_crc32", "doc_ids", "lengths")
    return blocks.select(*columns).mapInArrow(_decoded(table, columns), f"doc_id {id_type}, start long, ids binary")


def _to_blocks(tokenizer: str, end_id: int, block_tokens: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        number = first = size = 0
        held, doc_ids, lengths = [], [], []
        id_type = None

        def block() -> pa.RecordBatch:
            ids = b"".join(held)
            counts = np.bincount(np.frombuffer(ids, "<u4")).astype("<u4").tobytes()
            values = [[part], [number], [first], [size], [ids], [counts], pa.array([doc_ids], pa.list_(id_type)), [lengths]]
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], ["part", "block", "first", "n_tokens", "ids", "counts", "doc_ids", "lengths"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                ids = encode(text) + end
                held.append(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                size += len(ids) // 4
                if size >= block_tokens:
                    yield block()
                    number, first, size = number + 1, first + size, 0
                    held, doc_ids, lengths = [], [], []
        if held:
            yield block()

    return run


def _frequencies(raw: DataFrame) -> rans.Frequencies:
    """Counts of all ids in all blocks, combined per task; one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for (block,) in (row for batch in batches for row in rows_of(batch, "counts")):
            found = np.frombuffer(block, "<u4").astype(np.int64)
            if len(found) > len(counts):
                found[: len(counts)] += counts
                counts = found
            else:
                counts[: len(found)] += found
        tokens = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts[tokens])], ["token", "n"])

    rows = raw.select("counts").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.token for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.token] = r.n
    return rans.Frequencies.fit(counts)


def _coded(table: rans.Frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, ids in enumerate(batch.column("ids")):
                row = batch.slice(i, 1)
                payload, checkpoints, crc = rans.encode(np.frombuffer(ids.as_buffer(), "<u4"), table)
                made = [row.column("start"), row.column("n_tokens"), pa.array([payload]), pa.array([checkpoints]), pa.array([crc]), row.column("doc_ids"), row.column("lengths")]
                yield pa.RecordBatch.from_arrays(made, ["start", "n_tokens", "payload", "checkpoints", "ids_crc32", "doc_ids", "lengths"])

    return run


def _decoded(table: rans.Frequencies, columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = table.symbols()
        for batch in batches:
            id_type = batch.schema.field("doc_ids").type.value_type
            for start, n, payload, checkpoints, crc, doc_ids, lengths in rows_of(batch, *columns):
                ids = rans.decode(payload, checkpoints, n, table, symbols).astype("<u4")
                if zlib.crc32(ids.tobytes()) != crc:
                    raise ValueError(f"block at {start}: checksum differs")
                ends = np.cumsum(lengths)
                texts = [ids[end - size : end].tobytes() for end, size in zip(ends, lengths)]
                made = [pa.array(doc_ids, id_type), pa.array(start + ends - np.array(lengths), pa.int64()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "start", "ids"])

    return run
