"""Best-fit packing by minimum bin slack.

Pieces of documents are packed into sequences of a fixed capacity. What matters about a piece is its
length, so bins are planned on the counts of lengths, at most ``capacity`` numbers however large
the corpus: the longest length left opens a bin, a subset-sum dynamic programme over bitsets finds
the fullest combination of lengths still there to go with it, and the combination is taken out as
often as the counts allow (until then it remains the fullest). The plan gives each length intervals
of ranks; a piece finds its sequence by its rank among the pieces of its length.

Null texts count as empty; every document ends with the end id, so it has one piece at least. Rows
with equal ids are separate documents. An empty table gives an empty result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import keep, rows_of
from textfeat.llm.tokens import encoder
from textfeat.plans import sizing


@dataclass(frozen=True)
class Slot:
    """Pieces of ``length`` with rank ``first`` or more: one per sequence from ``sequence`` on, at ``offset``."""

    length: int
    first: int
    sequence: int
    offset: int


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each at most as often as counted, whose sum is the largest that fits ``room``.

    Bit s of the set says that sum s can be reached; the sets before each step lead back to the
    lengths. Stops as soon as the room can be filled.
    """
    within = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        several = 1
        while left > 0 and not reached >> room:  # 1, 2, 4, ... copies, the rest last
            copies = min(several, left)
            steps.append((reached, length, copies))
            reached |= (reached << (length * copies)) & within
            left -= copies
            several *= 2
        if reached >> room:
            break
    total, chosen = reached.bit_length() - 1, []
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * copies
            total -= length * copies
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[Slot]:
    """Slots that place every piece; ``counts`` is the number of pieces of each length."""
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    slots: list[Slot] = []
    sequences = 0
    while left:
        seed = max(left)
        rest = {k: n - (k == seed) for k, n in left.items() if n > (k == seed)}
        bin_ = [seed, *fullest(rest, capacity - seed)]
        times = min(left[k] // bin_.count(k) for k in set(bin_))
        offset = 0
        for length in bin_:
            slots.append(Slot(length, used[length], sequences, offset))
            used[length] += times
            left[length] -= times
            offset += length
        for length in set(bin_):
            if not left[length]:
                del left[length]
        sequences += times
    return slots


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` of every piece of every document.

    ``ids`` are little-endian unsigned 32-bit integers. Documents longer than ``capacity`` are cut
    into pieces of it, the first being the shorter one. Texts and ids are not shuffled: the staged
    pieces are numbered per task and length, and only those numbers are summed over tasks.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    fields = f"part long, doc_id {id_type}, piece int, start long, length long, ids binary, rank long"
    pieces = keep(source.mapInArrow(_pieces(tokenizer, end_id, capacity), fields), "pieces")

    per_part = keep(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    slots = plan(counts, capacity)
    before = per_part.selectExpr("part", "length", "sum(n) OVER (PARTITION BY length ORDER BY part) - n AS before")
    ranked = pieces.join(sizing.broadcast_if_small(before), ["part", "length"]).withColumn("rank", F.col("before") + F.col("rank"))
    columns = ("doc_id", "piece", "start", "length", "ids", "rank")
    fields = f"doc_id {id_type}, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return ranked.select(*columns).mapInArrow(_placed(slots), fields)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (all pieces in their order) and ``doc_ids`` of packed pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return joined.select("sequence_id", ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def _pieces(tokenizer: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            made: list[tuple] = []
            size = 0
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                ids = encode(text) + end
                n = len(ids) // 4
                ends = range((n - 1) % capacity + 1, n + 1, capacity)
                for piece, stop in enumerate(ends):
                    begin = max(0, stop - capacity) if piece else 0
                    length = stop - begin
                    made.append((part, doc_id, piece, begin, length, ids[4 * begin : 4 * stop], int(seen[length])))
                    seen[length] += 1
                size += n
                if size > 1_000_000:
                    yield _batch(made, id_type)
                    made, size = [], 0
            if made:
                yield _batch(made, id_type)

    return run


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int64(), id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["part", "doc_id", "piece", "start", "length", "ids", "rank"])


def _placed(slots: list[Slot]):
    ordered = sorted(slots, key=lambda s: (s.length, s.first))
    # Length and rank in one number: 2^40 pieces of one length are beyond any corpus.
    keys = np.array([(s.length << 40) + s.first for s in ordered], np.int64)
    sequence = np.array([s.sequence - s.first for s in ordered], np.int64)
    offset = np.array([s.offset for s in ordered], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            slot = np.searchsorted(keys, (batch.column("length").to_numpy() << 40) + rank, "right") - 1
            made = [*batch.columns[:5], pa.array(sequence[slot] + rank), pa.array(offset[slot])]
            yield pa.RecordBatch.from_arrays(made, [*batch.schema.names[:5], "sequence_id", "offset"])

    return run
