"""Compression of vectors to codes of parts, with codebooks from Ball k-means.

Components become integers floor(scale * x), vectors are cut into equal consecutive parts, and each
part position has a codebook of integer entries. The first codebook holds the parts of the rows with the
smallest ids. A round assigns every part to its nearest entry (ties to the lower index) and replaces
every entry by the floored mean of its parts.

A round begins with the entry each part had before. That entry's ball, its centre and a radius that
holds all its parts, says which entries are neighbours: those nearer to the centre than two radii. A
part within half the way to the nearest neighbour is in the stable core and keeps its entry without any
distance but that to its centre. Any other part lies in a ring between half the ways to two successive
neighbours, and only the neighbours up to there are compared. Squares are compared as integers, so
nothing is lost by rounding and ties come out as in a full search. Radii are bounded by those of the round
before plus the way the centre moved, which saves a pass.

Rows whose vector is null, holds null or non-finite components, or has another number of components than
most (of equally many the least) take no part. Integers beyond 2 ** 24 in size raise, as their squares
would not be exact. A number of components that does not divide by the parts is filled with zeros.
Repeated ids are rows of their own, in order of their vectors; null ids come last. Fewer rows than
entries make smaller codebooks. Other columns are not needed; no rows give no rows.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textfeat.llm.shared import keep
from textfeat.plans.sizing import broadcast_if_small
from textfeat.plans.staging import release

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 24
# Parts whose distances to all entries are held at a time.
SLICE = 4096


def finite(vector: Column) -> Column:
    """Whether all components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_vectors(rows: DataFrame, vector_column: str, scale: int, largest: int) -> DataFrame:
    """Rows that take part, with ``whole array<long>``; staged."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = rows.withColumn("vector", vector).where(finite(F.col("vector")))

    def whole(x: Column) -> Column:
        fits = F.abs(x) < largest / scale
        return F.when(fits, F.floor(x * scale).cast("long")).otherwise(F.raise_error(F.lit(f"a component is {largest // scale} or larger")).cast("long"))

    rows = keep(rows.withColumn("whole", F.transform("vector", whole)).drop("vector"), "whole-vectors")
    usual = rows.groupBy(F.size("whole").alias("size")).count().orderBy(F.desc("count"), "size").limit(2).collect()
    return rows.where(F.size("whole") == usual[0]["size"]) if len(usual) > 1 else rows


@dataclass(frozen=True)
class Balls:
    """Codebooks ``entries[part, entry, component]`` with, for each entry, its neighbours.

    ``around[part][entry]`` holds the other entries whose centre is nearer than two radii, nearest
    first, and ``ways`` their squared distances.
    """

    entries: np.ndarray
    around: list[list[np.ndarray]]
    ways: list[list[np.ndarray]]

    @staticmethod
    def of(entries: np.ndarray, radii: np.ndarray | None) -> "Balls":
        """``radii`` bounds the distance of the parts of each entry; None where nothing is assigned."""
        around, ways = [], []
        for p, book in enumerate(entries):
            apart = ((book[:, None] - book[None]) ** 2).sum(-1)
            lists = []
            for j in range(len(book)):
                others = np.delete(np.arange(len(book)), j)
                if radii is not None:
                    # A little more than two radii, for they come from square roots.
                    others = others[apart[j, others] <= (2 * radii[p, j] * (1 + 1e-9) + 1e-6) ** 2]
                lists.append(others[np.argsort(apart[j, others], kind="stable")])
            around.append(lists)
            ways.append([apart[j, near] for j, near in enumerate(lists)])
        return Balls(entries, around, ways)

    def first(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part of ``data[row, part, component]``, by full search."""
        codes = np.empty(data.shape[:2], np.int64)
        apart = np.empty(data.shape[:2], np.int64)
        for begin in range(0, len(data), SLICE):
            some = slice(begin, begin + SLICE)
            for p, book in enumerate(self.entries):
                distance = _squares(data[some, p], book)
                codes[some, p] = distance.argmin(1)
                apart[some, p] = distance.min(1)
        return codes, apart

    def again(self, data: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The same from the entries of the round before; also the number of distances computed."""
        codes, computed = codes.copy(), codes.size
        apart = np.empty(codes.shape, np.int64)
        for p, book in enumerate(self.entries):
            own = codes[:, p].copy()
            apart[:, p] = ((data[:, p] - book[own]) ** 2).sum(-1)
            for j in np.unique(own):
                members = np.flatnonzero(own == j)
                # The part may be nearer to, or as near as to, a centre at most twice its distance away.
                reach = np.searchsorted(self.ways[p][j], 4 * apart[members, p], side="right")
                ringed = members[reach > 0]
                reach = reach[reach > 0]
                for begin in range(0, len(ringed), SLICE):
                    some, far = ringed[begin : begin + SLICE], reach[begin : begin + SLICE]
                    near = self.around[p][j][: far.max()]
                    distance = _squares(data[some, p], book[near])
                    outside = np.arange(len(near)) >= far[:, None]
                    computed += int(far.sum())
                    least = np.where(outside, np.iinfo(np.int64).max, distance).min(1)
                    tied = (distance == least[:, None]) & ~outside
                    index = np.where(tied, near, len(book)).min(1)
                    held = apart[some, p]
                    moves = (least < held) | ((least == held) & (index < j))
                    codes[some[moves], p] = index[moves]
                    apart[some[moves], p] = least[moves]
        return codes, apart, computed


def _squares(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all parts to all entries, exact in integers."""
    total = np.zeros((len(parts), len(book)), np.int64)
    for i in range(book.shape[1]):
        total += (parts[:, i, None] - book[:, i]) ** 2
    return total


@dataclass(frozen=True)
class Compressed:
    """``rows``: ``vec_id``, the columns asked for, ``code binary``, ``error long``; all codebooks as
    ``entries[part, entry, component]``."""

    rows: DataFrame
    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, *columns: str, id_column: str = "vec_id", vector_column: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Compressed:
    """Codes of all rows. To the driver come ``entries`` rows to begin with, then sums by entry."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part, so 1 to 256 entries")
    # Columns asked for travel in one, so their names cannot clash.
    named = rows.select(F.col(id_column).alias("vec_id"), F.struct(F.lit(0).alias("_"), *map(F.col, columns)).alias("own"), F.col(vector_column).alias("vector"))
    whole = whole_vectors(named, "vector", scale, LARGEST)
    drawn = whole.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    book = _cut(np.array([r.whole for r in drawn], np.int64).reshape(len(drawn), -1 if drawn else 0), parts).transpose(1, 0, 2)
    balls = Balls.of(book, None)
    held = _assigned(whole, balls, first=True)
    for _ in range(rounds if drawn else 0):
        sums, counts, farthest = _totals(held, book.shape)
        means = np.where(counts[..., None] > 0, np.floor_divide(sums, np.maximum(counts, 1)[..., None]), book)
        moved = np.sqrt(((means - book).astype(float) ** 2).sum(-1))
        book, balls = means, Balls.of(means, np.sqrt(farthest.astype(float)) + moved)
        before, held = held, _assigned(held, balls, first=False)
        release(before)
    error = F.aggregate("apart", F.lit(0).cast("long"), lambda total, x: total + x)
    return Compressed(held.select("vec_id", *(F.col("own")[c].alias(c) for c in columns), "code", error.alias("error")), book)


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """``[row, part, component]``, filled up with zeros."""
    n, size = vectors.shape
    width = -(-size // parts)
    filled = np.zeros((n, parts * width), np.int64)
    filled[:, :size] = vectors
    return filled.reshape(n, parts, width)


def _integers(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1 if len(column) else 0)


def _assigned(rows: DataFrame, balls: Balls, first: bool) -> DataFrame:
    """``rows`` with ``code`` and ``apart``, the squared distances of the parts; staged."""
    schema = rows.select("vec_id", "own", "whole").schema.add("code", T.BinaryType()).add("apart", T.ArrayType(T.LongType()))
    parts = len(balls.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = _cut(_integers(batch.column("whole")), parts)
            if first:
                codes, apart = balls.first(data)
            else:
                before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                codes, apart, _ = balls.again(data, before.astype(np.int64))
            made = [pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary()), pa.array(list(apart), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "own", "whole")), *made], ["vec_id", "own", "whole", "code", "apart"])

    return keep(rows.mapInArrow(run, schema), "codes")


def _totals(rows: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, numbers and greatest squared distance of the parts of each entry, summed up per task."""
    parts, entries, width = shape
    names = ["slot", "n", "farthest", *(f"s{i}" for i in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        counts, farthest = np.zeros(parts * entries, np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            data = _cut(_integers(batch.column("whole")), parts)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            slots = (codes + entries * np.arange(parts)).reshape(-1)
            np.add.at(sums, slots, data.reshape(-1, width))
            np.maximum.at(farthest, slots, _integers(batch.column("apart")).reshape(-1))
            counts += np.bincount(slots, minlength=len(counts))
        used = np.flatnonzero(counts)
        made = [used, counts[used], farthest[used], *(sums[used, i] for i in range(width))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names)

    partial = rows.select("whole", "code", "apart").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    total = partial.groupBy("slot").agg(F.sum("n").alias("n"), F.max("farthest").alias("farthest"), *(F.sum(n).alias(n) for n in names[3:]))
    found = total.toArrow()
    slots = found.column("slot").to_numpy()
    sums = np.zeros((parts * entries, width), np.int64)
    counts, farthest = np.zeros(parts * entries, np.int64), np.zeros(parts * entries, np.int64)
    counts[slots], farthest[slots] = found.column("n").to_numpy(), found.column("farthest").to_numpy()
    for i in range(width):
        sums[slots, i] = found.column(f"s{i}").to_numpy()
    return sums.reshape(shape), counts.reshape(shape[:2]), farthest.reshape(shape[:2])


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` (``label``, ``error``) with ``label_error``, the error of all rows of the label; nulls
    are one label. The labels' sums are broadcast behind a check of their number, else joined."""
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = broadcast_if_small(keep(sums, "label-errors"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
