"""Nearest neighbours by inner product: multi-index hashing over learned binary codes.

Rows are parted into bands of like length, as lengths lie in a bounded sample, from the longest down. Vectors get one more
component that brings all of a band to its greatest length (0 for queries), which turns the largest
inner product into the smallest angle. Principal axes of the sample, turned several times over so that
signs lose least, give codes of ``BITS`` bits. Rows are dealt to blocks by hash, queries to chunks; every
pair of them is one task of bounded size.

A band of a block has a table for each byte of the code. With m bytes, a code within distance r of a
query's has a byte within r // m, so probing all bytes within p finds every code within m p + m - 1.
Distance and greatest length estimate a product. The bands whose unseen codes could have the greatest
estimates are probed further until ``CANDIDATES`` codes of the block, of other ids than the query's, have
estimates above all unseen ones, or no code is left. The radius of each band is then the largest
distance whose estimate is not below that of the last candidate: every code within it is reranked by the
inner product of the original vectors in double precision. Rows equal in id and vector are one row with
a count until they are ranked.

Vectors that are null, zero, of another dimension than most in the sample, or hold null or
non-finite components take no part, nor do null ids. Rows with the query's id are its own. Of
several queries with one id the least vector counts. Ties go to the smaller id. Other columns are not
read, whatever their names. An empty table, or no query, gives an empty result.
"""

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import keep

BITS = 128
BANDS = 32
STEP = 1.25  # greatest lengths of two bands differ by this factor at least
SAMPLE = 20_000
BLOCK_ROWS = 16_384
CHUNK_QUERIES = 2_048
CANDIDATES = 1_000


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Codes:
    """Learned projection to the signs of ``BITS`` components, and the bands of lengths."""

    def __init__(self, sample: np.ndarray, longest: float, rounds: int = 30):
        lengths, tops = np.sort(np.linalg.norm(sample, axis=1)), [longest]
        while len(tops) < BANDS and (below := np.searchsorted(lengths, tops[-1] / STEP)):
            tops.append(lengths[below - 1])
        self.tops = np.array(tops[::-1])
        data = self.extended(sample, self.bands(sample))
        _, axes = np.linalg.eigh(data.T @ data)
        axes = axes[:, ::-1]
        rng = np.random.default_rng(0)
        parts = []
        for begin in range(0, BITS, axes.shape[1]):  # as many bits at a time as there are axes
            part = axes[:, : BITS - begin]
            flat = data @ part
            turn, _ = np.linalg.qr(rng.standard_normal((part.shape[1],) * 2))
            for _ in range(rounds):  # alternate between codes and the rotation that fits them best
                left, _, right = np.linalg.svd(flat.T @ np.sign(flat @ turn), full_matrices=False)
                turn = left @ right
            parts.append(part @ turn)
        self.projection = np.hstack(parts)

    def bands(self, vectors: np.ndarray) -> np.ndarray:
        """Place in ``tops`` of the greatest length of each row's band."""
        return np.minimum(np.searchsorted(self.tops, np.linalg.norm(vectors, axis=1)), len(self.tops) - 1)

    def extended(self, vectors: np.ndarray, bands: np.ndarray) -> np.ndarray:
        units = vectors / self.tops[bands, None]
        return np.column_stack([units, np.sqrt(np.maximum(0, 1 - (units**2).sum(1)))])

    def of_rows(self, vectors: np.ndarray, bands: np.ndarray) -> np.ndarray:
        return self._pack(self.extended(vectors, bands) @ self.projection)

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return self._pack(vectors @ self.projection[:-1])

    def _pack(self, projected: np.ndarray) -> np.ndarray:
        return np.packbits(projected > 0, axis=1)


@cache
def _flips(p: int) -> np.ndarray:
    """Bytes with ``p`` bits."""
    every = np.arange(256, dtype=np.uint8)
    return every[np.bitwise_count(every) == p]


class MultiIndex:
    """Tables of the bytes of codes."""

    def __init__(self, codes: np.ndarray):
        self.n, self.tables = codes.shape
        self.words = np.ascontiguousarray(np.ascontiguousarray(codes).view(np.uint64).T)
        order = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        self.order = order.T.ravel()
        starts = [np.searchsorted(codes[order[:, j], j], np.arange(257)) + j * self.n for j in range(self.tables)]
        self.starts = np.array(starts, np.int32)

    def probe(self, code: np.ndarray, p: int) -> np.ndarray:
        """Rows of which a byte differs from the query's in ``p`` bits; rows may repeat."""
        values = (code[:, None] ^ _flips(p)).astype(np.int64)
        table = np.arange(self.tables)[:, None]
        starts = self.starts[table, values].ravel()
        sizes = self.starts[table, values + 1].ravel() - starts
        ends = np.cumsum(sizes)
        return self.order[np.arange(ends[-1], dtype=np.int32) + np.repeat((starts - ends + sizes).astype(np.int32), sizes)]

    def distances(self, rows: np.ndarray, code: np.ndarray) -> np.ndarray:
        counts = (np.bitwise_count(word[rows] ^ own) for word, own in zip(self.words, code.view(np.uint64)))
        return sum(counts, np.zeros(len(rows), np.int16))


class Probing:
    """One query's way through one band: the codes seen so far and what unseen ones may reach."""

    def __init__(self, index: MultiIndex, code: np.ndarray, top: float, other: np.ndarray):
        self.index, self.code, self.other = index, code, other
        self.estimates = top * np.cos(np.pi / BITS * np.arange(BITS + 2))  # by distance
        self.seen = np.zeros(index.n, bool)
        self.level = 0
        self.rows, self.found = np.empty(0, np.int64), np.empty(0)

    @property
    def unseen(self) -> float:
        """The greatest estimate that a code not seen yet may have."""
        return -math.inf if self.level > 8 else self.estimates[self.level * self.index.tables]

    def further(self) -> None:
        """Probe bytes one bit further off."""
        met = np.zeros(self.index.n, bool)
        met[self.index.probe(self.code, self.level)] = True
        new = np.flatnonzero(met & ~self.seen & self.other)
        self.seen |= met
        self.level = 9 if self.seen.all() else self.level + 1
        self.rows = np.append(self.rows, new)
        self.found = np.append(self.found, self.estimates[self.index.distances(new, self.code)])


class Block:
    """Multi-indexes of the bands of a block."""

    def __init__(self, codes: Codes, data: np.ndarray):
        bands = codes.bands(data)
        packed = codes.of_rows(data, bands)
        self.parts = []
        for band in np.unique(bands):
            rows = np.flatnonzero(bands == band)
            self.parts.append((rows, MultiIndex(packed[rows]), codes.tops[band]))

    def candidates(self, code: np.ndarray, least: int, own: np.ndarray) -> np.ndarray:
        """The ``least`` rows of greatest estimates and all whose estimates are not below the last of
        them; rows that ``own`` marks are neither counted nor returned."""
        ways = [Probing(index, code, top, ~own[rows]) for rows, index, top in self.parts]
        while True:
            best = max(ways, key=lambda way: way.unseen)
            found = np.concatenate([way.found for way in ways])
            if best.unseen == -math.inf or np.count_nonzero(found > best.unseen) >= least:
                break
            best.further()
        limit = np.partition(found, len(found) - least)[-least] if len(found) > least else -math.inf
        return np.concatenate([rows[way.rows[way.found >= limit]] for way, (rows, _, _) in zip(ways, self.parts)])


def search(rows: DataFrame, queries: DataFrame, k: int, sample: int = SAMPLE, id_column: str = "vec_id", vector_column: str = "embedding", candidates: int | None = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product found for each query.

    ``candidates`` codes of each block are reranked at least, or ``k`` if that is more; with None all are
    and the result is exact.
    """
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    named = [F.col(id_column).cast("long").alias("id"), vector.alias("vector")]
    rows = rows.select(*named).where(usable(F.col("vector")) & F.col("id").isNotNull())
    rows = keep(rows.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("n")), "vectors")
    queries = queries.select(*named).where(usable(F.col("vector")) & F.col("id").isNotNull())
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = [r.vector for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    if not drawn:
        return empty
    size = max(sorted({len(v) for v in drawn}), key=[len(v) for v in drawn].count)
    rows, queries = (df.where(F.size("vector") == size) for df in (rows, queries))
    queries = keep(queries.groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    n_rows, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    n_queries = queries.count()
    if not n_queries:
        return empty
    codes = Codes(np.array([v for v in drawn if len(v) == size]), math.sqrt(longest))
    blocks, chunks = -(-n_rows // BLOCK_ROWS), -(-n_queries // CHUNK_QUERIES)

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        # A repeated id is in many blocks. Both sides need keys of one type, or equal keys are shuffled apart.
        part = F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int").alias(own)
        return df.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = dealt(rows, "block", blocks, "chunk", chunks).groupBy("block", "chunk")
    right = dealt(queries, "chunk", chunks, "block", blocks).groupBy("block", "chunk")
    found = left.cogroup(right).applyInPandas(_searched(codes, k, candidates), "query_id long, vec_id long, score double")
    ranked = found.selectExpr("query_id", "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def _searched(codes: Codes, k: int, candidates: int | None):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(queries):
            ids, times, data = rows["id"].to_numpy(), np.minimum(rows["n"].to_numpy(), k), np.stack(rows["vector"].to_list())
            block = None if candidates is None else Block(codes, data)
            asked = np.stack(queries["vector"].to_list())
            for query_id, query, code in zip(queries["id"], asked, codes.of_queries(asked)):
                own = ids == query_id
                near = np.flatnonzero(~own) if block is None else block.candidates(code, max(k, candidates), own)
                if len(near) > k:  # those that may be among the first k, whatever the rounding
                    rough = data[near] @ query
                    limit = np.partition(rough, len(rough) - k)[-k]
                    near = near[rough >= limit - 1e-9 * (1 + abs(limit))]
                score = (data[near] * query).sum(1)
                first = np.lexsort((ids[near], -score))[:k]
                first = np.repeat(first, times[near[first]])[:k]
                out += zip([query_id] * len(first), ids[near[first]].tolist(), score[first].tolist())
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run
