"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are the bitwise majority of the XXH64 (seed 42) of word shingles. Equal fingerprints
are grouped first; all further work is on different ones. Two that differ in at most three bits
agree in one of four blocks of 16 bits, so each fingerprint is dealt four times, by a hash of each block,
to so many cells that each holds some thousands. In a cell fingerprints are turned until the block leads,
sorted by Gray rank and put under a tree whose nodes hold the bits that all fingerprints below share;
two nodes are compared on the bits both hold, and where more than the threshold differ, no pair below
them is looked at. A node's bits include those of the nodes above it, so differences add up on the way
down.

A cell returns each fingerprint linked to the least of its group, never all pairs. Cells of more
than ``CELL_ROWS`` are split: their rows are dealt to parts by hash and every pair of parts is a cell
of its own. The groups of all cells are joined by rounds of large and small stars.

Null texts count as empty; a text without words has fingerprint zero, which links like any other.
Null ids are documents; a component without any other id has a null id. Repeated rows are documents
of their own, linked by their equal fingerprints. An empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import keep, words
from textfeat.plans.staging import release

SHINGLE = 3
DISTANCE = 3
CELL_ROWS = 8192

# Cells of a block at most, as the crowded ones are broadcast.
BLOCK_CELLS = 65536

# Children of a node; fingerprints under a node of the lowest level.
FANOUT = 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of all shingles, repeats included; a shorter text is one shingle."""
    found = words(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()))

    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - (shingle - 1))
        full = F.transform(places, lambda i: F.xxhash64(F.concat_ws(" ", *(F.element_at(w, i + j) for j in range(shingle)))))
        short = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= shingle, full).when(F.size(w) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(found), hashes)[0]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, tie, fp`` of every document; ``tie`` is a hash of the text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("tie"), shingle_hashes(text, shingle).alias("hashes"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_majorities, f"doc_id {id_type}, tie long, fp long")


def _majorities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("hashes")
        ends = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy()[: ends[-1]].view(np.uint64)
        sizes = np.diff(ends)
        full = np.flatnonzero(sizes)
        fp = np.zeros(len(sizes), np.uint64)
        for begin in range(0, len(full), 512):  # few enough to stay in the processor's cache
            some = full[begin : begin + 512]
            first, last = ends[some[0]], ends[some[-1] + 1]
            part, at = values[first:last], ends[some] - first
            for bit in range(64):
                count = np.add.reduceat((part >> np.uint64(bit)) & np.uint64(1), at)
                fp[some] |= (2 * count > sizes[some].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(fp.view(np.int64))], ["doc_id", "tie", "fp"])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the order of the reflected Gray code."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Tree over fingerprints in Gray order; ``parent`` takes up the groups found."""

    def __init__(self, codes: np.ndarray, distance: int = DISTANCE):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.distance = distance
        self.parent = np.arange(len(codes))
        # Pairs of nodes compared, and of fingerprints.
        self.node_pairs = self.code_pairs = 0
        # From the fingerprints up: bits shared below a node and their values.
        self.levels = [(np.full(len(codes), ~np.uint64(0)), self.codes)]
        while len(self.levels[-1][0]) > FANOUT:
            mask, value = self.levels[-1]
            starts = np.arange(0, len(mask), FANOUT)
            first = np.repeat(value[starts], np.diff(np.append(starts, len(mask))))
            shared = np.bitwise_and.reduceat(mask & ~(value ^ first), starts)
            self.levels.append((shared, value[starts] & shared))

    def link(self) -> None:
        """Group all fingerprints within the distance of each other, directly or by others."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        i, j = np.triu_indices(n, 0 if top else 1)
        todo = [(top, i, j)]
        while todo:
            level, i, j = todo.pop()
            mask, value = self.levels[level]
            if level:
                self.node_pairs += len(i)
            else:
                self.code_pairs += len(i)
            near = np.bitwise_count((value[i] ^ value[j]) & mask[i] & mask[j]) <= self.distance
            i, j = i[near], j[near]
            if not len(i):
                continue
            if not level:
                self._union(i, j)
                continue
            for begin in range(0, len(i), 4096):  # bounds what is held at a time
                todo.append((level - 1, *self._below(level, i[begin : begin + 4096], j[begin : begin + 4096])))

    def _below(self, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(FANOUT)
        a = (i[:, None, None] * FANOUT + step[:, None] + 0 * step).reshape(-1)
        b = (j[:, None, None] * FANOUT + step + 0 * step[:, None]).reshape(-1)
        n = len(self.levels[level - 1][0])
        kept = (a < n) & (b < n) & ((a < b) if level == 1 else (a <= b))
        return a[kept], b[kept]

    def _union(self, i: np.ndarray, j: np.ndarray) -> None:
        parent = self.parent
        while True:
            a, b = parent[i], parent[j]
            apart = a != b
            if not apart.any():
                return
            a, b, i, j = a[apart], b[apart], i[apart], j[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]


def links(different: DataFrame, distance: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``u, v``: each fingerprint of ``different`` (``fp``) linked to another of its group in a cell.

    There is one block more than bits may differ, and four at least, so that one block agrees. Narrower
    blocks make larger cells.
    """
    if not 0 <= distance < 64:
        raise ValueError(f"distance {distance} is not in 0 to 63")
    blocks = max(4, distance + 1)
    # Half full on average; the crowded ones are split below.
    cells = min(BLOCK_CELLS, max(1, 2 * different.count() // cell_rows))
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    dealt = different.select("fp", block)
    # Block b holds the bits from 64 b // blocks on, up to the next block.
    value = F.expr(f"shiftrightunsigned(fp, int(64 * block div {blocks})) & (shiftleft(1L, int(64 * (block + 1) div {blocks} - 64 * block div {blocks})) - 1)")
    dealt = dealt.withColumn("cell", (F.col("block") * cells + F.pmod(F.xxhash64(value), F.lit(cells))).cast("int")).drop("block")
    hot = keep(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows), "hot-cells")
    dealt = dealt.join(F.broadcast(hot), "cell", "left")
    parts = F.coalesce(F.ceil(F.col("n") / cell_rows), F.lit(1)).cast("int")
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    dealt = dealt.select("fp", "cell", part.alias("part"), other)
    dealt = dealt.select("fp", "cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    return dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high").mapInArrow(_grouped(distance, blocks, cells), "u long, v long")


def _grouped(distance: int, blocks: int, cells: int):
    def stars_of(held: list[np.ndarray], cell: int) -> np.ndarray:
        return _stars(held, distance, 64 - 64 * (cell // cells + 1) // blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("cell", "low", "high")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            out = []
            for begin, end in zip([0, *cuts], [*cuts, len(fp)]):
                if key is not None and key != tuple(keys[begin]):
                    out.append(stars_of(held, key[0]))
                    held = []
                key = tuple(keys[begin])
                held.append(fp[begin:end])
            yield _edges(out)
        yield _edges([stars_of(held, key[0])] if held else [])

    return run


def turned(codes: np.ndarray, by: int) -> np.ndarray:
    """Words rotated to the left."""
    by %= 64
    return codes if not by else (codes << np.uint64(by)) | (codes >> np.uint64(64 - by))


def _stars(held: list[np.ndarray], distance: int, by: int) -> np.ndarray:
    """Links of a cell whose block leads after a rotation to the left."""
    codes = np.concatenate(held).view(np.uint64)
    if len(codes) < 2:
        return np.empty((0, 2), np.int64)
    index = GrayIndex(turned(codes, by), distance)
    index.link()
    codes = turned(index.codes, -by).view(np.int64)
    found = np.flatnonzero(index.parent != np.arange(len(codes)))
    return np.column_stack([codes[found], codes[index.parent[found]]])


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["u", "v"])


def stars(edges: DataFrame) -> DataFrame:
    """``u, v``: every node with an edge beside the least node of its component, itself left out.

    Rounds of large and small stars; each ends in a staged table, so no lineage grows.
    """
    edges = keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = keep(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = keep(large.distinct(), "large")
        lowest = keep(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = keep(moved.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "small")
        for done in (edges, both, least, large, lowest):
            release(done)
        edges = small
        found = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == state:
            return edges
        state = found


def components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, tie, fp, root, component_id`` of every document.

    ``component_id`` is the smallest id reachable by links; ``root`` names the component where ids
    are null.
    """
    found = keep(fingerprints(docs, id_column, text_column), "fingerprints")
    different = keep(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    roots = stars(links(different)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    labelled = different.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    labelled = keep(labelled, "labelled")
    least = keep(labelled.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    named = keep(labelled.join(least, "root").select("fp", "root", "component_id"), "named")
    return found.join(named, "fp").select("doc_id", "tie", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` with all columns, one of each component: that with the smallest id.

    Nulls come last, equal ids in order of the text's hash; of equal rows one stays.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie")
    found = components(docs, id_column, text_column)
    kept = found.groupBy("root").agg(F.min(rank).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("kept_id"), F.col("k.tie").alias("kept_tie"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.xxhash64(text).alias("tie"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie"))
    kept = keep(kept, "kept")
    # From the staged fingerprints: the texts are not read again.
    counts = keep(found.groupBy(F.col("doc_id").alias("id"), "tie").count().where("count > 1"), "repeated-rows")
    stay = rows.join(kept, same, "left_semi")
    if counts.isEmpty():
        return stay.select("row.*")
    again = F.col("id").eqNullSafe(F.col("again_id")) & (F.col("tie") == F.col("again_tie"))
    counts = counts.select(F.col("id").alias("again_id"), F.col("tie").alias("again_tie"))
    once = stay.join(counts, again, "left_semi").groupBy("id", "tie").agg(F.first("row").alias("row"))
    return stay.join(counts, again, "left_anti").select("row.*").unionAll(once.select("row.*"))
