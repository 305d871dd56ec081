"""Document fingerprints: threshold-scaled sketches of word shingles, by SQL functions only.

A sketch holds every different shingle hash below a fixed fraction of the hash range. It grows with
the text, so a short text can be looked for in a long one; sketches of parts of a text merge by
union. Shingles are ``SHINGLE`` consecutive words, words being runs of characters other than ASCII
white space. A text with fewer words has one shingle, the whole sequence; one without words, a null
one included, has an empty sketch. A text whose hashes all lie above the limit keeps its smallest, so
that different short texts are told apart; merging drops it where another hash is below. Containment of such
a sketch is not an estimate: a longer text with a hash below the limit drops that hash, so 0 does not
mean that the short text is not in it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import words

SHINGLE = 5
FRACTION = 0.25


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Sorted different shingle hashes that lie in the lowest ``fraction`` of the range of a long."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(h) - (shingle - 1))
        full = F.transform(places, lambda i: F.xxhash64(*(F.element_at(h, i + j) for j in range(shingle))))
        short = F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " ")))
        return F.when(F.size(h) >= shingle, full).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))

    # One round of a loop gives the hashes a name; written out, they would be computed at every use.
    found = F.transform(F.array(hashes), shingles)[0]
    return F.transform(F.array(found), lambda every: _retained(every, fraction))[0]


def _retained(hashes: Column, fraction: float) -> Column:
    """Sorted different hashes below the limit; the smallest one where there are none."""
    limit = F.lit(int(-(2**63) + fraction * 2**64))
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda x: x < limit)))
    # Mostly one of the first hashes is below; only where none is, the smallest is looked for.
    return F.when(F.exists(hashes, lambda x: x < limit), below).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)


def fingerprint(sketch: Column) -> Column:
    """A sketch as text, 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def containment(ours: Column, theirs: Column) -> Column:
    """Estimated share of our shingles that are also theirs, 0 to 1; an empty sketch is in an empty one only.

    No estimate where ours is a fallback, one hash above the limit: 0 then says nothing.
    """
    share = F.size(F.array_intersect(ours, theirs)) / F.size(ours)
    return F.when(F.size(ours) > 0, share).otherwise(F.when(F.size(theirs) == 0, 1.0).otherwise(0.0))


def merge(ours: Column, theirs: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two texts together, both made with ``fraction``."""
    return F.transform(F.array(F.array_union(ours, theirs)), lambda both: _retained(both, fraction))[0]


def _bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Quantiles of the ids, by a job over the id column; as many numbers as buckets."""
    found = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0]
    return found or []


def with_next(docs: DataFrame, buckets: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, sketch, next_text, next_sketch``: every document beside the next by descending id.

    After the last comes the first. Null ids come last, equal ids by descending hash of the text, so
    repeated ids have a fixed order as far as their texts differ. A single document is its own next;
    an empty table gives an empty result.

    Texts are shuffled once, into ranges of ids, each sorted for itself; the first document of a
    range is also sent to the range before it. Null ids and ids with a quantile to themselves are
    spread over ranges of their text's hash.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    bounds = _bounds(source, buckets)
    different = sorted(set(bounds))
    hot = sorted({b for b in different if bounds.count(b) > 1})
    tie = F.xxhash64("text")
    part = F.when(F.col("doc_id").isNull() | (F.col("doc_id").isin(hot) if hot else F.lit(False)), F.shiftright(tie, 56) + 128)
    # Descending: the place among the bounds counts down; a hot id has a range of its own.
    above = _rank(F.col("doc_id"), different)
    exact = F.when(F.col("doc_id").isin(hot), 1).otherwise(0) if hot else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(2 * len(different) + 2)).otherwise(2 * (len(different) - above) + 1 - exact)
    rows = source.select("doc_id", "text", tie.alias("tie"), (bucket * 256 + 255 - F.coalesce(part, F.lit(0))).cast("long").alias("bucket"))

    # One row for each range: its first document, and the range before it; after the last the first.
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")).alias("head")
    heads = rows.groupBy("bucket").agg(first)
    heads = heads.selectExpr("head.doc_id AS head_id", "head.tie AS head_tie", "lag(bucket) OVER (ORDER BY bucket) AS before", "max(bucket) OVER () AS last")
    heads = heads.select("head_id", "head_tie", F.coalesce("before", "last").alias("guest_of"))
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    guests = rows.drop("bucket").join(F.broadcast(heads), same)  # at most 512 times as many rows as ``buckets``
    # Of equal rows one goes to the range before.
    heads = guests.groupBy("doc_id", "tie", F.col("guest_of").alias("bucket")).agg(F.first("text").alias("text"))

    every = rows.withColumn("guest", F.lit(False)).unionByName(heads.withColumn("guest", F.lit(True)))
    every = every.repartition("bucket").withColumn("sketch", sketch(F.col("text")))
    window = "(PARTITION BY bucket ORDER BY guest, doc_id DESC NULLS LAST, tie DESC)"
    every = every.selectExpr("doc_id", "text", "sketch", "guest", f"lead(struct(text, sketch)) OVER {window} AS next")
    return every.where("NOT guest").select("doc_id", "text", "sketch", F.col("next.text").alias("next_text"), F.col("next.sketch").alias("next_sketch"))


def _rank(value: Column, bounds: list[int]) -> Column:
    """Number of bounds below ``value``, by a search in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.array(*map(F.lit, bounds[::step]))
    slices = F.array(*(F.array(*map(F.lit, bounds[i : i + step])) for i in range(0, len(bounds), step)))
    place = F.size(F.filter(coarse, lambda b: b < value))
    within = F.size(F.filter(F.get(slices, place - 1), lambda b: b < value))
    return F.when(place == 0, 0).otherwise((place - 1) * step + within)
