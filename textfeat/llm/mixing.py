"""Mixing of sources to target weights by weighted fair queueing, by SQL functions only.

Each source plays its documents in a shuffled order, again from the start when it is through. A
document finishes at the virtual time (words its source has played so far) / (target of the source).
All sources are merged by that time and the queue is cut at the total budget, so every source has
then played about its target.

The order of a source is that of ``md5(seed:id:md5(text))``, cut into buckets by its leading digits;
words are summed by bucket first and only within a bucket row by row, so no source is sorted as a whole,
and documents of one id spread over the buckets. Equal rows have one place in the order: they are one row
with a count until the words before them are known, and then follow each other. The cut is found the same
way: virtual time is sliced evenly, and as every slice holds about as many words, only the slice in which
the budget ends is queued document by document.

Null texts and texts without words have size 0 and are never taken. The null source is a source.
Rows with equal ids are documents of their own. No rows give no rows. Other columns, whatever their names,
are not read by ``mix`` and pass through ``sequence``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import keep, words
from textfeat.plans import sizing

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEATS = 2

# Documents of a bucket on average; what one task sorts is a few of them.
BUCKET_ROWS = 10_000
# Equal rows that one row of a task is unfolded to.
UNFOLDED = 65_536


def word_count(text: str = "text") -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.size(words(text)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` of every source in ``sizes`` (``source, size``).

    Sources in order of code points, null last, weigh ``weights`` in turn. They share ``budget``
    times all sizes by weight; a target stops at ``repeats`` times the size of its source, and what
    is above goes to the others by weight. In order of limit per weight, the first sources reach
    their limits; from the first on that does not, all share what is left. Works on one row per
    source, which one task orders.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.selectExpr("*", "row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place", f"{budget}D * sum(source_size) OVER () AS total")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", turn.cast("double")).withColumn("most", repeats * F.col("source_size").cast("double"))
    order = "(ORDER BY most / weight, place ROWS BETWEEN"
    filled = ranked.selectExpr("*", f"coalesce(sum(most) OVER {order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS before", f"sum(weight) OVER {order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared")
    filled = filled.withColumn("first", F.expr("min(CASE WHEN most * shared > (total - before) * weight THEN struct(most / weight, place, (total - before) / shared AS level) END) OVER ()"))
    return filled.select("source", "source_size", F.least("most", F.coalesce(F.col("weight") * F.col("first.level"), "most")).alias("target"))


def mix(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``doc_id, tie, source, size, source_size, target, finish, times`` for every document.

    ``times`` says how often the mix takes the document whole, from 0 to ``repeats``; ``finish`` is
    its virtual finish time in the first round; ``tie`` is a hash of the text. Documents that finish at the same time are taken
    together or not at all.
    """
    turn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_column), F.lit("")))))
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), _tie(text_column), word_count(text_column).alias("size"), turn.alias("turn"))
    narrow = keep(narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("rows")).withColumn("words", F.col("size") * F.col("rows")), "sizes")
    n_rows = narrow.count()
    # Hexadecimal digits of the shuffle that name a bucket.
    digits = 1
    while n_rows > BUCKET_ROWS * 16**digits:
        digits += 1
    targets = source_targets(narrow.select("source", F.col("words").alias("size")), weights, budget, repeats)
    shuffled = narrow.withColumn("bucket", F.substring("turn", 1, digits))
    offsets = shuffled.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    offsets = offsets.selectExpr("source AS in_source", "bucket AS in_bucket", "sum(words) OVER (PARTITION BY source ORDER BY bucket) - words AS before")
    targets = targets.withColumnRenamed("source", "of_source")
    offsets = offsets.join(targets, F.col("in_source").eqNullSafe(F.col("of_source"))).drop("of_source")

    same = F.col("source").eqNullSafe(F.col("in_source")) & (F.col("bucket") == F.col("in_bucket"))
    played = shuffled.selectExpr("*", "sum(words) OVER (PARTITION BY source, bucket ORDER BY turn, doc_id, size, tie ROWS UNBOUNDED PRECEDING) - words AS within")
    played = _unfolded(played.join(sizing.broadcast_if_small(offsets), same))
    played = played.select("doc_id", "tie", "source", "size", "source_size", "target", (F.col("before") + F.col("within") + F.col("size") * F.col("nth")).alias("played"))
    played = keep(played, "played")

    slices = 16**digits
    finishes = [F.try_divide(F.col("played") + r * F.col("source_size"), "target") for r in range(repeats)]
    queue = played.where("size > 0 AND target > 0").select("size", F.explode(F.array(*finishes)).alias("finish"))
    queue = queue.withColumn("slice", F.floor(F.col("finish") * slices))
    by_slice = queue.groupBy("slice").agg(F.sum("size").alias("words"))
    by_slice = by_slice.selectExpr("slice", "sum(words) OVER (ORDER BY slice) AS total", "words")
    end = narrow.agg(F.sum("words")).first()[0] or 0
    full = by_slice.where(F.col("total") > budget * end).orderBy("slice").select("slice", (F.col("total") - F.col("words")).alias("before")).first()
    if full is None:  # the budget holds every round of every document
        return _answer(played, sum((F.when(f.isNotNull(), 1).otherwise(0) for f in finishes), F.lit(0)))
    at_cut = queue.where(F.col("slice") == full.slice).selectExpr("finish", "sum(size) OVER (ORDER BY finish) AS total")
    limit = at_cut.where(F.col("total") <= budget * end - full.before).agg(F.max("finish")).first()[0]
    taken = (F.when(F.floor(f * slices) < full.slice, 1).when(f <= F.lit(limit), 1).otherwise(0) for f in finishes)
    return _answer(played, sum(taken, F.lit(0)))


def _unfolded(grouped: DataFrame) -> DataFrame:
    """Each of ``rows`` equal rows again, numbered from 1 by ``nth``. Groups that are too large for one
    row are cut first and their pieces dealt to all tasks."""
    each = F.explode(F.sequence(F.col("first"), F.least(F.col("first") + (UNFOLDED - 1), "rows"))).alias("nth")
    small = grouped.where(F.col("rows") <= UNFOLDED).withColumn("first", F.lit(1).cast("long"))
    large = grouped.where(F.col("rows") > UNFOLDED)
    tasks = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = large.withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"), F.lit(UNFOLDED).cast("long"))))
    return small.unionByName(pieces.repartition(tasks, "first", "turn")).select("*", each)


def _answer(played: DataFrame, times: Column) -> DataFrame:
    times = F.when((F.col("size") > 0) & (F.col("target") > 0), times).otherwise(0)
    finish = F.try_divide("played", "target")
    return played.select("doc_id", "tie", "source", "size", "source_size", "target", finish.alias("finish"), times.cast("int").alias("times"))


def _tie(text_column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("tie")


def sequence(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **settings) -> DataFrame:
    """The mix itself: all columns of ``docs``, a row each time a document is taken.

    Range-sorted by virtual finish time: partitions follow each other and are sorted within. Equal
    rows are put together and taken as often as all of them.
    """
    mixed = mix(docs, id_column=id_column, text_column=text_column, source_column=source_column, **settings)
    rounds = mixed.groupBy("doc_id", "tie", "source").agg(F.sum("times").alias("times"), F.min("finish").alias("finish"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.count(F.lit(1)).alias("rows"))
    taken = rounds.where("times > 0").select(*(F.col(c).alias(f"mix_{c}") for c in rounds.columns))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("doc_id"), _tie(text_column), F.col(source_column).alias("source"))
    same = F.col("doc_id").eqNullSafe(F.col("mix_doc_id")) & (F.col("tie") == F.col("mix_tie")) & F.col("source").eqNullSafe(F.col("mix_source"))
    joined = rows.join(taken, same)
    # Of equal rows one stands for all. Only their texts are moved, one from each task.
    if not rounds.where("rows > 1").isEmpty():
        several = joined.where("mix_rows > 1").groupBy("doc_id", "tie", "source")
        first = several.agg(F.min_by(F.struct(*joined.columns), F.xxhash64(F.to_json("row"))).alias("first"))
        joined = joined.where("mix_rows = 1").unionByName(first.select("first.*"))
    again = F.explode(F.sequence(F.lit(0), F.col("mix_times").cast("int") - 1)).alias("round")
    every = joined.select("row", "doc_id", "tie", "mix_finish", F.try_divide("mix_source_size", "mix_target").alias("lap"), again)
    every = every.withColumn("finish", F.col("mix_finish") + F.col("round") * F.col("lap"))
    return every.repartitionByRange("finish").sortWithinPartitions("finish", "doc_id", "tie").select("row.*")
