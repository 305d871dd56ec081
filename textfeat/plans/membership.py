"""Whether a row's key is in a set of any size, decided within the row.

Rows that carry whole texts should not be shuffled to learn whether they are wanted. Where the wanted
keys are few they are broadcast. Of many, a bitmap is: one bit for the hash of each wanted key. Some
unwanted keys share a bit with a wanted one; as all keys are known beforehand, these are found and
make the next bitmap, of keys to be turned away, on which again some wanted keys fall, and so on. Each
level is smaller by the share of bits set, and what is left in the end is broadcast as it is. So the
answer is exact, bitmaps have a bound, and only keys are ever shuffled.

A bitmap is kept in blocks of 32,768 bits, each a row of 4 KB, and a row finds its block by a broadcast
join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.plans import sizing
from textfeat.plans.staging import stage

BLOCK_BITS = 32_768
# Bits for each key of a level, and at most (256 MB).
BITS_PER_KEY = 16
MOST_BITS = 1 << 31


def _place(key: Column, n_bits: int, level: int) -> Column:
    """Bit of a key, another one at every level."""
    return F.pmod(F.xxhash64(F.lit(level), key), F.lit(n_bits))


def _bitmap(keys: DataFrame, n_bits: int, level: int) -> DataFrame:
    """``block, bits binary``. Different bits are few enough a task to be combined before the shuffle."""
    places = keys.select(_place(F.col("key"), n_bits, level).alias("place"))
    block = F.floor(F.col("place") / BLOCK_BITS)
    return places.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(F.col("place") % BLOCK_BITS).alias("bits"))


def _marked(rows: DataFrame, key: Column, bitmap: DataFrame, n_bits: int, level: int) -> DataFrame:
    """``rows`` with ``marked``: whether the bit of the key is set."""
    name = f"block_{level}"
    place = _place(key, n_bits, level)
    found = rows.withColumn(name, F.floor(place / BLOCK_BITS)).join(F.broadcast(bitmap.withColumnRenamed("block", name)), name, "left")
    within = place % BLOCK_BITS
    byte = F.conv(F.hex(F.substring("bits", (F.floor(within / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), within % 8)) % 2 == 1
    return found.withColumn("marked", F.col("bits").isNotNull() & bit).drop(name, "bits")


def keep_members(rows: DataFrame, key: str, every: DataFrame, max_rows: int = sizing.BROADCAST_ROWS) -> DataFrame:
    """The rows whose ``key`` is wanted; ``rows`` are not shuffled.

    ``every`` has each key that may occur, once, as ``key`` with ``wanted boolean``. Where more than
    ``max_rows`` are wanted it is staged, as each level reads it. Keys that are null or not in ``every``
    go by chance: leave them out before.
    """
    wanted = every.where("wanted").select(F.col("key").alias(key))
    if sizing.is_small(wanted, max_rows):
        return rows.join(F.broadcast(wanted), key, "left_semi")
    every = stage(every.select("key", "wanted"), "keys")
    # Whole rows travel in one column, so names cannot clash; undecided until a bit says no.
    rows = rows.select(F.col(key).alias("key"), F.struct("*").alias("row"), F.lit(None).cast("boolean").alias("decided"))
    left, side, level = every, True, 0
    while True:
        inside = left.where(F.col("wanted") if side else ~F.col("wanted")).select("key")
        if sizing.is_small(inside, max_rows):
            # Of the undecided, those listed belong to this side and the others to the other one.
            listed = F.broadcast(inside.select(F.col("key").alias("listed")))
            member = rows.join(listed, F.col("decided").isNull() & (F.col("key") == F.col("listed")), "left")
            answer = F.coalesce("decided", F.col("listed").isNotNull() if side else F.col("listed").isNull())
            return member.where(answer).select("row.*")
        n_bits = min(MOST_BITS, BITS_PER_KEY * inside.count())
        n_bits = -(-n_bits // BLOCK_BITS) * BLOCK_BITS
        bitmap = stage(_bitmap(inside, n_bits, level), "bitmap")
        rows = _marked(rows, F.col("key"), bitmap, n_bits, level)
        rows = rows.withColumn("decided", F.coalesce("decided", F.when(~F.col("marked"), not side))).drop("marked")
        left = stage(_marked(left, F.col("key"), bitmap, n_bits, level).where("marked").drop("marked"), "undecided")
        side, level = not side, level + 1
