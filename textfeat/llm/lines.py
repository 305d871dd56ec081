"""Line dedup by overlapping windows of three lines.

Lines are what lies between newlines. Every three consecutive lines of a document are a window,
unless all are blank. A window that occurs more than once stays where it occurs first, by document
id, hash of the text and position; wherever else it occurs its three lines are covered. All lines
that some window covers are removed at once, so overlapping windows take out a long passage whole.

A text of fewer than three lines, an empty or null one is left as it is. A text that loses all lines
becomes empty; its row stays. Null ids come first. Rows equal in id and text are one document for
the order of occurrences and lose the same lines. Other columns, whatever their names, are kept. An
empty table gives an empty table.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import keep

WINDOW = 3


def windows(text: Column, width: int = WINDOW) -> Column:
    """Windows of a text as an array of ``pos, a, b``: first line (from 0) and 128 bits of hash."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"), (F.trim(line) != "").alias("filled")))

    def of(rows: Column) -> Column:
        def one(i: Column) -> Column:
            these = [F.element_at(rows, i + j) for j in range(width)]
            filled = these[0]["filled"]
            for line in these[1:]:
                filled = filled | line["filled"]
            return F.struct((i - 1).alias("pos"), F.xxhash64(*(t["a"] for t in these)).alias("a"), F.xxhash64(*(t["b"] for t in these)).alias("b"), filled.alias("filled"))

        many = F.filter(F.transform(F.sequence(F.lit(1), F.size(rows) - (width - 1)), one), lambda w: w["filled"])
        return F.when(F.size(rows) >= width, many)

    return F.transform(F.array(lines), of)[0]


def covered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WINDOW) -> DataFrame:
    """``doc_id, tie, starts``: first lines of the windows that each document loses."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    every = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("tie"), F.explode(windows(text, width)).alias("w"))
    every = keep(every.select("doc_id", "tie", "w.pos", "w.a", "w.b"), "windows")
    place = F.struct("doc_id", "tie", "pos")
    repeated = every.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # Staged, so that the join can split the rows of a very frequent window.
    repeated = keep(repeated.where("n > 1").drop("n"), "repeated-windows")
    later = every.join(repeated, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "tie").agg(F.collect_set("pos").alias("starts"))


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WINDOW) -> DataFrame:
    """All columns and rows of ``docs``, the text without the lines that windows cover."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(text).alias("tie"))
    lost = covered(docs, id_column, text_column, width).select(F.col("doc_id").alias("lost_id"), F.col("tie").alias("lost_tie"), "starts")
    same = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("tie") == F.col("lost_tie"))
    joined = rows.join(lost, same, "left")
    short = _without(width)(F.when(F.col("starts").isNotNull(), F.col("text")), "starts")  # other texts stay in the JVM
    names = docs.columns
    return joined.select(*(F.coalesce(short, F.col("text")).alias(c) if c == text_column else F.col("row")[c].alias(c) for c in names))


def _without(width: int):
    @F.pandas_udf("string")
    def without(texts: pd.Series, starts: pd.Series) -> pd.Series:
        def one(text, found):
            if text is None:
                return None
            gone = {p + j for p in found for j in range(width)}
            return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)

        return pd.Series([one(t, s) for t, s in zip(texts, starts)], dtype=object)

    return without
