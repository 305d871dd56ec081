"""Fitted decision trees as tables: a row for each node, with what its split does to the documents.

A node is numbered as in a heap: the root is 1, the children of n are 2 n (at most the threshold) and
2 n + 1. How many documents reach a node is counted by sending every document down the tree in one pass,
not taken from the model, so the table shows what the tree does.
"""

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Node = tuple[int, int | None, float | None, float, float | None, float]

NODE_SCHEMA = "node bigint, bin bigint, threshold double, impurity double, gain double, prediction double"


def nodes(model: DecisionTreeClassificationModel) -> list[Node]:
    """``node, bin, threshold, impurity, gain, prediction``; leaves have no split. As many as the tree has."""
    found: list[Node] = []
    todo = [(1, model._call_java("rootNode"))]
    while todo:
        number, node = todo.pop()
        if node.subtreeDepth():
            split = node.split()
            found.append((number, int(split.featureIndex()), float(split.threshold()), float(node.impurity()), float(node.gain()), float(node.prediction())))
            todo += [(2 * number, node.leftChild()), (2 * number + 1, node.rightChild())]
        else:
            found.append((number, None, None, float(node.impurity()), None, float(node.prediction())))
    return sorted(found)


def visits(rows: DataFrame, tree: Sequence[Node], *others: str) -> DataFrame:
    """``others, node, label, goes_right`` for every node that a document of ``rows`` (``label,
    features``) comes through; ``goes_right`` is null at a leaf."""
    by_number = {n[0]: n for n in tree}
    passed: dict[int, Column] = {1: F.lit(True)}

    def right(node: Node) -> Column:
        return F.get("entries", F.lit(node[1])) > node[2]

    steps = []
    for number in sorted(by_number):
        node = by_number[number]
        goes = right(node) if node[1] is not None else F.lit(None).cast("boolean")
        steps.append(F.when(passed[number], F.struct(F.lit(number).cast("bigint").alias("node"), goes.alias("goes_right"))))
        if node[1] is not None:
            passed[2 * number] = passed[number] & ~right(node)
            passed[2 * number + 1] = passed[number] & right(node)
    entries = rows.select(*others, "label", vector_to_array("features").alias("entries"))
    reached = entries.select(*others, "label", F.explode(F.array(*steps)).alias("step")).where("step IS NOT NULL")
    return reached.select(*others, "step.node", "label", "step.goes_right")


def tree_table(rows: DataFrame, tree: Sequence[Node]) -> DataFrame:
    """Nodes with ``n, n_pos`` documents of ``rows`` that reach them and ``n_right, pos_right`` of those
    that go on to the right child (null at leaves)."""
    positive = F.col("label") == 1
    right = F.coalesce("goes_right", F.lit(False))
    counts = visits(rows, tree).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(positive).alias("n_pos"),
        F.count_if(right).alias("n_right"),
        F.count_if(right & positive).alias("pos_right"),
    )
    table = rows.sparkSession.createDataFrame(list(tree), NODE_SCHEMA)
    inner = F.col("bin").isNotNull()
    found = table.join(counts, "node", "left")
    return found.select(
        *table.columns,
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
        F.when(inner, F.coalesce("n_right", F.lit(0))).alias("n_right"),
        F.when(inner, F.coalesce("pos_right", F.lit(0))).alias("pos_right"),
    )


def levelled(rows: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """``rows`` whose features are steps: how many of the ascending ``cuts`` a weight is above.

    A tree over steps has few candidate thresholds in each bin, the same in every engine.
    """
    step = F.transform(vector_to_array("features"), lambda x: sum((F.when(x > c, 1.0).otherwise(0.0) for c in cuts), F.lit(0.0)))
    return rows.withColumn("features", array_to_vector(step))
