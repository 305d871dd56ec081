"""Document frequency kept up to date from arriving documents.

A long run over a library is done in batches, and a run that stops is taken up where it was
left. Structured Streaming gives both: its checkpoint says which files were counted, and each
micro-batch writes its own partitions of a ``FrequencyStore``, so a batch that is repeated replaces
what it wrote before instead of being counted twice, and documents that come back count once.
"""

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textfeat.operators import terms
from textfeat.plans.staging import release
from textfeat.plans.store import STATE_SCHEMA, FrequencyStore
from textfeat.sources import datasets


def write_states(states: DataFrame, path: str) -> None:
    """Write ``batch, word, df``, replacing the batches in it only."""
    datasets.write_dataset(states, path, ["batch"])


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """``word, df, batch`` of all batches written so far."""
    return datasets.read_dataset(spark, path, STATE_SCHEMA)


def maintain_state(
    docs: DataFrame,
    state_path: str,
    checkpoint_path: str,
    body: str = "body",
    stop_words: Collection[str] = (),
) -> StreamingQuery:
    """Count the documents of a streaming ``docs`` that have not been counted yet, then stop.

    ``state_path`` becomes a ``FrequencyStore``; ``read_state`` reads its states, which add up under
    ``weights.merge_states``. Ids may come back in any later batch.
    """

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        counts = terms.term_counts(batch, body, stop_words)
        FrequencyStore(batch.sparkSession, state_path).add(counts, batch_id)
        release(counts)

    return (
        docs.writeStream.foreachBatch(count_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
