"""Whole runs: corpus to features, features and subjects to results."""

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.operators import folds as fold_ops
from textfeat.operators import hashing, models, subjects, terms, weights
from textfeat.plans.staging import local_table, release, stage, stage_path
from textfeat.plans.store import FrequencyStore
from textfeat.sources import datasets


@dataclass(frozen=True)
class Corpus:
    """Results of counting: ``counts`` of documents from staged tables, merged frequency ``state``, and
    ``n_docs``, one row, where it is known without a pass over the words."""

    counts: DataFrame
    state: DataFrame
    n_docs: DataFrame | None = None

    @property
    def size(self) -> DataFrame:
        return weights.state_size(self.state) if self.n_docs is None else self.n_docs

    @property
    def tf(self) -> DataFrame:
        return terms.term_frequency(self.counts)

    def vocabulary(self, min_doc_pct: float = 0.0) -> DataFrame:
        """``word, df, idf`` of the terms in at least ``min_doc_pct`` percent of documents."""
        return weights.state_idf(self.state, min_doc_pct, self.n_docs)

    def release(self) -> None:
        """Delete the staged tables when nothing is to be read from the corpus any more."""
        release(self.counts)
        release(self.state)


def count_corpus(
    docs: DataFrame,
    body: str = "body",
    stop_words: terms.StopWords = (),
    keep_empty: bool = False,
    earlier: DataFrame | None = None,
    store: FrequencyStore | None = None,
    batch: int = 0,
) -> Corpus:
    """Count ``doc_id, body`` once; ``earlier`` is the frequency state of previous batches.

    Documents must not be in a batch before as well; where they may, give the ``store`` of all batches
    instead, which takes up this one as number ``batch`` and counts every document and word once.

    Texts are read and split one time. Document frequency, corpus size and term frequency all
    come from their staged counts. Of an unmerged state each reader computes its own part, so it
    is staged only where ``earlier`` is merged in.
    """
    counts, sizes = terms.sized_counts(docs, body, stop_words, keep_empty)
    state = weights.sized_state(counts, sizes)
    if store is not None:
        store.add(counts, batch)
        state = stage(store.state(), "state")
    elif earlier is not None:
        state = stage(weights.merge_states(earlier, state), "state")
    else:
        return Corpus(counts, state, sizes)
    return Corpus(counts, state)


def frequency_state(
    docs: DataFrame,
    body: str = "body",
    stop_words: terms.StopWords = (),
    keep_empty: bool = False,
    keys: Sequence[str] = (),
    once: bool = False,
) -> DataFrame:
    """Document-frequency state alone, where no counts are needed afterwards.

    The texts are read once; words of ids that are those of one text are shuffled combined per
    task, and only the others are merged before. ``once`` as in ``terms.counted_texts``.
    """
    stop_words = terms.inline_stop_words(stop_words)
    if isinstance(stop_words, DataFrame):
        counts = terms.unstopped_counts(docs, stop_words, body, keep_empty, keys)
        return weights.frequency_state(counts, *keys)
    alone, shared = terms.counted_texts(docs, body, stop_words, keep_empty, keys, once=once)
    state = weights.frequency_state_in_place(alone, *keys)
    if shared is None:
        return state
    both = state.unionByName(weights.frequency_state(shared, *keys))
    return both.groupBy(*keys, "word").agg(F.sum("df").alias("df"))


def build_vectors(
    corpus: Corpus,
    lengths: Sequence[int],
    min_doc_pct: float,
    path: str,
    batch: int = 0,
    portable: bool = False,
) -> None:
    """Hash the TF-IDF weights of a corpus at every length and write the vectors."""
    vocabulary = stage(corpus.vocabulary(min_doc_pct), "vocabulary")
    hashed = hashing.hashed_tfidf(corpus.tf, vocabulary, lengths, portable, by_document=True)
    datasets.write_vectors(hashing.assemble_vectors(hashed), path, batch)
    release(vocabulary)


def stage_vectors(hashed: DataFrame, num_bins: int) -> DataFrame:
    """ML vectors of one length, by way of a staged dataset."""
    spark = hashed.sparkSession
    path = stage_path(spark, "vectors")
    datasets.write_vectors(hashing.assemble_vectors(hashed), path)
    return datasets.read_vectors(spark, path, num_bins)


def draw_folds(
    vectors: DataFrame, metadata: DataFrame, ranks: Collection[int], num_folds: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Chosen subjects and stratified folds of the documents with a vector.

    The subjects, one row per rank asked for, pass through the driver; the labels are staged.
    """
    pairs = stage(subjects.subject_pairs(subjects.with_vectors(metadata, vectors)), "pairs")
    chosen = subjects.pick_ranks(subjects.subject_counts(pairs), ranks)
    rows = chosen.collect()
    if missing := sorted(set(ranks) - {row["rank"] for row in rows}):
        raise ValueError(f"there are no subjects of rank {missing}")
    chosen = local_table(vectors.sparkSession, rows, chosen.schema)
    labels = stage(subjects.one_vs_rest(vectors, pairs, chosen), "labels")
    release(pairs)
    return chosen, fold_ops.stratified_folds(labels, num_folds, seed)


def classify(
    vectors: DataFrame,
    metadata: DataFrame,
    ranks: Collection[int],
    num_folds: int,
    seed: int = 0,
    settings: Sequence[models.Setting] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Result rows of every subject, validation fold, setting and set.

    ``path`` keeps the rows of each finished model, see ``models.evaluate_grid``.

    The subject names come to the driver, one per rank asked for, as it starts the fits.
    """
    chosen, folds = draw_folds(vectors, metadata, ranks, num_folds, seed)
    table = stage(models.training_table(folds, vectors), "training")
    release(folds)
    names = [row["subject"] for row in chosen.orderBy("rank").collect()]
    try:
        counts = models.evaluate_grid(table, names, num_folds, settings or models.default_grid(), path=path)
    finally:
        release(table)
    return models.results_table(counts)
