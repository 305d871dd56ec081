"""Words of documents and their counts."""

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.functions import text
from textfeat.plans import sizing
from textfeat.plans.staging import release, stage

StopWords = DataFrame | Collection[str]

# Stop words kept as a set inside the expression; a longer list is joined.
INLINE_STOP_WORDS = 10_000


def tokenize(docs: DataFrame, body: str = "body", keep_empty: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, doc_id, word``, one row per occurrence."""
    words = docs.select(*keys, "doc_id", F.explode(text.tokens(F.col(body))).alias("word"))
    return words if keep_empty else words.where("word <> ''")


def remove_stop_words(words: DataFrame, stop_words: StopWords) -> DataFrame:
    """Rows whose ``word`` is not listed; nulls in the list are ignored. Runs a row count when
    given a DataFrame."""
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select("word").where("word IS NOT NULL")
        return words.join(sizing.broadcast_if_small(listed), "word", "left_anti")
    listed = _known(stop_words)
    return words.where(~F.col("word").isin(listed)) if listed else words


def _known(stop_words: Collection[str]) -> list[str]:
    return [word for word in stop_words if word is not None]


def _with_id(docs: DataFrame) -> DataFrame:
    """Texts without an id belong to no document."""
    return docs.where("doc_id IS NOT NULL")


def inline_stop_words(stop_words: StopWords) -> StopWords:
    """A short table of stop words as a list; anything else unchanged."""
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select("word").where("word IS NOT NULL").limit(INLINE_STOP_WORDS + 1).collect()
        return [row["word"] for row in listed] if len(listed) <= INLINE_STOP_WORDS else stop_words
    return stop_words


def count_in_place(
    docs: DataFrame,
    body: str = "body",
    stop_words: Collection[str] = (),
    keep_empty: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``keys, doc_id, terms array<struct<word, cnt>>, max_cnt``, one row per text, by word.

    Each text is counted within its own row: its words are sorted, the ends of the runs of
    equal words are found, and the distance between two ends is a count. No shuffle. Texts
    without words give no row.
    """
    listed, ids = _known(stop_words), [*keys, "doc_id"]

    found = text.tokens(F.col(body))
    if not keep_empty:
        found = F.array_remove(found, "")
    if listed:
        found = F.filter(found, lambda word: ~word.isin(listed))

    # One select per step: each reads the array of the step before more than once, which
    # keeps the optimizer from merging them and computing an array again for every element.
    words = docs.select(*ids, F.sort_array(found).alias("words"))
    size = F.size("words")
    places = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    ends = words.select(
        *ids,
        "words",
        F.filter(places, lambda i: (i == size) | (F.get("words", i) != F.get("words", i - 1))).alias("ends"),
    )

    def term(end, nth):
        count = end - F.coalesce(F.get("ends", nth - 1), F.lit(0))
        return F.struct(F.get("words", end - 1).alias("word"), count.cast("bigint").alias("cnt"))

    counted = ends.select(*ids, F.transform("ends", term).alias("terms"))
    counted = counted.select(*ids, "terms", F.array_max(F.col("terms.cnt")).alias("max_cnt"))
    # Handed on through a generator: a later filter on the result then stays above it, where
    # otherwise it would be pushed below the selects with the arrays built once more inside it.
    filled = F.when(F.size("terms") > 0, F.array(F.struct("terms", "max_cnt")))
    return counted.select(*ids, F.inline_outer(filled)).where("terms IS NOT NULL")


def counted_texts(
    docs: DataFrame,
    body: str = "body",
    stop_words: Collection[str] = (),
    keep_empty: bool = False,
    keys: Sequence[str] = (),
    max_repeated: int = sizing.BROADCAST_ROWS,
    once: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Texts counted in one pass: rows of ``count_in_place`` whose id is that of no other text,
    and ``keys, doc_id, word, cnt`` of all others, merged by id, or None where there are none.

    Every text is counted in its own row and staged. The ids that repeat are found in the staged
    id column, and only their terms are shuffled, combined per task by id and word, so an id shared
    by very many texts still spreads over all tasks. Up to ``max_repeated`` such ids are broadcast
    to set the two apart; more are joined. Texts without an id are left out.

    ``once`` is for results that are read one time, of ids that are columns of their own, not made
    from the text: repeated ids are then looked for in these columns first, and where there are
    none nothing is staged.
    """
    ids = [*keys, "doc_id"]
    if once and sizing.repeated_keys(_with_id(docs), *ids).isEmpty():
        return count_in_place(sizing.spread(_with_id(docs).select(*ids, body)), body, stop_words, keep_empty, keys), None
    texts = sizing.spread(_with_id(docs).select(*ids, body))
    rows = stage(count_in_place(texts, body, stop_words, keep_empty, keys), "texts")
    repeated = stage(sizing.repeated_keys(rows, *ids), "repeated")
    if repeated.isEmpty():
        release(repeated)
        return rows, None
    repeated = sizing.broadcast_if_small(repeated.select(*(F.col(c).alias(f"repeated_{c}") for c in ids)), max_repeated)
    same = [F.col(c).eqNullSafe(F.col(f"repeated_{c}")) for c in ids]
    several = rows.join(repeated, same, "left_semi").select(*ids, F.inline("terms"))
    shared = several.groupBy(*ids, "word").agg(F.sum("cnt").alias("cnt"))
    return rows.join(repeated, same, "left_anti"), stage(shared, "shared")


def unstopped_counts(
    docs: DataFrame,
    stop_words: DataFrame,
    body: str = "body",
    keep_empty: bool = False,
    keys: Sequence[str] = (),
    max_repeated: int = sizing.BROADCAST_ROWS,
) -> DataFrame:
    """Staged ``keys, doc_id, word, cnt`` without the words of a long list, which is joined to
    the counts after the texts were counted in their rows."""
    alone, shared = counted_texts(docs, body, (), keep_empty, keys, max_repeated)
    counts = alone.select(*keys, "doc_id", F.inline("terms"))
    if shared is not None:
        counts = counts.unionByName(shared)
    return stage(remove_stop_words(counts, stop_words), "counts")


def term_counts(
    docs: DataFrame,
    body: str = "body",
    stop_words: StopWords = (),
    keep_empty: bool = False,
    with_max: bool = False,
    max_repeated: int = sizing.BROADCAST_ROWS,
    once: bool = False,
) -> DataFrame:
    """``doc_id, word, cnt`` and, with ``with_max``, the highest count of the document.

    Texts with the same id add up; those without one are left out. Texts are read once, see
    ``counted_texts``; what comes back reads staged tables, or with ``once`` the texts where it can.
    """
    stop_words = inline_stop_words(stop_words)
    columns = ["doc_id", "word", "cnt"] + (["max_cnt"] if with_max else [])

    def completed(counts: DataFrame) -> DataFrame:
        return (counts.join(max_counts(counts), "doc_id") if with_max else counts).select(columns)

    if isinstance(stop_words, DataFrame):
        return completed(unstopped_counts(docs, stop_words, body, keep_empty, max_repeated=max_repeated))
    alone, shared = counted_texts(docs, body, stop_words, keep_empty, max_repeated=max_repeated, once=once)
    counts = flatten_terms(alone).select(columns)
    return counts if shared is None else counts.unionByName(completed(shared))


def sized_counts(
    docs: DataFrame, body: str = "body", stop_words: StopWords = (), keep_empty: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``term_counts`` with the highest counts, and ``n_docs`` of them, one row. A text whose id is that of
    no other counts as its row, whose words are not read for it."""
    stop_words = inline_stop_words(stop_words)
    if isinstance(stop_words, DataFrame):
        counts = term_counts(docs, body, stop_words, keep_empty, with_max=True)
        return counts, counts.agg(F.countDistinct("doc_id").alias("n_docs"))
    alone, shared = counted_texts(docs, body, stop_words, keep_empty)
    counts, sizes = flatten_terms(alone), alone.agg(F.count(F.lit(1)).alias("n_docs"))
    if shared is None:
        return counts, sizes
    completed = shared.join(max_counts(shared), "doc_id").select(counts.columns)
    sizes = sizes.unionByName(shared.agg(F.countDistinct("doc_id").alias("n_docs")))
    return counts.unionByName(completed), sizes.agg(F.sum("n_docs").alias("n_docs"))


def flatten_terms(rows: DataFrame) -> DataFrame:
    """``doc_id, word, cnt, max_cnt`` from ``count_in_place``."""
    return rows.select("doc_id", F.inline("terms"), "max_cnt")


def max_counts(counts: DataFrame) -> DataFrame:
    """``doc_id, max_cnt``."""
    return counts.groupBy("doc_id").agg(F.max("cnt").alias("max_cnt"))


def highest_counts(
    docs: DataFrame, body: str = "body", stop_words: StopWords = (), keep_empty: bool = False, once: bool = False
) -> DataFrame:
    """``doc_id, max_cnt`` from texts. Where an id is that of one text, it is known in its row."""
    stop_words = inline_stop_words(stop_words)
    if isinstance(stop_words, DataFrame):
        return max_counts(unstopped_counts(docs, stop_words, body, keep_empty))
    alone, shared = counted_texts(docs, body, stop_words, keep_empty, once=once)
    highest = alone.select("doc_id", "max_cnt")
    return highest if shared is None else highest.unionByName(max_counts(shared))


def term_frequency(counts: DataFrame) -> DataFrame:
    """``doc_id, word, tf``: counts over the highest count of the document, in (0, 1]."""
    if "max_cnt" not in counts.columns:
        counts = counts.join(max_counts(counts), "doc_id")
    return counts.select("doc_id", "word", (F.col("cnt") / F.col("max_cnt")).alias("tf"))


def term_lists(
    rows: DataFrame, value: str, alias: str, parts: int = 1
) -> DataFrame:
    """``doc_id, part, <alias> array<struct<word, value>>`` sorted by word.

    A document has one list (part 0), which holds each of its different words once. Where
    merged texts make lists that are too long, ``parts`` hashes the words of every document
    over so many lists.
    """
    items = F.array_sort(F.collect_list(F.struct("word", value))).alias(alias)
    part = F.pmod(F.xxhash64("word"), F.lit(parts).cast("bigint"))
    return rows.groupBy("doc_id", part.alias("part")).agg(items)


def frequency_lists(
    docs: DataFrame,
    body: str = "body",
    stop_words: StopWords = (),
    keep_empty: bool = False,
    parts: int = 1,
    once: bool = False,
) -> DataFrame:
    """``doc_id, part, terms array<struct<word, cnt>>``: the counts of ``term_counts`` as
    lists, see ``term_lists``. With one part the list of an id that is that of one text is made
    within its row."""
    stop_words = inline_stop_words(stop_words)
    if parts > 1 or isinstance(stop_words, DataFrame):
        return term_lists(term_counts(docs, body, stop_words, keep_empty, once=once), "cnt", "terms", parts)
    alone, shared = counted_texts(docs, body, stop_words, keep_empty, once=once)
    lists = alone.select("doc_id", F.lit(0).cast("bigint").alias("part"), "terms")
    return lists if shared is None else lists.unionByName(term_lists(shared, "cnt", "terms"))
