"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters is a space. All n-grams of one to ``ORDER``
characters are hashed into 2 ** ``BITS`` bins. Counts of all training texts are summed per task and
then over tasks; the matrix of log probabilities, bins by languages, goes to all tasks.

A text that is null or has no letter is ``und`` with score 0. Texts without a language, and those
without letters, are not learned from. Without any training text every text is ``und``. The score is
the posterior probability. Equal posteriors go to the language that is first by name. Other columns
are not needed; repeated rows count each; no rows give no rows.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import in_slices, rows_of
from textfeat.llm.tokens import LETTER, _classes

ORDER = 3
BITS = 16
BATCH_BYTES = 1 << 20


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all n-grams, one row per n, and the first place of each text.

    Texts are set apart by spaces, as many as an n-gram could reach over. Column i holds the
    n-grams that begin at place i; those of blanks alone, and those that begin between texts, are in
    bin 0, which weighs nothing.
    """
    gap = " " * (ORDER - 1)
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((gap.join(lowered) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_classes()[codes] == LETTER, codes, 32).astype(np.uint32)
    n = len(codes) - (ORDER - 1)
    key = np.zeros(n, np.uint32)
    blank = np.ones(n, bool)
    bins = np.empty((ORDER, n), np.uint32)
    for k in range(ORDER):
        code = codes[k : k + n]
        key = (key * np.uint32(0x01000193)) ^ (code * np.uint32(0x9E3779B1) + np.uint32(k + 1))
        blank &= code == 32
        bins[k] = np.where(blank, 0, (key * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)) % np.uint32((1 << BITS) - 1) + 1)
    sizes = np.array([len(t) + len(gap) for t in lowered], np.int64)
    ends = np.cumsum(sizes)
    between = (ends[:-1, None] - np.arange(1, ORDER)).reshape(-1)
    bins[:, between] = 0
    return bins, ends - sizes


class Model:
    """Learned languages in order of their names, ``log_p[bin, language]``, log priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, documents: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.log_p = np.log(smooth / smooth.sum(0)).astype(np.float32)
        self.log_p[0] = 0
        self.prior = np.log(documents / documents.sum())

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        bins, starts = grams(texts)
        totals = np.zeros((len(texts), len(self.languages)))
        for row in bins:
            # A text may end in the last gap, where no n-gram begins.
            totals += np.add.reduceat(self.log_p[row], np.minimum(starts, len(row) - 1), axis=0, dtype=np.float64)
        totals += self.prior
        best = totals.argmax(1)
        scores = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
        return [self.languages[i] for i in best], scores.tolist()


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> Model | None:
    """Counts over all of ``docs``. Bins times languages come to the driver, as many as there are."""
    rows = docs.select(F.col(text_column).alias("text"), F.col(language_column).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counted = rows.mapInArrow(_count, "lang string, bin long, n long")
    found = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    if not languages:
        return None
    counts, documents = np.zeros((1 << BITS, len(languages))), np.zeros(len(languages))
    column = found.column("lang").to_pandas().map({name: i for i, name in enumerate(languages)}).to_numpy()
    bins, n = found.column("bin").to_numpy(), found.column("n").to_numpy()
    counts[bins[bins >= 0], column[bins >= 0]] = n[bins >= 0]
    documents[column[bins < 0]] = n[bins < 0]
    return Model(languages, counts, documents)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in in_slices(batches, "text", BATCH_BYTES):
        by_lang: dict[str, list[str]] = {}
        for text, lang in rows_of(batch, "text", "lang"):
            if has_letter(text):
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            bins, _ = grams(texts)
            found = np.bincount(bins.reshape(-1), minlength=1 << BITS)
            counts[lang] = counts[lang] + found if lang in counts else found
            documents[lang] = documents.get(lang, 0) + len(texts)
    for lang, found in counts.items():  # the number of documents is in bin -1
        found[0] = 0
        bins = np.flatnonzero(found)
        made = [pa.array([lang] * (len(bins) + 1)), pa.array(np.append(bins, -1)), pa.array(np.append(found[bins], documents[lang]))]
        yield pa.RecordBatch.from_arrays(made, ["lang", "bin", "n"])


def predict(text: Column, model: Model | None) -> Column:
    """Struct ``lang, score`` of a text."""

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        held, size = [], 0
        for i, text in enumerate([*texts, None]):
            if i < len(texts) and model is not None and has_letter(text):
                held.append((i, text))
                size += len(text)
            if held and (i == len(texts) or size >= BATCH_BYTES):
                for (k, _), lang, score in zip(held, *model.predict([t for _, t in held])):
                    langs[k], scores[k] = lang, score
                held, size = [], 0
        return pd.DataFrame({"lang": langs, "score": scores})

    return predicted(text)
