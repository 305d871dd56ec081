"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 to K - 1. One weight vector over hashed text features gives a text a score s, and
ordered thresholds cut it: P(grade <= k) = logistic(threshold_k - s). Features are the presence of
lower-case words in 2 ** ``BITS`` hash bins and the shape of the text in steps (share of repeated
words, of capitals, of marks, of digits, length of words). Weights are found by proximal gradient
steps on the likelihood with an L1 penalty, over the bins whose presence goes with another mean
grade by chance less often than ``ASSOCIATION`` standard errors; so words without bearing on the
grade weigh nothing however long a text is.

The model is fitted on at most ``sample`` rated documents, those with the smallest hash of their id;
every document is scored, by its whole text. Rows whose grade or text is null are not learned from; a
document with several ratings is learned from with each. Without usable ratings all weights are 0
and the thresholds give every grade the same probability. A null or empty text has no words and
gets the grade of its shape. Other columns are not needed; no rows give no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textfeat.llm.shared import rows_of

BITS = 18
SAMPLE = 20_000
ASSOCIATION = 4.0
LEAST_TEXTS = 5

# ASCII marks separate words; what kind a byte is: capital, digit, mark, other.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TO_SPACE = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_KIND = np.array([1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b in _MARKS else 0 for b in range(256)], np.uint8)


def features(text: str | None) -> np.ndarray:
    """Different hash bins of a text, ascending."""
    text = text or ""
    listed = text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()
    words = set(listed)
    kinds = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=4) / max(1, len(text))
    mean = sum(map(len, words)) / max(1, len(words))
    shape = [
        b"\0different%d" % int(10 * len(words) / max(1, len(listed))),
        b"\0capitals%d" % int(10 * kinds[1]),
        b"\0digits%d" % int(10 * kinds[2]),
        b"\0marks%d" % int(20 * kinds[3]),
        b"\0mean%d" % min(20, int(mean)),
        b"\0words%d" % len(listed).bit_length(),
    ]
    bins = np.fromiter(map(crc32, [*words, *shape]), np.uint32, len(words) + len(shape)) & np.uint32((1 << BITS) - 1)
    return np.unique(bins)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, bins: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[b].sum() for b in bins])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) in column k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -500, 500)))


def fit(bins: list[np.ndarray], grades: np.ndarray, n_grades: int, penalty: float = 1e-4, rounds: int = 300, rate: float = 0.3) -> OrdinalModel:
    """Maximum likelihood with an L1 penalty, by adaptive proximal gradient steps."""
    sizes = np.array([len(b) for b in bins], np.int64)
    flat = np.concatenate(bins) if bins else np.empty(0, np.int64)
    seen, flat = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(bins)), sizes)
    if len(bins):
        texts = np.bincount(flat, minlength=len(seen))
        away = np.abs(np.bincount(flat, grades[row], len(seen)) / texts - grades.mean()) * np.sqrt(texts)
        telling = (away >= ASSOCIATION * grades.std()) & (away > 0) & (texts >= LEAST_TEXTS)
        row, flat = row[telling[flat]], flat[telling[flat]]
    shares = (np.bincount(grades, minlength=n_grades) + 1) / (len(grades) + n_grades)
    below = np.cumsum(shares)[:-1]
    thresholds = np.log(below / (1 - below))
    weights, past, past_t = np.zeros(len(seen)), np.full(len(seen), 1e-8), np.full(n_grades - 1, 1e-8)
    n = max(1, len(bins))
    low, high = grades - 1, grades  # thresholds below and above a grade
    for _ in range(rounds if len(bins) else 0):
        score = np.bincount(row, weights[flat], len(bins))
        edges = np.concatenate([np.full((len(bins), 1), -np.inf), thresholds - score[:, None], np.full((len(bins), 1), np.inf)], axis=1)
        at = 1 / (1 + np.exp(-np.clip(edges, -50, 50)))
        at[:, 0], at[:, -1] = 0, 1
        upper, lower = at[np.arange(len(bins)), high + 1], at[np.arange(len(bins)), low + 1]
        p = np.maximum(upper - lower, 1e-12)
        slope = np.bincount(flat, (1 - upper - lower)[row], len(seen)) / n
        past += slope**2
        step = rate / np.sqrt(past)
        weights = weights - step * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
        slope_t = np.array([(np.where(high == k, -upper * (1 - upper) / p, 0) + np.where(low == k, lower * (1 - lower) / p, 0)).sum() / n for k in range(n_grades - 1)])
        past_t += slope_t**2
        thresholds = np.maximum.accumulate(thresholds - rate * slope_t / np.sqrt(past_t))
    full = np.zeros(1 << BITS)
    full[seen] = weights
    return OrdinalModel(full, thresholds)


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> OrdinalModel:
    """Fit on at most ``sample`` rows of ``ratings`` (``doc_id, grade``).

    Their bins come to the driver: at most ``sample`` times the different words of a text. Where ids
    of ``docs`` repeat, that many of all rated rows are drawn once more by hash.
    """
    order = F.xxhash64("doc_id", "grade")
    rated = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").orderBy(order, "doc_id", "grade").limit(sample)
    texts = docs.where(F.col(text_column).isNotNull()).select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = texts.join(F.broadcast(rated.select("doc_id", F.col("grade").cast("long").alias("grade"))), "doc_id")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "grade", "text").mapInArrow(_bins, f"doc_id {id_type}, grade long, bins binary")
    found = found.orderBy(F.xxhash64("doc_id", "bins"), "doc_id", "grade", "bins").limit(sample).toArrow()
    table = sorted(zip(*(found.column(c).to_pylist() for c in ("doc_id", "grade", "bins"))))
    return fit([np.frombuffer(b, np.uint32) for _, _, b in table], np.array([g for _, g, _ in table], np.int64), n_grades)


def score(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``expected_grade`` and ``tails`` (P(grade > k) for each k)."""
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    @F.pandas_udf("array<double>")
    def tails(texts: pd.Series) -> pd.Series:
        own = OrdinalModel(weights, thresholds)
        return pd.Series(list(own.tails(own.scores([features(t) for t in texts]))), dtype=object)

    scored = docs.select(F.struct("*").alias("row"), tails(F.col(text_column)).alias("tails"))
    expected = F.aggregate("tails", F.lit(0.0), lambda total, t: total + t)
    return scored.select("row.*", expected.alias("expected_grade"), "tails")


def _bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins = [features(text).tobytes() for (text,) in rows_of(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(bins, pa.binary())], ["doc_id", "grade", "bins"])
