"""Whitening of vectors by components found exactly.

Components c become integers floor(scale * c); the different vectors, each once, are the fit list. Their
scatter n * sum(x x') - S S' is a matrix of integers, summed up in parts without rounding; its
eigenvalues are n * n times those of the covariance. Then

1. its characteristic polynomial is found exactly: modulo each of as many primes as its coefficients need,
   a task brings the matrix to Hessenberg form and unrolls the polynomial; the residues give the
   coefficients by Chinese remaindering;
2. its roots, all real, are isolated by Descartes' rule, which is exact for such polynomials: the sign
   changes of p(x + t) count the roots above t, with integers of any size;
3. a component is the null-space of the matrix less its root, by inverse iteration with ``DIGITS`` digits.
   Roots too close to be told apart share a space, of which an orthonormal basis is taken.

Rows whose vector is null, holds null or non-finite components, or has another number of components than
most take no part. Integers beyond 2 ** 40 in size raise. Only components of positive variance are there
to be whitened, so a single vector, or an empty table, gives no rows. Repeated rows are results of
their own but one vector of the fit list. Null ids stay. Other columns are not needed.

What reaches the driver, and each task, grows with the square of the number of components, not with the
rows: meant for up to some hundreds of components.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textfeat.llm.codebooks import _integers, whole_vectors
from textfeat.llm.shared import keep

SCALE = 64
OFFSET = 1_000_000
LARGEST = 1 << 40
COMPONENTS = 16
# Decimal digits of the inverse iteration, bits to which a root is found, bits of the primes.
DIGITS = 60
ROOT_BITS = 96
PRIME_BITS = 31


def primes(n: int) -> list[int]:
    """The ``n`` largest primes below 2 ** ``PRIME_BITS``."""
    found: list[int] = []
    candidate = 2**PRIME_BITS - 1
    while len(found) < n:
        if is_prime(candidate):
            found.append(candidate)
        candidate -= 2
    return found


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 2 ** 32."""
    if n < 2 or n % 2 == 0:
        return n == 2
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 7, 61):
        if base % n == 0:
            continue
        x = pow(base, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo ``p``, constant first, by way of Hessenberg form."""
    h, d = matrix % p, len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        times = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - times[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * times % p).sum(1)) % p
    # q[k]: polynomial of the leading k rows and columns.
    q = np.zeros((d + 1, d + 1), np.int64)
    q[0, 0] = 1
    for k in range(d):
        q[k + 1, 1:] = q[k, :-1]
        q[k + 1] = (q[k + 1] - h[k, k] * q[k]) % p
        product = 1
        for i in range(k - 1, -1, -1):
            product = product * int(h[i + 1, i]) % p
            if not product:
                break
            q[k + 1] = (q[k + 1] - int(h[i, k]) * product % p * q[i]) % p
    return q[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), constant first, of a symmetric positive semidefinite matrix of
    integers. One task row for each prime."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # The coefficient of x^(d - k) is a sum of C(d, k) products whose mean is at most (trace / d)^k.
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    chosen = primes((2 * bound).bit_length() // (PRIME_BITS - 1) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                left = np.array([[x % p for x in row] for row in matrix], np.int64)
                made = [pa.array([p]), pa.array([polynomial_modulo(left, p).tolist()])]
                yield pa.RecordBatch.from_arrays(made, ["p", "residues"])

    parts = min(len(chosen), 4 * spark.sparkContext.defaultParallelism)
    work = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(parts)
    rows = work.mapInArrow(run, "p long, residues array<long>").collect()
    modulus = math.prod(r.p for r in rows)
    total = [0] * (d + 1)
    for r in rows:
        rest = modulus // r.p
        factor = rest * pow(rest, -1, r.p)
        for k, residue in enumerate(r.residues):
            total[k] += factor * residue
    return [x - modulus if (x := t % modulus) > modulus // 2 else x for t in total]


def roots_above(polynomial: list[int], t: int) -> int:
    """Number of roots above ``t``, with multiplicity, of a polynomial all of whose roots are real."""
    shifted = list(polynomial)
    for begin in range(len(shifted) - 1):  # Taylor shift by repeated division by x - t
        for k in range(len(shifted) - 2, begin - 1, -1):
            shifted[k] += t * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass(frozen=True)
class Root:
    """``low < root <= low + 1``, both over 2 ** ``bits``; ``times`` roots lie there."""

    low: int
    bits: int
    times: int

    def value(self) -> Decimal:
        with localcontext() as context:
            context.prec = DIGITS
            return (Decimal(self.low) + Decimal("0.5")) / Decimal(1 << self.bits)


def largest_roots(polynomial: list[int], most: int) -> list[Root]:
    """The largest positive roots, ``most`` with multiplicity or all, falling, to ``ROOT_BITS`` bits."""
    d = len(polynomial) - 1
    zeros = next((k for k, c in enumerate(polynomial) if c), d)
    polynomial, d = polynomial[zeros:], d - zeros
    if not d:
        return []
    # All roots are positive now; the least is above |constant| over the sum's power.
    top = -polynomial[-2]
    least = max(1, top ** (d - 1) // abs(polynomial[0]))  # 1 / least bounds the least root from below
    most = min(most, d)
    bits = 0
    # Scale roots so that the smallest wanted one has ROOT_BITS bits.
    while roots_above(_scaled(polynomial, bits), 1 << ROOT_BITS) < most:
        bits += 16
        if bits > least.bit_length() + ROOT_BITS + 16:
            break
    polynomial = _scaled(polynomial, bits)
    found: list[Root] = []
    # Intervals (low, high] with the numbers of roots above both ends, the highest last.
    todo = [(0, (top << bits) + 1, d, 0)]
    while todo and sum(r.times for r in found) < most:
        low, high, above_low, above_high = todo.pop()
        if above_high >= most or above_low == above_high:
            continue
        if high - low <= max(1, low >> ROOT_BITS):
            found.append(Root(low, bits, min(above_low, most) - above_high))
            continue
        middle = (low + high) // 2
        above = roots_above(polynomial, middle)
        todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def _scaled(polynomial: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2 ** ``bits`` times as large."""
    d = len(polynomial) - 1
    return [c << bits * (d - k) for k, c in enumerate(polynomial)]


def null_space(matrix: list[list[int]], root: Root) -> list[np.ndarray]:
    """Orthonormal vectors of the space that the matrix scales by about ``root``."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        value = root.value()
        rows = np.array([[Decimal(x) - value if i == j else Decimal(x) for j, x in enumerate(row)] for i, row in enumerate(matrix)], object)
        order, factors = _factored(rows, value)
        rng = np.random.default_rng(0)
        found: list[np.ndarray] = []
        for _ in range(root.times):
            vector = np.array([Decimal(int(x)) for x in rng.integers(-1000, 1000, d)], object)
            for _ in range(3):
                vector = _solved(order, factors, vector)
                for _ in range(2):
                    for other in found:
                        vector = vector - (vector * other).sum() * other
                    vector = vector / (vector * vector).sum().sqrt()
            found.append(vector)
    out = []
    for vector in found:
        plain = vector.astype(np.float64)
        plain /= np.sqrt((plain**2).sum())
        out.append(plain * np.sign(plain[np.abs(plain).argmax()]))
    return out


def _factored(rows: np.ndarray, value: Decimal) -> tuple[list[int], np.ndarray]:
    """Triangular factors with the order of the pivots."""
    a, d, order = rows.copy(), len(rows), list(range(len(rows)))
    tiny = value * Decimal(10) ** -(DIGITS - 5)  # in place of a pivot that is lost to rounding
    for k in range(d):
        pivot = k + int(np.abs(a[k:, k]).argmax())
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, None, k + 1 :]
    return order, a


def _solved(order: list[int], a: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = right[order]
    for k in range(1, len(x)):
        x[k] = x[k] - (a[k, :k] * x[:k]).sum()
    for k in range(len(x) - 1, -1, -1):
        rest = (a[k, k + 1 :] * x[k + 1 :]).sum() if k + 1 < len(x) else Decimal(0)
        x[k] = (x[k] - rest) / a[k, k]
    return x


@dataclass(frozen=True)
class Whitening:
    """Of the fit list: ``n`` vectors of sums ``sums`` (of whole vectors, without ``OFFSET``), ``axes``
    in rows by falling ``variances``, and the shares of the whole variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    shares: np.ndarray

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """n * x - S, exact; Python integers where 64 bits may not do."""
        if not len(whole):
            return whole
        far = self.n * int(np.abs(whole).max()) + max(map(abs, self.sums))
        kind = np.int64 if far < 2**62 else object
        return self.n * whole.astype(kind) - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) @ self.axes.T) / (self.n * np.sqrt(self.variances))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From the different ``whole`` vectors, staged; None where nothing varies."""
    sums = vectors.mapInArrow(_scatter, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    total = {(r.i, r.j): int(r.total) for r in sums}
    n = total.get((-1, -1), 0)
    d = max((i for i, _ in total), default=-1) + 1
    s = [total[i, -1] for i in range(d)]
    matrix = [[n * total[max(i, j), min(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return None
    axes, variances, shares = [], [], []
    with localcontext() as context:
        context.prec = DIGITS
        for root in largest_roots(characteristic_polynomial(vectors.sparkSession, matrix), components):
            axes += null_space(matrix, root)
            variances += [float(root.value() / n / n)] * root.times
            shares += [float(root.value() / trace)] * root.times
    return Whitening(n, s, np.array(axes), np.array(variances), np.array(shares))


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products (i, j), of components (i, -1) and of ones (-1, -1) of a task."""
    n, sums, products = 0, None, None
    for batch in batches:
        data = _integers(batch.column("whole"))
        for begin in range(0, len(data), 1024):
            some = data[begin : begin + 1024]
            # Squares of 1024 rows fit floats exactly below 2 ** 21, then 64 bits, then Python's integers.
            size = int(np.abs(some).max(initial=0))
            kind = np.float64 if size < 2**21 else np.int64 if size < 2**26 else object
            part = some.astype(kind)
            made = (part.T @ part).astype(np.int64 if kind is not object else object).astype(object)
            total = some.astype(object).sum(0) if kind is object else some.sum(0).astype(object)
            sums, products = (total, made) if sums is None else (sums + total, products + made)
            n += len(some)
    if not n:
        return
    d = len(sums)
    rows = [(-1, -1, n)] + [(i, -1, sums[i]) for i in range(d)] + [(i, j, products[i, j]) for i in range(d) for j in range(i + 1)]
    i, j, value = zip(*rows)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in value], pa.decimal128(38, 0))], ["i", "j", "total"])


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened vectors less the identity."""
    k = len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(model.centred(_integers(batch.column("whole"))))
            if len(w):
                sums, products = sums + w.sum(0), products + w.T @ w
        i, j = np.indices((k, k))
        made = [np.append(i.reshape(-1), np.arange(k)), np.append(j.reshape(-1), np.full(k, -1)), np.append(products.reshape(-1), sums)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["i", "j", "v"])

    rows = vectors.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    found = {(r.i, r.j): r.v / model.n for r in rows}
    mean = np.array([found[i, -1] for i in range(k)])  # zero but for rounding, as vectors are centred before
    covariance = np.array([[found[i, j] for j in range(k)] for i in range(k)]) - mean[:, None] * mean
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each
    row and component."""
    spark = rows.sparkSession
    whole = whole_vectors(rows.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector")), "vector", scale, LARGEST)
    vectors = keep(whole.select("whole").distinct(), "fit-list")
    model = fit(vectors, components)
    id_type = whole.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = model.centred(_integers(batch.column("whole")))
            if not len(centred):
                continue
            wide = centred if int(np.abs(centred).max(initial=0)) ** 2 * max(1, centred.shape[1]) < 2**62 else centred.astype(object)
            deviation = (wide * wide).sum(1)
            made = [pa.array([int(x) for x in deviation], pa.int64()), pa.array(model.whitened(centred).tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *made], ["vec_id", "deviation", "whitened"])

    found = whole.mapInArrow(run, f"vec_id {id_type}, deviation long, whitened array<double>")
    # Columns of the model by component, which posexplode counts from 0.
    shares = F.array(*map(F.lit, model.shares.tolist()))
    found = found.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "value"))
    return found.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
