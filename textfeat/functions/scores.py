"""Expressions over counts and weights."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def inverse_frequency(df: Column, n_docs: Column) -> Column:
    """ln(N / df), not smoothed."""
    return F.log(n_docs.cast("double") / df)


def keeps_share(df: Column, n_docs: Column, min_doc_pct: float) -> Column:
    """Whether a term is found in at least ``min_doc_pct`` percent of the documents.

    Compared in decimals, so a term exactly on the limit is kept for any percentage.
    """
    limit = F.lit(Decimal(str(min_doc_pct))) * n_docs.cast("decimal(18,0)")
    return df.cast("decimal(18,0)") * 100 >= limit


def hash_bin(word: Column, num_bins: int, portable: bool = False) -> Column:
    """Bin of a word, 0 to ``num_bins`` - 1.

    The portable form takes the first 32 bits of the MD5 digest and can be redone in any
    SQL engine; the default is the faster 64-bit xxHash.
    """
    if portable:
        head = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
        return F.pmod(head, F.lit(int(num_bins)).cast("bigint"))
    return F.pmod(F.xxhash64(word), F.lit(int(num_bins)).cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0.0 where the denominator is zero."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))
