"""Expressions over whole texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textfeat.functions import patterns

UNIDENTIFIED = -1


def normalise_newlines(text: Column) -> Column:
    """Line ends as ``\\n`` and no final one, as if the text had been joined from its lines."""
    return F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"\n\z", "")


def document_id(text: Column) -> Column:
    """Number of the first ``[EBook #n]`` or ``[Etext #n]``, -1 where there is none."""
    found = F.regexp_extract(text, patterns.DOCUMENT_ID, 2).try_cast("bigint")
    return F.coalesce(found, F.lit(UNIDENTIFIED).cast("bigint"))


def strip_header(text: Column) -> Column:
    """Text after the last start marker; all of it where there is none."""
    return F.element_at(F.split(text, patterns.HEADER_END), -1)


def strip_footer(text: Column) -> Column:
    """Text before the first end or licence marker."""
    return F.split(text, patterns.FOOTER_START, 2)[0]


def strip_boilerplate(text: Column) -> Column:
    return strip_footer(strip_header(text))


def tokens(body: Column) -> Column:
    """Lower-cased words, empty ones included where separators touch an end of the text.

    Text in ASCII is lowered as a whole, which moves no separator there; elsewhere words are, as the
    lower case of a separator can be a letter (the Kelvin sign) and that of a letter hold a separator.
    """

    def words(text: Column) -> Column:
        plain = F.split(text, patterns.CHARACTER_SEPARATOR)
        return F.when(text.contains("--"), F.split(text, patterns.WORD_SEPARATOR_RANGES)).otherwise(plain)

    is_ascii = F.length(body) == F.octet_length(body)
    return F.when(is_ascii, words(F.lower(body))).otherwise(F.transform(words(body), F.lower))
