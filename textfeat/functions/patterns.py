"""Fixed values.

Marker and separator patterns of the supported e-book collection. They decide which
results are right, so they are given literally. ``(?i)`` replaces a case-insensitive flag.
"""

HEADER_END = r"(?i)\n\*{3} ?START OF[^*\n]+GUTENBERG[^*\n]+\*{3}\n"
FOOTER_START = r"(?i)\*{3} ?(END OF[^*\n]+GUTENBERG|START: FULL LICENSE)"
DOCUMENT_ID = r"(?i)\[ *(ebook|etext) *# *([0-9]+) *\]"

NUMERIC_SUFFIX = r"(\d+)(-\d+)(/|\.txt)"
UTF8_NAME = r"^\d+-0\.txt"
LATIN1_NAME = r"^\d+-8.txt"

# Anything but A-Z a-z U+00C0-U+01BF ' and -, or two and more hyphens.
WORD_SEPARATOR = r"[^A-Za-zÀ-ƿ'\-]+|-{2,}"

# The same separators with the character set written as the ranges it holds instead of the
# ranges it leaves out. java.util.regex tests one character against a negated union several
# times slower; on the 25 MB of documents at sf0.1 this form took 0.4 s, the other 3 s.
# tests/test_functions.py compares the two over every code point of the basic plane.
WORD_SEPARATOR_RANGES = r"[\x00-&(-,.-@\[-`{-¿ǀ-\x{10FFFF}]+|--+"

# The separators of a text in which no two hyphens meet: a single class, found without alternatives.
CHARACTER_SEPARATOR = WORD_SEPARATOR_RANGES.removesuffix("|--+")

# Elements and attributes of the RDF metadata, by their local names whatever prefixes a file binds.
RDF_SCHEMA = (
    "`ebook` array<struct<"
    "`_about`: string, "
    "`subject`: array<struct<"
    "`Description`: array<struct<"
    "`value`: array<string>, "
    "`memberOf`: array<struct<`_resource`: string>>>>>>>>"
)
