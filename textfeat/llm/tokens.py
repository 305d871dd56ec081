"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

The library takes about a second for a megabyte, so a text is first cut at places where its own
pre-tokenizer cuts as well. Every piece is encoded by the library and kept in a bounded cache;
a text is the concatenation of its pieces. Texts in which a cut would not be certain go through
the library whole. Special-token strings in a text are ordinary text.
"""

import json
import unicodedata
from functools import cache

import numpy as np
from tokenizers import Tokenizer

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4

# The property White_Space.
_WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_APOSTROPHE = ord("'")

# Words one worker keeps encoded, some 150 MB; beyond that it starts anew.
CACHE_WORDS = 1_000_000


@cache
def _classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[_WHITE_SPACE] = SPACE
    return table


@cache
def _byte_characters() -> dict[int, str]:
    """Printable stand-in of each byte in a byte-level vocabulary, for ``str.translate``."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Pieces(dict):
    """Ids of the pieces met so far."""

    def __init__(self, encoder: "TextEncoder"):
        self.encoder, self.model = encoder, encoder.tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        if "'" in piece:  # may hold a contraction
            ids = self.encoder.whole(piece)
        else:
            characters = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_byte_characters())
            ids = np.array([t.id for t in self.model.tokenize(characters)], "<u4").tobytes()
        self[piece] = ids
        return ids


class TextEncoder:
    """Encodes texts as the tokenizer file at ``path`` does without special tokens.

    Knows two kinds of files: byte-level BPE that keeps white space (no normalizer), and BPE over
    lower-case words (NFC, lower case, white space dropped). ``encode(None)`` is ``encode("")``.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            self.words_only = json.load(file)["normalizer"] is not None
        self._pieces = _Pieces(self)

    @property
    def size(self) -> int:
        return self.tokenizer.get_vocab_size()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.words_only:
            if "İ" in text or "Σ" in text:  # their lower case is not one character, or depends on the next
                return self.whole(text)
            text = unicodedata.normalize("NFC", text).lower()
        pieces = self._cut(text)
        known = self._pieces
        if len(known) > CACHE_WORDS:
            known.clear()
        return b"".join(map(known.__getitem__, pieces))

    def _cut(self, text: str) -> list[str]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _classes()[codes]
        starts = np.empty(len(codes), bool)
        starts[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
        space = kinds == SPACE
        run_starts = starts & ~space
        run_starts[1:] &= space[:-1]  # a run of other characters begins
        if self.words_only:
            starts |= kinds == NUMBER
        else:
            last = space[:-1] & ~space[1:]  # last of a run of white space: apart, or the head of the next piece
            starts[:-1] |= last
            starts[1:] &= ~(last & (codes[:-1] == 32))
        quotes = np.flatnonzero(codes == _APOSTROPHE)
        if len(quotes):  # the run around an apostrophe stays in one piece
            runs = np.cumsum(run_starts)
            marked = np.zeros(runs[-1] + 1, bool)
            marked[runs[quotes]] = True
            starts &= ~(marked[runs] & ~space & ~run_starts)
        at = np.flatnonzero(starts)
        ends = np.append(at[1:], len(codes))
        if self.words_only:
            kept = ~space[at]
            at, ends = at[kept], ends[kept]
        return [text[i:j] for i, j in zip(at.tolist(), ends.tolist())]


@cache
def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and file."""
    return TextEncoder(path)
