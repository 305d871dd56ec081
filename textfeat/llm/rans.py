"""Static range asymmetric numeral system (rANS) for token ids, in numpy.

One frequency table serves all blocks. A block is cut into segments of ``LANES * STEPS`` ids; each
segment is coded by ``LANES`` interleaved states of 64 bits that give off 32-bit words, and its
checkpoint (states, place of its words) lets it be decoded alone. All segments of a block are coded
side by side, one numpy operation for all their states.
"""

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 32
STEPS = 512
SEGMENT = LANES * STEPS

_LOW = np.uint64(1 << 31)  # states lie in [2^31, 2^63)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class Frequencies:
    """``freq[id]`` of ``2 ** bits`` slots; 0 for ids that never occur."""

    bits: int
    freq: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray) -> "Frequencies":
        """Scale ``counts`` to a power of two; every id that occurs keeps a slot at least."""
        counts = np.asarray(counts, np.int64)
        present = max(1, int((counts > 0).sum()))
        bits = min(24, max(12, present.bit_length() + 5))
        freq = np.zeros(max(1, len(counts)), np.int64)
        if counts.sum():
            freq[: len(counts)] = np.where(counts > 0, np.maximum(1, counts * (1 << bits) // counts.sum()), 0)
        else:
            freq[0] = 1 << bits
        surplus = int(freq.sum()) - (1 << bits)
        for i in np.argsort(-freq, kind="stable"):  # the most frequent ids take up the rounding
            change = max(1 - int(freq[i]), -surplus)
            freq[i] += change
            surplus += change
            if not surplus:
                break
        return Frequencies(bits, freq)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.freq) - self.freq

    def symbols(self) -> np.ndarray:
        """Id of each slot."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)


def encode(ids: np.ndarray, table: Frequencies) -> tuple[bytes, bytes, int]:
    """Words of all segments, their checkpoints, CRC-32 of the ids.

    A checkpoint is ``LANES`` states and the number of words before the segment, each an unsigned
    64-bit integer.
    """
    n = len(ids)
    segments = max(1, -(-n // SEGMENT))
    steps = min(STEPS, max(1, -(-n // LANES)))
    padded = np.full(segments * SEGMENT, len(table.freq), np.int64)
    padded[:n] = ids
    grid = padded.reshape(segments, STEPS, LANES)[:, :steps].transpose(1, 0, 2).reshape(steps, -1)
    # What fills up the last segment has probability one and leaves its state as it is.
    freq = np.append(table.freq, 1 << table.bits).astype(np.uint64)
    start = np.append(table.starts, 0).astype(np.uint64)
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(grid.shape[1], _LOW, np.uint64)
    given = np.empty(grid.shape, bool)
    words = np.empty(grid.shape, np.uint32)
    for t in range(steps - 1, -1, -1):
        f = freq[grid[t]]
        given[t] = over = state >= f << room
        words[t] = state  # the low half
        state = np.where(over, state >> _WORD, state)
        quotient = state // f
        state = (quotient << bits) + (state - quotient * f) + start[grid[t]]
    by_segment = given.reshape(steps, segments, LANES).transpose(1, 0, 2)
    payload = words.reshape(steps, segments, LANES).transpose(1, 0, 2)[by_segment]
    counts = by_segment.sum((1, 2))
    before = (np.cumsum(counts) - counts).astype(np.uint64)
    checkpoints = np.column_stack([state.reshape(segments, LANES), before]).astype("<u8")
    return payload.astype("<u4").tobytes(), checkpoints.tobytes(), zlib.crc32(ids.astype("<u4").tobytes())


def decode(
    payload: bytes, checkpoints: bytes, n: int, table: Frequencies, symbols: np.ndarray, only: slice = slice(None)
) -> np.ndarray:
    """Ids of a block of ``n``, or of the segments in ``only``. ``symbols`` is ``table.symbols()``.

    Raises ``ValueError`` where the words do not lead back to the states from which coding began.
    """
    words = np.append(np.frombuffer(payload, "<u4").astype(np.uint64), np.uint64(0))
    points = np.frombuffer(checkpoints, "<u8").reshape(-1, LANES + 1)
    sizes = np.clip(n - SEGMENT * np.arange(len(points)), 0, SEGMENT)[only]
    state = points[only, :LANES].astype(np.uint64)
    place = points[only, LANES].astype(np.int64)
    freq, start = table.freq.astype(np.uint64), table.starts.astype(np.uint64)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    lane = np.arange(LANES)
    steps = -(-int(sizes.max(initial=0)) // LANES)
    out = np.empty((steps, *state.shape), np.uint32)
    for t in range(steps):
        slot = state & mask
        out[t] = symbol = symbols[slot]
        new = freq[symbol] * (state >> bits) + slot - start[symbol]
        live = t * LANES + lane < sizes[:, None]
        state = np.where(live, new, state)
        need = live & (state < _LOW)
        taken = np.cumsum(need, axis=1)
        word = words[np.minimum(place[:, None] + taken - 1, len(words) - 1)]
        state = np.where(need, (state << _WORD) | word, state)
        place += taken[:, -1]
    if (state != _LOW).any():
        raise ValueError("damaged block")
    return np.concatenate([out[:, i].reshape(-1)[:size] for i, size in enumerate(sizes)] or [np.empty(0, np.uint32)])
