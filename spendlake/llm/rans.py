"""Static range asymmetric numeral system over numpy, many interleaved blocks side by side.

A block holds ``LANES * STEPS`` symbols, dealt over its lanes in turn; every lane has a 64-bit state and all lanes of a
block share one stream of 32-bit words. Blocks are independent: a checkpoint (first word, states of the lanes) and a
checksum is all a reader needs to decode a block by itself, or any set of blocks at once.
"""

from __future__ import annotations

import zlib

import numpy as np

LANES, STEPS, SCALE = 16, 256, 20
BLOCK = LANES * STEPS
_LOW, _WORD, _SCALE = np.uint64(1 << 31), np.uint64(32), np.uint64(SCALE)


class Frequencies:
    """Shared table: every counted symbol gets a share of ``2 ** SCALE`` slots, at least one."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        if len(counts) > 1 << 16:
            raise ValueError("symbols have to fit into 16 bits")
        if not counts.any():
            counts = np.ones(1, np.int64)
        known, total = counts > 0, int(counts.sum())
        spare = (1 << SCALE) - int(known.sum())
        share = np.array([c * spare // total for c in counts.tolist()], np.int64) + known
        share[int(counts.argmax())] += (1 << SCALE) - int(share.sum())
        self.share = share.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(share), dtype=np.uint16), share)
        self.common = int(counts.argmax())


def encode(symbols: np.ndarray, table: Frequencies) -> tuple[bytes, bytes, bytes, bytes]:
    """Words, the blocks' first words, states of their lanes, and checksums of their symbols."""
    blocks = -(-len(symbols) // BLOCK)
    padded = np.full(blocks * BLOCK, table.common, np.uint16)
    padded[: len(symbols)] = symbols
    sums = np.array([zlib.crc32(x) for x in padded.reshape(blocks, BLOCK)], np.uint32)
    steps = padded.reshape(blocks, STEPS, LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words, given = np.zeros((STEPS, blocks, LANES), np.uint32), np.zeros((STEPS, blocks, LANES), bool)
    for t in range(STEPS - 1, -1, -1):
        share, start = table.share[steps[:, t]], table.start[steps[:, t]]
        full = state >= share << np.uint64(63 - SCALE)
        words[t], given[t] = state.astype(np.uint32), full
        state = np.where(full, state >> _WORD, state)
        whole = state // share
        state = (whole << _SCALE) + (state - whole * share) + start
    given = given.transpose(1, 0, 2)
    stream = words.transpose(1, 0, 2)[given]
    firsts = np.concatenate([[0], np.cumsum(given.sum((1, 2)))])[:-1].astype(np.uint32)
    return stream.astype("<u4").tobytes(), firsts.astype("<u4").tobytes(), state.astype("<u8").tobytes(), sums.astype("<u4").tobytes()


def decode(stream: bytes, firsts: bytes, states: bytes, sums: bytes, count: int, table: Frequencies) -> np.ndarray:
    """The symbols of the blocks given by their checkpoints; raises if a checksum differs."""
    words = np.append(np.frombuffer(stream, "<u4"), np.uint32(0)).astype(np.uint64)
    place = np.frombuffer(firsts, "<u4").astype(np.int64)
    state = np.frombuffer(states, "<u8").astype(np.uint64).reshape(-1, LANES)
    out = np.empty((len(place), STEPS, LANES), np.uint16)
    slots = np.uint64((1 << SCALE) - 1)
    for t in range(STEPS):
        slot = state & slots
        symbol = table.symbol[slot]
        out[:, t] = symbol
        state = table.share[symbol] * (state >> _SCALE) + slot - table.start[symbol]
        short = state < _LOW
        nth = np.cumsum(short, 1)
        take = words[np.minimum(place[:, None] + nth - 1, len(words) - 1)]
        state = np.where(short, state << _WORD | take, state)
        place = place + nth[:, -1]
    found = [zlib.crc32(x) for x in out.reshape(-1, BLOCK)]
    if found != np.frombuffer(sums, "<u4").tolist():
        raise ValueError("a block's checksum differs: the file is damaged")
    return out.reshape(-1)[:count]
