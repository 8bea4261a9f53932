"""Content-defined chunking with a gear rolling hash.

The hash at a byte depends on the 32 bytes up to it, so a boundary moves with
its content. Chunking is normalised: below the wanted size a boundary needs
more zero bits, above it fewer, and no chunk exceeds ``most``. Boundaries lie
between characters. A block of texts is hashed at once; as no boundary is looked
for in a text's first ``least`` >= 32 bytes, no text sees its neighbour's bytes.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np

from stationflow.llm.common import mix, owners

WINDOW = 32
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class Chunking:
    least: int
    wanted: int
    most: int

    def bits(self, more: int) -> np.uint32:
        return np.uint32(32 - (self.wanted.bit_length() - 1 + more))


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte, by doubling: five steps cover the window."""
    total = GEAR[data]
    step = 1
    while step < WINDOW:
        wider = total.copy()
        wider[step:] += total[:-step] << np.uint32(step)
        total = wider
        step *= 2
    return total


def chunks(data: np.ndarray, offsets: np.ndarray, how: Chunking):
    """(start, end, text) of every chunk of a block of texts; an empty text has none."""
    assert how.least >= WINDOW
    n = len(data)
    hashes = gear(data)
    whole = np.ones(n, bool)
    whole[:-1] = (data[1:] & 0xC0) != 0x80
    loose_at = np.flatnonzero((hashes >> how.bits(-1) == 0) & whole)
    strict = (loose_at[hashes[loose_at] >> how.bits(1) == 0] + 1).tolist()
    loose = (loose_at + 1).tolist()
    starts, ends = [], []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        at = begin
        while at < end:
            if end - at <= how.least:
                cut = end
            else:
                k = bisect_left(strict, at + how.least)
                cut = strict[k] if k < len(strict) else n + how.most
                if cut >= at + how.wanted:
                    k = bisect_left(loose, at + how.wanted)
                    cut = loose[k] if k < len(loose) else n + how.most
                if cut > at + how.most:
                    cut = at + how.most
                    while cut < end and data[cut] & 0xC0 == 0x80:
                        cut += 1
                cut = min(cut, end)
            starts.append(at)
            ends.append(cut)
            at = cut
    start, end = np.array(starts, np.int64), np.array(ends, np.int64)
    return start, end, owners(offsets, start)


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> list[bytes]:
    raw = memoryview(data.tobytes())
    return [blake2b(raw[a:b], digest_size=size).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
