"""Counting quotient filters over 64-bit fingerprints, built and merged in bulk.

A fingerprint is cut into the number of its segment, a quotient and a remainder. The quotient names a home slot; the
sorted remainders of one quotient are a run, which starts at its home or right behind the run before. One bit per
quotient says that it has a run, one bit per slot that a run ends there. So the slots hold remainders only, and yet
give back every fingerprint, in order: filters merge by their sorted remainders without loss. A slot seen more than
once has a counter beside it.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<BBIIQ")
LOAD = 0.9


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()


def _flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count, bitorder="little").astype(bool)


def encode(prints: np.ndarray, counts: np.ndarray, segment_bits: int) -> bytes:
    """The filter of sorted, distinct fingerprints of one segment (at least one) and how often each was seen."""
    n = len(prints)
    q_bits = max(1, int(np.ceil(np.log2(n / LOAD)))) if n > 1 else 1
    r_bits = 64 - segment_bits - q_bits
    own = prints & np.uint64((1 << 64 - segment_bits) - 1)
    home = (own >> np.uint64(r_bits)).astype(np.int64)
    index = np.arange(n)
    slot = index + np.maximum.accumulate(home - index)
    size, width = int(slot[-1]) + 1, (r_bits + 7) // 8

    has_run = np.zeros(1 << q_bits, bool)
    has_run[home] = True
    run_end, counted = np.zeros(size, bool), np.zeros(size, bool)
    run_end[slot[np.append(home[1:] != home[:-1], True)]] = True
    counted[slot] = counts > 1
    remainders = np.zeros((size, width), np.uint8)
    remainders[slot] = (own & np.uint64((1 << r_bits) - 1)).astype("<u8")[:, None].view(np.uint8)[:, :width]
    return b"".join([_HEAD.pack(segment_bits, q_bits, size, int(counted.sum()), int(prints[0]) >> (64 - segment_bits)),
                     _bits(has_run), _bits(run_end), _bits(counted), remainders.tobytes(),
                     counts[counts > 1].astype("<u8").tobytes()])


def decode(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, counts) of a filter, sorted."""
    segment_bits, q_bits, size, n_counted, segment = _HEAD.unpack_from(body)
    r_bits, at = 64 - segment_bits - q_bits, _HEAD.size
    width = (r_bits + 7) // 8

    def take(length: int) -> bytes:
        nonlocal at
        at += length
        return body[at - length:at]

    homes = np.flatnonzero(_flags(take(((1 << q_bits) + 7) // 8), 1 << q_bits))
    ends = np.flatnonzero(_flags(take((size + 7) // 8), size))
    counted = _flags(take((size + 7) // 8), size)
    remainders = np.zeros((size, 8), np.uint8)
    remainders[:, :width] = np.frombuffer(take(size * width), np.uint8).reshape(size, width)
    more = np.frombuffer(take(8 * n_counted), "<u8")

    starts = np.maximum(homes, np.append(-1, ends[:-1]) + 1)
    length = ends - starts + 1
    slot = np.repeat(ends + 1 - length.cumsum(), length) + np.arange(length.sum())
    prints = (np.uint64(segment << 64 - segment_bits) | (np.repeat(homes, length).astype(np.uint64) << np.uint64(r_bits))
              | remainders.view("<u8")[slot, 0])
    counts = np.ones(len(prints), np.int64)
    counts[counted[slot]] = more
    return prints, counts


def build(prints: np.ndarray, segment_bits: int) -> list[tuple[int, bytes]]:
    """(segment, filter) for every segment that holds one of ``prints``, which may repeat and need no order."""
    values, counts = np.unique(prints, return_counts=True)
    segment = (values >> np.uint64(64 - segment_bits)).astype(np.int64)
    cuts = np.flatnonzero(segment[1:] != segment[:-1]) + 1
    starts = np.concatenate(([0], cuts, [len(values)]))
    return [(int(segment[a]), encode(values[a:b], counts[a:b], segment_bits)) for a, b in zip(starts[:-1], starts[1:]) if b > a]


def merge(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, index of their filter, count over all filters), merged by sorted remainders.

    All filters are of one segment. The stable sort merges runs that are sorted already.
    """
    parts = [decode(body) for body in bodies]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    prints = np.concatenate([p for p, _ in parts])
    owner = np.repeat(np.arange(len(parts)), [len(p) for p, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(prints, kind="stable")
    prints, owner, counts = prints[order], owner[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    total = np.add.reduceat(counts, first)
    return prints, owner, np.repeat(total, np.diff(np.append(first, len(prints))))
