"""XXH64 of many byte slices of one buffer at once, in numpy."""

from __future__ import annotations

import numpy as np

# --- fixed values: primes of the published XXH64 algorithm --------------------
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)
# ------------------------------------------------------------------------------


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def _equal_lengths(raw, lanes8, lanes4, at: np.ndarray, length: int, seed: np.uint64) -> np.ndarray:
    end = at + length
    if length >= 32:
        v = [np.full(len(at), s, np.uint64) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        for s in range(length // 32):
            for k in range(4):
                v[k] = _round(v[k], lanes8[at + (32 * s + 8 * k)])
        acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            acc = (acc ^ _round(np.uint64(0), v[k])) * P1 + P4
    else:
        acc = np.full(len(at), seed + P5, np.uint64)
    acc = acc + np.uint64(length)
    rest = length % 32
    for k in range(rest // 8):
        acc = _rotl(acc ^ _round(np.uint64(0), lanes8[end - rest + 8 * k]), 27) * P1 + P4
    rest %= 8
    if rest >= 4:
        acc = _rotl(acc ^ (lanes4[end - rest].astype(np.uint64) * P1), 23) * P2 + P3
        rest -= 4
    for k in range(rest):
        acc = _rotl(acc ^ (raw[end - rest + k].astype(np.uint64) * P5), 11) * P1
    acc ^= acc >> np.uint64(33)
    acc *= P2
    acc ^= acc >> np.uint64(29)
    acc *= P3
    return acc ^ (acc >> np.uint64(32))


def slices_hash(buffer: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of ``buffer[starts[i]:ends[i]]``, worked out together for slices of one length."""
    lengths = (ends - starts).astype(np.int64)
    if not len(lengths):
        return np.empty(0, np.uint64)
    small = lengths.astype(np.uint16) if lengths.max() < 1 << 16 else lengths
    order = np.argsort(small, kind="stable")
    lengths, at = lengths[order], starts[order].astype(np.int64)
    raw = np.frombuffer(buffer + bytes(8), dtype=np.uint8)
    lanes8 = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    lanes4 = np.ndarray((len(raw) - 7,), dtype="<u4", buffer=raw, strides=(1,))
    out = np.empty(len(at), np.uint64)
    cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1), len(lengths)]
    with np.errstate(over="ignore"):
        for a, b in zip(cuts, cuts[1:]):
            out[order[a:b]] = _equal_lengths(
                raw, lanes8, lanes4, at[a:b], int(lengths[a]), np.uint64(seed)
            )
    return out
