"""Cuckoo filter over 64-bit hashes in one numpy table: insert, delete and probe whole arrays.

Fan et al., "Cuckoo Filter: Practically Better Than Bloom", 2014. A bucket has four 16-bit
fingerprints; the second bucket is the first one xor a hash of the fingerprint.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500
#: Share of slots that may be used before the table is built anew at twice its size.
FULL = 0.85


def buckets_for(count: int) -> int:
    """Power of two that holds ``count`` fingerprints at half of the permitted load."""
    return 1 << max(2, int(np.ceil(np.log2(max(1, count) / (SLOTS * FULL / 2)))))


def empty(buckets: int) -> np.ndarray:
    return np.zeros((buckets, SLOTS), np.uint16)


def places(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and both buckets of each hash."""
    h = np.asarray(hashes).astype(np.int64, copy=False).view(np.uint64)
    mark = (h >> np.uint64(48)).astype(np.uint16)
    mark[mark == 0] = 1
    first = (h & np.uint64(buckets - 1)).astype(np.int64)
    return mark, first, first ^ _step(mark, buckets)


def _step(mark, buckets: int):
    return ((np.asarray(mark).astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(7)).astype(np.int64) & (buckets - 1)


def contains(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mark, first, second = places(hashes, len(table))
    return ((table[first] == mark[:, None]) | (table[second] == mark[:, None])).any(axis=1)


def insert(table: np.ndarray, hashes: np.ndarray) -> bool:
    """Add each hash once. False when one found no place; the table must then be built anew, larger."""
    marks, firsts, seconds = places(hashes, len(table))
    for mark, first, second in zip(marks.tolist(), firsts.tolist(), seconds.tolist()):
        if not (_put(table, first, mark) or _put(table, second, mark)) and not _kick(table, first, mark):
            return False
    return True


def _put(table: np.ndarray, bucket: int, mark: int) -> bool:
    row = table[bucket]
    for slot in range(SLOTS):
        if row[slot] == 0:
            row[slot] = mark
            return True
    return False


def _kick(table: np.ndarray, bucket: int, mark: int) -> bool:
    for turn in range(KICKS):
        slot = (mark + turn) % SLOTS
        table[bucket, slot], mark = mark, int(table[bucket, slot])
        bucket ^= int(_step(mark, len(table)))
        if _put(table, bucket, mark):
            return True
    return False


def delete(table: np.ndarray, hashes: np.ndarray) -> None:
    """Remove one fingerprint for each hash. Only hashes that were inserted may be removed."""
    marks, firsts, seconds = places(hashes, len(table))
    for mark, first, second in zip(marks.tolist(), firsts.tolist(), seconds.tolist()):
        for bucket in (first, second):
            found = np.flatnonzero(table[bucket] == mark)
            if len(found):
                table[bucket, found[0]] = 0
                break


def build(hashes: np.ndarray) -> np.ndarray:
    size = buckets_for(len(hashes))
    while True:
        table = empty(size)
        if insert(table, hashes):
            return table
        size *= 2


def pack(table: np.ndarray) -> bytes:
    return table.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(bytes(blob), np.uint16).reshape(-1, SLOTS).copy()
