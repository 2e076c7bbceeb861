"""A cuckoo filter in one array: four slots a bucket, 16-bit fingerprints, deletions allowed."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500


class CuckooFilter:
    """Holds 16-byte keys. Two buckets are possible for a key; each follows from the other."""

    def __init__(self, buckets: int, table: bytes | None = None):
        self.mask = buckets - 1
        self.table = (np.zeros(buckets * SLOTS, np.uint16) if table is None
                      else np.frombuffer(table, np.uint16).copy())

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """Room for ``n`` keys at a load of at most four fifths."""
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, n) / (0.8 * SLOTS))))))

    @classmethod
    def loaded(cls, table: bytes) -> CuckooFilter:
        return cls(len(table) // (2 * SLOTS), table)

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key."""
        words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        mark = (words[:, 1] >> np.uint64(48)).astype(np.int64)
        mark[mark == 0] = 1
        first = (words[:, 1] & np.uint64(self.mask)).astype(np.int64)
        return mark, first, self.other(first, mark)

    def other(self, bucket, mark):
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def contains(self, keys: list[bytes]) -> np.ndarray:
        """True for every key held, and for few others."""
        if not keys:
            return np.zeros(0, bool)
        mark, first, second = self.places(keys)
        rows = self.table.reshape(-1, SLOTS)
        return ((rows[first] == mark[:, None]).any(1)) | ((rows[second] == mark[:, None]).any(1))

    def add(self, keys: list[bytes]) -> bool:
        """Insert; False if the table is too full, and then it has to be built anew."""
        if not keys:
            return True
        rng = np.random.default_rng(len(keys))
        for mark, first, second in zip(*(x.tolist() for x in self.places(keys))):
            if self._put(first, mark) or self._put(second, mark):
                continue
            bucket = first
            for slot in rng.integers(0, SLOTS, KICKS).tolist():
                at = bucket * SLOTS + slot
                mark, self.table[at] = int(self.table[at]), mark
                bucket = self.other(bucket, mark)
                if self._put(bucket, mark):
                    break
            else:
                return False
        return True

    def _put(self, bucket: int, mark: int) -> bool:
        row = self.table[bucket * SLOTS:(bucket + 1) * SLOTS]
        free = np.flatnonzero(row == 0)
        if len(free):
            row[free[0]] = mark
        return len(free) > 0

    def remove(self, keys: list[bytes]) -> None:
        """Take out keys that are held; others must not be given."""
        if not keys:
            return
        for mark, first, second in zip(*(x.tolist() for x in self.places(keys))):
            for bucket in (first, second):
                row = self.table[bucket * SLOTS:(bucket + 1) * SLOTS]
                found = np.flatnonzero(row == mark)
                if len(found):
                    row[found[0]] = 0
                    break


def filter_of(keys: list[bytes]) -> CuckooFilter:
    """A filter of all keys; grows until they fit."""
    room = len(keys)
    while True:
        made = CuckooFilter.for_keys(room)
        if made.add(keys):
            return made
        room = max(room * 2, 16)
