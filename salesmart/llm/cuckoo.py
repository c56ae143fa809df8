"""Cuckoo filters over 128-bit keys, kept as plain arrays and changed in numpy batches."""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.8
MAX_KICKS = 500


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class CuckooFilter:
    """16-bit fingerprints in buckets of four; never a false negative for inserted keys.

    What finds no slot after ``MAX_KICKS`` rounds goes to an exact overflow list, so an insertion
    cannot fail. Deleting a key that was inserted removes one copy of its fingerprint.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None, overflow: np.ndarray | None = None):
        self.mask = np.uint64(buckets - 1)  # a power of two
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.overflow = np.zeros(0, np.uint64) if overflow is None else overflow

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(buckets)

    @classmethod
    def load(cls, table: bytes, overflow: bytes) -> CuckooFilter:
        rows = np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(rows), rows, np.frombuffer(overflow, np.uint64).copy())

    def dump(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), self.overflow.tobytes()

    def _places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first bucket, fingerprint); the pair also names a key in the overflow list."""
        hi, lo = hi.view(np.uint64), lo.view(np.uint64)
        print_ = (_mix(lo) & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        return _mix(hi) & self.mask, print_

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return (bucket ^ _mix(print_.astype(np.uint64) * np.uint64(0x5BD1E995))) & self.mask

    @staticmethod
    def _pair(bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return (bucket << np.uint64(16)) | print_.astype(np.uint64)

    def _settle(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """Puts fingerprints into free slots; True where one was found."""
        done = np.zeros(len(bucket), bool)
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        free = self.table[at] == 0
        slot = np.argmax(np.cumsum(free, axis=1) == (rank + 1)[:, None], axis=1)
        fits = rank < free.sum(axis=1)
        self.table[at[fits], slot[fits]] = print_[order][fits]
        done[order[fits]] = True
        return done

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> None:
        bucket, print_ = self._places(hi, lo)
        rng = np.random.default_rng(len(bucket))
        for k in range(MAX_KICKS):
            if not len(bucket):
                return
            done = self._settle(bucket, print_)
            bucket, print_ = bucket[~done], print_[~done]
            if not len(bucket):
                return
            if k:  # one newcomer per full bucket takes the slot of a random tenant
                _, pick = np.unique(bucket, return_index=True)
                slot = rng.integers(0, SLOTS, len(pick))
                old = self.table[bucket[pick], slot]
                self.table[bucket[pick], slot] = print_[pick]
                print_[pick] = old
                moved = self._other(bucket[pick], old)
                bucket[pick] = moved
                rest = np.ones(len(bucket), bool)
                rest[pick] = False
                bucket[rest] = self._other(bucket[rest], print_[rest])
            else:
                bucket = self._other(bucket, print_)
        # either bucket of a pair leads to the same smaller name
        self.overflow = np.concatenate((self.overflow, np.minimum(self._pair(bucket, print_), self._pair(self._other(bucket, print_), print_))))

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        bucket, print_ = self._places(hi, lo)
        other = self._other(bucket, print_)
        found = (self.table[bucket] == print_[:, None]).any(axis=1) | (self.table[other] == print_[:, None]).any(axis=1)
        if len(self.overflow):
            name = np.minimum(self._pair(bucket, print_), self._pair(other, print_))
            found |= np.isin(name, self.overflow)
        return found

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out one copy for each key; keys must have been inserted."""
        bucket, print_ = self._places(hi, lo)
        other = self._other(bucket, print_)
        for b, o, p in zip(bucket.tolist(), other.tolist(), print_.tolist(), strict=True):
            for place in (b, o):
                slot = np.flatnonzero(self.table[place] == p)
                if len(slot):
                    self.table[place, slot[0]] = 0
                    break
            else:
                name = min((b << 16) | p, (o << 16) | p)
                at = np.flatnonzero(self.overflow == name)
                if not len(at):
                    raise KeyError("a key to delete was never inserted")
                self.overflow = np.delete(self.overflow, at[0])
