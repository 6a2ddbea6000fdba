"""Sets of word shingles as 64-bit hashes, their b-bit MinHash signatures and
parity bitmaps (plain numpy, used inside tasks).

A signature has ``CHUNKS`` chunks of ``WIDTH`` positions; each position keeps
the low 16 bits of one minimum. Two sets of similarity j agree in a position
with probability j (and 2 ** -16).
"""

from __future__ import annotations

import numpy as np
import xxhash

CHUNKS, WIDTH = 13, 5
POSITIONS = CHUNKS * WIDTH
#: Texts are hashed together up to so many bytes (a longer text by itself).
BATCH_BYTES = 1 << 20

UPPER = bytes(range(65, 91))
#: A-Z to lower case, every ASCII white space to a blank.
PLAIN = bytes.maketrans(UPPER + b"\t\n\x0b\x0c\r", UPPER.lower() + b" " * 5)

_rng = np.random.default_rng(20_240_613)
XOR = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TIMES = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(32)
BASE = 0x2545F4914F6CDD1D
BACK = pow(BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> SHIFT)) * MIX
    h = (h ^ (h >> SHIFT)) * MIX2
    return h ^ (h >> SHIFT)


class Powers:
    """Powers of the rolling base and of its inverse modulo 2 ** 64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, BATCH_BYTES + 1)
            for name, base in (("up", BASE), ("down", BACK)):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                setattr(self, name, np.multiply.accumulate(out))


POWERS = Powers()


def word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every word of a PLAIN text."""
    POWERS.to(len(joined) + 1)
    raw = np.frombuffer(joined, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (raw != 32).view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * POWERS.up[:len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * POWERS.down[starts]
    return starts, mixed(h + (ends - starts).astype(np.uint64) * MIX)


def _of_batch(texts: list[bytes], n: int) -> list[np.ndarray]:
    joined = b" ".join(t.translate(PLAIN) for t in texts)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, own = word_hashes(joined)
    at = np.searchsorted(starts, begins)  # the first word of each text
    h = np.full(max(0, len(own) - n + 1), n, np.uint64)
    for k in range(n):
        h = (h ^ (h >> SHIFT)) * MIX + own[k:len(own) - n + 1 + k]
    h = mixed(h)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= n:
            part = np.sort(h[a:b - n + 1])
            out.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
            continue
        whole = np.full(int(b > a), b - a, np.uint64)
        for x in own[a:b]:
            whole = (whole ^ (whole >> SHIFT)) * MIX + x
        out.append(mixed(whole))
    return out


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Of each UTF-8 text the sorted distinct hashes of its ``n``-word shingles
    (A-Z lower-cased, words split at ASCII white space); of the whole sequence
    where there are fewer words; none without words."""
    out, held, size = [], [], 0
    for t in texts:
        if held and size + len(t) > BATCH_BYTES:
            out += _of_batch(held, n)
            held, size = [], 0
        held.append(t)
        size += len(t) + 1
    return out + (_of_batch(held, n) if held else [])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), POSITIONS) uint16; no set is empty."""
    out = np.empty((len(sets), POSITIONS), np.uint16)
    if not sets:
        return out
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    for i in range(POSITIONS):
        out[:, i] = np.minimum.reduceat((every ^ XOR[i]) * TIMES[i], starts) & np.uint64(0xFFFF)
    return out


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """(rows, POSITIONS) int64. Entry WIDTH * c + j is chunk c without its
    position j: two chunks differ in one position or none exactly if some of
    these are equal. Four positions of 16 bits fill the key."""
    out = np.empty(sigs.shape, np.uint64)
    wide = sigs.astype(np.uint64)
    for c in range(CHUNKS):
        for j in range(WIDTH):
            key = np.zeros(len(sigs), np.uint64)
            for k in (x for x in range(WIDTH) if x != j):
                key = (key << np.uint64(16)) | wide[:, WIDTH * c + k]
            out[:, WIDTH * c + j] = key
    return out.view(np.int64)


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a whole set, as two signed longs."""
    d = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def bitmap(own: np.ndarray) -> bytes:
    """Parity bitmap of at least two bits a member (a power of two, 512 or more):
    bit b is the parity of the members whose low bits are b."""
    bits = max(512, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(b: np.ndarray, size: int) -> np.ndarray:
    """A bitmap (bytes as an array) as it would be with ``size`` bytes."""
    return np.bitwise_xor.reduce(b.reshape(-1, size), axis=0)


def apart(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """A lower bound of the members in which a set differs from others, from
    their bitmaps (``others``: a matrix of rows of one length, at most ``one``'s)."""
    return np.bitwise_count(others ^ folded(one, others.shape[1])).sum(1, dtype=np.int64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Members that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
