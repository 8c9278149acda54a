"""Words and word shingles of many texts as numpy arrays of 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

# Words of more bytes are hashed one by one.
_LONG = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict = {}


def mix(x):
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int):
    """base**0 .. base**n modulo 2**64, kept for the largest n so far."""
    held = _powers.get(base)
    if held is None or len(held) <= n:
        size = 1 << max(16, int(n).bit_length())
        steps = np.full(size + 1, base, np.uint64)
        steps[0] = 1
        held = _powers[base] = np.multiply.accumulate(steps)
    return held


def polynomial(values, starts, ends, base: int = _BASE):
    """The rolling (Karp-Rabin) hash of each range of an array, modulo 2**64: sums of
    value * base**i over a prefix, subtracted and scaled back. All ranges at once."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * _power(base, n)[:n], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return (sums[ends] - sums[starts]) * _power(inverse, n)[starts]


# Space and tab to carriage return, which separate words.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[32, 9, 10, 11, 12, 13]] = True
# Everything in ASCII but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def hash_ranges(flat, starts, ends):
    """A 64-bit hash of each range of an array of bytes, eight bytes after eight.

    Each step mixes what was read so far with the next bytes; sums of powers, which are equal
    for words of a certain form whatever the base, play no part.
    """
    sizes = ends - starts
    hashed = mix(sizes.astype(np.uint64) + np.uint64(_BASE))
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    long = sizes > _LONG
    for i in np.flatnonzero(long).tolist():
        digest = hashlib.blake2b(flat[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashed[i] = int.from_bytes(digest, "little")
    rows = np.flatnonzero(~long)
    at, left = starts[rows], sizes[rows]
    while len(rows):
        part = padded[at[:, None] + np.arange(8)].view("<u8").ravel()
        spare = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
        # Shifting by a whole 64 bits is not defined, but no range here is empty.
        part = part << spare
        hashed[rows] = mix((hashed[rows] ^ part) * np.uint64(_BASE) + np.uint64(1))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return hashed


def words(texts: list[str], separators=SEPARATORS):
    """Hashes of all words of the texts, and where each text's words end.

    A word is a run of bytes that are no separators. Equal words have equal hashes.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    flat = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    apart = separators[flat]
    inside = ~apart
    starts = np.flatnonzero(inside & np.concatenate([[True], apart[:-1]]))
    ends = np.flatnonzero(apart & np.concatenate([[False], inside[:-1]]))
    limits = np.cumsum([len(r) + 1 for r in raw])
    return hash_ranges(flat, starts, ends), np.searchsorted(starts, limits)


def shingles(hashed, ends, width: int):
    """Hashes of all runs of ``width`` words, and the text and first word of each.

    Runs do not cross texts. A text of fewer words (but one at least) is one run.
    """
    counts = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), counts)
    first = np.arange(len(hashed))
    last = np.minimum(first + width, ends[owner])
    begins = ends[owner] - counts[owner]
    good = (last - first == width) | ((counts[owner] < width) & (first == begins))
    first, last, owner = first[good], last[good], owner[good]
    runs = polynomial(hashed, first, last, 0xD6E8FEB86659FD93)
    return mix(runs + (last - first).astype(np.uint64)), owner, first
