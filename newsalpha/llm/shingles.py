"""Sets of word shingles as arrays of 64-bit hashes."""

import numpy as np

# Bytes that end a word, and the letters that are lowered.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Bytes of a text that are hashed at once, so that a very long text needs little memory.
PART = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base up to a part's length, and of its inverse modulo 2 ** 64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    both = []
    for factor in (BASE, inverse):
        powers = np.full(PART + 1, factor, dtype=np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, in order. A word is a run of bytes that are not white space, letters A-Z lowered."""
    if not _tables:
        _tables.append(_powers())
    up, down = _tables[0]
    raw, at, found = text.encode().translate(LOWER), 0, []
    # Sum and length of a word that goes on in the next part.
    begun, length = np.zeros(1, dtype=np.uint64), 0
    while at < len(raw):
        end = min(len(raw), at + PART)
        if end < len(raw):  # cut behind the last white space; a part without any is the inside of a word
            cut = max(raw.rfind(space, at, end) for space in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            end = cut + 1 if cut >= at else end
        part = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        inside = np.concatenate([[False], ~SPACES[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        words, lengths = (sums[ends] - sums[starts]) * down[starts], (ends - starts).astype(np.uint64)
        if length:
            if len(starts) and starts[0] == 0:
                words[:1] = begun + words[:1] * np.uint64(pow(int(BASE), length, 1 << 64))
                lengths[0] += np.uint64(length)
            else:
                words, lengths = np.concatenate([begun, words]), np.concatenate([[np.uint64(length)], lengths])
        at = end
        if at < len(raw) and not SPACES[raw[at - 1]]:
            begun, length = words, int(lengths[0])
            continue
        length = 0
        found.append(mix(words + lengths))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of the whole text if it has fewer; none without words."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    count = len(hashes) - size + 1
    joined = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        joined = joined * BASE + hashes[k : k + count]
    return np.unique(mix(joined))


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets have at least ``percent`` per cent of their union in common."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return bool(len(a)) and 100 * shared >= percent * (len(a) + len(b) - shared)
