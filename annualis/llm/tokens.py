"""Words of many texts at once, as 64-bit hashes, by numpy over their bytes."""

from __future__ import annotations

import numpy as np

LONGEST = 1 << 12  # places of a word with a factor of their own; longer words use them again
_random = np.random.default_rng(20240607)
BYTE_CODE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_CODE = _random.integers(1, 1 << 63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters and digits and the bytes of other characters parts words.
PARTING = np.ones(256, bool)
PARTING[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, a space after each, and the end of each."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    return data, np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)


def word_hashes(data: np.ndarray, parts: np.ndarray, fold_latin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``data`` starts, and its hash; A-Z are lower-cased, with ``fold_latin`` also À-Þ.

    ``parts`` says which bytes part words. A hash is a sum over the bytes of random codes of byte and place, stirred.
    """
    inside = ~parts[data]
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return starts, _hashes(data, inside, starts, ends, fold_latin)


def _hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_latin: bool) -> np.ndarray:
    """Hashes of the words from ``starts`` to ``ends``, which hold all bytes that are ``inside``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    low = ASCII_LOWER[data]
    if fold_latin and len(low) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][capital] += 32
    sizes = ends - starts
    at = np.flatnonzero(inside)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if int(sizes.max()) > LONGEST:
        place %= LONGEST
    codes = BYTE_CODE[low[at]]
    codes *= PLACE_CODE[place]
    codes ^= codes >> np.uint64(29)
    codes *= PLACE_CODE[LONGEST - 1]
    out = np.add.reduceat(codes, np.cumsum(sizes) - sizes)
    out ^= out >> np.uint64(32)
    out *= PLACE_CODE[1]
    out ^= out >> np.uint64(29)
    return out


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces start, how many bytes they have, and where those scripts' signs start.

    Thai, Lao, Burmese, Khmer, kana and ideographs; the signs are those of U+3000-303F and full-width punctuation.
    """
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 2 < len(data)]
    a, b, c = data[at], data[at + 1], data[at + 2]
    signs = ((a == 0xE3) & (b == 0x80)) | ((a == 0xEF) & (b == 0xBC) & ((c <= 0x8F) | ((c >= 0x9A) & (c <= 0xA0))))
    three = ((a >= 0xE3) & (a <= 0xE9)) | ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | (
        (a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F))) | ((a == 0xEF) & (((b >= 0xA4) & (b <= 0xAB)) | (b == 0xBC) | (b == 0xBD)))
    four = (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)
    keep = (three | four) & ~signs
    return at[keep], np.where(four[keep], 4, 3), at[signs]


def unit_hashes(data: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes`` with ``fold_latin``, where scripts without spaces give a unit for each character.

    Such a unit's hash is that of the character and the next one, if both stand side by side. The third array tells
    which units are characters with no such neighbour behind them.
    """
    leads, sizes, signs = _unspaced(data)
    if not len(leads) and not len(signs):
        starts, hashes = word_hashes(data, parts, fold_latin=True)
        return starts, hashes, np.zeros(len(starts), bool)
    inside = ~parts[data]
    for k in range(3):
        inside[signs + k] = False
    cut = np.zeros(len(data) + 1, bool)
    cut[leads] = True
    cut[leads + sizes] = True
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    starts, ends = np.flatnonzero(inside & (cut[:-1] | ~before)), np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    hashes = _hashes(data, inside, starts, ends, True)
    single = np.zeros(len(data), bool)
    single[leads] = True
    single = single[starts]
    followed = np.zeros(len(starts), bool)
    followed[:-1] = single[:-1] & single[1:] & (ends[:-1] == starts[1:])
    out = hashes.copy()
    at = np.flatnonzero(followed)
    out[at] = (hashes[at] * PLACE_CODE[2]) ^ hashes[at + 1]
    return starts, out, single & ~followed
