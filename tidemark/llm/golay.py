"""The perfect binary Golay code (23, 12): every 23-bit word lies within 3 errors of one codeword."""

from __future__ import annotations

from itertools import combinations

import numpy as np

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1

_made: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The parity of each of the 4096 data words, and the error of each of the 2048 syndromes."""
    if not _made:
        par = np.zeros(4096, np.uint32)
        for d in range(4096):
            r = d << 11
            for b in range(22, 10, -1):
                if r >> b & 1:
                    r ^= GENERATOR << (b - 11)
            par[d] = r
        err = np.zeros(2048, np.uint32)
        for w in (1, 2, 3):
            for bits in combinations(range(23), w):
                e = sum(1 << b for b in bits)
                err[par[e >> 11] ^ (e & 0x7FF)] = e
        _made["par"], _made["err"] = par, err
    return _made["par"], _made["err"]


def decode(v: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    par, err = _tables()
    v = v.astype(np.uint32)
    return (v ^ err[par[v >> np.uint32(11)] ^ (v & np.uint32(0x7FF))]) >> np.uint32(11)


def near(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in v, index) for the distinct indices of all words within one bit of each v.

    Two words within 2 bits of each other share an index: that of a word within one bit of both. A word
    has 1 index if it lies within 2 bits of its codeword, else 6.
    """
    flips = np.concatenate(([0], 1 << np.arange(23))).astype(np.uint32)
    all_ = np.sort(decode(v.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(all_.shape, bool)
    new[:, 1:] = all_[:, 1:] != all_[:, :-1]
    at = np.nonzero(new)
    return at[0], all_[new]
