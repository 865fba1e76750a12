"""Code points of a text as arrays, with a coarse class for each."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

UPPER, LETTER, DIGIT, SPACE, PUNCTUATION, SYMBOL, OTHER = range(7)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point; white space is the ASCII kind and category Z."""
    of = {"Lu": UPPER, "Lt": UPPER, "Ll": LETTER, "Lm": LETTER, "Lo": LETTER, "Mn": LETTER,
          "Mc": LETTER, "Nd": DIGIT, "Nl": DIGIT, "No": DIGIT, "Zs": SPACE, "Zl": SPACE,
          "Zp": SPACE, "Sm": SYMBOL, "Sc": SYMBOL, "Sk": SYMBOL, "So": SYMBOL}
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        out[c] = PUNCTUATION if kind[0] == "P" else of.get(kind, OTHER)
    out[[9, 10, 11, 12, 13]] = SPACE
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
