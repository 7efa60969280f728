"""Word splits shared by the operators, on the UTF-8 bytes of Arrow columns."""

from __future__ import annotations

import pyarrow as pa
import xxhash

_ASCII = bytes(range(128))
_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
# A-Z to a-z; every other ASCII byte that is no letter or digit to a blank
LETTERS = bytes.maketrans(
    _ASCII, bytes(c if chr(c).isalnum() else 32 for c in _ASCII.translate(LOWER))
)


def utf8(column) -> list[bytes | None]:
    """The values of a string column as bytes, nulls as None."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches, rows: int = 500):
    """The batches in pieces, so that Python objects exist for a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blank_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but blank and the control characters 9 to 13; null has none."""
    return text.split() if text else []


def lower_blank_words(text: bytes | None) -> list[bytes]:
    """`blank_words` with A-Z lower-cased."""
    return text.translate(LOWER).split() if text else []


def letter_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters; null has none."""
    return text.translate(LETTERS).split() if text else []


class WordHash(dict):
    """XXH64 of words, remembered; forgets everything when it holds `most` words."""

    def __init__(self, most: int = 500_000, seed: int = 0):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value
