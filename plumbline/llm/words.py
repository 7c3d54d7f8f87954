"""Words of very long texts, a piece at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from plumbline.llm.decontaminate import _FOLD

PIECE_BYTES = 2**20


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """Lower-cased words of a text (a-z, 0-9, all beyond ASCII), about a megabyte at a time."""
    if text is None:
        return
    data = text.encode().translate(_FOLD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def firsts_of(counts: list[int]) -> np.ndarray:
    """Place of the first word of every text and, last, the number of words."""
    return np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]).astype(np.int64)
