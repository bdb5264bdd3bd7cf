"""Per-text statistics over words between ASCII white space, vectorised per text (Arrow batches)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
         "n_upper long, n_digits long, n_stops long, n_bars long, n_bangs long, n_bytes long, n_distinct long")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every `width` consecutive words (polynomial over word hashes, odd base)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:n].copy()
    for k in range(1, width):
        out *= _BASE
        out += h[k:k + n]
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `width` words at one of the starts."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:n]) > 0


def repeated_words(h: np.ndarray, width: int = 8) -> int:
    """Words inside windows of `width` words that occur at least twice."""
    r = rolling(h, width)
    if len(r) < 2:
        return 0
    _, inverse, counts = np.unique(r, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    return int(covered(starts, width, len(h)).sum()) if len(starts) else 0


def stats_of(text: str | None) -> tuple:
    raw = (text or "").encode()
    words = raw.split()          # bytes split exactly at ASCII white space
    lines = [x for x in raw.split(b"\n") if x.strip()]
    h = word_hashes(words)
    n_bytes = len(raw.translate(None, SPACE))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (len(words), len(text or "") - (len(raw) - n_bytes), count(SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(h), len(lines), count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"0123456789"), count(b".!?"),
            count(b"|"), count(b"!"), n_bytes, len(np.unique(h)))


def _stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in STATS.split(", ")]
    for texts in batches:
        yield pd.DataFrame([stats_of(t) for t in texts], columns=names)


def text_stats(text: Column | str) -> Column:
    """struct of STATS of a text column. Marked as not deterministic, so that filters on it are neither
    pushed below a join that thins the rows nor evaluated a second time."""
    return F.pandas_udf(_stats, STATS).asNondeterministic()(text)
