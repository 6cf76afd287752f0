"""Word statistics of whole texts, for whole Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import textarrays as ta

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Bytes of text that are worked on at once.
SLICE = 1 << 19


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return np.diff(total[bounds])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _owner(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    # Starts and ends alternate within each text, so sorting pairs them up.
    text = np.searchsorted(offsets, start, "right") - 1
    wordy = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~ta.IS_SPACE[data], out=wordy[1:])
    kept = wordy[end] > wordy[start]
    start, end, text = start[kept], end[kept], text[kept]
    keys = ta.Hashes(ta.BYTE[data]).of(start, end) ^ ta.mix(text.astype(ta.U64))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(text[again], minlength=len(offsets) - 1).astype(np.int64)


def _repeat_words(words: ta.Words) -> np.ndarray:
    """Words inside 3-word windows that the text has twice or more."""
    n = len(words)
    covered = np.zeros(n + 1, np.int64)
    if n >= 3:
        windows = ta.Hashes(words.hashes()).runs(3)
        text = _owner(words.first)
        inside = text[:-2] == text[2:]
        at = np.flatnonzero(inside)
        hit = at[repeated(windows[at] ^ ta.mix(text[at].astype(ta.U64)))]
        np.add.at(covered, hit, 1)
        np.subtract.at(covered, hit + 3, 1)
    return _per_text(np.cumsum(covered)[:n] > 0, words.first)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics `NAMES` of every text of the column; NULL has no word."""
    data, offsets = ta.flat(column)
    found = {name: [] for name in NAMES}
    for a, b in ta.parts(offsets, SLICE):
        own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = ta.Words(own, at)
        found["n_words"].append(np.diff(words.first))
        found["word_chars"].append(_per_text(~ta.IS_SPACE[own] & ((own & 0xC0) != 0x80), at))
        found["n_symbols"].append(_per_text(IS_SYMBOL[own], at))
        found["n_dup_lines"].append(_dup_lines(own, at))
        found["n_repeat_words"].append(_repeat_words(words))
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in found.items()}
