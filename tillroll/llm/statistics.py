"""Counts of whole texts that the quality operators share."""

from __future__ import annotations

import numpy as np

from tillroll.llm import flat

WINDOW = 5  # words in a repeat window

SYMBOL = flat.byte_table(b"#*$%&|<>")
UPPER = flat.byte_table(bytes(range(65, 91)))
LOWER = flat.byte_table(bytes(range(97, 123)))
DIGIT = flat.byte_table(b"0123456789")
STOP = flat.byte_table(b".,;:?")


class TextCounts:
    """Counts of every document of one slice, as arrays."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(offsets) - 1
        self.starts, self.ends, self.first_word = flat.words(data, offsets)
        self.n_words = np.diff(self.first_word)
        self.doc = np.repeat(np.arange(n), self.n_words)
        self.hashes = flat.piece_hashes(data, self.starts, self.ends)
        self.word_chars = self.count(~flat.SPACE & ~flat.CONTINUATION)
        self.n_symbols = self.count(SYMBOL)
        self.n_dup_lines, self.n_lines = self._duplicate_lines(n)
        self.n_repeat_words = self._repeat_words(n)

    def count(self, table: np.ndarray) -> np.ndarray:
        return flat.counts_per_document(table[self.data], self.offsets)

    def _duplicate_lines(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, first = flat.lines(self.data, self.offsets)
        # a line has a word if a word begins between its ends
        worded = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends = starts[worded], ends[worded]
        doc = np.repeat(np.arange(n), np.diff(first))[worded]
        _, earlier = flat.repeated(doc, flat.piece_hashes(self.data, starts, ends))
        return np.bincount(doc[earlier], minlength=n), np.bincount(doc, minlength=n)

    def _repeat_words(self, n: int) -> np.ndarray:
        windows = flat.window_hashes(self.hashes, WINDOW)
        doc = self.doc[: len(windows)]
        whole = doc == self.doc[WINDOW - 1 :] if len(windows) else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        again, _ = flat.repeated(doc[at], windows[at])
        cover = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(cover, at[again], 1)
        np.add.at(cover, at[again] + WINDOW, -1)
        covered = np.cumsum(cover[:-1]) > 0
        return np.bincount(self.doc[covered], minlength=n)
