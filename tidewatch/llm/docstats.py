"""Counts per document from which the quality rules and the quality classifier start."""

from __future__ import annotations

import numpy as np

from tidewatch.llm.textbytes import CONTINUATION, SPACE, Texts, grams, in_row, span_hashes

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_ASCII_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_PUNCTUATION = (np.arange(256) > 32) & (np.arange(256) < 127) & ~_ASCII_LETTER & ~_DIGIT & ~SYMBOLS

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_digits",
    "n_punctuation",
    "n_distinct_words",
    "n_spaces",
)
REPEAT_WINDOW = 8


def count(texts: Texts) -> dict[str, np.ndarray]:
    """Each of ``COUNTS`` for each row, over whole texts.

    A line is a part between line feeds that has a word; lines and words are equal when their bytes are.
    ``n_repeat_words`` counts words inside windows of eight words that occur twice or more in the text.
    """
    rows = texts.rows
    data = texts.data
    starts, ends, row = texts.words()
    hashes = span_hashes(data, starts, ends)
    out = {"n_words": np.bincount(row, minlength=rows)}
    for name, table in (
        ("n_symbols", SYMBOLS),
        ("n_upper", _UPPER),
        ("n_digits", _DIGIT),
        ("n_punctuation", _PUNCTUATION),
        ("n_spaces", SPACE),
        ("continued", CONTINUATION),
    ):
        out[name] = texts.sums(table[data])
    out["word_chars"] = np.diff(texts.offsets) - out["n_spaces"] - out["continued"]
    out["n_letters"] = out["word_chars"] - out["n_symbols"] - out["n_digits"] - out["n_punctuation"]

    # A statistic only, so 40 bits of a word's hash do: they leave room for the row, and sorting alone counts.
    keys = np.sort((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    out["n_distinct_words"] = np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=rows)

    windows, first = grams(hashes, row, REPEAT_WINDOW)
    windows = in_row(windows, row[first])
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    out["n_repeat_words"] = np.zeros(rows, np.int64)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        first = first[twice[at] == windows]
        cover = np.zeros(len(row) + 1, np.int32)
        cover[first] += 1
        cover[first + REPEAT_WINDOW] -= 1
        out["n_repeat_words"] = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=rows)

    line_starts, line_ends, line_row = texts.spans(data != 10)
    worded = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_row = line_row[worded]
    lines = span_hashes(data, line_starts[worded], line_ends[worded])
    _, first = np.unique(in_row(lines, line_row), return_index=True)
    out["n_lines"] = np.bincount(line_row, minlength=rows)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_row[first], minlength=rows)
    return {name: out[name].astype(np.int64) for name in COUNTS}


