"""Token counts of sections or fields, by encoding the whole text once.

Cutting a text before encoding changes its tokens at the cuts. So each whole text is encoded once, every token gets
its span of characters, and spans are joined with the sections' intervals. A token that lies in several sections is
given to one of them by a stated rule, so the sections' counts add up to the text's.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST, MOST, LAST = "first", "most", "last"

_loaded: dict[tuple[str, str], tuple[object, np.ndarray]] = {}


def load(path: str, pattern: str):
    """A byte-level encoding from a file of ranks, and the bytes of each token; once per worker process."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        lengths[list(ranks.values())] = [len(token) for token in ranks]
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _loaded[path, pattern] = encoding, lengths
    return _loaded[path, pattern]


def token_spans(text: str, encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 character of each token. A character cut into several tokens is in the span of each."""
    ends = np.cumsum(lengths[np.array(encoding.encode_ordinary(text), np.int64)])
    if text.isascii():
        return np.concatenate([[0], ends[:-1]]) if len(ends) else ends, ends
    data = np.frombuffer(text.encode(), np.uint8)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = np.concatenate([[0], ends[:-1]])
    return chars[starts + 1] - 1, chars[ends]


def owners(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token lies in several.

    ``first`` and ``last`` are the sections' ascending, disjoint intervals, at least one. By rule, a token in several
    goes to the first, the last, or that with most of its characters (the first of equals). A token in none, such as
    a separator, goes to the section before it, or to the first section if there is none before.
    """
    low = np.searchsorted(last, starts, "right")
    high = np.searchsorted(first, ends, "left") - 1
    out = np.where(low <= high, low if rule != LAST else high, np.maximum(high, 0))
    crossing = low < high
    if rule == MOST:
        at = np.flatnonzero(crossing)
        best = np.zeros(len(at), np.int64)
        choice = low[at]
        for k in range(int((high[at] - low[at]).max()) + 1 if len(at) else 0):
            section = np.minimum(low[at] + k, high[at])
            held = np.minimum(ends[at], last[section]) - np.maximum(starts[at], first[section])
            better = held > best
            best[better], choice[better] = held[better], section[better]
        out[at] = choice
    return out, crossing


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The intervals between line feeds."""
    cuts = np.array([i for i, c in enumerate(text) if c == "\n"] if "\n" in text else [], np.int64)
    return np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(text)]])


def attribute(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    sections: Column | None = None,
    rule: str = MOST,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing): one row per section of every row of ``docs``.

    ``sections`` is an array of (start, end) in characters, ascending and disjoint; left out, they are the lines.
    ``n_tokens`` are the tokens a section is given, ``n_crossing`` those of them that lie in other sections too.
    Null text counts as empty: it is one line without tokens. Where ``sections`` is null or empty, the whole text is
    one section. Rows that repeat an id, or have none, get their own sections; other columns do not matter; an empty
    table gives no rows.
    """
    if rule not in (FIRST, MOST, LAST):
        raise ValueError(f"no such rule: {rule}")
    whole = F.lit(None).cast("array<struct<start:long,end:long>>")
    given = sections is not None
    rows = docs.select(
        docs[id].cast("long").alias("doc_id"),
        docs[text].cast("string").alias("text"),
        (sections.cast("array<struct<start:long,end:long>>") if given else whole).alias("sections"),
    )
    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = load(tokenizer, pattern)
        for batch in batches:
            body = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            picked, parts = [], []
            for k in range(batch.num_rows):
                one = body[k].as_py().decode("utf-8", "replace")
                cut = batch.column(2)[k].as_py() if given else None
                if cut:
                    first, last = (np.array([c[i] for c in cut], np.int64) for i in ("start", "end"))
                else:
                    first, last = (np.array([0]), np.array([len(one)])) if given else lines(one)
                owner, crossing = owners(*token_spans(one, encoding, lengths), first, last, rule)
                count = np.bincount(owner, minlength=len(first))
                across = np.bincount(owner[crossing], minlength=len(first))
                picked.append(np.full(len(first), k))
                parts.append((np.arange(len(first)), first, last, count, across))
                if len(parts) >= 2000 or k == batch.num_rows - 1:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                    ids = batch.column(0).take(pa.array(np.concatenate(picked)))
                    yield pa.RecordBatch.from_arrays([ids, *columns], names)
                    picked, parts = [], []

    return rows.mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")


def passages(text: Column, length: int) -> Column:
    """Sections of ``length`` characters, the last one shorter; for ``attribute``. Null for null and empty texts."""
    size = F.length(text)
    starts = F.when(size > 0, F.sequence(F.lit(0), size - 1, F.lit(length)))
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.least(i + length, size).alias("end")))


def joined_fields(docs: DataFrame, fields: list[str], separator: str = "\n") -> tuple[Column, Column]:
    """The text of several fields one after the other (null is empty), and the sections they are in it."""
    parts = [F.coalesce(docs[f].cast("string"), F.lit("")) for f in fields]
    at = F.lit(0)
    sections = []
    for part in parts:
        end = at + F.length(part)
        sections.append(F.struct(at.cast("long").alias("start"), end.cast("long").alias("end")))
        at = end + len(separator)
    return F.concat_ws(separator, *parts), F.array(*sections)
