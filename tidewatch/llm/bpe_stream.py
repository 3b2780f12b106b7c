"""Byte pair encoding as a transducer with bounded lookahead, and decoding as a state machine over bytes.

A word is read symbol by symbol. Its encoding up to any place is a path of tokens, and the last token of that path is
the only one that may stand next to the path before it: two neighbours are possible if no merge would have joined
their edges while both were there. So the machine keeps, for each place in its window, the last token only.

How far ahead one must look follows from the merge list alone. Where two texts first differ, merges differ; a merge
can carry that difference to the left by its own length, and a later one by the length of what it takes or leaves
there. ``lookahead`` is the longest such chain of merges in ascending rank. Tokens that end before the last
``lookahead`` symbols are the same however the word goes on: they are emitted, and the window moves. Memory does not
grow with the word. Merge lists in which a token is used before all its merges are done have no such bound and are
refused.

Decoding adds the bytes of token after token to a UTF-8 machine that gives text as soon as a character is whole.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.textbytes import LOWER, Texts, span_hashes, texts

_UNITS = 1 << 19  # units, words and neighbours that a worker remembers; forgotten when full
_WORDS = 1 << 17
_PAIRS = 1 << 18
_SHORT = 48  # symbols of a word that goes through the machine side by side with others
_BLOCK = 1 << 16  # ids decoded at a time

# The form of the tokenizer files that the encoder reads, and the ASCII part of its split pattern.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 ]+| ")


def _byte_symbols() -> str:
    """The character that stands for each byte in vocabularies over bytes: itself if it can be seen, else the next
    from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return "".join(chr(b if b in seen else next(hidden)) for b in range(256))


BYTE_SYMBOLS = _byte_symbols()


class Merges:
    """A merge list: which tokens it makes, which may be neighbours, and how far one must look ahead.

    ``ends`` marks the last symbol of a word, as in ``lo`` + ``w</w>``. Tokens are strings; their length counts
    symbols, so without the mark.
    """

    def __init__(self, merges: Iterable[tuple[str, str]], ends: str = ""):
        self.ends = ends
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, tuple[int, str, str]] = {}
        used: set[str] = set()
        for rank, (left, right) in enumerate(merges):
            token = left + right
            if token in self.made or token in used:
                raise ValueError(f"the token {token!r} is used before all merges to it, or made twice")
            used.update((left, right))
            self.rank[left, right] = rank
            self.made[token] = rank, left, right
        self.lookahead = self._lookahead()
        #: Tokens that a text of their own symbols gives; others stand in no encoding.
        self.whole: set[str] = set()
        for token, (rank, left, right) in self.made.items():
            if all(t in self.whole or t not in self.made for t in (left, right)) and self._apart(left, right, rank):
                self.whole.add(token)
        self.longest = max((self.size(t) for t in self.whole), default=1)
        self._known: dict[tuple[str, str], bool] = {}

    def size(self, token: str) -> int:
        return len(token) - (len(self.ends) if self.ends and token.endswith(self.ends) else 0)

    def _lookahead(self) -> int:
        """The most symbols between a boundary and the first symbol to the right that can decide on it, the last
        symbol of the word (which may carry a mark) included."""
        reach: dict[str, int] = {}  # of a token that begins where encodings differ: how far the cause may be
        most = 0
        for token, (_, left, right) in self.made.items():  # by rank
            here = max(self.size(right), reach.get(right, 0))
            most = max(most, here)
            beyond = here + self.size(left)
            reach[token] = max(beyond, reach.get(left, 0))
            reach[left] = max(beyond, reach.get(left, 0))
        return most + 1

    def _apart(self, left: str, right: str, until: int) -> bool:
        """Whether no merge before rank ``until`` joins the edges of the two. Undoes the merges of both, latest
        first; what is at the edge was there from its own merge until that of what it became part of."""
        left_until = right_until = until
        while True:
            rank = self.rank.get((left, right))
            # equal ranks are merged from the left: left's own merge wins over this one, this one over right's
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            of_left, of_right = self.made.get(left), self.made.get(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and of_left[0] >= of_right[0]):
                left_until, _, left = of_left
            else:
                right_until, right, _ = of_right

    def neighbours(self, left: str, right: str) -> bool:
        pair = left, right
        known = self._known.get(pair)
        if known is None:
            if len(self._known) >= _PAIRS:
                self._known.clear()
            known = self._known[pair] = self._apart(left, right, len(self.rank) + 1)
        return known


class Transducer:
    """Encodes one word: ``feed`` its symbols in pieces of any size, then ``finish``; both give the tokens that have
    become certain. Holds at most about four lookaheads of symbols."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.room = 3 * merges.lookahead + merges.longest
        self.text = ""  # from the last boundary that is certain
        self.last: list[str] = [""]  # of each place of the text: the last token of the encoding up to there

    def _step(self, end: int, mark: str) -> str:
        """The last token of the encoding up to ``end``."""
        text, last, merges = self.text, self.last, self.merges
        whole, known = merges.whole, merges._known
        for begin in range(max(0, end - merges.longest), end):
            token = text[begin:end] + mark
            if end - begin == 1 or token in whole:
                before = last[begin]
                if not begin:
                    return token
                fits = known.get((before, token))
                if fits or (fits is None and merges.neighbours(before, token)):
                    return token
        raise ValueError("no encoding")  # each symbol alone is a token, so this does not happen

    def _path(self, end: int, size: int) -> list[str]:
        """Tokens up to ``end``, of which the last has ``size`` symbols."""
        path, place = [], end
        while place:
            path.append(self.last[place])
            place -= size
            size = len(self.last[place])
        return path[::-1]

    def feed(self, symbols: str) -> list[str]:
        out: list[str] = []
        for begin in range(0, len(symbols), self.merges.lookahead):
            self.text += symbols[begin : begin + self.merges.lookahead]
            for end in range(len(self.last), len(self.text)):  # the newest symbol may be the word's last
                self.last.append(self._step(end, ""))
            if len(self.text) > self.room:
                out += self._emit()
        return out

    def _emit(self) -> list[str]:
        head = len(self.last) - 1
        path = self._path(head, len(self.last[head]))
        place, count = 0, 0
        while place + len(path[count]) < head - self.merges.lookahead:
            place += len(path[count])
            count += 1
        self.text, self.last = self.text[place:], self.last[place:]
        return path[:count]

    def finish(self) -> list[str]:
        """The remaining tokens; the machine is then ready for another word."""
        end = len(self.text)
        if not end:
            return []
        self.last.append(self._step(end, self.merges.ends))
        path = self._path(end, self.merges.size(self.last[end]))
        self.text, self.last = "", [""]
        return path


def _gathered(flat: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices of ``flat`` one after the other."""
    total = np.cumsum(counts)
    return flat[np.repeat(begins - total + counts, counts) + np.arange(total[-1] if len(total) else 0)]


class SideBySide:
    """The same machine for many short words at once: all of them advance by one symbol at a time, in numpy.

    Tokens are vocabulary ids here. The tokens that end at a place are found in a trie of reversed tokens.
    """

    def __init__(self, merges: Merges, ids: dict[str, int]):
        self.longest, mark = merges.longest, merges.ends
        n = self.n = max(ids.values()) + 1
        self.rank, self.size = np.full(n, -1), np.ones(n, np.int64)
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for token, (rank, left, right) in merges.made.items():
            at = ids[token]
            self.rank[at], self.left[at], self.right[at], self.size[at] = rank, ids[left], ids[right], merges.size(token)
        made = np.flatnonzero(self.rank >= 0)
        pairs = self.left[made] * n + self.right[made]
        sort = np.argsort(pairs)
        self.pairs, self.pair_ranks = np.append(pairs[sort], -1), np.append(self.rank[made][sort], -1)

        symbol = {s: b for b, s in enumerate(BYTE_SYMBOLS)}
        self.symbols = np.zeros(0x200, np.int64)
        self.symbols[[ord(s) for s in BYTE_SYMBOLS]] = np.arange(256)
        edges: dict[int, int] = {}
        token_at = [-1]
        atoms = [s + m for s in BYTE_SYMBOLS for m in {"", mark}]
        for token in (*atoms, *merges.whole):
            body = token[: merges.size(token)]
            node, shift = 0, 256 if len(body) < len(token) or not mark else 0
            for c in reversed(body):
                key = node * 512 + symbol[c] + (shift if mark else 0)
                shift = 0
                if key not in edges:
                    edges[key] = len(token_at)
                    token_at.append(-1)
                node = edges[key]
            token_at[node] = ids[token]
        self.mark = 256 if mark else 0
        self.token_at = np.array(token_at)
        keys = np.array([*edges], np.int64)
        sort = np.argsort(keys)
        self.edges, self.child = np.append(keys[sort], -1), np.append(np.array([*edges.values()])[sort], 0)
        self.known = np.full(1 << 20, -1, np.int64)
        self.known_fits = np.zeros(1 << 20, bool)

    def _find(self, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table[:-1], keys)
        return at, table[at] == keys

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out, todo = np.ones(len(left), bool), np.arange(len(left))
        left_until, right_until = np.full(len(left), self.n), np.full(len(left), self.n)
        while len(todo):
            at, found = self._find(self.pairs, left * self.n + right)
            rank = self.pair_ranks[at]
            joins = found & (rank < left_until) & (rank <= right_until)
            out[todo[joins]] = False
            of_left, of_right = self.rank[left], self.rank[right]
            go = ~joins & ((of_left >= 0) | (of_right >= 0))
            undo = of_left >= of_right
            left_until, right_until = np.where(undo, of_left, left_until)[go], np.where(undo, right_until, of_right)[go]
            left, right = np.where(undo, self.right[left], left)[go], np.where(undo, right, self.left[right])[go]
            todo = todo[go]
        return out

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokens may be neighbours; the pairs met last are remembered."""
        keys = left * self.n + right
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.known_fits[slots]
        missing = np.flatnonzero(self.known[slots] != keys)
        if len(missing):
            new, which = np.unique(keys[missing], return_inverse=True)
            fits = self._apart(new // self.n, new % self.n)
            out[missing] = fits[which]
            self.known[slots[missing]] = keys[missing]
            self.known_fits[slots[missing]] = out[missing]
            again = missing[self.known[slots[missing]] != keys[missing]]  # pairs that share a slot: the last one stays
            self.known[slots[again]] = -1
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = self.symbols[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(sizes)
        codes[ends - 1] += self.mark
        order = np.argsort(-sizes, kind="stable")
        begins, long = (ends - sizes)[order], sizes[order]
        last = np.full((len(words), int(long[0]) + 1), -1, np.int64)
        for end in range(1, int(long[0]) + 1):
            word = np.arange(int(np.searchsorted(-long, -end, "right")))
            node = np.zeros(len(word), np.int64)
            for size in range(1, min(end, self.longest) + 1):
                at, found = self._find(self.edges, node * 512 + codes[begins[word] + end - size])
                word, node = word[found], self.child[at[found]]
                token = self.token_at[node]
                some = np.flatnonzero(token >= 0)
                if size < end:
                    some = some[self._fits(last[word[some], end - size], token[some])]
                last[word[some], end] = token[some]
                more = np.ones(len(word), bool)
                more[some] = False
                word, node = word[more], node[more]
                if not len(word):
                    break
        place, word, path = long.copy(), np.arange(len(words)), []
        while len(word):
            token = last[word, place[word]]
            path.append((word, token))
            place[word] -= self.size[token]
            word = word[place[word] > 0]
        counts = np.zeros(len(words), np.int64)
        for word, _ in path:
            counts[word] += 1
        in_order = np.empty(len(words), np.int64)
        in_order[order] = counts
        tail = np.cumsum(in_order)[order] - 1
        out = np.empty(int(counts.sum()), np.int32)
        for step, (word, token) in enumerate(path):
            out[tail[word] - step] = token
        return out, in_order


class Encoder:
    """Ids of texts, by a tokenizer file that lowers case, drops white space and merges bytes inside words.

    White space never is part of a token, so a text is encoded as its words, each different one once while it is
    remembered. A word is split by the file's pattern, and each part goes through the transducer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        plain = not model.get("dropout") and not model.get("byte_fallback") and not model.get("ignore_merges")
        if not (
            model["type"] == "BPE"
            and plain
            and not model.get("continuing_subword_prefix")
            and (spec["normalizer"] or {}).get("normalizers") == _NORMAL
            and len(splits) == 2
            and splits[0].get("pattern") == {"Regex": _SPLIT}
            and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
            and splits[1]["type"] == "ByteLevel"
            and not splits[1]["add_prefix_space"]
        ):
            raise ValueError(f"{path} is no tokenizer of words in lower case without white space")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = Merges(((a, b) for a, b in pairs), model.get("end_of_word_suffix") or "")
        self.ids: dict[str, int] = model["vocab"]
        if any(s + mark not in self.ids for s in BYTE_SYMBOLS for mark in ("", self.merges.ends)):
            raise ValueError(f"{path} has no token for some byte")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that are more than their text")
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special_bytes = np.unique([ord(s[0]) for s in special if s[0] < "\x80"]).astype(np.uint8)
        self.machine, self.many = Transducer(self.merges), SideBySide(self.merges, self.ids)
        self._forget_parts()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _forget_parts(self) -> None:
        self.parts: dict[str, int] = {}
        self.part_begins, self.part_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.part_flat = np.zeros(0, np.int32)

    def _split(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of words that have no white space, and how many each word has. Many are split as one text:
        what a space separates is normalized and split by itself."""
        joined = " ".join(words)
        if joined.isascii() and joined.isprintable():
            found = _ASCII_SPLIT.findall(joined.lower())
            spaces = np.flatnonzero(np.fromiter((p == " " for p in found), bool, len(found)))
            return [p for p in found if p != " "], np.diff(np.concatenate([[-1], spaces, [len(found)]])) - 1
        if joined.split() == words:
            normal = self.normalizer.normalize_str(joined)
            pieces = self.splitter.pre_tokenize_str(normal)
            spaces = [k for k, c in enumerate(normal) if c == " "]
            begins = np.fromiter((span[0] for _, span in pieces), np.int64, len(pieces))
            cuts = np.searchsorted(begins, np.array(spaces, np.int64))
            return [p for p, _ in pieces], np.diff(np.concatenate([[0], cuts, [len(pieces)]]))
        if len(words) == 1:  # white space of other kinds inside the word
            pieces = [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(words[0]))]
            return pieces, np.array([len(pieces)])
        half = len(words) // 2
        a, b = self._split(words[:half]), self._split(words[half:])
        return a[0] + b[0], np.concatenate([a[1], b[1]])

    def _learn(self, parts: list[str]) -> None:
        """Encodes parts that are not known yet."""
        short = [p for p in parts if len(p) <= _SHORT]
        flat, counts = [], []
        if short:
            ids, n = self.many.encode(short)
            flat.append(ids)
            counts.append(n)
        long = [p for p in parts if len(p) > _SHORT]
        for part in long:
            ids = [self.ids[t] for t in self.machine.feed(part) + self.machine.finish()]
            flat.append(np.array(ids, np.int32))
            counts.append(np.array([len(ids)], np.int64))
        first = len(self.parts)
        self.parts.update(zip([*short, *long], range(first, first + len(parts)), strict=True))
        n = np.concatenate(counts)
        self.part_begins = np.concatenate([self.part_begins, len(self.part_flat) + np.cumsum(n) - n])
        self.part_counts = np.concatenate([self.part_counts, n])
        self.part_flat = np.concatenate([self.part_flat, *flat])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without white space or special tokens, one after the other, and how many each has."""
        parts, owned = [], []
        for begin in range(0, len(words), 512):
            some, n = self._split(words[begin : begin + 512])
            parts += some
            owned.append(n)
        new = [p for p in dict.fromkeys(parts) if p not in self.parts]
        if new and len(self.parts) + len(new) > _WORDS:
            self._forget_parts()
            new = list(dict.fromkeys(parts))
        if new:
            self._learn(new)
        at = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))
        ids, counts = _gathered(self.part_flat, self.part_begins[at], self.part_counts[at]), self.part_counts[at]
        total = np.concatenate([[0], np.cumsum(counts)])
        ends = np.cumsum(np.concatenate(owned))
        return ids, np.diff(total[ends], prepend=0)

    def encode(self, text: str) -> list[int]:
        """The ids of one text."""
        pieces = self.special_split.split(text) if self.special_split else [text]
        out: list[int] = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.special[piece])
            elif words := piece.split(" "):
                out.extend(self.encode_words([w for w in words if w] or [""])[0].tolist())
        return out

    def encode_rows(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other, and how many each row has."""
        starts, ends, rows = part.words()
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(part.rows, np.int64)
        data = LOWER[part.data]
        hits = np.flatnonzero(np.isin(part.data, self.special_bytes))
        marked = np.unique(np.searchsorted(starts, hits, "right") - 1)
        for w in marked:  # a special token may be inside: case counts
            data[starts[w] : ends[w]] = part.data[starts[w] : ends[w]]
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > _UNITS:
            self._forget()
        new = np.flatnonzero(~np.isin(keys, self.keys, assume_unique=True))
        if len(new):
            raw, special = data.tobytes(), np.isin(first[new], marked)
            ascending = np.argsort((data[starts[first[new]]] >= 0x80) + 2 * special, kind="stable")  # like with like
            new, special = new[ascending], int(special.sum())
            words = [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in first[new]]
            flat, counts = self.encode_words(words[: len(words) - special]) if len(words) > special else ([], [])
            odd = [self.encode(w) for w in words[len(words) - special :]]
            counts = np.concatenate([counts, np.array([len(ids) for ids in odd], np.int64)]).astype(np.int64)
            begins = len(self.flat) + np.cumsum(counts) - counts
            self.flat = np.concatenate([self.flat, flat, np.array([i for ids in odd for i in ids], np.int32)]).astype(np.int32)
            sort = np.argsort(new)
            new, begins, counts = new[sort], begins[sort], counts[sort]
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.begins = np.insert(self.begins, at, begins)
            self.counts = np.insert(self.counts, at, counts)
        at = np.searchsorted(self.keys, keys)
        begins, counts = self.begins[at][which], self.counts[at][which]
        total = np.concatenate([[0], np.cumsum(counts)])
        return _gathered(self.flat, begins, counts), np.diff(total[np.searchsorted(rows, np.arange(part.rows + 1))])


class Decoder:
    """Text of ids. Files with a byte decoder give the bytes of all tokens; files without one give the tokens as they
    are written in the vocabulary, a space between them. Ids that are no tokens give nothing. Bytes that are no UTF-8
    give U+FFFD."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        decoder = spec["decoder"]
        if decoder is not None and decoder["type"] != "ByteLevel":
            raise ValueError(f"{path} has a decoder of another kind")
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        byte = {s: b for b, s in enumerate(BYTE_SYMBOLS)}
        #: A space goes before every token but the first, so that what is decoded is final at once.
        self.between = b" " if decoder is None else b""

        def piece(token: str) -> bytes:
            if decoder is not None and all(c in byte for c in token):
                return bytes(byte[c] for c in token)
            return token.encode()

        pieces = [self.between + piece(tokens[i]) if i in tokens else b"" for i in range(max(tokens) + 1)]
        self.counts = np.array([len(p) for p in pieces] + [0], np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.start()

    def start(self) -> None:
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.skip = len(self.between)

    def feed(self, ids: np.ndarray) -> str:
        """The text that the ids make certain."""
        ids = np.where((ids >= 0) & (ids < len(self.counts) - 1), ids, len(self.counts) - 1)
        counts = self.counts[ids]
        raw = _gathered(self.flat, self.begins[ids], counts).tobytes()
        if raw and self.skip:
            raw, self.skip = raw[self.skip :], 0
        return self.utf8.decode(raw)

    def finish(self) -> str:
        """What is left of the text; the machine is then ready for another."""
        rest = self.utf8.decode(b"", True)
        self.start()
        return rest

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text of one document in pieces."""
        for begin in range(0, len(ids), _BLOCK):
            yield self.feed(ids[begin : begin + _BLOCK])
        yield self.finish()


_machines: dict[str, tuple[Encoder, Decoder]] = {}


def machines(path: str) -> tuple[Encoder, Decoder]:
    """One pair per worker process and tokenizer."""
    if path not in _machines:
        _machines[path] = Encoder(path), Decoder(path)
    return _machines[path]


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(docs[id].alias("id"), docs[text].cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of every row: the ids of its whole text. Null and blank texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = machines(tokenizer)
        for batch in batches:
            for some in texts(batch.column(1)):
                ids, counts = encoder.encode_rows(some)
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(some.first, some.rows), lists], [id, "ids"])

    rows = _rows(docs, id, text)
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; null and empty lists give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = machines(tokenizer)
        for batch in batches:
            for k in range(batch.num_rows):  # a text at a time: it may be long
                values = batch.column(1)[k].values
                some = np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)
                out = pa.array(["".join(decoder.decode(some))], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), out], [id, "text"])

    rows = encoded.select(encoded[id].alias("id"), encoded[ids].cast("array<long>").alias("ids"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, text string")


def round_trips(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: its whole text encoded, and those ids decoded.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` over the UTF-8 text,
    both in lowercase hex. Null, empty and blank texts have no tokens and the empty text. Repeated rows and null ids
    give a row each; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = machines(tokenizer)
        for batch in batches:
            for some in texts(batch.column(1)):
                ids, counts = encoder.encode_rows(some)
                raw = memoryview(ids.astype("<u4").tobytes())
                coded, decoded, begin = [], [], 0
                for end in np.cumsum(counts).tolist():
                    coded.append(hashlib.sha256(raw[4 * begin : 4 * end]).hexdigest())
                    of_text = hashlib.sha256()
                    for piece in decoder.decode(ids[begin:end]):
                        of_text.update(piece.encode())
                    decoded.append(of_text.hexdigest())
                    begin = end
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(some.first, some.rows), pa.array(counts), pa.array(coded), pa.array(decoded)],
                    [id, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = _rows(docs, id, text)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
