"""Byte-level BPE of a tokenizer file, encoded and decoded with merges over contiguous rank arrays.

A word (a match of the pre-tokeniser's pattern) is held as its part boundaries and, beside them, the rank of each
adjacent pair of parts. The smallest rank is looked for by a scan of the array, its boundary is deleted and the ranks
on both sides are looked up again, until no pair has a rank. That is the quickest way for short words; a word beyond
`scan_bytes` takes the same merges from a heap over linked parts, so its cost grows with n log n. Ranks belong to pairs
of parts, as in the file: the same bytes cut elsewhere have none. Words repeat, so each worker keeps the ids of words it has met, up to a bound.

Texts never meet: encoding and decoding are map-only, a text at a time, and a text is read in runs of matches, so
beyond the text and its ids no list grows with it.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the pattern of byte-level pre-tokenisers
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MATCHES = 50_000  # matches held at a time
FLUSH_BYTES = 8 << 20  # of results, before a batch is handed on
CACHED_WORDS, CACHED_CHARS = 200_000, 32


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the file: printable Latin-1 stands for itself, the rest follow 255 in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 256 + hidden.index(b)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def _doubtful():
    """Characters that the pattern engine takes for letters, numbers or white space but an older Unicode leaves unassigned: libraries disagree on them."""
    newer = regex.compile(r"[\p{L}\p{N}\s]")
    runs, cps = [], [cp for cp in range(0x110000) if unicodedata.category(chr(cp)) == "Cn" and newer.match(chr(cp))]
    for cp in cps:
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]") if runs else None


class RankBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, scan_bytes: int = 160):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec["pre_tokenizer"], spec.get("added_tokens") or []
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        level = bool(pre) and pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True) and (spec.get("decoder") or {}).get("type") == "ByteLevel"
        if not plain or not level or spec.get("normalizer") or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} is no plain byte-level BPE")
        of = {s: b for b, s in enumerate(byte_symbols())}
        self.ids = {bytes(map(of.__getitem__, token)): i for token, i in model["vocab"].items() if all(c in of for c in token)}
        if not all(bytes([b]) in self.ids for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        pairs = [(bytes(map(of.__getitem__, a)), bytes(map(of.__getitem__, b))) for a, b in pairs]
        self.joined = {a + b: rank for rank, (a, b) in enumerate(pairs)}  # rank of a merge by the bytes it makes
        self.left, self.none = [*(len(a) for a, _ in pairs), 0], len(pairs)  # bytes of its left part; the rank of no merge
        if len(self.joined) < len(pairs):
            raise ValueError(f"{path} makes one token by two merges")
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(longest_first) + ")") if longest_first else None
        self.split, self.path, self.scan_bytes = regex.compile(PATTERN), path, scan_bytes
        self.bytes_of = [b""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in [*self.ids.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.bytes_of[i] = token
        self.coded = _Words(self)

    def merge(self, word: bytes) -> list[bytes]:
        """The parts of a word after all merges."""
        return self.merge_scan(word) if len(word) <= self.scan_bytes else self.merge_heap(word)

    def merge_scan(self, word: bytes) -> list[bytes]:
        rank, left, none, n = self.joined.get, self.left, self.none, len(word)
        bounds = list(range(n + 1))
        ranks = [rank(word[i : i + 2], none) for i in range(n - 1)]
        least = min(ranks, default=none)
        while least < none:
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            a, b = bounds[i], bounds[i + 1]
            if i:  # a rank holds where the left part is the merge's own
                before = bounds[i - 1]
                r = rank(word[before:b], none)
                ranks[i - 1] = r if left[r] == a - before else none
            if i < len(ranks):
                r = rank(word[a : bounds[i + 2]], none)
                ranks[i] = r if left[r] == b - a else none
            least = min(ranks, default=none)
        return [word[a:b] for a, b in itertools.pairwise(bounds)]

    def merge_heap(self, word: bytes) -> list[bytes]:
        n, rank, left, none = len(word), self.joined.get, self.left, self.none
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at each place; 0: merged away

        def pair(i: int) -> int:
            j = stop[i]
            r = rank(word[i : stop[j]], none) if j < n else none
            return r if left[r] == j - i else none

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) < none]
        heapq.heapify(heap)
        while heap:
            r, i, end = heapq.heappop(heap)
            j = stop[i]
            if not j or j >= n or stop[j] != end or pair(i) != r:
                continue  # one of the two parts is no more what it was
            stop[i], stop[j] = end, 0
            if end < n:
                before[end] = i
            for k in (before[i], i):
                if k >= 0 and (r := pair(k)) < none:
                    heapq.heappush(heap, (r, k, stop[stop[k]]))
        out, i = [], 0
        while i < n:
            out.append(word[i : stop[i]])
            i = stop[i]
        return out

    def word_ids(self, word: str) -> bytes:
        return np.array([self.ids[p] for p in self.merge(word.encode())], "<u4").tobytes()

    def _words(self, text: str) -> Iterator[list[str]]:
        if not text.isascii() and (doubtful := _doubtful()) is not None and doubtful.search(text):
            from tokenizers import pre_tokenizers

            yield [text[a:b] for _, (a, b) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        elif len(text) <= MATCHES:
            yield self.split.findall(text)
        else:
            found = self.split.finditer(text)
            while words := [m.group() for m in itertools.islice(found, MATCHES)]:
                yield words

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; added tokens in it get their own ids."""
        if self.marks is None or not self.marks.search(text):
            return b"".join(b"".join(map(self.coded.__getitem__, words)) for words in self._words(text))
        out = []
        for part in self.marks.split(text):
            out.append(self.special[part].to_bytes(4, "little") if part in self.special else b"".join(b"".join(map(self.coded.__getitem__, words)) for words in self._words(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids, added tokens included; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        at = np.frombuffer(ids, "<u4")
        known = at[at < len(self.bytes_of)]
        return b"".join(b"".join(map(self.bytes_of.__getitem__, known[i : i + MATCHES].tolist())) for i in range(0, len(known), MATCHES)).decode("utf-8", "replace")


class _Words(dict):
    """Ids of words met before: those since the last turn and, until they are met again, those of the turn before; a turn is CACHED_WORDS words. Long words are not kept."""

    def __init__(self, bpe: RankBpe):
        super().__init__()
        self.word_ids, self.older = bpe.word_ids, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word) or self.word_ids(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def rank_bpe(path: str) -> RankBpe:
    return RankBpe(path)


def _mapped(source: str, target: str, kind: pa.DataType, one):
    """Batches with one more column, target = one(source); results are handed on at FLUSH_BYTES."""

    def run(batches):
        for b in batches:
            at, values, size = 0, [], 0
            for i, v in enumerate(b.column(source)):
                values.append(one(v.as_py()))
                size += len(values[-1])
                if size >= FLUSH_BYTES or i == b.num_rows - 1:
                    part = b.slice(at, len(values))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, kind)], names=[*part.schema.names, target])
                    at, values, size = i + 1, [], 0

    return run


def encode_ranked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (little-endian unsigned 32-bit integers), as the tokenizer file's library encodes
    the whole text without special tokens around it, truncation or padding.

    Null text counts as empty and gives no ids. The strings of added tokens in a text get the ids of these tokens, as in
    the library. Repeated rows are encoded each, other columns are ignored, an empty table gives no rows. A text is held
    whole by its task, with its ids; memory beyond that does not grow with it, but for a word (an unbroken run of letters,
    say), whose merges take some 300 bytes a byte.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    coded = rows.mapInArrow(_mapped("text", "ids", pa.binary(), lambda text: rank_bpe(path).encode(text)), f"doc_id {kind}, text string, ids binary")
    return coded.select("doc_id", "ids")


def decode_ranked(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (doc_id, ids) with the column decoded, a string: added tokens stay in, bytes that are no UTF-8 become U+FFFD.

    Null or empty ids decode to an empty text, ids outside the vocabulary to nothing. Repeated rows are decoded each; an
    empty table gives no rows.
    """
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_mapped("ids", "decoded", pa.string(), lambda ids: rank_bpe(path).decode(ids or b"")), f"doc_id {kind}, ids binary, decoded string")
