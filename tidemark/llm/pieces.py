"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary (pieces and scores) is read from a model file; encoding itself is numpy.  A text is
cut where no piece can reach across: before a word-start mark that follows something else, and
around line feeds.  The distinct segments of a slice of texts are encoded together: all their
symbols lie in one flat array, every round finds the best-scored adjacent pair of each segment,
merges its leftmost non-overlapping occurrences at once, and compacts the array.

Merging several occurrences at once equals merging one by one unless the new symbol could form a
pair that scores at least as well; for those pairs (a table, made from the vocabulary) a round
merges the leftmost occurrence only.  A run of many letters without a cut could take a round for each of
its pairs; segments of more than LONG symbols are merged pair by pair from a queue instead, in the same
order, so the time for any text follows its length.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import lists, text_slices

MARK = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)
#: Segments remembered between slices; only a cache, emptied when it is full.
REMEMBERED = 150_000
SLICE = 1 << 22
#: Symbols of a segment that merge rounds take on; longer ones are merged from a queue.
LONG = 256


class Vocabulary:
    """Pieces, merge ranks and byte pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)])
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.bytes = np.full(n, -1)
        for value, i in self.byte_ids.items():
            self.bytes[i] = value
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.surface = [
            bytes([self.bytes[i]]) if self.bytes[i] >= 0 else b"" if special[i] else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces of this model reach across the cuts")
        scores = np.array([model.get_score(i) for i in range(n)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)  # the best score has rank 0
        pairs: dict[int, int] = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        keys = np.array(sorted(pairs), np.int64)
        merged = np.array([pairs[k] for k in keys.tolist()], np.int32)
        #: rank of the best pair that a piece can be part of
        best = np.full(n, _NONE, np.int32)
        for part in (keys >> 32, keys & 0xFFFFFFFF):
            np.minimum.at(best, part, rank[merged])
        self.alone = best <= rank  # merge one occurrence at a time when this piece arises
        self.rank, self.ranks, self.size, self.pairs = rank, rank.tolist(), n, pairs
        self._table(keys, merged)

    def _table(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressing table from pair to merged piece, read by a few vectorised probes."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.bits, left = bits, np.arange(len(keys))
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        self.probes = 0
        while len(left):
            slot = self._slot(keys[left], self.probes)
            self.probes += 1
            free = self.keys[slot] == -1
            left_free = left[free]
            _, first = np.unique(slot[free], return_index=True)
            won = left_free[first]
            self.keys[slot[free][first]], self.values[slot[free][first]] = keys[won], merged[won]
            left = np.setdiff1d(left, won)

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        spread = (keys.astype(np.uint64) + np.uint64(probe)) * np.uint64(0x9E3779B97F4A7C15 + 2 * probe)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that a pair of symbols merges to, -1 if there is none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            slot = self._slot(keys[open_], probe)
            found = self.keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            open_ = open_[~hit & (found != -1)]
            if not len(open_):
                break
        return out

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in one array, and their number per segment."""
        n = len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, n)
        text = "".join(segments)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        chars, back = np.unique(codes, return_inverse=True)
        # Characters without a piece get numbers beyond the vocabulary and never merge.
        known = np.array([self.ids.get(chr(c), self.size + i) for i, c in enumerate(chars.tolist())], np.int64)
        symbol = known[back].astype(np.int32) if len(back) else np.empty(0, np.int32)
        owner = np.repeat(np.arange(n), lengths)
        done_symbols, done_owners = [], []
        long, ends = np.flatnonzero(lengths > LONG), np.cumsum(lengths)
        for i in long.tolist():
            merged = self._merge_long(symbol[ends[i] - lengths[i]:ends[i]].tolist())
            done_symbols.append(np.array(merged, np.int32))
            done_owners.append(np.full(len(merged), i))
        if len(long):
            rest = lengths[owner] <= LONG
            symbol, owner = symbol[rest], owner[rest]
        while len(symbol):
            inside = np.flatnonzero((owner[1:] == owner[:-1]) & (symbol[1:] < self.size) & (symbol[:-1] < self.size))
            merged = self.merge_of(symbol[inside], symbol[inside + 1])
            can = merged >= 0
            at, merged = inside[can], merged[can]
            own, rank = owner[at], self.rank[merged]
            best = np.full(n, _NONE, np.int32)
            np.minimum.at(best, own, rank)
            # Segments without a pair are finished and leave the array.
            stays = best[owner] < _NONE
            if not stays.all():
                done_symbols.append(symbol[~stays])
                done_owners.append(owner[~stays])
            top = rank == best[own]
            at, merged, own = at[top], merged[top], own[top]
            first = np.ones(len(at), bool)
            first[1:] = own[1:] != own[:-1]
            # In a chain of overlapping occurrences every second one merges, beginning at its left end.
            start = np.ones(len(at), bool)
            start[1:] = at[1:] != at[:-1] + 1
            index = np.arange(len(at))
            chain_start = np.maximum.accumulate(np.where(start, index, 0))
            use = (index - chain_start) % 2 == 0
            use &= first | ~self.alone[merged]
            at, merged = at[use], merged[use]
            symbol = symbol.copy()
            symbol[at] = merged
            stays[at + 1] = False
            symbol, owner = symbol[stays], owner[stays]
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        symbol, owner = np.concatenate(done_symbols), np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        return self._with_bytes(symbol[order], owner[order], chars, n)

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The symbols of one segment after all merges, best pair first and of equal ones the leftmost."""
        n, pairs, rank = len(symbols), self.pairs, self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            merged = pairs.get(symbols[left] << 32 | symbols[right])
            if merged is not None:
                heapq.heappush(queue, (rank[merged], left, right, merged))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, merged = heapq.heappop(queue)
            # The entry may be old: either symbol may have been merged away or changed since.
            if symbols[left] < 0 or after[left] != right or pairs.get(symbols[left] << 32 | symbols[right]) != merged:
                continue
            symbols[left], symbols[right] = merged, -1
            after[left] = follow = after[right]
            if follow < n:
                before[follow] = left
                offer(left, follow)
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s >= 0]

    def _with_bytes(self, symbol, owner, chars, n) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece by the pieces of their UTF-8 bytes."""
        odd = np.flatnonzero(symbol >= self.size)
        if len(odd):
            parts, at = [], 0
            widths = np.ones(len(symbol), np.int64)
            for i in odd.tolist():
                raw = chr(int(chars[symbol[i] - self.size])).encode("utf-8", "surrogatepass")
                widths[i] = len(raw)
                parts += [symbol[at:i], np.array([self.byte_ids[b] for b in raw], np.int32)]
                at = i + 1
            symbol = np.concatenate([*parts, symbol[at:]])
            owner = np.repeat(owner, widths)
        return symbol.astype(np.int64), np.bincount(owner, minlength=n)

    def decode_segments(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each segment, with its leading blanks; bytes that are not UTF-8 become U+FFFD."""
        surfaces = list(map(self.surface.__getitem__, ids.tolist()))
        out, at = [], 0
        for n in counts.tolist():
            out.append(b"".join(surfaces[at: at + n]).decode("utf-8", "replace"))
            at += n
        return out


_RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


def segments(text: str | None) -> list[str]:
    """The parts that are encoded by themselves; together they are the text after the mark is put first."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _RUNS.findall(MARK + text.replace(" ", MARK))
    words = text.split(" ")
    if "\n" not in text:
        return [MARK + w for w in words]
    out: list[str] = []
    for word in words:
        if "\n" in word:
            out += _RUNS.findall(MARK + word)
        else:
            out.append(MARK + word)
    return out


class Coder:
    """Encodes and decodes texts with a vocabulary, remembering frequent segments."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.written: list[bytes] = []
        self.read: list[str] = []

    def learn(self, parts: list[list[str]]) -> None:
        """Make sure that all segments are known."""
        if len(self.known) > REMEMBERED:
            self.known, self.ids, self.written, self.read = {}, [], [], []
        new = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.known]
        if not new:
            return
        ids, counts = self.vocabulary.encode(new)
        self.read += self.vocabulary.decode_segments(ids, counts)
        numbers = list(map(str, ids.tolist()))
        at, base = 0, len(self.ids)
        for k, n in enumerate(counts.tolist()):
            self.ids.append(ids[at: at + n])
            self.written.append(",".join(numbers[at: at + n]).encode())
            self.known[new[k]] = base + k
            at += n

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [segments(t) for t in texts]
        self.learn(parts)
        return [np.concatenate([self.ids[self.known[s]] for s in own] or [np.empty(0, np.int64)]) for own in parts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids of one text: marks become blanks, and the blank put first goes."""
        text = self.vocabulary.decode_segments(np.asarray(ids, np.int64), np.array([len(ids)]))[0]
        return text.removeprefix(" ")

    def digests(self, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, sha256 of the ids written in decimal, sha256 of the decoded text."""
        parts = [segments(t) for t in texts]
        self.learn(parts)
        sizes, written, read = [], [], []
        for own in parts:
            index = list(map(self.known.__getitem__, own))
            sizes.append(sum(len(self.ids[i]) for i in index))
            written.append(hashlib.sha256(b",".join([self.written[i] for i in index])).hexdigest())
            text = "".join([self.read[i] for i in index]).removeprefix(" ")
            read.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
        return sizes, written, read


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The coder of a model file, made once per worker process."""
    if path not in _coders:
        _coders[path] = Coder(Vocabulary(path))
    return _coders[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text; null and empty texts have no ids."""

    def work(batches):
        for keys, texts in lists(batches, "doc_id", "text"):
            for low, high in text_slices(texts, SLICE):
                ids = coder(path).encode(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[low:high], pa.int64()), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return _plain(docs).mapInArrow(work, "doc_id bigint, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids give an empty text."""

    def work(batches):
        for keys, ids in lists(batches, "doc_id", "ids"):
            own = coder(path)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([own.decode(i or []) for i in ids], pa.string())],
                names=["doc_id", "text"],
            )

    return coded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(work, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts give no ids and the digest of nothing.  Repeated rows get equal answers; a
    null doc_id stays null; other columns are ignored.
    """

    def work(batches):
        for keys, texts in lists(batches, "doc_id", "text"):
            for low, high in text_slices(texts, SLICE):
                sizes, written, read = coder(path).digests(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[low:high], pa.int64()), pa.array(sizes, pa.int64()), pa.array(written), pa.array(read)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _plain(docs).mapInArrow(work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
