"""Fill-in-the-middle: documents cut at line ends into prefix, middle and suffix, and put in a new order.

Where line k of a text ends is found without walking through its lines.  A rolling hash cuts the bytes
into chunks at places that depend on nearby content only, so passages that documents share fall into
equal chunks.  What a cut needs to know of a chunk, its numbers of line ends and of code points, is its
boundary summary.  It is worked out once per distinct chunk and kept in a cache whose keys are the
chunk's bytes, which are compared in full, so a hash alone is never trusted.  Summaries add up: running
totals over the chunks name the chunk that a cut lies in, and only that chunk is looked into.

The draw of a document depends on its id and the seed only.  A document without text, or one that
contains a mark itself, stays as it is ("plain"), so every output can be turned back.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType

from tidemark.llm.slices import column, utf8, with_arrays

# The marks that open prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: A chunk ends where this many bits of the rolling hash are zero, or after LONGEST bytes.
CUT_BITS = 8
LONGEST = 4096
#: Bytes whose content decides whether a chunk ends behind them; a power of two.
REACH = 16
#: Bytes hashed at a time.
BLOCK = 1 << 20
#: Bytes of chunks that a task's cache holds; a full cache is emptied, which costs time only.
CACHE_BYTES = 8 << 20

_GEAR = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)


def rolling_cuts(data: np.ndarray) -> np.ndarray:
    """Places behind which the rolling hash of the last REACH bytes asks for a cut; none in the first ones."""
    out = []
    for at in range(REACH - 1, len(data), BLOCK):
        rolled = _GEAR[data[at - REACH + 1:at + BLOCK]]
        step = 1
        while step < REACH:
            rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint64(step))
            step *= 2
        out.append(np.flatnonzero(rolled[REACH - 1:] >> np.uint64(64 - CUT_BITS) == 0) + at + 1)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of texts that lie one behind the other; text i ends at ``bounds[i + 1]``.

    Every text ends a chunk.  No other cut falls among its first bytes, where the hash would depend
    on the text before.
    """
    cuts = rolling_cuts(data)
    begun = bounds[np.searchsorted(bounds, cuts - 1, side="right") - 1]
    ends = np.union1d(cuts[cuts - begun >= REACH], bounds[1:][np.diff(bounds) > 0])
    before = np.append(0, ends)[:-1]
    wide = np.flatnonzero(ends - before > LONGEST)
    return np.union1d(ends, np.concatenate([np.zeros(0, np.int64), *(np.arange(before[i] + LONGEST, ends[i], LONGEST) for i in wide)]))


def code_points(data: bytes) -> int:
    """Code points that begin in these bytes of UTF-8."""
    return len(data) - int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 == 0x80))


class Summaries:
    """Line ends and code points of chunks; each distinct chunk is counted once while the cache holds it."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.known, self.counted = most, 0, {}, 0

    def of(self, chunk: bytes) -> tuple[int, int]:
        known = self.known.get(chunk)
        if known is None:
            if self.held > self.most:
                self.known, self.held = {}, 0
            known = self.known[chunk] = chunk.count(b"\n"), code_points(chunk)
            self.held += len(chunk)
            self.counted += 1
        return known


class Chunked:
    """Texts, given as UTF-8, as chunks with running totals of line ends and code points."""

    def __init__(self, texts: list[bytes], summaries: Summaries):
        self.flat = b"".join(texts)
        self.bounds = np.cumsum([0, *map(len, texts)])
        ends = chunk_ends(np.frombuffer(self.flat, np.uint8), self.bounds)
        self.starts = np.append(0, ends)
        counts = [summaries.of(self.flat[a:b]) for a, b in zip(self.starts[:-1].tolist(), ends.tolist())]
        self.lines, self.chars = np.cumsum([(0, 0), *counts], axis=0).T      # before each chunk
        self.first = np.searchsorted(self.starts, self.bounds)               # first chunk of each text

    def line_ends(self, i: int) -> int:
        return int(self.lines[self.first[i + 1]] - self.lines[self.first[i]])

    def size(self, i: int) -> tuple[int, int]:
        """Bytes and code points of text i."""
        low, high = self.first[i], self.first[i + 1]
        return int(self.starts[high] - self.starts[low]), int(self.chars[high] - self.chars[low])

    def after(self, i: int, k: int) -> tuple[int, int]:
        """Bytes and code points of text i up to and with its k-th line end."""
        if k == 0:
            return 0, 0
        low, high = self.first[i], self.first[i + 1]
        wanted = self.lines[low] + k
        at = low + int(np.searchsorted(self.lines[low + 1:high + 1], wanted))
        chunk, end = self.flat[self.starts[at]:self.starts[at + 1]], 0
        for _ in range(int(wanted - self.lines[at])):
            end = chunk.index(b"\n", end) + 1
        return int(self.starts[at] - self.starts[low]) + end, int(self.chars[at] - self.chars[low]) + code_points(chunk[:end])


def draw(doc_id: int | None, n: int, rate: int, suffix_first: int, seed: int) -> tuple[int, int, str]:
    """Lines before the middle, lines before the suffix, and the form of a document with ``n`` lines."""
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(text[k:k + 8], 16) for k in (0, 8, 16, 24))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return low, high, "plain" if h3 % 100 >= rate else "spm" if h4 % 100 < suffix_first else "psm"


def rearrange(ids: list, texts: list[bytes], summaries: Summaries, rate: int, suffix_first: int, seed: int) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each text, given as UTF-8."""
    chunked, out = Chunked(texts, summaries), []
    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        ended = chunked.line_ends(i)
        n = ended + bool(text and not text.endswith(b"\n"))
        low, high, form = draw(doc_id, n, rate, suffix_first, seed)
        if form == "plain" or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
            out.append((n, "plain", None, None, text))
            continue
        (a, a_chars), (b, b_chars) = (chunked.size(i) if k > ended else chunked.after(i, k) for k in (low, high))
        prefix, middle, suffix = PREFIX + text[:a], MIDDLE + text[a:b], SUFFIX + text[b:]
        output = suffix + prefix + middle if form == "spm" else prefix + suffix + middle
        out.append((n, form, a_chars, b_chars - a_chars, output))
    return out


def fill_in_middle(docs: DataFrame, rate: int = 100, suffix_first: int = 50, seed: int = 7) -> DataFrame:
    """The documents with ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` percent of the documents are cut, ``suffix_first`` percent of those put the suffix first
    (spm), the others the prefix (psm).  Lines are ``[^\\n]*\\n|[^\\n]+``; prefix, middle and suffix may be
    empty.  A null text counts as empty and gives an empty output; empty texts and texts with a mark are
    plain, with null lengths.  A null id draws like the empty text.  Rows are independent of each other:
    repeated ids draw alike, and empty tables give empty results.  Other columns stay as they are, but
    columns with the names above are replaced.
    """

    def work():
        summaries = Summaries()

        def step(part):
            done = rearrange(column(part, "doc_id").to_pylist(), utf8(part), summaries, rate, suffix_first, seed)
            *others, outputs = zip(*done)
            return [*map(list, others), [o.decode() for o in outputs]]

        return step

    added = {
        "n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(),
        "output": StringType(),
    }
    return with_arrays(docs, added, work)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text behind an output; a mark stands in it once, since texts with marks stay plain."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(m.decode() for m in (PREFIX, SUFFIX, MIDDLE)))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def digest(docs: DataFrame) -> DataFrame:
    """Per document the lengths, and hashes of the output and of the text turned back from it."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
