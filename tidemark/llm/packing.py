"""Packing tokenised documents into fixed windows by minimum bin slack.

A document longer than a window is cut into whole windows and a remainder.  How many remainders of
each length there are is a table of at most ``window`` numbers, whatever the size of the corpus.
On that table the planner repeatedly looks for the multiset of lengths that fills a window closest:
a bitset (one bit per reachable sum) runs over the lengths, the best reachable sum is traced back
to counts per length, and the pattern is used as often as the remaining counts allow.  Each
pattern uses up a length, so there are at most as many patterns as lengths.

Documents meet their place by rank: the r-th remainder of a length belongs to the pattern whose
range of ranks holds r.  Ranks come from counters inside the tasks that tokenise plus a running
total over the tasks, so no length, however common, meets in one task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import lists, text_parts
from tidemark.operators.materialise import cut_lineage

WINDOW = 4096
END = 2
#: Bytes that a worker's remembered parts may take, and what a part takes besides its letters and ids.
REMEMBERED_BYTES, PART_BYTES = 64 << 20, 200

#: The parts that the vocabulary's own pattern finds in a lower-cased chunk of plain letters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: Texts of ASCII and precomposed Latin-1 letters, which normalisation leaves alone.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")


class Parts(dict):
    """Ids of parts as bytes, worked out when first asked for.

    When half of ``most`` bytes are held, they become the older half, and the half before them is
    forgotten; what is asked for again moves to the younger half.  So memory is bounded and frequent
    parts stay.
    """

    def __init__(self, ids_of, most: int):
        super().__init__()
        self.ids_of, self.most, self.held, self.older = ids_of, most, 0, {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            found = self.ids_of(part)
        if 2 * self.held > self.most:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self[part] = found
        self.held += len(part) + len(found) + PART_BYTES
        return found


class Tokens:
    """Ids of texts as little-endian 32-bit bytes, by the ``tokenizers`` library, part by part.

    The vocabulary splits at white space and then by its pattern before anything else, so a text's
    ids are those of its parts, and a part goes straight to the library's model, its letters written
    as that model spells bytes.  Texts with other letters, and chunks that may hold a special token, are
    left to the whole library in blank-separated chunks.
    """

    def __init__(self, path: str, most: int = REMEMBERED_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spelt = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {ord(c): spelt(c)[0][0] for c in map(chr, range(33, 256)) if _PLAIN.fullmatch(c)}
        self.parts = Parts(self._ids, most)

    def _ids(self, part: str) -> bytes:
        if "<|" not in part and _PLAIN.fullmatch(part):
            return array("I", [t.id for t in self.model.tokenize(part.translate(self.letters))]).tobytes()
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if "<|" not in text and _PLAIN.fullmatch(text):
            return _PARTS.findall(text.lower())
        out: list[str] = []
        for raw in text.encode().split():
            chunk = raw.decode()
            if "<|" not in chunk and _PLAIN.fullmatch(chunk):
                out += _PARTS.findall(chunk.lower())
            else:
                out.append(chunk)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        get = self.parts.__getitem__
        return [b"".join(map(get, self.split(t))) for t in texts]


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def best_fill(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum comes closest to ``window`` from below.

    One bitset per length: bit s tells whether sum s can be reached with the lengths so far.  Counts
    are split into powers of two, so a length with many documents costs a few shifts.
    """
    mask = (1 << (window + 1)) - 1
    steps, reach, states = [], 1, [1]
    for length in sorted(counts, reverse=True):
        left, take = min(counts[length], window // length), 1
        while left > 0:
            take = min(take, left)
            reach |= (reach << (take * length)) & mask
            steps.append((length, take))
            states.append(reach)
            left -= take
            take *= 2
        if reach >> window & 1:
            break
    total, used = reach.bit_length() - 1, Counter()
    for k in range(len(steps) - 1, -1, -1):
        length, take = steps[k]
        if not states[k] >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(how often, lengths per window) until all remainders are placed."""
    left, out = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        # The longest remainder opens the window: it is the hardest to place.
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if c > (n == longest)}
        fill = Counter(best_fill({n: c for n, c in rest.items() if n <= window - longest}, window - longest))
        fill[longest] += 1
        often = min(left[n] // c for n, c in fill.items())
        out.append((often, dict(fill)))
        for n, c in fill.items():
            left[n] -= c * often
            if not left[n]:
                del left[n]
    return out


def places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, per window, offset) of all patterns."""
    used, rows, sequence = Counter(), [], 0
    for often, fill in patterns:
        offset = 0
        for length in sorted(fill, reverse=True):
            n = fill[length]
            rows.append((length, used[length], used[length] + n * often, sequence, n, offset))
            used[length] += n * often
            offset += n * length
        sequence += often
    return rows


_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "task bigint, whole boolean, rank bigint, ids binary"
)


def _cut(path: str, window: int, end: int, with_ids: bool):
    def work(batches):
        task, wholes, ranks = TaskContext.get().partitionId(), 0, Counter()
        closing = np.array([end], "<u4").tobytes()
        for keys, texts in lists(text_parts(batches, 1 << 20), "doc_id", "text"):
            rows = []
            for key, raw in zip(keys, tokens(path).encode(texts)):
                raw += closing
                n = len(raw) // 4
                for start in range(0, n, window):
                    part = raw[4 * start: 4 * (start + window)]
                    size = len(part) // 4
                    if size == window:
                        rank, wholes = wholes, wholes + 1
                    else:
                        rank = ranks[size]
                        ranks[size] += 1
                    rows.append((key, start, size, zlib.crc32(part), n, task, size == window, rank, part if with_ids else None))
            kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in _PIECES.split(", ")]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return work


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``ids`` too (the
    piece's ids as little-endian 32-bit bytes) if asked for.  Each document is its ids and ``end``;
    null and empty texts are the end id alone.  Repeated rows, and rows with a null doc_id, are
    documents of their own.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut_lineage(plain.mapInArrow(_cut(path, window, end, with_ids), _PIECES))
    # One row per task and length; ranks continue from task to task.
    per_task = cut_lineage(
        pieces.groupBy("whole", "length", "task").agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(
            Window.partitionBy("whole", "length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        ), F.lit(0)))
    )
    # At most ``window`` counts reach the driver.
    counts = {
        r["length"]: r["n"] for r in per_task.filter("not whole").groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    patterns = plan(counts, window)
    rows = places(patterns)
    first_whole = sum(often for often, _ in patterns)
    # Bounded by the window: at most that many patterns, each with few distinct lengths.
    table = spark.createDataFrame(
        rows, "length bigint, rank_from bigint, rank_to bigint, first_sequence bigint, each bigint, base bigint"
    )
    ranked = (
        # The counts grow with the tasks, so they are shuffled; a key has the pieces of one task at most.
        pieces.join(per_task.drop("n").hint("merge"), ["whole", "length", "task"])
        .withColumn("place", F.col("before") + F.col("rank"))
    )
    output = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    wholes = ranked.filter("whole").withColumns(
        {"sequence_id": F.lit(first_whole) + F.col("place"), "offset": F.lit(0).cast("bigint")}
    )
    within = (F.col("place") >= F.col("rank_from")) & (F.col("place") < F.col("rank_to"))
    turn = F.col("place") - F.col("rank_from")
    rest = (
        ranked.filter("not whole").join(F.broadcast(table), "length").filter(within)
        .withColumns({
            "sequence_id": F.col("first_sequence") + F.floor(turn / F.col("each")),
            "offset": F.col("base") + (turn % F.col("each")) * F.col("length"),
        })
    )
    return wholes.select(*output).unionByName(rest.select(*output))
