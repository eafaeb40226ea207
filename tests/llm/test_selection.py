"""Resampling, substring deduplication and fill-in-the-middle against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.llm import checks, fill_middle, relative_parsing, resampling

DOCS = "doc_id bigint, text string, lang string, score double, rank int, n string, spans int, text_key int, removed string"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))
TEXTS = [
    (1, "One two  three\nfour, FIVE six-seven\n" * 12), (2, None), (3, ""), (4, "\n\n \t\n"), (5, LONG), (6, LONG + " tail\nend"),
    (7, "Éa é\u0085x  y 😀 z_9\n" * 30), (8, "holds a <P> mark\nand more"), (9, "no line end"), (None, "no id here\n" * 9),
    (10, "one two three\nfour five six seven\n" * 12), (11, "a" * 200_000), (12, "q\n" * 5000),
]


def spread(spark, texts, repeat=True):
    """Nulls in every column, a repeated row, and columns whose names clash with results."""
    data = [(i, t, None, None, None, None, None, None, None) for i, t in texts]
    data += [(texts[0][0], texts[0][1], "en", 0.5, 3, "n", 1, 2, "r")] if repeat else []
    return spark.createDataFrame(data, DOCS).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spread(spark, TEXTS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_sql(sql, texts, target=()):
    con = duckdb.connect()
    for name, columns, data in (("documents", "doc_id BIGINT, text VARCHAR", texts), ("benchmark", "item_id BIGINT, text VARCHAR", target)):
        con.execute(f"CREATE TABLE {name} ({columns})")
        if data:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    return con.execute(sql).fetchall()


def as_rows(values):
    return sorted(map(tuple, values), key=lambda r: tuple((v is None, str(v)) for v in r))


# -- fill in the middle ------------------------------------------------------------------------


def brute_fill(doc_id, text, rate=100, suffix_first=50, seed=7):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    draw = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(draw[k:k + 8], 16) for k in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text or ""
    p, m, s = ("".join(part) for part in (lines[:low], lines[low:high], lines[high:]))
    if h[3] % 100 < suffix_first:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.text(st.sampled_from("ab \n\né😀x<P>SM"), max_size=300), max_size=12), st.integers(0, 100), st.integers(0, 2000))
@settings(max_examples=150, deadline=None)
def test_cuts_equal_those_of_the_lines(texts, rate, cache):
    ids = list(range(len(texts)))
    texts = [t * 40 if len(t) % 3 == 0 else t for t in texts]
    got = fill_middle.rearrange(ids, [t.encode() for t in texts], fill_middle.Summaries(cache), rate, 50, 7)
    assert [(*r[:4], r[4].decode()) for r in got] == [brute_fill(i, t, rate) for i, t in zip(ids, texts)]


def test_shared_chunks_are_counted_once():
    rng = random.Random(3)
    passage = bytes(rng.randrange(32, 127) for _ in range(50_000))
    alone, both = fill_middle.Summaries(), fill_middle.Summaries()
    fill_middle.Chunked([b"one " + passage], alone)
    fill_middle.Chunked([b"one " + passage, b"another start " + passage], both)
    assert both.counted - alone.counted < 8 < alone.counted


def test_fill_in_middle(spark, docs, nothing):
    got = fill_middle.fill_in_middle(docs, seed=7)
    assert set(got.columns) == {*docs.columns, "form", "prefix_chars", "middle_chars", "output"}
    want = [(i, t, *brute_fill(i, t)) for i, t in [*TEXTS, TEXTS[0]]]
    assert rows(got.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output")) == as_rows(want)
    back = got.filter(~fill_middle.restored().eqNullSafe(F.coalesce("text", F.lit(""))))
    assert back.count() == 0
    assert {r[0] for r in got.select("form").distinct().collect()} == {"plain", "spm", "psm"}
    some = fill_middle.fill_in_middle(docs, rate=40, suffix_first=0, seed=1)
    assert rows(some.select("doc_id", "output")) == as_rows((i, brute_fill(i, t, 40, 0, 1)[4]) for i, t in [*TEXTS, TEXTS[0]])
    assert fill_middle.digest(nothing).collect() == []
    assert rows(fill_middle.digest(docs)) == as_rows(by_sql(checks.FILL_IN_MIDDLE, [*TEXTS, TEXTS[0]]))


# -- substring deduplication -------------------------------------------------------------------


def brute_repeats(texts, window):
    first, split = {}, [(i, (t or "").encode().split()) for i, t in texts]
    for i, words in split:
        for k in range(len(words) - window + 1) if i is not None else ():
            key = tuple(words[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1) if i is not None else ():
            if first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return as_rows(out)


def passages(seed, vocabulary, documents=50):
    """Documents put together from shared passages, some in periods, with nulls and repeated ids."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    shared = [[rng.choice(words) for _ in range(rng.choice([6, 8, 9, 20, 60]))] for _ in range(12)]
    out = []
    for i in range(documents):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 12))]
        out.append((rng.choice([i, i, i, i // 2, None]), rng.choice([" ", "\n", "\t "]).join(parts) if rng.random() < 0.95 else None))
    return out + out[:5]


COLUMNS = ["doc_id", "n_words", "n_removed", "kept_text"]


@pytest.mark.parametrize("seed, vocabulary", [(1, 2), (2, 30), (3, 500)])
@pytest.mark.parametrize("block_stretches", [4096, 1])
def test_repeats_by_either_way(spark, seed, vocabulary, block_stretches):
    texts = passages(seed, vocabulary)
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    got = relative_parsing.remove_repeats(df, 8, 4, block_stretches).select(COLUMNS)
    assert rows(got) == brute_repeats(texts, 8)


@given(st.lists(st.lists(st.integers(0, 2), min_size=5, max_size=60), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_block_finds_every_earlier_window(texts):
    import numpy as np

    block, seen = relative_parsing.Block(5), set()
    for doc, text in enumerate(texts):
        words = np.array(text, np.uint64)
        windows = [tuple(text[k:k + 5]) for k in range(len(text) - 4)]
        spans = block.parse(doc, words)
        assert {k for a, b in spans for k in range(a, b)} == {k for k, w in enumerate(windows) if w in seen}
        seen |= set(windows)


def test_substring_dedup_of_hard_texts(spark, docs, nothing):
    texts = [*TEXTS, TEXTS[0]]
    got = relative_parsing.remove_repeats(docs)
    assert set(got.columns) == {*docs.columns, "n_words", "n_removed", "kept_text"}
    assert rows(got.select(COLUMNS)) == brute_repeats(texts, 50)
    ranges = {r["doc_id"]: r["removed"] for r in got.collect()}
    assert ranges[6] == [0, 60_000] and ranges[5] == []
    assert relative_parsing.digest(nothing).collect() == []
    assert rows(relative_parsing.digest(docs)) == as_rows(by_sql(checks.REPEATS, texts))


def test_a_passage_of_most_documents(spark):
    """A line of 60 words in many contexts; only its first document keeps it."""
    rng, line = random.Random(4), " ".join(f"common{i}" for i in range(60))
    texts = [(i, " ".join([f"a{rng.random()}" for _ in range(30)] + [line] + [f"b{rng.random()}" for _ in range(30)])) for i in range(150)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    for most in (4096, 3):
        got = relative_parsing.remove_repeats(df, block_stretches=most).select("doc_id", "n_removed", "removed")
        assert rows(got) == as_rows((i, 60 if i else 0, [30, 90] if i else []) for i in range(150))


# -- importance resampling ---------------------------------------------------------------------


def features(text, width=2):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    runs = [" ".join(words[i:i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(run.encode()) for run in runs]


def brute_draw(texts, target, percent=25, least=20, buckets=10_000):
    read = [(i, *features(t)) for i, t in texts]
    s, t = (collections.Counter(h % buckets for f in found for h in f) for found in ([r[2] for r in read], [features(x)[1] for _, x in target]))
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    scored = []
    for i, n_words, found in read:
        gain = sum(math.floor(1000 * math.log((t[h % buckets] + 1) * s_all / ((s[h % buckets] + 1) * t_all))) for h in found)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = gain // len(found) if found else 0
        scored.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words >= least])
    able = sorted((r for r in scored if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = place
    return as_rows(r[:5] for r in scored)


@given(st.text(st.sampled_from("abZ9 .,é😀\x85\x7f_ \n"), max_size=400), st.integers(1, 3), st.sampled_from([3, 17, 1 << 20]))
@settings(max_examples=150, deadline=None)
def test_chained_hashes_are_those_of_the_joined_words(text, width, size):
    got = list(resampling.run_hashes(text.encode(), width, size))
    n, want = features(text, width)
    assert sum(k for k, _ in got) == n
    assert sorted(h for _, hashes in got for h in hashes.tolist()) == sorted(want)


TARGET = [(1, "seven words that look like these here"), (2, None), (3, "one two three four")]


def test_draw_towards_a_target(spark, docs, nothing):
    rng = random.Random(6)
    more = [(100 + i, " ".join(rng.choice(["one", "two", "seven", "look", "w1", "w2", "x"]) for _ in range(rng.randrange(60)))) for i in range(80)]
    texts = [*TEXTS, *more, TEXTS[0]]
    frame = spread(spark, TEXTS + more)
    target = spark.createDataFrame(TARGET, "item_id bigint, text string")
    got = rows(resampling.digest(frame, target))
    assert got == brute_draw(texts, TARGET)
    assert got == as_rows(by_sql(checks.RESAMPLING, texts, TARGET))
    drawn = resampling.resample(frame, target, percent=50)
    assert set(drawn.columns) == {*frame.columns, "n_words", "n_features", "weight"}
    assert sorted(r["rank"] for r in drawn.collect()) == list(range(1, drawn.count() + 1))
    assert resampling.digest(nothing, target).collect() == []
    alone = resampling.digest(frame, target.limit(0))
    assert rows(alone) == brute_draw(texts, [])


def test_ties_are_drawn_by_id(spark):
    scored = spark.createDataFrame([(i, 30, 5 if i is None or i % 3 else -4000) for i in [7, 3, 5, 1, 9, 12, 6, None]], "doc_id bigint, n_words bigint, score bigint")
    got = {r["doc_id"]: r["rank"] for r in resampling.draw(scored, percent=50).collect()}
    assert got == {1: 1, 5: 2, 7: 3, None: 4, 3: None, 6: None, 9: None, 12: None}


def test_every_document_of_one_score_level(spark):
    scored = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(20).alias("n_words"), (F.col("id") % 2).alias("score"))
    got = {r["doc_id"]: r["rank"] for r in resampling.draw(scored).filter("rank IS NOT NULL").collect()}
    assert got == {2 * k + 1: k + 1 for k in range(250)}
