"""Quality rules: text statistics as column expressions, and learned decision lists over them.

The learner sees labelled statistics only, on a coarse grid of quantiles.  Sequential covering grows
one rule at a time: a conjunction of thresholds that covers many texts of one class and few of the
other, chosen on two thirds of the rows; conditions that do not help on the other third are pruned.
Covered rows leave, and the next rule is grown.  The result is an ordered list of rules, emitted as
one ``CASE WHEN`` expression over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.materialise import cut_lineage

BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Statistics a rule may test, all shares or means, so that they mean the same in short and long texts.
FEATURES = (
    "symbol_share", "upper_share", "line_share", "repeat_share", "word_length", "mark_share", "digit_share",
    "bar_share", "words_log",
)
#: At most so many labelled rows, those with the smallest hashes of the id, are learned from.
LEARN_ROWS = 20_000
#: Thresholds per statistic and class.
CUTS = 20
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right for this share of what it covers, in the part it was not grown on as well.
PRECISION = 0.97
#: Fewest rows that a rule covers in the part it is grown on.
SUPPORT = 5


def _runs(words: Column, window: int) -> Column:
    """Hashes of all runs of ``window`` words; null for a shorter text."""
    return F.when(F.size(words) >= window, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (window - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(words, i, window)),
    ))


def _twice(placed: Column) -> Column:
    """Positions, in order, of the runs that occur twice, from (hash, position) sorted by hash."""
    same = lambda p, k: F.coalesce(F.get(placed, k)["h"] == p["h"], F.lit(False))
    twice = F.filter(placed, lambda p, k: same(p, k - 1) | same(p, k + 1))
    return F.array_sort(F.transform(twice, lambda p: p["i"]))


def _covered(twice: Column, window: int) -> Column:
    """Words in those runs: each run adds the words up to the next run, or all its words."""
    return F.aggregate(
        twice, F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(window))).alias("n")),
        lambda a: a["n"],
    )


def statistics(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and the statistics of each whole text; null texts count as empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as counts, and the shares of FEATURES.
    Runs of words are compared by 64-bit hashes.  Repeated rows get equal rows; of the other columns those
    in ``carry`` stay, whose names must differ from all these.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, BLANK), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda chars: F.length("__text") - F.length(F.regexp_replace("__text", chars, ""))
    parted = docs.select("doc_id", *carry, text.alias("__text"), words.alias("__words"), lines.alias("__lines"))
    # One step per column that an expression reads more than once, so that each is computed once.
    runs = parted.withColumn("__runs", _runs(F.col("__words"), window))
    repeated = F.size(F.array_distinct("__runs")) < F.size("__runs")
    pairs = F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    parted = runs.withColumn("__placed", F.when(repeated, F.array_sort(pairs)))
    counted = parted.select(
        "doc_id", *carry,
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        without(r"[#*$%&|<>]").cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(_covered(_twice(F.col("__placed")), window), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("__lines").alias("__n_lines"),
        without("[A-Z]").alias("__upper"), without("[0-9]").alias("__digits"), without("[!?;:=]").alias("__marks"),
        without(r"\|").alias("__bars"),
    )
    per = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return counted.withColumns({
        "symbol_share": per("n_symbols", "n_words"), "upper_share": per("__upper", "word_chars"),
        "line_share": per("n_dup_lines", "__n_lines"), "repeat_share": per("n_repeat_words", "n_words"),
        "word_length": per("word_chars", "n_words"), "mark_share": per("__marks", "n_words"),
        "digit_share": per("__digits", "word_chars"), "bar_share": per("__bars", "n_words"),
        "words_log": F.log1p("n_words"),
    }).drop("__n_lines", "__upper", "__digits", "__marks", "__bars")


@dataclass(frozen=True)
class Rule:
    """``conditions`` are (statistic, '>=' or '<', threshold); all must hold."""

    conditions: tuple[tuple[str, str, float], ...]
    good: bool

    def covers(self, row) -> bool:
        return all(row[f] >= t if op == ">=" else row[f] < t for f, op, t in self.conditions)

    def column(self) -> Column:
        out = F.lit(True)
        for f, op, t in self.conditions:
            out = out & ((F.col(f) >= t) if op == ">=" else (F.col(f) < t))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {op} {t:.4g}" for f, op, t in self.conditions) + f" -> {'keep' if self.good else 'reject'}"


def _weight(rows, good: bool) -> tuple[int, int]:
    right = sum(r["n"] for r in rows if r["label"] == good)
    return right, sum(r["n"] for r in rows) - right


def _grow(rows: list[dict], cuts: dict[str, list[float]], good: bool) -> tuple:
    """Add the condition with the largest information gain until the rule covers one class only."""
    conditions, own = (), rows
    right, wrong = _weight(own, good)
    while wrong and len(conditions) < MAX_CONDITIONS:
        purity, best = math.log2(right / (right + wrong)), None
        for feature, thresholds in cuts.items():
            # Counts per grid cell, then running sums: one look at the rows per statistic.
            cells: dict[int, list[int]] = {}
            for r in own:
                cell = cells.setdefault(r["cell"][feature], [0, 0])
                cell[r["label"] != good] += r["n"]
            below = [0, 0]
            for k, threshold in enumerate(thresholds):
                for j in (0, 1):
                    below[j] += cells.get(k, (0, 0))[j]
                for op, p, n in (("<", *below), (">=", right - below[0], wrong - below[1])):
                    if p >= SUPPORT and (p, n) != (right, wrong):
                        gain = p * (math.log2(p / (p + n)) - purity)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, (feature, op, threshold))
        if best is None or best[0] <= 1e-9:
            break
        conditions += (best[1],)
        own = [r for r in own if Rule((best[1],), good).covers(r)]
        right, wrong = _weight(own, good)
    return conditions


def _prune(conditions: tuple, rows: list[dict], good: bool) -> tuple:
    """Drop conditions, the last first, while that does not make the rule worse on rows not grown on."""
    def worth(own: tuple) -> float:
        right, wrong = _weight([r for r in rows if Rule(own, good).covers(r)], good)
        return (right + 1) / (right + wrong + 2)

    best = conditions
    while len(best) > 1 and worth(best[:-1]) >= worth(best):
        best = best[:-1]
    return best


def _candidate(left: list[dict], cuts: dict[str, list[float]], good: bool) -> tuple[float, Rule] | None:
    """The next rule for one class and what it gains (in bits); None if there is no rule sure enough."""
    grown_on, other = [r for r in left if r["part"] < 2], [r for r in left if r["part"] == 2]
    all_right, all_wrong = _weight(left, good)
    if _weight(grown_on, good)[0] < SUPPORT:
        return None
    conditions = _grow(grown_on, cuts, good)
    for own in dict.fromkeys((_prune(conditions, other, good), conditions) if conditions else ()):
        right, wrong = _weight([r for r in left if Rule(own, good).covers(r)], good)
        # Sure enough: right nearly always, and wrong at most half as often as the class is among what is left.
        sure = right >= PRECISION * (right + wrong) and 2 * wrong * (all_right + all_wrong) <= all_wrong * (right + wrong)
        if right >= SUPPORT and sure:
            return right * (math.log2(right / (right + wrong)) - math.log2(all_right / (all_right + all_wrong))), Rule(own, good)
    return None


def cover(rows: Sequence[dict], cuts: dict[str, list[float]]) -> list[Rule]:
    """An ordered list of rules by sequential covering; the first that covers a text decides, the rest is kept.

    Each step grows a rule for either class and takes the one that gains more, so a rule that keeps can
    stand before one that would reject too much.  ``rows`` hold the statistics, ``cell`` (grid cell per
    statistic), ``label`` (good or not), ``n`` (how many texts), and ``part`` (0 to 2; part 2 is not grown on).
    Rules that keep at the end of the list change nothing and are left out.
    """
    rules: list[Rule] = []
    left = list(rows)
    while len(rules) < MAX_RULES:
        found = [c for c in (_candidate(left, cuts, good) for good in (False, True)) if c]
        if not found:
            break
        rule = max(found, key=lambda c: c[0])[1]
        rules.append(rule)
        left = [r for r in left if not rule.covers(r)]
    while rules and rules[-1].good:
        rules.pop()
    return rules


def _known(labels: DataFrame, label: str) -> DataFrame:
    """The ids with a label 0 or 1; of several labels the smallest counts."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("__label"))


def learn(measured: DataFrame, labels: DataFrame, label: str = "quality", most: int = LEARN_ROWS) -> list[Rule]:
    """Learn from ``measured`` (doc_id and statistics) where ``labels`` (doc_id, ``label`` 0 or 1) knows
    the row.  Of the rows that are known, at most ``most``, with the smallest hashes of the id, reach the
    driver, already reduced to statistics; of rows that share an id the smallest statistics count.
    Unknown labels and null ids are left out; without rows there are no rules.
    """
    own = measured.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("s"))
    sample = cut_lineage(
        own.join(_known(labels, label), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        .select("doc_id", "__label", "s.*")
    )
    points = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    # Quantiles of either class: what marks the rare class lies far out among all texts.
    sides = sample.groupBy("__label").agg(*[F.percentile_approx(f, points, 10_000).alias(f) for f in FEATURES]).collect()
    cuts = {f: sorted({t for r in sides for t in r[f] or [] if t is not None}) for f in FEATURES}
    rows = []
    for r in sample.select("__label", (F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3))).alias("part"), *FEATURES).orderBy("doc_id").toLocalIterator():
        row = {f: r[f] for f in FEATURES} | {"label": r["__label"] == 1, "part": r["part"], "n": 1}
        row["cell"] = {f: sum(t <= r[f] for t in cuts[f]) for f in FEATURES}
        rows.append(row)
    return cover(rows, cuts)


def verdict(rules: Sequence[Rule]) -> Column:
    """The ordered conditional expression of a rule list: true keeps the text."""
    out = None
    for rule in rules:
        out = (F.when if out is None else out.when)(rule.column(), F.lit(rule.good))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, the columns in ``carry``, the statistics, base_failed and kept for each row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated runs.  ``kept`` is false
    if the base fails, else what the learned list says; texts that no rule covers are kept.  Every row
    is judged by its own text, whatever its id; an empty table gives no rows.
    """
    rules = learn_from(docs, labels)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # Stored, so that a caller's filter on the verdict is not pushed into the array expressions, where each
    # of them would be computed again wherever it is read.
    measured = cut_lineage(statistics(docs, carry=carry))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))


def learn_from(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = LEARN_ROWS) -> list[Rule]:
    """Learn from whole documents: only the statistics of the labelled sample are computed.

    The bound is on documents that have a label, so labels of other documents take no place in it.
    """
    known = _known(labels, label)
    # At most ``most`` ids at any input size, so they may be broadcast.
    ids = cut_lineage(
        docs.select("doc_id").join(known, "doc_id", "left_semi").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    return learn(statistics(chosen), known.join(F.broadcast(ids), "doc_id", "left_semi").withColumnRenamed("__label", label), label, most)
