"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts the score.

Everything is a column expression.  Per kind, one regular expression cuts the text into the pieces
between its matches (``split``) and gives the matches (``regexp_extract_all``); running lengths turn
them into code-point positions.  Patterns are written so that they never scan a run of characters
twice: possessive groups, and a look-behind that lets a match begin only at the start of a run or
where the previous match ended.  Running lengths are added up in blocks, and the context of a span is put
together from the pieces around it, so the time for one text follows its length and its matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Characters around a span that are searched for context words.
CONTEXT = 40
#: Pieces on either side that hold the context for sure: a match and the gap before it have 3 characters or more.
NEAR_PIECES = CONTEXT // 3 + 1
#: Extra kinds need this score; base kinds stay at any score.
LEAST_SCORE = 0.5
#: Elements whose running sums are worked out together, and characters of a text that are cut off at a time.
BLOCK, CHUNK = 64, 1024


@dataclass(frozen=True)
class Kind:
    """``hint`` is a cheap pattern that any text with a match also matches."""

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    base: bool
    score: float
    context: str


def digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn check of a string of digits."""
    places = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(
        i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
    ).otherwise(c.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def mod97(code: Column) -> Column:
    """The ISO 7064 check of an account number: country and check digits go last, letters count 10 to 35."""
    moved = F.concat(F.substr(code, F.lit(5), F.length(code)), F.substr(code, F.lit(1), F.lit(4)))
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    rest = F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda a, c: F.when(c == "", a).otherwise((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97),
    )
    return rest == 1


def _small_parts(span: Column) -> Column:
    value = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
    small = lambda part: (F.length(value(part)) <= 3) & (value(part).cast("int") <= 255)
    return F.forall(F.split(span, r"\."), small)


def _compact(span: Column) -> Column:
    return F.regexp_replace(span, " ", "")


#: The base kinds in their listed order, then the kinds that this method adds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         lambda s: F.lit(True), True, 0.8, r"e-?mail|contact|write|address|@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
         _small_parts, True, 0.6, r"\bip\b|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}",
         lambda s: F.length(digits(s)).between(14, 19) & luhn(digits(s)), True, 0.8, r"card|visa|credit|payment|paid"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         lambda s: F.length(digits(s)).between(10, 15), True, 0.6, r"phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
         lambda s: F.length(_compact(s)).between(15, 34) & mod97(_compact(s)), False, 0.7, r"iban|account|bank|transfer"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         lambda s: ~s.rlike("^(?:000|666|9..)-|-00-|-0000$"), False, 0.4, r"ssn|social|security"),
    Kind("short_card", r"(?<![0-9+-])(?:[0-9][\x20-]?){12}[0-9](?![0-9])", r"[0-9](?:[\x20-]?[0-9]){12}",
         lambda s: (F.length(digits(s)) == 13) & luhn(digits(s)), False, 0.3, r"card|visa|credit|payment|paid"),
)

_SPAN = "struct<kind:string,place:int,start:int,end:int,score:double,base:boolean>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each element all elements before it combined, from 0 on; in blocks, so never all pairs of elements."""
    fold = lambda part: F.aggregate(part, F.lit(0), combine)

    def of_blocks(blocks: Column) -> Column:
        return _let(F.transform(blocks, fold), lambda sums: F.flatten(F.transform(blocks, lambda block, i: _let(
            fold(F.slice(sums, F.lit(1), i)),
            lambda start: F.transform(block, lambda x, j: combine(start, fold(F.slice(block, F.lit(1), j)))),
        ))))

    def of_all(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / BLOCK).cast("int")
        return of_blocks_once(F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(every, b * BLOCK + 1, F.lit(BLOCK))
        ))

    of_blocks_once = lambda blocks: _let(blocks, of_blocks)
    return _let(numbers, of_all)


def _spans(text: Column, place: int, kind: Kind) -> Column:
    none = F.array().cast(f"array<{_SPAN}>")
    keep = F.lit(CONTEXT)

    def of_pieces(pieces: Column) -> Column:
        """``pieces``: (gap, value) in order; the last gap has no value."""
        size = lambda x: F.coalesce(F.length(x["value"]), F.lit(0))
        lengths = F.transform(pieces, lambda x: F.length(x["gap"]) + size(x))
        return _let(_running(lengths, lambda a, b: a + b), lambda before: F.filter(
            F.transform(pieces, lambda x, i: span(pieces, x, i, F.get(before, i) + F.length(x["gap"]))),
            lambda s: s.isNotNull(),
        ))

    def span(pieces: Column, x: Column, i: Column, start: Column) -> Column:
        first = F.greatest(i - NEAR_PIECES, F.lit(0))
        left = F.transform(F.slice(pieces, first + 1, i - first), lambda p: F.concat(F.right(p["gap"], keep), p["value"]))
        right = F.transform(
            F.slice(pieces, i + 2, F.lit(NEAR_PIECES)), lambda p: F.concat(F.left(p["gap"], keep), F.coalesce(p["value"], F.lit("")))
        )
        before = F.right(F.concat(F.array_join(left, ""), F.right(x["gap"], keep)), keep)
        near = F.lower(F.concat(before, F.lit(" "), F.left(F.array_join(right, ""), keep))).rlike(kind.context)
        found = F.struct(
            F.lit(kind.name).alias("kind"), F.lit(place).alias("place"), start.alias("start"),
            (start + F.length(x["value"])).alias("end"), (F.lit(kind.score) + F.when(near, 0.2).otherwise(0.0)).alias("score"),
            F.lit(kind.base).alias("base"),
        ).cast(_SPAN)
        return F.when(x["value"].isNotNull() & kind.valid(x["value"]), found)

    values = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    spans = _let(F.arrays_zip(F.split(text, kind.pattern, -1).alias("gap"), values.alias("value")), of_pieces)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)
    return F.when(text.rlike(kind.hint), spans).otherwise(none)


def personal_data(docs: DataFrame, text: str = "text", alias: str = "pii") -> DataFrame:
    """Add the array of spans (kind, place, start, end, score, base) of each whole text.

    ``start`` and ``end`` count code points, ``end`` excluded; spans are ordered by start, then by the
    order of the kinds.  Null and empty texts have no spans.  An extra kind's span that overlaps a
    base span is left out.  All other columns and repeated rows stay as they are.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = F.concat(*[_spans(body, i, k) for i, k in enumerate(KINDS) if k.base])
    extra = F.concat(*[_spans(body, i, k) for i, k in enumerate(KINDS) if not k.base])
    apart = lambda e, b: (e["end"] <= b["start"]) | (b["end"] <= e["start"])
    found = docs.withColumns({f"{alias}_base": base, f"{alias}_extra": extra})
    free = F.filter(F.col(f"{alias}_extra"), lambda e: F.forall(F.col(f"{alias}_base"), lambda b: apart(e, b)))
    by_start = lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"], s["score"], s["base"])
    ordered = F.transform(
        F.array_sort(F.transform(F.concat(f"{alias}_base", free), by_start)),
        lambda s: F.struct(s["kind"], s["place"], s["start"], s["end"], s["score"], s["base"]).cast(_SPAN),
    )
    return found.withColumn(alias, ordered).drop(f"{alias}_base", f"{alias}_extra")


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, spans, max_score."""
    found = personal_data(docs.select("doc_id", "text")).select("doc_id", "pii")
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")
    return found.select(
        "doc_id", *[count(k.name) for k in KINDS if k.base],
        F.sha2(written(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"),
        written(F.col("pii")).alias("spans"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("max_score"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "<{}>") -> DataFrame:
    """The same rows and columns, with every span of the text replaced by a mark such as ``<EMAIL>``.

    Of overlapping spans the first one replaces what it covers, later ones only what lies beyond it.
    A null text stays null.
    """
    kinds = [k.name for k in KINDS]
    found = personal_data(docs, text, "__pii")
    body = F.col(text)
    label = lambda s: F.element_at(F.array(*[F.lit(mark.format(k.upper())) for k in kinds]), s["place"] + 1)

    def done(spans: Column, chunks: Column, ends: Column) -> Column:
        """``ends``: for each span how far the spans before it reach."""
        def part(low: Column, high: Column) -> Column:
            first = F.floor(low / CHUNK).cast("int")
            own = F.slice(chunks, first + 1, F.floor((high - 1) / CHUNK).cast("int") - first + 1)
            return F.when(high <= low, F.lit("")).otherwise(F.substr(F.array_join(own, ""), low - first * CHUNK + 1, high - low))

        marked = F.transform(spans, lambda s, i: _let(F.get(ends, i), lambda at: F.when(
            s["end"] > at, F.concat(part(at, F.greatest(s["start"], at)), label(s))
        ).otherwise(F.lit(""))))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(marked, ""), part(last, F.length(body)))

    changed = _let(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CHUNK}}}"), 0), lambda chunks: _let(
        _running(F.transform("__pii", lambda s: s["end"]), lambda a, b: F.greatest(a, b)), lambda ends: done(F.col("__pii"), chunks, ends)
    ))
    return found.withColumn(text, F.when(F.size("__pii") > 0, changed).otherwise(body)).select(*docs.columns)
