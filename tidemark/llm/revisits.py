"""Not-modified revisit resolution for web archive records.

A revisit record says that a page had not changed.  It is resolved by an as-of join: the latest
earlier full response of the same canonical URL, if the validators agree.  The headers of the
revisit then update those of the stored response, except the ones that describe the stored body.

One URL may hold a large share of all records, so a URL is cut into buckets along time.  A window
works inside each (URL, bucket), and one row per bucket carries the last response over the cuts.
Payloads do not travel: only identifiers, validators and headers do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.materialise import cut_lineage
from tidemark.operators.running import range_buckets

#: Headers of a 304 answer that never replace those of the stored response (RFC 9110 and 9111): they
#: belong to the body or to the connection.
FIXED_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authorization", "set-cookie", "te", "trailer", "trailers",
    "transfer-encoding", "upgrade", "warning",
)
#: Query parameters that do not change what is shown.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid|phpsessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """The URL as a key: lower-case host without scheme, ``www.``, port 80 or 443; no fragment, no
    tracking parameters, the others sorted; no final slash.  Null gives null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(
        F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_sort(F.filter(
        F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)
    ))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _strong(etag: Column) -> Column:
    """The opaque part of an entity tag: a 304 is decided by weak comparison, which ignores ``W/``."""
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers updated by those of the revisit, without the ones that must not change."""
    allowed = F.map_filter(F.coalesce(fresh, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*FIXED_HEADERS))
    return F.map_zip_with(stored, allowed, lambda k, a, b: F.coalesce(b, a))


def resolve_revisits(records: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per revisit record, resolved where possible.

    ``records`` holds record_id, url, at (timestamp), kind ('response' or 'revisit'), status, headers
    (map of lower-case names), digest (of the payload of a response).  Result: record_id, url_key, at,
    response_id, outcome, headers, digest.

    Only responses with status 200 are full.  Records of one URL are ordered by (at, record_id), so of
    equal times the smaller id is the earlier.  ``outcome``: 'no_response' if there is none before;
    else by the first validator that both carry, entity tag before last-modified: 'etag' or
    'last_modified' if they agree, 'changed' if not; 'unchecked' if they share none.  'etag',
    'last_modified' and 'unchecked' give the response's digest and the merged headers; otherwise the
    digest is null and the headers are the revisit's own.  Records with a null URL match nothing, null
    times come first, records of other kinds are ignored, and repeated revisits are answered each.
    """
    micros = F.coalesce(F.unix_micros("at"), F.lit(-(1 << 50)))
    used = cut_lineage(records.filter(
        (F.col("kind") == "revisit") | ((F.col("kind") == "response") & (F.col("status") == 200))
    ).select(
        "record_id", "kind", "at", "headers", "digest", canonical_url(F.col("url")).alias("url_key"),
        micros.alias("__micros"), F.coalesce("record_id", F.lit(0)).cast("bigint").alias("__id"),
    ))
    # Cuts along time, and along the ids of one moment, at quantiles: they only balance the buckets.
    span = used.agg(*[f(c).alias(f"{n}_{c}") for c in ("__micros", "__id") for n, f in (("low", F.min), ("high", F.max))]).first()
    low, first = span["low___micros"] or 0, span["low___id"] or 0
    width = float((span["high___id"] or 0) - first + 1)
    used = used.withColumn("__order", (F.col("__micros") - low).cast("double") + (F.col("__id") - first) / width)
    bucketed = range_buckets("__order", used.select("__order"), buckets, "__bucket")(used)
    response = F.when(F.col("kind") == "response", F.struct("record_id", "headers", "digest"))
    # A null URL is a key of its own per record: such records are spread and match nothing.
    lone = F.when(F.col("url_key").isNull(), F.col("record_id"))
    placed = bucketed.withColumns({"__response": response, "__lone": lone}).drop("__micros", "__id", "__order")
    keys = ["__key", "__bucket"]
    keyed = placed.withColumn("__key", F.struct("url_key", "__lone"))
    order = F.struct("at", "record_id")
    ends = keyed.groupBy(*keys).agg(F.max_by("__response", F.when(F.col("kind") == "response", order)).alias("__end"))
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, F.last("__end", ignorenulls=True).over(before).alias("__carried"))
    inside = Window.partitionBy(*keys).orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    joined = keyed.withColumn("__near", F.last("__response", ignorenulls=True).over(inside)).filter(
        F.col("kind") == "revisit").join(carried, keys)
    found = F.coalesce("__near", "__carried")
    both = joined.withColumn("__found", F.when(F.col("url_key").isNotNull(), found))
    own, stored = F.col("headers"), F.col("__found.headers")
    tags = (_strong(own["etag"]), _strong(stored["etag"]))
    dates = (own["last-modified"], stored["last-modified"])
    outcome = (
        F.when(F.col("__found").isNull(), "no_response")
        .when(tags[0] == tags[1], "etag").when(tags[0] != tags[1], "changed")
        .when(dates[0] == dates[1], "last_modified").when(dates[0] != dates[1], "changed")
        .otherwise("unchecked")
    )
    valid = F.col("outcome").isin("etag", "last_modified", "unchecked")
    return both.withColumn("outcome", outcome).select(
        "record_id", "url_key", "at", F.col("__found.record_id").alias("response_id"), "outcome",
        F.when(valid, merged_headers(stored, own)).otherwise(own).alias("headers"),
        F.when(valid, F.col("__found.digest")).alias("digest"),
    )


def crawl_records(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of ``pages`` (page_id, url, html): each page is fetched once and asked
    for again later, with the validators that its first answer carried.

    The ways in which servers differ follow the page: a third send no entity tag, some send it weak the
    second time, some neither validator.  A page of the same canonical URL fetched in between makes
    the revisit's validators disagree.  Null pages have an empty payload.
    """
    n = F.coalesce(F.col("page_id"), F.lit(0))
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    tag = F.when(n % 3 != 0, F.concat(F.lit('"'), F.substr(F.md5(body), F.lit(1), F.lit(16)), F.lit('"')))
    changed = F.when(n % 7 != 0, F.date_format(F.timestamp_seconds(1_700_000_000 - n * 977), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    kept = lambda entries: F.map_filter(F.map_from_entries(F.array(
        *[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in entries.items()]
    )), lambda k, v: v.isNotNull())
    first = kept({
        "content-type": F.lit("text/html"), "content-length": F.octet_length(body), "etag": tag,
        "last-modified": changed, "cache-control": F.lit("max-age=600"), "server": F.concat(F.lit("s"), n % 5),
    })
    again = kept({
        "content-length": F.lit("0"), "etag": F.when(n % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag),
        "last-modified": changed, "cache-control": F.concat(F.lit("max-age="), 60 * (1 + n % 10)),
        "expires": F.concat(F.lit("t"), n), "set-cookie": F.concat(F.lit("v="), n),
    })
    shared = [F.col("url")]
    answer = pages.select(
        (2 * n).alias("record_id"), *shared, F.timestamp_seconds(1_700_000_000 + 60 * n).alias("at"),
        F.lit("response").alias("kind"), F.lit(200).alias("status"), first.alias("headers"), F.sha1(body).alias("digest"),
    )
    asked = pages.select(
        (2 * n + 1).alias("record_id"), *shared, F.timestamp_seconds(1_700_000_000 + 60 * n + 3600 * (1 + n % 240)).alias("at"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"), again.alias("headers"), F.lit(None).cast("string").alias("digest"),
    )
    return answer.unionAll(asked)


def headers_text(headers: Column) -> Column:
    """``name: value`` lines in the order of the names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")
