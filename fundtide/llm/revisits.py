"""WARC records: what a not-modified revisit stands for.

A revisit record says that a URL had not changed, and carries no body.  It is resolved by
an as-of join: the latest earlier full response of the same canonical URL.  Their
validators must agree; then the revisit takes over the response's payload and headers,
and replaces those headers that a 304 response may replace.

Records: record_id bigint, url string, captured_at bigint (or timestamp), record_type
('response' or 'revisit'), status int, headers map<string, string> (names in lower case),
payload_digest string.  Bodies are not needed and do not move; ``refers_to`` names the
record that has the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a 304 response updates (fixed values of HTTP).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not change what is served.
TRACKING = "^(utm_[a-z]+|ref)="
#: Parts of the time range that a URL's records are dealt into, so that a URL of any size spreads.
SLICES = 64


def canonical_url(url: Column) -> Column:
    """Host in lower case without www, default port and scheme; path without a closing slash;
    parameters sorted and without tracking; no fragment.  Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place, query = F.split_part(bare, F.lit("?"), F.lit(1)), F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(place, "^([^/]*)", 1)), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "^[^/]*(.*)$", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def latest_earlier(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """Every revisit, all columns, with ``stored``: what its latest earlier full response has; null without one.

    Earlier means a smaller captured_at; of responses captured at once the largest
    record_id counts.  Each URL's time is cut into slices: the last response of every slice
    is aggregated, carried forward over the slices, and meets the revisits of later ones.
    Digest and headers travel with the response, so nobody looks it up by its record_id: a
    response that many revisits refer to would be a hot key.
    """
    timed = records.withColumn("at", F.col("captured_at").cast("bigint")).withColumn("full", F.col("record_type") == "response")
    low, high = timed.agg(F.min("at"), F.max("at")).first()
    width = max(1, ((high or 0) - (low or 0)) // slices + 1)
    timed = timed.withColumn("slice", F.floor((F.col("at") - F.lit(low or 0)) / F.lit(width)))
    place = F.when(F.col("full"), F.struct("at", "record_id"))
    own = F.when(F.col("full"), F.struct(F.col("record_id").alias("refers_to"), "payload_digest", "headers"))

    last = timed.groupBy("url_key", "slice").agg(F.max_by(own, place).alias("last"))
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url_key", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))

    # A revisit stands before a response of the same time.
    order = Window.partitionBy("url_key", "slice").orderBy("at", "full", "record_id")
    inside = F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = timed.withColumn("met", inside).filter(~F.col("full")).join(carried, ["url_key", "slice"])
    return met.withColumn("stored", F.coalesce("met", "carried")).drop("met", "carried", "at", "full", "slice")


def _strong(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def resolve(records: DataFrame, slices: int = SLICES) -> DataFrame:
    """One row per revisit: refers_to, outcome, payload_digest and headers.

    Outcomes: ``resolved``; ``no_earlier_response``; ``validator_mismatch`` when ETags (weak
    comparison), or without them Last-Modified, differ; ``no_validator`` when they have
    neither in common.  Only resolved rows carry payload and headers.  Rows with a null URL
    or time have no earlier response.  Repeated rows each give their result, and a response
    that is repeated counts once.
    """
    keyed = records.select("record_id", "url", "captured_at", "record_type", "status", "headers", "payload_digest").withColumn(
        "url_key", canonical_url(F.col("url")))
    known = F.col("url_key").isNotNull() & F.col("captured_at").isNotNull() & F.col("record_id").isNotNull()
    revisit = F.col("record_type") == "revisit"
    full = (F.col("record_type") == "response") & (F.col("status") == 200)
    found = latest_earlier(keyed.filter(known & (revisit | full)), slices)
    # Revisits without URL or time need no join, in which they would all have one key.
    alone = keyed.filter(revisit & ~known).withColumn("stored", F.lit(None).cast(found.schema["stored"].dataType))
    joined = found.unionByName(alone).select(
        "*", F.col("stored.refers_to").alias("refers_to"), F.col("stored.payload_digest").alias("_digest"),
        F.col("stored.headers").alias("_stored"))

    def both(name: str) -> tuple[Column, Column]:
        return F.try_element_at("_stored", F.lit(name)), F.try_element_at("headers", F.lit(name))

    (tag, new_tag), (date, new_date) = both("etag"), both("last-modified")
    outcome = (
        F.when(F.col("refers_to").isNull(), "no_earlier_response")
        .when(tag.isNotNull() & new_tag.isNotNull(),
              F.when(_strong(tag) == _strong(new_tag), "resolved").otherwise("validator_mismatch"))
        .when(date.isNotNull() & new_date.isNotNull(),
              F.when(date == new_date, "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )
    permitted = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("_stored", lambda k, _: ~F.map_contains_key(permitted, k)), permitted)
    out = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return out.select(
        "record_id", F.col("url_key").alias("canonical_url"), "captured_at", "outcome", "refers_to",
        F.when(resolved, F.col("_digest")).alias("payload_digest"), F.when(resolved, merged).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as lines in the order of their names."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log from a table of pages: each page is fetched once and revisited.

    The first revisit has another form of the URL and a weak ETag, which has changed for every
    fifth page; the second has only Last-Modified, changed for every third; every ninth page
    has one from before its first fetch.
    """
    page = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.md5("html").alias("digest"),
                        F.char_length("html").cast("string").alias("size")).withColumn("at", F.col("page_id") * 60)
    text = lambda c: c.cast("string")
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    modified = text(F.col("at") - 3600)

    def headers(**fields: Column) -> Column:
        pairs = [x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    first = F.struct(
        (F.col("page_id") * 4).alias("record_id"), F.col("url").alias("url"), F.col("at").alias("captured_at"),
        F.lit("response").alias("record_type"), F.lit(200).alias("status"),
        headers(content_type=F.lit("text/html"), content_length=F.col("size"), date=text(F.col("at")), etag=tag,
                last_modified=modified, cache_control=F.lit("max-age=60")).alias("headers"),
        F.col("digest").alias("payload_digest"))

    def revisit(number: int, url: Column, at: Column, fields: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 4 + number).alias("record_id"), url.alias("url"), at.alias("captured_at"),
            F.lit("revisit").alias("record_type"), F.lit(304).alias("status"), fields.alias("headers"),
            F.lit(None).cast("string").alias("payload_digest"))

    bare = F.regexp_replace("url", "#.*$", "")
    other = F.concat(F.regexp_replace(bare, "^https?://", "HTTPS://WWW."),
                     F.when(bare.contains("?"), "&").otherwise("?"), F.lit("utm_medium=again#x"))
    soon, later, sooner = F.col("at") + 30, F.col("at") + 7200, F.col("at") - 10
    one = revisit(1, other, soon, headers(
        date=text(soon), cache_control=F.lit("max-age=600"), content_length=F.lit("0"), server=F.lit("cache"),
        etag=F.when(F.col("page_id") % 5 == 0, F.lit('W/"changed"')).otherwise(F.concat(F.lit("W/"), tag))))
    two = revisit(2, F.col("url"), later, headers(
        date=text(later), last_modified=F.when(F.col("page_id") % 3 == 0, text(later)).otherwise(modified)))
    three = revisit(3, F.col("url"), sooner, headers(date=text(sooner), etag=tag))
    records = F.when(F.col("page_id") % 9 == 0, F.array(first, one, two, three)).otherwise(F.array(first, one, two))
    return page.select(F.explode(records).alias("r")).select("r.*")
