"""Resolution of not-modified revisits in web archives.

A revisit record says that a page had not changed since an earlier fetch and
carries no body.  It is resolved by an as-of join: the latest earlier full
response of the same canonical URL.  The validators must agree (a strong
ETag, else Last-Modified, else the payload digest), and the headers that a
not-modified answer may update replace those of the stored response.

The join runs on metadata alone.  Responses and revisits are windowed per URL
and time slice; slices hand on their last response through a small table with
one row per URL and slice.  A URL with a third of all records is thereby split
by time.  No body is moved.

Defined cases: a record without URL or time resolves to nothing ("orphan"); at
equal times the smaller record id counts as earlier; a repeated record id gives
repeated rows; null headers are empty; columns beyond the named ones are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Headers that a not-modified answer may carry.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Width of a time slice in seconds.
SLICE_SECONDS = 6 * 3600


def canonical_url(url: Column) -> Column:
    """Scheme dropped, host in lower case without "www." and default ports,
    no fragment, no tracking parameters, no slash at the end."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.", "")
    rest = F.regexp_replace(u, "^[^/?]*", "")
    rest = F.regexp_replace(rest, "([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, "&+", "&"), "\\?&", "?"), "[?&/]+$", "")
    return F.concat(host, rest)


def resolve(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """``records``: ``record_id, kind ('response' or 'revisit'), url, ts (long
    seconds), digest, headers map<string,string>`` with lower-case names.
    Returns one row per revisit: ``record_id, url_key, target_id, status,
    payload_digest, headers``.  Status: "resolved", "mismatch" (the validators
    differ: no body is taken), "orphan" (no earlier response)."""
    # records without a URL or time can meet nothing and keep out of the shuffle's groups
    named = records.select("record_id", "kind", canonical_url(F.col("url")).alias("url_key"), "ts", "digest", "headers")
    usable = named.where("url_key is not null and ts is not null").withColumn("slice", F.floor(F.col("ts") / F.lit(slice_seconds)))
    stored = F.when(F.col("kind") == "response", F.struct("record_id", "digest", "headers"))
    inside = Window.partitionBy("url_key", "slice").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = usable.withColumn("found", F.last(stored, ignorenulls=True).over(inside)).where("kind = 'revisit'")

    responses = usable.where("kind = 'response'")
    latest = responses.groupBy("url_key", "slice").agg(F.max_by(F.struct("record_id", "digest", "headers"), F.struct("ts", "record_id")).alias("r"))
    # one row per URL and slice that has responses or revisits
    asked = usable.where("kind = 'revisit'").select("url_key", "slice").distinct()
    slices = latest.join(asked, ["url_key", "slice"], "full")
    earlier = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = slices.withColumn("before", F.last("r", ignorenulls=True).over(earlier)).where("before is not null").select("url_key", "slice", "before")

    joined = near.join(handed, ["url_key", "slice"], "left").withColumn("target", F.coalesce("found", "before"))
    lost = named.where("kind = 'revisit' and (url_key is null or ts is null)")
    cols = ["record_id", "url_key", "digest", "headers"]
    joined = joined.select(*cols, "target").unionByName(lost.select(*cols), allowMissingColumns=True)
    return joined.select("record_id", "url_key", *_outcome())


def _outcome() -> list[Column]:
    empty = F.create_map().cast("map<string,string>")
    own = F.coalesce("headers", empty)
    old = F.coalesce("target.headers", empty)

    def differs(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), a != b)

    def strong(tag: Column) -> Column:
        return F.when(~F.startswith(tag, F.lit("W/")), tag)

    changed = F.coalesce(
        differs(strong(own["etag"]), strong(old["etag"])), differs(own["last-modified"], old["last-modified"]), differs(F.col("digest"), F.col("target.digest")), F.lit(False)
    )
    status = F.when(F.col("target").isNull(), "orphan").when(changed, "mismatch").otherwise("resolved")
    fresh = F.map_filter(own, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(fresh), k))
    resolved = status == "resolved"
    return [
        F.col("target.record_id").alias("target_id"),
        status.alias("status"),
        F.when(resolved, F.col("target.digest")).alias("payload_digest"),
        F.when(resolved, F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, fresh))))).alias("headers"),
    ]


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records out of a table of fetched pages (page_id, url, html).

    Page p is a full response at second 3600 p; every page is asked for again
    later: a revisit after ``1 + 7919 p % 50`` fetches.  Every eleventh
    page has only its revisit (the full response lies outside the table), and
    every seventh revisit names the ETag of another version."""
    later = F.col("page_id") + 1 + F.pmod(F.col("page_id") * 7919, F.lit(50))
    digest = F.md5(F.coalesce(F.col("html"), F.lit("")))
    etag = F.substring(digest, 1, 12)
    changed = F.col("page_id") % 7 == 3
    date = lambda n: n.cast("string")
    first = F.struct(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), (F.col("page_id") * 3600).alias("ts"), digest.alias("digest"),
        F.create_map(F.lit("etag"), etag, F.lit("date"), date(F.col("page_id") * 3600), F.lit("content-type"), F.lit("text/html")).alias("headers"),
    )
    again = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), (later * 3600 + 1800).alias("ts"), digest.alias("digest"),
        F.create_map(F.lit("etag"), F.when(changed, F.concat(F.lit("x"), etag)).otherwise(etag), F.lit("date"), date(later * 3600 + 1800), F.lit("server"), F.lit("a")).alias("headers"),
    )
    both = F.when(F.col("page_id") % 11 == 5, F.array(again)).otherwise(F.array(first, again))
    return pages.select("url", F.explode(both).alias("r")).select("r.record_id", "r.kind", "url", "r.ts", "r.digest", "r.headers")
