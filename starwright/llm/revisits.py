"""Revisit records that say "not modified", resolved to the response they mean.

Captures are grouped by canonical URL; an as-of join gives each revisit the
latest earlier full response of its URL: one window over the URL's captures by
time carries the last full response forward.  The revisit counts as resolved
when its validators agree (its ETag, or without one its modification time);
then the stored body is taken and headers that a 304 may update are merged.

A URL's captures are one window group, which spills; it is not collected.
Captures without a URL are dealt out by their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Headers of a not-modified response that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified",
             "vary")


def canonical_url(url: F.Column) -> F.Column:
    """Scheme, leading www. or m., fragment, query of tracking and trailing slash
    don't tell two pages apart; the host is lower-cased."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^(www|m)\.", "")
    rest = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*(.*)$", 1),
                            r"([?&])(utm_[^&]*|ref=[^&]*)", "")
    return F.concat(host, F.regexp_replace(rest, r"[/?&]+$", ""))


def resolve_revisits(records: DataFrame, id_col: str = "record_id") -> DataFrame:
    """``records`` has ``id_col``, ``url``, ``captured_at`` (any ordered type),
    ``status``, ``etag``, ``last_modified``, ``headers`` (map) and ``body``.

    For each revisit (status 304): ``id_col``, ``url_key``, ``response_id`` (the
    latest earlier status 200 of its canonical URL, null without one; of two at
    one time the larger id), ``resolved`` (there is one and the validators
    agree; without any validator it isn't), ``headers`` and ``body`` (null
    unless resolved).  Records with a null URL or time are never matched."""
    url, at = canonical_url(F.col("url")), F.col("captured_at")
    full = (F.col("status") == 200) & at.isNotNull()
    kept = F.when(full, F.struct(F.col(id_col).alias("id"), "etag", "last_modified", "headers",
                                 "body"))
    # at one time the revisits come first: the rows before one are strictly earlier
    # responses, whatever type the times have
    order = Window.partitionBy("url_key", F.when(url.isNull(), F.col(id_col))).orderBy(
        at.asc_nulls_first(), F.coalesce(full, F.lit(False))).rowsBetween(
        Window.unboundedPreceding, -1)
    keyed = records.withColumn("url_key", url)
    latest = F.max_by(kept, F.when(full, F.struct(at, F.col(id_col)))).over(order)
    found = (keyed.withColumn("__r", latest).where("status = 304"))
    usable = F.col("url_key").isNotNull() & at.isNotNull()
    same = F.when(F.col("etag").isNotNull(), F.col("etag") == F.col("__r.etag")).otherwise(
        F.col("last_modified") == F.col("__r.last_modified"))
    resolved = F.coalesce(usable & F.col("__r").isNotNull() & same, F.lit(False))
    new = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")),
                       lambda k, _: F.lower(k).isin(*PERMITTED))
    old = F.map_filter(F.coalesce("__r.headers", F.create_map().cast("map<string,string>")),
                       lambda k, _: ~F.array_contains(
                           F.transform(F.map_keys(new), F.lower), F.lower(k)))
    return found.select(
        id_col, "url_key", F.when(usable, F.col("__r.id")).alias("response_id"),
        resolved.alias("resolved"), F.when(resolved, F.map_concat(old, new)).alias("headers"),
        F.when(resolved, F.col("__r.body")).alias("body"))
