"""WARC: resolution of not-modified revisits.

A revisit record (a 304 answer) has no body of its own.  It is resolved by an
as-of join: among the full responses of the same canonical url, the latest one
strictly before it.  Their validators must agree (ETag, else Last-Modified,
else payload digest); then the revisit takes the stored body and headers, with
the headers a 304 may update replaced by its own.

The as-of join is a running maximum per (canonical url, slice of time), plus the
maxima of the earlier slices carried forward; so a url that holds a large share
of all records is worked on slice by slice in many tasks.

Defined results: a record without a url is ``unresolvable``; a revisit without
an earlier full response is ``no_earlier``; one whose validators disagree, or
share no kind of validator, is ``mismatch``; of several full responses at one
moment the greatest record id counts; full responses pass as ``full``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: records of a slice of time, about
SLICE_ROWS = 500_000
#: headers of the stored response that a 304 never replaces (fixed values, RFC 9111 section 3.2 and 9110 section 7.6.1)
KEPT_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type",
                "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer",
                "transfer-encoding", "upgrade")


def canonical_url(url: str | Column) -> Column:
    """Host and path as an archive looks them up: scheme, ``www.``, default
    port, fragment, final slashes and utm_ parameters dropped, host lower-cased,
    parameters sorted."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#[\s\S]*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&")))
                    .otherwise(F.lit("")))


def _slices(records: DataFrame, slice_rows: int) -> Column:
    n = -(-records.count() // slice_rows)
    if n <= 1:
        return F.lit(0)
    cuts = records.select(F.percentile_approx("moment", [i / n for i in range(1, n)], 10_000)).head()[0] or []
    cuts = sorted(set(cuts))
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("moment"))), F.lit(0))


def resolve_revisits(records: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``records``: record_id, type ('response' or 'revisit'), url, moment
    (long), status, headers (map, lower-case names), digest.  Adds canonical,
    state, source_id (the response whose body counts) and merged (headers); input
    columns of these names are left out.  A record without a moment has no place in
    time: such a revisit finds nothing earlier, such a response is nobody's source."""
    records = records.drop("canonical", "state", "source_id", "merged")
    r = records.withColumn("canonical", canonical_url("url")).withColumn("_slice", _slices(records, slice_rows))
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("canonical").isNotNull()
    stored = F.when(full & F.col("moment").isNotNull(), F.struct("moment", "record_id", "digest", F.to_json("headers").alias("headers")))
    r = r.withColumn("_stored", stored)
    before = Window.partitionBy("canonical", "_slice").orderBy("moment").rangeBetween(
        Window.unboundedPreceding, -1)
    per_slice = r.filter(F.col("_stored").isNotNull()).groupBy("canonical", "_slice").agg(
        F.max("_stored").alias("_last"))
    slices = r.filter("type = 'revisit'").select("canonical", "_slice").distinct()
    earlier = (per_slice.join(slices, ["canonical", "_slice"], "full")
               .withColumn("_carried", F.max("_last").over(
                   Window.partitionBy("canonical").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)))
               .filter("_carried is not null").select("canonical", "_slice", "_carried"))
    out = r.withColumn("_near", F.max("_stored").over(before)).join(earlier, ["canonical", "_slice"], "left")
    src = F.coalesce("_near", "_carried")
    theirs = F.from_json(F.col("_src.headers"), "map<string,string>")
    out = out.withColumn("_src", src).withColumn("_old", theirs)
    checks = [(F.try_element_at("headers", F.lit(k)), F.try_element_at("_old", F.lit(k)))
              for k in ("etag", "last-modified")] + [(F.col("digest"), F.col("_src.digest"))]
    agree = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), a == b) for a, b in checks], F.lit(False))
    revisit = F.col("type") == "revisit"
    state = (F.when(F.col("canonical").isNull(), "unresolvable").when(full, "full").when(~revisit, "other")
             .when(F.col("_src").isNull(), "no_earlier").when(~agree, "mismatch").otherwise("resolved"))
    out = out.withColumn("state", F.coalesce(state, F.lit("other")))
    new = F.map_filter("headers", lambda k, v: ~k.isin(*KEPT_HEADERS))
    kept = F.map_filter("_old", lambda k, v: ~F.map_contains_key(new, k))
    merged = F.when(F.col("state") == "resolved", F.map_concat(kept, new)).when(F.col("state") == "full", F.col("headers"))
    return out.select(*records.columns, "canonical", "state",
                      F.when(F.col("state") == "resolved", F.col("_src.record_id"))
                      .when(F.col("state") == "full", F.col("record_id")).alias("source_id"),
                      merged.alias("merged"))


def header_lines(headers: str | Column) -> Column:
    """Headers as ``name: value`` lines in name order."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")
