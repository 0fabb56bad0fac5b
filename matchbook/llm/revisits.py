"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit record holds the headers of a 304 answer and no payload. Its payload is that of the latest earlier full
response to the same canonical URL, found by an as-of join, if their validators agree. The headers are those of
that response, updated by the headers that a 304 answer may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import stored

#: Time is cut into this many ranges, so the captures of one URL are spread over as many tasks.
SLICES = 256
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|sessionid|phpsessid)(=|$)"
# Header fields that describe the payload of a 200 answer, which a 304 answer must not change.
PAYLOAD_FIELDS = ("content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding")


def canonical(url: str | Column) -> Column:
    """The URL without scheme, leading www., default port, user part, fragment, tracking parameters and last slash;
    host in lower case, parameters sorted. Null stays null."""
    url = F.trim(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]?\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lower_keys(headers: Column) -> Column:
    """Field names in lower case; of a field given twice, the value that sorts last."""
    pairs = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v"))))
    names = F.array_distinct(F.transform(pairs, lambda e: e["k"]))
    value = lambda n: F.element_at(F.filter(pairs, lambda e: e["k"] == n), -1)["v"]
    return F.map_from_arrays(names, F.transform(names, value))


def merged(old: Column, new: Column) -> Column:
    """The stored header fields, updated by those of the 304 answer that do not describe a payload."""
    allowed = F.map_filter(new, lambda k, _: ~k.isin(*PAYLOAD_FIELDS))
    return F.map_zip_with(old, allowed, lambda _, a, b: F.coalesce(b, a))


def _as_of(records: DataFrame, slices: int) -> DataFrame:
    """Add ``full``: the latest response to the URL captured before the record; of equal times, the largest id."""
    cuts = records.select(F.percentile_approx("at", [k / slices for k in range(1, slices)], 20 * slices)).first()[0]
    cuts = sorted(set(cuts or []))
    slice_ = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c < F.col("at")))
    records = records.withColumn("slice", slice_)
    # What earlier slices leave: one row for each URL and slice, at most ``slices`` for one URL.
    every = records.groupBy("site", "slice").agg(F.max("own").alias("last"))
    earlier = Window.partitionBy("site").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = stored(every.select("site", "slice", F.max("last").over(earlier).alias("carry")), "carry")
    within = Window.partitionBy("site", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    joined = records.join(carry, ["site", "slice"])
    return joined.withColumn("full", F.coalesce(F.max("own").over(within), "carry"))


def resolve(records: DataFrame, slices: int = SLICES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Resolve the revisits of ``records``: record_id, url, captured_at (long), kind, status (int), headers (map).

    Returns record_id, site (canonical URL), captured_at, kind, outcome, ref_id, headers and the ``carry`` columns.
    A response keeps its own; a revisit has those of the response it resolves to (``ref_id``), with merged headers.
    Outcomes: full (a response with status 200), other (neither that nor a revisit), resolved, mismatch (another
    entity tag or date), unchecked (no validator on both sides to compare), missing (no earlier full response).
    Only resolved revisits get values from a response. Entity tags compare weakly, and before dates.

    Records without URL or time resolve to nothing; null headers count as none. Rows that repeat each give a row.
    An empty table gives no rows; further columns are ignored. A URL with very many captures is spread over tasks
    by time. A payload can be joined by ``ref_id`` (``with_payloads``), so the as-of join does not move payloads.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    is_full = (F.col("kind") == "response") & (F.col("status") == 200)
    known = F.col("url").isNotNull() & F.col("captured_at").isNotNull()
    rows = records.select(
        F.col("record_id").alias("id"),
        canonical("url").alias("site"),
        F.col("captured_at").cast("long").alias("at"),
        "kind",
        F.coalesce(is_full, F.lit(False)).alias("is_full"),
        known.alias("known"),
        F.coalesce(lower_keys(F.col("headers")), none).alias("headers"),
        F.struct(F.lit(True).alias("_"), *carry).alias("extra"),
    )
    # Maps have no order, so the struct that the maximum compares holds their entries.
    entries = F.map_entries("headers")
    own = F.struct("at", "id", entries.alias("headers"), "extra")
    rows = rows.withColumn("own", F.when(F.col("is_full") & F.col("known"), own))
    found = _as_of(rows.where("known"), slices)
    old = F.map_from_entries("full.headers")
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    new = F.col("headers")
    both_tags, both_dates = tag(old).isNotNull() & tag(new).isNotNull(), old["last-modified"].isNotNull() & new["last-modified"].isNotNull()
    outcome = (
        F.when(F.col("is_full"), "full")
        .when(~F.coalesce(F.col("kind") == "revisit", F.lit(False)), "other")
        .when(F.col("full").isNull(), "missing")
        .when(both_tags, F.when(tag(old) == tag(new), "resolved").otherwise("mismatch"))
        .when(both_dates, F.when(old["last-modified"] == new["last-modified"], "resolved").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    found = found.withColumn("outcome", outcome)
    lost = F.when(F.col("is_full"), "full").when(F.col("kind") == "revisit", "missing").otherwise("other")
    rest = rows.where(~F.col("known")).withColumn("full", F.lit(None).cast(found.schema["full"].dataType)).withColumn("outcome", lost)
    done = found.select(rest.columns).unionByName(rest)
    ok = F.col("outcome") == "resolved"
    return done.select(
        F.col("id").alias("record_id"),
        "site",
        F.col("at").alias("captured_at"),
        "kind",
        "outcome",
        F.when(ok, F.col("full.id")).when(F.col("outcome") == "full", F.col("id")).alias("ref_id"),
        F.when(ok, merged(old, new)).otherwise(new).alias("headers"),
        *[F.when(ok, F.col("full.extra")[c]).when(F.col("outcome") == "full", F.col("extra")[c]).alias(c) for c in carry],
    )


def with_payloads(resolved: DataFrame, records: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Add the payload of the response that each record stands for."""
    payloads = records.where((F.col("kind") == "response") & (F.col("status") == 200)).select(
        F.col("record_id").alias("ref_id"), payload_col
    )
    return resolved.join(payloads, "ref_id", "left")


def captures(pages: DataFrame) -> DataFrame:
    """Archive records made of pages (page_id, url, html): a full response at time 10 * page_id, and a later revisit.

    The revisit repeats the validators of its page, so it resolves unless another capture of the URL came between.
    By the last digit of the id, some revisits hold a date only, or no validator, or come before their page.
    """
    digit = F.pmod(F.col("page_id"), F.lit(10))
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    day = F.concat(F.lit("day "), F.floor(F.col("page_id") / 7).cast("string"))
    body = F.struct(F.sha2(F.col("html").cast("binary"), 256).alias("payload_sha256"), F.length("html").cast("long").alias("payload_chars"))
    header = lambda *pairs: F.map_from_arrays(
        F.filter(F.array(*[F.when(v.isNotNull(), F.lit(k)) for k, v in pairs]), lambda x: x.isNotNull()),
        F.filter(F.array(*[v for _, v in pairs]), lambda x: x.isNotNull()),
    )
    at = F.col("page_id") * 10
    later = F.when(digit == 5, at - 1).otherwise(at + 5 + F.pmod(F.col("page_id") * 7919, F.lit(200_003)))
    page = pages.select("page_id", "url", digit.alias("digit"), tag.alias("tag"), day.alias("day"), body.alias("body"), at.alias("at"), later.alias("later"))
    full = header(
        ("Content-Type", F.lit("text/html")), ("Content-Length", F.col("body.payload_chars").cast("string")),
        ("ETag", F.col("tag")), ("Last-Modified", F.col("day")), ("Cache-Control", F.lit("max-age=60")),
    )
    short = header(
        ("Content-Length", F.lit("0")), ("Cache-Control", F.lit("max-age=600")), ("Date", F.col("later").cast("string")),
        ("ETag", F.when(F.col("digit").isin(3, 7), F.lit(None)).otherwise(F.concat(F.lit("W/"), F.col("tag")))),
        ("Last-Modified", F.when(F.col("digit") != 3, F.col("day"))),
    )
    two = F.array(
        F.struct(F.col("at").alias("captured_at"), F.lit("response").alias("kind"), F.lit(200).alias("status"), full.alias("headers")),
        F.struct(F.col("later").alias("captured_at"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), short.alias("headers")),
    )
    return page.select(F.col("page_id").alias("record_id"), "url", F.explode(two).alias("r"), "body").select(
        "record_id", "url", "r.*", "body.payload_sha256", "body.payload_chars"
    )
