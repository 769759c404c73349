"""Not-modified revisits of web archives, resolved to the response they confirm.

A revisit record holds no page.  It is joined as of its time, by canonical
address, to the latest earlier full response; its validators say whether that
response is the one it confirms; and its headers, as far as a cache may take
them over, replace those of the response.

The as-of join runs in two steps, so that an address with most of the records
is spread by time: inside one (address, period), and over the last responses
of the earlier periods, of which there is one row per address and period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.session import stable

#: Headers that a not-modified response does not update, being
#: about the connection or about the body that was left out.
NOT_UPDATED = (
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)

#: Query parameters that say how a page was reached, not which one it is.
TRACKING = r"^(utm_[a-z]*|fbclid|gclid|sessionid|phpsessid|jsessionid)(=|$)"

PERIOD_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Address without scheme, user, www or m host, default port, fragment,
    tracking parameters and final slash; host in lower case, parameters
    sorted.  NULL, and texts that are no http address, give NULL."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    shape = r"^[Hh][Tt][Tt][Pp][Ss]?://([^/?]+)([^?]*)[?]?(.*)$"
    host = F.lower(F.regexp_extract(bare, shape, 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", "")
    host = F.regexp_replace(host, r"^(www[0-9]*|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, shape, 2), "/+$", "")
    parts = F.filter(
        F.split(F.regexp_extract(bare, shape, 3), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)
    )
    query = F.array_join(F.array_sort(parts), "&")
    joined = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(bare.rlike(shape), joined)


def _entries(headers: Column) -> Column:
    """Header entries with names in lower case, the last of each name."""
    named = F.transform(
        F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>")),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    return F.filter(
        named,
        lambda e, i: ~F.exists(F.slice(named, i + 2, F.greatest(F.size(named), F.lit(1))), lambda x: x["key"] == e["key"]),
    )


def _value(entries: Column, name: str) -> Column:
    found = F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]
    return F.nullif(F.trim(found), F.lit(""))


def _opaque(tag: Column) -> Column:
    """Entity tag for weak comparison."""
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url_key, outcome, response_id, headers, payload.

    Input columns: record_id bigint, url string, at bigint (seconds), kind
    (``response`` or ``revisit``), status int, headers map<string,string>,
    payload string (a digest or place of the page); others are ignored.  Full
    responses are those of status 200.  Earlier means a smaller (at,
    record_id).  Outcomes:

    * ``resolved``: entity tags are equal (weak comparison), or, where the
      revisit has none, modification dates are;
    * ``changed``: the validators differ, or the response lacks the one asked;
    * ``unverified``: the revisit has no validator; it is merged all the same;
    * ``unmatched``: no earlier full response, or no usable address or time.

    For ``changed`` and ``unmatched`` headers are the revisit's own and payload
    is NULL.  Repeated records give repeated rows; without revisits there are
    no rows.
    """
    rows = records.select(
        F.col("record_id").cast("bigint").alias("record_id"),
        canonical_url(F.col("url")).alias("url_key"),
        F.col("at").cast("bigint").alias("at"),
        (F.col("kind") == "response").alias("full"),
        F.col("kind"),
        F.col("status").cast("int").alias("status"),
        _entries(F.col("headers")).alias("entries"),
        F.col("payload").cast("string").alias("payload"),
    ).where((F.col("kind") == "revisit") | ((F.col("kind") == "response") & (F.col("status") == 200)))
    rows = rows.withColumn(
        "stored",
        F.when(F.col("full"), F.struct(F.col("record_id").alias("id"), F.col("entries").alias("entries"), F.col("payload").alias("payload"))),
    ).drop("kind", "status")
    # read four times below; the parsing of addresses and headers is the costly part
    rows = stable(rows)
    placed = F.col("url_key").isNotNull() & F.col("at").isNotNull()
    usable = rows.where(placed).withColumn("period", F.floor(F.col("at") / period_seconds))

    # responses last within one (time, id), so that a revisit does not find a later one
    inside = Window.partitionBy("url_key", "period").orderBy("at", F.col("record_id").asc_nulls_first(), "full")
    near = F.last("stored", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    revisits = stable(usable.withColumn("near", near).where(~F.col("full")).drop("stored"))

    latest = usable.where("full").groupBy("url_key", "period").agg(
        F.max_by("stored", F.struct("at", "record_id")).alias("stored")
    )
    marks = latest.unionByName(
        revisits.where("near is null").select("url_key", "period").distinct(), allowMissingColumns=True
    ).groupBy("url_key", "period").agg(F.first("stored", ignorenulls=True).alias("stored"))
    earlier = Window.partitionBy("url_key").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select(
        "url_key", "period", F.last("stored", ignorenulls=True).over(earlier).alias("far")
    ).where("far is not null")

    joined = revisits.where("near is null").join(carried, ["url_key", "period"], "left").drop("near")
    found = revisits.where("near is not null").withColumnRenamed("near", "far").unionByName(joined)
    lost = rows.where(~placed & ~F.col("full")).drop("stored")
    found = found.drop("period").unionByName(lost, allowMissingColumns=True)

    own, stored = F.col("entries"), F.col("far.entries")
    tag, date = _value(own, "etag"), _value(own, "last-modified")
    same = F.when(tag.isNotNull(), _opaque(tag) == _opaque(_value(stored, "etag"))).otherwise(
        date == _value(stored, "last-modified")
    )
    outcome = (
        F.when(F.col("far").isNull(), "unmatched")
        .when(tag.isNull() & date.isNull(), "unverified")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("changed")
    )
    news = F.filter(own, lambda e: ~e["key"].isin(*NOT_UPDATED))
    merged = F.concat(F.filter(stored, lambda s: ~F.exists(news, lambda n: n["key"] == s["key"])), news)
    judged = found.withColumn("outcome", outcome)
    taken = F.col("outcome").isin("resolved", "unverified")
    return judged.select(
        "record_id",
        "url_key",
        "outcome",
        F.when(F.col("outcome") != "unmatched", F.col("far.id")).alias("response_id"),
        F.map_from_entries(F.when(taken, merged).otherwise(own)).alias("headers"),
        F.when(taken, F.col("far.payload")).alias("payload"),
    )


def header_text(headers: Column) -> Column:
    """``name: value`` lines in the order of names."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(lines), "\n")


def page_captures(pages: DataFrame) -> DataFrame:
    """Four archive records of each page, a day apart, as input of the above.

    Derived by rule from page_id: most pages are fetched in full first and
    confirmed later; some are confirmed before any fetch, changed or fetched
    again in between, or confirmed by date or without validators.
    """
    page = F.coalesce("page_id", F.lit(0))
    base = pages.select(
        page.alias("p"), "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.octet_length("html").alias("bytes")
    ).withColumn("c", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    again = (F.col("p") % 7 == 0) & (F.col("c") >= 2)
    response = ((F.col("c") == 0) & (F.col("p") % 11 != 0)) | ((F.col("c") == 2) & (F.col("p") % 7 == 0))
    version = F.when(again, "b").when((F.col("c") == 1) & (F.col("p") % 5 == 0), "x").otherwise("a")
    tag = F.concat(F.lit('"'), version, F.lit("-"), F.col("digest"), F.lit('"'))
    at = F.col("p") * 10 + F.col("c") * PERIOD_SECONDS + 1_700_000_000
    whole = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"),
        F.lit("Content-Length"), F.col("bytes").cast("string"),
        F.lit("ETag"), tag,
        F.lit("Last-Modified"), F.concat(F.lit("day "), version),
        F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    short = F.create_map(
        F.lit("Content-Length"), F.lit("0"),
        F.lit("ETag"), F.when(F.col("p") % 6 > 1, F.concat(F.when(F.col("p") % 2 == 1, "W/").otherwise(""), tag)),
        F.lit("Last-Modified"), F.when(F.col("p") % 6 == 1, F.concat(F.lit("day "), version)),
        F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.col("c").cast("string")),
        F.lit("X-Cache"), F.lit("hit"),
    )
    return base.select(
        (F.col("p") * 4 + F.col("c")).alias("record_id"),
        F.concat("url", F.when(F.col("c") % 2 == 1, "#again").otherwise("")).alias("url"),
        at.alias("at"),
        F.when(response, "response").otherwise("revisit").alias("kind"),
        F.when(response, 200).otherwise(304).alias("status"),
        F.when(response, whole).otherwise(F.map_filter(short, lambda k, v: v.isNotNull())).alias("headers"),
        F.when(response, F.concat(F.col("digest"), version)).alias("payload"),
    )
