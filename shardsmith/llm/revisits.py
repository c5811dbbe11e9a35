"""Not-modified revisits: an as-of join to the latest earlier full response.

Records are those of a web archive: id, type (``response`` or ``revisit``),
url, time, status, headers and payload.  A revisit takes the latest response
with status 200 of the same canonical URL that is strictly earlier.  If the
validators agree (weakly compared ETag; without one on both sides
Last-Modified; without that the payload digest), the revisit gets the
response's payload and its headers, updated by the revisit's own, save those
that describe a body or a connection.

The as-of join is two windows: within a URL and a time block, then over the
last response of each block, so a URL that holds a third of all records is
spread over its blocks.  Records of equal URL and time are one row there, so
that a window holds at most as many rows as its block has seconds.  The
answer belongs to a URL and a time and names its response; each payload moves
once, to the revisits that name it.

Outcomes (``outcome``): ``response`` for what is no revisit, ``resolved``,
``mismatch``, ``no_validator`` or ``no_response``.  Defined cases: a null URL
or time finds and serves nothing; a null header map is empty, header names
are lower-cased and the last of equal names holds; responses of equal time
go by the greatest id, a null id being the smallest, and those of equal ids by
a hash of headers and payload; ids need not be unique: a revisit gets the
payload of its own URL, whatever else has its id; a response without an id
serves, with a null ``refers_to``; empty payloads are payloads; other columns stay as they are, save
those named like an output, which are replaced; empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Query parameters that only track; headers that a not-modified response may not change.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid)(=|$)"
BODY_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
URL = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)(?:\?(.*))?$"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, user, ``www.``, default port, fragment, closing slashes and tracking
    parameters, other parameters sorted; what is no such URL loses its fragment only."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    part = lambda i: F.regexp_extract(u, URL, i)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(1)), r"^.*@", ""), r"^www\.|:(80|443)$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(part(3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    whole = F.concat(host, F.regexp_replace(part(2), r"/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(u.rlike(URL), whole).otherwise(u)


def clean_headers(headers: Column) -> Column:
    """Names in lower case, the last of equal ones; never null."""
    none = F.create_map().cast("map<string,string>")
    add = lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"]))
    return F.coalesce(F.aggregate(F.map_entries(headers.cast("map<string,string>")), none, add), none)


def merge_headers(stored: Column, new: Column) -> Column:
    allowed = F.map_filter(new, lambda k, _: ~k.isin(BODY_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(allowed, k)), allowed)


def _agrees(old: Column, new: Column) -> Column:
    """Whether the validators agree; null where there is none on both sides."""
    tag = lambda h: F.regexp_replace(F.element_at(h, "etag"), r"^W/", "")
    return F.coalesce(tag(old) == tag(new), *(F.element_at(old, k) == F.element_at(new, k) for k in ("last-modified", "warc-payload-digest")))


def resolve_revisits(records: DataFrame, block_seconds: int = 86_400) -> DataFrame:
    """``records`` (record_id, record_type, url, time in seconds, status, headers, payload) with revisits filled in:
    ``headers``, ``payload``, ``refers_to`` and ``outcome``."""
    names = [c for c in records.columns if c not in ("refers_to", "outcome")]
    records = records.select(*names).withColumns({"__url": canonical_url(F.col("url")), "headers": clean_headers(F.col("headers"))})
    full = F.coalesce((F.col("record_type") == "response") & (F.col("status") == 200), F.lit(False))
    dated = F.col("__url").isNotNull() & F.col("time").isNotNull()
    # tells apart responses of equal url, time and id
    records = records.withColumn("__body", F.when(full & dated, F.xxhash64(F.array_sort(F.map_entries("headers")), F.col("payload").isNull(), "payload")))
    here = F.when(full, F.struct("time", "record_id", "__body"))
    slim = records.filter(dated).withColumns({"__block": F.floor(F.col("time") / block_seconds), "__here": here})
    # one row for each second of a url, so a window holds no more than a block's seconds
    points = slim.groupBy("__url", "__block", "time").agg(F.max("__here").alias("__here"), F.max(F.col("record_type") == "revisit").alias("__asked"))
    within = W.partitionBy("__url", "__block").orderBy("time").rowsBetween(W.unboundedPreceding, -1)
    near = points.withColumn("__near", F.max("__here").over(within)).filter("__asked")
    blocks = points.groupBy("__url", "__block").agg(F.max("__here").alias("__last"))
    before = W.partitionBy("__url").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    far = blocks.select("__url", "__block", F.max("__last").over(before).alias("__far")).filter(F.col("__far").isNotNull())
    # the answer is one of the url and time, whatever ids the records have
    answers = near.join(far, ["__url", "__block"], "left").select(F.col("__url").alias("__at"), F.col("time").alias("__when"), F.coalesce("__near", "__far").alias("__key")).filter(F.col("__key").isNotNull())
    asking = F.coalesce(F.col("record_type") == "revisit", F.lit(False)) & dated
    # payloads move once, to the revisits: the rows that serve are reduced and joined by the same two columns
    revisits = records.filter(asking).drop("__body").join(answers, (F.col("__url") == F.col("__at")) & (F.col("time") == F.col("__when")), "left").drop("__at", "__when")
    served = records.filter(full & dated).select(F.col("__url").alias("__from"), F.struct("time", "record_id", "__body").alias("__response"), F.lit(True).alias("__found"), F.col("headers").alias("__headers"), F.col("payload").alias("__payload"))
    served = served.dropDuplicates(["__from", "__response"]).withColumn("refers_to", F.col("__response")["record_id"])
    revisits = revisits.join(served, (F.col("__url") == F.col("__from")) & (F.col("__key") == F.col("__response")), "left")
    agrees = _agrees(F.col("__headers"), F.col("headers"))
    outcome = F.when(F.col("__found").isNull(), "no_response").when(agrees.isNull(), "no_validator").when(agrees, "resolved").otherwise("mismatch")
    revisits = revisits.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    new = {
        "headers": F.when(good, merge_headers(F.col("__headers"), F.col("headers"))).otherwise(F.col("headers")),
        "payload": F.when(good, F.col("__payload")).otherwise(F.col("payload")),
    }
    revisits = revisits.select(*(new[c].alias(c) if c in new else F.col(c) for c in names), F.when(good, F.col("refers_to")).alias("refers_to"), "outcome")
    no_answer = F.when(F.col("record_type") == "revisit", "no_response").otherwise("response")
    rest = records.filter(~asking).select(*names, F.lit(None).cast(records.schema["record_id"].dataType).alias("refers_to"), no_answer.alias("outcome"))
    return rest.unionByName(revisits)
