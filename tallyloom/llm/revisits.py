"""Not-modified revisits of web archives, resolved to the response they stand for.

Records are captures of a URL at a time: full responses, and revisits that say "not modified". A revisit
belongs to the latest earlier full response of its canonical URL: an as-of join. It is done in two
levels, so that a URL with very many captures is no single task's work: captures are cut into time
slices, each slice keeps its last full response, and a running maximum over slices carries it on; only inside
a slice are captures sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 7 * 86_400

# Fields a "not modified" answer may update (HTTP caching, RFC 9110 and 9111).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid|sid"


def canonical_url(url: Column) -> Column:
    """Without scheme, port, ``www.``, fragment, tracking parameters, trailing slash; host in lower case."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":\d+$", ""), r"^www\.", "")
    path = F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(path, "/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fields = F.array_sort(
        F.filter(
            F.split(query, "&"), lambda x: (x != "") & ~x.rlike(f"^(?i:{TRACKING})(=|$)")
        )
    )
    tail = F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")
    return F.when(host == "", url).otherwise(F.concat(host, path, tail))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(
    spark: SparkSession, records: DataFrame, slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """One row per revisit with the response it stands for.

    ``records`` has record_id, url, time (seconds), status (200 or 304; others are ignored), headers (a
    map with lower-case names) and digest of the payload. A revisit's ``outcome`` is:

    * ``resolved``: its entity tag, or without one on either side its modification date, agrees with the
      response's, or it has the response's digest; headers are the response's, updated by the permitted ones;
    * ``changed``: a validator disagrees;
    * ``unverified``: neither side gives a validator to compare;
    * ``missing``: no earlier full response, or no URL or time.

    Earlier means a smaller time; of responses at one time the largest record_id counts. Only resolved
    revisits get headers and digest. Repeated revisits are resolved each. Further columns are ignored.
    """
    rows = records.select("record_id", "url", "time", "status", "headers", "digest")
    rows = rows.where("status in (200, 304)").withColumn("canonical", canonical_url(F.col("url")))
    rows = rows.withColumn("slice", F.expr(f"time div {int(slice_seconds)}"))
    usable = rows.where("canonical is not null and time is not null")
    response = F.struct("time", "record_id", "headers", "digest")
    newest = F.max_by(response, F.when(F.col("status") == 200, F.struct("time", "record_id")))

    earlier_slices = Window.partitionBy("canonical").orderBy("slice")
    earlier_slices = earlier_slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        usable.groupBy("canonical", "slice")
        .agg(newest.alias("own"), F.max((F.col("status") == 304).cast("int")).alias("asked"))
        .withColumn("carried", F.last("own", ignorenulls=True).over(earlier_slices))
        .where("asked = 1 and carried is not null")
        .select("canonical", "slice", "carried")
    )
    inside = Window.partitionBy("canonical", "slice").orderBy("time")
    inside = inside.rangeBetween(Window.unboundedPreceding, -1)
    near = usable.withColumn("near", newest.over(inside)).where("status = 304")
    found = near.join(carried, ["canonical", "slice"], "left")
    found = found.withColumn("of", F.coalesce("near", "carried")).drop("near", "carried")
    lost = rows.where("status = 304 and (canonical is null or time is null)")
    lost = lost.withColumn("of", F.lit(None).cast(found.schema["of"].dataType))
    both = found.unionByName(lost.select(*found.columns))

    mine, theirs = F.col("headers"), F.col("of.headers")
    tag, old_tag = _weak(mine["etag"]), _weak(theirs["etag"])
    date, old_date = mine["last-modified"], theirs["last-modified"]
    agrees = F.coalesce(tag == old_tag, date == old_date, F.col("digest") == F.col("of.digest"))
    outcome = (
        F.when(F.col("of").isNull(), "missing")
        .when(agrees, "resolved")
        .when(agrees.isNull(), "unverified")
        .otherwise("changed")
    )
    allowed = F.map_filter(mine, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    allowed = F.coalesce(allowed, F.create_map().cast("map<string,string>"))
    stays = F.map_filter(theirs, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    stays = F.coalesce(stays, F.create_map().cast("map<string,string>"))
    merged = F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(stays, allowed))))
    return both.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "canonical",
        "time",
        F.col("of.record_id").alias("response_id"),
        F.col("of.time").alias("response_time"),
        "outcome",
        F.when(F.col("outcome") == "resolved", merged).alias("headers"),
        F.when(F.col("outcome") == "resolved", F.col("of.digest")).alias("digest"),
    )

