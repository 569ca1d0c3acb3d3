"""Cross-site boilerplate lines by distinct-site sketches.

Every line goes under a 128-bit hash. One aggregation gathers for each hash a HyperLogLog sketch of the
sites that show it; sketches merge on the map side and again after the shuffle. An estimate far below
or above the threshold decides by itself; the lines between get an exact count of distinct sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.written import written

LEAST_SITES = 10
SKETCH_BITS = 10  # 2 ** 10 registers, a standard error of about 3 %
MARGIN = 0.25  # estimates nearer to the threshold than this share of it are counted exactly

_BODY = ("doc_id", "body")


def _lines(docs: DataFrame, site: str) -> DataFrame:
    text = F.col("text")
    listed = docs.select(
        "doc_id",
        F.xxhash64("text").alias("body"),
        F.when(F.col(site).isNotNull(), F.xxhash64(F.col(site))).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("place", "line"),
    ).where("trim(both ' \t\r' from line) <> ''")
    return listed.select(
        "doc_id",
        "body",
        "site",
        "place",
        F.xxhash64("line").alias("one"),
        F.xxhash64(F.lit(1), "line").alias("two"),
    )


def boilerplate_lines(
    spark: SparkSession,
    lines: DataFrame,
    least_sites: int = LEAST_SITES,
    margin: float = MARGIN,
) -> DataFrame:
    """Hashes ``one`` and ``two`` of lines shown by at least ``least_sites`` sites, with ``first_doc``.

    ``lines`` has doc_id, site, one and two. The result is exact: ``n_sites`` is the estimate where that
    decides, else the count.
    """
    spread = (
        lines.groupBy("one", "two")
        .agg(
            F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sites"),
            F.min("doc_id").alias("first_doc"),
        )
        .select("one", "two", "first_doc", F.hll_sketch_estimate("sites").alias("n_sites"))
        .where(F.col("n_sites") >= least_sites * (1 - margin))
    )
    spread = written(spark, spread, "spread")
    unsure = spread.where(F.col("n_sites") <= least_sites * (1 + margin))
    counted = (
        lines.join(unsure.select("one", "two"), ["one", "two"])
        .select("one", "two", "site")
        .distinct()
        .groupBy("one", "two")
        .agg(F.count("site").alias("exact"))
        .where(F.col("exact") >= least_sites)
    )
    sure = spread.where(F.col("n_sites") > least_sites * (1 + margin))
    near = unsure.join(counted, ["one", "two"]).withColumn("n_sites", F.col("exact"))
    return sure.unionByName(near.select(*sure.columns))


def drop_boilerplate(
    spark: SparkSession,
    docs: DataFrame,
    site: str = "source",
    least_sites: int = LEAST_SITES,
) -> DataFrame:
    """The columns of ``docs`` with cleaned ``text``, and ``n_lines`` and ``n_dropped``.

    A line that at least ``least_sites`` distinct sites show is boilerplate. It stays in the smallest
    doc_id that has it, so no content is lost altogether, and goes everywhere else. Further columns
    stay, but for the two that are counted here. Lines end with a
    line feed and are compared whole; blank lines always stay. A null site is no site, a null text has no
    lines and stays null, and rows without a doc_id count for the spread but keep their lines. Rows that
    share a doc_id are treated alike.
    """
    lines = written(spark, _lines(docs.where("text is not null"), site), "lines")
    common = boilerplate_lines(spark, lines, least_sites)
    places = (
        lines.join(common, ["one", "two"])
        .where("doc_id > first_doc")
        .groupBy(*_BODY)
        .agg(F.collect_set("place").alias("places"))
    )
    text = F.col("text")
    keyed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("doc_id"),
        F.xxhash64(text).alias("body"),
        text.alias("text"),
    )
    joined = keyed.join(places, ["doc_id", "body"], "left")
    kept = F.expr(
        "case when places is null then text else array_join(filter(split(text, '\\n'),"
        " (line, i) -> not array_contains(places, i)), '\\n') end"
    )
    counts = {
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))),
        "n_dropped": F.when(F.col("places").isNull(), 0).otherwise(F.size("places")),
    }
    rest = [
        kept.alias("text") if c == "text" else F.col(f"row.`{c}`")
        for c in docs.columns
        if c not in counts
    ]
    return joined.select(*rest, *[made.alias(name) for name, made in counts.items()])
