"""The queries of this folder; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import find_items
from tallyloom.llm.divergence import audit
from tallyloom.llm.fingerprint import compare_with_edits
from tallyloom.llm.licenses import scan
from tallyloom.llm.lines import drop_boilerplate
from tallyloom.llm.markup import main_text
from tallyloom.llm.mixing import mix
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.oracle import ORACLE
from tallyloom.llm.quality import classify
from tallyloom.llm.revisits import resolve
from tallyloom.llm.set_join import classes
from tallyloom.llm.substring import remove_repeats
from tallyloom.llm.vector_codes import coded_vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, _table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(spark, _table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(spark, _table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, _table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def captures(pages: DataFrame) -> DataFrame:
    """Five captures of every page: two versions in full, and three revisits with unlike validators."""
    day = 86_400
    etag = "concat('\"', left(md5(html), 16), '-', %s, '\"')"
    changed = "concat('day ', cast(page_id % 28 + {k} as string))"
    return (
        pages.selectExpr("page_id", "url", "coalesce(html, '') as html")
        .selectExpr("*", "explode(sequence(0, 4)) as k")
        .selectExpr(
            "page_id * 5 + k as record_id",
            "case when k = 1 then concat(url, '#again') else url end as url",
            f"1700000000 + (page_id * 7919) % (30 * {day}) + k * (3 * {day} + page_id % 1000) as time",
            "if(k in (0, 2), 200, 304) as status",
            f"""map_filter(map(
                'date', cast(k as string),
                'server', if(k in (0, 2), 'origin', 'edge'),
                'content-length', cast(if(k in (0, 2), length(html), 0) as string),
                'cache-control', if(k = 4, 'max-age=60', null),
                'etag', case when k in (0, 2) then {etag % "cast(k as string)"}
                    when k = 1 and page_id % 3 <> 0 then concat('W/', {etag % "'0'"})
                    when k = 3 and page_id % 4 = 0 then {etag % "'0'"}
                    when k = 3 then {etag % "'2'"} end,
                'last-modified', case when k in (0, 2) then {changed.format(k="k")}
                    when k = 1 then {changed.format(k="0")}
                    when k = 4 and page_id % 5 <> 0 then {changed.format(k="2")} end
            ), (name, value) -> value is not null) as headers""",
            "if(k in (0, 2), md5(concat(html, cast(k as string))), null) as digest",
        )
    )


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolve(spark, captures(_table(spark, sf_dir, "pages"))).withColumn(
        "headers", F.array_join(lines, "\n")
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, _table(spark, sf_dir, "pages"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "same_as", "class_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, _table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_vectors(spark, _table(spark, sf_dir, "embeddings"))


def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark, _table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_decontamination": op4_decontamination,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_revisits": op8_revisits,
    "op9_main_text": op9_main_text,
    "op10_near_dedup": op10_near_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_vector_codes": op12_vector_codes,
    "op13_set_join": op13_set_join,
}

__all__ = ["ORACLE", "QUERIES"]
