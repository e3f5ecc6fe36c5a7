"""Removing lines that many sites share, counted with HyperLogLog sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import let, materialize, text_or_empty

#: A line on this many distinct sites is boilerplate.
MIN_SITES = 5
#: Lines of fewer words stay; with 1 every line that isn't blank takes part, of any length and script.
MIN_WORDS = 1
#: log2 of the sketch's registers; its relative standard error is 1.04 / sqrt(2^LG_K).
LG_K = 12

_BLANK = " \t\r\x0b\x0c"


def document_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each line of at least ``min_words`` words: document key, site, place, hash."""
    enough = r"[\x20\x09-\x0D]+".join([r"[^\x20\x09-\x0D]+"] * max(1, min_words))
    lines = docs.select(*row_key(), F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("_site"),
                        F.posexplode(F.split(text_or_empty(), "\n")).alias("_pos", "_line"))
    return (lines.where(F.col("_line").rlike(enough))
            .select("_d", "_t", "_site", "_pos", F.xxhash64(F.btrim("_line", F.lit(_BLANK))).alias("_h")))


def row_key() -> list[Column]:
    """A document's key: its doc_id (null: the least) and a hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_d"), F.xxhash64(text_or_empty()).alias("_t")]


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Hashes of lines on at least ``min_sites`` distinct sites, with their first place.

    Sketches of the sites are built before the shuffle and merged after it, so a line that is
    everywhere is one row of each task. Lines whose estimate is within four standard errors
    (or one site) of the threshold are counted exactly, over pairs of line and site that are
    made distinct before the shuffle too.
    """
    place = F.struct("_d", "_t", "_pos")
    sketched = materialize(
        lines.groupBy("_h").agg(F.hll_sketch_agg("_site", lg_k).alias("_sketch"), F.min(place).alias("_first"))
        .select("_h", "_first", F.hll_sketch_estimate("_sketch").alias("_sites"))
        .where(F.col("_sites") >= 2), "line-spread")
    margin = max(1, int(4 * 1.04 / 2 ** (lg_k / 2) * min_sites) + 1)
    near = F.abs(F.col("_sites") - min_sites) <= margin
    exact = (lines.join(sketched.where(near).select("_h"), "_h", "left_semi").select("_h", "_site").distinct()
             .groupBy("_h").agg(F.count(F.lit(1)).alias("_exact")))
    sure = sketched.where(~near & (F.col("_sites") > min_sites)).select("_h", "_first")
    close = sketched.where(near).join(exact.where(F.col("_exact") >= min_sites), "_h").select("_h", "_first")
    return sure.unionByName(close)


def remove_shared_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                        lg_k: int = LG_K) -> DataFrame:
    """Documents without the lines that spread over ``min_sites`` or more distinct sites.

    Adds n_lines and removed_lines and replaces text; all other columns stay. Lines are
    compared without blanks at either end, a site is a source (null is a site of its own). The
    first occurrence of such a line, by least doc_id and place, stays, so its content is kept
    once; all others go. Lines of fewer than ``min_words`` words always stay.

    A null text stays null (no lines); an empty one has one empty line. A document that loses
    all its lines has an empty text. Null doc_ids come first in the order. Rows with equal
    doc_id and text are the same document and treated alike. An empty table gives no rows.
    """
    clash = [c for c in ("n_lines", "removed_lines") if c in docs.columns]
    docs = docs.drop(*clash)
    lines = materialize(document_lines(docs, min_words), "lines")
    shared = materialize(boilerplate_lines(lines, min_sites, lg_k), "boilerplate")
    place = F.struct("_d", "_t", "_pos")
    gone = (lines.join(shared, "_h").where(place != F.col("_first")).groupBy("_d", "_t")
            .agg(F.collect_set("_pos").alias("_gone")))
    split = F.split(F.col("text"), "\n")
    rest = F.array_join(let(split, lambda lines: F.transform(
        F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))),
        lambda i: F.get(lines, i))), "\n")
    d, t = row_key()
    others = [c for c in docs.columns if c != "text"]
    joined = docs.select(d, t, "text", F.struct(*others).alias("_rest")).join(gone, ["_d", "_t"], "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(rest)
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("removed_lines"))
