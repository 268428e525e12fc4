"""Removal of lines that many sites share, in DataFrame functions only.

Every line is known by a 64-bit hash. One HyperLogLog sketch of sites per line hash,
merged by aggregation, tells on how many distinct sites a line stands. Lines whose
estimate is near the threshold are counted exactly; only of these are the sites shuffled.
What stands on enough sites is boilerplate and is removed from every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import SPACE, stored

#: A line on this many distinct sites is boilerplate.
MIN_SITES = 10
#: Bits of the sketches' buckets, and the share of the threshold that counts as near it.
#: The standard error of 2**12 buckets is 1.6 %, so a tenth is over six of them.
BUCKET_BITS, NEAR = 12, 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    """Hash of the line without white space at its ends; null for a blank line."""
    trimmed = F.regexp_replace(line, rf"\A{SPACE}+|{SPACE}+\z", "")
    return F.when(trimmed != "", F.xxhash64(trimmed))


def line_hashes(text: Column) -> Column:
    return F.transform(_lines(text), _hash)


def line_sites(docs: DataFrame, site: str) -> DataFrame:
    """``line`` (hash) and ``site``, once a document; lines of a null site count for none."""
    hashes = F.array_compact(F.array_distinct(line_hashes(F.col("text"))))
    return docs.filter(F.col(site).isNotNull()).select(
        F.col(site).cast("string").alias("site"), F.explode(hashes).alias("line")
    )


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` and ``sites`` of the lines on at least ``min_sites`` distinct sites.

    ``sites`` is exact for lines near the threshold, an estimate above it. Every task
    makes a sketch of its own sites per line, and the shuffle brings one sketch a task
    and line, so a line that a third of all documents have is no hot key.
    """
    pairs = line_sites(docs, site)
    sketches = pairs.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", BUCKET_BITS)).alias("estimate")
    )
    likely = stored(sketches.filter(F.col("estimate") >= min_sites * (1 - NEAR)), "likely_lines")
    sure = likely.filter(F.col("estimate") > min_sites * (1 + NEAR))
    near = likely.filter(F.col("estimate") <= min_sites * (1 + NEAR)).select("line")
    exact = (
        pairs.join(near, "line", "left_semi").distinct()
        .groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    return sure.select("line", F.col("estimate").alias("sites")).unionByName(exact)


def without_boilerplate(
    docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``doc_id``, ``text`` without its boilerplate lines, ``n_lines`` and ``n_removed``.

    Lines are what ``\\n`` separates; blank ones are never removed. A null text stays null
    and has no lines, an empty one has one blank line. A null site counts for no line, but
    its documents are cleaned too. Repeated rows and ids each have their row; an empty
    table gives an empty result; other columns are ignored.
    """
    shared = stored(boilerplate(docs, site, min_sites), "boilerplate").select("line")
    hits = (
        docs.select(
            F.col("doc_id").alias("hit_id"),
            F.xxhash64("text").alias("hit_text"),
            F.posexplode(line_hashes(F.col("text"))).alias("place", "line"),
        )
        .join(shared, "line")
        .groupBy("hit_id", "hit_text")
        .agg(F.array_sort(F.collect_set("place")).alias("places"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64("text") == F.col("hit_text"))
    own = docs.select("doc_id", "text").join(hits.hint("shuffle_hash"), same, "left")
    # A column of its own, as the lambda below looks it up once for every gap.
    own = own.withColumn("lines", _lines(F.col("text")))
    n = F.size("places")

    def between(i: Column) -> Column:
        """The lines between two removed ones, or before the first or after the last."""
        after = F.when(i == 0, -1).otherwise(F.get("places", i - 1))
        until = F.when(i == n, F.size("lines")).otherwise(F.get("places", i))
        return F.slice("lines", after + 2, until - after - 1)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), n), between))
    changed = F.col("places").isNotNull()
    return own.select(
        "doc_id",
        F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.when(changed, n).otherwise(0).alias("n_removed"),
    )
