"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule rejects a document if a share, in thousandths, is above a cutoff. The cutoffs come
from labelled documents, apart for every stratum (language), and they come with a
guarantee: with probability 1 - ``delta`` over the labelled sample, no stratum has more
than ``alpha`` of its good documents rejected.

1. One half of the labelled texts proposes. Per stratum and rule, at each level of a price
   for false rejections (from dear to cheap), the cutoff is the one with the greatest
   share of bad documents rejected, less the price times the share of good ones. So every
   level is a set of cutoffs, and each rejects at least what the level before did.
2. The other half certifies. Per stratum the levels are tested in that order: the number
   of good documents that a level rejects must be so small that, if the true share were
   ``alpha``, the exact binomial probability of so few were at most ``delta`` divided by
   the number of strata (Bonferroni). The first level that fails ends the tests of its
   stratum, so within it no further correction is needed (fixed sequence).

The last certified level is in force. A stratum with too few labels rejects nothing by
these rules.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import SPACE, free_name, stored

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: At most this share of a stratum's good documents may be rejected, with this risk of error.
ALPHA, DELTA = 0.02, 0.05
#: Prices of a false rejection, dear to cheap.
PRICES = (200, 100, 50, 20, 10)
RULES = ("symbols", "others", "capitals", "dup_lines", "repeat_words", "word_length")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def measures(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row a document: the counts, the rules' shares, and a hash of the text.

    Null and empty texts have no words and all counts 0. Windows are compared by 64-bit
    hashes within one document.
    """
    text = F.col("text")
    base = docs.select(
        "doc_id",
        F.col(stratum).cast("string").alias("stratum"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    split = base.select(
        "*",
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}")).alias("lines"),
    )
    hashed = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    last = F.size("words") - WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]),
    )
    windowed = hashed.select(
        "doc_id", "stratum", "digest",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\x20\x09-\x0D]")).cast("bigint").alias("n_others"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(last >= 0, windows).alias("windows"),
    )
    # Only where some window repeats: sorting (hash, place) brings equal hashes together, a
    # second sort brings the places of the repeated ones in order, and each covers the words
    # up to the next one, five at most. All steps are n log n. Columns that lambdas look up
    # are columns of an earlier projection, else they would be computed for every element.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    paired = windowed.withColumn("pairs", F.when(repeats, F.sort_array(pairs)))

    def twin(p: Column, k: Column) -> Column:
        same = [F.coalesce(F.get("pairs", k + d)["h"] == p["h"], F.lit(False)) for d in (-1, 1)]
        return F.when(same[0] | same[1], p["i"])

    placed = paired.withColumn(
        "places", F.sort_array(F.array_compact(F.transform("pairs", twin)))
    )
    covered = F.aggregate(
        F.transform(
            "places", lambda p, k: F.least(F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        ),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    counted = placed.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))
    ).drop("windows", "pairs", "places")
    return counted.select("*", *[share.alias(f"rule_{name}") for name, share in shares().items()])


def _per_mille(part: str, whole: str) -> Column:
    value = F.floor(F.lit(1000) * F.col(part) / F.greatest(F.col(whole), F.lit(1).cast("bigint")))
    return F.least(value, F.lit(1000).cast("bigint")).cast("int")


def shares() -> Mapping[str, Column]:
    """The rules' values, from 0 to 1000."""
    return {
        "symbols": _per_mille("n_symbols", "word_chars"),
        "others": _per_mille("n_others", "word_chars"),
        "capitals": _per_mille("n_capitals", "word_chars"),
        "dup_lines": _per_mille("n_dup_lines", "n_lines"),
        "repeat_words": _per_mille("n_repeat_words", "n_words"),
        # Characters a word, in fortieths: 1000 is 25.
        "word_length": F.least(
            F.floor(F.lit(40) * F.col("word_chars") / F.greatest("n_words", F.lit(1).cast("bigint"))),
            F.lit(1000).cast("bigint"),
        ).cast("int"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words")
    )


def _ln_factorial(n: Column) -> Column:
    """Logarithm of n!: by Stirling's series from 20 on, exact below."""
    x = n.cast("double") + 1
    series = (
        (x - 0.5) * F.log(x) - x + 0.9189385332046727
        + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5.0))
    )
    return F.when(n < 20, F.log(F.factorial(F.least(n.cast("int"), F.lit(20))).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), where it is below one half; 1 from the mean on.

    The terms are summed from k downwards. They shrink faster than a geometric series, so
    terms more than 60 deviations below, less than 1e-300, are left out.
    """
    k, n = k.cast("bigint"), n.cast("bigint")
    first = F.exp(
        _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    steps = F.least(k, F.ceil(60 * F.sqrt(n * p)) + 60)
    total = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), steps),
        F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda a, i: F.struct(
            (a["term"] * (k - i) / (n - k + i + 1) * ((1 - p) / p)).alias("term"),
            (a["sum"] + a["term"]).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k < n * p, total).otherwise(1.0)


def labelled_texts(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of each distinct labelled text once a stratum, with ``good`` and ``proposes``.

    Copies of a text are one observation, good if any label says so, and fall into the
    same half. What fails the base rules is no observation.
    """
    marked = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    values = [F.max(f"rule_{r}").alias(f"rule_{r}") for r in RULES]
    return (
        measured.filter(~base_failed())
        .join(marked, "doc_id")
        .groupBy("stratum", "digest")
        .agg((F.max("quality") > 0).alias("good"), *values)
        .withColumn("proposes", F.col("digest") < "8")
    )


def proposed_cutoffs(texts: DataFrame, prices: Sequence[int] = PRICES) -> DataFrame:
    """``stratum``, ``rule`` (index), ``level`` and ``cutoff`` that the first half proposes."""
    pairs = F.array(
        *[F.struct(F.lit(i).alias("rule"), F.col(f"rule_{r}").alias("v")) for i, r in enumerate(RULES)]
    )
    counts = (
        texts.filter("proposes")
        .select("stratum", "good", F.explode(pairs).alias("p"))
        .groupBy("stratum", F.col("p.rule").alias("rule"), F.col("p.v").alias("v"))
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # At most 1001 values a rule, so these windows are small whatever the table's size.
    rule = Window.partitionBy("stratum", "rule")
    above = rule.orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    cuts = counts.select(
        "stratum", "rule", "v",
        F.coalesce(F.sum("good").over(above), zero).alias("lost"),
        F.coalesce(F.sum("bad").over(above), zero).alias("caught"),
        F.sum("good").over(rule).alias("all_good"),
        F.sum("bad").over(rule).alias("all_bad"),
        F.lead("v").over(rule.orderBy("v")).alias("next"),
    ).filter("next is not null")
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(p).alias("price")) for i, p in enumerate(prices)])
    gain = F.col("caught") * F.col("all_good") - F.col("l.price") * F.col("lost") * F.col("all_bad")
    best = (
        cuts.select("*", F.explode(levels).alias("l"))
        .withColumn("gain", gain.cast("decimal(38,0)"))
        .filter("gain > 0")
        .groupBy("stratum", "rule", F.col("l.level").alias("level"))
        .agg(F.max(F.struct("gain", "v", F.floor((F.col("v") + F.col("next")) / 2).cast("int").alias("cutoff"))).alias("b"))
    )
    sofar = rule.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return best.select("stratum", "rule", "level", F.min("b.cutoff").over(sofar).alias("cutoff"))


def _with_level(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``level``, the first one that rejects the row; null if none does."""
    lists = cutoffs.groupBy("stratum").agg(
        F.collect_list(F.struct("rule", "level", "cutoff")).alias("cutoffs")
    )
    joined = rows.join(lists.withColumnRenamed("stratum", "_stratum"), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    values = F.array(*[F.col(f"rule_{r}") for r in RULES])
    over = F.filter("cutoffs", lambda c: F.get(values, c["rule"]) > c["cutoff"])
    return joined.withColumn("level", F.array_min(F.transform(over, lambda c: c["level"]))).drop("cutoffs", "_stratum")


def certified_levels(
    texts: DataFrame, cutoffs: DataFrame, alpha: float = ALPHA, delta: float = DELTA, levels: int = len(PRICES)
) -> DataFrame:
    """``stratum`` and ``certified``, its last certified level; strata without one are absent."""
    held = _with_level(texts.filter("good and not proposes"), cutoffs)
    lost = [F.count_if(F.col("level") <= i).alias(f"lost_{i}") for i in range(levels)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *lost)
    risk = counts.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy()))
    ok = [(binomial_tail(F.col(f"lost_{i}"), F.col("n"), alpha) * F.col("strata") <= delta) for i in range(levels)]
    passed, certified = F.lit(True), F.lit(None).cast("int")
    for i, test in enumerate(ok):
        passed = passed & test
        certified = F.when(passed, F.lit(i)).otherwise(certified)
    return risk.select("stratum", certified.alias("certified")).filter("certified is not null")


def judged(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
    prices: Sequence[int] = PRICES,
) -> DataFrame:
    """``doc_id``, ``digest``, the counts, ``base_failed`` and ``kept`` of every row.

    Null and empty texts fail the base rules. A null stratum is a stratum of its own.
    Labels that are null, of no document, or repeated do no harm: the greatest of an id
    counts. Without labels only the base rules reject. Repeated rows and ids each have
    their row; an empty table gives an empty result; other columns are ignored.
    """
    measured = stored(measures(docs, stratum), "measures")
    texts = stored(labelled_texts(measured, labels), "labelled")
    cutoffs = stored(proposed_cutoffs(texts, prices), "cutoffs")
    levels = certified_levels(texts, cutoffs, alpha, delta, len(prices))
    levels = levels.withColumnRenamed("stratum", "_stratum")
    rows = _with_level(measured, cutoffs).join(levels, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.coalesce(F.col("level") <= F.col("certified"), F.lit(False))
    return rows.select(
        "doc_id", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk: float) -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever these are called.

    Null and empty texts go, as they fail the base rules; a null id is matched like any
    other; repeated rows are kept or go together; an empty table gives an empty one.
    """
    kept = judged(docs, labels, stratum, **risk).filter("kept")
    kept_id, kept_text = free_name(docs, "_kept_id"), free_name(docs, "_kept_text")
    keys = kept.select(F.col("doc_id").alias(kept_id), F.col("digest").alias(kept_text)).distinct()
    digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    return docs.join(
        keys.hint("shuffle_hash"),
        docs["doc_id"].eqNullSafe(F.col(kept_id)) & (digest == F.col(kept_text)),
        "left_semi",
    )
