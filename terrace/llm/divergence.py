"""Which sources of a language use its terms otherwise, and which terms tell.

Terms are counted per language and source while the texts are read. What two counts say
about a term depends on the counts alone, so terms are grouped into cells of equal counts
(of a source and its language, or of two sources), the divergence is evaluated once a cell
and weighted by how many terms the cell has. Ranks come from the cells' cumulative
multiplicity; only cells that can reach the report are expanded into terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored, text_slices

#: A language keeps the terms of so many of its documents; so many terms of a source are reported.
MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Different terms of sources that a task holds before it passes their counts on.
HELD = 200_000

_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Bytes that are in no term become blanks, A-Z lower case. Bytes of other characters stay.
TERM_BYTES = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _LETTERS else 0x20 for b in range(256))

_COUNTS = "lang string, source string, term string, n bigint, df bigint"


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, per language and source, of a part of the rows.

    A row without a term stands for each language and source.
    """
    n: dict[tuple, Counter] = {}
    df: dict[tuple, Counter] = {}

    def counts() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), own in n.items():
            docs = df[lang, source]
            size = len(own) + 1
            rows = ([lang] * size, [source] * size, [*own, None], [*own.values(), 0],
                    [*map(docs.__getitem__, own), 0])
            for column, more in zip(columns, rows, strict=True):
                column += more
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "df"])

    for batch in text_slices(batches, "text"):
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for group, text in zip(zip(langs, sources, strict=True), texts, strict=True):
            words = text.translate(TERM_BYTES).split()
            if group not in n:
                n[group], df[group] = Counter(), Counter()
            n[group].update(words)
            df[group].update(set(words))
        if sum(map(len, n.values())) > HELD:
            yield counts()
            n, df = {}, {}
    if n:
        yield counts()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``df`` (documents).

    A null language, source or text is an empty one. Each language and source that occurs
    has a row whose term is null. Tasks count their own rows first, so a term that every
    document has is a row a task and source.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = plain.mapInArrow(_count, _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column | int, total: Column, terms: Column) -> Column:
    """Of a billion, plus one: the smoothed share of a term with this count. Exact."""
    top = F.lit(SCALE).cast("decimal(12,0)") * ((F.lit(count) if isinstance(count, int) else count) + 2)
    return 1 + F.call_function("div", top, total + 2 * terms)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sized(rows: DataFrame, groups: DataFrame, name: str, total: str) -> DataFrame:
    """The rows with the total of the source that a column names."""
    sizes = groups.select("lang", F.col("source").alias(name), F.col("group_n").alias(total))
    return rows.join(sizes, ["lang", name])


class Audit:
    """The counts of a table of documents, and the two reports on them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS) -> None:
        counts = stored(term_counts(docs), "term_counts")
        held = F.array_sort(F.collect_list(F.struct("source", "n")))
        #: ``lang``, ``term``, ``lang_count`` and ``held``: its count in each source that has it.
        self.kept = stored(
            counts.filter("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("df").alias("df"), F.sum("n").alias("lang_count"), held.alias("held"))
            .filter(F.col("df") >= min_docs).drop("df"),
            "kept_terms",
        )
        of_lang = self.kept.groupBy("lang").agg(
            F.count(F.lit(1)).alias("terms"), F.sum("lang_count").alias("lang_n")
        )
        self.members = self.kept.select("lang", "term", "lang_count", F.inline("held"))
        of_source = self.members.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        none = F.lit(0).cast("bigint")
        #: ``lang``, ``source`` and their totals, with those that have no term.
        self.groups = stored(
            counts.filter("term IS NULL").select("lang", "source")
            .join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("group_n", "terms", "lang_n")]),
            "groups",
        )
        #: ``n`` and ``lang_count`` of a source's terms, and how many terms have these two.
        self.cells = stored(
            self.members.groupBy("lang", "source", "n", "lang_count").agg(F.count(F.lit(1)).alias("m")),
            "cells",
        )

    def terms(self, top: int = TOP) -> DataFrame:
        """``lang``, ``source``, ``item``, ``value`` and ``rank`` of the terms a source has most of
        above its language."""
        group = ["lang", "source"]
        p = share(F.col("n"), F.col("group_n"), F.col("terms"))
        q = share(F.col("lang_count"), F.col("lang_n"), F.col("terms"))
        above = (
            self.cells.join(self.groups, group)
            .select(*group, "n", "lang_count", "m", p.alias("p"), q.alias("q")).filter("p > q")
            .select(*group, "n", "lang_count", "m", divergence(F.col("p"), F.col("q")).alias("value"))
        )
        # Cells of one value are one step of the ranking; no more than the first ones are needed.
        by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
        before = F.sum("m").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
        steps = (
            above.groupBy(*group, "value").agg(F.sum("m").alias("m"))
            .withColumn("step", F.row_number().over(by_value)).filter(F.col("step") <= top)
            .withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < top)
            .select(*group, "value")
        )
        cells = above.join(steps, [*group, "value"]).select(*group, "n", "lang_count", "value")
        in_order = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
        return (
            self.members.join(cells, [*group, "n", "lang_count"])
            .select(*group, F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= top)
        )

    def _cells_of_two(self) -> DataFrame:
        """``lang``, ``a``, ``b`` (sources, in order), their counts ``na`` and ``nb``, and ``m``:
        how many terms have these. Only terms that both have; tasks sum their own first."""
        first = self.kept.filter(F.size("held") > 1).select("lang", "held", F.posexplode("held").alias("i", "x"))
        two = first.select("lang", "x", F.explode(F.slice("held", F.col("i") + 2, F.size("held"))).alias("y"))
        names = (F.col("x.source").alias("a"), F.col("y.source").alias("b"),
                 F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
        return two.select("lang", *names).groupBy("lang", "a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("m"))

    def pairs(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (another source of the language), ``value`` and ``rank``.

        With ``f0`` for the divergence of two absent terms, a term of one source alone adds
        what it has above ``f0``, and a term of both adds what it has above both of these
        sums. So only terms that two sources share are looked at for the two.
        """
        groups = self.groups
        a, b, terms = F.col("a_n"), F.col("b_n"), F.col("terms")

        def f(x: Column | int, y: Column | int) -> Column:
            return divergence(share(x, a, terms), share(y, b, terms))

        of_lang = groups.select("lang", "terms").distinct()
        both = _sized(_sized(self._cells_of_two(), groups, "a", "a_n"), groups, "b", "b_n").join(of_lang, "lang")
        more = F.col("m") * (f(F.col("na"), F.col("nb")) - f(F.col("na"), 0) - f(0, F.col("nb")) + f(0, 0))
        shared = both.groupBy("lang", "a", "b").agg(F.sum(more).alias("value"))
        # Divergence is symmetric: each two sources are summed once and reported twice.
        shared = shared.unionByName(shared.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))

        other = groups.select("lang", F.col("source").alias("b"), F.col("group_n").alias("b_n"))
        two = groups.select("lang", F.col("source").alias("a"), F.col("group_n").alias("a_n"), "terms")
        two = two.join(other, "lang").filter("a != b")
        alone = self.cells.groupBy("lang", F.col("source").alias("a"), "n").agg(F.sum("m").alias("m"))
        own = (
            two.join(alone, ["lang", "a"]).groupBy("lang", "a", "b")
            .agg(F.sum(F.col("m") * (f(F.col("n"), 0) - f(0, 0))).alias("value"))
        )
        own = own.unionByName(own.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        absent = F.when(terms > 0, terms * f(0, 0)).otherwise(0)
        all_parts = two.select("lang", "a", "b", absent.alias("value")).unionByName(own).unionByName(shared)
        in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (
            all_parts.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item"))
            .agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(in_order))
        )


def audited(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair`` ranks a source's distances to every other source of its language, part
    ``term`` the first ``top`` terms that it has more of than its language. Ties are in
    order of the items' bytes. Null languages, sources and texts are empty ones, repeated
    rows count as often as they stand there, an empty table gives an empty result, other
    columns are ignored. A source without a kept term has pairs, but no terms; the only
    source of a language has no pairs. The pairs grow with the square of a language's
    sources, as their report does.
    """
    audit = Audit(docs, min_docs)

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(audit.pairs(), "pair").unionByName(part(audit.terms(top), "term"))
