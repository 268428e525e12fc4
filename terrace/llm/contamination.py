"""Benchmark decontamination by Wu-Manber search over words.

The search strings are windows of ten consecutive words of the benchmark items; an item
with fewer words is one shorter window. A symbol is a word, a block is two words. For
each window length a shift table tells, for the block that ends at the present position,
how far the search may skip without missing an occurrence. Where the shift is 0 the block
is the suffix of some window: the windows of that suffix are looked up in its bucket, and
the words themselves are compared.

Documents are searched where they are read, without a shuffle. Windows are held in
blocks of bounded number: a benchmark of any size is searched in several passes, each
of which hands the documents on to the next one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import slices, stored

WINDOW = 10
#: Windows that one pass over the documents searches for.
WINDOWS_PER_PASS = 50_000

#: A-Z to a-z; digits, letters and bytes from 0x80 on stay; all else separates words.
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256)
)

Window = tuple[bytes, ...]


def words_of(text: bytes | None) -> list[bytes]:
    """Words of the text with A-Z in lower case; null has none."""
    return (text or b"").translate(_FOLDED).split()


@dataclass
class WuManber:
    """Search for windows of one length."""

    length: int
    shift: dict[Window, int] = field(default_factory=dict)
    bucket: dict[Window, dict[Window, list[str]]] = field(default_factory=dict)

    def add(self, window: Window, item: str | None) -> None:
        block = min(2, self.length)
        for end in range(block, self.length + 1):
            key, skip = window[end - block : end], self.length - end
            self.shift[key] = min(self.shift.get(key, skip), skip)
        items = self.bucket.setdefault(window[-block:], {}).setdefault(window, [])
        if item is not None:
            items.append(item)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """End (exclusive) and items of every occurrence, in order."""
        block = min(2, self.length)
        get, default, end, n = self.shift.get, self.length - block + 1, self.length, len(words)
        while end <= n:
            suffix = tuple(words[end - block : end])
            skip = get(suffix, default)
            if skip:
                end += skip
                continue
            items = self.bucket[suffix].get(tuple(words[end - self.length : end]))
            if items is not None:
                yield end, items
            end += 1


def matchers(windows: Iterable[tuple[str | None, list[bytes]]]) -> list[WuManber]:
    found: dict[int, WuManber] = {}
    for item, window in windows:
        found.setdefault(len(window), WuManber(len(window))).add(tuple(window), item)
    return [found[n] for n in sorted(found)]


def search(
    machines: list[WuManber],
    words: list[bytes],
    spans: Iterable[tuple[int, int]] = (),
    items: Iterable[str] = (),
) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans of hit words, and items; added to those of earlier passes."""
    hits, seen = list(spans), set(items)
    for machine in machines:
        for end, its in machine.find(words):
            start = end - machine.length
            if hits and hits[-1][0] <= start <= hits[-1][1]:
                hits[-1] = (hits[-1][0], max(end, hits[-1][1]))
            else:
                hits.append((start, end))
            seen.update(its)
    merged: list[tuple[int, int]] = []
    for start, end in sorted(hits):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged, seen


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item`` (text, null for a null id) and ``window`` (array of words), each once."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            items: list[str | None] = []
            windows: list[list[bytes]] = []
            ids = batch.column(0).to_pylist()
            for item, text in zip(ids, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                for start in range(max(1, len(words) - size + 1) if words else 0):
                    items.append(item)
                    windows.append(words[start : start + size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.list_(pa.binary()))],
                names=["item", "window"],
            )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(cut, "item string, window array<binary>").distinct()


def _passes(benchmark: DataFrame, size: int, per_pass: int) -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast search machines, one for each block of windows, and whether it is the last.

    None without windows. A machine is made when it is asked for, and is to be dropped before
    the next one, so neither the driver nor a worker ever holds more than a pass.
    """
    windows = stored(benchmark_windows(benchmark, size), "windows")
    spark, blocks = windows.sparkSession, -(-windows.count() // per_pass)
    block = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    for k in range(blocks):
        rows = windows.filter(block == k).collect()  # about per_pass rows
        machines = matchers((r["item"], [bytes(w) for w in r["window"]]) for r in rows)
        yield spark.sparkContext.broadcast(machines), k + 1 == blocks


SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, per_pass: int = WINDOWS_PER_PASS
) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` and ``items`` of every row.

    ``spans`` are the hit words as disjoint ranges of word positions, end exclusive;
    ``items`` the ids, as text and in no order, of the items with an occurring window.
    Null and empty texts have no words and no hits. Items without words search for
    nothing; windows of an item with a null id hit, but name no item. Repeated rows each
    have a row; empty tables give empty results; other columns are ignored.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", SPANS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    arrow = (pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()))

    def searcher(machines: object, last: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 512):
                counts: list[int] = []
                spans: list[list[dict]] = []
                items: list[list[str]] = []
                for text, old, names in zip(
                    batch.column("text").cast(pa.binary()).to_pylist(),
                    batch.column("spans").to_pylist(),
                    batch.column("items").to_pylist(),
                    strict=True,
                ):
                    words = words_of(text)
                    before = [(s["start"], s["end"]) for s in old]
                    hits, seen = search(machines.value if machines else [], words, before, names)
                    counts.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in hits])
                    items.append(list(seen))
                text = pa.nulls(len(counts), pa.string()) if last else batch.column("text")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        text,
                        pa.array(counts, pa.int64()),
                        pa.array(spans, arrow[0]),
                        pa.array(items, arrow[1]),
                    ],
                    names=schema.names,
                )

        return run

    found = docs.select(
        "doc_id",
        F.col("text").cast("string"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    none = True
    for machines, last in _passes(benchmark, size, per_pass):
        none, found = False, found.mapInArrow(searcher(machines, last), schema)
        if not last:  # what was found so far is kept, the machines are not
            found = stored(found, "passages")
            machines.destroy()
    return (found.mapInArrow(searcher(None, True), schema) if none else found).drop("text")


def without_passages(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, per_pass: int = WINDOWS_PER_PASS
) -> DataFrame:
    """The documents in which no window occurs, with all their columns; nothing is shuffled.

    Null and empty texts stay; repeated rows stay or go together; other columns may have any
    name; empty tables give an empty result, or all documents if the benchmark is empty.
    """

    def keeper(machines: object, at: int):
        def clean(text: bytes | None) -> bool:
            words = words_of(text)
            return all(next(m.find(words), None) is None for m in machines.value)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 512):
                kept = [clean(t) for t in batch.column(at).cast(pa.binary()).to_pylist()]
                yield batch.filter(pa.array(kept, pa.bool_()))

        return run

    for machines, last in _passes(benchmark, size, per_pass):
        docs = docs.mapInArrow(keeper(machines, docs.columns.index("text")), docs.schema)
        if not last:
            docs = stored(docs, "clean_so_far")
            machines.destroy()
    return docs


def n_hit(spans: str | Column = "spans") -> Column:
    """Number of words in the spans."""
    column = F.col(spans) if isinstance(spans, str) else spans
    return F.aggregate(
        column, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
