"""Ranked search with short queries: the best documents of every item.

Only terms of items matter, so a document is the counts of these terms and its length
factor ``m``. Documents that agree in both are one class, whatever else they say: they are
found by hash, verified by their values, scored once, and take their ranks in order of
their ids. Every task keeps its best classes of each item.

Items are dealt into blocks of bounded size, so that what a task holds does not grow with
their number; all documents are met with each block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored, text_slices

TOP = 10
#: Items of a block, and their terms, each counted once an item. An item of more terms is alone.
BLOCK_ITEMS, BLOCK_TERMS = 256, 20_000
#: Numbers in a table of classes and terms, or of classes and items.
TABLE = 1 << 22
#: Vectors of the last classes are broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
#: Parts in which candidates are ranked before all are.
PARTS = 32

_TERM = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Bytes that are in no term become blanks, A-Z lower case. Bytes of other characters stay.
TERM_BYTES = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _TERM else 0x20 for b in range(256))
_LAST = np.iinfo(np.int64).max


def term_weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((2 N + 2) / (2 df + 1)))``."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and ``terms``: its distinct terms, of all rows that have this id."""
    words = F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"),
    )
    pairs = items.select("item_id", F.explode(words).alias("term")).distinct()
    return pairs.groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[str]]]]:
    """The items, fetched one partition at a time, in lists of bounded size."""
    block: list[tuple[object, list[str]]] = []
    size = 0
    for row in item_terms(items).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(row["terms"]) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
    if block:
        yield block


def _vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id``, ``n`` (terms), ``terms`` (places in the vocabulary, ascending) and their ``tfs``."""
    sent = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(vocabulary)})
    kind = dict(docs.dtypes)["doc_id"]

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value.get
        for batch in text_slices(batches, "text"):
            sizes, terms, tfs, ends = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").translate(TERM_BYTES).split()
                own = Counter(map(place, words))
                own.pop(None, None)
                ordered = sorted(own)
                sizes.append(len(words))
                terms += ordered
                tfs += map(own.__getitem__, ordered)
                ends.append(len(terms))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32()))
                for x in (terms, tfs)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>"
    )


def _best(entries: list[np.ndarray], top: int) -> list[np.ndarray]:
    """Of each item (place, score, least id, class) the first ``top`` in order."""
    item, score, least, name = entries
    order = np.lexsort((name, least, -score, item))
    item = item[order]
    first = np.searchsorted(item, item)
    order = order[np.arange(len(item)) - first < top]
    return [x[order] for x in entries]


def _scored(classes: DataFrame, items: list[list[int]], weights: np.ndarray, top: int) -> DataFrame:
    """``item`` (place), ``score``, ``least`` and ``class_id`` of every task's best classes."""
    # Whole numbers below 2**53 are exact as doubles; beyond that they stay integers.
    most = int(weights.max(initial=0)) * 1_000_000 * max(map(len, items))
    number = np.float64 if most < 1 << 53 else np.int64
    sent = classes.sparkSession.sparkContext.broadcast((items, weights))
    many, terms = len(items), len(weights)
    rows = max(1, TABLE // max(many, terms))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, weight = sent.value
        of_item = np.zeros((terms, many), number)
        for i, own in enumerate(lists):
            of_item[own, i] = 1
        kept = [np.zeros(0, np.int64) for _ in range(4)]
        floor = np.ones(many, np.int64)  # a class below this is not among the best
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                name, m, least = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("class_id", "m", "least"))
                place, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
                sizes = batch.column("terms").value_lengths().to_numpy()
                row = np.repeat(np.arange(len(sizes)), sizes)
                value = weight[place] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                table = np.zeros((len(sizes), terms), number)
                table[row, place] = value
                scores = (table @ of_item).astype(np.int64)
                if len(sizes) > top:
                    np.maximum(floor, np.partition(scores, -top, axis=0)[-top], out=floor)
                found, item = np.nonzero(scores >= floor)
                new = [item, scores[found, item], least[found], name[found]]
                kept = _best([np.concatenate(x) for x in zip(kept, new, strict=True)], top)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0].astype(np.int32)), *map(pa.array, kept[1:])],
            names=["item", "score", "least", "class_id"],
        )

    return classes.select(
        "class_id", "m", "terms", "tfs", F.coalesce("least", F.lit(_LAST)).alias("least")
    ).mapInArrow(score, "item int, score bigint, least bigint, class_id bigint")


def _first(rows: DataFrame, top: int, by: list[str], *order: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", place).filter(F.col("rank") <= top)


def _ranked_block(docs: DataFrame, block: list[tuple[object, list[str]]], top: int) -> DataFrame:
    """``item`` (place in the block), ``rank``, ``doc_id`` and ``score``."""
    vocabulary = sorted({t for _, terms in block for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    vectors = stored(_vectors(docs, vocabulary), "vectors")
    n_docs, n_terms = vectors.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    # A row for each term of the block at most.
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = count
    own = F.lit(90).cast("decimal(3,0)") * F.col("n") * F.lit(n_docs)
    m = 10 + F.call_function("div", own, F.lit(max(n_terms, 1)))
    bags = vectors.filter(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    bags = bags.withColumn("bag", F.xxhash64("terms", "tfs", "m"))
    same = ["bag", "m", "terms", "tfs"]
    # Equal rows meet by hash and are one class only if all values are the same. Tasks join
    # their own first, so a class with a third of the documents is one row a task.
    classes = bags.groupBy(*same).agg(F.min("doc_id").cast("bigint").alias("least"))
    classes = stored(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    items = [[place[t] for t in terms] for _, terms in block]
    found = _scored(classes, items, term_weight(n_docs, df), top)
    order = (F.desc("score"), F.col("least"), F.col("class_id"))
    parted = found.withColumn("part", F.pmod(F.xxhash64("class_id"), F.lit(PARTS)))
    best = _first(_first(parted, top, ["item", "part"], *order), top, ["item"], *order)
    best = stored(best.select("item", "score", "class_id"), "best_classes")
    last = stored(classes.join(best.select("class_id").distinct(), "class_id", "left_semi"), "last_classes")
    size = last.agg(F.sum(8 * F.size("terms") + 64)).first()[0] or 0
    last = last.select("class_id", *same)
    members = bags.join(F.broadcast(last) if size <= BROADCAST_BYTES else last, same)
    by_id = F.col("doc_id").asc_nulls_last()
    members = _first(members.select("class_id", "doc_id"), top, ["class_id"], by_id).drop("rank")
    return _first(best.join(members, "class_id"), top, ["item"], F.desc("score"), by_id).select(
        "item", "rank", "doc_id", "score"
    )


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of every item's best documents.

    Rows with the same item id are one item, with the terms of all; so are rows with a null
    id. Equal scores are in order of the document id, a null id last; repeated ids and rows
    are documents of their own. Null and empty texts have no terms: such a document or item
    is in no result. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    done = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score bigint")
    for block in _blocks(items):
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"item int, item_id {kind}")
        found = _ranked_block(docs, block, top).join(F.broadcast(names), "item")
        done = done.unionByName(stored(found.select("item_id", "rank", "doc_id", "score"), "ranked"))
    return done
