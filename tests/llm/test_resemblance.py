"""Near copies that differ in more bits than fingerprints are linked by."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import resemblance, simhash
from tests.llm import brute


def _sets(text):
    words = brute.lower_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _made():
    """Texts, edited copies of some in chains, stars and pairs below the similarity."""
    draw, made = random.Random(3), []
    words = [f"w{i}" for i in range(900)]
    for _ in range(40):
        first = [draw.choice(words) for _ in range(draw.randint(3, 260))]
        made.append(first)
        for _ in range(draw.randint(0, 9)):
            copy = list(draw.choice((first, made[-1])))
            for _ in range(draw.randint(1, 1 + len(copy) // 25)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            made.append(copy)
    texts = [" ".join(x) for x in made] + [None, "", " \n", "one", "ONE  "]
    return texts + texts[:20]


def _expected(texts):
    label = brute.components([brute.simhash(t) for t in texts])
    sets = [_sets(t) for t in texts]
    direct = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                direct += 1
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label, direct


def test_edited_copies_are_one_group(spark):
    texts = _made()
    label, beyond = _expected(texts)
    assert beyond > 10  # groups that fingerprints leave apart
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    kept = simhash.one_of_each(docs, similarity=resemblance.SIMILARITY)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label))
    import corpus_pipeline

    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == sorted(set(label))


@pytest.mark.parametrize(("block", "few"), [(2, 8), (5, 0)])
def test_blocks_lose_no_link(spark, monkeypatch, block, few):
    """Texts of a key in several blocks, which only the last pass brings together."""
    monkeypatch.setattr(resemblance, "BLOCK", block)
    monkeypatch.setattr(resemblance, "FEW", few)
    draw = random.Random(11)
    words, texts = [f"w{i}" for i in range(4000)], []
    for _ in range(6):  # a text and copies of it, and copies of these, each a little further off
        own = [[draw.choice(words) for _ in range(120)]]
        for _ in range(25):
            copy = list(draw.choice(own[-8:]))
            for _ in range(draw.randint(1, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            own.append(copy)
        texts += [" ".join(x) for x in own]
    draw.shuffle(texts)
    label, beyond = _expected(texts)
    assert beyond > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    kept = simhash.one_of_each(docs, similarity=resemblance.SIMILARITY)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label))


def test_forests_of_a_group_against_all_pairs():
    draw = random.Random(1)
    for size in (2, 8, 9, 40, 150):
        sets = []
        for _ in range(size):
            if sets and draw.random() < 0.7:
                own = set(draw.choice(sets).tolist())
                for _ in range(draw.randint(0, max(1, len(own) // 6))):
                    own.discard(draw.choice(sorted(own)))
                    own.add(draw.getrandbits(40))
            else:
                own = {draw.getrandbits(40) for _ in range(draw.randint(1, 60))}
            sets.append(np.array(sorted(own), np.int64))
        roots = np.array([draw.randrange(size) for _ in range(size)])
        every = [
            (int(roots[i]), int(roots[j])) for i in range(size) for j in range(i)
            if 5 * len({*sets[i]} & {*sets[j]}) >= 4 * len({*sets[i]} | {*sets[j]})
        ]
        found = resemblance.group_links(roots.copy(), sets, 800)
        assert set(found) <= {*every, *((b, a) for a, b in every)}
        assert len(found) < len(set(roots.tolist())) or not found

        def parts(links, roots=roots):
            label = {int(r): int(r) for r in roots}
            for a, b in links:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
            return label

        assert parts(found) == parts(every)


def test_sketches_of_every_text_with_words(spark):
    docs = spark.createDataFrame([("a b c d e f",), ("A  b c d e f",), ("",), (None,), ("x",), ("x",)], "text string")
    found = resemblance.sketches(docs).collect()
    assert sorted(r["n"] for r in found) == [1, 2, 2] and {len(r["bands"]) for r in found} == {resemblance.BANDS}
    assert len({tuple(r["bands"]) for r in found if r["n"] == 2}) == 1
    nobody = docs.limit(0).select(F.lit(1).cast("bigint").alias("doc_id"), "text")
    assert simhash.one_of_each(nobody, similarity=0.8).isEmpty()
    assert np.array_equal(resemblance.shingles(b"b a"), resemblance.shingles(b" B a "))
