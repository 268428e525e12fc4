"""Source divergence, byte-level BPE and ranked search against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrace.llm import bpe, divergence, pretokens, ranking
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, item string, n bigint, ids string, value int"
CLASH = ("clash", "clash", 3, "clash", 7)


def _made(seed=2, count=260):
    draw = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(60)] + ["Ünï", "日本", "don't", "A1b", "42"]
    rows = []
    for i in range(count):
        n = draw.choice((0, 1, 5, 40, 90))
        text = " ".join(draw.choice(words[: draw.choice((6, 65))]) for _ in range(n))
        lang, source = draw.choice((("en", "s1"), ("en", "s1"), ("en", "s2"), ("en", None), ("fr", "s1"), (None, "x"), ("fr", "é")))
        rows.append((i, text, lang, source, *CLASH))
    rows += [rows[3], rows[4], (None, "wa wb", "en", "s2", *CLASH), (7, "other words wa", "en", "s9", *CLASH)]
    rows += [(500, None, "en", "s2", *CLASH), (501, "", "solo", "only", *CLASH), (502, "wa " * 30_000 + "Ünï", "en", "s2", *CLASH)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _divergent(rows, min_docs=10, top=10):
    pattern, counts, df = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", {}, {}
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        terms = re.findall(pattern, (r[1] or "").translate(brute.ASCII_LOWER))
        counts.setdefault((lang, source), Counter()).update(terms)
        df.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang, own in df.items():
        kept = sorted((t for t, n in own.items() if n >= min_docs), key=str.encode)
        v = len(kept)
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        total = sum(groups.values(), Counter())

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(total)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            term = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -x, i) for i, (x, _, o) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", t, -x, i) for i, (x, _, t) in enumerate(sorted(term)[:top], 1)]
    return out


@pytest.mark.parametrize("held", [200_000, 5])
def test_divergence(docs, rows, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    found = divergence.audited(docs)
    assert sorted(map(tuple, found.collect())) == sorted(_divergent(rows))


def test_divergence_of_ties_and_nothing(spark, docs, rows, empty):
    assert divergence.audited(empty).isEmpty()
    few = [r for r in rows if r[2] == "fr"][:9]
    assert sorted(map(tuple, divergence.audited(spark.createDataFrame(few, SCHEMA)).collect())) == sorted(_divergent(few))
    same = [(i, "aa bb cc dd", "en", f"s{i % 2}", *CLASH) for i in range(40)]
    same += [(99, "aa bb cc dd ee ff gg hh ii jj kk ll", "en", "s0", *CLASH)] * 11
    got = divergence.audited(spark.createDataFrame(same, SCHEMA), top=3)
    assert sorted(map(tuple, got.collect())) == sorted(_divergent(same, top=3))


def _ranked(rows, items, top=10):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = lambda t: re.findall(pattern, (t or "").translate(brute.ASCII_LOWER))
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, own in asked.items():
        weight = {t: int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t in own}
        scored = []
        for (doc, c), n in zip(docs, sizes, strict=True):
            m = 10 + 90 * n * n_docs // max(total, 1)
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(i, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(scored)[:top], 1)]
    return out


ITEMS = [(1, "wa wb WC"), (2, "ünï 日本 wa wa"), (3, None), (4, "..."), (5, "absent"), (6, "42 don't"), (1, "wd A1b"), (None, "wax")]


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("how", [{}, {"BLOCK_ITEMS": 2, "TABLE": 40}, {"BLOCK_TERMS": 1, "BROADCAST_BYTES": 0}])
def test_ranked_search(spark, docs, rows, monkeypatch, how):
    for name, value in how.items():
        monkeypatch.setattr(ranking, name, value)
    # Copies of one document, more than are asked for, far apart by id.
    more = rows + [(1000 - i, "wa wb Ünï", "en", "s1", *CLASH) for i in range(30)]
    more += [(2000, "Ünï, ünï: wa; wb zz", "en", "s1", *CLASH), (2001, "WB wa qq ünï Ünï", "en", "s1", *CLASH)]
    frame = spark.createDataFrame(more, SCHEMA).repartition(3)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, doc_id string")
    got = ranking.ranked(frame, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert _sorted(map(tuple, got.collect())) == _sorted(_ranked(more, ITEMS))


def test_ranked_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranking.ranked(empty, items).isEmpty()
    assert ranking.ranked(docs, items.limit(0)).isEmpty()
    assert ranking.ranked(docs.filter("text is null or text = ''"), items).isEmpty()


def test_scores_too_large_for_doubles_stay_whole():
    found = []
    for number in (np.float64, np.int64):
        weight = np.full(3, 10**9)
        value = weight * (10**9 * np.array([3, 5, 7]) // (1000 * np.array([3, 5, 7]) + 88))
        found.append(int((value.astype(number)[None, :] @ np.ones((3, 1), number))[0, 0]))
    assert found[1] == sum(value.tolist())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(bpe.default_ranks(), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_against_the_library(spark, docs, rows, empty, library):
    expected = []
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((r[0], len(ids), digest, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert _sorted(map(tuple, bpe.digests(docs).collect())) == _sorted(expected)
    ids = bpe.encoded(docs)
    assert _sorted((r["doc_id"], len(r["ids"])) for r in ids.collect()) == _sorted(e[:2] for e in expected)
    back = bpe.decoded(ids.unionByName(ids.limit(1).withColumn("ids", F.lit(None).cast("array<int>"))))
    texts = sorted((r[1] or "").encode() for r in rows)
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == sorted([b"", *texts])
    assert bpe.digests(empty).isEmpty() and bpe.decoded(bpe.encoded(empty)).isEmpty()


def test_pieces_are_those_of_the_pattern(library):
    import public_tokenizers
    import regex

    pool = ["a", "s", "t", "re", "ve", "'", "'s", "'ll", "'l", "'r", "'v", " ", "  ", "\n", "\t", "1", "é", "字", "😀", "!",
            "'d", "e", "l", "''", " '", "\x85", "Ⅷ", " ", "　", "m", "<|endoftext|>", "​"]
    draw = random.Random(1)
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 40))) for _ in range(4000)]
    texts += ["", "x" * 5000, " " * 5000, "' " * 3000 + "'"]
    table = bpe.class_table()
    found, counts = pretokens.pieces(pa.array(texts), table)
    found, at = found.to_pylist(), 0
    for text, n in zip(texts, counts, strict=True):
        assert [x.decode() for x in found[at : at + n]] == regex.findall(public_tokenizers.PATTERN, text)
        at += n
    assert at == len(found)
    assert pretokens.pieces(pa.array([], pa.string()), table)[0].to_pylist() == []
    codec = bpe.Codec(bpe.read_ranks(open(bpe.default_ranks(), "rb").read()), table, remembered=20)
    for at in range(0, len(texts), 300):
        some = texts[at : at + 300]
        ids = codec.encode(pa.array(some))
        assert ids.to_pylist() == library.encode_ordinary_batch(some, num_threads=1)
        assert codec.decode(ids).to_pylist() == [t.encode() for t in some]


def test_scan_is_a_running_product():
    draw = np.random.default_rng(0)
    for n in (0, 1, 63, 64, 1000, 4097):
        numbers = pretokens.OF_CLASS[draw.integers(0, 11, n)]
        state, states = pretokens.START, []
        for f in numbers:
            state = int(pretokens.FUNCTIONS[f, state])
            states.append(state)
        assert pretokens.FUNCTIONS[pretokens.scan(numbers), pretokens.START].tolist() == states


def test_pieces_begin_where_the_machine_with_states_says():
    draw = np.random.default_rng(3)
    pool = np.array([ord(c) for c in "abstmdrvel''' \n\t17!?éⅧ　字😀"], np.uint32)
    table = bpe.class_table()
    for _ in range(1500):
        sizes = draw.integers(0, 12, draw.integers(1, 6))
        codes = pool[draw.integers(0, len(pool), sizes.sum())]
        edges = np.append(0, np.cumsum(sizes))
        own, before, at = pretokens.begins(codes, table, edges), [], 0
        for size in sizes.tolist():
            state, found = pretokens.START, [False] * size
            for i, seen in enumerate([*table[codes[at : at + size]].tolist(), pretokens.END]):
                state, begin = pretokens._step(state, seen)
                if begin & pretokens.HERE and i < size:
                    found[i] = True
                if begin & pretokens.BEFORE:
                    found[i - 1] = True
            before += found
            at += size
        assert own.tolist() == before


def test_a_piece_of_every_batch_is_merged_once_whatever_is_forgotten():
    asked = []

    def merge(some):
        asked.extend(some)
        return [len(p) for p in some], [1] * len(some)

    own = pretokens.PieceIds(bpe.class_table(), merge, remembered=30)
    for n in range(40):
        new = [f" {chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + k)}" for k in range(5)]
        ends, ids = own.encode(pa.array(["every" + "".join(new), "", "every"]))
        assert (ends.tolist(), ids.tolist()) == ([0, 6, 6, 7], [5, *[4] * 5, 5])
        assert len(own.known) + len(own.older) <= 30 + 2 * 6
    assert asked.count(b"every") == 1 and len(asked) == 201
