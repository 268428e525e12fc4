"""The mixture against the given weights, over many periods."""

from fractions import Fraction

from terrace.llm import mixing


def test_no_source_drifts_from_its_weight():
    weights = [(1 / 3) ** 0.5] + [(2 / 57) ** 0.5] * 19
    whole = mixing.whole_weights(weights)
    total = sum(map(Fraction, weights))
    targets = [Fraction(w) / total for w in weights]
    assert [Fraction(w, sum(whole)) for w in whole] == targets
    slots, counts = 25_000, [0] * len(weights)
    for at, (s, block, release, deadline, slot) in enumerate(mixing.turns(whole, [slots] * len(weights))):
        if at == slots:
            break
        assert slot == at and block == counts[s] and release <= slot < deadline
        counts[s] += 1
        if at % 97 == 0 or at == slots - 1:
            assert all(abs(c - (at + 1) * t) < 1 for c, t in zip(counts, targets, strict=True))


def test_periods_planned_apart_are_one_schedule():
    whole, ends = mixing.whole_weights([0.5, 0.3, 0.0001, 0.2]), [300, 40, 3, 77]
    made = list(mixing.turns(whole, ends))
    assert len(made) == sum(ends) and len({r[-1] for r in made}) == len(made)
    again = []
    for slot, given in mixing.states(whole, ends, 13):
        turns = mixing.turns(whole, ends, given, slot)
        again += [r for r, _ in zip(turns, range(13))]
    assert again == made


def test_a_small_weight_is_kept(spark):
    rows = [(i, "x" * 10, "big" if i % 4 else "small") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights = {"big": 0.9999, "small": 0.0001}
    placed = mixing.scheduled(docs, weights, period=7, block_chars=10, bucket_rows=30).collect()
    assert len(placed) == 400 and len({r["mix_slot"] for r in placed}) == 400
    total = sum(Fraction(w) for w in weights.values())
    for r in placed:
        share = Fraction(weights[r["source"]]) / total
        assert r["mix_release"] == r["mix_block"] / share // 1
        assert r["mix_deadline"] == -(-(r["mix_block"] + 1) / share // 1)
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]


def test_blocks_grow_where_there_would_be_too_many(spark):
    rows = [(i, "x" * (1 + i % 50), f"s{i % 4}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    placed = mixing.scheduled(docs, period=3, block_chars=10, bucket_rows=100, most_blocks=40).collect()
    assert len(placed) == 2000
    slots = {(r["source"], r["mix_block"]): r["mix_slot"] for r in placed}
    assert 30 <= len(slots) <= 44 and len(set(slots.values())) == len(slots)
    size = -(-sum(len(r[1]) for r in rows) // 40)
    assert all(r["mix_block"] == r["mix_start"] // size for r in placed)
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in placed)


def test_the_query_is_the_schedule_of_plain_python(spark):
    """Slots against a schedule made slot by slot, from the characters of each source."""
    rows = [(i, "y" * (i % 37), f"s{i % 3}") for i in range(300)] + [(900, None, None), (901, "", "s0"), (902, "z" * 500, "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    placed = mixing.scheduled(docs, {"s0": 5, "s1": 2, "s2": 3, None: 1}, block_chars=50, bucket_rows=20).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text or "")
    weights = {s: Fraction(w, 11) for s, w in (("s0", 5), ("s1", 2), ("s2", 3), (None, 1))}
    ends, given, slot, expected = {s: n // 50 + 1 for s, n in sizes.items()}, dict.fromkeys(sizes, 0), 0, {}
    while any(given[s] < ends[s] for s in ends):
        ready = [
            (-(-(given[s] + 1) // weights[s]), str(s), s) for s in ends
            if given[s] < ends[s] and given[s] // weights[s] <= slot
        ]
        if ready:
            deadline, _, s = min(ready)
            expected[s, given[s]] = (slot, deadline)
            given[s] += 1
        slot += 1
    deadlines = {k: d for k, (_, d) in expected.items()}
    for r in placed:
        key = (r["source"], r["mix_block"])
        assert r["mix_deadline"] == deadlines[key] and r["mix_slot"] < deadlines[key]
    # Ties of deadlines may be broken otherwise; which slots are used may not.
    used = {(r["source"], r["mix_block"]): r["mix_slot"] for r in placed}
    assert set(used.values()) <= {slot for slot, _ in expected.values()} and len(set(used.values())) == len(used)
