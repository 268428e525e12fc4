"""Secrets in versions that are gone, and searches of several passes."""

from datetime import datetime, timezone

import pytest

from terrace.llm import contamination, secrets

SCHEMA = "doc_id bigint, text string, blob string, seen string"
DAY = [datetime(2026, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
KEY = "AKIA" + "B" * 16


def _docs(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "ledger"), str(tmp_path / "history")


def test_a_secret_taken_out_is_still_found(spark, paths):
    first = _docs(spark, (1, f"k {KEY}"), (2, f"k {KEY}"), (3, "nothing"), (None, None))
    assert secrets.scan_history(first, *paths, DAY[0]) == (4, 3)
    assert secrets.scan_history(first, *paths, DAY[1]) == (0, 0)
    later = _docs(spark, (1, "clean now"), (2, f"k {KEY}"), (3, "password=hunter22"), (None, None), (4, "nothing"))
    assert secrets.scan_history(later, *paths, DAY[2]) == (3, 2)  # two texts are new, one is only new to its path
    found = secrets.findings_by_path(later, *paths).collect()
    got = sorted((r["doc_id"], r["kind"], r["start"], r["end"], r["current"], r["seen"].day) for r in found)
    assert got == [(1, "access", 2, 22, False, 1), (2, "access", 2, 22, True, 1), (3, "assign", 0, 17, True, 3)]


def test_a_new_rule_version_scans_all_blobs_once(spark, paths):
    docs = _docs(spark, (1, "one two"), (2, "one two"), (3, "three"))
    secrets.scan_history(docs, *paths, DAY[0])
    newer = (*secrets.RULES, secrets.Rule("word", "two", version=2))
    assert secrets.scan_history(docs, *paths, DAY[1], newer) == (0, 2)
    assert secrets.scan_history(docs, *paths, DAY[1], newer) == (0, 0)
    found = secrets.findings_by_path(docs, *paths, newer).collect()
    assert sorted((r["doc_id"], r["kind"], r["start"]) for r in found) == [(1, "word", 4), (2, "word", 4)]
    assert secrets.findings_by_path(docs, *paths).isEmpty()  # by the older rules


def test_history_of_nothing(spark, paths):
    nothing = _docs(spark).limit(0)
    assert secrets.scan_history(nothing, *paths, DAY[0]) == (0, 0)
    assert secrets.findings_by_path(nothing, *paths).isEmpty()


def test_passes_one_after_the_other(spark, monkeypatch):
    """No more than one pass's machines are alive at a time."""
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "w1 w2"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(30)], "item_id bigint, text string")
    alive, most = set(), []
    real = spark.sparkContext.broadcast

    def sent(value):
        made = real(value)
        alive.add(id(made))
        most.append(len(alive))
        destroy = made.destroy

        def gone(*a):
            alive.discard(id(made))
            destroy(*a)

        made.destroy = gone
        return made

    one = {r["doc_id"]: (r["spans"], sorted(r["items"])) for r in contamination.find_passages(docs, items).collect()}
    kept = sorted(r["doc_id"] for r in contamination.without_passages(docs, items).collect())
    monkeypatch.setattr(spark.sparkContext, "broadcast", sent)
    many = {r["doc_id"]: (r["spans"], sorted(r["items"])) for r in contamination.find_passages(docs, items, per_pass=9).collect()}
    assert many == one and max(most) == 1 and len(most) > 2
    alive.clear()
    most.clear()
    assert sorted(r["doc_id"] for r in contamination.without_passages(docs, items, per_pass=9).collect()) == kept
    assert max(most) == 1 and len(most) > 2
