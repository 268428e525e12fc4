import json

import pytest

from terrace.contracts import PayloadSpec
from terrace.operators.dedup import deduplicate
from terrace.streaming.ingest import (
    batch_writer,
    drain,
    file_records,
    ingest_status,
    kafka_records,
    read_ingested,
    read_rejected,
    start_ingest,
    stop_ingest,
)
from terrace.streaming.publish import publish
from terrace.streaming.records import RECORD_SCHEMA, parse_records, to_records

SPEC = PayloadSpec(("ano", "id", "nota"), (("nota", "double"),))
COLUMNS = ("ano", "id", "nota")


def source(spark, n=12):
    data = [("2024" if i % 2 else "2023", f"{i:03}", f"{i}.5" if i % 3 else "") for i in range(n)]
    return spark.createDataFrame(data, "ano string, id string, nota string").coalesce(1)


def test_records_keep_every_field(spark):
    df = spark.createDataFrame([("7", None), (None, "x")], "id string, t string")
    found = {r["key"]: json.loads(bytes(r["data"])) for r in to_records(df, "id").collect()}
    assert found == {"7": {"id": "7", "t": None}, "default": {"id": None, "t": "x"}}
    assert to_records(df, "absent").first()["key"] == "default"


def test_parse(spark, rows):
    texts = ['{"ano":"2024","id":"1","nota":"x"}', '{"ano":2024,"nota":"1.5","more":1}',
             "{bad", "null", "", '{"other":1}', "[]"]
    records = spark.createDataFrame([("k", bytearray(t, "utf-8")) for t in texts], RECORD_SCHEMA)
    parsed = parse_records(records, SPEC)
    valid = parsed.filter("record_status = 'valid'")
    assert rows(valid, *COLUMNS, "raw_record") == [("2024", None, 1.5, None)]
    rejected = parsed.filter("record_status = 'rejected'")
    assert {r[0] for r in rows(rejected, "raw_record")} == {
        "{bad", "null", "", '{"other":1}', "[]", '{"ano":"2024","id":"1","nota":"x"}',
    }


def test_fields_that_do_not_fit_are_rejected_with_their_text(spark, rows):
    texts = ['{"ano":"20x4","id":"1","nota":"1"}', '{"ano":"2024","id":"2","nota":"7O0"}',
             '{"ano":"","id":"3","nota":""}', '{"id":"4"}']
    records = spark.createDataFrame([("k", bytearray(t, "utf-8")) for t in texts], RECORD_SCHEMA)
    parsed = parse_records(records, SPEC)
    assert rows(parsed, "id", "ano", "nota", "record_status", "raw_record") == [
        ("1", None, 1.0, "rejected", texts[0]), ("2", "2024", None, "rejected", texts[1]),
        ("3", None, None, "valid", None), ("4", None, None, "valid", None),
    ]


@pytest.fixture
def published(spark, tmp_path):
    publish(source(spark), "id", str(tmp_path / "in"), records_per_file=5, ranges=1)
    return str(tmp_path / "in")


def handler(tmp_path, label):
    return batch_writer(SPEC, "e", str(tmp_path / "out"), label)


def test_bounded_batches_and_same_result_as_batch(spark, rows, tmp_path, published):
    drain(file_records(spark, published, 1), handler(tmp_path, "a"), str(tmp_path / "c"))
    batches = sorted(p.name for p in (tmp_path / "out" / "run=a").iterdir() if p.is_dir())
    assert batches == ["batch_id=0", "batch_id=1", "batch_id=2"]
    ingested = read_ingested(spark, str(tmp_path / "out"))
    assert not {"run", "batch_id", "record_status", "raw_record"} & set(ingested.columns)
    batch = parse_records(spark.read.parquet(published), SPEC)
    expected = [(int(a), i, n) for a, i, n in rows(batch, *COLUMNS)]
    assert rows(ingested, *COLUMNS) == expected


def test_compact_batches_have_one_file_per_year(spark, rows, tmp_path, published):
    for compact in (False, True):
        write = batch_writer(SPEC, "e", str(tmp_path / f"{compact}"), "a", compact=compact)
        write(spark.read.parquet(published).repartition(4), 0)
    counts = [len(list((tmp_path / f"{c}").rglob("*.parquet"))) for c in (False, True)]
    assert counts[0] > 2 and counts[1] == 2
    plain, compacted = (read_ingested(spark, str(tmp_path / f"{c}")) for c in (False, True))
    assert rows(plain, *COLUMNS) == rows(compacted, *COLUMNS)


def test_same_checkpoint_goes_on_where_it_stopped(spark, tmp_path, published):
    run = lambda: drain(
        file_records(spark, published), handler(tmp_path, "a"), str(tmp_path / "c")
    )
    run()
    run()
    assert read_ingested(spark, str(tmp_path / "out")).count() == 12
    to_records(source(spark, 15).filter("id > '011'"), "id").write.parquet(f"{published}/range=1")
    run()
    assert read_ingested(spark, str(tmp_path / "out")).count() == 15


def test_a_repeated_batch_replaces_itself(spark, tmp_path, published):
    write = handler(tmp_path, "a")
    batch = spark.read.parquet(published)
    write(batch, 0)
    write(batch, 0)
    assert read_ingested(spark, str(tmp_path / "out")).count() == 12


def test_crash_between_write_and_commit(spark, rows, tmp_path, published):
    """Without its commit a batch runs again; the records must not be there twice."""
    run = lambda: drain(
        file_records(spark, published, 1), handler(tmp_path, "a"), str(tmp_path / "c")
    )
    run()
    before = rows(read_ingested(spark, str(tmp_path / "out")), *COLUMNS)
    last = tmp_path / "c" / "commits" / "2"
    last.unlink()
    (tmp_path / "c" / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert last.exists()
    assert rows(read_ingested(spark, str(tmp_path / "out")), *COLUMNS) == before


def test_fresh_checkpoint_adds_nothing_after_dedup(spark, rows, tmp_path, published):
    for label in ("a", "b"):
        drain(file_records(spark, published), handler(tmp_path, label), str(tmp_path / label))
    ingested = read_ingested(spark, str(tmp_path / "out"))
    assert ingested.count() == 24
    kept = deduplicate(ingested, ("ano", "id"), ("_ingestion_timestamp",), "n")
    assert kept.count() == 12 and rows(kept.select("n").distinct()) == [(2,)]


def test_empty_batch_writes_nothing(spark, tmp_path):
    handler(tmp_path, "a")(spark.createDataFrame([], RECORD_SCHEMA), 0)
    assert not (tmp_path / "out").exists()
    assert read_ingested(spark, str(tmp_path / "out")) is None
    assert read_rejected(spark, str(tmp_path / "out")) is None


def test_label_must_read_back_as_text():
    with pytest.raises(ValueError):
        batch_writer(SPEC, "e", "out", "007")


def test_a_topic_needs_the_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_records(spark, "host:9092", "students", records_per_batch=500)


def test_start_status_stop(spark, tmp_path, published):
    query = start_ingest(
        file_records(spark, published), handler(tmp_path, "a"), str(tmp_path / "c"), "1 second"
    )
    query.processAllAvailable()
    status = ingest_status(query)
    assert status["active"] and status["batch_id"] == 0 and len(status["read_up_to"]) == 1
    assert read_ingested(spark, str(tmp_path / "out")).count() == 12
    stop_ingest(query)
    stop_ingest(query)
    assert not ingest_status(query)["active"]
