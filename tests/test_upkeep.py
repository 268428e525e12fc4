"""What keeps streams and layers in order between runs."""

import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from terrace.contracts import PayloadSpec
from terrace.functions.lineage import Run
from terrace.operators.dedup import deduplicate
from terrace.plans import literacy as L
from terrace.plans import refresh
from terrace.sources.buckets import bucketed_name, merge_bucketed, ordered_buckets, write_bucketed
from terrace.sources.changes import changed, partition_files, write_note
from terrace.sources.layers import Store
from terrace.streaming import compaction
from terrace.streaming.ingest import BACKLOG_BATCHES, batch_writer, drain, file_records, read_ingested, read_rejected
from terrace.streaming.publish import NOTE, publish, published_ranges, range_of
from terrace.streaming.records import RECORD_SCHEMA, to_records
from terrace.streaming.unique import arriving_records, state_partitions, unique_rows, unique_status, unique_writer
from tests.test_layers import FILES, STUDENTS

SPEC = PayloadSpec(("ano", "id", "nota"), (("nota", "double"),))
KEY = ("ano", "id")


def _records(spark, texts, path):
    frame = spark.createDataFrame([("k", bytearray(t, "utf-8")) for t in texts], RECORD_SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(path)


def _text(key, ano="2024", nota="1"):
    return f'{{"ano":"{ano}","id":"{key}","nota":"{nota}"}}'


def _date(path, seconds):
    """Give the files that have no date of ours yet this one."""
    for name in sorted(os.listdir(path)):
        file = f"{path}/{name}"
        if name.endswith(".parquet") and os.path.getmtime(file) > 1_500_000_000:
            os.utime(file, (1_400_000_000 + seconds, 1_400_000_000 + seconds))


class _Stream:
    def __init__(self, spark, where, within="10 minutes"):
        self.spark, self.where, self.within, self.at = spark, str(where), within, 0
        self.write = unique_writer(SPEC, "e", f"{self.where}/out", "a")

    def arrive(self, *texts, after=0):
        self.at += after
        _records(self.spark, texts, f"{self.where}/in")
        _date(f"{self.where}/in", self.at)
        drain(self.rows(), self.write, f"{self.where}/c")

    def rows(self):
        return unique_rows(arriving_records(self.spark, f"{self.where}/in", 1), SPEC, KEY, self.within)

    def ids(self):
        return sorted(str(r["id"]) for r in read_ingested(self.spark, f"{self.where}/out").collect())


def test_a_stream_stores_a_key_once_over_restarts(spark, tmp_path):
    stream = _Stream(spark, tmp_path)
    stream.arrive(_text("1"), _text("2"), _text("1"))
    assert stream.ids() == ["1", "2"]
    stream.arrive(_text("2", nota="9"), _text("3"), _text("2", ano="2023"), after=60)  # a new query each time
    assert stream.ids() == ["1", "2", "2", "3"]
    drain(stream.rows(), stream.write, f"{tmp_path}/c")
    assert stream.ids() == ["1", "2", "2", "3"]


def test_a_batch_of_unique_rows_leaves_a_file_a_core_and_year_whatever_the_state(spark, tmp_path):
    _records(spark, [_text(str(n)) for n in range(200)] + [_text("7"), "no record"], f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        assert state_partitions(spark) == 8
        stream = _Stream(spark, tmp_path)
        _records(spark, [_text("7"), _text("200")], f"{tmp_path}/in")
        drain(stream.rows(), stream.write, f"{tmp_path}/c", state_partitions(spark))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stored = read_ingested(spark, f"{tmp_path}/out")
    assert (stored.count(), stored.select("id").distinct().count()) == (201, 201)
    assert read_rejected(spark, f"{tmp_path}/out").count() == 1
    batches = [b for b in (tmp_path / "out" / "run=a").iterdir() if b.is_dir()]
    assert all(len(list(b.rglob("record_status=valid/**/*.parquet"))) <= 4 for b in batches)
    assert max(int(p.name) for p in (tmp_path / "c" / "state" / "0").iterdir() if p.name.isdigit()) < 8


def test_a_backlog_of_many_files_comes_in_few_batches(spark, tmp_path):
    texts = spark.createDataFrame([("k", bytearray(_text(str(n)), "utf-8")) for n in range(70)], RECORD_SCHEMA)
    texts.repartition(70).write.parquet(f"{tmp_path}/in")
    files = len(list((tmp_path / "in").glob("*.parquet")))
    assert files > 2 * BACKLOG_BATCHES
    drain(file_records(spark, f"{tmp_path}/in", 1), batch_writer(SPEC, "e", f"{tmp_path}/out", "a"), f"{tmp_path}/c")
    batches = [b for b in (tmp_path / "out" / "run=a").iterdir() if b.is_dir()]
    assert 1 < len(batches) <= BACKLOG_BATCHES
    assert sorted(int(r["id"]) for r in read_ingested(spark, f"{tmp_path}/out").collect()) == list(range(70))


def test_a_forgotten_key_is_stored_again_and_removed_later(spark, tmp_path):
    stream = _Stream(spark, tmp_path)
    stream.arrive(_text("1"))
    stream.arrive(_text("2"), after=3600)  # the watermark passes the first key
    stream.arrive(_text("3"), after=60)
    stream.arrive(_text("1"), after=60)
    assert stream.ids() == ["1", "1", "2", "3"]
    assert deduplicate(read_ingested(spark, f"{tmp_path}/out"), KEY, ("_ingestion_timestamp",)).count() == 3


def test_what_is_no_record_or_has_no_key_stays(spark, tmp_path):
    stream = _Stream(spark, tmp_path)
    lone = '{"ano":"2024","nota":"1"}'
    stream.arrive("{bad", "{bad", _text("1"), _text("1", nota="x"), lone, lone)
    assert stream.ids() == ["1", "None", "None"]
    rejected = sorted(r["raw_record"] for r in read_rejected(spark, f"{tmp_path}/out").collect())
    assert rejected == [_text("1", nota="x"), "{bad", "{bad"]


def test_status_counts_copies(spark, tmp_path):
    stream = _Stream(spark, tmp_path)
    _records(spark, [_text("1"), _text("1"), _text("2")], f"{tmp_path}/in")
    query = (
        stream.rows().writeStream.foreachBatch(stream.write).option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    status = unique_status(query)
    assert (status["records"], status["duplicates"], status["keys_held"]) == (3, 1, 2)


def _source(spark, n=60, more=()):
    data = [("2024", f"{i % (n - 5):03}", f"{i}.5" if i % 7 else "") for i in range(n)] + list(more)
    return spark.createDataFrame(data + data[:2] * 2, "ano string, id string, nota string")


def test_publication_goes_on_where_it_stopped(spark, rows, tmp_path, monkeypatch):
    path, frame = str(tmp_path / "in"), _source(spark)
    calls = []
    import terrace.streaming.publish as module

    real = module.to_records

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(module, "to_records", failing)
    with pytest.raises(OSError, match="lost"):
        publish(frame, "id", path, ranges=8, ranges_a_commit=2)
    monkeypatch.setattr(module, "to_records", real)
    first = {r["range"] for r in published_ranges(spark, path).collect()}
    assert len(first) == 4
    kept = {p: os.path.getmtime(p) for r in first for p in map(str, (tmp_path / "in" / f"range={r}").iterdir())}
    left = publish(frame, "id", path, ranges=8, ranges_a_commit=2)
    assert not first & set(left) and first | set(left) == set(range(8))
    assert kept == {p: os.path.getmtime(p) for p in kept}
    expected = sorted(bytes(r["data"]) for r in to_records(frame, "id").collect())
    assert sorted(bytes(r["data"]) for r in spark.read.parquet(path).collect()) == expected
    assert publish(frame, "id", path, ranges=8) == []


def test_only_ranges_that_changed_are_published_again(spark, tmp_path):
    path = str(tmp_path / "in")
    publish(_source(spark), "id", path, ranges=8)
    more = _source(spark, more=[("2024", "new", "1")])
    own = spark.range(1).select(F.lit("new").alias("id")).select(range_of(spark.range(1).select(F.lit("new").alias("id")), "id", 8)).first()[0]
    assert publish(more, "id", path, ranges=8) == [own]
    assert spark.read.parquet(path).count() == more.count()
    assert publish(spark.createDataFrame([], "id string, x int"), "id", str(tmp_path / "none")) == []
    with pytest.raises(ValueError, match="ranges"):
        publish(more, "id", path, ranges=2)
    assert NOTE.startswith("_")


# --- Compaction ---


@pytest.fixture
def batches(spark, tmp_path):
    out = str(tmp_path / "out")
    write = batch_writer(SPEC, "e", out, "a")
    for b in range(6):
        texts = [_text(10 * b + i, ano=str(2023 + i % 2), nota="x" if i == 3 else "1") for i in range(5)]
        frame = spark.createDataFrame([("k", bytearray(t, "utf-8")) for t in texts], RECORD_SCHEMA)
        write(frame.repartition(2), b)
    return out


def _state(spark, out):
    ids = sorted(r["id"] for r in read_ingested(spark, out).collect())
    return ids, sorted(r["raw_record"] for r in read_rejected(spark, out).collect())


def test_compaction_keeps_every_row_once(spark, batches):
    before, files = _state(spark, batches), compaction.stored_files(spark, batches)
    assert compaction.compact_batches(spark, batches) == ["a.0.4"]
    assert _state(spark, batches) == before
    assert compaction.sweep(spark, batches) == 5
    assert _state(spark, batches) == before and compaction.stored_files(spark, batches) < files
    assert compaction.compact_batches(spark, batches) == [] and compaction.sweep(spark, batches) == 0
    # A later batch is read next to the bins, and packed when it is no longer the last.
    write = batch_writer(SPEC, "e", batches, "a")
    for b in (6, 7):
        write(spark.createDataFrame([("k", bytearray(_text(90 + b), "utf-8"))], RECORD_SCHEMA), b)
    ids = _state(spark, batches)[0]
    assert len(ids) == len(before[0]) + 2
    assert compaction.compact_batches(spark, batches) == ["a.5.6"]
    assert _state(spark, batches)[0] == ids


def test_compaction_ended_before_its_manifest(spark, batches, monkeypatch):
    before = _state(spark, batches)
    real = compaction.plan_bins

    class Lost(Exception):
        pass

    def lines(*args, **kwargs):
        raise Lost

    frame = type(spark)
    create = frame.createDataFrame
    monkeypatch.setattr(frame, "createDataFrame", lines)
    with pytest.raises(Lost):
        compaction.compact_batches(spark, batches)
    monkeypatch.setattr(frame, "createDataFrame", create)
    assert os.path.isdir(f"{batches}/{compaction.BINS}") and compaction.manifest(spark, batches) is None
    assert _state(spark, batches) == before
    assert real(spark, batches).count() == 1
    compaction.compact_batches(spark, batches)
    assert _state(spark, batches) == before


def test_bins_follow_the_size_of_files(spark, batches):
    size = compaction.batch_files(spark, batches).agg(F.avg("bytes")).first()[0]
    bins = compaction.plan_bins(spark, batches, target_bytes=int(size * 2)).collect()
    ends = sorted((r["first"], r["last"]) for r in bins)
    assert len(ends) == 2 and ends[0][0] == 0 and ends[0][1] + 1 == ends[1][0] and all(a < b for a, b in ends)
    assert compaction.plan_bins(spark, batches, target_bytes=1).isEmpty()


# --- Refresh ---

ONE = Run(datetime(2026, 1, 2, tzinfo=timezone.utc))
TWO = Run(datetime(2026, 1, 3, tzinfo=timezone.utc))


@pytest.fixture
def root(spark, tmp_path):
    (tmp_path / "arquivos").mkdir()
    for name, lines in FILES.items():
        (tmp_path / "arquivos" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return tmp_path


def _stamps(spark, root, layer, entity):
    column = {"silver": "_silver_processing_timestamp", "gold": "_gold_processing_timestamp"}[layer]
    table = Store(spark, str(root)).read(layer, entity)
    return {(r["ano"], r[column]) for r in table.select("ano", column).distinct().collect()}


def test_refresh_writes_what_changed_only(spark, root):
    reports = refresh.refresh_layers(spark, str(root), ONE)
    assert {r["layer"] for r in reports} == {"bronze", "silver", "gold"}
    expected = [tuple(r) for r in Store(spark, str(root)).read("gold", L.ANALYTICAL).drop("_gold_processing_timestamp").sort("ano", "id_municipio", "rede").collect()]
    assert refresh.refresh_layers(spark, str(root), TWO) == []
    assert refresh.up_to_date(spark, str(root)).filter("not current").isEmpty()

    name = "br_inep_avaliacao_alfabetizacao_municipio.csv"
    lines = [x.replace("2023,3550308,2,3,49.5", "2023,3550308,2,3,48.5") for x in FILES[name]]
    (root / "arquivos" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    reports = refresh.refresh_layers(spark, str(root), TWO)
    assert [(r["layer"], r["years"]) for r in reports] == [("bronze", ["2023"]), ("silver", ["2023"]), ("gold", ["2023"])]
    entity = "avaliacao_alfabetizacao_municipio"
    assert _stamps(spark, root, "silver", reports[1]["entity"]) == {(2023, TWO.stamp), (2024, ONE.stamp)}
    assert _stamps(spark, root, "gold", L.ANALYTICAL) == {(2023, TWO.stamp), (2024, ONE.stamp)}
    assert entity in reports[1]["entity"]
    after = [tuple(r) for r in Store(spark, str(root)).read("gold", L.ANALYTICAL).drop("_gold_processing_timestamp").sort("ano", "id_municipio", "rede").collect()]
    assert len(after) == len(expected) and after != expected


def test_refresh_of_a_dimension_reaches_all_years(spark, root):
    refresh.refresh_layers(spark, str(root), ONE)
    name = "br_bd_diretorios_brasil_municipio.csv"
    lines = [x.replace("Fortaleza", "Fortaleza!") for x in FILES[name]]
    (root / "arquivos" / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    refresh.refresh_layers(spark, str(root), TWO)
    gold = Store(spark, str(root)).read("gold", L.ANALYTICAL)
    assert not gold.filter("nome_municipio = 'Fortaleza!'").isEmpty()
    assert {s for _, s in _stamps(spark, root, "gold", L.ANALYTICAL)} == {TWO.stamp}


def test_refresh_ended_midway_is_made_good(spark, root, monkeypatch):
    def lost(*args, **kwargs):
        raise OSError("lost")

    real = refresh.build_analytical
    monkeypatch.setattr(refresh, "build_analytical", lost)
    with pytest.raises(OSError):
        refresh.refresh_layers(spark, str(root), ONE)
    monkeypatch.setattr(refresh, "build_analytical", real)
    reports = refresh.refresh_layers(spark, str(root), TWO)
    assert [r["layer"] for r in reports] == ["gold"] and reports[0]["years"] == ["2023", "2024"]


def test_changes_of_partitions(spark, tmp_path):
    path, note = str(tmp_path / "t"), str(tmp_path / "note")
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "ano int, x string")
    frame.write.partitionBy("ano").parquet(path)
    figures = partition_files(spark, path, "ano")
    assert changed(figures, note) == ["1", "2", "__HIVE_DEFAULT_PARTITION__"]
    write_note(figures, note, ["1", "__HIVE_DEFAULT_PARTITION__"])
    assert changed(figures, note) == ["2"]
    write_note(figures, note, ["2"])
    frame.filter("ano = 1").write.mode("append").partitionBy("ano").parquet(path)
    assert changed(partition_files(spark, path, "ano"), note) == ["1"]
    assert partition_files(spark, str(tmp_path / "absent"), "ano").isEmpty()


# --- Buckets ---


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(n=400, seed=1):
    draw = random.Random(seed)
    hot = [("hot", 1, i, f"{i % 7}") for i in range(n // 3)]
    return hot + [(draw.choice("abcd") + str(draw.randrange(40)), draw.randrange(3), draw.randrange(9), draw.choice("xyz")) for _ in range(n)]


@pytest.fixture
def big_joins(spark):
    """Nothing is small enough to be broadcast, and plans are as made."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_no_exchange_for_work_by_the_key(spark, tmp_path, big_joins):
    lines = spark.createDataFrame(_lines(), "k string, n int, v int, t string")
    raw = write_bucketed(lines, bucketed_name("raw"), str(tmp_path / "raw"), ("k", "n"), 4)
    unique = deduplicate(raw, ("k", "n"), ("v",))
    assert "Exchange" not in _plan(unique)
    left = write_bucketed(unique, bucketed_name("left"), str(tmp_path / "left"), ("k", "n"), 4)
    right = write_bucketed(lines.groupBy("k", "n").agg(F.count(F.lit(1)).alias("c")), bucketed_name("right"), str(tmp_path / "right"), ("k", "n"), 4)
    joined = left.join(right, ["k", "n"], "left")
    assert "Exchange" not in _plan(joined)
    with ordered_buckets(spark):
        again = spark.table(left.sparkSession.catalog.listTables()[0].name)  # any, to plan anew
        assert again is not None
    plain = deduplicate(lines, ("k", "n"), ("v",)).join(lines.groupBy("k", "n").agg(F.count(F.lit(1)).alias("c")), ["k", "n"], "left")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))


def test_buckets_in_order_need_no_sort(spark, tmp_path, big_joins):
    lines = spark.createDataFrame(_lines(), "k string, n int, v int, t string")
    names = [bucketed_name("one"), bucketed_name("two")]
    for i, name in enumerate(names):
        write_bucketed(deduplicate(lines, ("k", "n")), name, str(tmp_path / str(i)), ("k", "n"), 4)
    with ordered_buckets(spark):
        joined = spark.table(names[0]).join(spark.table(names[1]).select("k", "n"), ["k", "n"])
        plan = _plan(joined)
    assert "Exchange" not in plan and "Sort [" not in plan and "SortMergeJoin" in plan


def test_merging_moves_the_increment_only(spark, tmp_path, big_joins):
    first, second = _lines(), _lines(seed=2)
    schema = "k string, n int, v int, t string"
    frames = [spark.createDataFrame(x, schema) for x in (first, second)]
    stored = deduplicate(frames[0], ("k", "n"), ("v",))
    stored = write_bucketed(stored, bucketed_name("s"), str(tmp_path / "s"), ("k", "n"), 4)
    merged = merge_bucketed(stored, frames[1].unionByName(spark.createDataFrame([(None, 1, 1, "x")], schema)), ("k", "n"), ("v",))
    expected = deduplicate(frames[0].unionByName(frames[1]), ("k", "n"), ("v",))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, expected.collect()))
    plan = _plan(merged)
    assert plan.count("Exchange hashpartitioning") == 1  # of the increment, to the buckets' keys
    nothing = merge_bucketed(stored, frames[1].limit(0), ("k", "n"), ("v",))
    assert nothing.count() == stored.count()


def test_students_fixture_is_the_layers_one():
    assert STUDENTS and FILES
