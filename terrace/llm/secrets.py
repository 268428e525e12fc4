r"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a document is content-addressed: its blob is the SHA-256 of its text.
The ledger is a table of scanned blobs, with the rule versions that were run and what
they found. A scan looks only at pairs of blob and rule version that the ledger does not
have, reads each new blob once however many documents hold it, appends to the ledger, and
joins the findings back to all documents.

Positions come from the text between the matches: ``split`` gives the gaps and
``regexp_extract_all`` the matches, so a match starts after the lengths of all gaps and
matches before it. The running sums are taken over rows of matches, so a text with very
many of them costs no more a match than one with few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.sources.scratch import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if their ``group`` has at least ``least`` characters.

    Matches are leftmost and do not overlap. A change of the pattern needs a new version.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # Runs are maximal, so asking for 24 in the pattern finds the same ones.
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)

LEDGER = (
    "blob string, rules array<string>,"
    " findings array<struct<rule: string, start: bigint, end: bigint>>"
)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty where none was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def versions(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``blob`` of every row; a null text is the empty one."""
    return docs.select("doc_id", _blob().alias("blob"))


def _blob() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def _matches(rule: Rule) -> Column:
    """Array of (rule, position in the text's order, gap before, lengths), unfiltered."""
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    rows = F.transform(
        F.arrays_zip(whole.alias("w"), value.alias("v"), F.split(text, rule.pattern).alias("g")),
        lambda m, i: F.struct(
            F.lit(rule.name).alias("rule"),
            i.alias("place"),
            F.char_length(m["g"]).cast("bigint").alias("gap"),
            F.char_length(m["w"]).cast("bigint").alias("size"),
            (F.char_length(m["v"]) >= rule.least).alias("counts"),
        ),
    )
    wanted = F.array_contains("pending", rule.name) & text.rlike(rule.pattern)
    # The last gap follows the last match and has none of its own.
    return F.when(wanted, F.filter(rows, lambda m: m["size"].isNotNull()))


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob``, ``rule``, ``start``, ``end`` (code points, end exclusive) of every finding.

    ``blobs`` has ``blob``, ``text`` and ``pending``, the names of the rules to run.
    """
    none = F.array().cast(
        "array<struct<rule: string, place: int, gap: bigint, size: bigint, counts: boolean>>"
    )
    each = F.concat(*[F.coalesce(_matches(rule), none) for rule in rules])
    rows = blobs.select("blob", F.explode(each).alias("m")).select("blob", "m.*")
    # The same blob may come twice, from documents with the same id: they agree in all.
    rows = rows.dropDuplicates(["blob", "rule", "place"])
    before = Window.partitionBy("blob", "rule").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return (
        rows.withColumn("end", end)
        .filter("counts")
        .select("blob", "rule", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def update_ledger(docs: DataFrame, known: DataFrame, path: str, rules: Sequence[Rule]) -> int:
    """Scan what the ledger lacks, append it, and return the number of blobs scanned.

    ``known`` are the versions of ``docs``. Each pending blob is read from one document,
    the one with the smallest id; the join on blob and id keeps the copies of one text
    apart, so that no task gets them all.
    """
    ledger = read_ledger(docs.sparkSession, path)
    seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
        F.collect_set("rule").alias("seen")
    )
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    pending = known.groupBy("blob").agg(F.min("doc_id").alias("of")).join(seen, "blob", "left")
    none = F.array().cast("array<string>")
    pending = pending.select(
        "blob", "of", F.array_except(wanted, F.coalesce("seen", none)).alias("pending")
    ).filter(F.size("pending") > 0)
    pending = stored(pending, "pending")
    scanned = pending.count()
    if not scanned:
        return 0
    chosen = pending.withColumnRenamed("blob", "of_blob").hint("shuffle_hash")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _blob().alias("blob"))
    same = (F.col("blob") == F.col("of_blob")) & F.col("doc_id").eqNullSafe(F.col("of"))
    found = scan_blobs(texts.join(chosen, same).select("blob", "text", "pending"), rules)
    per_blob = found.groupBy("blob").agg(
        F.collect_list(F.struct("rule", "start", "end")).alias("findings")
    )
    nothing = F.array().cast("array<struct<rule: string, start: bigint, end: bigint>>")
    (
        pending.join(per_blob, "blob", "left")
        .select(
            "blob", F.col("pending").alias("rules"), F.coalesce("findings", nothing).alias("findings")
        )
        .write.mode("append")
        .parquet(path)
    )
    return scanned


HISTORY = "doc_id bigint, blob string, seen timestamp"


def read_history(spark: SparkSession, path: str, doc_id: str = "bigint") -> DataFrame:
    """Every path (``doc_id``), each content it ever had (``blob``), and when that was first seen."""
    schema = HISTORY.replace("bigint", doc_id, 1)
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.groupBy("doc_id", "blob").agg(F.min("seen").alias("seen"))


def scan_history(
    docs: DataFrame,
    ledger_path: str,
    history_path: str,
    seen: datetime | None = None,
    rules: Sequence[Rule] = RULES,
) -> tuple[int, int]:
    """Add the present contents to the history and scan those the ledger lacks.

    Returns how many versions and how many blobs were new. Only pairs of blob and rule
    version that were never scanned are; a second call on the same documents reads their
    hashes and writes nothing. The ledger is written before the history, so after a failure
    in between the versions are still new, and their blobs are not scanned again.
    """
    spark, when = docs.sparkSession, seen or datetime.now(timezone.utc)
    known = stored(versions(docs).distinct(), "versions")
    scanned = update_ledger(docs, known, ledger_path, rules)
    before = read_history(spark, history_path, dict(known.dtypes)["doc_id"])
    same = known["doc_id"].eqNullSafe(before["doc_id"]) & (known["blob"] == before["blob"])
    new = stored(known.join(before, same, "left_anti"), "new_versions")
    added = new.count()
    if added:
        new.withColumn("seen", F.lit(when).cast("timestamp")).write.mode("append").parquet(history_path)
    return added, scanned


def findings_by_path(
    docs: DataFrame, ledger_path: str, history_path: str, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Findings of every version a path ever had: ``doc_id``, ``blob``, ``seen``, ``current``
    (whether it is the content now), ``kind``, ``start`` and ``end``.

    A secret that a later version took out is still found, under the version that had it. A
    blob's findings are joined to all paths that had it; a blob of very many paths is a
    skewed key, which the adaptive join splits.
    """
    spark = docs.sparkSession
    names = [r.name for r in rules]
    found = (
        read_ledger(spark, ledger_path).select("blob", F.explode("findings").alias("f"))
        .select("blob", "f.*").filter(F.col("rule").isin(names)).distinct()
    )
    history = read_history(spark, history_path, docs.schema["doc_id"].dataType.simpleString())
    now = versions(docs).distinct().select(F.col("doc_id").alias("id_now"), F.col("blob").alias("blob_now"))
    same = F.col("doc_id").eqNullSafe(F.col("id_now")) & (F.col("blob") == F.col("blob_now"))
    return history.join(found, "blob").join(now, same, "left").select(
        "doc_id", "blob", "seen", F.col("blob_now").isNotNull().alias("current"),
        F.substring_index("rule", "@", 1).alias("kind"), "start", "end",
    )


def find_secrets(
    docs: DataFrame, ledger_path: str | None = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``doc_id`` and ``findings``, an array of (start, rank, end, kind), for every row.

    Findings are in order of start, then of the rules (``rank``), and hold what the ledger
    has for these rule versions. Without a path the ledger is a new one in the shared
    scratch folder. Null and empty texts have no findings; repeated rows and ids each have
    their row; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    path = ledger_path or scratch_path(spark, "ledger")
    known = stored(versions(docs), "versions")
    update_ledger(docs, known, path, rules)
    rank = F.element_at(
        F.create_map(*[F.lit(x) for n, r in enumerate(rules) for x in (r.name, n)]), F.col("rule")
    )
    found = (
        read_ledger(spark, path)
        .select("blob", F.explode("findings").alias("f"))
        .select("blob", "f.*")
        .withColumn("rank", rank)
        .filter(F.col("rank").isNotNull())
        .withColumn("kind", F.substring_index("rule", "@", 1))
        .groupBy("blob")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "rank", "end", "kind"))).alias("findings")
        )
    )
    nothing = F.array().cast("array<struct<start: bigint, rank: int, end: bigint, kind: string>>")
    return known.join(found, "blob", "left").select(
        "doc_id", F.coalesce("findings", nothing).alias("findings")
    )


def spans_text(findings: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            findings,
            lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")),
        ),
        ",",
    )
