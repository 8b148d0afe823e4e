"""The incremental ingest end to end: files to messages, changes, issues, retractions and reviews, as one versioned step."""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T
from threshmill.operators import incremental, messages, segments
from threshmill.operators.analyzers import Analyzer, DeterministicAnalyzer
from threshmill.operators.registry import active, decide, review_rows

TABLES = {
    "sources": "source string, content_sha256 string, message_watermark long, last_message_time string, status string",
    "messages": "source string, idx int, line_number int, timestamp string, speaker string, content string, message_sha256 string, chain string",
    "issues": "issue_id string, source string, start_index int, end_index int, question string, answer string, status string",
    "reviews": "review_id string, issue_id string, relation string, target_kb_id string, proposed_question string, proposed_answer string, confidence double, status string",
    "revisions": "kb_id string, revision int, status string, question string, answer string, supersedes string",
    "evidence": "kb_id string, revision int, issue_id string, source string, status string",
    "audit": "event string, entity string, detail string",
}

#: Tables that are kept in buckets, by the hash of a column, and how many buckets a new registry has.
BUCKETED, BUCKETS = {"messages": "source", "issues": "source", "evidence": "source", "reviews": "issue_id"}, 64


class ConcurrentCommit(RuntimeError):
    """Another committer has written the version that this one was about to write."""


class Registry:
    """Tables as folders, and a version as one small file that names the folders of each table.

    A step reads the version once and commits the next one: tables that it does not give stay as they were. Large
    tables lie in buckets by the hash of their key, each in one folder; a step that says which keys it touched rewrites
    their buckets alone, each as a whole, so no bucket gathers small files. The file of a version is created only if it
    is not there, so of two committers one fails and nothing of it is seen.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets`` holds for a new registry; one that is there keeps its own number."""
        self.spark, self.root, self.new_buckets = spark, root.rstrip("/"), buckets

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("_versions").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        files, folder = self._files(), self._path("_versions")
        if not files.exists(folder):
            return 0
        return max((int(f.getPath().getName().removesuffix(".json")) for f in files.listStatus(folder) if f.getPath().getName().endswith(".json")), default=0)

    def folders(self, version: int) -> dict:
        """The folder of each table of a version, of bucketed ones that of each bucket that has rows; and the number of ``buckets``."""
        if not version:
            return {"buckets": self.new_buckets}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.root}/_versions/{version:08d}.json").collect()))

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*(f"{self.root}/{f}" for f in folders))

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables as of one version, the last if none is named."""
        there = self.folders(self.version() if version is None else version)
        listed = lambda own: [own] if isinstance(own, str) else list(own.values())
        return {name: self._read(name, listed(there.get(name, {}))) for name in TABLES}

    def table(self, name: str) -> DataFrame:
        return self.tables()[name]

    def _buckets(self, keys: DataFrame, key: str, n: int) -> list[int]:
        return sorted(r[0] for r in keys.select(F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).distinct().collect())  # at most n

    def part(self, name: str, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the buckets of a table in which the keys lie; other buckets are not read."""
        there = self.folders(self.version() if version is None else version)
        own = there.get(name, {})
        return self._read(name, [own[str(b)] for b in self._buckets(keys, BUCKETED[name], there["buckets"]) if str(b) in own])

    def commit(self, after: int | None = None, touched: dict[str, DataFrame] | None = None, **tables: DataFrame) -> int:
        """The version that follows ``after``, the last if none is named; readers see the old version or the new one, never a mixture.

        ``touched`` holds, by table, the keys whose rows are not as before; rows in buckets of others are not written,
        and need not be given. A bucketed table without an entry is written whole.
        """
        before = self.version() if after is None else after
        there, fresh = self.folders(before), uuid.uuid4().hex[:12]
        n = there["buckets"]
        for name, df in tables.items():
            folder = f"data/{before + 1:08d}-{fresh}/{name}"
            rows = df.select(*self.spark.createDataFrame([], TABLES[name]).columns)
            if name not in BUCKETED:
                there[name] = folder
                rows.write.parquet(f"{self.root}/{folder}")
                continue
            key = BUCKETED[name]
            wanted = self._buckets(touched[name], key, n) if name in (touched or {}) else list(range(n))
            kept = {b: f for b, f in there.get(name, {}).items() if int(b) not in wanted}
            if wanted:
                placed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).filter(F.col("bucket").isin(wanted))
                # by ranges, so that a bucket with a large source is written by many tasks
                placed.repartitionByRange("bucket", key, *[c for c in ("idx", "start_index", "review_id", "kb_id") if c in rows.columns]).write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
                found = [f.getPath().getName() for f in self._files().listStatus(self._path(folder))]
                kept |= {f.removeprefix("bucket="): f"{folder}/{f}" for f in found if f.startswith("bucket=")}
            there[name] = kept
        try:
            out = self._files().create(self._path(f"_versions/{before + 1:08d}.json"), False)
        except Py4JJavaError as refused:
            if "FileAlreadyExists" not in str(refused.java_exception):
                raise
            raise ConcurrentCommit(f"version {before + 1} is there already") from None
        out.write(bytearray(json.dumps(there).encode()))
        out.close()
        return before + 1


def bootstrap(registry: Registry, entries: DataFrame, count: int | None = None, sha256: str | None = None) -> int:
    """Import entries (kb_id, question, answer) as first revisions into an empty registry; returns how many.

    With a count or the SHA-256 of their canonical JSON lines by kb_id, a baseline that differs is refused.
    """
    if registry.version() and registry.table("revisions").limit(1).count():
        return 0
    line = T.canonical_json(kb_id=F.col("kb_id"), question=F.col("question"), answer=F.col("answer"))
    n, repeated = entries.agg(F.count("*"), F.count("*") - F.countDistinct("kb_id")).first()
    if repeated or count is not None and n != count:
        raise ValueError(f"the baseline has {n} entries, {repeated} of them repeated, for {count}")
    if sha256 is not None:
        digest = hashlib.sha256()
        for (own,) in entries.orderBy("kb_id").select(line).toLocalIterator():
            digest.update(own.encode() + b"\n")
        if digest.hexdigest() != sha256:
            raise ValueError("the baseline's SHA-256 differs")
    first = entries.select("kb_id", F.lit(1).alias("revision"), F.lit("active").alias("status"), "question", "answer", F.lit(None).cast("string").alias("supersedes"))
    audit = registry.spark.createDataFrame([("baseline_imported", f"{n} entries", json.dumps({"count": n, "sha256": sha256}))], TABLES["audit"])
    registry.commit(revisions=first, audit=registry.table("audit").unionByName(audit))
    return n


def prune(registry: Registry, table: str, key: str, gone: DataFrame) -> int:
    """A new version without the rows whose key is in ``gone``; the version before it remains as a copy. Returns how many went."""
    now = registry.version()
    rows = registry.tables(now)[table]
    lost = rows.join(gone.select(key), key, "left_semi").count()
    if lost:
        registry.commit(now, **{table: rows.join(gone.select(key), key, "left_anti")})
    return lost


def review(registry: Registry, decisions: dict[str, str], note: str = "") -> dict[str, str]:
    """Decide reviews by identifier, ``approved`` or ``rejected``; returns the event of each. Refused ones change nothing."""
    now = registry.version()
    there = registry.tables(now)
    rows = registry.spark.createDataFrame([(i, d, note) for i, d in decisions.items()], "review_id string, decision string, note string")
    after = decide(there["reviews"], there["issues"], there["revisions"], rows)
    events = {r.entity: r.event for r in after["audit"].collect()}  # as many as decisions
    if any(not e.startswith("refused") for e in events.values()):
        registry.commit(now, **after | {"evidence": there["evidence"].unionByName(after["evidence"]), "audit": there["audit"].unionByName(after["audit"])})
    return events


def ingest(registry: Registry, files: DataFrame, entries: DataFrame | None = None, analyzer: Analyzer | None = None, authoritative: bool = True, dry_run: bool = False, overlap: int = incremental.OVERLAP, source_ids: dict[str, str] | None = None) -> dict[str, int]:
    """Take in files (path, text); returns how many files changed in which way and how many issues related in which way.

    Issues are related to ``entries``, by default to the registry's active revisions. With ``authoritative``, registered
    sources that are not among the files count as deleted. ``source_ids`` names the registered source of files by path,
    for files that were renamed and changed. A dry run writes nothing. Which sources differ is known by the hashes kept
    with the sources; messages are read and written only in the buckets of those, and an unchanged source stays as stored.
    """
    at = registry.version()
    there = registry.tables(at)
    if entries is None:
        entries = active(there["revisions"]).select("kb_id", "question", "answer")
    if source_ids:
        named = registry.spark.createDataFrame(list(source_ids.items()), "path string, named string")
        files = files.join(F.broadcast(named), "path", "left").withColumn("path", F.coalesce("named", "path")).drop("named")
    parsed = messages.parse_messages(files)
    # The place in a source is the index; links are kept with the messages, so the next step compares them as they are.
    new = incremental.chained(parsed.withColumn("idx", F.col("line_number"))).withColumn("idx", F.col("place"))
    sources, issues, reviews, revisions, evidence = (there[n] for n in ("sources", "issues", "reviews", "revisions", "evidence"))
    was, now = sources.select("source", F.col("message_watermark").alias("n"), "content_sha256"), incremental.source_heads(new).checkpoint()
    heads = now.join(was.select("source", F.col("content_sha256").alias("was_sha")), "source")
    old = registry.part("messages", heads.filter("was_sha <> content_sha256"), at).withColumn("place", F.col("idx"))
    changes = incremental.affected_start(incremental.classify(old, new, was, now), issues, overlap).checkpoint()
    gone = incremental.deleted(was, now, changes) if authoritative else was.select("source").filter("false")
    moved = changes.filter("change = 'moved'").select(F.col("moved_from").alias("source"), F.col("source").alias("to"))
    issues = issues.join(moved, "source", "left").withColumn("source", F.coalesce("to", "source")).drop("to")
    kept = incremental.retract(issues, changes.filter("change in ('appended', 'modified')"), gone)
    starts = changes.filter("change in ('new', 'appended', 'modified')").select("source", F.coalesce("affected_start", F.lit(0)).alias("from"))
    touched = new.join(starts, "source").filter("idx >= from").withColumn("is_question", P.is_question(F.col("content"), "compact"))
    found = segments.fixed_blocks(touched, "source", "idx").drop("block")
    shift = found.join(starts, "source").withColumn("start_index", (F.col("start_index") + F.col("from")).cast("int")).withColumn("end_index", (F.col("end_index") + F.col("from")).cast("int")).drop("from")
    fresh = shift.withColumn("status", F.lit("active")).checkpoint()
    all_issues = incremental.upsert(kept, fresh.select(*kept.columns), "issue_id").checkpoint()
    analyzed = (analyzer or DeterministicAnalyzer()).analyze(fresh, entries).checkpoint()
    links = incremental.invalidated_links(evidence, all_issues)
    pending = review_rows(analyzed).unionByName(incremental.revalidations(evidence, links, revisions))
    all_reviews = incremental.insert_ignore(incremental.obsolete_reviews(reviews, all_issues), pending, "review_id")
    counts = {f"files_{r.change}": r["count"] for r in changes.groupBy("change").count().collect()}
    counts |= {f"knowledge_{r.relation}": r["count"] for r in analyzed.groupBy("relation").count().collect()}
    if n := gone.count():
        counts["files_deleted"] = n
    if not dry_run:
        moved_away = moved.select("source")
        touched = changes.filter("change <> 'unchanged'").select("source").unionByName(moved_away).unionByName(gone).distinct().checkpoint()
        stays = sources.join(now.select("source"), "source", "left_anti").join(moved_away, "source", "left_anti").filter(F.lit(not authoritative))
        still = registry.part("messages", touched, at).join(stays.select("source"), "source", "left_semi")
        all_messages = new.select(*still.columns).unionByName(still)
        changed_links = links.join(evidence, links.columns, "left_anti")
        changed_reviews = all_reviews.join(reviews, ["review_id", "status"], "left_anti")
        keys = {"messages": touched, "issues": touched, "evidence": changed_links, "reviews": changed_reviews}
        marks = incremental.watermarks(new, gone).unionByName(stays)
        registry.commit(at, keys, messages=all_messages, issues=all_issues, reviews=all_reviews, evidence=links, sources=marks)
    return counts
