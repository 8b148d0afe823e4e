"""Sinks: JSON lines, CSV, predicate fan-out, and releases that are written once and switched to at once."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import tempfile
from collections.abc import Mapping
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.functions import patterns as P
from threshmill.functions import text as T

SCHEMA_VERSION = "1.0"


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_new(df: DataFrame, path: str, *keys: str) -> int:
    """Append rows whose key is not there yet, so that a run that broke off can be repeated; returns how many."""
    spark = df.sparkSession
    try:
        there = spark.read.parquet(path).select(*keys)
        df = df.join(there, list(keys), "left_anti")
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    df = df.dropDuplicates(list(keys))
    n = df.count()
    if n:
        df.write.mode("append").parquet(path)
    return n


def fan_out(df: DataFrame, parts: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Rows by predicate; every row has to meet exactly one."""
    met = sum((F.coalesce(c, F.lit(False)).cast("int") for c in parts.values()), F.lit(0))
    wrong = df.filter(met != 1).limit(1).count()
    if wrong:
        raise ValueError("a row meets none or several of the predicates")
    return {name: df.filter(c) for name, c in parts.items()}


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """One CSV file with a header, made from Spark's parts in order; the mark tells spreadsheets that it is UTF-8."""
    folder = tempfile.mkdtemp(prefix=".csv-", dir=os.path.dirname(path) or ".")
    try:
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"file://{os.path.abspath(folder)}")
        with open(path, "wb") as out:
            out.write("﻿".encode() if bom else b"")
            for part in sorted(Path(folder).glob("part-*")):
                with part.open("rb") as f:
                    shutil.copyfileobj(f, out)
    finally:
        shutil.rmtree(folder)


def _sha(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def release_chunks(revisions: DataFrame) -> DataFrame:
    text = T.chunk_text("question", "answer")
    return revisions.select(F.format_string("%s@r%d", "kb_id", "revision").alias("chunk_id"), "kb_id", "revision", "status", "question", "answer", text.alias("text"), "supersedes")


def _lines(df: DataFrame, path: Path, *order: str) -> int:
    """Rows as JSON lines in order; streamed by partition, never collected whole."""
    n = 0
    with path.open("w", encoding="utf-8") as out:
        for (row,) in df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).toLocalIterator():
            out.write(row + "\n")
            n += 1
    return n


def current_release(root: str) -> str | None:
    link = Path(root) / "current"
    return os.path.basename(os.readlink(link)) if link.is_symlink() else None


def switch_current(root: str, version: str) -> None:
    """Point ``current`` at a release in one step."""
    fresh = Path(root) / ".current-new"
    fresh.unlink(missing_ok=True)
    fresh.symlink_to(version)
    os.replace(fresh, Path(root) / "current")


def publish(spark: SparkSession, revisions: DataFrame, violations: DataFrame, root: str, version: str, source_commit: str = "") -> dict:
    """Write an immutable release: chunks, changelog, manifest and checksums in a folder of its own, renamed when whole."""
    from threshmill.operators.registry import active, changelog

    if not re.fullmatch(r"\d+\.\d+\.\d+", version):
        raise ValueError("a release needs a version of three numbers")
    before = current_release(root)
    key = lambda v: tuple(map(int, v.split(".")))
    if before and key(version) <= key(before):
        raise ValueError("a release has to be later than the current one")
    target = Path(root) / version
    if target.exists():
        raise FileExistsError(version)
    found = [tuple(r) for r in violations.limit(20).collect()]
    if found:
        raise ValueError(f"gates: {found}")
    chunks = release_chunks(active(revisions))
    if chunks.filter(F.size(P.sensitive(F.col("text"))) > 0).limit(1).count():
        raise ValueError("sensitive text")
    Path(root).mkdir(parents=True, exist_ok=True)
    stage = Path(tempfile.mkdtemp(prefix=".stage-", dir=root))
    try:
        n = _lines(chunks, stage / "chunks.jsonl", "kb_id", "revision")
        old = spark.read.schema(chunks.schema).json(f"file://{(Path(root) / before / 'chunks.jsonl').resolve()}") if before else chunks.filter("false")
        log: dict[str, list[str]] = {"added": [], "revised": [], "removed": []}
        for row in changelog(old, chunks, "kb_id", "text").orderBy("kb_id").toLocalIterator():
            log[row.change].append(row.kb_id)
        (stage / "changelog.json").write_text(json.dumps({"release_version": version, "previous_release": before} | log, ensure_ascii=False, indent=1), encoding="utf-8")
        files = {name: _sha(stage / name) for name in ("chunks.jsonl", "changelog.json")}
        manifest = {"schema_version": SCHEMA_VERSION, "release_version": version, "generated_at": datetime.now(UTC).isoformat(timespec="seconds"), "chunk_count": n, "source_commit": source_commit, "files": files}
        (stage / "manifest.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=1), encoding="utf-8")
        names = ("changelog.json", "chunks.jsonl", "manifest.json")
        (stage / "SHA256SUMS").write_text("".join(f"{_sha(stage / name)}  {name}\n" for name in names))
        os.replace(stage, target)
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    switch_current(root, version)
    return manifest


def validate_release(spark: SparkSession, folder: str) -> list[str]:
    """What is wrong with a release; empty if nothing is."""
    path, wrong = Path(folder), []
    try:
        manifest = json.loads((path / "manifest.json").read_text(encoding="utf-8"))
    except (OSError, ValueError) as bad:
        return [f"manifest: {bad}"]
    if manifest.get("schema_version") != SCHEMA_VERSION:
        wrong.append("schema version")
    sums = dict(reversed(line.split("  ", 1)) for line in (path / "SHA256SUMS").read_text().splitlines() if "  " in line)
    if set(sums) != {"changelog.json", "chunks.jsonl", "manifest.json"}:
        wrong.append("names in SHA256SUMS")
    wrong += [f"checksum of {n}" for n, s in sums.items() if not (path / n).exists() or _sha(path / n) != s]
    wrong += [f"manifest hash of {n}" for n, s in manifest.get("files", {}).items() if not (path / n).exists() or _sha(path / n) != s]
    chunks = spark.read.json(f"file://{path.resolve()}/chunks.jsonl")
    row = chunks.agg(F.count("*").alias("n"), F.countDistinct("chunk_id").alias("ids"), F.sum((F.size(P.sensitive(F.col("text"))) > 0).cast("int")).alias("sensitive")).first()
    if row.n != manifest.get("chunk_count"):
        wrong.append("chunk count")
    if row.ids != row.n:
        wrong.append("chunk ids repeat")
    if row.sensitive:
        wrong.append("sensitive text")
    return wrong


def rollback(spark: SparkSession, root: str, version: str | None = None) -> str:
    """Switch to an earlier release, which is validated first; without a version, the one before the current."""
    now = current_release(root)
    key = lambda v: tuple(map(int, v.split(".")))
    there = sorted((p.name for p in Path(root).iterdir() if p.is_dir() and re.fullmatch(r"\d+\.\d+\.\d+", p.name)), key=key)
    if version is None:
        earlier = [v for v in there if now and key(v) < key(now)]
        if not earlier:
            raise ValueError("no earlier release")
        version = earlier[-1]
    if version not in there:
        raise ValueError(f"no release {version}")
    if wrong := validate_release(spark, f"{root}/{version}"):
        raise ValueError(f"{version}: {wrong}")
    switch_current(root, version)
    return version


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Several tables as folders of one, each with its schema: what a workbook with sheets holds."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def export_registry(revisions: DataFrame, path: str) -> None:
    """Revisions without their texts as JSON lines with sorted keys, in the order of entries and revisions over the part files."""
    row = T.canonical_json(kb_id=F.col("kb_id"), revision=F.col("revision"), status=F.col("status"), supersedes=F.col("supersedes"))
    revisions.orderBy("kb_id", "revision").select(row.alias("value")).write.mode("overwrite").text(path)


def write_embeddings(vectors: DataFrame, path: str) -> None:
    """Once only: an artifact that is there is never replaced."""
    vectors.write.mode("errorifexists").parquet(path)
