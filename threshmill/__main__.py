"""Command line: init, ingest, review, publish, validate-release and rollback."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from threshmill.operators.analyzers import DeterministicAnalyzer
from threshmill.operators.registry import active, publish_violations
from threshmill.plans.ingest import Registry, bootstrap, ingest, review
from threshmill.sources import json_lines, sinks, text_files


class NoAnalyzer:
    """Issues are taken in without relating them to entries."""

    def analyze(self, issues, entries):
        return DeterministicAnalyzer().analyze(issues, entries).filter("false")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="threshmill", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    start = commands.add_parser("init", help="import a baseline of entries into an empty registry")
    start.add_argument("baseline", help="JSON lines of kb_id, question and answer")
    start.add_argument("--count", type=int)
    start.add_argument("--sha256")
    take = commands.add_parser("ingest", help="take in new and changed chats")
    take.add_argument("folder")
    take.add_argument("--dry-run", action="store_true")
    take.add_argument("--overlap-messages", type=int, default=30)
    take.add_argument("--source-id", help="the registered source of a single file that was renamed and changed")
    take.add_argument("--analyze", action="store_true", help="relate issues to the active entries")
    take.add_argument("--analyzer", choices=["deterministic"], default="deterministic")
    judge = commands.add_parser("review", help="list reviews, or decide one")
    judge.add_argument("--status", default="pending")
    which = judge.add_mutually_exclusive_group()
    which.add_argument("--approve", metavar="REVIEW_ID")
    which.add_argument("--reject", metavar="REVIEW_ID")
    judge.add_argument("--note", default="")
    out = commands.add_parser("publish", help="write an immutable release and switch to it")
    out.add_argument("root")
    out.add_argument("--version", required=True)
    out.add_argument("--survivors", help="JSON lines of kb_id; by default every active entry")
    for own in (start, take, judge, out):
        own.add_argument("--registry", required=True)
    check = commands.add_parser("validate-release")
    check.add_argument("release")
    back = commands.add_parser("rollback")
    back.add_argument("root")
    back.add_argument("--version")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    registry = Registry(spark, args.registry) if hasattr(args, "registry") else None
    if args.command == "init":
        print(bootstrap(registry, json_lines(spark, args.baseline, "kb_id string, question string, answer string"), args.count, args.sha256))
    elif args.command == "ingest":
        files = text_files(spark, args.folder)
        named = None
        if args.source_id:
            paths = [r.path for r in files.select("path").limit(2).collect()]
            if len(paths) != 1:
                raise ValueError("--source-id needs a single file")
            named = {paths[0]: args.source_id}
        single = named is not None or args.folder.endswith(".md")
        found = ingest(registry, files, None, None if args.analyze else NoAnalyzer(), authoritative=not single, dry_run=args.dry_run, overlap=args.overlap_messages, source_ids=named)
        print(json.dumps(found, ensure_ascii=False))
    elif args.command == "review":
        if not (args.approve or args.reject):
            for row in registry.table("reviews").filter(F.col("status") == args.status).orderBy("review_id").toJSON().toLocalIterator():
                print(row)
            return 0
        events = review(registry, {args.approve or args.reject: "approved" if args.approve else "rejected"}, args.note)
        print(json.dumps(events))
        return int(any(e.startswith("refused") for e in events.values()))
    elif args.command == "publish":
        there = registry.tables()
        survivors = json_lines(spark, args.survivors, "kb_id string") if args.survivors else active(there["revisions"]).select("kb_id")
        gates = publish_violations(there["revisions"], there["reviews"], survivors)
        print(json.dumps(sinks.publish(spark, there["revisions"], gates, args.root, args.version), ensure_ascii=False))
    elif args.command == "validate-release":
        wrong = sinks.validate_release(spark, args.release)
        print("\n".join(wrong) or "valid")
        return bool(wrong)
    else:
        print(sinks.rollback(spark, args.root, args.version))
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return run(SparkSession.builder.appName("threshmill").getOrCreate(), args)
    except (ValueError, FileExistsError) as refused:
        print(refused, file=sys.stderr)
        return 2


if __name__ == "__main__":
    raise SystemExit(main())
