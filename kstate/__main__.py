"""Command line: one sub-command a stage. Results are printed as one line of JSON; a broken rule ends with status 2."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from kstate import stages
from kstate.functions.canon import KStateError, canonical_json
from kstate.operators import synthesize as S
from kstate.sources import files

IDENTITY = ("source_id", "snapshot_id", "synthesis_run_id", "resolution_run_id", "plan_run_id")
#: how many parts of the identity each stage takes
TAKES = {"snapshot": 1, "classify": 2, "extract": 2, "normalize": 2, "synthesize": 2, "resolve": 3, "plan": 4, "compile": 5}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kstate", description=__doc__)
    p.add_argument("--root", default=".kstate", help="folder of all stages, shared by all nodes")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("acquire", help="bring a source under the root")
    a.add_argument("source_id")
    a.add_argument("locator")
    a.add_argument("--provider", choices=files.PROVIDERS, default="auto")
    a.add_argument("--ref")
    a.add_argument("--replace", action="store_true")
    a.add_argument("--max-http-bytes", type=int, default=files.MAX_BYTES)
    for name, n in TAKES.items():
        s = sub.add_parser(name, help=f"run the {name} stage")
        for part in IDENTITY[:n]:
            s.add_argument(part)
        if name == "synthesize":
            s.add_argument("--provider", choices=("offline", "openai"), default="offline")
            s.add_argument("--model", default="offline")
            s.add_argument("--max-input-chars", type=int, default=stages.Limits.max_input_chars)
            s.add_argument("--max-batch-units", type=int, default=stages.Limits.max_batch_units)
            s.add_argument("--max-output-tokens", type=int, default=stages.Limits.max_output_tokens)
        elif name == "resolve":
            s.add_argument("--catalog")
            s.add_argument("--similarity-threshold", type=float, default=stages.Limits.threshold)
            s.add_argument("--shortlist-limit", type=int, default=stages.Limits.shortlist)
        elif name == "plan":
            for f in ("claims", "relations", "decisions"):
                s.add_argument(f"--{f}")
    return p


def run(args: argparse.Namespace, spark: SparkSession | None = None) -> str:
    if args.command == "acquire":
        got = files.acquire(args.source_id, args.locator, Path(args.root) / "acquired", args.provider, args.ref, args.replace, args.max_http_bytes)
        return canonical_json({k: got[k] for k in ("source_id", "provider", "artifact")})
    store = stages.Store(spark or SparkSession.builder.appName("kstate").getOrCreate(), args.root)
    who = [getattr(args, part) for part in IDENTITY[: TAKES[args.command]]]
    if args.command == "synthesize":
        limits = stages.Limits(args.max_input_chars, args.max_batch_units, args.max_output_tokens)
        done = stages.synthesize(store, *who, S.OfflineProvider() if args.provider == "offline" else S.ResponsesProvider(), args.model, limits)
    elif args.command == "resolve":
        done = stages.resolve(store, *who, args.catalog, stages.Limits(threshold=args.similarity_threshold, shortlist=args.shortlist_limit))
    elif args.command == "plan":
        done = stages.plan(store, *who, args.claims, args.relations, args.decisions)
    else:
        done = {"snapshot": stages.snapshot, "classify": stages.classify, "extract": stages.extract, "normalize": stages.normalize, "compile": stages.compile_state}[args.command](store, *who)
    return stages.summary(done)


def main(argv: list[str] | None = None) -> int:
    try:
        print(run(parser().parse_args(argv)))
    except KStateError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
