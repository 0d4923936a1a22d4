"""Command line: python -m turnloom.plans.cli VERB [ID ...] [--home DIR] [--store DIR] [flags]."""

from __future__ import annotations

import argparse
import json
import time

from ..config import Config, session
from ..sinks.lock import Locked
from ..sources.resolve import open_source
from . import engine

# Other names of the verbs.
ALIASES = {"": "import", "all": "import", "sync": "import", "update": "import", "run": "import", "import-all": "import", "ls": "scan", "list": "scan"}
VERBS = ("scan", "plan", "import", "status", "verify", "audit", "help")


#: Rows that a verb shows of each of its tables; --json shows all.
SHOWN = {"scan": (30,), "status": (20, 20), "audit": (10,)}


def parsed(argv: list[str]) -> tuple[str, argparse.Namespace]:
    """The verb, by its aliases, and the flags; an unknown verb is help."""
    parser = argparse.ArgumentParser(prog="turnloom", add_help=False)
    parser.add_argument("verb", nargs="?", default="")
    parser.add_argument("ids", nargs="*")
    parser.add_argument("--home")
    parser.add_argument("--store")
    parser.add_argument("--source", choices=("auto", "db", "rollout"))
    parser.add_argument("--max", type=int, default=0)
    parser.add_argument("--format-version", type=int, default=0)
    for flag in ("--legacy", "--force", "--dry-run", "--json"):
        parser.add_argument(flag, action="store_true")
    args = parser.parse_args(argv)
    verb = ALIASES.get(args.verb, args.verb)
    return (verb if verb in VERBS else "help"), args


def main(argv: list[str] | None = None) -> int:
    verb, args = parsed(argv if argv is not None else __import__("sys").argv[1:])
    if verb == "help":
        print(__doc__, "\nVerbs:", ", ".join(VERBS))
        return 0
    config = Config.normalized({"source_home": args.home, "store": args.store, "source_mode": args.source, "include_legacy": args.legacy, "max_sessions": args.max, "format_version": args.format_version, "dry_run": args.dry_run})
    spark = session()
    code = 0
    more = []
    if verb == "scan":
        df = open_source(spark, config).sessions.orderBy("updated_at", ascending=False)
    elif verb == "plan":
        df = engine.plan(open_source(spark, config), config.format_version).stats
    elif verb == "status":
        df, more = engine.status(spark, config), [engine.imported(spark, config)]
        print(json.dumps(engine.paths(config), ensure_ascii=False))
    elif verb == "audit":
        df = engine.audit(spark, config)
    elif verb == "verify":
        df = engine.verify(spark, config, args.ids)
        code = int(not df.where("not ok").isEmpty())
    else:
        try:
            run = engine.sync(spark, config, args.force, args.ids)
        except (LookupError, Locked) as error:
            print(json.dumps({"ok": False, "error": str(error)}, ensure_ascii=False) if args.json else error)
            return 1
        engine.write_report(run, f"{config.store}/reports", time.strftime("%Y%m%dT%H%M%S"))
        df = run.totals
        code = int(df.first()["errors"] > 0)
    for rows, most in zip((df, *more), SHOWN.get(verb, (30,)), strict=False):
        if args.json:
            for line in rows.toJSON().toLocalIterator():
                print(json.dumps(json.loads(line), ensure_ascii=False))
        else:
            rows.show(most, truncate=60)
            if (rest := rows.count() - most) > 0:
                print(f"{rest} more")
    return code


if __name__ == "__main__":
    raise SystemExit(main())
