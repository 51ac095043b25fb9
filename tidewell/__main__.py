"""Command line for the two workflows.

    python -m tidewell train-tutors  --csv train.csv --model M [--label-mode rank]
    python -m tidewell seed-history  --csv points.csv --table H [--sep ';']
    python -m tidewell serve-tutors  --stream DIR --history H --out P --model M --checkpoint C
                                     [--via-log L] [--trigger '30 seconds']
    python -m tidewell train-houses  --csv train.csv --model M
    python -m tidewell serve-houses  --stream DIR --out P --model M --checkpoint C
                                     [--out-format FMT --out-option k=v ...]
    python -m tidewell show          --table P --kind tutors|houses [--rows 20]

The session comes from ``spark-submit`` / the environment (``getOrCreate``);
``--master`` is only for local runs. With a processing-time trigger the serve
commands run until stopped; the default trigger processes what is there and
exits.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _store_args(p: argparse.ArgumentParser, role: str) -> None:
    p.add_argument(f"--{role}-format", default=None,
                   help=f"connector format of a store holding the {role} table")
    p.add_argument(f"--{role}-option", action="append", default=[], metavar="KEY=VALUE")


def _store(args, role: str):
    fmt = getattr(args, f"{role}_format")
    if not fmt:
        return None
    opts = dict(o.split("=", 1) for o in getattr(args, f"{role}_option"))
    return fmt, opts


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewell")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train-tutors")
    t.add_argument("--csv", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--label-mode", default="rank", choices=["rank", "value"])
    t.add_argument("--sep", default=",")

    s = sub.add_parser("seed-history")
    s.add_argument("--csv", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--sep", default=";")

    v = sub.add_parser("serve-tutors")
    for a in ("--stream", "--history", "--out", "--model", "--checkpoint"):
        v.add_argument(a, required=True)
    v.add_argument("--via-log", default=None)
    v.add_argument("--sep", default=";")
    v.add_argument("--trigger", default="available_now")
    v.add_argument("--max-files", type=int, default=None)
    v.add_argument("--null-safe", action="store_true", help="keep negative stored values")
    _store_args(v, "history")
    _store_args(v, "out")

    h = sub.add_parser("train-houses")
    h.add_argument("--csv", required=True)
    h.add_argument("--model", required=True)
    h.add_argument("--label-mode", default="rank", choices=["rank", "value"])

    w = sub.add_parser("serve-houses")
    for a in ("--stream", "--out", "--model", "--checkpoint"):
        w.add_argument(a, required=True)
    w.add_argument("--trigger", default="available_now")
    w.add_argument("--max-files", type=int, default=None)
    _store_args(w, "out")

    o = sub.add_parser("show")
    o.add_argument("--table", required=True)
    o.add_argument("--kind", required=True, choices=["tutors", "houses"])
    o.add_argument("--rows", type=int, default=20)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName("tidewell")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()

    from .plans import houses, tutors
    from .streaming.runner import await_done

    def finish(queries):
        for q in queries:
            if args.trigger == "available_now":
                await_done(q)
            else:
                q.awaitTermination()

    if args.cmd == "train-tutors":
        _, report = tutors.train(spark, args.csv, args.model, label_mode=args.label_mode,
                                 sep=args.sep)
        report.show(truncate=False)
    elif args.cmd == "seed-history":
        tutors.seed_history(spark, args.csv, args.table, sep=args.sep)
    elif args.cmd == "serve-tutors":
        finish(tutors.serve(spark, args.stream, args.history, args.out, args.model,
                            args.checkpoint, sep=args.sep, via_log=args.via_log,
                            trigger=args.trigger, max_files_per_trigger=args.max_files,
                            absent=None if args.null_safe else 0.0,
                            history_store=_store(args, "history"),
                            out_store=_store(args, "out")))
    elif args.cmd == "train-houses":
        _, report = houses.train(spark, args.csv, args.model, label_mode=args.label_mode)
        report.show(truncate=False)
    elif args.cmd == "serve-houses":
        finish([houses.serve(spark, args.stream, args.out, args.model, args.checkpoint,
                             trigger=args.trigger, max_files_per_trigger=args.max_files,
                             out_store=_store(args, "out"))])
    elif args.cmd == "show":
        mod = tutors if args.kind == "tutors" else houses
        mod.predictions(spark, args.table).orderBy("id").show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
