"""Command line for spark-submit or ``python -m augur``.

  build   --forecasts F --demographics D --tags T --out MODEL
  gold    --model MODEL --out GOLD [--full]         (refreshed from the loads since)
  append  --model MODEL [--forecasts F] [--demographics D] [--tags T]
  stream  --source DIR --model MODEL --checkpoint DIR
  export  --gold GOLD --table NAME --out PATH        (JSON records)
  vacuum  --model DIR [--keep N]                     (remove old versions' files)

``--master`` is only for local runs; under spark-submit the cluster manager
provides it. Row counts are printed as JSON.
"""

from __future__ import annotations

import argparse
import json

from augur.session import build_session, clear_scratch


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="augur")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="raw CSV extracts -> star schema (full refresh)")
    b.add_argument("--forecasts", required=True)
    b.add_argument("--demographics", required=True)
    b.add_argument("--tags", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--lenient", action="store_true", help="quarantine rows that don't parse or cast")
    g = sub.add_parser("gold", help="model -> mergeable state, gold marts and roll-ups")
    g.add_argument("--model", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--full", action="store_true", help="compute everything anew")
    a = sub.add_parser("append", help="merge new extracts into the model")
    a.add_argument("--forecasts", default=None)
    a.add_argument("--demographics", default=None, help="register or update forecasters")
    a.add_argument("--tags", default=None)
    a.add_argument("--lenient", action="store_true", help="quarantine rows that don't parse or cast")
    a.add_argument("--model", required=True)
    s = sub.add_parser("stream", help="load every extract landing in a folder")
    s.add_argument("--source", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--checkpoint", required=True)
    e = sub.add_parser("export", help="write a gold table as JSON records")
    e.add_argument("--gold", required=True)
    e.add_argument("--table", required=True)
    e.add_argument("--out", required=True)
    v = sub.add_parser("vacuum", help="remove files that the newest versions don't use")
    v.add_argument("--model", required=True, help="a model or gold folder")
    v.add_argument("--keep", type=int, default=1)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session("augur-" + args.cmd, args.master)
    if args.cmd == "build":
        from augur.plans.model import build

        out = build(spark, {
            "raw_forecasts_export": args.forecasts,
            "raw_forecaster_demographics": args.demographics,
            "raw_question_tags": args.tags,
        }, args.out, lenient=args.lenient)
    elif args.cmd == "gold":
        from augur.plans.gold import build_gold, refresh_gold

        out = (build_gold if args.full else refresh_gold)(spark, args.model, args.out)
    elif args.cmd == "append":
        from augur.sources.csv import scan_csv_strings
        from augur.sources.schemas import RAW_DEMOGRAPHICS, RAW_FORECASTS, RAW_QUESTION_TAGS
        from augur.streaming.incremental import load

        given = ((args.forecasts, RAW_FORECASTS), (args.demographics, RAW_DEMOGRAPHICS), (args.tags, RAW_QUESTION_TAGS))
        out = load(spark, args.model, *[scan_csv_strings(spark, p, schema, lenient=args.lenient) if p else None for p, schema in given], lenient=args.lenient)
    elif args.cmd == "stream":
        from augur.streaming.incremental import stream_forecasts

        q = stream_forecasts(spark, args.source, args.model, args.checkpoint)
        q.awaitTermination()
        out = {"batches": len(q.recentProgress)}
    elif args.cmd == "vacuum":
        from augur.sources.store import Store

        out = {"removed": Store(spark, args.model).vacuum(args.keep)}
    else:
        from augur.plans.gold import gold_table
        from augur.sources.sinks import export_json

        export_json(gold_table(spark, args.gold, args.table), args.out)
        out = {"exported": args.table}
    print(json.dumps(out, sort_keys=True))
    return out


if __name__ == "__main__":
    main()
    clear_scratch(build_session())  # the process ends: nothing reads the intermediate tables any more
