"""Command line: run, preview, validate-config, version."""

from __future__ import annotations

import argparse
import json
import sys

from . import __version__
from .config import ConfigError, Settings, load_settings


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("sievework").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="sievework", description="Turn web addresses and pages into a training corpus.")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="curate a URL list")
    run.add_argument("--out", "-o", required=True)
    run.add_argument("--config", "-c")
    run.add_argument("--urls", help="file of URLs, one a line")
    run.add_argument("--text", help="URLs, one a line")
    run.add_argument("--pages", help="table of pages (page_id, url, html) to read instead of the web")
    run.add_argument("--suffix-list", help="file of public suffixes, in the form of the public suffix list")
    run.add_argument("--max-urls", type=int)
    run.add_argument("--format", "-f", choices=("parquet", "jsonl"), help="overrides output.format")
    run.add_argument("--dry-run", "--dry_run", action="store_true")
    run.add_argument("--no-save-input-urls", action="store_true")
    run.add_argument("--json", action="store_true", help="print the summary as JSON")
    preview = commands.add_parser("preview", help="first rows of a run's first shard")
    preview.add_argument("out")
    preview.add_argument("--limit", type=int, default=50)
    preview.add_argument("--export", help="write the rows to this JSON lines file as well")
    preview.add_argument("--record", type=int, help="show the whole record at this place instead")
    commands.add_parser("validate-config", help="check a configuration file").add_argument("config")
    commands.add_parser("version")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "version":
        print(__version__)
        return 0
    if args.command == "validate-config":
        try:
            load_settings(args.config)
        except (ConfigError, FileNotFoundError) as e:
            print(e, file=sys.stderr)
            return 1
        print("valid")
        return 0
    spark = _session()
    if args.command == "preview":
        from .plans.curate import json_lines, preview_rows
        from .sources.shards import first_shard, write_text

        rows = first_shard(spark, args.out)
        shown = [] if rows is None else rows.offset(args.record).limit(1).collect() if args.record is not None else preview_rows(rows, args.limit).collect()
        lines = list(json_lines(shown))
        print("".join(lines), end="")
        if args.export:
            write_text(spark, args.export, lines)
        return 0
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        # The output's store is shared by the whole cluster.
        spark.sparkContext.setCheckpointDir(f"{args.out.rstrip('/')}/_tables")
    from .functions.urls import SUFFIXES, read_suffixes
    from .plans.curate import json_safe, run
    from .sources.http import pages_table
    from .sources.shards import write_text
    from .sources.urls import read_urls

    if args.max_urls is not None and args.max_urls < 1:
        print("--max-urls must be 1 or more", file=sys.stderr)
        return 2
    try:
        settings = load_settings(args.config) if args.config else Settings()
        pages = spark.read.parquet(args.pages) if args.pages else None
        urls = pages.selectExpr("page_id as input_pos", "url as raw_url") if pages is not None and not (args.text or args.urls) else read_urls(spark, args.text, args.urls)
    except (ConfigError, FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    if args.max_urls:
        urls = urls.orderBy("input_pos").limit(args.max_urls)
    if not args.no_save_input_urls and not args.pages:
        write_text(spark, f"{args.out.rstrip('/')}/input_urls.txt", (f"{r[0]}\n" for r in urls.orderBy("input_pos").select("raw_url").toLocalIterator()))
    if args.dry_run:
        print("configuration and URLs are valid")
        return 0
    scan = (lambda wanted: pages_table(pages, wanted)) if pages is not None else None
    suffixes = read_suffixes(r[0] for r in spark.read.text(args.suffix_list).toLocalIterator()) if args.suffix_list else SUFFIXES
    summary = json_safe(run(urls, settings, args.out, args.format, scan, suffixes=suffixes))
    print(json.dumps(summary, ensure_ascii=False) if args.json else f"kept={summary['kept']} dropped={summary['dropped']} total={summary['total']} shards={summary['shards_written']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
