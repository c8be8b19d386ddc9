"""Command line: one command for each pipeline, with files in and out, and ``query`` for a registered query.

Outputs are folders of CSV files below ``--output-dir``, named after their content.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph import catalog
from corpgraph.operators import ops
from corpgraph.plans import brands, bundles, contacts, pac, people
from corpgraph.schemas import ACTIVITY, CROSSWALK, FILINGS, RECEIPTS, find_column, require_columns, strings
from corpgraph.sources import connectors, io
from corpgraph.streaming import ingest


@dataclass(frozen=True)
class Thresholds:
    """Scores from which brands merge and are suggested, and from which committees match and are reviewed."""

    merge: float = 90
    suggest: float = 80
    high: float = 95
    review: float = 90


COMMANDS: dict[str, tuple[Callable, list[tuple[str, dict]]]] = {}
_NEEDED = {"required": True}


def command(*options: tuple[str, dict]):
    def register(f):
        COMMANDS[f.__name__.replace("_", "-")] = (f, list(options))
        return f

    return register


def _save(df: DataFrame, args, name: str) -> None:
    io.write_csv(df, f"{args.output_dir}/{name}")


@command(("--input", _NEEDED), ("--output-dir", _NEEDED), ("--chunk-size", {"type": int, "default": 1_500_000}), ("--no-resume", {"action": "store_true"}))
def executives(spark: SparkSession, args) -> None:
    """Executives in filings: raw mentions, cleaned names, final rows, and a summary. Companies of an earlier run's raw output are not read again."""
    filings = io.read_csv(spark, args.input, FILINGS, label="filings").withColumn("_row", F.monotonically_increasing_id())
    done = None if args.no_resume else io.if_there(spark, f"{args.output_dir}/executives_raw", strings("company filing_type chunk_no at executive_name executive_title confidence"))
    raw = people.raw_executives(filings, "_row", size=args.chunk_size, done=done)
    io.write_csv(raw, f"{args.output_dir}/executives_raw", mode="overwrite" if done is None else "append")
    every = io.read_csv(spark, f"{args.output_dir}/executives_raw", strings("company filing_type chunk_no at executive_name executive_title confidence")).withColumns({c: F.col(c).cast("int") for c in ("chunk_no", "at")})
    named = people.clean_names(every)
    _save(named.drop("_low"), args, "executives_cleaned")
    final = people.final_executives(every)
    _save(final, args, "executive_final")
    io.write_summary(people.executive_summary(final), f"{args.output_dir}/executive_dataset_summary")
    _save(people.confidence_counts(final), args, "executive_confidence")


@command(("--input", _NEEDED), ("--output-dir", _NEEDED), ("--title-column", {"default": "executive_title_clean"}))
def titles(spark: SparkSession, args) -> None:
    """Counts of standard titles and categories, category shares, and a histogram of the counts."""
    rows = require_columns(io.read_csv(spark, args.input, label="executives"), [args.title_column])
    summary = people.title_summary(rows, args.title_column)
    _save(summary.orderBy(F.desc("count"), "title_standard", "category"), args, "executive_titles_category")
    _save(people.category_share(summary).orderBy(F.desc("count"), "category"), args, "category_share")
    _save(ops.histogram(summary, "count", 15).orderBy("bin"), args, "count_histogram")


@command(("--input", _NEEDED), ("--results", _NEEDED), ("--pages", _NEEDED), ("--output-dir", _NEEDED), ("--max-companies", {"type": int}), ("--run-social", {"action": "store_true"}), ("--fix-missing", {"action": "store_true"}))
def contact_details(spark: SparkSession, args) -> None:
    """Contacts of companies from tables of search results (query, rank, url) and pages (url, html); companies of an earlier run stay as they are."""
    names = ops.capped(contacts.unique_companies(io.read_csv(spark, args.input, label="companies")), args.max_companies, ["company"])
    results = io.read_csv(spark, args.results, strings("query rank url"), label="search results").withColumn("rank", F.col("rank").cast("int"))
    pages = io.read_csv(spark, args.pages, strings("url html"), label="pages")
    out = f"{args.output_dir}/company_contacts"
    fields = strings("company company_clean domain ir_page ir_email cs_page cs_email error")
    done = io.if_there(spark, out, fields)
    io.write_csv(contacts.extract_contacts(names, results, pages, done), out, mode="append")
    rows = io.read_csv(spark, out, fields)
    if args.run_social or args.fix_missing:
        rows = contacts.with_social(rows, results)
    if args.fix_missing:
        rows = contacts.repair(rows, results, pages)
    _save(rows, args, "company_contacts_final")


@command(("--company-file", _NEEDED), ("--index", {}), ("--exhibits", _NEEDED), ("--output-dir", _NEEDED))
def subsidiaries(spark: SparkSession, args) -> None:
    """Companies with ciks (matched with ``--index``, a JSON index, where they have none), the log of their exhibits, subsidiaries, failures, and the master table.

    ``--exhibits``: CSV of cik, accession, exhibit_url, html, error.
    """
    rows = require_columns(io.read_csv(spark, args.company_file, label="companies"), ["company_name"])
    if args.index:
        rows = bundles.add_ciks(rows, io.read_company_index(spark, args.index))
    rows = require_columns(rows, ["cik"]).withColumn("cik", F.trim(F.replace("cik", F.lit(".0"), F.lit(""))))
    _save(rows, args, "unique_companies_with_cik")
    found = rows.select("company_name", "cik").join(io.read_csv(spark, args.exhibits, strings("cik accession exhibit_url html error"), label="exhibits"), "cik", "left")
    log = bundles.exhibit_reason(found).select("company_name", "cik", "has_exhibit21", "exhibit_url", "reason")
    _save(log, args, "companies_exhibit21_log")
    done = io.if_there(spark, f"{args.output_dir}/ex21_full_output", strings("parent_name parent_cik source_url subsidiary_name_raw subsidiary_name_clean source_type confidence extraction_notes"))
    found = found.where("exhibit_url is not null or error is not null").select(F.col("company_name").alias("parent_name"), F.col("cik").alias("parent_cik"), F.col("exhibit_url").alias("source_url"), "html", "error")
    made, failed = bundles.extract_all(found, done)
    io.write_csv(made, f"{args.output_dir}/ex21_full_output", mode="append")
    _save(failed, args, "ex21_errors")
    every = io.read_csv(spark, f"{args.output_dir}/ex21_full_output", made.schema)
    _save(bundles.master(log, every), args, "master_company_subsidiary_dataset")


@command(("--contacts", _NEEDED), ("--subsidiaries", _NEEDED), ("--output-dir", _NEEDED), ("--company", {}), ("--limit", {"type": int}), ("--dry-run", {"action": "store_true"}))
def bundle(spark: SparkSession, args) -> None:
    """Documents (path, json) of companies with contacts and subsidiaries; ``--dry-run`` prints the first summaries."""
    sides = []
    for path, label in ((args.contacts, "contacts"), (args.subsidiaries, "subsidiaries")):
        side = io.read_csv(spark, path, label=label)
        side = side.withColumnRenamed(find_column(side, ["company", "company_name", "parent_name"]), "company")
        sides.append(people.of_company(side, args.company) if args.company else side)
    if args.limit:
        kept = ops.capped(bundles.summaries(*sides), args.limit, ["company_name"]).select(F.col("company_name").alias("_kept"))
        sides = [s.join(kept, F.trim("company") == F.col("_kept"), "left_semi") for s in sides]
    if args.dry_run:
        print("\n".join(connectors.preview(bundles.summaries(*sides))))
    else:
        bundles.documents(*sides).write.mode("overwrite").json(f"{args.output_dir}/documents")


@command(("--messages", _NEEDED), ("--output-dir", _NEEDED), ("--merge-threshold", {"type": float, "default": Thresholds.merge}), ("--review-threshold", {"type": float, "default": Thresholds.suggest}), ("--max-messages", {"type": int}))
def brands_extract(spark: SparkSession, args) -> None:
    """Brands in a folder of messages (JSON lines): mentions, counts, and names to review. Each file is read once, over all runs."""
    ingest.ingest(spark, args.messages, f"{args.output_dir}/messages", f"{args.output_dir}/_state").awaitTermination()
    rows = ops.capped(spark.read.parquet(f"{args.output_dir}/messages"), args.max_messages, ["date", "message_id"])
    found = brands.mentions(rows)
    canonical = brands.canonical_brands(found, merge=args.merge_threshold, review=args.review_threshold)
    _save(found.join(canonical.drop("suggested", "score"), ["message_id", "position"]).select("message_id", "date", "brand_raw", "brand_clean", "brand_canonical", "source"), args, "brand_request_extracted")
    _save(brands.brand_counts(found, canonical), args, "brand_request_counts")
    _save(canonical.where("suggested is not null").select(F.col("brand_canonical").alias("brand_raw"), F.col("suggested").alias("suggested_canonical"), "score"), args, "alias_review")


@command(("--input-counts", {}), ("--output-dir", _NEEDED))
def brands_clean(spark: SparkSession, args) -> None:
    """Clean, review and dropped tables of brand counts."""
    rows = brands.labelled(io.read_csv(spark, args.input_counts or f"{args.output_dir}/brand_request_counts", label="brand counts"))
    _save(brands.clean_brands(rows).orderBy(F.desc("count"), "brand_canonical_clean"), args, "brand_request_counts_clean")
    for label, name in (("review", "review"), ("drop", "dropped")):
        _save(rows.where(F.col("label") == label).orderBy(F.desc("count"), "brand_canonical"), args, f"brand_request_counts_{name}")


@command(("--committees", _NEEDED), ("--activity", _NEEDED), ("--universe", _NEEDED), ("--crosswalk", _NEEDED), ("--output-dir", _NEEDED))
def pac_superset(spark: SparkSession, args) -> None:
    """The universe of tickers with each one's PAC status, and the tables on the way there."""
    joined = pac.with_activity(pac.corporate_pacs(io.read_committees(spark, args.committees)), io.read_csv(spark, args.activity, ACTIVITY, label="activity"))
    _save(joined, args, "pacs_with_activity")
    _save(pac.zero_activity(joined), args, "zero_activity_pacs")
    status = pac.company_status(joined)
    _save(status, args, "company_pac_status")
    crosswalk = io.read_csv(spark, args.crosswalk, CROSSWALK, label="crosswalk")
    _save(pac.superset(io.read_csv(spark, args.universe, label="universe"), crosswalk, status), args, "pac_superset")


@command(("--executives", _NEEDED), ("--crosswalk", _NEEDED), ("--output-dir", _NEEDED))
def tickers(spark: SparkSession, args) -> None:
    """Executives with tickers, and the logs of companies without one and with several."""
    rows = io.read_csv(spark, args.executives, label="executives")
    rows = rows.withColumnRenamed(find_column(rows, ["company", "company_name"]), "company")
    out = people.with_tickers(rows, io.read_csv(spark, args.crosswalk, CROSSWALK, label="crosswalk"))
    _save(out.withColumn("ticker_candidates", F.array_join("ticker_candidates", "|")), args, "executives_with_tickers")
    _save(people.triage(people.unmatched(out)), args, "unmatched_companies")
    _save(people.ambiguous(out), args, "ambiguous_companies")


@command(("--input-dir", _NEEDED), ("--years", {"nargs": "+", "type": int, "default": [2020, 2022, 2024, 2026]}), ("--output-dir", _NEEDED))
def build_master(spark: SparkSession, args) -> None:
    """Committee masters of several cycles (files ``YEAR.txt``) in one table."""
    _save(io.committees_of_cycles(spark, {y: f"{args.input_dir}/{y}.txt" for y in args.years}), args, "committee_master")


@command(("--receipts", _NEEDED), ("--master", _NEEDED), ("--output-dir", _NEEDED), ("--valid-cycles", {"nargs": "+", "type": int, "default": [2020, 2022, 2024, 2026]}), ("--high", {"type": float, "default": Thresholds.high}), ("--review", {"type": float, "default": Thresholds.review}))
def validate(spark: SparkSession, args) -> None:
    """Receipts matched with the committee master: matches, a summary, the match rate, and the committees most often unmatched."""
    receipts = pac.in_cycles(io.read_csv(spark, args.receipts, RECEIPTS, label="receipts"), args.valid_cycles)
    matches = pac.match_receipts(receipts, io.read_csv(spark, args.master, label="committee master"), high=args.high, review=args.review).persist()
    _save(matches, args, "matches")
    _save(pac.match_summary(matches).orderBy(F.desc("rows"), "match_method"), args, "match_summary")
    io.write_summary(pac.match_rate(matches), f"{args.output_dir}/match_rate")
    _save(pac.top_unmatched(matches), args, "top_unmatched")
    matches.unpersist()


@command(("--messages", _NEEDED), ("--output-dir", _NEEDED))
def alerts(spark: SparkSession, args) -> None:
    """Executive changes in a folder of alert messages (JSON lines), and the lines that no rule could read."""
    ingest.ingest(spark, args.messages, f"{args.output_dir}/messages", f"{args.output_dir}/_state").awaitTermination()
    events = people.alert_events(spark.read.parquet(f"{args.output_dir}/messages"))
    _save(events, args, "executive_changes")
    _save(people.failures(events), args, "parse_failures")


@command(("name", {"choices": sorted(catalog.QUERIES)}), ("data_dir", {}), ("out", {"nargs": "?"}))
def query(spark: SparkSession, args) -> None:
    """A registered query over a folder of Parquet tables: shows its rows, or writes them as Parquet."""
    df = catalog.QUERIES[args.name](spark, args.data_dir)
    df.write.mode("overwrite").parquet(args.out) if args.out else df.show(50, truncate=80)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corpgraph", description=__doc__)
    subs = parser.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        sub = subs.add_parser(name, help=f.__doc__)
        for option, settings in options:
            sub.add_argument(option, **settings)
    args = parser.parse_args(argv)
    COMMANDS[args.command][0](spark or SparkSession.builder.appName("corpgraph").getOrCreate(), args)
