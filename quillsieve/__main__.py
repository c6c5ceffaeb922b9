"""Command line: ``spark-submit`` or ``python -m quillsieve <job> ...``.

Each job takes folders or tables any Spark reader knows; nothing is kept on the
driver. Run ``python -m quillsieve <job> -h`` for its options.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.patterns import DEFAULT_PHRASES, TermList
from .functions.ordering import SHUFFLE_SEED, shuffle_key
from .functions.reporting import shard_number
from .functions.textnorm import long_enough
from .operators.packing import ROW_GROUP_ROWS, SHARD_CHARS, pad_shards, sample_previews
from .operators.stats import length_histogram
from .plans.audit import audit_corpus, live_rows, rewrite_dirty, rewrite_live
from .plans.build import TARGET_TOKENS, Source, append_corpus, build_corpus, collect_sources, packed_corpus
from .plans.dialogues import TARGET_DIALOGUES, accepted, request_table, screen_replies
from .plans.report import report_json
from .runtime import drop_stages, materialize, rename_new
from .sources.documents import append_dialogues, count_jsonl, read_books, scan_subsets
from .sources import manifest
from .sources.shards import all_valid, validate_shards, write_shards
from .sources.stagestore import StageStore, fingerprint
from .streaming.audit_stream import audit_new_shards, audited_counts

PAD_HELP = "write an is_pad column, so that later jobs can drop the pad copies"
TERM_SCHEMA = "ord int, term string, category string, whole_word boolean"


# Terms that still travel to every task as a list; more are matched through the index.
LIST_TERMS = 5_000


def read_terms(spark: SparkSession, path: str) -> TermList:
    """Term list as JSON lines: ord, term, category, whole_word."""
    rows = spark.read.schema(TERM_SCHEMA).json(path)
    if rows.count() > LIST_TERMS:
        raise ValueError(f"{path} has more than {LIST_TERMS} terms: this job takes a list, only the audit takes tables of any size")
    return TermList.from_table(rows)


def print_rows(rows: DataFrame) -> None:
    """Every row as a JSON line; the driver holds one partition at a time."""
    for row in rows.select(F.to_json(F.struct("*")).alias("line")).toLocalIterator():
        print(row.line)


def pad_flag(args: argparse.Namespace) -> tuple[str, ...]:
    return ("is_pad",) if args.pad_flag else ()


SUBSET_SCHEMA = "row_id bigint, text string, audience string, text_token_length bigint"


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with row ids; sources without any are numbered once and stored, so that every later pass sees the same numbers."""
    if rows.where(F.col("row_id").isNull()).isEmpty():
        return rows
    if not rows.where(F.col("row_id").isNotNull()).isEmpty():
        raise ValueError("some rows have a row_id and some have none")
    return materialize(rows.withColumn("row_id", F.monotonically_increasing_id()), "numbered")


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = dict(pair.split("=", 1) for pair in args.subset)
    if args.state:
        return build_by_stages(spark, args, paths)
    rows, failed = scan_subsets(spark, paths, SUBSET_SCHEMA)
    for name, error in failed.items():
        print(f"skipped {name}: {error.splitlines()[0]}")
    corpus = build_corpus(numbered(rows), read_books(spark, args.books), args.target_tokens, shard_chars=args.shard_chars)
    write_shards(corpus, args.output, clustered=True, extra=pad_flag(args))


def build_by_stages(spark: SparkSession, args: argparse.Namespace, paths: dict[str, str]) -> None:
    """A build that keeps finished sources in ``--state`` and, run again, goes on where it stopped."""
    store = StageStore(spark, args.state)

    def source(name: str, path: str, position: int) -> Source:
        def read() -> DataFrame:
            rows, _ = scan_subsets(spark, {name: path}, SUBSET_SCHEMA)
            return numbered(rows.withColumn("ord", F.lit(position)))

        return Source(name, f"{position}:{fingerprint(spark, path)}", read)

    parts = []
    for position, (name, path) in enumerate(paths.items()):
        try:
            parts.append(source(name, path, position))
        except AnalysisException as error:
            print(f"skipped {name}: {str(error).splitlines()[0]}")
    books = Source("books", fingerprint(spark, args.books, "pg*.txt"), lambda: read_books(spark, args.books))
    selected = collect_sources(store, parts, [books], args.target_tokens)
    corpus = packed_corpus(selected.rows, args.shard_chars, ROW_GROUP_ROWS, SHUFFLE_SEED)
    staged = f"{args.output.rstrip('/')}.staged-{uuid.uuid4().hex}"
    write_shards(corpus, staged, clustered=True, extra=pad_flag(args))
    if not rename_new(spark, staged, args.output):
        raise FileExistsError(args.output)


def append(spark: SparkSession, args: argparse.Namespace) -> None:
    """Packs documents (Parquet files with a text column) behind a shard folder, once for each batch name."""
    rows = spark.read.schema("text string").parquet(args.input)
    position = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    docs = rows.where(long_enough(F.col("text"))).select(F.md5(position).alias("doc_id"), "text")
    print(f"version {append_corpus(spark, args.output, docs, args.batch, shard_chars=args.shard_chars)}")


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    docs = live_rows(spark, args.input)
    phrases = DEFAULT_PHRASES if args.phrases else []
    terms = spark.read.schema(TERM_SCHEMA).json(args.terms)
    if terms.count() <= LIST_TERMS:
        terms = TermList.from_table(terms)
    result = audit_corpus(docs, terms, phrases, whole_shards=True)
    write_shards(result.kept, args.output, clustered=True, extra=pad_flag(args))
    result.log.write.mode("overwrite").json(f"{args.output}-log")
    result.counts.write.mode("overwrite").json(f"{args.output}-counts")
    print_rows(result.counts.orderBy("shard"))


def audit_new(spark: SparkSession, args: argparse.Namespace) -> None:
    """Audits shard files not seen before and writes their clean shards; those of earlier runs stay as they are.

    A shard is one file. Its number comes from its path.
    """
    state = f"{args.output}-state"

    def publish(rows: DataFrame) -> None:
        kept = rows.where(~F.col("blocked"))
        position = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        named = kept.select(shard_number(F.col("file")).alias("shard"), "text", F.md5(position).alias("doc_id"))
        keyed = named.withColumn("shuffle_key", shuffle_key(F.col("doc_id")))
        padded = pad_shards(keyed, whole_shards=True)
        write_shards(padded, args.output, mode="dynamic", clustered=True)

    audit_new_shards(
        spark, args.input, f"{state}/rows", f"{state}/checkpoint", read_terms(spark, args.terms), shard="file",
        phrases=DEFAULT_PHRASES if args.phrases else (), publish=publish,
    )
    print_rows(audited_counts(spark, f"{state}/rows", shard="file").orderBy("file"))


def rewrite(spark: SparkSession, args: argparse.Namespace) -> None:
    """Second pass: writes replacements of the changed shards to a folder, or publishes them as the input's next version."""
    if args.publish:
        version, dirty = rewrite_live(spark, args.input, pad_flag=args.pad_flag)
        print_rows(dirty.orderBy("shard"))
        print("nothing to change" if version is None else f"published version {version}")
        return
    changed = rewrite_dirty(live_rows(spark, args.input), whole_shards=True)
    write_shards(changed, args.output, mode="dynamic", clustered=True, extra=pad_flag(args))


def vacuum(spark: SparkSession, args: argparse.Namespace) -> None:
    """Deletes shard files that no kept version of a published folder lists."""
    print(f"deleted {manifest.vacuum(spark, args.input, args.keep, args.min_age_hours)} files")


def stats(spark: SparkSession, args: argparse.Namespace) -> None:
    report = report_json(spark, args.input)
    report.write.mode("overwrite").text(args.output)
    docs = live_rows(spark, args.input)
    print_rows(length_histogram(docs).orderBy("bin"))
    print_rows(sample_previews(docs, args.num_samples))


def validate(spark: SparkSession, args: argparse.Namespace) -> None:
    checked = materialize(validate_shards(spark, args.input), "checked")
    print_rows(checked.where("NOT ok").select("path", "issues").orderBy("path"))
    verdict = all_valid(checked).first()
    print(f"{verdict.shards} shards, {verdict.rows} rows, all valid: {verdict.all_ok}")
    if not verdict.all_ok:
        raise SystemExit(1)


def requests(spark: SparkSession, args: argparse.Namespace) -> None:
    topics = spark.read.schema("topic_id string, topic string").json(args.topics)
    existing = args.existing
    if args.finished:
        existing = count_jsonl(spark, args.finished).first()[0]
    table = request_table(topics, existing, args.num_dialogues, args.variations_per_topic)
    table.write.mode("overwrite").json(args.output)


def screen(spark: SparkSession, args: argparse.Namespace) -> None:
    replies = spark.read.schema("task_id string, reply string").json(args.replies)
    verdicts = spark.read.schema("task_id string, verdict string").json(args.verdicts)
    screened = materialize(screen_replies(replies, verdicts, read_terms(spark, args.terms)), "screened")
    append_dialogues(accepted(screened, "task_id", args.target), args.output)
    print_rows(screened.groupBy("status").count().orderBy("status"))


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quillsieve", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(function, name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=function.__doc__)
        sub.set_defaults(run=function)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    sub = job(build, "build", "books", "output")
    sub.add_argument("--subset", action="append", required=True, help="name=path, in order; repeatable")
    sub.add_argument("--target-tokens", type=int, default=TARGET_TOKENS)
    sub.add_argument("--shard-chars", type=int, default=SHARD_CHARS)
    sub.add_argument("--pad-flag", action="store_true", help=PAD_HELP)
    sub.add_argument("--state", help="folder of finished stages; a build that stopped goes on from there")
    sub = job(append, "append", "input", "output", "batch")
    sub.add_argument("--shard-chars", type=int, default=SHARD_CHARS)
    sub = job(audit, "audit", "input", "output", "terms")
    sub.add_argument("--pad-flag", action="store_true", help=PAD_HELP)
    sub.add_argument("--phrases", action="store_true", help="apply the second pass as well")
    sub = job(audit_new, "audit-new", "input", "output", "terms")
    sub.add_argument("--phrases", action="store_true", help="apply the second pass as well")
    sub = job(rewrite, "rewrite", "input")
    target = sub.add_mutually_exclusive_group(required=True)
    target.add_argument("--output", help="folder for the replacements")
    target.add_argument("--publish", action="store_true", help="replace the changed shards by a new version of the input folder")
    sub.add_argument("--pad-flag", action="store_true", help=PAD_HELP)
    sub = job(vacuum, "vacuum", "input")
    sub.add_argument("--keep", type=int, default=1, help="versions whose files stay")
    sub.add_argument("--min-age-hours", type=float, default=24)
    sub = job(stats, "stats", "input", "output")
    sub.add_argument("--num-samples", type=int, default=5)
    job(validate, "validate", "input")
    sub = job(requests, "requests", "topics", "output")
    sub.add_argument("--existing", type=int, default=0, help="dialogues that are finished already")
    sub.add_argument("--finished", help="file of finished dialogues; its lines are counted instead")
    sub.add_argument("--num-dialogues", type=int, default=TARGET_DIALOGUES)
    sub.add_argument("--variations-per-topic", type=int, default=50)
    sub = job(screen, "screen", "replies", "verdicts", "terms", "output")
    sub.add_argument("--target", type=int, help="dialogues to accept at most")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"quillsieve {args.job}").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        drop_stages(spark)


if __name__ == "__main__":
    main()
