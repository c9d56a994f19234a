"""The four stages: integration, storage, processing and analysis, and the chain of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.html import PostingSelectors, extract_posting
from siltstone.functions.predicates import has_empty_section
from siltstone.functions.records import content_digest, content_id, decode_payload, record_id, strip_newlines
from siltstone.functions.text import analyze, analyze_tags
from siltstone.operators.counts import tag_count
from siltstone.operators.incremental import everything, high_water_mark, new_rows, next_gaps, rows_in_gaps, when_any
from siltstone.operators.ranking import relative_weights
from siltstone.operators.scoring import POSTING_FIELDS, Field, classify, field_terms, weighted_points
from siltstone.plans.etl import run_etl
from siltstone.schemas import ANALYSED_FIELDS, BRONZE_SCHEMA, GOLD_TAG_SCHEMA, SILVER_SCHEMA
from siltstone.sources import keyed
from siltstone.sources.records import to_bronze, to_messages
from siltstone.sources.tables import TableSpec, read_table, read_table_stream, write_table
from siltstone.streaming.fanout import add_counts, append_batch, fan_out, read_batches, upsert_batch
from siltstone.streaming.sinks import append_to_table, read_keyed_table, update_to_table, upsert_to_table


#: The order of a listing: newest postings first.
LISTING = ["page", "pos"]


@dataclass(frozen=True)
class Lakehouse:
    """The tables below one base path."""

    base_path: str
    file_format: str = "parquet"

    def _table(self, name: str, schema=None) -> TableSpec:
        return TableSpec(f"{self.base_path.rstrip('/')}/{name}", self.file_format, schema)

    @property
    def collected(self) -> TableSpec:
        return self._table("collected")

    @property
    def markers(self) -> TableSpec:
        return self._table("markers")

    @property
    def gaps(self) -> TableSpec:
        return self._table("gaps")

    @property
    def records(self) -> TableSpec:
        return self._table("records")

    @property
    def bronze(self) -> TableSpec:
        return self._table("bronze", BRONZE_SCHEMA)

    @property
    def silver(self) -> TableSpec:
        return self._table("silver", SILVER_SCHEMA)

    @property
    def silver_batches(self) -> TableSpec:
        return self._table("silver_batches", SILVER_SCHEMA)

    @property
    def commits(self) -> TableSpec:
        return self._table("commits")

    @property
    def gold_tags(self) -> TableSpec:
        return self._table("gold/tags", GOLD_TAG_SCHEMA)

    @property
    def index(self) -> TableSpec:
        return self._table("index", SILVER_SCHEMA)


# Integration -----------------------------------------------------------------------------------

def collected_postings(
    fetched: DataFrame, source: Column, selectors: PostingSelectors = PostingSelectors()
) -> DataFrame:
    """Fetched pages (page, pos, html) with parsed fields, content id, digest and the empty-section flag."""
    parsed = fetched.select("page", "pos", strip_newlines(F.col("html")).alias("raw")).withColumn(
        "posting", extract_posting(F.col("raw"), selectors)
    )
    named = [F.col(name) for name in ("title", "company", "requirement", "benefit", "overview")]
    return parsed.select("page", "pos", "raw", source.alias("source"), "posting.*").select(
        content_id(*named).alias("id"),
        content_digest(*named).alias("digest"),
        "*",
        has_empty_section(F.col("requirement"), F.col("overview"), F.col("benefit")).alias("abnormal"),
    )


def run_integration(
    fetched: DataFrame,
    source: Column,
    collected: TableSpec,
    selectors: PostingSelectors = PostingSelectors(),
    limit: int | None = None,
    last_seen: str | None = None,
    gaps: DataFrame | None = None,
) -> DataFrame:
    """New postings of a run: with ``gaps`` the first ``limit`` that no run has collected yet.

    Without them, the first ``limit`` in page order, cut at the last-seen digest: what lies between the
    limit and that posting is then left out for good. The short content id may name several postings, so
    both go by the digest of the whole fields. The parsed pages are written first, because the cut reads
    them twice.
    """
    write_table(collected_postings(fetched, source, selectors), collected)
    rows = read_table(fetched.sparkSession, collected)
    if gaps is None:
        return new_rows(rows, "digest", LISTING, limit, last_seen)
    return rows_in_gaps(rows, "digest", LISTING, gaps, limit)


def read_gaps(spark: SparkSession, lake: Lakehouse, last_seen: str | None = None) -> DataFrame:
    """What the last run left open; before the first run everything, or what is above ``last_seen``."""
    try:
        runs = read_table(spark, lake.gaps)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return everything(spark, [] if last_seen is None else [f"{last_seen}#1"])
    return runs.where(F.col("run") == runs.agg(F.max("run")).scalar()).drop("run")


def write_gaps(gaps: DataFrame, lake: Lakehouse) -> None:
    """Add the gaps after a run, with the time as its number; one file, so a run is there whole or not."""
    write_table(gaps.withColumn("run", F.current_timestamp()).coalesce(1), lake.gaps, "append")


def posting_messages(postings: DataFrame, group: str) -> DataFrame:
    """Messages of a run: the raw page with its source and the name of the run as headers."""
    return to_messages(
        postings, F.col("raw"), {"source": F.col("source"), "message_group_id": F.lit(group)}
    )


# Storage ---------------------------------------------------------------------------------------

def run_storage(records: DataFrame, bronze: TableSpec) -> DataFrame:
    """Record stream to the bronze table; the reader of the stream bounds its batches."""
    return run_etl(lambda: records, to_bronze, lambda rows: append_to_table(rows, bronze))


# Processing ------------------------------------------------------------------------------------

def to_silver(bronze: DataFrame, selectors: PostingSelectors = PostingSelectors()) -> DataFrame:
    """Bronze rows to one row per posting."""
    return bronze.select(
        record_id(F.col("partition"), F.col("offset")).alias("id"),
        "source",
        "collect_id",
        extract_posting(decode_payload(F.col("value")), selectors).alias("posting"),
    ).select(
        "id", "source", "collect_id",
        *[f"posting.{name}" for name in ("title", "tags", "overview", "requirement", "benefit", "company")],
    )


def run_processing(
    spark: SparkSession,
    lake: Lakehouse,
    selectors: PostingSelectors = PostingSelectors(),
    files_per_batch: int | None = None,
) -> DataFrame:
    """Bronze to silver, then silver to the index and to the gold tag counts.

    Pages are parsed once, into silver; the other two sinks follow the silver table side by side.
    ``files_per_batch`` cuts a long backlog into batches of so many files. If one sink fails, the
    other is stopped.
    """
    run_etl(
        lambda: read_table_stream(spark, lake.bronze, files_per_batch),
        lambda rows: to_silver(rows, selectors),
        lambda rows: append_to_table(rows, lake.silver),
    )
    silver = read_table_stream(spark, lake.silver, files_per_batch)
    sinks = [
        upsert_to_table(silver, lake.index, "id", ["id"], wait=False),
        update_to_table(tag_count(silver), lake.gold_tags, "tag", wait=False),
    ]
    try:
        for query in sinks:
            query.awaitTermination()
    finally:
        for query in sinks:
            query.stop()
    return silver


def run_processing_together(
    spark: SparkSession,
    lake: Lakehouse,
    selectors: PostingSelectors = PostingSelectors(),
    files_per_batch: int | None = None,
) -> DataFrame:
    """Bronze to silver, index and gold tag counts, by one stream that parses and reads every page once.

    A batch counts when all three have it (see :mod:`siltstone.streaming.fanout`); a run that died between two
    of them is finished by the next. Gives the silver rows of whole batches. A lake is processed either so or
    by :func:`run_processing`, as both number the batches of the same index and counts.

    Batches come one after the other, and one of few files has few tasks: its records are dealt to all cores by
    their place in the record stream before their pages are parsed.
    """
    bronze = read_table_stream(spark, lake.bronze, files_per_batch)
    dealt = bronze.repartition(spark.sparkContext.defaultParallelism, "partition", "offset")
    fan_out(
        to_silver(dealt, selectors),
        lake.commits,
        {
            "silver": append_batch(lake.silver_batches),
            "index": upsert_batch(lake.index, "id", ["id"]),
            "gold": add_counts(lake.gold_tags, "tag", "tag_post_count", tag_count),
        },
    )
    return read_batches(spark, lake.silver_batches, lake.commits)


# Analysis --------------------------------------------------------------------------------------

def run_analysis(spark: SparkSession, lake: Lakehouse, words: int | None = None) -> DataFrame:
    """Relative weights of all tags of the gold table, or of the most frequent ones."""
    tags = read_keyed_table(spark, lake.gold_tags, "tag")
    return relative_weights(tags.select(F.col("tag").alias("term"), F.col("tag_post_count").alias("n")), words)


def analysed_copy(index: DataFrame, text_fields: tuple[str, ...] = ANALYSED_FIELDS, tags: str | None = "tags") -> DataFrame:
    """The index rows with a term array beside every analysed field."""
    return index.select(
        "*",
        *([analyze_tags(tags).alias(f"{tags}_terms")] if tags else []),
        *[analyze(name).alias(f"{name}_terms") for name in text_fields],
    )


def refresh_analysed_copy(spark: SparkSession, index: TableSpec, copy: TableSpec, key: str = "id", **fields) -> DataFrame:
    """Analyse the rows of a keyed index that changed since the last refresh, and give them.

    The copy is a keyed table too; its last batch is the mark up to which the index was read, so a
    refresh that dies is done again. What did not change is not read. Rows are dealt to the buckets before they are
    analysed, so term arrays are not shuffled. Read it with ``read_keyed_table``.
    """
    mark = keyed.state_of(spark, copy).committed
    changed, upto = keyed.changes_after(spark, index, key, mark)
    if upto is not None and upto != mark:
        keyed.put_batch(changed, copy, key, upto, widen=lambda placed: analysed_copy(placed, **fields))
    return analysed_copy(changed, **fields)


def score_terms(
    postings: DataFrame,
    dictionary: DataFrame,
    fields: list[Field] = POSTING_FIELDS,
    buckets: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Points and class of every term of the postings: tags, then text fields, then dictionary.

    With ``stored`` the postings are an :func:`analysed_copy`; its term arrays are read instead of the texts.
    """
    tag_field = fields[0].name
    terms = field_terms(postings, {
        field.name: F.col(f"{field.name}_terms") if stored
        else analyze_tags(field.name) if field.name == tag_field else analyze(field.name, distinct=True)
        for field in fields
    })
    return classify(weighted_points(terms, fields, tag_field, buckets), dictionary)


# The chain -------------------------------------------------------------------------------------

def run_stages(
    spark: SparkSession,
    lake: Lakehouse,
    records: DataFrame,
    selectors: PostingSelectors = PostingSelectors(),
    files_per_batch: int | None = None,
    processing: Callable[..., DataFrame] = run_processing,
) -> DataFrame:
    """Storage, processing and analysis of what a record stream holds.

    ``processing`` is :func:`run_processing` or :func:`run_processing_together`.
    """
    run_storage(records, lake.bronze)
    processing(spark, lake, selectors, files_per_batch)
    return run_analysis(spark, lake)


def run_all(
    spark: SparkSession,
    lake: Lakehouse,
    fetched: DataFrame,
    source: Column,
    send: Callable[[DataFrame], object],
    receive: Callable[[], DataFrame],
    selectors: PostingSelectors = PostingSelectors(),
    limit: int | None = None,
    last_seen: str | None = None,
    files_per_batch: int | None = None,
    processing: Callable[..., DataFrame] = run_processing,
) -> DataFrame | None:
    """The whole chain; the stages after integration run only if there are new postings.

    ``send`` puts new postings into the record stream (see :func:`posting_messages`), ``receive``
    opens that stream. With a limit, postings beyond it stay open for later runs: the gaps around what
    was collected are kept in a table. Gaps and the marker of the next run (:func:`next_marker`) move
    only after sending: a failed send and a run without new postings leave them as they were.
    ``last_seen`` bounds the first run; later ones go by the gaps.
    """
    gaps = read_gaps(spark, lake, last_seen)
    postings = run_integration(fetched, source, lake.collected, selectors, limit, gaps=gaps)
    if not when_any(postings, send):
        return None
    collected = read_table(spark, lake.collected)
    write_gaps(next_gaps(collected, "digest", LISTING, gaps, limit), lake)
    first = high_water_mark(collected, "digest", LISTING)
    write_table(first.withColumn("moved", F.current_timestamp()), lake.markers, "append")
    return run_stages(spark, lake, receive(), selectors, files_per_batch, processing)


def next_marker(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """One row with the digest of the first posting of the last run that sent any; call it after such a run."""
    return read_table(spark, lake.markers).agg(F.max_by("marker", "moved").alias("marker"))
