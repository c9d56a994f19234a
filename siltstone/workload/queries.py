"""One query per operator over the sample tables. Each reads whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import predicates, records, text
from siltstone.functions.html import PostingSelectors, extract_posting
from siltstone.operators import counts, incremental, ranking, scoring, search
from siltstone.plans import medallion
from siltstone.session import scratch_path
from siltstone.sources import keyed
from siltstone.sources.dictionary import dictionary_lines, duplicate_entries, sorted_entries
from siltstone.sources.records import read_record_files, to_bronze, value_text
from siltstone.sources.tables import TableSpec, read_table, table_report, write_table
from siltstone.streaming import sinks
from siltstone.streaming.fanout import read_batches

# The sample pages have no posting classes: title, first heading, navigation entries, paragraphs.
PAGE_SELECTORS = PostingSelectors(title="title", company="h1", tag_list="ul", paragraph="p")
PAGE_SOURCE = "pages.example"
POSTING_TEXT = ("title", "company", "overview", "requirement", "benefit")

SCORED_FIELDS = [
    scoring.Field("tags", 6, 1),
    scoring.Field("document", 1, 3),
    scoring.Field("conversation", 1, 3),
    scoring.Field("title", 1, 3),
]
SEARCH_TEXT = "nicht que"
SCORE_DIGITS = 6
LAST_SEEN = 1000
ABSENT = -1
LAST_SEEN_PAGE = "123fb1f9a8f717ce5c3d62699e3809e6e24c0b29c5074fb2dbe63dbd8debda27"
RUN_LIMIT = 1000
# Days since 1970: the first and the second listing end before them.
LISTED_UNTIL = (10_341, 10_830)
REPORT_PARTITIONS = 8
# Keys of a point read.
READ_USERS = (7, 42, 99, 10**9)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """A sample table. ``siltstone.scan.tasks`` (unset by default) deals its rows to so many tasks.

    That is for files of one row group, which a scan can't divide; a cluster's tables have many.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*columns) if columns else df
    tasks = spark.conf.get("siltstone.scan.tasks", None)
    return df.repartition(int(tasks)) if tasks else df


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The trailing star makes the path a pattern, which a stream needs to accept a single file.
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id", "html")


def part_tags(parts: DataFrame) -> DataFrame:
    """Parts as rows with a tag array: the words of the name."""
    return parts.select(F.split("p_name", " ").alias("tags"))


def event_records(events: DataFrame) -> DataFrame:
    """Events as a record stream.

    The second header is a number, a date text for every 7th user, and missing for every 11th.
    """
    second = F.when(F.col("user_id") % 7 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.col("user_id").cast("string")
    )
    first_header = records.header("source", F.col("event_type"))
    return events.select(
        F.lit(None).cast("binary").alias("key"),
        records.encode_payload(F.col("props")).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.when(F.col("user_id") % 11 == 0, F.array(first_header))
        .otherwise(F.array(first_header, records.header("collect_id", second)))
        .alias("headers"),
    )


def page_records(source: DataFrame) -> DataFrame:
    """Pages as a record stream."""
    return source.select(
        F.lit(None).cast("binary").alias("key"),
        records.encode_payload(F.col("html")).cast("binary").alias("value"),
        F.lit("pages").alias("topic"),
        (F.col("page_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("page_id") / 4).cast("long").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(
            records.header("source", F.lit(PAGE_SOURCE)),
            records.header("collect_id", F.col("page_id").cast("string")),
        ).alias("headers"),
    )


# Records ---------------------------------------------------------------------------------------

def bronze_projection(spark, sf_dir):
    return bronze_rows(to_bronze(event_records(table(spark, sf_dir, "events"))))


def bronze_rows(bronze: DataFrame) -> DataFrame:
    """Bronze rows with types that compare alike everywhere (NULL numbers as text)."""
    return bronze.withColumns({
        "timestamp": F.col("timestamp").cast("timestamp_ntz"), "collect_id": F.col("collect_id").cast("string"),
    })


def raw_values(spark, sf_dir):
    return value_text(event_records(table(spark, sf_dir, "events")))


def surrogate_id(spark, sf_dir):
    stream = event_records(table(spark, sf_dir, "events"))
    return stream.select("partition", "offset", records.record_id(F.col("partition"), F.col("offset")).alias("id"))


def payload_decode(spark, sf_dir):
    sent = table(
        spark, sf_dir, "documents", "doc_id", records.encode_payload(F.col("text")).cast("binary").alias("value")
    )
    return sent.select("doc_id", records.decode_payload(F.col("value").cast("string")).alias("text"))


def json_to_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events", "event_id", "props")
    parsed = events.select("event_id", F.from_json("props", "k int").alias("parsed"))
    return parsed.select("event_id", "parsed.k", F.to_json("parsed").alias("encoded"))


def posting_row(row: DataFrame) -> DataFrame:
    return row.withColumn("tags", F.array_join("tags", "|"))


def html_extract(spark, sf_dir):
    parsed = pages(spark, sf_dir).select(
        "page_id", extract_posting(F.col("html"), PAGE_SELECTORS).alias("posting")
    )
    return posting_row(parsed.select("page_id", F.lit(PAGE_SOURCE).alias("source"), "posting.*"))


def newline_strip(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", records.strip_newlines(F.col("text")).alias("text"))


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the order of a collection run, twenty to a result page."""
    return pages(spark, sf_dir).select(
        F.floor(F.col("page_id") / 20).cast("int").alias("page"),
        (F.col("page_id") % 20).cast("int").alias("pos"),
        "html",
    )


def abnormal_records(spark, sf_dir):
    collected = medallion.collected_postings(fetched_pages(spark, sf_dir), F.lit(PAGE_SOURCE), PAGE_SELECTORS)
    return collected.select("page", "pos", "id", "abnormal")


def content_id(spark, sf_dir):
    fields = ["p_name", "p_brand", "p_type"]
    return table(
        spark, sf_dir, "part", "p_partkey", records.content_id(*[F.col(name) for name in fields]).alias("id")
    )


def row_label(spark, sf_dir):
    label = records.row_label(F.col("p_partkey"), F.col("p_name"), F.col("p_brand"))
    return table(spark, sf_dir, "part", "p_partkey", label.alias("label"))


# Counts ----------------------------------------------------------------------------------------

def tag_count(spark, sf_dir):
    return counts.tag_count(part_tags(table(spark, sf_dir, "part")))


def company_count(spark, sf_dir):
    return counts.company_count(table(spark, sf_dir, "customer"), "c_mktsegment")


def row_count(spark, sf_dir):
    return counts.row_count(table(spark, sf_dir, "lineitem"), "row_count")


def keyword_count(spark, sf_dir):
    return counts.keyword_count(table(spark, sf_dir, "documents"), "source")


def tag_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_count(spark, sf_dir).select(F.col("tag").alias("term"), F.col("tag_post_count").alias("n"))


def frequency_table(spark, sf_dir):
    return ranking.frequency_table(tag_frequency(spark, sf_dir))


def frequency_table_top(spark, sf_dir):
    return ranking.frequency_table(term_count(spark, sf_dir), ranking.CLOUD_WORDS)


def frequency_map(spark, sf_dir, shards=256):
    """One map per shard, so that no task has all tags; give more shards for more than some million distinct tags."""
    mapped = counts.frequency_map(tag_frequency(spark, sf_dir), "term", "n", shards)
    return mapped.select(F.explode("frequency").alias("tag", "n"))


# Text ------------------------------------------------------------------------------------------

def tokenize(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.posexplode(text.tokenize("text")).alias("pos", "token"))


def token_word_count(spark, sf_dir):
    return table(spark, sf_dir, "part", "p_partkey", text.word_count("p_name").alias("words"))


def _kept_words(spark: SparkSession, sf_dir: str, words: list[str]) -> DataFrame:
    kept = text.blank_stop_words(text.tokenize("text"), words)
    return documents(spark, sf_dir).select("doc_id", F.array_join(kept, " ", "_").alias("kept"))


def stopwords_english(spark, sf_dir):
    return _kept_words(spark, sf_dir, text.ENGLISH_STOP_WORDS)


def stopwords_vietnamese(spark, sf_dir):
    return _kept_words(spark, sf_dir, text.VIETNAMESE_STOP_WORDS)


def shingles(spark, sf_dir):
    slots = text.blank_stop_words(text.tokenize("text"), text.ENGLISH_STOP_WORDS + text.VIETNAMESE_STOP_WORDS)
    pairs = documents(spark, sf_dir).select("doc_id", F.posexplode(text.word_pairs(slots)).alias("pos", "pair"))
    return pairs.where(F.col("pair").isNotNull())


def number_blank(spark, sf_dir):
    words = counts.word_frequency(documents(spark, sf_dir), text.tokenize("text"))
    return words.select("term", F.trim(text.blank_number("term")).alias("blanked"), "n")


def analyze_text(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return search.term_listing(items, "item_id", "text")


def tag_terms(spark, sf_dir):
    return counts.term_count(part_tags(table(spark, sf_dir, "part")), text.analyze_tags("tags"))


def term_count(spark, sf_dir):
    return counts.text_term_count(documents(spark, sf_dir), "text")


def term_count_min3(spark, sf_dir):
    return counts.text_term_count(documents(spark, sf_dir), "text", 3)


def term_count_min10(spark, sf_dir):
    return counts.text_term_count(documents(spark, sf_dir), "text", 10)


def frequent_terms(spark, sf_dir):
    return counts.frequent_term_count(documents(spark, sf_dir), text.analyze("text", distinct=True), 10)


def term_buckets(spark, sf_dir):
    return counts.text_term_count(documents(spark, sf_dir), "text", limit=counts.TERM_BUCKETS)


def term_top(spark, sf_dir):
    return counts.text_term_count(documents(spark, sf_dir), "text", limit=100)


def word_frequency(spark, sf_dir):
    return counts.word_frequency(documents(spark, sf_dir), text.tokenize("text"))


def word_frequency_stop(spark, sf_dir):
    return counts.word_frequency(documents(spark, sf_dir), text.tokenize("text"), text.ENGLISH_STOP_WORDS)


def most_frequent(spark, sf_dir):
    return counts.most_frequent(word_frequency(spark, sf_dir))


def relative_weight(spark, sf_dir):
    weights = ranking.relative_weights(term_count(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", SCORE_DIGITS))


def match_search(spark, sf_dir):
    hits = search.match_search(documents(spark, sf_dir), "doc_id", "text", SEARCH_TEXT)
    return hits.withColumn("score", F.round("score", SCORE_DIGITS))


def match_search_many(spark, sf_dir):
    """All benchmark texts as queries over all documents."""
    asked = table(spark, sf_dir, "benchmark", "item_id", "text")
    hits = search.match_search_many(documents(spark, sf_dir), "doc_id", "text", asked, "item_id", "text")
    return hits.withColumn("score", F.round("score", SCORE_DIGITS))


def match_search_stored(spark, sf_dir):
    index = written_copy(spark, sf_dir)
    hits = search.match_search(index, "doc_id", "text", SEARCH_TEXT, stored_terms="text_terms")
    return hits.withColumn("score", F.round("score", SCORE_DIGITS))


# Scoring ---------------------------------------------------------------------------------------

def scored_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (field, term, n): one tag field and three text fields, each from its own table."""
    titles = pages(spark, sf_dir).select(extract_posting(F.col("html"), PAGE_SELECTORS)["title"].alias("title"))
    conversations = table(spark, sf_dir, "conversations", "text")
    return incremental.concat_batches([
        scoring.field_terms(part_tags(table(spark, sf_dir, "part")), {"tags": text.analyze_tags("tags")}).withColumn("n", F.lit(1).cast("long")),
        scoring.field_parts(documents(spark, sf_dir), "document", "text"),
        scoring.field_parts(conversations, "conversation", "text"),
        scoring.field_terms(titles, {"title": text.analyze("title", distinct=True)}).withColumn("n", F.lit(1).cast("long")),
    ])


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark texts as dictionary lines, duplicates included."""
    items = table(spark, sf_dir, "benchmark", "text")
    lines = items.select(F.explode(text.tokenize("text")).alias("token"))
    return dictionary_lines(lines.select(F.concat("token", F.lit("  ")).alias("value")))


def weighted_points(spark, sf_dir):
    return scoring.weighted_points(scored_terms(spark, sf_dir), SCORED_FIELDS)


def weighted_points_buckets(spark, sf_dir):
    return scoring.weighted_points(scored_terms(spark, sf_dir), SCORED_FIELDS, buckets=counts.TERM_BUCKETS)


def term_scoring(spark, sf_dir):
    points = scoring.weighted_points(scored_terms(spark, sf_dir), SCORED_FIELDS, tag_field="tags")
    return scoring.classify(points, dictionary(spark, sf_dir)).select("term", "points", "class")


def tag_points(spark, sf_dir):
    return scoring.tag_points(term_scoring(spark, sf_dir))


def other_points(spark, sf_dir):
    return scoring.other_points(term_scoring(spark, sf_dir))


def posting_scores(spark, sf_dir):
    silver = pages(spark, sf_dir).select(extract_posting(F.col("html"), PAGE_SELECTORS).alias("posting"))
    scored = medallion.score_terms(silver.select("posting.*"), dictionary(spark, sf_dir))
    return scored.select("term", "points", "class")


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.term_parts(documents(spark, sf_dir), "text").select("term").distinct()


def term_flags(spark, sf_dir):
    term = F.col("term")
    return document_terms(spark, sf_dir).select(
        "term",
        predicates.is_single_non_ascii(term).alias("single_non_ascii"),
        predicates.has_drop_word(term).alias("drop_word"),
        predicates.is_numeric(term).alias("number"),
        predicates.is_admissible(term).alias("admissible"),
    )


def terms_allowed(spark, sf_dir):
    return scoring.allowed_terms(document_terms(spark, sf_dir), dictionary(spark, sf_dir))


def terms_dropped(spark, sf_dir):
    return scoring.dropped_terms(document_terms(spark, sf_dir), dictionary(spark, sf_dir))


def dictionary_duplicates(spark, sf_dir):
    return duplicate_entries(dictionary(spark, sf_dir))


def dictionary_sorted(spark, sf_dir):
    return sorted_entries(dictionary(spark, sf_dir))


# Incremental -----------------------------------------------------------------------------------

def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders newest first: page is the age in days counted backwards, pos the key."""
    return table(
        spark, sf_dir, "orders",
        (-F.unix_date(F.col("o_orderdate").cast("date"))).alias("page"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").alias("id"),
    )


def batch_concat(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderstatus", "o_orderkey", "o_totalprice")
    return incremental.concat_batches([
        orders.where(F.col("o_orderstatus") == status).select(
            F.lit(page).alias("page"), F.col("o_orderkey").alias("pos"), "o_totalprice"
        )
        for page, status in enumerate(["F", "O", "P"], start=1)
    ])


def page_max(spark, sf_dir):
    return incremental.page_max(
        table(spark, sf_dir, "pages", "url"), F.regexp_extract("url", "page=([^&#]*)", 1)
    )


def latest_limit(spark, sf_dir):
    return incremental.first_rows(order_pages(spark, sf_dir), ["page", "pos"], RUN_LIMIT)


def since_marker(spark, sf_dir):
    return incremental.since_marker(order_pages(spark, sf_dir), "id", LAST_SEEN, ["page", "pos"])


def since_marker_absent(spark, sf_dir):
    return incremental.since_marker(order_pages(spark, sf_dir), "id", ABSENT, ["page", "pos"])


def new_rows(spark, sf_dir):
    return incremental.new_rows(order_pages(spark, sf_dir), "id", ["page", "pos"], RUN_LIMIT, LAST_SEEN)


def limited_runs(spark, sf_dir):
    """Three runs over a growing listing, the first two limited to a quarter of all orders; which run took which."""
    orders = order_pages(spark, sf_dir)
    limit = orders.count() // 4
    gaps, taken = incremental.everything(spark), []
    for run, (listed, n) in enumerate([(F.col("page") > -LISTED_UNTIL[0], limit), (F.col("page") > -LISTED_UNTIL[1], limit), (F.lit(True), None)], start=1):
        listing = orders.where(listed)
        taken.append(incremental.rows_in_gaps(listing, "id", ["page", "pos"], gaps, n).select("id", F.lit(run).alias("run")))
        gaps = incremental.next_gaps(listing, "id", ["page", "pos"], gaps, n)
    return incremental.concat_batches(taken)


def high_water_mark(spark, sf_dir):
    return incremental.high_water_mark(order_pages(spark, sf_dir), "id", ["page", "pos"])


def _stored_scores(spark: SparkSession, sf_dir: str, fields: list[scoring.Field]) -> DataFrame:
    """Scores from the term arrays of a written analysed copy."""
    silver = pages(spark, sf_dir).select(extract_posting(F.col("html"), PAGE_SELECTORS).alias("posting"))
    copy = TableSpec(scratch_path(spark, "analysed"))
    write_table(medallion.analysed_copy(silver.select("posting.*")), copy)
    scored = medallion.score_terms(read_table(spark, copy), dictionary(spark, sf_dir), fields, stored=True)
    return scored.select("term", "points", "class")


def posting_scores_stored(spark, sf_dir):
    return _stored_scores(spark, sf_dir, scoring.POSTING_FIELDS)


def posting_scores_strict(spark, sf_dir):
    return _stored_scores(spark, sf_dir, scoring.POSTING_FIELDS_STRICT)


def tag_points_table(spark, sf_dir):
    return ranking.frequency_table(tag_points(spark, sf_dir).withColumnRenamed("points", "n"))


def other_points_table(spark, sf_dir):
    return ranking.frequency_table(other_points(spark, sf_dir).withColumnRenamed("points", "n"))


def keyed_upsert(spark, sf_dir):
    events = table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value")
    early = F.col("event_type").isin("signup", "error", "click")
    return incremental.upsert(events.where(early), events.where(~early), "user_id", ["event_id"])


def written_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with their term arrays, written and read back."""
    copy = TableSpec(scratch_path(spark, "analysed"))
    write_table(medallion.analysed_copy(documents(spark, sf_dir), ("text",), tags=None), copy)
    return read_table(spark, copy)


def analysed_copy(spark, sf_dir):
    return written_copy(spark, sf_dir).select(
        "doc_id", F.size("text_terms").alias("terms"), F.size(F.array_distinct("text_terms")).alias("distinct_terms")
    )


# Streams and jobs ------------------------------------------------------------------------------

def stream_bronze(spark, sf_dir):
    bronze = TableSpec(scratch_path(spark, "bronze"))
    medallion.run_storage(event_records(table_stream(spark, sf_dir, "events")), bronze)
    return bronze_rows(read_table(spark, bronze))


def stream_tag_count(spark, sf_dir):
    gold = TableSpec(scratch_path(spark, "tags"))
    sinks.complete_to_table(counts.tag_count(part_tags(table_stream(spark, sf_dir, "part"))), gold)
    return sinks.read_complete_table(spark, gold)


def stream_tag_update(spark, sf_dir):
    gold = TableSpec(scratch_path(spark, "tags"))
    sinks.update_to_table(counts.tag_count(part_tags(table_stream(spark, sf_dir, "part"))), gold, "tag")
    return sinks.read_keyed_table(spark, gold, "tag")


def stream_row_count(spark, sf_dir):
    total = TableSpec(scratch_path(spark, "total"))
    sinks.count_to_table(table_stream(spark, sf_dir, "lineitem"), total)
    return sinks.read_complete_table(spark, total)


def stream_keyed_upsert(spark, sf_dir):
    index = TableSpec(scratch_path(spark, "index"))
    events = table_stream(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    sinks.upsert_to_table(events, index, "user_id", ["event_id"])
    return sinks.read_keyed_table(spark, index, "user_id")


def stream_keyed_compacted(spark, sf_dir):
    index = TableSpec(scratch_path(spark, "index"))
    events = table_stream(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    sinks.upsert_to_table(events, index, "user_id", ["event_id"])
    sinks.compact_keyed_table(spark, index, "user_id")
    return sinks.read_keyed_table(spark, index, "user_id")


def keyed_point_read(spark, sf_dir):
    """The current rows of a few keys: two batches, a merge between them, one bucket read for each key."""
    index = TableSpec(scratch_path(spark, "index"))
    events = table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "value")
    early = F.col("event_type").isin("signup", "error", "click")
    for batch, rows in enumerate([events.where(early), events.where(~early)]):
        keyed.put_batch(incremental.latest_per_key(rows, "user_id", ["event_id"]), index, "user_id", batch)
        if batch == 0:
            keyed.merge_buckets(spark, index, "user_id")
    return sinks.read_keyed_table(spark, index, "user_id", READ_USERS)


def analysed_changes(spark, sf_dir):
    """An analysed copy of the documents, refreshed after a second batch has replaced and added some."""
    index, copy = TableSpec(scratch_path(spark, "index")), TableSpec(scratch_path(spark, "analysed"))
    docs = documents(spark, sf_dir)
    first = docs.where(F.col("doc_id") % 4 != 3).withColumn("text", F.when(F.col("doc_id") % 4 == 2, "old text").otherwise(F.col("text")))
    for batch, rows in enumerate([first, docs.where(F.col("doc_id") % 4 > 1)]):
        keyed.put_batch(rows, index, "doc_id", batch)
        medallion.refresh_analysed_copy(spark, index, copy, "doc_id", text_fields=("text",), tags=None)
    sizes = [F.size("text_terms").alias("terms"), F.size(F.array_distinct("text_terms")).alias("distinct_terms")]
    return sinks.read_keyed_table(spark, copy, "doc_id", columns=sizes)


def _run_lake(spark: SparkSession, sf_dir: str, **options) -> tuple[medallion.Lakehouse, DataFrame]:
    lake = medallion.Lakehouse(scratch_path(spark, "lake"))

    def send(postings: DataFrame) -> None:
        numbered = postings.select((F.col("page") * 20 + F.col("pos")).alias("page_id"), F.col("raw").alias("html"))
        write_table(page_records(numbered), lake.records, "append")

    weights = medallion.run_all(
        spark, lake, fetched_pages(spark, sf_dir), F.lit(PAGE_SOURCE), send,
        lambda: read_record_files(spark, lake.records.data_path), PAGE_SELECTORS, **options,
    )
    return lake, weights


def medallion_flow(spark, sf_dir):
    _, weights = _run_lake(spark, sf_dir)
    return weights.withColumn("weight", F.round("weight", SCORE_DIGITS))


def medallion_silver(spark, sf_dir):
    lake, _ = _run_lake(spark, sf_dir)
    return posting_row(read_table(spark, lake.silver))


def medallion_index(spark, sf_dir):
    lake, _ = _run_lake(spark, sf_dir)
    return posting_row(sinks.read_keyed_table(spark, lake.index, "id"))


def medallion_together(spark, sf_dir):
    """Silver rows of whole batches, where one stream writes silver, index and counts."""
    lake, _ = _run_lake(spark, sf_dir, processing=medallion.run_processing_together, files_per_batch=1)
    return posting_row(read_batches(spark, lake.silver_batches, lake.commits))


def medallion_together_weights(spark, sf_dir):
    _, weights = _run_lake(spark, sf_dir, processing=medallion.run_processing_together, files_per_batch=1)
    return weights.withColumn("weight", F.round("weight", SCORE_DIGITS))


def integration_messages(spark, sf_dir):
    collected = TableSpec(scratch_path(spark, "collected"))
    postings = medallion.run_integration(
        fetched_pages(spark, sf_dir), F.lit(PAGE_SOURCE), collected, PAGE_SELECTORS, None, LAST_SEEN_PAGE
    )
    return medallion.posting_messages(postings, "run 1").select(
        F.md5(records.decode_payload(F.col("value").cast("string"))).alias("raw_md5"),
        *[F.col("headers")[i]["key"].alias(f"header{i + 1}") for i in range(2)],
        *[F.col("headers")[i]["value"].cast("string").alias(f"value{i + 1}") for i in range(2)],
    )


def table_rows(spark, sf_dir):
    return table_report(table(spark, sf_dir, "lineitem")).select("row_count")


def table_partitions(spark, sf_dir):
    """Partitions and rows of a table dealt to eight partitions."""
    return table_report(table(spark, sf_dir, "lineitem").repartition(REPORT_PARTITIONS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        bronze_projection, raw_values, surrogate_id, payload_decode, json_to_columns, html_extract, newline_strip,
        abnormal_records, content_id, row_label,
        tag_count, company_count, row_count, keyword_count, frequency_table, frequency_table_top, frequency_map,
        tokenize, token_word_count, stopwords_english, stopwords_vietnamese, shingles, number_blank, analyze_text,
        tag_terms, term_count, term_count_min3, term_count_min10, frequent_terms, term_buckets, term_top, word_frequency,
        word_frequency_stop, most_frequent, relative_weight, match_search,
        match_search_stored, match_search_many,
        weighted_points, weighted_points_buckets, term_scoring, tag_points, other_points, posting_scores,
        posting_scores_stored, posting_scores_strict, tag_points_table, other_points_table, term_flags,
        terms_allowed, terms_dropped, dictionary_duplicates, dictionary_sorted,
        batch_concat, page_max, latest_limit, since_marker, since_marker_absent, new_rows, limited_runs, high_water_mark,
        keyed_upsert, keyed_point_read, analysed_copy, analysed_changes,
        stream_bronze, stream_tag_count, stream_tag_update, stream_row_count, stream_keyed_upsert, stream_keyed_compacted,
        medallion_flow, medallion_silver, medallion_index, medallion_together, medallion_together_weights, integration_messages,
        table_rows, table_partitions,
    ]
}
