"""Match search: documents with any of the query terms, ranked by BM25."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.text import analyze
from siltstone.session import scratch_path

# The public BM25 defaults and the number of hits shown.
BM25_K1 = 1.2
BM25_B = 0.75
HITS = 10


def term_listing(df: DataFrame, key: str, text: str, analyzer: Callable[[Column], Column] = analyze) -> DataFrame:
    """One row per term of every text: key, pos, term."""
    return df.select(key, F.posexplode(analyzer(F.col(text))).alias("pos", "term"))


def analyze_text(spark: SparkSession, text: str, analyzer: Callable[[Column], Column] = analyze) -> DataFrame:
    """The terms of one ad-hoc text: pos, term."""
    return term_listing(spark.range(1).select("id", F.lit(text).alias("text")), "id", "text", analyzer).drop("id")


def match_search(
    df: DataFrame,
    doc_id: str,
    text: str,
    query: str,
    analyzer: Callable[[Column], Column] = analyze,
    k: int = HITS,
    stored_terms: str | None = None,
) -> DataFrame:
    """The k best documents for the query as (doc_id, score), ties by id.

    ``stored_terms`` names the term array of an analysed table; it then stands for analysing the
    text again. ``doc_id`` is a key of the table.

    The query's terms are a small table, as large as the query, and joined to the terms of every row
    where it is read. What is left, one row per document and one per term found in it, is written to
    the scratch folder, because corpus statistics and scores both need it. Scoring shuffles hits only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "postings")
    wanted = analyze_text(spark, query, analyzer).select("term").distinct().withColumn("_wanted", F.lit(True))
    terms_of_row = F.col(stored_terms) if stored_terms else analyzer(F.col(text))
    # The row without a term stands for the document itself.
    with_itself = F.concat(F.array(F.lit(None).cast("string")), "_terms")
    (
        df.select(doc_id, terms_of_row.alias("_terms"))
        .select(doc_id, F.size("_terms").alias("_length"), F.explode(with_itself).alias("term"))
        .join(F.broadcast(wanted), "term", "left")
        .where(F.col("term").isNull() | F.col("_wanted"))
        .groupBy(doc_id, "_length", "term").agg(F.count("*").alias("_tf"))
        .write.parquet(path)
    )
    found = spark.read.parquet(path).where(F.col("_length") > 0)
    hits = found.where(F.col("term").isNotNull())
    stats = found.where(F.col("term").isNull()).agg(
        F.struct(F.count("*").alias("docs"), F.avg("_length").alias("length"))
    ).scalar()
    having = hits.groupBy("term").agg(F.count("*").alias("_having"))

    idf = F.log1p((F.col("_stats")["docs"] - F.col("_having") + 0.5) / (F.col("_having") + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * F.col("_length") / F.col("_stats")["length"])
    part = F.struct("term", (idf * F.col("_tf") / (F.col("_tf") + norm)).alias("part"))
    # Summed up in the order of the terms, so that equal documents have equal scores.
    parts = F.array_sort(F.collect_list(part))
    return (
        hits.join(F.broadcast(having), "term")
        .withColumn("_stats", stats)
        .groupBy(doc_id).agg(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x["part"]).alias("score"))
        .orderBy(F.desc("score"), F.asc(doc_id))
        .limit(k)
    )


def match_search_many(
    df: DataFrame,
    doc_id: str,
    text: str,
    queries: DataFrame,
    query_id: str,
    query: str,
    analyzer: Callable[[Column], Column] = analyze,
    k: int = HITS,
    stored_terms: str | None = None,
) -> DataFrame:
    """The k best documents of every query as (query_id, rank, doc_id, score), as so many single searches would give.

    Rows of one ``query_id`` are one query. A query without text, terms or hits has no rows. Texts are analysed once:
    only rows of terms that some query asks for, and one row per document for the statistics, are shuffled, by document
    and term, and written. The k best of a query are taken in every
    task before what is left is sent to the query's task: k rows of each, however many documents it hits. No side is
    forced to be broadcast, as queries can be many; a term in most documents is scored once for each query that has it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "hits")
    terms = F.col(stored_terms) if stored_terms else analyzer(F.col(text))
    asked = queries.select(F.col(query_id).alias("_query"), F.explode(analyzer(F.col(query))).alias("term")).distinct()
    wanted = asked.select(F.col("term").alias("_wanted")).distinct()
    # The row without a term stands for the document itself; its key in the join is the id, so that these rows are spread.
    with_itself = F.concat(F.array(F.lit(None).cast("string")), F.array_compact("_terms"))
    key = F.coalesce("term", F.col("_doc").cast("string"))
    (
        df.select(F.col(doc_id).alias("_doc"), terms.alias("_terms"))
        .select("_doc", F.size("_terms").alias("_length"), F.explode(with_itself).alias("term"))
        .join(wanted, key == F.col("_wanted"), "left")
        .where(F.col("term").isNull() | F.col("_wanted").isNotNull())
        .groupBy("_doc", "_length", "term").agg(F.count("*").alias("_tf"))
        .write.parquet(path)
    )
    found = spark.read.parquet(path)
    hits = found.where(F.col("term").isNotNull())
    # Rows of one id and length are one row here, with their number.
    docs, total = F.sum("_tf"), F.sum(F.col("_tf") * F.col("_length"))
    with_terms = found.where(F.col("term").isNull() & (F.col("_length") > 0))
    stats = with_terms.agg(F.struct(docs.alias("docs"), (total / docs).alias("length"))).scalar()
    having = hits.groupBy("term").agg(F.count("*").alias("_having"))
    idf = F.log1p((F.col("_stats")["docs"] - F.col("_having") + 0.5) / (F.col("_having") + 0.5))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * F.col("_length") / F.col("_stats")["length"])
    part = F.struct("term", (idf * F.col("_tf") / (F.col("_tf") + norm)).alias("part"))
    parts = F.array_sort(F.collect_list(part))  # one per term of the query
    scores = (
        hits.join(asked.join(having, "term"), "term")
        .withColumn("_stats", stats)
        .groupBy("_query", "_doc").agg(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x["part"]).alias("score"))
    )
    best = Window.partitionBy("_query").orderBy(F.desc("score"), F.asc("_doc"))
    ranked = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("_query").alias("query_id"), "rank", F.col("_doc").alias("doc_id"), "score")
