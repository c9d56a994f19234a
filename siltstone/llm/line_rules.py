"""Quality rules with cross-document line frequency, with DataFrame operations only.

Base counts are made inside each row. ``n_repeat_words`` hashes every five-word window; only a text in
which two hashes are equal sorts them, and adds up the places under windows found twice or more.

Line rule. A line is normalised (lower case, digits as 0, other than letters and digits as one space)
and hashed. Lines are counted in distinct texts per host (the source of a document; copies of one text
count once). A line in more than ``MOST`` distinct texts, and in more than ``MOST_SHARE`` of the host's,
is boilerplate: it is removed. A document whose words are then fewer than
``LEAST_LEFT`` of before is depleted and rejected, like one that fails the base rules. (Short lines
weigh little, so a document with some boilerplate stays.) ``line_rules`` gives the numbers of the removed lines
beside its verdict, and ``without_boilerplate`` the documents that are kept, without those lines.

Scale. The hashes of the lines are made once and written. Lines are counted by (host, line, text digest) with map-side aggregation, then by (host, line):
the result is small. Rows meet the boilerplate lines salted by ``SALTS``, so a line that every third
document has is dealt to many tasks.

Defined cases: a null or empty text has no words and fails. A null source is a host of its own. Rows are
told apart by id and text; repeated rows get the same result each. Extra columns are ignored, or kept by
``without_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import written

LEAST_WORDS, MOST_REPEAT = 10, 20
MOST, MOST_SHARE = 10, 0.002
LEAST_LEFT = 0.3
SALTS = 16

_SPACE = r"[ \t-\r]"
_SYMBOLS = "#*$%&|<>"


def _base(documents: DataFrame) -> DataFrame:
    """doc_id, source, digest, lines with a word and the base counts of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), text.alias("text"))
    solid = F.translate("text", " \t\n\x0b\x0c\r", "")
    flat = F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    rows = rows.select(
        "doc_id", "host", F.xxhash64("text").alias("digest"), F.char_length(solid).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"), F.split(flat, " +").alias("w"))
    rows = rows.withColumn("n_words", F.when(F.col("word_chars") == 0, 0).otherwise(F.size("w")).cast("long"))
    window = ", ".join(f"w[i + {j}]" for j in range(5))
    rows = rows.withColumn("g", F.expr(f"CASE WHEN size(w) >= 5 THEN transform(sequence(0, size(w) - 5), i -> xxhash64({window})) ELSE array() END"))
    # Windows that are found again: sorted by (hash, place), equal neighbours, back in order of place.
    # A place adds the words up to the next one, five at most.
    repeat = F.expr("""CASE WHEN size(g) = size(array_distinct(g)) THEN 0 ELSE
        aggregate(array(array_sort(transform(g, (h, i) -> struct(h AS h, i AS i)))), 0, (n0, s) -> n0 +
          aggregate(array(array_sort(transform(filter(sequence(0, size(s) - 1),
              j -> (j > 0 AND s[greatest(j - 1, 0)].h = s[j].h) OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].h = s[j].h)), j -> s[j].i))), 0, (n1, p) -> n1 +
            aggregate(transform(p, (x, k) -> IF(k = size(p) - 1, 5, least(5, p[least(k + 1, size(p) - 1)] - x))), 0, (a, b) -> a + b))) END""")
    return rows.select(
        "doc_id", "host", "digest", "lines", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeat.cast("long").alias("n_repeat_words"))


def _normal(line):
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{N}", "0"), r"[^\p{L}0]+", " "))


def _lines(documents: DataFrame) -> DataFrame:
    """doc_id, host, digest, number and hash of the normalised line, and its characters without white space."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(text).alias("digest"), F.posexplode(F.split(text, "\n")).alias("no", "raw"))
    chars = F.char_length(F.translate("raw", " \t\n\x0b\x0c\r", ""))
    rows = rows.select("doc_id", "host", "digest", "no", _normal(F.col("raw")).alias("normal"), chars.alias("chars"))
    return rows.filter("normal <> ''").select("doc_id", "host", "digest", "no", F.xxhash64("normal").alias("line"), "chars")


def _judged(documents: DataFrame) -> DataFrame:
    """What ``line_rules`` returns, with host and digest of every row."""
    base = _base(documents).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT * F.col("n_words"))).drop("lines")
    lines = written(_lines(documents), "lines")
    texts = documents.select(F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
    hosts = texts.groupBy("host").agg(F.countDistinct("digest").alias("texts"))
    seen = lines.select("host", "line", "digest").distinct().groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > MOST)
    often = seen.join(hosts, "host").filter(F.col("n") > MOST_SHARE * F.col("texts")).select("host", "line")
    often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lines.withColumn("salt", F.pmod(F.hash("doc_id", "digest"), F.lit(SALTS)))
    # A set of lines: repeated rows have the same.
    gone = salted.join(often, ["host", "line", "salt"]).groupBy("doc_id", "host", "digest").agg(F.array_sort(F.collect_set(F.struct("no", "chars"))).alias("lines"))
    gone = gone.select(F.col("doc_id").alias("id"), F.col("host").alias("own_host"), F.col("digest").alias("own"), F.col("lines.no").alias("removed"),
                       F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["chars"]).alias("gone"))
    joined = base.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own")) & (F.col("host") == F.col("own_host")), "left")
    left = F.when(F.col("word_chars") > 0, 1 - F.coalesce("gone", F.lit(0)) / F.col("word_chars")).otherwise(0.0)
    joined = joined.withColumn("share_left", F.round(left, 6))
    return joined.select(
        "host", "digest", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("share_left") >= LEAST_LEFT)).alias("kept"), "share_left", F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"))


def line_rules(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text, source): the base counts, base_failed, kept, the share of words left, and the numbers (from 0) of removed lines."""
    return _judged(documents).drop("host", "digest")


def without_boilerplate(documents: DataFrame) -> DataFrame:
    """The kept rows of ``documents``, with all their columns, without the boilerplate lines in the text."""
    changed = _judged(documents).filter(~F.col("kept") | (F.size("removed_lines") > 0))
    changed = changed.select(F.struct("doc_id", "host", "digest").alias("changed_row"), "kept", "removed_lines").distinct()
    changed = written(changed.withColumnsRenamed({"kept": "line_kept", "removed_lines": "line_gone"}), "changed")
    text = F.coalesce("text", F.lit(""))
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(text).alias("digest"))
    joined = documents.withColumn("line_row", row).join(changed, F.col("line_row").eqNullSafe(F.col("changed_row")), "left").filter(F.coalesce("line_kept", F.lit(True)))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("line_gone", i)), "\n")
    return joined.withColumn("text", F.when(F.size("line_gone") > 0, left).otherwise(F.col("text"))).select(*documents.columns)


ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS raw FROM docs),
grams AS (SELECT r, unnest(range(greatest(len(w) - 4, 0))) AS pos, w FROM words),
windows AS (SELECT r, pos, list_slice(w, pos + 1, pos + 5) AS g FROM grams),
again AS (SELECT r, pos FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeated AS (SELECT r, count(DISTINCT pos + j) AS n FROM again, (SELECT unnest(range(5)) AS j) GROUP BY r),
raw_lines AS (SELECT r, host, text, unnest(raw) AS line FROM words),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
lines AS (SELECT r, host, text, trim(regexp_replace(regexp_replace(lower(line), '\pN', '0', 'g'), '[^\pL0]+', ' ', 'g')) AS normal,
  len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars FROM raw_lines),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM docs GROUP BY host),
often AS (SELECT host, normal FROM lines JOIN hosts USING (host) WHERE normal <> '' GROUP BY host, normal, texts HAVING count(DISTINCT text) > {MOST} AND count(DISTINCT text) > {MOST_SHARE} * texts),
gone AS (SELECT r, sum(chars) AS n FROM lines JOIN often USING (host, normal) GROUP BY r),
counts AS (SELECT words.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS gone
  FROM words LEFT JOIN dup USING (r) LEFT JOIN repeated USING (r) LEFT JOIN gone USING (r)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEAT} * n_words AS base_failed,
  round(CASE WHEN word_chars > 0 THEN 1 - gone / word_chars ELSE 0.0 END, 6) AS share_left FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND share_left >= {LEAST_LEFT} AS kept, share_left FROM judged"""
