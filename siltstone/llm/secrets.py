"""Secret scans with character Markov models, with DataFrame operations only.

Base patterns find assignments to telling names, access keys and hexadecimal runs. Further candidates are
maximal runs of at least ``LEAST_RUN`` characters of ``[A-Za-z0-9+/_=-]``. A base match may cover only a part of one:
the parts under base matches are labelled samples of random strings, the parts outside, if they have ``LEAST_RUN``
characters again, of ordinary identifiers: their character pairs, counted over
all distinct samples of the corpus, train two first-order models. A part outside base matches is a secret if
its log-likelihood ratio is at least ``LEAST_RATIO``, and ``LEAST_MEAN`` for each pair.

Places come without a position function: the pieces between matches and the matches themselves are
measured, and summed up in order within a document. Only matches are shuffled, never texts.

The models are one array of 128 x 128 numbers in the plan, whatever the input. Without samples of
both kinds the models add nothing.

Defined cases: null and empty texts have no spans. Rows are told apart by id and text; repeated rows
get the same result each, rows without id too. Overlapping spans of different kinds are all listed, and
redacted together. Extra columns are ignored by ``secret_scan`` and kept by ``redacted``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import BROADCAST_ROWS, written

LEAST_RUN, LEAST_RATIO, LEAST_MEAN = 16, 12.0, 0.5
#: Weight of the characters' frequencies in those of the pairs, and of an even spread in the former.
BACK_OFF, SMOOTH = 20.0, 0.5
MASK = "[secret]"

# The base patterns and the least lengths of what they find.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ["assign", "access", "hex", "markov"]
LEAST_VALUE = 12
PATTERNS = [ASSIGN, "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"]


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("own_id", F.col("doc_id").cast("long")).withColumn("digest", F.xxhash64("text"))


def _measured(kind: int):
    return lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("no"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["match"]).alias("size"), x["value"].alias("value"))


def _parts(placed: DataFrame) -> DataFrame:
    """doc_id, digest, start, end, value, touched: the parts of candidates under base matches, and those outside that are long enough."""
    base = F.col("kind") < len(KINDS) - 1
    # One sweep over the ends of a document's spans: how many base matches and candidates are open from each to the next.
    edge = lambda at, step: F.struct(F.col(at).alias("at"), F.when(base, step).otherwise(0).alias("base"), F.when(base, 0).otherwise(step).alias("run"))
    edges = placed.select("doc_id", "digest", F.explode(F.array(edge("start", 1), edge("end", -1))).alias("e")).select("doc_id", "digest", "e.*")
    order = Window.partitionBy("doc_id", "digest").orderBy("at")
    past = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = edges.select(
        "doc_id", "digest", F.col("at").alias("start"), F.lead("at").over(order).alias("end"), (F.sum("base").over(past) > 0).alias("touched"),
        F.sum("run").over(past).alias("open"), F.max(F.when(F.col("run") > 0, F.col("at"))).over(past).alias("first")).filter("open > 0 and start < end")
    order = Window.partitionBy("doc_id", "digest").orderBy("start")
    new = F.coalesce((F.lag("first").over(order) != F.col("first")) | (F.lag("touched").over(order) != F.col("touched")), F.lit(True))
    pieces = pieces.withColumn("new", new.cast("int")).withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pieces = pieces.groupBy("doc_id", "digest", "first", "part", "touched").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    both = pieces.select("doc_id", "digest", "first", F.struct("start", "end", "touched").alias("own"), F.lit(None).cast("string").alias("value")).unionByName(
        placed.filter(~base).select("doc_id", "digest", F.col("start").alias("first"), "value"), allowMissingColumns=True)
    whole = both.groupBy("doc_id", "digest", "first").agg(F.collect_list("own").alias("own"), F.max("value").alias("value"))
    out = whole.select("doc_id", "digest", "first", "value", F.explode("own").alias("own")).select("doc_id", "digest", "first", "value", "own.*")
    size = (F.col("end") - F.col("start")).cast("int")
    out = out.withColumn("value", F.substr("value", (F.col("start") - F.col("first") + 1).cast("int"), size))
    return out.filter((F.col("touched") & (size > 1)) | (size >= LEAST_RUN)).select("doc_id", "digest", "start", "end", "value", "touched")


def found_spans(documents: DataFrame) -> DataFrame:
    """doc_id, digest, kind (its number), start, end, value of all base matches and parts of candidates, and whether a part is under a base match."""
    rows = _keyed(documents).select(F.col("own_id").alias("doc_id"), "digest", "text").filter("text <> ''")
    kinds = []
    for number, pattern in enumerate(PATTERNS):
        find = F.lit(pattern)
        value = F.regexp_extract_all("text", find, F.lit(2 if number == 0 else 0))
        matches = F.regexp_extract_all("text", find, F.lit(0)) if number == 0 else value
        kinds.append(F.when(F.col("text").rlike(pattern), F.transform(
            F.arrays_zip(F.split("text", pattern, -1).alias("gap"), matches.alias("match"), value.alias("value")),
            _measured(number))))
    nothing = F.expr("cast(array() as array<struct<kind: int, no: int, gap: int, size: int, value: string>>)")
    all_kinds = F.concat(*(F.coalesce(k, nothing) for k in kinds))
    exploded = rows.select("doc_id", "digest", F.explode(all_kinds).alias("m")).select("doc_id", "digest", "m.*").filter("value is not null")
    own = exploded.repartition("doc_id", "digest").dropDuplicates(["doc_id", "digest", "kind", "no"])
    before = Window.partitionBy("doc_id", "digest", "kind").orderBy("no")
    placed = own.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.filter((F.col("kind") > 0) | (F.char_length("value") >= LEAST_VALUE))
    placed = written(placed.select("doc_id", "digest", "kind", "start", "end", "value"), "matches")
    markov = len(KINDS) - 1
    base = placed.filter(F.col("kind") < markov).withColumn("value", F.lit(None).cast("string")).withColumn("touched", F.lit(True))
    return base.unionByName(_parts(placed).withColumn("kind", F.lit(markov)))


def ratios(spans: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of ASCII characters, by 128 * first + second."""
    samples = spans.filter(F.col("value").isNotNull()).select("touched", "value").distinct()
    pairs = samples.select("touched", F.explode(F.expr("transform(sequence(1, char_length(value) - 1), i -> substr(value, i, 2))")).alias("pair"))
    counted = pairs.groupBy("touched", "pair").agg(F.count("*").alias("n")).collect()  # at most 2 x 66 x 66 rows
    models = {True: {}, False: {}}
    for r in counted:
        # An unknown secret is among the ordinary samples: a pair of one sample alone is no evidence there.
        models[r["touched"]][r["pair"]] = r["n"] if r["touched"] else r["n"] - 1
    if not models[True] or not models[False]:
        return []
    alphabet = sorted({c for m in models.values() for pair in m for c in pair})
    out = [0.0] * (128 * 128)
    logs = {}
    for label, model in models.items():
        after, single = dict.fromkeys(alphabet, 0), dict.fromkeys(alphabet, SMOOTH)
        for pair, n in model.items():
            after[pair[0]] += n
            single[pair[1]] += n
        all_ = sum(single.values())
        logs[label] = {a + b: math.log((model.get(a + b, 0) + BACK_OFF * single[b] / all_) / (after[a] + BACK_OFF)) for a in alphabet for b in alphabet}
    for pair in logs[True]:
        out[128 * ord(pair[0]) + ord(pair[1])] = round(logs[True][pair] - logs[False][pair], 6)
    return out


def _verdict(table: list[float]) -> Column:
    """Whether a candidate's ratio is that of a random string."""
    if not table:
        return F.lit(False)
    pair = lambda i: F.get(F.col("weights"), F.ascii(F.substr("value", i, F.lit(1))) * 128 + F.ascii(F.substr("value", i + 1, F.lit(1))))
    total = F.aggregate(F.sequence(F.lit(1), F.char_length("value") - 1), F.lit(0.0), lambda s, i: s + pair(i))
    return (total >= LEAST_RATIO) & (total >= LEAST_MEAN * (F.char_length("value") - 1))


def secret_spans(documents: DataFrame) -> DataFrame:
    """doc_id, digest, kind (its number), start, end of every secret; places are code points."""
    spans = written(found_spans(documents), "spans")
    table = ratios(spans)
    if table:
        spans = spans.withColumn("weights", F.from_json(F.lit(str(table)), "array<double>"))
    markov = len(KINDS) - 1
    secret = spans.filter((F.col("kind") < markov) | (~F.col("touched") & _verdict(table)))
    return secret.select("doc_id", "digest", "kind", "start", "end")


def secret_scan(documents: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    spans = secret_spans(documents)
    kinds = F.array(*map(F.lit, KINDS))
    listed = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])
    own = F.struct("start", "kind", "end")
    all_ = F.array_sort(F.collect_list(own))
    base = F.array_sort(F.collect_list(F.when(F.col("kind") < len(KINDS) - 1, own)))
    found = spans.groupBy("doc_id", "digest").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(3)), base.alias("base"), all_.alias("all"))
    found = found.select(
        F.col("doc_id").alias("id"), F.col("digest").alias("own"), "n_assign", "n_access", "n_hex",
        F.sha2(F.array_join(F.transform("base", listed), ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("all", listed), ",").alias("spans"))
    rows = _keyed(documents).select(F.col("own_id").alias("doc_id"), "digest")
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own")), "left")
    count = [F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS[:3]]
    return joined.select("doc_id", *count, F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redacted(documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all their columns, with ``MASK`` for every run of secrets in the text."""
    spans = written(secret_spans(documents), "secrets")
    places = spans.groupBy(F.col("doc_id").alias("secret_id"), F.col("digest").alias("secret_digest")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("secret_places"))
    if spans.count() <= BROADCAST_ROWS:  # pairs of numbers; with more of them the join shuffles
        places = F.broadcast(places)
    rows = documents.withColumn("secret_row", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("digest")))
    joined = rows.join(places, F.col("secret_row.id").eqNullSafe(F.col("secret_id")) & (F.col("secret_row.digest") == F.col("secret_digest")), "left")
    # Place by place in order: the text up to a span that begins after the last one, and its mask.
    pieces = """aggregate(secret_places, named_struct('at', 0L, 'out', cast(array() as array<string>)), (s, x) -> named_struct(
        'at', greatest(s.at, x.end),
        'out', IF(x.start < s.at, s.out, concat(s.out, array(substr(text, CAST(s.at AS INT) + 1, CAST(x.start - s.at AS INT)))))))"""
    joined = joined.withColumn("secret_pieces", F.when(F.col("secret_places").isNotNull(), F.expr(pieces)))
    rest = F.expr("substr(text, CAST(secret_pieces.at AS INT) + 1)")
    masked = F.concat(F.array_join(F.col("secret_pieces.out"), MASK), F.lit(MASK), rest)
    text = F.when(F.col("secret_places").isNull(), F.col("text")).otherwise(masked)
    return joined.withColumn("text", text).select(*documents.columns)
