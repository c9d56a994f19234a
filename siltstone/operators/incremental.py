"""Incremental collection: page batches, cuts at a last-seen row, keyed replacement."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.predicates import is_digits
from siltstone.session import scratch_path


def concat_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All batches in one table; the order lives in their page and position columns."""
    return reduce(DataFrame.unionByName, batches)


def page_max(df: DataFrame, label: Column) -> DataFrame:
    """Largest page number among the labels that are numbers."""
    return df.select(label.alias("label")).where(is_digits(F.col("label"))).agg(
        F.max(F.col("label").try_cast("bigint")).alias("page_num")
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first n rows in the given order; all rows without a limit (none, or 0)."""
    return df.orderBy(*order).limit(n) if n else df


def since_marker(df: DataFrame, row_id: str, marker: int | str | None, order: Sequence[str]) -> DataFrame:
    """Rows before the first occurrence of the last-seen id; all rows without marker or match.

    The marker position is one aggregated row, read as a scalar subquery; it is NULL without a
    match. The table is read twice, so give it as a scan or a written table.
    """
    if marker is None:
        return df
    position = F.struct(*order)
    seen = df.where(F.col(row_id) == marker).agg(F.min(position).alias("seen")).scalar()
    return df.where(F.coalesce(position < seen, F.lit(True)))


def high_water_mark(df: DataFrame, row_id: str, order: Sequence[str]) -> DataFrame:
    """One row with the id of the first row: the marker of the next run."""
    return df.agg(F.min_by(row_id, F.struct(*order)).alias("marker"))


def new_rows(df: DataFrame, row_id: str, order: Sequence[str], n: int | None, marker: int | str | None) -> DataFrame:
    """The limit, then the cut at the marker."""
    return since_marker(first_rows(df, order, n), row_id, marker, order)


# Gaps ------------------------------------------------------------------------------------------
#
# A listing has its newest rows first and grows at its top. A run with a limit leaves open what lies
# between its last row and the newest row of the run before. Open gaps are kept by the ids around them,
# as positions shift from run to run.

#: Rows above and below a gap that hold its place; one of each has to be in the next listing.
ANCHORS = 20
#: ``above``: ids of collected rows just above the gap, ``below``: of those just below; empty without bound.
GAPS = "gap int, above array<string>, below array<string>"


def everything(spark: SparkSession, below: Sequence[str] = ()) -> DataFrame:
    """The gaps before the first run: one from the top to the end, or to the rows ``below`` (as ids of :func:`positions`)."""
    return spark.createDataFrame([(0, [], list(below))], GAPS)


def positions(df: DataFrame, row_id: str, order: Sequence[str]) -> DataFrame:
    """(id, at): the rows of a listing and their positions.

    A row whose id occurs again is numbered from the end of the listing, which stays when it grows at its
    top, so every row has an id of its own.
    """
    from_end = Window.partitionBy("id").orderBy(F.desc("at"))
    rows = df.select(F.coalesce(F.col(row_id).cast("string"), F.lit("")).alias("id"), F.struct(*order).alias("at")).distinct()
    return rows.select(F.concat("id", F.lit("#"), F.row_number().over(from_end)).alias("id"), "at")


def gap_bounds(listing: DataFrame, gaps: DataFrame) -> DataFrame:
    """The gaps with their bounds in a listing of (id, at); a bound none of whose ids is listed is open."""
    sides = [gaps.select("gap", F.lit(side).alias("side"), F.explode(side).alias("id")) for side in ("above", "below")]
    found = sides[0].union(sides[1]).join(listing, "id").groupBy("gap").agg(
        F.max(F.when(F.col("side") == "above", F.col("at"))).alias("low"),
        F.min(F.when(F.col("side") == "below", F.col("at"))).alias("high"),
    )
    return gaps.join(found, "gap", "left")


def open_rows(listing: DataFrame, bounds: DataFrame) -> DataFrame:
    """The rows of a listing that lie in a gap.

    The bounds are few (each run adds one gap at most) and are read as one array, so the listing is
    neither joined nor shuffled.
    """
    intervals = bounds.agg(F.collect_list(F.struct("low", "high")).alias("gaps")).scalar()
    at = F.col("at")
    inside = F.exists("_gaps", lambda g: F.coalesce(at > g["low"], F.lit(True)) & F.coalesce(at < g["high"], F.lit(True)))
    return listing.withColumn("_gaps", intervals).where(inside).drop("_gaps")


def rows_in_gaps(df: DataFrame, row_id: str, order: Sequence[str], gaps: DataFrame, n: int | None = None) -> DataFrame:
    """The first n rows (all without a limit) that lie in an open gap.

    Only ids and positions are sorted; whole rows are filtered by the gaps and by the last position taken.
    ``df`` is read several times, so give it as a scan or a written table. Rows of one position are one.
    """
    listing = positions(df, row_id, order)
    bounds = gap_bounds(listing, gaps)
    rows = open_rows(df.withColumn("at", F.struct(*order)), bounds)
    if n:
        rows = rows.where(F.col("at") <= first_rows(open_rows(listing, bounds), ["at"], n).agg(F.max("at")).scalar())
    return rows.drop("at")


def next_gaps(df: DataFrame, row_id: str, order: Sequence[str], gaps: DataFrame, n: int | None = None) -> DataFrame:
    """The gaps after a run of :func:`rows_in_gaps` with the same arguments.

    A gap whose rows were all taken is closed, the one in which the limit fell is narrowed to what is
    below it, those further down stay. The gap at the top always stays open: it is bounded by the first
    collected rows of this listing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "listing")
    positions(df, row_id, order).write.parquet(path)
    listing = spark.read.parquet(path)
    bounds = gap_bounds(listing, gaps)
    inside = open_rows(listing, bounds)
    # The last row taken and the first one left: two positions, read together.
    taken = first_rows(inside, ["at"], n)
    last = taken.agg(F.max("at").alias("last")).scalar()
    left = inside.where(F.coalesce(F.col("at") > last, F.lit(True)))
    edge = spark.range(1).select(last.alias("last"), left.agg(F.min("at")).scalar().alias("left")).first()
    near = lambda rows, by: [r["id"] for r in rows.orderBy(by).limit(ANCHORS).collect()]
    if edge["left"] is None:
        below = near(listing, F.asc("at"))
        return everything(spark, below) if below else gaps
    # Bounds as comparable tuples; an open bound lies beyond all positions.
    old = [(tuple(r["low"]) if r["low"] else None, tuple(r["high"]) if r["high"] else None, r["above"], r["below"]) for r in bounds.collect()]
    cut, rest = tuple(edge["last"]), tuple(edge["left"])
    kept = []
    for low, high, above, below in old:
        if high is not None and high <= rest:
            continue  # nothing of it is left
        if low is None or low < cut:
            above = near(taken, F.desc("at"))
        kept.append((above, below))
    collected = listing.where(F.col("at") < F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(rest, listing.schema["at"].dataType.fields)]))
    top = ([], near(collected, F.asc("at")))
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([top, *kept])], GAPS)


def when_any(df: DataFrame, next_step: Callable[[DataFrame], object]) -> bool:
    """Run the next step only if there are rows; tells whether it ran."""
    if df.isEmpty():
        return False
    next_step(df)
    return True


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the last one in the order.

    A ``max_by`` aggregation, so a key with very many versions is reduced to one row per task
    before the shuffle.
    """
    others = [name for name in df.columns if name != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
        .select(*[key if name == key else F.col("_row")[name].alias(name) for name in df.columns])
    )


def upsert(current: DataFrame, changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Current rows with those of a changed key replaced by its last change."""
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return latest_per_key(both, key, ["_new", *order]).drop("_new")
