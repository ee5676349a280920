"""Window functions that never need a whole group in one task.

A plain window over a hot key (or over no key at all) sorts the whole group in a single
task. Here one range-partitioned sort numbers the rows; every further window then runs
over fixed-size chunks of consecutive numbers:

* ``number_rows``  exact 1..n per group from the sorted slices and their row counts;
* ``chunked``      frames reaching a fixed number of rows back or ahead (lag, lead, moving averages;
                   each chunk also gets copies of its neighbours' edge rows) and prefix sums, counts
                   and maxima (each chunk gets the totals of earlier ones), over one exchange;
                   ``framed`` and ``running`` are either half of it;
* ``ranked``       rank and dense_rank, from the counts of distinct values;
* ``sessions``     runs of rows with no long gap, folded within chunks first.

Top-k filters per group do not need this: for ``row_number() <= k`` Spark prunes to k rows
per group and task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

CHUNK_ROWS = 1_000_000
RN = "rn"


def _group(keys: Sequence[str]) -> Column:
    # A struct compares its NULL fields as equal, so groups with NULL keys join too.
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))


def sort_column(spec: str | Column) -> Column:
    """'-amount' sorts descending, 'amount' ascending; NULLs last in both."""
    if isinstance(spec, Column):
        return spec
    return F.col(spec[1:]).desc_nulls_last() if spec.startswith("-") else F.col(spec).asc_nulls_last()


def sorted_spans(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """Rows in global order with their slice, and one row per (slice, group).

    A span tells where its rows start (``_first``), how many rows and how much weight its group
    has in earlier slices (``_rows_before``, ``_before``), in the slice (``_here``) and in all
    (``_size``). There are at most as many spans as groups and slices together; they are written
    too, so that the planner knows their size and does not shuffle all rows to meet a few spans.
    """
    rows = materialise(
        df.sort(*[F.col(k).asc_nulls_first() for k in keys], *[sort_column(o) for o in order])
          .withColumn("_pos", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_slice", F.shiftright("_pos", 33)).withColumn("_group", _group(keys))
    spans = rows.groupBy("_slice", "_group").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"),
        F.sum(weight if weight else F.lit(1)).alias("_here"))
    group = Window.partitionBy("_group")
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    return rows, materialise(spans.select(
        "_slice", "_group", "_first", "_here",
        F.coalesce(F.sum("_rows").over(earlier), none).alias("_rows_before"),
        F.coalesce(F.sum("_here").over(earlier), none).alias("_before"),
        F.sum("_here").over(group).alias("_size")), "spans")


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = RN) -> DataFrame:
    """Row number 1..n within ``keys`` by ``order``.

    ``order`` should be total: its last columns split runs of equal values over tasks.
    """
    rows, spans = sorted_spans(df, keys, order)
    spans = spans.select("_slice", "_group", (F.col("_first") - F.col("_rows_before")).alias("_base"))
    return (rows.join(spans, ["_slice", "_group"])
            .select(*df.columns, (F.col("_pos") - F.col("_base") + 1).alias(name)))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per group with their count ``_n``; equal values fold before the shuffle."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))


def _chunk(rn: Column, chunk_rows: int) -> Column:
    return F.floor((rn - 1) / chunk_rows)


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    frames: dict[str, Callable[[Window], Column]] | None = None,
    sums: dict[str, str | Column] | None = None,
    maxima: dict[str, str | Column] | None = None,
    before: int = 0,
    ahead: int = 0,
    rn: str = RN,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Frames, prefix sums and prefix maxima over one exchange of the rows.

    ``frames`` maps a name to a function of the ordered window that looks at most ``before`` rows
    back and ``ahead`` rows forward, e.g. ``lambda w: F.lag('x').over(w)``. ``sums`` and ``maxima``
    are prefixes up to and including each row; NULL inputs are skipped, and a prefix without any
    value is NULL. What earlier chunks add up to travels as one head row of each later chunk, so
    the rows themselves are not shuffled a second time to meet it.
    """
    size = chunk_rows or CHUNK_ROWS
    if max(before, ahead) > size:
        raise ValueError("the frame must not be longer than a chunk")
    frames, columns = frames or {}, df.columns
    prefixes = [(f"_p{i}", agg, name, F.col(e) if isinstance(e, str) else e) for i, (agg, name, e) in enumerate(
        [(F.sum, *s) for s in (sums or {}).items()] + [(F.max, *m) for m in (maxima or {}).items()])]
    own = _chunk(F.col(rn), size)
    # A row also belongs to the next chunk if that looks back to it, and to the previous one
    # if that looks ahead to it. Copies are before + ahead rows per chunk.
    targets = F.array_distinct(F.array(
        _chunk(F.greatest(F.col(rn) - ahead, F.lit(1)), size), own, _chunk(F.col(rn) + before, size)))
    rows = df.select("*", _group(keys).alias("_group"), own.alias("_own"), *[e.alias(tmp) for tmp, _, _, e in prefixes])
    out = rows.withColumn("_chunk", F.explode(targets))
    if prefixes:
        totals = rows.groupBy("_group", "_own").agg(*[agg(tmp).alias(tmp) for tmp, agg, _, _ in prefixes])
        earlier = Window.partitionBy("_group").orderBy("_own").rowsBetween(Window.unboundedPreceding, -1)
        # The first chunk of a group has no head. Any other begins with all copies a frame may look back
        # to, so that its head stays outside of the frames of its own rows.
        heads = totals.select("_group", "_own", F.col("_own").alias("_chunk"), F.lit(0).cast(df.schema[rn].dataType).alias(rn),
                              *[agg(tmp).over(earlier).alias(tmp) for tmp, agg, _, _ in prefixes]).filter("_own > 0")
        at_home = F.col("_chunk") == F.col("_own")
        out = out.withColumns({tmp: F.when(at_home, F.col(tmp)).cast(heads.schema[tmp].dataType) for tmp, _, _, _ in prefixes})
        out = out.unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy("_group", "_chunk").orderBy(rn)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    out = out.select("*", *[fn(w).alias(name) for name, fn in frames.items()],
                     *[agg(tmp).over(so_far).alias(name) for tmp, agg, name, _ in prefixes])
    return out.filter((F.col("_chunk") == F.col("_own")) & (F.col(rn) > 0)).select(
        *columns, *frames, *[name for _, _, name, _ in prefixes])


def framed(
    df: DataFrame, keys: Sequence[str], outputs: dict[str, Callable[[Window], Column]],
    before: int = 0, ahead: int = 0, rn: str = RN, chunk_rows: int | None = None,
) -> DataFrame:
    """Window outputs that look at most ``before`` rows back and ``ahead`` rows forward."""
    return chunked(df, keys, outputs, before=before, ahead=ahead, rn=rn, chunk_rows=chunk_rows)


def running(
    df: DataFrame, keys: Sequence[str], sums: dict[str, str | Column] | None = None,
    maxima: dict[str, str | Column] | None = None, rn: str = RN, chunk_rows: int | None = None,
) -> DataFrame:
    """Prefix sums and maxima up to and including each row."""
    return chunked(df, keys, sums=sums, maxima=maxima, rn=rn, chunk_rows=chunk_rows)


def ranked(
    df: DataFrame, keys: Sequence[str], by: str, tiebreak: Sequence[str] = (),
    row_number: str | None = "row_number", rank: str = "rank", dense_rank: str = "dense_rank",
) -> DataFrame:
    """rank and dense_rank by one column, and row_number with ties ordered by ``tiebreak``.

    Ranks depend on the value alone: the distinct values are numbered (dense rank) and their
    counts summed up (rank), then joined to the rows. Only row_number sorts all rows.
    """
    value = by.lstrip("-")
    values, spans = sorted_spans(value_counts(df, keys, value), keys, [by], "_n")
    local = Window.partitionBy("_slice", "_group").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    ranks = values.join(spans, ["_slice", "_group"]).select(
        _group([*keys, value]).alias("_value"),
        (F.sum("_n").over(local) - F.col("_n") + F.col("_before") + 1).alias(rank),
        (F.col("_pos") - F.col("_first") + F.col("_rows_before") + 1).alias(dense_rank))
    rows = number_rows(df, keys, [by, *tiebreak], row_number) if row_number else df
    # Written first, so that adaptive execution can split the join at a hot value.
    return rows.withColumn("_value", _group([*keys, value])).join(materialise(ranks, "ranks"), "_value").drop("_value")


def lag_lead(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
    previous: str, following: str, offset: int = 1, chunk_rows: int | None = None,
) -> DataFrame:
    rows = number_rows(df, keys, order)
    rows = framed(rows, keys, {
        previous: lambda w: F.lag(value, offset).over(w),
        following: lambda w: F.lead(value, offset).over(w),
    }, before=offset, ahead=offset, chunk_rows=chunk_rows)
    return rows.drop(RN)


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int, tiebreak: Sequence[str],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Runs of rows at most ``gap_seconds`` apart: start, end and row count of each run.

    Same sessions as ``session_window``, but a hot key is split over tasks: rows are numbered and
    meet the row before them once, in chunks. A run is named by the number of its first row and
    folds within its chunk; only the part that a chunk begins in the middle of a run, one row
    at most, takes its name from earlier chunks.
    """
    size = chunk_rows or CHUNK_ROWS
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = number_rows(df.select(*keys, ts, *[c for c in tiebreak if c not in keys]).withColumn("_t", micros),
                       keys, ["_t", *tiebreak])
    rows = rows.select(*keys, ts, "_t", RN, _group(keys).alias("_group"), _chunk(F.col(RN), size).alias("_own"))
    rows = rows.withColumn("_chunk", F.explode(F.array_distinct(F.array("_own", _chunk(F.col(RN) + 1, size)))))
    w = Window.partitionBy("_group", "_chunk").orderBy(RN)
    rows = rows.withColumn("_gap", F.col("_t") - F.lag("_t").over(w)).filter("_chunk = _own")
    first = F.when((F.col(RN) == 1) | (F.col("_gap") > gap_seconds * 1_000_000), F.col(RN))
    rows = rows.withColumn("_run", F.max(first).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = materialise(rows.groupBy(*keys, "_group", "_chunk", "_run").agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")), "runs")
    earlier = Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    open_run = (parts.groupBy("_group", "_chunk").agg(F.max("_run").alias("_run"))
                .select("_group", "_chunk", F.max("_run").over(earlier).alias("_run")))
    goes_on = parts.filter("_run is null").drop("_run").join(open_run, ["_group", "_chunk"])
    runs = parts.filter("_run is not null").unionByName(goes_on).groupBy(*keys, "_run").agg(
        F.min("_start").alias("session_start"), F.max("_last").alias("last"), F.sum("_n").alias("count"))
    return runs.select(*keys, "session_start",
                       (F.col("last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"), "count")
