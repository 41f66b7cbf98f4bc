"""Rolling z-score over the last N readings of each (machine, sensor) series.

For each reading, over the frame of the ``preceding`` earlier readings plus
the reading itself (ordered by time, then event id):

    rolling_avg    = round(avg(value), 4)
    rolling_stddev = round(stddev_samp(value), 4)        -- NULL for 1 row
    z_score        = round(|value - rolling_avg| / d, 4)
                     d = rolling_stddev if > 0 else 1.0

The plan is always the same, whatever the size, and starts no job while it is built:

1. Buckets. A histogram of the rows per (series, ``cell_seconds``) is summed up along
   each series. A series with more than ``bucket_rows`` rows is cut at the cells where
   the sum passes a multiple of that (readings of one series in one cell share a bucket).
   Only such series have edges, so there are fewer edges than rows / ``bucket_rows``: they
   are broadcast, and each row finds its bucket without a shuffle. The histogram also
   tells from which cell on there are ``preceding`` rows before an edge; these rows go to
   the bucket behind the edge, too.
2. Merged states. In a bucket, the rows are cut into runs as long as the frame. A frame
   is the beginning of a run and the end of the run before, so its state (count, sum, squared
   deviations) is merged from a prefix state and a suffix state. A row costs two
   running updates and one merge instead of a frame; nothing is ever subtracted, so no
   digits are lost to sums over long series.

The rows are shuffled once, by series and bucket. A caller who knows the number of rows passes the number of
tasks (``tasks_for``), so that the rows of a task, which it sorts, don't grow with the table. ``rolling_zscore_window`` (strategy
``window``) is the plain form, one window per series and one frame per row, for tests and
for callers who know that their series are small.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, PipelineConfig
from ..functions.rounding import int_div, round_half_up

def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raw aggregates first, rounding in a second step: an expression used twice inside the
    rounding would otherwise be planned as two window functions. As a row of a generator the
    rounded values are computed once: a filter on the z-score can't take their formulas along."""
    both = F.struct(round_half_up(F.col("_ravg"), 4).alias("rolling_avg"), round_half_up(F.col("_rstd"), 4).alias("rolling_stddev"))
    kept = [F.col(f"`{c}`") for c in cols]
    return df.select(*kept, F.explode(F.array(both)).alias("_rounded")).select(*kept, "_rounded.rolling_avg", "_rounded.rolling_stddev")


def _with_z(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    v = F.col(cfg.cols.value)
    d = F.when(F.col("rolling_stddev") > 0, F.col("rolling_stddev")).otherwise(F.lit(1.0))
    return df.withColumn("z_score", round_half_up(F.abs(v - F.col("rolling_avg")) / d, 4))


def _order(cfg: PipelineConfig) -> list[str]:
    return [cfg.cols.time, cfg.cols.event_id]


def rolling_zscore_window(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    keys = list(cfg.cols.series_keys)
    v = F.col(cfg.cols.value)
    w = Window.partitionBy(*keys).orderBy(*_order(cfg)).rowsBetween(-cfg.anomaly.preceding, 0)
    raw = df.select("*", F.avg(v).over(w).alias("_ravg"), F.stddev_samp(v).over(w).alias("_rstd"))
    return _with_z(_rounded(raw, df.columns), cfg)


# ---- buckets from a counting histogram -----------------------------------------------

def _zoned(df: DataFrame, time: str) -> bool:
    return dict(df.dtypes)[time] == "timestamp"


def _seconds(t: Column, zoned: bool) -> Column:
    """Whole seconds; of a time without a zone, counted without one."""
    if zoned:
        return F.unix_seconds(t)
    return F.datediff(F.to_date(t), F.lit("1970-01-01")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def histogram(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Rows per (series, cell): ``_at`` is the cell's first second; rows without a time are a cell of their own (NULL)."""
    c, width = cfg.cols, cfg.anomaly.cell_seconds
    second = _seconds(F.col(c.time), _zoned(df, c.time))
    return df.groupBy(*c.series_keys, (second - F.pmod(second, F.lit(width))).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))


def edges(cells: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Where series are cut: ``_at`` begins bucket ``_bucket`` (from 1); rows from ``_from`` on (NULL: from the first) are needed
    before it. Series with at most a bucket of rows have none."""
    keys = list(cfg.cols.series_keys)
    rows, before = max(cfg.anomaly.bucket_rows, cfg.anomaly.preceding + 1), F.col("_before")
    along = Window.partitionBy(*keys).orderBy("_at")
    summed = cells.withColumn("_before", F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    reach = Window.partitionBy(*keys).orderBy("_before").rangeBetween(Window.unboundedPreceding, -cfg.anomaly.preceding)
    step = int_div(before, F.lit(rows))
    cut = summed.select(*keys, "_at", F.max("_at").over(reach).alias("_from"), step.alias("_step"),
                        F.lag(step, 1, 0).over(Window.partitionBy(*keys).orderBy("_before")).alias("_last"))
    return cut.filter(F.col("_step") > F.col("_last")) \
        .select(*keys, "_at", "_from", F.row_number().over(along).alias("_bucket"))


def slice_of(second: Column) -> Column:
    """-1 before the first edge (and for no time), one slice for all times from the last edge on."""
    inside = int_div(F.least(second, F.col("_last")) - F.col("_first"), F.col("_width"))
    return F.when(second >= F.col("_first"), inside).otherwise(F.lit(-1).cast("long"))


def slices(cut: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row for each series with edges, which it has by slices of time of equal width, about four for each edge, so that most
    rows are in a slice without one and need no look at its arrays.

    ``_slices`` holds for each slice, from -1 on (before the first edge), the number of edges before it, those in it, and the
    stretches of time in it whose rows a later bucket needs. Nothing is shuffled again: all is done where the cells were summed up.
    """
    keys = list(cfg.cols.series_keys)
    all_, along = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_at")
    first, last = F.min("_at").over(all_), F.max("_at").over(all_)
    spans = cut.select("*", first.alias("_first"), last.alias("_last"), F.lead("_at").over(along).alias("_next"),
                       F.greatest(F.lit(1), F.ceil((last - first) / (4 * F.count(F.lit(1)).over(all_)))).alias("_width"))

    def entry(s: Column, edge=None, need=None) -> Column:  # noqa: ANN001
        nothing = F.lit(None).cast("struct<_from: long, _to: long, _bucket: int>")
        return F.struct(s.alias("_s"), (F.lit(None).cast("long") if edge is None else edge).alias("_e"),
                        (nothing if need is None else need).alias("_need"))

    here, need = slice_of(F.col("_at")), F.struct("_from", F.col("_at").alias("_to"), "_bucket")
    # the edge in its slice, the stretch before it in each slice that it touches, and the slices up to the next edge's
    entries = F.concat(
        F.array(entry(here, F.col("_at"))),
        F.transform(F.sequence(slice_of(F.col("_from")), slice_of(F.col("_at") - 1)), lambda s: entry(s, need=need)),
        F.transform(F.sequence(here, F.greatest(here, slice_of(F.col("_next")))), lambda s: entry(s)))
    told = ["_first", "_last", "_width"]
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    each = spans.select(*keys, *told, F.inline(entries)).groupBy(*keys, "_s").agg(
        F.sort_array(F.collect_list("_e")).alias("_edges"), F.collect_list("_need").alias("_needed"), *[F.first(x).alias(x) for x in told]) \
        .withColumn("_base", F.coalesce(F.sum(F.size("_edges")).over(earlier), F.lit(0)).cast("int"))
    listed = F.sort_array(F.collect_list(F.struct("_s", "_base", "_edges", "_needed")))
    return each.groupBy(*keys).agg(listed.alias("_slices"), *[F.first(x).alias(x) for x in told])


def bucketed(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The rows with ``_b``, the bucket of their series, and once more with ``_carry`` in each bucket that needs them before its first row."""
    c, keys = cfg.cols, list(cfg.cols.series_keys)
    # fewer edges than rows / bucket_rows, however many series there are, and about four times as many slices
    known = slices(edges(histogram(df, cfg), cfg), cfg).withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    # null-safe: a series with a NULL machine or sensor is still a series
    same = reduce(and_, [df[k].eqNullSafe(known[f"_k{i}"]) for i, k in enumerate(keys)])
    cols, second = [F.col(f"`{x}`") for x in df.columns], _seconds(F.col(c.time), _zoned(df, c.time))
    at = F.get("_slices", (slice_of(F.col("_second")) + 1).cast("int"))
    rows = df.join(F.broadcast(known), same, "left").withColumn("_second", F.when(F.col("_slices").isNotNull(), second)) \
        .select(*cols, "_second", F.when(F.col("_slices").isNotNull(), at).alias("_slice"))

    t, first_bucket = F.col("_second"), F.struct(F.lit(0).alias("_b"), F.lit(False).alias("_carry"))
    passed = F.when(t.isNull(), F.lit(0)).otherwise(F.size(F.filter("_slice._edges", lambda e: e <= t)))
    own = F.struct((F.col("_slice._base") + passed).alias("_b"), F.lit(False).alias("_carry"))

    def needed(x: Column) -> Column:
        first = x["_from"].isNull()
        return F.when(t.isNull(), first).otherwise((first | (x["_from"] <= t)) & (t < x["_to"]))

    copies = F.transform(F.filter("_slice._needed", needed), lambda x: F.struct(x["_bucket"].alias("_b"), F.lit(True).alias("_carry")))
    undivided = t.isNotNull() & (F.size("_slice._edges") == 0) & (F.size("_slice._needed") == 0)
    base = F.struct(F.col("_slice._base").alias("_b"), F.lit(False).alias("_carry"))
    return rows.select(*cols, F.inline(F.when(F.col("_slice").isNull(), F.array(first_bucket)).when(undivided, F.array(base))
                                       .otherwise(F.concat(F.array(own), copies))))


# ---- frames from merged states ---------------------------------------------------------

def _state(v: Column, w) -> Column:
    n = F.count(v).over(w)
    return [n, F.sum(v).over(w), F.var_pop(v).over(w) * n]


def sliding_stats(df: DataFrame, group: list[str], order: list[str], value: str, preceding: int) -> DataFrame:
    """``_ravg`` and ``_rstd`` (sample) of ``value`` over each row and the ``preceding`` rows before it in its group."""
    v, frame = F.col(value), preceding + 1
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))) \
        .withColumn("_run", int_div(F.col("_rn") - 1, F.lit(frame)))
    running = (Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*group, "_run").orderBy(F.desc("_rn")).rowsBetween(*running)
    n, s, m2 = _state(v, back)
    behind = numbered.select("*", n.alias("_sn"), s.alias("_ss"), m2.alias("_sm"))
    forth = Window.partitionBy(*group, "_run").orderBy("_rn").rowsBetween(*running)
    n, s, m2 = _state(v, forth)
    # the runs follow one another, so this is the order of the rows, without another sort
    along = Window.partitionBy(*group).orderBy("_run", "_rn")
    states = behind.select("*", n.alias("_pn"), s.alias("_ps"), m2.alias("_pm"),
                           F.lag(F.struct("_sn", "_ss", "_sm"), preceding).over(along).alias("_suffix"))
    # the row that the frame begins with lies in the run before, unless the frame is a whole run
    sn = F.when((F.col("_rn") - 1) % frame < preceding, F.col("_suffix._sn"))
    ss, sm, pn, ps, pm = F.col("_suffix._ss"), F.col("_suffix._sm"), F.col("_pn"), F.col("_ps"), F.col("_pm")
    only_prefix, only_suffix = F.coalesce(sn, F.lit(0)) == 0, pn == 0
    total = pn + F.coalesce(sn, F.lit(0))
    apart = ss / sn - ps / pn
    merged = F.when(only_prefix, pm).when(only_suffix, sm).otherwise(pm + sm + apart * apart * (pn * sn / total))
    summed = F.when(only_prefix, ps).when(only_suffix, ss).otherwise(ps + ss)
    return states.withColumns({"_ravg": F.when(total > 0, summed / total), "_rstd": F.when(total > 1, F.sqrt(merged / (total - 1)))}) \
        .drop("_rn", "_run", "_sn", "_ss", "_sm", "_pn", "_ps", "_pm", "_suffix")


def tasks_for(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> int:
    """Number of tasks that the buckets of a stored table are dealt to, from its number of rows (footers are read only):
    some for each core while the table is small, and then as many as keep a task's rows at ``task_rows`` or so."""
    rows, a = df.count(), cfg.anomaly
    spread = min(rows // a.bucket_rows + len(cfg.sensors), 3 * df.sparkSession.sparkContext.defaultParallelism)
    return max(1, spread, -(-rows // a.task_rows))


def rolling_zscore_bucketed(df: DataFrame, cfg: PipelineConfig = DEFAULT, tasks: int | None = None) -> DataFrame:
    group, rows = [*cfg.cols.series_keys, "_b"], bucketed(df, cfg)
    if tasks:
        rows = rows.repartition(tasks, *group)
    stats = sliding_stats(rows, group, _order(cfg), cfg.cols.value, cfg.anomaly.preceding)
    return _with_z(_rounded(stats.filter(~F.col("_carry")), df.columns), cfg)


def rolling_zscore(df: DataFrame, cfg: PipelineConfig = DEFAULT, strategy: str = "bucketed", tasks: int | None = None) -> DataFrame:
    """Input rows plus rolling_avg, rolling_stddev and z_score; ``tasks`` (bucketed) share the buckets, without it as
    many as the session's shuffle partitions."""
    if strategy == "window":
        return rolling_zscore_window(df, cfg)
    if strategy != "bucketed":
        raise ValueError(f"unknown strategy {strategy!r}")
    return rolling_zscore_bucketed(df, cfg, tasks)


def flag_anomalies(scored: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return scored.withColumn("is_anomaly", F.col("z_score") > F.lit(cfg.anomaly.threshold))


def anomalies(scored: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Only the readings whose z-score exceeds the threshold (strict)."""
    return scored.filter(F.col("z_score") > F.lit(cfg.anomaly.threshold))
