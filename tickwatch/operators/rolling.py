"""Row-frame window functions per key that scale past one task per key.

The plain form is ``Window.partitionBy(key).orderBy(ts, seq).rowsBetween(-n, 0)``:
one exchange on ``key`` and one sort, but then every row of a key goes
through a single task, and a key may hold a third of all rows.

:func:`row_frames` keeps the same frames but partitions by ``(key, chunk)``
where a chunk is a run of about ``chunk_rows`` consecutive rows of one key,
and every chunk also receives the rows just before it (its *halo*, at least
``halo`` rows) so each frame is complete inside its chunk. Halo copies are
dropped after the window.

Rows are counted per ``(key, time bucket)`` — a small, map-side combined
aggregate. From the counts alone a *bucket plan* assigns every bucket to a
chunk (by its row offset within the key, a prefix sum in two levels) and lists
the at most two following chunks whose halo it falls into. The plan is written below the shared
checkpoint directory and joined by an ordinary equi-join: Spark broadcasts it
when its size on disk allows, and shuffles both sides otherwise. Whole
buckets are copied as halo, so the halo is ``halo`` rows plus at most a
bucket's worth.

A bucket that holds more than ``chunk_rows`` rows (a burst on one key) is split
into finer ones, down to one second, and the others stay as they are. So only
rows sharing one timestamp, or without one, stay together.

Long frames take constant time per row (:class:`BlockAverages`): a frame of
``n`` rows is a suffix of one block of ``n`` rows and a prefix of the next, and
both are running sums. Nothing is subtracted, so a bad reading (NaN, infinite
or far too large) affects the rows whose frame holds it and no others, which
running sums minus earlier running sums cannot guarantee. Short frames are
Spark's own bounded frames.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Stage = Callable[[WindowSpec], Mapping[str, Column]]

DEFAULT_CHUNK_ROWS = 16_384
DEFAULT_BUCKET_SECONDS = 3_600
# Stands for the bucket of rows without a time.
NO_TIME = -(2**62)

# Frames of the metrics table: (source column, preceding rows). The current
# row is always included, so 480 preceding rows is a 481-row frame.
DEFAULT_MA_FRAMES: dict[str, tuple[str, int]] = {
    "price_ma_24h": ("price_usd", 480),
    "volume_ma_24h": ("volume_24h_usd", 480),
    "price_ma_15min": ("price_usd", 5),
}

_HELPERS = ("_kv", "_kn", "_tbv", "_w", "_n", "_own", "_chunk", "_to")


def order_columns(df: DataFrame, ts_col: str = "collection_timestamp", tie_col: str = "seq") -> list[str]:
    """Deterministic order inside a key: time, then a tie-breaker.

    With no ``seq`` column the remaining columns break ties, so rows that
    share a timestamp still get one fixed order.
    """
    if tie_col in df.columns:
        return [ts_col, tie_col]
    return [ts_col] + [c for c in df.columns if c != ts_col]


def _with_surrogates(df: DataFrame, key: str, time_col: str, bucket_seconds: int) -> DataFrame:
    """Non-null stand-ins for (key, bucket), so joins and partitionings on
    them are plain equi-keys (a null key stays distinct from every value)."""
    k = F.col(key)
    tb = F.floor(F.col(time_col) / F.lit(bucket_seconds))
    return df.withColumns(
        {
            "_kv": F.coalesce(k.cast("string"), F.lit("")),
            "_kn": k.isNull(),
            "_tbv": F.coalesce(tb, F.lit(NO_TIME)),
        }
    )


_PARTS = ["_kv", "_kn", "_tbv"]


#: Seconds of a bucket run, in buckets (of a quarter of an hour at least): offsets inside a run come from one window.
RUN_BUCKETS = 4_096


def _counts(rows: DataFrame, width: int) -> DataFrame:
    return rows.groupBy(*_PARTS).agg(F.count(F.lit(1)).alias("_n")).withColumn("_w", F.lit(width))


def _plan_of(counts: DataFrame, bucket_seconds: int, chunk_rows: int, halo: int) -> DataFrame:
    """The bucket plan of disjoint buckets ``(_kv, _kn, _tbv, _w, _n)``.

    A bucket's row offset is a prefix sum in two levels: over the buckets of its
    run (a window by key and run), and over the totals of the key's runs, of
    which there are about two a year. A bucket with rows at offsets
    ``[off, end)`` belongs to chunk ``off div chunk_rows``. It feeds the halo of
    the following chunks that may hold rows before offset ``end + halo``: the
    chunk in which the next bucket begins and at most one more.
    """
    run_seconds = RUN_BUCKETS * max(bucket_seconds, 900)
    started = counts.withColumn(
        "_at", F.when(F.col("_tbv") == NO_TIME, F.col("_tbv")).otherwise(F.col("_tbv") * F.col("_w"))
    ).withColumn("_run", F.expr(f"_at div {run_seconds}"))
    inside = Window.partitionBy("_kv", "_kn", "_run").orderBy("_at")
    upto = started.withColumns({
        "_inside": F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"),
        "_next": F.lead("_at").over(inside),
    })
    # A run's last bucket knows its total.
    runs = upto.where("_next IS NULL").groupBy("_kv", "_kn").agg(
        F.sort_array(F.collect_list(F.struct("_run", (F.col("_inside") + F.col("_n")).alias("n")))).alias("r"),
        F.sum(F.col("_inside") + F.col("_n")).alias("_total"))
    before = F.transform("r", lambda x, i: F.struct(
        x["_run"].alias("_run"),
        F.aggregate(F.slice("r", 1, i), F.lit(0).cast("long"), lambda acc, y: acc + y["n"]).alias("_before")))
    runs = runs.select("_kv", "_kn", "_total", F.inline(before))
    placed = upto.join(runs, ["_kv", "_kn", "_run"]).withColumn("_off", F.col("_before") + F.col("_inside")).withColumns({
        "_own": F.expr(f"_off div {int(chunk_rows)}"),
        "_first": F.expr(f"greatest(_off div {int(chunk_rows)} + 1, (_off + _n) div {int(chunk_rows)})"),
        "_last": F.expr(f"least((_off + _n + {int(halo)} - 1) div {int(chunk_rows)}, (_total - 1) div {int(chunk_rows)})"),
    })
    to = F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last")).otherwise(F.array().cast("array<bigint>"))
    return placed.select(*_PARTS, "_w", "_n", "_own", (to if halo > 0 else F.array().cast("array<bigint>")).alias("_to"))


def bucket_plan(
    df: DataFrame,
    key: str = "crypto_id",
    time_col: str = "collection_timestamp",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    halo: int = 480,
) -> DataFrame:
    """One row per (key, bucket): its width ``_w``, its row count ``_n``, its chunk
    ``_own`` and the chunks ``_to`` whose halo it must also feed. Computed
    from bucket counts only."""
    counts = _counts(_with_surrogates(df, key, time_col, bucket_seconds), bucket_seconds)
    return _plan_of(counts, bucket_seconds, chunk_rows, halo)


def _bucketed(df: DataFrame, plan: DataFrame | None, key: str, time_col: str, widths: Sequence[int]) -> DataFrame:
    """Rows with their bucket. A bucket marked as split in ``plan`` (no ``_own``)
    hands its rows to the buckets of the next width."""
    rows = _with_surrogates(df, key, time_col, widths[0]).withColumn("_w", F.lit(widths[0]))
    for finer in widths[1:]:
        split = plan.where(F.col("_own").isNull()).select(*_PARTS, "_w", F.lit(True).alias("_split"))
        rows = rows.join(split, [*_PARTS, "_w"], "left").withColumns({
            "_tbv": F.when(F.col("_split"), F.floor(F.col(time_col) / F.lit(finer))).otherwise(F.col("_tbv")),
            "_w": F.when(F.col("_split"), F.lit(finer)).otherwise(F.col("_w")),
        }).drop("_split")
    return rows


def _stored(df: DataFrame, name: str) -> DataFrame:
    from tickwatch.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _adaptive_plan(
    df: DataFrame, key: str, time_col: str, bucket_seconds: int, chunk_rows: int, halo: int
) -> tuple[DataFrame, int]:
    """A bucket plan whose buckets fit a chunk, and the finest width in it.

    Buckets with a time that hold more than ``chunk_rows`` rows are split into
    60x finer ones, down to one second, and stay in the plan as marks without
    ``_own``; all other buckets keep their width. The plan is written below the
    session's checkpoint directory, so that its size is known to the join."""
    plan = _stored(bucket_plan(df, key, time_col, bucket_seconds, chunk_rows, halo), "bucket-plan")
    widths = [bucket_seconds]
    marks = None
    counts = plan.select(*_PARTS, "_w", "_n")
    while widths[-1] > 1:
        over = (F.col("_w") == widths[-1]) & (F.col("_tbv") != F.lit(NO_TIME)) & (F.col("_n") > chunk_rows)
        if counts.where(over).isEmpty():
            break
        new = counts.where(over).select(*_PARTS, "_w", F.lit(0).cast("long").alias("_n"),
                                        F.lit(None).cast("long").alias("_own"), F.lit(None).cast("array<bigint>").alias("_to"))
        marks = new if marks is None else marks.unionByName(new)
        widths.append(max(1, widths[-1] // 60))
        finer = _counts(_bucketed(df, marks, key, time_col, widths).where(F.col("_w") == widths[-1]), widths[-1])
        counts = _stored(counts.where(~over).unionByName(finer.select(counts.columns)), "bucket-counts")
    if marks is not None:
        plan = _stored(_plan_of(counts, bucket_seconds, chunk_rows, halo).unionByName(marks), "bucket-plan")
    return plan, widths[-1]


def _staged(df: DataFrame, stages: Sequence[Stage], parts: Sequence[str], order: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*parts).orderBy(*order)
    for stage in stages:
        df = stage.apply(df, parts, order) if hasattr(stage, "apply") else df.withColumns(dict(stage(w)))
    return df


def row_frames(
    df: DataFrame,
    stages: Sequence[Stage],
    key: str = "crypto_id",
    order: Sequence[str] | None = None,
    halo: int = 480,
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
    time_col: str = "collection_timestamp",
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Add the columns produced by ``stages`` evaluated over ordered rows per key.

    Each stage gets a ``WindowSpec`` (partitioned and ordered, no frame) and
    returns ``{name: column}``; later stages may read earlier stages' columns.
    A stage with a method ``apply(rows, partition columns, order)`` is called by that instead.
    Frames may look back at most ``halo`` rows. ``chunk_rows=None`` uses one
    window partition per key.
    """
    order = list(order or order_columns(df, time_col))
    if chunk_rows is None:
        return _staged(df, stages, [key], order)

    if halo > chunk_rows:
        raise ValueError(f"halo ({halo}) must not exceed chunk_rows ({chunk_rows})")
    original = df.columns
    plan, finest = _adaptive_plan(df, key, time_col, bucket_seconds, chunk_rows, halo)
    widths = [bucket_seconds]
    while widths[-1] > finest:
        widths.append(max(1, widths[-1] // 60))
    rows = _bucketed(df, plan, key, time_col, widths)
    if len(widths) == 1:
        rows = rows.drop("_w").join(plan.drop("_n", "_w"), _PARTS)
    else:
        rows = rows.join(plan.where(F.col("_own").isNotNull()).drop("_n"), [*_PARTS, "_w"])
    spread = rows.withColumn("_chunk", F.explode(F.concat(F.array(F.col("_own")), F.col("_to"))))
    out = _staged(spread, stages, ["_kv", "_kn", "_chunk"], order)
    out = out.where(F.col("_chunk") == F.col("_own"))
    added = [c for c in out.columns if c not in original and c not in _HELPERS]
    return out.select(*original, *added)


def moving_average_stages(frames: Mapping[str, tuple[str, int]], with_counts: bool = False) -> list[Stage]:
    """A stage that adds ``avg(src)`` over ``rowsBetween(-n, 0)`` for each frame
    (and, with ``with_counts``, ``<name>_n``: the non-null readings in it)."""

    def averages(w: WindowSpec) -> dict[str, Column]:
        cols = {name: F.avg(src).over(w.rowsBetween(-n, 0)) for name, (src, n) in frames.items()}
        if with_counts:
            cols.update({f"{name}_n": F.count(src).over(w.rowsBetween(-n, 0)) for name, (src, n) in frames.items()})
        return cols

    return [averages]


#: Frames of more rows than this are averaged by blocks.
LONG_FRAME = 32


class BlockAverages:
    """A stage like :func:`moving_average_stages` for frames of one length, at constant cost per row.

    Rows are numbered inside the partition and cut into blocks of the frame's
    length. The sum over a frame is the running sum of the row's own block up to
    the row, plus the running sum of the block before from its end down to the
    frame's first row; that one is a lag away. The same holds for the counts.
    """

    def __init__(self, frames: Mapping[str, tuple[str, int]], with_counts: bool = False):
        (self.length,) = {n + 1 for _, n in frames.values()}
        self.frames, self.with_counts = frames, with_counts

    def apply(self, df: DataFrame, parts: Sequence[str], order: Sequence[str]) -> DataFrame:
        n, names = self.length, list(dict.fromkeys(src for src, _ in self.frames.values()))
        kept = df.columns
        rows = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
        rows = rows.withColumn("_block", F.expr(f"(_rn - 1) div {n}"))
        by_block = Window.partitionBy(*parts, "_block")
        upto = by_block.orderBy("_rn").rowsBetween(Window.unboundedPreceding, 0)
        rest = by_block.orderBy(F.col("_rn").desc()).rowsBetween(Window.unboundedPreceding, 0)
        parts_of = lambda w, p: {f"_{p}{kind}{i}": f(src).over(w) for i, src in enumerate(names)
                                 for kind, f in (("s", F.sum), ("c", F.count))}
        rows = rows.withColumns(parts_of(rest, "r")).withColumns(parts_of(upto, "u"))
        at = Window.partitionBy(*parts).orderBy("_block", "_rn")  # as the rows are sorted already
        # A frame that is a whole block, or begins before the partition, has no part in the block before.
        earlier = lambda c: F.when((F.col("_block") > 0) & (F.col("_rn") % n != 0), F.lag(c, n - 1).over(at))
        rows = rows.withColumns({f"_e{kind}{i}": earlier(f"_r{kind}{i}") for i in range(len(names)) for kind in "sc"})
        zero = F.lit(0)
        out = {}
        for name, (src, _) in self.frames.items():
            i = names.index(src)
            count = F.col(f"_uc{i}") + F.coalesce(F.col(f"_ec{i}"), zero)
            total = F.coalesce(F.col(f"_us{i}"), zero) + F.coalesce(F.col(f"_es{i}"), zero)
            out[name] = F.when(count > 0, total / count)
            if self.with_counts:
                out[f"{name}_n"] = count
        added = [c for c in out if c not in kept]
        return rows.withColumns(out).select(*kept, *added)


def add_moving_averages(
    df: DataFrame,
    frames: Mapping[str, tuple[str, int]] | None = None,
    key: str = "crypto_id",
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
    order: Sequence[str] | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    with_counts: bool = False,
    blocks: bool = False,
) -> DataFrame:
    """Per-key moving averages over row frames (defaults: 481 and 6 rows).
    ``with_counts`` also adds ``<name>_n``, the non-null readings per frame.

    All frames share one partitioning, so the plan has a single window exchange
    for them. Frames are Spark's own and sum from their first row
    to their last, at a cost of the frame's length per row. With ``blocks``, frames
    longer than :data:`LONG_FRAME` rows cost the same for any length; their sums
    add the same values in another order, so the last bits may differ.
    """
    frames = dict(frames or DEFAULT_MA_FRAMES)
    halo = max(n for _, n in frames.values())
    long = {n: {k: f for k, f in frames.items() if f[1] == n} for n in {n for _, n in frames.values()} if blocks and n >= LONG_FRAME}
    short = {k: f for k, f in frames.items() if f[1] not in long}
    stages: list = moving_average_stages(short, with_counts) if short else []
    stages += [BlockAverages(group, with_counts) for group in long.values()]  # last: they sort by block
    out = row_frames(
        df,
        stages,
        key=key,
        order=order,
        halo=halo,
        chunk_rows=chunk_rows if chunk_rows is None else max(chunk_rows, halo),
        bucket_seconds=bucket_seconds,
    )
    added = [c for name in frames for c in ((name, f"{name}_n") if with_counts else (name,))]
    return out.select(*[c for c in df.columns if c not in added], *added)


def lag_stage(value: str, n: int, name: str) -> Stage:
    """``lag(value, n)`` — null until ``n`` earlier rows exist."""
    return lambda w: {name: F.lag(value, n).over(w)}


def min_max_stage(value: str, rows: int, min_name: str, max_name: str) -> Stage:
    """Rolling min and max over the current row and ``rows - 1`` before it."""
    return lambda w: {
        min_name: F.min(value).over(w.rowsBetween(-(rows - 1), 0)),
        max_name: F.max(value).over(w.rowsBetween(-(rows - 1), 0)),
    }


def ordered_rise_stages(value: str, rows: int, rise: str, peak: str) -> list[Stage]:
    """Over the current row and ``rows - 1`` before it: the largest ratio of a
    value to an earlier one (1.0 for a single row), and that later value (of
    equal ratios, the largest).

    What a run of rows needs to be joined to the next is its smallest and largest
    value and its best pair: the best of both runs, and the second's largest over
    the first's smallest. Runs of 1, 2, 4, ... rows are joined to runs twice as
    long by a lag, and a frame is put together from the powers of two of its
    length, latest rows first: a cost of log(rows) per row, in one ordering.
    """
    v = F.col(value)
    pair = lambda ratio, top: F.struct(ratio.alias("rise"), top.alias("peak"))
    run = lambda lo, hi, best: F.struct(lo.alias("lo"), hi.alias("hi"), best.alias("best"))

    def joined(a: Column, b: Column) -> Column:
        """Run ``a`` followed by run ``b``; either may be missing."""
        across = F.when(a.isNotNull() & b.isNotNull(), pair(F.try_divide(b["hi"], a["lo"]), b["hi"]))
        both = run(F.least(a["lo"], b["lo"]), F.greatest(a["hi"], b["hi"]), F.greatest(a["best"], b["best"], across))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    stages: list[Stage] = [lambda w: {"_run0": F.when(v.isNotNull(), run(v, v, pair(F.lit(1.0), v)))}]
    for k in range(1, rows.bit_length()):
        stages.append(lambda w, k=k: {f"_run{k}": joined(F.lag(f"_run{k - 1}", 1 << (k - 1)).over(w), F.col(f"_run{k - 1}"))})
    done = 0
    for k in range(rows.bit_length()):
        if rows >> k & 1:
            piece = lambda w, k=k, back=done: F.lag(f"_run{k}", back).over(w) if back else F.col(f"_run{k}")
            stages.append(lambda w, p=piece, first=done == 0: {"_frame": p(w) if first else joined(p(w), F.col("_frame"))})
            done += 1 << k
    stages.append(lambda w: {rise: F.col("_frame.best.rise"), peak: F.col("_frame.best.peak")})
    return stages


def _unit_frames(rows: DataFrame, key: str, length: int, units: Sequence[int], lo: int, hi: int) -> DataFrame:
    """Adds ``_fs, _fc``: sums of ``_s`` and ``_c`` over the rows of the key at ``[_at + lo, _at + hi]``, where that is
    the last ``length`` places or so.

    Two units of ``units[0]`` places, ``length`` apart, have the same number modulo ``length / units[0]``. Both edges of
    a frame lie in such a pair, so a window by key and that remainder sees exactly the edges through its range frame. The
    whole units between come from the table of sums per unit, by the same rule with the next unit; its rows join the
    window's exchange as extra rows, so the rows themselves are exchanged once.
    """
    if not units:
        # Few rows: a span of 32 frames, and the frame before it as halo.
        span = 32 * length
        own = F.floor(F.col("_at") / span)
        last = F.floor((F.col("_at") - lo) / span)
        dealt = rows.withColumns({"_own": own, "_span": F.explode(F.sequence(own, last))})
        frame = Window.partitionBy(key, "_span").orderBy("_at").rangeBetween(lo, hi)
        framed = dealt.withColumns({"_fs": F.sum("_s").over(frame), "_fc": F.sum("_c").over(frame)})
        return framed.where("_own = _span").drop("_own", "_span")
    n = length // units[0]
    unit = F.floor(F.col("_at") / units[0])
    sums = rows.where("_at IS NOT NULL").groupBy(key, unit.alias("_at")).agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    whole = _unit_frames(sums, key, n, units[1:], -(n - 1), -1)
    # Rows without a time have no frame; they are only spread.
    place = F.coalesce(F.pmod(unit, F.lit(n)), -1 - F.pmod(F.xxhash64(*rows.columns), F.lit(n)))
    marked = rows.withColumns({"_unit": unit, "_place": place, "_ws": F.lit(None).cast("double"), "_wc": F.lit(None).cast("bigint"), "_extra": F.lit(False)})
    extra = whole.select(key, F.col("_at").alias("_unit"), F.pmod("_at", F.lit(n)).alias("_place"), F.col("_fs").alias("_ws"),
                         F.col("_fc").alias("_wc"), F.lit(True).alias("_extra"), (F.col("_at") * units[0]).alias("_at"))
    both = marked.unionByName(extra, allowMissingColumns=True)
    edges = Window.partitionBy(key, "_place").orderBy("_at").rangeBetween(lo, hi)
    one = Window.partitionBy(key, "_place", "_unit")
    framed = both.withColumns({"_es": F.sum("_s").over(edges), "_ec": F.sum("_c").over(edges)}).withColumns(
        {"_ws": F.max("_ws").over(one), "_wc": F.max("_wc").over(one)}).where("NOT _extra")
    zero = lambda c, d, z: F.coalesce(c, z) + F.coalesce(d, z)
    return framed.withColumns({"_fs": zero("_es", "_ws", F.lit(0.0)), "_fc": zero("_ec", "_wc", F.lit(0))}).select(*rows.columns, "_fs", "_fc")


def add_time_frame_average(
    df: DataFrame,
    value: str,
    name: str,
    seconds: int = 86_400,
    key: str = "crypto_id",
    ts_col: str = "collection_timestamp",
) -> DataFrame:
    """``avg(value)`` over the rows of the same key whose timestamp (whole seconds) lies in
    ``[ts - seconds, ts]`` — a true-time 24h frame that does not assume a
    fixed collection cadence. Rows with a null timestamp get null.

    A frame is the rows of two edge minutes and the whole minutes between them, and
    those are the minutes of two edge hours and the whole hours between (see
    :func:`_unit_frames`; units that do not divide ``seconds`` are left out). A
    key's day is spread over as many window partitions as it has minutes.
    Sums are added, never subtracted, so a bad reading stays in its frames.
    """
    units = [60] if seconds % 60 == 0 and seconds > 120 else []
    if units and seconds % 3_600 == 0 and seconds > 7_200:
        units.append(60)  # minutes of an hour
    there = F.col(ts_col).isNotNull()
    rows = df.withColumns({"_at": F.col(ts_col).cast("bigint"), "_s": F.col(value).cast("double"),
                           "_c": F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("bigint")})
    if not units:
        nowhere = rows.where(~there).withColumns({"_fs": F.lit(None).cast("double"), "_fc": F.lit(0).cast("bigint")})
        out = _unit_frames(rows.where(there), key, seconds, units, -seconds, 0).unionByName(nowhere)
    else:
        out = _unit_frames(rows, key, seconds, units, -seconds, 0)
    average = F.when(there & (F.col("_fc") > 0), F.col("_fs") / F.col("_fc"))
    return out.withColumn(name, average).select(*[c for c in df.columns if c != name], name)
