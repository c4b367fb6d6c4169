"""Window operators that hold however the rows spread over keys: distributed prefix scans.

All rows, of all keys, form one line in the order (key, ordering columns).  One
job draws a sample of it and cuts it into pieces of about equal size, as many as
the session has shuffle partitions.  A key that a cut goes through has several
chunks; windows run per (key, chunk), so no task gets more than about one piece,
whether a key owns 90 % of the rows or 0.9 %.  What a chunk needs from the
others is small:

* running totals, ranks and last versions need one carry per earlier chunk,
* peers (rows of one ordering value) that lie on both sides of a cut need that
  value's share of the other chunks,
* lag, lead and moving frames need a few rows of the neighbouring chunks.

There are fewer cuts than pieces, so the cuts and all carries have at most two
rows per piece, and only they are fetched or broadcast.  Any cuts give the same
result.  A table of at most ``Split.rows`` rows keeps the plain window.  The
input is read once for the sample and once per carry; store an expensive one
first (``session.cut_lineage``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import all_of, as_col, bare, same, sort_columns
from tidemark.session import cut_lineage

CHUNK = "__chunk"
CUTS = "__cuts"
EDGE = "__edge"


@dataclass(frozen=True)
class Split:
    """``rows``: a table of at most so many is not cut.  ``chunks``: pieces of the whole line; by default the
    session's shuffle partitions, the number of tasks it gives any shuffle."""

    rows: int = 1_000_000
    chunks: int | None = None


DEFAULT_SPLIT = Split()
#: Sampled rows: of a task's first rows all, of later ones fewer and fewer; and of all tasks, per piece.
PER_TASK, PER_PIECE, SAMPLED = 64, 64, 200_000


def _check(by: list[str], order: list[str]) -> None:
    if not by:
        raise ValueError("name the partition columns; use global_top for a ranking over everything")
    if not order:
        raise ValueError("an ordering is required")


def _matches(keys: list[str], prefix: str) -> Column:
    return all_of(same(F.col(k), F.col(f"{prefix}{k}")) for k in keys)


@dataclass(frozen=True)
class Chunked:
    """Rows with their chunk: -1 for keys without a cut, 0.. along the order for the others.

    ``hot`` holds the rows of cut keys only, and is None when nothing is cut.
    """

    df: DataFrame
    by: list[str]
    hot: DataFrame | None

    @property
    def keys(self) -> list[str]:
        return [*self.by, CHUNK]

    def window(self, order: list[str]) -> WindowSpec:
        """Within a chunk, or within the key where nothing is cut."""
        return Window.partitionBy(*(self.by if self.hot is None else self.keys)).orderBy(*sort_columns(order))


def cut_points(df: DataFrame, by: list[str], order: list[str], split: Split) -> DataFrame | None:
    """Keys that the cuts go through, each with its cuts in order (columns ``by`` and ``CUTS``); None without any.

    The i-th row of a task is taken with the chance ``PER_TASK / i`` and stands
    for ``i / PER_TASK`` rows, which needs no count of the table beforehand.  Of
    these a weighted sample of bounded size is lined up; its even steps are the
    cuts.
    """
    pieces = split.chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pieces < 2:
        return None
    names = list(dict.fromkeys([*by, *bare(order)]))
    most = max(4 * pieces, min(PER_PIECE * pieces, SAMPLED))
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) + 1
    weight = F.greatest(F.lit(1.0), F.col("__cut_i") / F.lit(float(PER_TASK)))
    thinned = df.select(*names).withColumn("__cut_i", place).filter(F.rand(7) * F.col("__cut_i") < PER_TASK)
    drawn = thinned.select(*names, weight.alias("__cut_w"), (-F.log1p(-F.rand(11)) / weight).alias("__cut_key"))
    sample = drawn.orderBy("__cut_key").limit(most)
    # Windows over everything, which is the bounded sample here.
    line, all_rows = Window.orderBy(*sort_columns([*by, *order])), Window.partitionBy()
    held, least = F.count(F.lit(1)).over(all_rows), F.max("__cut_key").over(all_rows)
    total = F.when(F.col("__cut_m") < most, F.sum("__cut_w").over(all_rows)).otherwise(F.col("__cut_m") / least)
    numbered = sample.withColumn("__cut_row", F.row_number().over(line)).withColumn("__cut_m", held)
    numbered = numbered.withColumn("__cut_p", F.least(F.lit(pieces), F.ceil(total / split.rows)))

    def step(at: Column) -> Column:
        return F.floor(at * F.col("__cut_p") / F.col("__cut_m"))

    at = F.col("__cut_row")
    cuts = numbered.filter((step(at) > step(at - 1)) & (at < F.col("__cut_m")))
    cut = F.struct("__cut_row", *[F.col(name).alias(f"__o{i}") for i, name in enumerate(bare(order))])
    grouped = cuts.groupBy(*by).agg(F.sort_array(F.collect_list(cut)).alias(CUTS))
    found = grouped.toArrow()
    return df.sparkSession.createDataFrame(found, schema=grouped.schema) if found.num_rows else None


def _pinned(hashed: Column) -> Column:
    """The same value, but one the optimiser does not take for a constant.

    Where all keys are constants it would turn an equality join into a product.
    """
    return hashed + F.spark_partition_id() * F.lit(0).cast("bigint")


def _beyond(cut: str, order: list[str]) -> str:
    """Whether a row lies at a cut or behind it (SQL), NULL sorting as in ``sort_columns``."""
    found = "true"
    for i, name in reversed(list(enumerate(order))):
        mine, other = f"`{name.lstrip('-')}`", f"{cut}.__o{i}"
        low, high = (mine, other) if name.startswith("-") else (other, mine)
        before = f"({low} IS NULL AND {high} IS NOT NULL) OR coalesce({low} < {high}, false)"
        found = f"CASE WHEN {before} THEN true WHEN {mine} <=> {other} THEN {found} ELSE false END"
    return found


def _passed(order: list[str], most: int) -> Column:
    """How many of the sorted cuts a row has passed, by halving steps; -1 where its key has none.

    As SQL text, which takes one call to build instead of hundreds.
    """
    steps = ", ".join(str(2**i) for i in reversed(range(most.bit_length())))
    beyond = _beyond(f"get({CUTS}, __i + __w - 1)", order)
    further = f"CASE WHEN __i + __w <= size({CUTS}) AND ({beyond}) THEN __i + __w ELSE __i END"
    return F.expr(f"CASE WHEN {CUTS} IS NULL THEN -1 ELSE reduce(array({steps}), 0, (__i, __w) -> {further}) END")


def _at_cut(order: list[str]) -> Column:
    """Whether a row's ordering value is that of the cut before or behind its chunk: only such peers can be parted."""

    def equal(cut: str) -> str:
        values = " AND ".join(f"`{name}` <=> {cut}.__o{i}" for i, name in enumerate(bare(order)))
        return f"({cut} IS NOT NULL AND {values})"

    return F.expr(f"{CUTS} IS NOT NULL AND ({equal(f'get({CUTS}, {CHUNK} - 1)')} OR {equal(f'get({CUTS}, {CHUNK})')})")


def chunked(df: DataFrame, by: list[str], order: list[str], split: Split, peers: list[str] | None = None) -> Chunked:
    """Number the chunks of every key along the whole ``order``.

    With ``peers``, the leading part of ``order``, a column ``EDGE`` tells rows
    whose peers may lie in several chunks.
    """
    _check(by, order)
    cuts = cut_points(df, by, order, split)
    if cuts is None:
        return Chunked(df.withColumn(CHUNK, F.lit(-1)), by, None)
    most = split.chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    renamed = cuts.withColumnsRenamed({k: f"__k_{k}" for k in by})
    renamed = F.broadcast(renamed.withColumn("__k", F.xxhash64(*[f"__k_{k}" for k in by])))
    on = (F.col("__l") == F.col("__k")) & _matches(by, "__k_")
    placed, passed = df.withColumn("__l", _pinned(F.xxhash64(*by))), _passed(order, most)
    edge = [_at_cut(peers).alias(EDGE)] if peers else []

    def numbered(how: str) -> DataFrame:
        joined = placed.join(renamed, on, how).select(*df.columns, CUTS, passed.alias(CHUNK))
        return joined.select(*df.columns, CHUNK, *edge)

    return Chunked(numbered("left"), by, numbered("inner"))


def _earlier(by: list[str]) -> WindowSpec:
    """Over carries: everything in the key's earlier chunks."""
    return Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def _attach(df: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Left join a size-bounded summary on null-safe keys, without a shuffle."""
    renamed = summary.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    return df.join(F.broadcast(renamed), _matches(keys, "__k_"), "left").drop(*[f"__k_{k}" for k in keys])


def _join_values(df: DataFrame, found: DataFrame, keys: list[str], bounded: bool = False) -> DataFrame:
    """Put per-value results back on the rows; NULL keys match.  ``bounded`` results are broadcast."""
    renamed = found.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    renamed = renamed.withColumn("__k", _pinned(F.xxhash64(*[f"__k_{k}" for k in keys])))
    placed = df.withColumn("__l", _pinned(F.xxhash64(*keys)))
    on = (F.col("__l") == F.col("__k")) & _matches(keys, "__k_")
    joined = placed.join(F.broadcast(renamed) if bounded else renamed, on, "left")
    return joined.drop("__l", "__k", *[f"__k_{k}" for k in keys])


def _plus(*parts: Column) -> Column:
    """Sum of totals; a NULL one has seen no value, and does not spoil the others."""
    total = parts[0]
    for part in parts[1:]:
        total = F.when(total.isNull(), part).when(part.isNull(), total).otherwise(total + part)
    return total


def _carried(rows: Chunked, sums: list[str]) -> DataFrame:
    """Per chunk, the totals ``__b_`` of the key's earlier chunks."""
    totals = rows.hot.groupBy(*rows.keys).agg(*[F.sum(n).alias(f"__t_{n}") for n in sums])
    return totals.select(*rows.keys, *[F.sum(f"__t_{n}").over(_earlier(rows.by)).alias(f"__b_{n}") for n in sums])


def _parted(rows: Chunked, order: list[str], sums: list[str]) -> DataFrame:
    """Per chunk and value at a cut, the value's totals in earlier (``__e_``) and later (``__a_``) chunks."""
    values = [n for n in dict.fromkeys(bare(order)) if n not in rows.by]
    shared = rows.hot.filter(EDGE).groupBy(*rows.keys, *values).agg(*[F.sum(n).alias(f"__t_{n}") for n in sums])
    line = Window.partitionBy(*rows.by, *values).orderBy(CHUNK)
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    later = line.rowsBetween(1, Window.unboundedFollowing)
    return shared.select(
        *rows.keys,
        *values,
        *[F.sum(f"__t_{n}").over(earlier).alias(f"__e_{n}") for n in sums],
        *[F.sum(f"__t_{n}").over(later).alias(f"__a_{n}") for n in sums],
    )


def _running_rows(df: DataFrame, by: list[str], order: list[str], sums: list[str], split: Split) -> DataFrame:
    """Replace each column of ``sums`` by its running total; ``order`` is unique per key."""
    rows = chunked(df, by, order, split)
    frame = rows.window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.df.withColumns({f"__m_{n}": F.sum(n).over(frame) for n in sums})
    if rows.hot is None:
        return local.withColumns({n: F.col(f"__m_{n}") for n in sums}).drop(CHUNK, *[f"__m_{n}" for n in sums])
    joined = _attach(local, _carried(rows, sums), rows.keys)
    totals = {n: _plus(F.col(f"__m_{n}"), F.col(f"__b_{n}")) for n in sums}
    return joined.withColumns(totals).drop(CHUNK, *[f"__{p}_{n}" for n in sums for p in "mb"])


def _spread(df: DataFrame) -> Column:
    """A hash of the row, by which the peers of a crowded value can be parted."""
    return F.xxhash64(*[name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    sums: dict[str, Column | str],
    tie: list[str] | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Running totals.

    With ``tie`` (columns making the order unique) the frame is by ROWS;
    without, it is the default RANGE frame, where peers share the total.
    """
    _check(by, order)
    # A total of totals is wider than a total: whatever is cut, the result has the type of a plain sum.
    plain = df.agg(*[F.sum(as_col(c)).alias(n) for n, c in sums.items()]).dtypes
    typed = {n: F.col(n).cast(kind) for n, kind in plain}
    if tie:
        found = _running_rows(
            df.withColumns({n: as_col(c) for n, c in sums.items()}), by, order + tie, list(sums), split
        )
        return found.withColumns(typed)
    # Totals go to columns of their own, as an ordering column may be summed under its name.
    own = {f"__s_{n}": as_col(c) for n, c in sums.items()}
    rows = chunked(df.withColumns(own | {"__spread": _spread(df)}), by, [*order, "__spread"], split, peers=order)
    local = rows.df.withColumns({f"__m_{n}": F.sum(n).over(rows.window(order)) for n in own})
    if rows.hot is None:
        totals = {n: F.col(f"__m___s_{n}") for n in sums}
        return local.withColumns(totals).drop(CHUNK, "__spread", *own, *[f"__m_{n}" for n in own])
    local = _attach(local, _carried(rows, list(own)), rows.keys)
    values = [n for n in dict.fromkeys(bare(order)) if n not in by]
    local = _attach(local, _parted(rows, order, list(own)), [*rows.keys, *values])
    totals = {n: _plus(*[F.col(f"__{p}___s_{n}") for p in "mba"]) for n in sums}
    made = [f"__{p}_{n}" for n in own for p in "mbea"]
    return local.withColumns(totals).withColumns(typed).drop(CHUNK, EDGE, "__spread", *own, *made)


def ranks(
    df: DataFrame,
    by: list[str],
    order: list[str],
    tie: list[str],
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``dense_rank``, always as bigint: a hot key outgrows int.

    ``order`` decides peers; ``tie`` makes ``row_number`` reproducible.
    """
    _check(by, order)
    rows = chunked(df, by, order + tie, split, peers=order)
    lined, peers = rows.window(order + tie), rows.window(order)
    local = rows.df.withColumns(
        {
            "row_number": F.row_number().over(lined).cast("bigint"),
            "rank": F.rank().over(peers).cast("bigint"),
            "dense_rank": F.dense_rank().over(peers).cast("bigint"),
        }
    )
    if rows.hot is None:
        return local.drop(CHUNK)
    values = [n for n in dict.fromkeys(bare(order)) if n not in by]
    counted = Chunked(rows.df, by, rows.hot.withColumn("__n", F.lit(1).cast("bigint")))
    parted = _parted(counted, order, ["__n"])
    # A value that began in an earlier chunk is no new one.
    again = parted.groupBy(*rows.keys).agg(F.count("__e___n").alias("__again"))
    different = rows.hot.select(*rows.keys, *values).distinct().groupBy(*rows.keys).agg(F.count(F.lit(1)).alias("__d"))
    new = F.col("__d") - F.coalesce("__again", F.lit(0))
    fresh = _attach(different, again, rows.keys).select(
        *rows.keys,
        (F.sum(new).over(_earlier(by).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__d")).alias("__dense"),
    )
    found = _attach(local, _carried(counted, ["__n"]), rows.keys)
    found = _attach(_attach(found, fresh, rows.keys), parted, [*rows.keys, *values])
    before = F.coalesce("__b___n", F.lit(0))
    return found.withColumns(
        {
            "row_number": F.col("row_number") + before,
            "rank": F.col("rank") + before - F.coalesce("__e___n", F.lit(0)),
            "dense_rank": F.col("dense_rank") + F.coalesce("__dense", F.lit(0)),
        }
    ).drop(CHUNK, EDGE, "__dense", "__b___n", "__e___n", "__a___n")


def _starts(rows: Chunked) -> DataFrame:
    """Per cut key, its chunks in order with the rows before each and up to its end (``__line``)."""
    sizes = rows.hot.groupBy(*rows.keys).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy(*rows.by).orderBy(CHUNK)
    ends = sizes.withColumn("stop", F.sum("n").over(upto))
    chunk = F.struct(F.col(CHUNK).alias("chunk"), (F.col("stop") - F.col("n")).alias("start"), "stop")
    return ends.groupBy(*rows.by).agg(F.sort_array(F.collect_list(chunk)).alias("__line"))


def _halo(rows: Chunked, order: list[str], count: int, after: bool) -> DataFrame:
    """Rows lent to other chunks: the ``count`` before each chunk, or behind it.

    Only the last (first) ``count`` rows of a chunk can be needed, which is all
    that leaves a map task.  The rows before each chunk of the key are known, so
    a row finds its own place in the key, and from it the chunks that begin (end)
    no further than ``count`` rows away: the next one, or several short ones.
    No task sees more of a key than that.
    """
    forward = sort_columns(order)
    backward = sort_columns([o[1:] if o.startswith("-") else f"-{o}" for o in order])
    inner = Window.partitionBy(*rows.keys).orderBy(*(forward if after else backward))
    edge = rows.hot.withColumn("__e", F.row_number().over(inner)).filter(F.col("__e") <= count)
    placed = _join_values(edge, _starts(rows), rows.by, bounded=True)

    def wanted(other: Column) -> Column:
        if after:
            return (other["chunk"] < F.col(CHUNK)) & (F.col("__at") < other["stop"] + count)
        return (other["chunk"] > F.col(CHUNK)) & (F.col("__at") >= other["start"] - count)

    mine = F.filter("__line", lambda other: other["chunk"] == F.col(CHUNK))[0]
    at = mine["start"] + F.col("__e") - 1 if after else mine["stop"] - F.col("__e")
    lent = placed.withColumn("__at", at).withColumn("__to", F.explode(F.filter("__line", wanted)["chunk"]))
    return lent.withColumn(CHUNK, F.col("__to")).drop("__e", "__at", "__line", "__to")


def neighbour_frame(
    df: DataFrame,
    by: list[str],
    order: list[str],
    tie: list[str],
    before: int,
    after: int,
    columns,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Add columns that look at most ``before`` / ``after`` rows away.

    ``columns`` receives the ordered window and returns name -> Column.
    """
    full = order + tie
    rows = chunked(df, by, full, split)
    if rows.hot is None:
        return rows.df.withColumns(columns(rows.window(full))).drop(CHUNK)
    lined = rows.df.withColumn("__own", F.lit(True))
    for count, is_after in ((before, False), (after, True)):
        if count:
            lined = lined.unionByName(_halo(rows, full, count, is_after).withColumn("__own", F.lit(False)))
    return lined.withColumns(columns(rows.window(full))).filter("__own").drop("__own", CHUNK)


def lag_lead(
    df: DataFrame,
    by: list[str],
    order: list[str],
    tie: list[str],
    lags: dict[str, tuple] | None = None,
    leads: dict[str, tuple] | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Previous / next values; each entry is name -> (column, offset, default)."""
    lags, leads = lags or {}, leads or {}

    def columns(window):
        found = {n: F.lag(c, k, d).over(window) for n, (c, k, d) in lags.items()}
        found.update({n: F.lead(c, k, d).over(window) for n, (c, k, d) in leads.items()})
        return found

    before = max((k for _, k, _ in lags.values()), default=0)
    after = max((k for _, k, _ in leads.values()), default=0)
    return neighbour_frame(df, by, order, tie, before, after, columns, split)


def moving(
    df: DataFrame,
    by: list[str],
    order: list[str],
    tie: list[str],
    rows: int,
    aggs: dict[str, Column],
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Aggregates over the last ``rows`` rows, the current one included."""

    def columns(window):
        frame = window.rowsBetween(1 - rows, Window.currentRow)
        return {n: c.over(frame) for n, c in aggs.items()}

    return neighbour_frame(df, by, order, tie, rows - 1, 0, columns, split)


def gaps(
    df: DataFrame, by: list[str], time: str, tie: list[str], split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """Days since the previous and until the next row of the key."""
    found = lag_lead(
        df, by, [time], tie, lags={"__prev": (time, 1, None)}, leads={"__next": (time, 1, None)}, split=split
    )
    return found.withColumns(
        {
            "days_since_previous": F.datediff(F.col(time), F.col("__prev")),
            "days_until_next": F.datediff(F.col("__next"), F.col(time)),
        }
    ).drop("__prev", "__next")


def within(
    df: DataFrame,
    by: list[str],
    order: str,
    width,
    sums: dict[str, Column | str],
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Sums over rows whose integer ``order`` value lies in ``[current - width, current]``.

    The running total up to a value, less the running total before the value
    ``width`` below it.  Rows are combined by (key, value) once and stored; each
    combined value is two points, where its range ends and where it begins, and
    the two sorted streams of points merge on one scanned line, whatever the
    width.  Whole numbers and decimals are exact; floats carry the rounding of a
    difference.  Rows without an order value share one window.
    """
    _check(by, [order])
    plain = df.agg(*[F.sum(as_col(c)).alias(n) for n, c in sums.items()]).dtypes
    totals = df.groupBy(*by, order).agg(
        *[F.sum(as_col(c)).alias(n) for n, c in sums.items()],
        *[F.count(as_col(c)).alias(f"__c_{n}") for n, c in sums.items()],
    )
    totals = cut_lineage(totals)
    names = [*sums, *[f"__c_{n}" for n in sums]]
    ref = F.col(order)
    point = [
        F.struct(ref.alias("at"), F.lit(1).alias("side"), *names),
        F.struct(
            (ref - F.lit(width)).cast(dict(df.dtypes)[order]).alias("at"),
            F.lit(0).alias("side"),
            *[F.lit(None).cast(kind).alias(n) for n, kind in totals.select(*names).dtypes],
        ),
    ]
    # A missing value comes first on the line and is in every total, so differences are free of it; it has no begin.
    points = F.when(ref.isNull(), F.array(point[0])).otherwise(F.array(*point))
    line = totals.select(*by, ref.alias("__ref"), F.explode(points).alias("__p")).select(
        *by, "__ref", F.col("__p.at").alias("__at"), F.col("__p.side").alias("__side"), *[F.col(f"__p.{n}") for n in names]
    )
    line = _running_rows(line, by, ["__at", "__side"], names, split)
    side = F.col("__side")
    found = line.groupBy(*by, "__ref").agg(
        *[F.max(F.when(side == 1, F.col(n))).alias(f"__u_{n}") for n in names],
        *[F.max(F.when(side == 0, F.col(n))).alias(f"__b_{n}") for n in names],
    )

    def inside(name: str) -> Column:
        return F.coalesce(F.col(f"__u_{name}"), F.lit(0)) - F.coalesce(F.col(f"__b_{name}"), F.lit(0))

    numbers = {n: F.when(inside(f"__c_{n}") > 0, inside(n)).cast(kind) for n, kind in plain}
    found = found.select(*by, F.col("__ref").alias(order), *[c.alias(n) for n, c in numbers.items()])
    return _join_values(df.drop(*sums), found, [*by, order])


def with_totals(
    df: DataFrame, by: list[str], aggs: dict[str, Column], split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """Put whole-key aggregates on each row.

    Keys are combined map-side into one row each and joined back, so no key's
    rows are gathered; the planner broadcasts few keys and splits a hot one.
    ``split`` is not needed any more and kept for callers that pass it.
    """
    if not by:
        raise ValueError("name the partition columns")
    totals = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    return _join_values(df.drop(*aggs), totals, by)


def zscore(df: DataFrame, by: list[str], value: str, out: str = "z", split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Distance from the group mean in sample standard deviations.

    NULL stays NULL, and a group without spread gives NULL.
    """
    found = with_totals(df, by, {"__mean": F.avg(value), "__sd": F.stddev_samp(value)}, split)
    return found.withColumn(out, F.try_divide(F.col(value) - F.col("__mean"), F.col("__sd"))).drop("__mean", "__sd")


def top_n(df: DataFrame, by: list[str], order: list[str], n: int, tie: list[str]) -> DataFrame:
    """Exactly ``n`` rows per key, ties broken by ``tie``.

    Every map task keeps at most ``n`` rows per key before the shuffle
    (WindowGroupLimit), so a hot key shrinks where it is read.
    """
    _check(by, order)
    if n > 1000:
        raise ValueError("beyond 1000 rows per key the map-side limit is off; filter ranks() instead")
    window = Window.partitionBy(*by).orderBy(*sort_columns(order + tie))
    return df.withColumn("row_number", F.row_number().over(window)).filter(F.col("row_number") <= n)


def latest(df: DataFrame, keys: list[str], order: list[str], tie: list[str]) -> DataFrame:
    """The newest row per key; ``order`` is ascending age, e.g. ``["updated_at"]``."""
    newest = [o[1:] if o.startswith("-") else f"-{o}" for o in order + tie]
    return top_n(df, keys, newest, 1, []).drop("row_number")


def global_top(df: DataFrame, order: list[str], k: int, tie: list[str]) -> DataFrame:
    """The first ``k`` rows of everything, with their position.

    A window without partition columns would move all rows to one task; the
    sorted limit keeps ``k`` per task and only those are numbered.
    """
    first = df.orderBy(*sort_columns(order + tie)).limit(k)
    return first.withColumn("row_number", F.row_number().over(Window.orderBy(*sort_columns(order + tie))))


def asof_versions(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    time: str,
    payload: list[str],
    start: str = "effective_start",
    end: str = "effective_end",
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Point-in-time left join for keys with very many versions.

    Versions must not overlap (see ``scd.overlaps``).  Facts and versions are
    lined up by time and each fact takes the last version seen, so no fact
    meets all versions of its key.  Each chunk of a cut key learns the last
    version of the earlier ones.
    """
    version = F.struct(F.col(start).alias("__from"), F.col(end).alias("__until"), *payload)
    kind = dict(dim.dtypes)[start]
    # A version comes before the facts of its day, which follow in hash order:
    # that spreads a crowded day over several chunks.
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(2**30))
    facts = fact.withColumn("__at", F.col(time).cast(kind)).withColumn("__line", spread)
    starts = dim.select(*on, F.col(start).alias("__at"), F.lit(-1).cast("bigint").alias("__line"), version.alias("__v"))
    rows = chunked(facts.unionByName(starts, allowMissingColumns=True), on, ["__at", "__line"], split)
    frame = rows.window(["__at", "__line"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.df.withColumn("__seen", F.last("__v", ignorenulls=True).over(frame)).filter(F.col("__line") >= 0)
    if rows.hot is not None:
        # Each chunk's last version, NULL for none, carried over the later chunks.
        carried = (
            rows.hot.groupBy(*rows.keys)
            .agg(F.max_by("__v", F.when(F.col("__line") < 0, F.col("__at"))).alias("__last"))
            .select(*rows.keys, F.last("__last", ignorenulls=True).over(_earlier(on)).alias("__carried"))
        )
        seen = _attach(seen, carried, rows.keys).withColumn("__seen", F.coalesce("__seen", "__carried"))
    until = F.col("__seen.__until")
    alive = F.col("__seen").isNotNull() & (until.isNull() | (F.col("__at") < until))
    alive &= all_of(F.col(k).isNotNull() for k in on)
    return seen.select(*fact.columns, *[F.when(alive, F.col(f"__seen.{p}")).alias(p) for p in payload])
