"""Row order on an unordered engine.

Three tools, none of which sends a whole table or a whole group through one
task:

* ``number_rows``   dense 0-based ids from a total order (range partitions)
* ``dense_position``, ``prefix_sum``, ``previous_value``   ordered work on data
  that already has an integer position, cut into blocks of positions
* ``take_lowest``   exact k smallest hash draws per group
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store

#: positions per block; a block is the largest group one task sorts
BLOCK = 1 << 18

_BEFORE = (Window.unboundedPreceding, -1)


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def number_rows(df: DataFrame, order_by, within=(), out: str = "row_id", keep=None) -> DataFrame:
    """Add dense ids 0, 1, ... in the order of ``order_by``, restarting per ``within``.

    ``order_by`` must be a total order. Rows are range partitioned on
    ``within + order_by``, so even one group holding most rows is spread, and
    stored; each partition then needs only the number of its group's rows in
    earlier partitions. Groups are told apart by a hash first: names that begin alike
    would be compared in full again and again. ``keep`` names the columns that are
    wanted afterwards (all by default); it has to hold ``within``.
    """
    within = list(within)
    keys = [F.col(w) for w in within] + [_col(c) for c in order_by]
    wanted = list(df.columns if keep is None else keep)
    if within:
        df, keys = df.withColumn("_group", F.xxhash64(*within)), [F.col("_group"), *keys]
    placed = store(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*wanted, F.monotonically_increasing_id().alias("_at")),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(*within, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(*_BEFORE)
    # stored: its true size then decides between a broadcast and a shuffled join
    runs = store(
        runs.select(
            *within,
            "_part",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "runs",
    )
    return (
        placed.withColumn("_part", part)
        .join(runs, [*within, "_part"])
        .withColumn(out, F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_shift")
    )


def _blocks(df: DataFrame, pos: str, block: int) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(pos) / block))


def _with_offsets(df: DataFrame, weight: Column, within, total_of) -> DataFrame:
    """Attach to each block the total weight of the earlier blocks of its group."""
    totals = df.groupBy(*within, "_block").agg(total_of(weight).alias("_total"))
    earlier = Window.partitionBy(*within).orderBy("_block").rowsBetween(*_BEFORE)
    offsets = totals.select(*within, "_block", F.sum("_total").over(earlier).alias("_offset"))
    return df.join(_hashed(offsets), [*within, "_block"])


def _hashed(side: DataFrame) -> DataFrame:
    """One row per block: small next to the rows it is joined to, so hashing it
    saves sorting them once more than the window needs."""
    return side.hint("shuffle_hash")


def dense_position(
    df: DataFrame, pos: str, within=(), out: str = "position", block: int = BLOCK
) -> DataFrame:
    """Renumber the rows that are left 0, 1, ... in the order of ``pos``."""
    within = list(within)
    blocked = _with_offsets(_blocks(df, pos, block), F.lit(1), within, F.count)
    inside = Window.partitionBy(*within, "_block").orderBy(pos)
    number = F.row_number().over(inside) - 1 + F.coalesce("_offset", F.lit(0))
    return blocked.withColumn(out, number.cast("bigint")).drop("_block", "_offset")


def prefix_sum(
    df: DataFrame, pos: str, value: str, within=(), out: str = "running", block: int = BLOCK
) -> DataFrame:
    """Running sum in the order of ``pos``; NULL is skipped and stays NULL."""
    within = list(within)
    blocked = _with_offsets(_blocks(df, pos, block), F.col(value), within, F.sum)
    inside = Window.partitionBy(*within, "_block").orderBy(pos).rowsBetween(
        Window.unboundedPreceding, 0
    )
    total = F.sum(value).over(inside) + F.coalesce("_offset", F.lit(0))
    return blocked.withColumn(out, F.when(F.col(value).isNotNull(), total)).drop(
        "_block", "_offset"
    )


def previous_value(
    df: DataFrame, pos: str, value: str, within=(), out: str = "previous", block: int = BLOCK
) -> DataFrame:
    """Value of the row just before in the order of ``pos`` (NULL for the first)."""
    within = list(within)
    blocked = _blocks(df, pos, block)
    last = blocked.groupBy(*within, "_block").agg(
        F.max(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))).alias("_last")
    )
    order = Window.partitionBy(*within).orderBy("_block")
    last = last.select(
        *within, "_block", F.lag(F.col("_last.v")).over(order).alias("_edge")
    )
    inside = Window.partitionBy(*within, "_block").orderBy(pos)
    before = F.when(F.row_number().over(inside) == 1, F.col("_edge")).otherwise(
        F.lag(value).over(inside)
    )
    return blocked.join(_hashed(last), [*within, "_block"]).withColumn(out, before).drop("_block", "_edge")


def group_sizes(df: DataFrame, within) -> DataFrame:
    """within, n: rows per group. Stored, so later joins plan with its true size."""
    return store(df.groupBy(*within).agg(F.count(F.lit(1)).alias("n")), "sizes")


def _with_group_value(df: DataFrame, values: DataFrame, name: str, within) -> DataFrame:
    """Attach a column that has one value for each group; without groups it is one scalar."""
    if within:
        return df.join(values.select(*within, name), list(within), "left")
    return df.withColumn(name, values.select(name).scalar())


#: bits of a draw that one histogram looks at, and how often it is refined at most
_BITS, _ROUNDS = 12, 2
#: rows of a group that are left to be ranked, about
_LAST = 4096
#: standard deviations by which the draws of a small group may be unlike uniform ones before all are ranked
_SPREAD = 6.0


def lowest_cuts(rows: DataFrame, draw: str, tie, wanted: DataFrame, within=(), spread: float | None = _SPREAD) -> DataFrame:
    """within, _cut: the last of the ``_k`` smallest (draw, tie) of each group; no row for groups with none.

    ``rows`` needs only within, draw and tie. Groups of a few thousand rows are ranked, first only their rows up to the
    draw below which ``_k`` of n uniform draws lie by ``spread`` standard deviations; groups that have fewer rows there are
    ranked whole afterwards. In larger ones a histogram
    counts the draws by their first bits, as many as the group's size asks for, up to 12; the next
    one counts those in the bin where the group's count is reached by 12 more. The rows left in the last bin
    are ranked. ``wanted`` has within, n (the rows of the group) and _k.
    """
    within, tie = list(within), list(tie)
    key = F.struct(F.col(draw).alias("_draw"), *tie)
    wanted = wanted.where("_k > 0")
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / F.lit(float(_LAST)))), F.lit(0)), F.lit(_BITS * _ROUNDS)).cast("int")
    top = F.lit(None).cast("double")
    if spread is not None:
        top = F.when(bits == 0, (F.col("_k") + F.sqrt(F.col("_k") + F.lit(1.0)) * F.lit(spread)) / F.col("n"))
    left = wanted.select(*within, F.col("_k").alias("_left"), bits.alias("_bits"), F.struct(bits.alias("bits"), top.alias("top")).alias("_first"))
    most = left.agg(F.max("_bits")).first()[0]
    if most is None:
        return rows.where("false").select(*within, key.alias("_cut"))
    earlier = Window.partitionBy(*within).orderBy("_bin").rowsBetween(*_BEFORE)
    near = F.col("_first.top").isNull() | F.col(draw).isNull() | (F.col(draw) <= F.col("_first.top"))
    inside = _with_group_value(rows, left, "_first", within).where(F.col("_first").isNotNull() & near)
    inside = inside.withColumn("_bits", F.col("_first.bits")).drop("_first")
    for step in range(1, -(-most // _BITS) + 1):
        scale = F.pow(F.lit(2.0), F.least(F.col("_bits"), F.lit(_BITS * step)))
        binned = inside.withColumn("_bin", F.floor(F.col(draw) * scale))
        counts = binned.groupBy(*within, "_bits", "_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn(
            "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        )
        joined = _with_group_value(counts, left, "_left", within)
        # the bin where the count is reached: one row for each group
        left = store(
            joined.where((F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_before") + F.col("_n"))).select(
                *within, (F.col("_left") - F.col("_before")).alias("_left"), "_bin"
            ), "cut_bins",
        )
        inside = binned.join(left.select(*within, "_bin"), [*within, "_bin"], "left_semi").drop("_bin")
    order = Window.partitionBy(*within).orderBy(draw, *tie)
    ranked = inside.select(*within, key.alias("_cut"), F.row_number().over(order).alias("_at"))
    joined = _with_group_value(ranked, left, "_left", within)
    cuts = store(joined.where(F.col("_at") == F.col("_left")).select(*within, "_cut"), "cuts")
    if spread is None:
        return cuts
    if within:
        short = wanted.join(cuts.select(*within), within, "left_anti")
    else:
        short = wanted.where(F.lit(cuts.isEmpty()))
    return cuts if short.isEmpty() else cuts.unionByName(lowest_cuts(rows, draw, tie, short, within, None))


def cut_points(
    df: DataFrame, draw, tie, how_many: Column, within=(), sizes: DataFrame | None = None
) -> DataFrame:
    """within, _point: what ``below_cut`` compares with to flag ``how_many`` rows of each group (see ``take_lowest``).

    Groups that are taken whole need no search.
    """
    within, tie = list(within), list(tie)
    sizes = group_sizes(df, within) if sizes is None else sizes
    wanted = sizes.select(*within, "n", F.least(how_many, F.col("n")).cast("bigint").alias("_k"))
    cuts = lowest_cuts(df.select(*within, _col(draw).alias("_draw"), *tie), "_draw", tie, wanted.where("_k < n"), within)
    none = F.lit(None).cast(cuts.schema["_cut"].dataType)
    whole = wanted.where("_k = n").select(*within, F.struct(F.lit(True).alias("whole"), none.alias("cut")).alias("_point"))
    return cuts.select(*within, F.struct(F.lit(False).alias("whole"), F.col("_cut").alias("cut")).alias("_point")).unionByName(whole)


def below_cut(df: DataFrame, points: DataFrame, draw, tie, within=(), out: str = "chosen") -> DataFrame:
    """Flag the rows up to the cut point of their group; rows of groups that are taken whole need no draw."""
    marked = _with_group_value(df, points, "_point", list(within))
    taken = F.col("_point.whole") | (F.struct(_col(draw).alias("_draw"), *tie) <= F.col("_point.cut"))
    return marked.withColumn(out, F.coalesce(taken, F.lit(False))).drop("_point")


def take_lowest(
    df: DataFrame, draw, tie, how_many: Column, within=(), out: str = "chosen", sizes: DataFrame | None = None
) -> DataFrame:
    """Flag exactly ``how_many`` rows per group: those with the smallest draws.

    ``draw``, a column or its name, is uniform in [0, 1), ``tie`` makes the order total and
    ``how_many`` is an expression over ``n``, the rows of the group. Each group's cut
    point is found from the draws alone (``lowest_cuts``); the rows then only compare
    themselves with it, so wide rows are neither sorted nor ranked. ``sizes`` may pass group
    sizes that are already known.
    """
    points = cut_points(df, draw, tie, how_many, within, sizes)
    return below_cut(df, points, draw, tie, within, out)
