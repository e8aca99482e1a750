"""Order-based operators that stay correct and parallel under key skew.

``latest_per_key`` keeps the greatest row of each key with an aggregate, so
rows are combined map-side and a key holding a third of all rows never
lands whole in one task.

``ordinal`` numbers the rows of each group (``row_number``):

* ``method="window"``: the plain window, one hash exchange on the group key;
  one task sorts a whole group.
* ``method="sorted"``: a global range sort spreads even a single huge group
  over many partitions; each row gets its position inside its partition
  (materialised once with ``checkpoint()``), and a per-(group,
  partition) count table turns positions into ordinals.  Two large
  exchanges and one write instead of one exchange.
* ``method="cut"``: the data's own order values cut the groups.  One
  map-side-combined count per (key, leading order value) gives, by prefix
  sums, how many rows of the group come before each piece; rows meet that
  number by a join on the piece and are numbered inside it, in the join's
  own partitioning.  If a piece is still too large, the next order column
  cuts as well.  One exchange of the rows; no range sampling, no stored rows.
* ``method="auto"`` (default): decided by group size.  Groups above
  ``max_group_rows`` are found first with a map-side-combined count; there
  are at most ``rows / max_group_rows`` of them.  With such a group the
  data-cut ordinal numbers all rows; without one the plan is just the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33   # monotonically_increasing_id = partition index << 33 | row position

# A group up to this size is sorted by one task (a few seconds of work);
# larger ones are spread over many.  Same default as RunParams.max_group_rows.
DEFAULT_MAX_GROUP_ROWS = 1_000_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Sequence[str], extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys``: the ``values`` of the row with the greatest ``order``.

    ``order`` is compared left to right with NULL lowest, i.e.
    ``ORDER BY order DESC NULLS LAST`` then ``row_number() = 1``.  Exact ties
    on ``order`` resolve to the greatest ``values``, so the pick is
    reproducible.  ``max`` of one struct keeps a single aggregation buffer.
    """
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    picked = df.groupBy(*keys).agg(F.max(packed).alias("_latest"), *extra_aggs)
    rest = [c for c in picked.columns if c not in set(keys) | {"_latest"}]
    return picked.select(*keys, *[F.col(f"_latest.v{i}").alias(v) for i, v in enumerate(values)],
                         *rest)


def hot_keys(df: DataFrame, keys: Sequence[str], max_group_rows: int,
             sizes_from: DataFrame | None = None) -> DataFrame | None:
    """The groups of ``df`` with more than ``max_group_rows`` rows, or None.

    Counted with a map-side-combined aggregate, in its own small job; the
    result (at most rows / max_group_rows keys, a proven bound) is
    checkpointed so every later use reads the same keys.  ``sizes_from``
    may be a cheaper DataFrame with the same key columns whose per-key row
    counts are at least those of ``df`` (e.g. the rows before a distinct):
    then ``df`` itself is not computed for the check.
    """
    from ..plans.session import checkpoint_dir

    source = df if sizes_from is None else sizes_from
    gnames = [f"_g{i}" for i in range(len(keys))]
    found = (source.groupBy(*[F.col(k).alias(g) for k, g in zip(keys, gnames)])
                   .agg(F.count(F.lit(1)).alias("_size"))
                   .where(F.col("_size") > F.lit(max_group_rows))
                   .select(*gnames))
    checkpoint_dir(df.sparkSession)
    found = found.checkpoint(eager=True)
    return None if found.isEmpty() else found


def split_by_hot_keys(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other groups, rows of hot groups); ``hot`` comes from ``hot_keys``.

    The key set has at most rows / max_group_rows entries; it is also
    counted, and broadcast only within the broadcast row limit (a tiny
    threshold could make it large), else joined by shuffle.
    """
    from .joins import DEFAULT_BROADCAST_ROWS, at_most, maybe_broadcast

    gnames = [f"_g{i}" for i in range(len(keys))]
    cond = [F.col(k).eqNullSafe(F.col(g)) for k, g in zip(keys, gnames)]
    side = maybe_broadcast(hot, at_most(hot, DEFAULT_BROADCAST_ROWS))
    return (df.join(side, cond, "left_anti"),
            df.join(side, cond, "left_semi"))


DETECT = "detect"


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
            method: str = "auto", max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
            sizes_from: DataFrame | None = None, hot: DataFrame | None | str = DETECT,
            cluster_by: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Add ``name`` = ``row_number() OVER (PARTITION BY keys ORDER BY order)`` as int.

    ``order`` must be a total order within each group, as for any
    reproducible ``row_number``.  With ``method="auto"`` the group sizes are
    checked first (``hot_keys``), unless the caller already knows the hot
    groups (``hot``: a DataFrame of keys named ``_g0, _g1, ...``, or None for
    none); without a hot group the plan is the plain window.  ``cluster_by``
    (a prefix of ``keys``) hash-partitions the window's rows by fewer
    columns, so a later step keyed by the same columns reuses the exchange;
    only for "auto", where the window sees no hot group.  ``by`` names the
    columns that ``order`` sorts, for the data-cut ordinal; without it hot
    groups are split off and range-sorted.
    """
    keys = list(keys)
    order = list(order)
    if method == "window":
        return _ordinal_window(df, keys, order, name)
    if method == "sorted":
        return _ordinal_sorted(df, keys, order, name)
    if method == "cut":
        return ordinal_cut(df, keys, by, order, name, max_group_rows)
    if method != "auto":
        raise ValueError(f"unknown method {method!r}")
    if isinstance(hot, str):
        hot = hot_keys(df, keys, max_group_rows, sizes_from)
    if hot is None:
        return _ordinal_window(df, keys, order, name, cluster_by)
    if by:
        return ordinal_cut(df, keys, by, order, name, max_group_rows)
    cold_rows, hot_rows = split_by_hot_keys(df, keys, hot)
    return (_ordinal_window(cold_rows, keys, order, name, cluster_by)
            .unionByName(_ordinal_sorted(hot_rows, keys, order, name)))


def _ordinal_window(df: DataFrame, keys: list[str], order: list[Column], name: str,
                    cluster_by: Sequence[str] | None = None) -> DataFrame:
    if cluster_by:
        df = df.repartition(*cluster_by)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))


def _ordinal_sorted(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    from ..plans.session import checkpoint_dir

    cols = df.columns
    # Range partitioning samples the whole sort key, so a hot group is cut
    # into many partitions; the ids follow the sorted order.  The positioned
    # rows are checkpointed: the two uses below must see the very same
    # partitions (a second range shuffle would sample its own bounds), and a
    # lost executor must not change them.  The group is carried as one
    # struct column: never NULL and equal for equal keys (NULL fields too).
    checkpoint_dir(df.sparkSession)
    positioned = (df.orderBy(*[F.col(k).asc_nulls_first() for k in keys], *order)
                    .withColumn("_oid", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright(F.col("_oid"), _POS_BITS))
                    .withColumn("_key", F.struct(*keys))
                    .checkpoint(eager=True))
    counts = (positioned.groupBy(F.col("_key").alias("_gkey"), F.col("_part").alias("_gpart"))
                        .agg(F.count(F.lit(1)).alias("_n"), F.min("_oid").alias("_first")))
    # Rows of the same group in earlier partitions.  One row per
    # (group, partition): a group spans at most every partition.
    earlier = (Window.partitionBy("_gkey").orderBy("_gpart")
                     .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_gkey", "_gpart", "_first",
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # Rows of a group lie side by side inside a partition, so the distance to
    # the group's first row there is the position: no window over the rows.
    joined = positioned.join(offsets, (F.col("_key") == F.col("_gkey"))
                        & (F.col("_part") == F.col("_gpart")), "inner")
    return joined.select(*cols, (F.col("_before") + F.col("_oid") - F.col("_first") + 1)
                         .cast("int").alias(name))


def ordinal_cut(df: DataFrame, keys: Sequence[str], by: Sequence[str], order: Sequence[Column],
                name: str, max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
                maxima: dict[str, str] | None = None) -> DataFrame:
    """``ordinal`` with groups cut by their own order values; see the module.

    ``maxima`` (new column: column) adds maxima over the whole group: they
    are taken per piece in the same count and travel with the offsets.  Keys
    and order values may be NULL: pieces are compared as structs.
    """
    from .joins import materialise

    keys, by, order = list(keys), list(by), list(order)
    maxima = maxima or {}
    if not by or len(by) != len(order):
        raise ValueError("name the column of each order expression")
    for lead in range(1, len(by) + 1):
        cut = by[:lead]
        pieces = materialise(df.groupBy(*keys, *cut).agg(
            F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(new) for new, c in maxima.items()]))
        if lead == len(by) or (pieces.agg(F.max("_n")).first()[0] or 0) <= max_group_rows:
            break
    # Rows before the piece: per order column, those alike in the columns
    # before it and smaller in this one.  One row per piece is sorted here.
    table, before = pieces, F.lit(0)
    for k, column in enumerate(cut):
        same = [*keys, *cut[:k]]
        earlier = Window.partitionBy(*same).orderBy(order[k]).rowsBetween(Window.unboundedPreceding, -1)
        level = (pieces.groupBy(*same, column).agg(F.sum("_n").alias("_s"))
                 .select(F.struct(*same, column).alias("_level"),
                         F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias(f"_b{k}")))
        table = (table.withColumn("_level", F.struct(*same, column))
                 .join(level, "_level").drop("_level"))
        before = before + F.col(f"_b{k}")
    whole = Window.partitionBy(*keys)
    offsets = table.select(F.struct(*keys, *cut).alias("_piece"), before.alias("_before"),
                           *[F.max(new).over(whole).alias(new) for new in maxima])
    joined = df.withColumn("_piece", F.struct(*keys, *cut)).join(offsets, "_piece")
    inside = Window.partitionBy("_piece").orderBy(*order)
    return joined.select(*df.columns, *maxima, (F.col("_before") + F.row_number().over(inside))
                         .cast("int").alias(name))
