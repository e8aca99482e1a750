"""Client-account life cycle: entries paired with exits, journey, active flag.

One function per step; ``client_accounts_from`` chains them.  Scopes differ by
design: the never-left branch reads the run day's snapshot, the exit branch
reads every snapshot of the accounts that ever left.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import account_key
from ..functions.rules import (entry_or_exit, event_date, is_active, journey_label,
                               journey_override, opening_date)
from ..sources.scans import scan_since, scan_snapshot
from .joins import DEFAULT_BROADCAST_ROWS, materialise, maybe_broadcast
from .ordering import DEFAULT_MAX_GROUP_ROWS, DETECT, hot_keys, ordinal, split_by_hot_keys
from .watch import Watch

# Above this many listed accounts the exclusion becomes a join against a
# DataFrame built from the list (its size is the list's, known on the driver).
_INLINE_LIST_MAX = 10_000

LIFECYCLE_COLUMNS = [
    "numero_cnpj_completo", "numero_unico_cliente", "agencia_conta", "canal",
    "data_aceite_ressegmentacao", "data_inicio_relacionamento_bancario", "data_encerramento_conta",
]


def with_account_key(cli: DataFrame) -> DataFrame:
    """Compute the ``branch_account`` key once, right after the scan."""
    return cli.withColumn("agencia_conta", account_key())


def exclude_accounts(df: DataFrame, excluded: Sequence[str], key: str = "agencia_conta") -> DataFrame:
    """Drop listed accounts, and rows without a key (as SQL ``NOT IN`` does).

    A NULL in the list drops every row, as ``NOT IN`` does; the result does
    not depend on the list's length.
    """
    keep = F.col(key).isNotNull()
    if not excluded:
        return df.where(keep)
    if any(a is None for a in excluded):
        return df.where(F.lit(False))
    if len(excluded) <= _INLINE_LIST_MAX:
        return df.where(keep & ~F.col(key).isin(list(excluded)))
    spark = df.sparkSession
    listed = spark.createDataFrame([(a,) for a in excluded], f"{key} string")
    listed = maybe_broadcast(listed, len(excluded) <= DEFAULT_BROADCAST_ROWS)
    return df.where(keep).join(listed, key, "left_anti")


def client_snapshot(cli: DataFrame, execute_date: int, excluded: Sequence[str]) -> DataFrame:
    """The run day's accounts, minus the excluded ones."""
    day = with_account_key(scan_snapshot(cli, execute_date))
    return exclude_accounts(day, excluded).select(
        F.col("cnpj").alias("numero_cnpj_completo"),
        F.col("id_cnpj_eq3").alias("numero_unico_cliente"),
        "agencia_conta", "canal", "data_aceite_ressegmentacao",
        F.col("data_abertura_conta").alias("data_inicio_relacionamento_bancario"),
        "data_encerramento_conta",
    )


def exit_accounts(cli: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Distinct accounts that ever had a resegmentation exit (all snapshots)."""
    exits = with_account_key(cli.where(F.col("canal") == K.CHANNEL_RESSEG_OUT))
    return exclude_accounts(exits.select("agencia_conta"), excluded).distinct()


def exit_history(cli: DataFrame, exits: DataFrame, small: bool = False) -> DataFrame:
    """Distinct events, over all snapshots, of the accounts in ``exits``.

    ``small`` (a measured size, see ``profile_decisions``) broadcasts the exit
    accounts: the semi-join then filters the raw rows map-side and the
    distinct combines before its exchange; otherwise a shuffle semi-join.
    """
    rows = with_account_key(cli).join(maybe_broadcast(exits, small), "agencia_conta", "left_semi")
    return rows.select(
        F.col("cnpj").alias("numero_cnpj_completo"),
        F.col("id_cnpj_eq3").alias("numero_unico_cliente"),
        "agencia_conta", "canal",
        event_date().alias("data_aceite_ressegmentacao"),
        F.col("data_abertura_conta").alias("data_inicio_relacionamento_bancario"),
    ).distinct()


def exit_ranks(history: DataFrame, method: str = "auto",
               max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
               sizes_from: DataFrame | None = None, hot: DataFrame | None | str = DETECT,
               watch: Watch | None = None, clustered: bool = False) -> DataFrame:
    """Ordinal of each event within (account, entry-or-exit side), oldest first.

    NULL dates sort last.  The history is distinct over all its columns, so
    ordering by all of them is total and the ordinals are reproducible.
    ``sizes_from`` (see ``exit_event_sizes``) lets the hot-group check count
    raw rows instead of recomputing the distinct history; ``hot`` (see
    ``hot_exit_groups``) skips the check.  ``watch`` counts accounts with
    several dates for one event in the same pass.  ``clustered`` says that the
    history is partitioned by account already.
    """
    by = ["data_aceite_ressegmentacao", "data_inicio_relacionamento_bancario", "canal",
          "numero_cnpj_completo", "numero_unico_cliente"]
    order = [F.col(c).asc_nulls_last() for c in by]
    # Outside hot groups an account holds at most 2 * max_group_rows rows, so
    # the window rows are partitioned by account alone: the entry/exit
    # pairing (keyed by account and ordinal) then reuses that exchange.
    def ranked(rows: DataFrame, method: str = method, hot: DataFrame | None | str = hot,
               clustered: bool = clustered) -> DataFrame:
        side = rows.withColumn("_side", entry_or_exit())
        cluster = ["agencia_conta"] if method == "auto" and not clustered else None
        return ordinal(side, ["agencia_conta", "_side"], order, "rank_cli", method=method,
                       max_group_rows=max_group_rows, sizes_from=sizes_from, hot=hot,
                       cluster_by=cluster, by=by).drop("_side")

    if watch is None or method != "auto":
        return ranked(history, clustered=clustered)
    if isinstance(hot, str):
        hot = hot_keys((history if sizes_from is None else sizes_from).withColumn("_side", entry_or_exit()),
                       ["agencia_conta", "_side"], max_group_rows)
    if hot is None:
        rows = history if clustered else history.repartition("agencia_conta")
        return ranked(watch.account_events(rows), hot=None, clustered=True)
    cold_rows, hot_rows = split_by_hot_keys(history, ["agencia_conta"], hot.select("_g0").distinct())
    watch.hot_account_events(hot_rows)
    if not clustered:
        cold_rows = cold_rows.repartition("agencia_conta")
    return (ranked(watch.account_events(cold_rows), hot=None, clustered=True)
            .unionByName(ranked(hot_rows)))


def exit_event_sizes(cli: DataFrame, exits: DataFrame, small: bool = False) -> DataFrame:
    """Raw (pre-distinct) rows of the leaving accounts, keyed like ``exit_ranks``.

    Per (account, side) there are at least as many raw rows as distinct
    events, so counting these bounds the group sizes from above, reading
    three columns of the client table and no shuffle of the history.
    """
    return (with_account_key(cli).join(maybe_broadcast(exits, small), "agencia_conta", "left_semi")
            .select("agencia_conta", entry_or_exit().alias("_side")))


def account_profile(cli: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Per account key (listed and keyless rows dropped): whether it ever had
    an exit, and its raw row counts on the entry and on the exit side.

    One map-side-combined aggregate over three columns of the client table
    gives both the exit accounts and upper bounds of every ranking group's
    size.
    """
    rows = exclude_accounts(with_account_key(cli).select("agencia_conta", "canal"), excluded)
    is_exit = F.coalesce(F.col("canal") == K.CHANNEL_RESSEG_OUT, F.lit(False))
    return rows.groupBy("agencia_conta").agg(
        F.max(is_exit).alias("has_exit"),
        F.sum(is_exit.cast("long")).alias("exit_rows"),
        F.sum((~is_exit).cast("long")).alias("entry_rows"))


def leavers(profile: DataFrame) -> DataFrame:
    """The part of a profile that later steps use, and so the part to store."""
    return profile.where(F.col("has_exit"))


def exits_of(profile: DataFrame) -> DataFrame:
    """The exit accounts, from a profile (same rows as ``exit_accounts``)."""
    return profile.where(F.col("has_exit")).select("agencia_conta")


def _hot_sides(max_group_rows: int):
    return (F.col("entry_rows") > max_group_rows, F.col("exit_rows") > max_group_rows)


def profile_counts(profile: DataFrame, max_group_rows: int) -> tuple[int, int]:
    """(exit accounts, accounts with a hot ranking group), in one small job.

    Only two numbers reach the driver.
    """
    entry_hot, exit_hot = _hot_sides(max_group_rows)
    row = profile.agg(
        F.sum(F.col("has_exit").cast("long")).alias("exits"),
        F.sum((F.col("has_exit") & (entry_hot | exit_hot)).cast("long")).alias("hot")).first()
    return int(row["exits"] or 0), int(row["hot"] or 0)


def hot_exit_groups(profile: DataFrame, max_group_rows: int) -> DataFrame:
    """Ranking groups (account, side) that may exceed ``max_group_rows``.

    At most rows / max_group_rows of them; named like ``ordinal``'s hot keys.
    """
    entry_hot, exit_hot = _hot_sides(max_group_rows)
    sides = F.array(F.when(entry_hot, F.lit(K.SIDE_ENTRY)),
                    F.when(exit_hot, F.lit(K.CHANNEL_RESSEG_OUT)))
    return (profile.where(F.col("has_exit"))
                   .select(F.col("agencia_conta").alias("_g0"), F.explode(sides).alias("_g1"))
                   .where(F.col("_g1").isNotNull()))


def profile_decisions(profile: DataFrame, max_group_rows: int,
                      method: str = "auto") -> tuple[DataFrame, bool, DataFrame | None]:
    """From a materialised profile: the exit accounts, whether they may be
    broadcast, and the hot ranking groups (None when there are none)."""
    n_exits, n_hot = profile_counts(profile, max_group_rows)
    hot = hot_exit_groups(profile, max_group_rows) if method == "auto" and n_hot else None
    return exits_of(profile), n_exits <= DEFAULT_BROADCAST_ROWS, hot


def never_left_accounts(snapshot: DataFrame, exits: DataFrame, small: bool = False) -> DataFrame:
    """Run-day accounts that never had an exit, with their own closing date."""
    return snapshot.join(maybe_broadcast(exits, small), "agencia_conta", "left_anti").select(
        "numero_cnpj_completo", "numero_unico_cliente", "agencia_conta", "canal",
        F.col("data_aceite_ressegmentacao").cast("date").alias("data_aceite_ressegmentacao"),
        F.col("data_inicio_relacionamento_bancario").cast("date")
         .alias("data_inicio_relacionamento_bancario"),
        F.col("data_encerramento_conta").cast("date").alias("data_encerramento_conta"),
    )


def account_lifecycle(ranks: DataFrame, never_left: DataFrame) -> DataFrame:
    """Pair the n-th entry with the n-th exit of the same account (by ordinal
    alone, with no date test), then add the never-left accounts.

    An entry without a same-ordinal exit stays open.  A NULL channel is
    neither an entry nor an exit here.  The reference states the pairing as
    a left self-join on (account, ordinal); an (account, ordinal) holds at
    most one entry and one exit, so a window over that key gives the same
    rows with one exchange instead of two, in groups of at most two rows
    even for a hot account.
    """
    pair = Window.partitionBy("agencia_conta", "rank_cli")
    is_exit = F.col("canal") == K.CHANNEL_RESSEG_OUT
    closed = F.max(F.when(is_exit, F.col("data_aceite_ressegmentacao"))).over(pair)
    paired = ranks.withColumn("_closed", closed).where(F.col("canal") != K.CHANNEL_RESSEG_OUT).select(
        "numero_cnpj_completo", "numero_unico_cliente", "agencia_conta", "canal",
        F.col("data_aceite_ressegmentacao").cast("date").alias("data_aceite_ressegmentacao"),
        F.col("data_inicio_relacionamento_bancario").cast("date")
         .alias("data_inicio_relacionamento_bancario"),
        F.col("_closed").cast("date").alias("data_encerramento_conta"),
    )
    return paired.unionByName(never_left.select(*LIFECYCLE_COLUMNS))


def journey_adjusted(lifecycle: DataFrame, to_outros: Sequence[str],
                     to_onboarding: Sequence[str]) -> DataFrame:
    """Journey = channel, except for accounts listed for a fixed journey.

    Long lists become a join against a DataFrame built from them.
    """
    journey = journey_override("agencia_conta", "canal", to_outros, to_onboarding)
    if len(to_outros) + len(to_onboarding) > _INLINE_LIST_MAX:
        fixed = {a: K.CHANNEL_ONBOARDING for a in to_onboarding}
        fixed |= {a: K.CHANNEL_OUTROS for a in to_outros}  # the first list wins
        listed = lifecycle.sparkSession.createDataFrame(
            [(a, j) for a, j in fixed.items() if a is not None], "agencia_conta string, _fixed string")
        lifecycle = lifecycle.join(maybe_broadcast(listed, len(fixed) <= DEFAULT_BROADCAST_ROWS),
                                   "agencia_conta", "left")
        journey = F.coalesce("_fixed", "canal")
    return lifecycle.select(
        "numero_cnpj_completo", "numero_unico_cliente", "agencia_conta", journey.alias("jornada"),
        "data_aceite_ressegmentacao", "data_inicio_relacionamento_bancario",
        "data_encerramento_conta",
    )


def client_accounts(adjusted: DataFrame, open_end: dt.date = K.OPEN_END) -> DataFrame:
    """Published account rows: label, opening and closing dates, active flag.

    The override comes first, so an overridden resegmentation entry gets the
    overriding label and the relationship-start date.  One ``distinct``; the
    flag is a function of the other columns.
    """
    return adjusted.select(
        "numero_cnpj_completo", "numero_unico_cliente", "agencia_conta",
        journey_label().alias("jornada"),
        opening_date().alias("data_abertura_conta_emps"),
        F.col("data_encerramento_conta").alias("data_encerramento_conta_emps"),
        is_active("data_encerramento_conta", open_end).alias("flag_conta_ativa"),
    ).distinct()


def client_accounts_from(cli: DataFrame, execute_date: int, excluded: Sequence[str] = (),
                         to_outros: Sequence[str] = (), to_onboarding: Sequence[str] = (),
                         open_end: dt.date = K.OPEN_END, method: str = "auto",
                         client_floor: int | None = None,
                         max_group_rows: int = DEFAULT_MAX_GROUP_ROWS,
                         watch: Watch | None = None) -> DataFrame:
    """The whole chain from the raw client table.

    ``client_floor`` optionally limits every client read to snapshots on or
    after that day (a partition filter); by default all snapshots are read,
    as the exit history needs them.  One account profile is materialised
    first: it gives the exit accounts (measured, then broadcast to both the
    semi- and the anti-join when small enough) and the hot ranking groups.
    """
    if client_floor is not None:
        cli = scan_since(cli, client_floor)
    profile = materialise(leavers(account_profile(cli, excluded)))
    exits, small, hot = profile_decisions(profile, max_group_rows, method)
    ranks = exit_ranks(exit_history(cli, exits, small), method=method,
                       max_group_rows=max_group_rows, hot=hot, watch=watch)
    lifecycle = account_lifecycle(ranks, never_left_accounts(
        client_snapshot(cli, execute_date, excluded), exits, small))
    return client_accounts(journey_adjusted(lifecycle, to_outros, to_onboarding), open_end)
