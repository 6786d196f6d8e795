"""Rate derivation: mid quotes, target mids, cross rates, union (P1-P4, J1-J3,
N1, U2, F3, G5).

Over a history every operator is keyed by ``period`` (the quote document's
``start``); one period is the special case the reference runs.  The quote x
target product of a period comes from a per-period row of target mids (an
aggregate with a map-side step), joined back on ``period``, plus a generator:
no window, no join product, no nested-loop join.
Target lists are driver-side configuration (a list of codes), which is what
bounds every broadcast and generator built from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.numbers import cross_rate, mid_rate, parse_rate
from ratebook.schemas import RATIO, WIDE_RATE
from ratebook.sources.config import BASE_CURRENCY, target_list


def quote_mid(items: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Quote items (text buy/sell) -> quotes to the base currency.

    ``items`` has ``period, pos, code, buyValue, sellValue, start, end``.
    Text is cast straight to DECIMAL(24,12) (malformed text raises), and
    ``code`` becomes ``from_curr``.  ``mid2`` is twice the mid rate, exact.
    """
    buy = parse_rate("buyValue", "buyValue")
    sell = parse_rate("sellValue", "sellValue")
    return (items
            .select("period", "pos", F.col("code").alias("from_curr"),
                    buy.alias("buyValue"), sell.alias("sellValue"), "start", "end")
            .withColumns({"fx_rate": mid_rate("buyValue", "sellValue"), "to_curr": F.lit(base),
                          "mid2": (F.col("buyValue") + F.col("sellValue")).cast(RATIO)}))


def drop_self_pairs(rates: DataFrame) -> DataFrame:
    """remove ``from_curr = to_curr`` (also a base->base source row)."""
    return rates.where(F.col("from_curr") != F.col("to_curr"))


def target_mids(quotes: DataFrame, targets: list[str]) -> DataFrame:
    """J3/A2 in table form: each target's own mid rate per period, first
    quote by ``pos``.

    ``min_by`` is an aggregate with a map-side partial step, so a target
    quoted many times in one period never lands in one task as a whole.  The
    broadcast side is the configured list (its length is known).
    """
    names = target_list(quotes.sparkSession, list(dict.fromkeys(_target_names(targets))))
    wanted = F.broadcast(names.select(F.col("to_curr").alias("_target")))
    return (quotes
            .join(wanted, F.col("from_curr") == F.col("_target"))
            .groupBy("period", "_target")
            .agg(F.min_by("fx_rate", "pos").alias("target_mid"))
            .withColumnRenamed("_target", "to_curr"))


def _target_names(targets) -> list[str]:
    """The configured target list on the driver (duplicates kept, in order)."""
    if isinstance(targets, DataFrame):
        raise TypeError("pass the configured target list (a list of codes)")
    return list(targets)


def period_mids(quotes: DataFrame, targets: list[str]) -> DataFrame:
    """One row per period with each target's first quote (``_mid0``, ``_mid1``, ...; NULL where not quoted).

    ``min_by`` has a map-side step, so a period with very many quotes is
    reduced in every task.  The whole quote row is kept: the aggregate then
    reads the same columns as the quotes it is joined to, and Spark derives
    them once (the exchange below both is reused).
    """
    first = F.struct(*quotes.columns)
    return quotes.groupBy(F.col("period").alias("_period")).agg(
        *[F.min_by(first, F.when(F.col("from_curr") == F.lit(t), F.col("pos"))).alias(f"_mid{i}")
          for i, t in enumerate(targets)])


def attach_target_mids(quotes: DataFrame, targets: list[str]) -> DataFrame:
    """J3 in column form: every quote row gets each target's first quote of its period.

    A join on ``period`` (a NULL period is a period of its own) with one row
    per period, whether a target is quoted in it or not: broadcast where it is
    measured small, else a shuffle join whose skewed periods AQE splits.
    """
    names = list(dict.fromkeys(targets))
    if not names:
        return quotes
    mids = period_mids(quotes, names)
    return quotes.join(mids, F.col("period").eqNullSafe(F.col("_period"))).drop("_period")


def _generated_rates(quotes: DataFrame, targets: list[str], with_mid_rows: bool) -> DataFrame:
    """Mid rows and/or cross rows from ONE pass over the quotes.

    Each quote row emits ``[its own mid row] + [one cross row per target]``
    through a generator.  A target without a quote in the period raises, naming the target and period (the source
    stops the run in that case too); a NULL quote gives NULL rates, which the
    runners' NOT NULL check names.
    """
    targets = _target_names(targets)
    names = list(dict.fromkeys(targets))
    if "mid2" not in quotes.columns:
        quotes = quotes.withColumn("mid2", (F.col("fx_rate") + F.col("fx_rate")).cast(RATIO))
    q = attach_target_mids(quotes, names)
    keep = [c for c in quotes.columns if c not in ("to_curr", "fx_rate", "mid2")]
    parts = []

    def rate_row(to_curr, rate, num, den):
        return F.struct(to_curr.alias("to_curr"), rate.cast(WIDE_RATE).alias("fx_rate"),
                        num.cast(RATIO).alias("fx_num"), den.cast(RATIO).alias("fx_den"))

    if with_mid_rows:
        parts.append(F.array(rate_row(F.col("to_curr"), F.col("fx_rate"), F.col("mid2"), F.lit(2))))
    if targets:
        # One higher-order expression over the configured list (repeats kept):
        # the rate expression, with its checks, is written once instead of
        # once per target.
        listed = F.array(*[F.lit(t) for t in targets])
        slots = F.array(*[F.lit(names.index(t)) for t in targets])
        mids = F.array(*[F.col(f"_mid{i}") for i in range(len(names))])

        def cross_row(i):
            t = F.element_at(listed, i + 1)
            mid = F.element_at(mids, F.element_at(slots, i + 1) + 1)
            missing = F.raise_error(F.concat(F.lit("no quote for target "), t, F.lit(" in period "),
                                             F.coalesce(F.col("period"), F.lit("NULL"))))
            twice = (F.col("sellValue") + F.col("sellValue")).cast(RATIO)
            rate = F.when(mid.isNull(), missing).otherwise(cross_rate(twice, mid["mid2"], t))
            return rate_row(t, rate, twice, mid["mid2"])

        parts.append(F.transform(F.sequence(F.lit(0), F.lit(len(targets) - 1)), cross_row))
    if not parts:
        none = rate_row(F.col("to_curr"), F.col("fx_rate"), F.col("mid2"), F.lit(2))
        return q.select(*keep, none.alias("_r")).select(*keep, "_r.*").where(F.lit(False))
    rows = parts[0] if len(parts) == 1 else F.concat(*parts)
    return (q.select(*keep, F.explode(rows).alias("_r"))
            .select(*keep, "_r.*"))


def cross_rates(quotes: DataFrame, targets: list[str]) -> DataFrame:
    """J2 + N1 + U1: every quote x every target in the same period.

    ``fx_rate(X->T) = sellValue(X) / mid(T)``: sell over mid, on purpose.
    The per-target blocks come out of one generator instead of a loop of
    unions; repeated targets give repeated rows, like the source.
    """
    return _generated_rates(quotes, targets, with_mid_rows=False)


def all_rates(quotes: DataFrame, targets, skipped: bool = False,
              base: str = BASE_CURRENCY) -> DataFrame:
    """F2 + U2 + F3 (+ G5): mid rows and cross rows, self pairs removed.

    The base currency is removed from the target list first (F2).
    ``skipped=True`` is the pass-through mode of the rare-currency jobs: the
    input comes back unchanged -- no cross rows and no self-pair filter.
    """
    if skipped:
        return quotes
    ts = [t for t in _target_names(targets) if t != base]
    return drop_self_pairs(_generated_rates(quotes, ts, with_mid_rows=True))


def union_rates(quotes: DataFrame, targets, base: str = BASE_CURRENCY) -> DataFrame:
    """U2 alone: mid rows and cross rows, self pairs still in."""
    ts = [t for t in _target_names(targets) if t != base]
    return _generated_rates(quotes, ts, with_mid_rows=True)


def rare_pair_grid(rare: DataFrame, targets: list[str]) -> DataFrame:
    """Every rare currency x every target, no self-pair filter.

    ``targets`` is the configured list (known on the driver); each rare row
    emits one row per target through a generator, so the grid costs no join
    and its size is ``rows(rare) * len(targets)``.
    """
    arr = F.array(*[F.lit(t) for t in targets])
    return (rare.select("from_curr", "c_pos", F.posexplode(arr).alias("t_pos", "to_curr"))
            .select("from_curr", "to_curr", "c_pos", F.col("t_pos").cast("int").alias("t_pos")))


def rare_quotes_to_rates(rare_quotes: DataFrame) -> DataFrame:
    """Rare quotes (text rate) -> the rate frame the enrich step expects."""
    return (rare_quotes
            .select(F.col("start").alias("period"), "from_curr", "to_curr",
                    parse_rate("fx_rate").cast(WIDE_RATE).alias("fx_rate"), "start", "end"))
