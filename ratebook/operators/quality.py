"""Data-quality guards and run counts (G1, G3, G4, A1, uniqueness).

Two forms for each check: a lazy ``DataFrame`` of offending rows (usable as
a query and in tests) and a guard that raises with a useful message.  Guards
are actions; jobs run them on small staged frames, not on raw history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratebook.schemas import OUT_RATE

SAMPLE = 20  # offending values named in an error message


class GuardError(ValueError):
    """A pipeline edge received data it must not pass on."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """G1: stop when a pipeline edge is empty (one bounded action)."""
    if df.isEmpty():
        raise GuardError(f"{what}: no rows")
    return df


def completeness_gaps(quotes: DataFrame, targets: list[str]) -> DataFrame:
    """G3 rows: (period, to_curr) where a configured target has no quote.

    One aggregate per period (a presence flag per configured target, with a
    map-side partial step), then each period emits its missing targets
    through a generator: the quotes are read once and nothing is joined.
    """
    wanted = sorted(set(targets))
    if not wanted:
        return quotes.select("period", F.lit(None).cast("string").alias("to_curr")).where(F.lit(False))
    flags = [F.max(F.when(F.col("from_curr") == F.lit(t), F.lit(True))).alias(f"_has{i}")
             for i, t in enumerate(wanted)]
    per_period = quotes.groupBy("period").agg(*flags)
    missing = F.array(*[F.when(F.col(f"_has{i}").isNull(), F.lit(t)) for i, t in enumerate(wanted)])
    return (per_period.select("period", F.explode(missing).alias("to_curr"))
            .where(F.col("to_curr").isNotNull()))


def check_complete(quotes: DataFrame, targets: list[str]) -> None:
    """G3 guard: every target needs a quote in every period."""
    gaps = completeness_gaps(quotes, targets).orderBy("period", "to_curr").take(SAMPLE)
    if gaps:
        listed = ", ".join(f"{r['to_curr']} in {r['period']}" for r in gaps)
        raise GuardError(f"no quote to the base currency for: {listed}")


def invalid_rates(df: DataFrame, col: str = "Rate") -> DataFrame:
    """G4 rows: a non-null ``col`` that does not parse as a decimal."""
    c = F.col(col)
    return df.where(c.isNotNull() & c.cast("string").try_cast(OUT_RATE).isNull())


def check_rates(df: DataFrame, col: str = "Rate") -> None:
    """G4 guard: raise naming sample values that are not decimals."""
    bad = invalid_rates(df, col).select(col).limit(SAMPLE).collect()
    if bad:
        raise GuardError("invalid rate values: " + ", ".join(repr(r[0]) for r in bad))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present more than once (aggregate with a map-side partial step)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, keys: list[str], what: str, copies: dict[str, int] | None = None,
                 copied: str = "TO_CURRNCY") -> None:
    """Raise where a key has more than one row, or more than ``copies`` gives for its ``copied`` value."""
    dups = duplicate_keys(df, keys)
    if repeated := {v: n for v, n in (copies or {}).items() if n > 1}:
        listed = F.create_map(*[F.lit(x) for pair in repeated.items() for x in pair])
        dups = dups.where(F.col("n") > F.coalesce(F.try_element_at(listed, F.col(copied)), F.lit(1)))
    dups = dups.limit(SAMPLE).collect()
    if dups:
        raise GuardError(f"{what}: keys {keys} not unique, e.g. "
                         + "; ".join(str(tuple(r[k] for k in keys)) for r in dups))


def periods_sharing_a_month(quotes: DataFrame) -> DataFrame:
    """Months (by the month end of ``end``) that hold more than one period.

    Under rate type V every period of a month gets the same VALID_FROM, so
    such a history must be narrowed first (one period per month).
    """
    from ratebook.functions.dates import month_end
    return (quotes.groupBy(month_end("end").alias("valid_from"))
            .agg(F.countDistinct("period").alias("periods"))
            .where(F.col("periods") > 1))


def check_one_period_per_month(quotes: DataFrame) -> None:
    bad = periods_sharing_a_month(quotes).orderBy("valid_from").limit(SAMPLE).collect()
    if bad:
        raise GuardError("rate type V needs one period per month; several periods in: "
                         + ", ".join(f"{r.valid_from} ({r.periods})" for r in bad))


def null_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where any of ``cols`` is NULL, with the names of those columns."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(names != "").withColumn("null_fields", names)


def check_not_null(df: DataFrame, cols: list[str], what: str,
                   label: list[str] | None = None) -> None:
    """K1's NOT NULL contract: every output column must be filled.  Sample
    rows are named by ``label`` (default: the first two columns)."""
    bad = null_fields(df, cols).limit(SAMPLE).collect()
    if bad:
        label = label or cols[:2]
        raise GuardError(f"{what}: NULL in required columns, e.g. " + "; ".join(
            "->".join(str(r[c]) for c in label) + f": {r['null_fields']}" for r in bad))


def observe_counts(df: DataFrame, name: str, *extra) -> tuple[DataFrame, Observation]:
    """A1: count rows (and any extra aggregates) as a side effect of the next
    action on ``df`` -- no second job over the data."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs
