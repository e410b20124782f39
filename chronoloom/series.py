"""Declaring a DataFrame as a set of series."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions.calendar import DEFAULT_PERIOD, period_number, period_start


@dataclass(frozen=True)
class SeriesSpec:
    """Roles of the columns of a series frame; passed beside the DataFrame.

    ``t`` is the dense period number every ordered operator works on.
    ``gapless`` records that no period is missing inside a series.
    """

    keys: tuple[str, ...]
    index: str
    unit: str
    t: str = "t"
    period: float | None = None
    gapless: bool = False
    periods: dict[str, float] = field(default_factory=dict, compare=False)

    @property
    def m(self) -> float:
        return self.period if self.period is not None else DEFAULT_PERIOD[self.unit]

    @property
    def by(self) -> list[str]:
        return list(self.keys)

    def with_(self, **changes) -> "SeriesSpec":
        return replace(self, **changes)

    def index_expr(self, t: Column) -> Column:
        return period_start(t, self.unit)


def duplicates(df: DataFrame, keys, index: str) -> DataFrame:
    """(key, index) pairs that occur more than once."""
    return df.groupBy(*keys, index).agg(F.count("*").alias("rows")).where("rows > 1")


def to_series(df: DataFrame, keys, index: str, unit: str, period: float | None = None,
              check: bool = True, gapless: bool = False) -> tuple[DataFrame, SeriesSpec]:
    """Attach the period number ``t`` and return the frame with its spec.

    ``check`` runs one aggregation and raises if (key, index) is not unique.
    """
    keys = tuple([keys] if isinstance(keys, str) else keys)
    if check:
        bad = duplicates(df, keys, index).take(1)
        if bad:
            raise ValueError(f"duplicate (key, index): {bad[0].asDict()}")
    spec = SeriesSpec(keys, index, unit, period=period, gapless=gapless)
    return df.withColumn("t", period_number(F.col(index), unit)), spec


def update_index(df: DataFrame, spec: SeriesSpec, index: str | None = None, unit: str | None = None,
                 keys=None, regular: bool = False) -> tuple[DataFrame, SeriesSpec]:
    """Swap index and/or keys; ``regular`` declares the new index gap-free."""
    new = spec.with_(index=index or spec.index, unit=unit or spec.unit, gapless=regular,
                     keys=tuple(keys) if keys is not None else spec.keys,
                     period=spec.period if unit in (None, spec.unit) else None)
    return df.withColumn(new.t, period_number(F.col(new.index), new.unit)), new


def require_gapless(spec: SeriesSpec, what: str) -> None:
    if not spec.gapless:
        raise ValueError(f"{what} needs a gap-free series: call fill_gaps first")
