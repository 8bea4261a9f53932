"""Statistics across columns of one row, as plain JVM expressions in stages.

A mean used by every deviation, or a moment used by several statistics, is a
column of its own projection. Written as one expression each, it would be
repeated in every place that uses it, and a row of n columns would need an
expression of n squared terms.

The expressions are SQL text: a wide table then takes one call per projection
to build instead of one per operator.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

VALUE_STATS = ("sum", "median", "std", "min", "max", "mean_change")
HISTORY_STATS = ("mean", "median", "std", "mean_change")


@dataclass(frozen=True)
class RowGroup:
    """Columns to summarise, and the statistics wanted of them.

    ``values`` and ``shares`` are output prefixes. Shares are each value over
    the guarded sum of the group. The skew among them is that of the values.
    """

    columns: tuple[str, ...]
    values: str | None = None
    stats: tuple[str, ...] = VALUE_STATS
    shares: str | None = None
    guard: float = 0.001


def row_sum(cols: Sequence[str]) -> str:
    return "(" + " + ".join(cols) + ")"


def row_mean(cols: Sequence[str]) -> str:
    return f"({row_sum(cols)} / {len(cols)}D)"


def row_median(cols: Sequence[str]) -> str:
    if len(cols) == 3:
        a, b, c = cols
        return f"CAST(greatest(least({a}, {b}), least(greatest({a}, {b}), {c})) AS DOUBLE)"
    ordered = f"sort_array(array({', '.join(cols)}))"
    half, odd = divmod(len(cols), 2)
    if odd:
        return f"CAST({ordered}[{half}] AS DOUBLE)"
    return f"(({ordered}[{half - 1}] + {ordered}[{half}]) / 2D)"


def _power_mean(cols: Sequence[str], centre: str, power: int) -> str:
    return row_mean([" * ".join([f"({c} - {centre})"] * power) for c in cols])


def _first_stage(n: int, group: RowGroup) -> list[str]:
    cols = group.columns
    return [
        f"{row_sum(cols)} AS _sum{n}",
        f"{row_mean(cols)} AS _mean{n}",
        f"{row_median(cols)} AS _median{n}",
        f"least({', '.join(cols)}) AS _min{n}",
        f"greatest({', '.join(cols)}) AS _max{n}",
        f"({cols[-1]} - {cols[0]}) / {len(cols) - 1}D AS _mean_change{n}",
    ]


def _second_stage(n: int, group: RowGroup) -> list[str]:
    return [
        f"{_power_mean(group.columns, f'_mean{n}', 2)} AS _square{n}",
        f"{_power_mean(group.columns, f'_mean{n}', 3)} AS _cube{n}",
    ]


def _output(n: int, group: RowGroup) -> list[str]:
    made = []
    if group.values is not None:
        special = {"std": f"sqrt(_square{n})"}
        made += [f"{special.get(s, f'_{s}{n}')} AS {group.values}_{s}" for s in group.stats]
    if group.shares is not None:
        # Dividing every value by one total divides its statistics by it; a
        # negative total would swap the least and the greatest share.
        total = f"(_sum{n} + {group.guard}D)"
        low, high = f"_min{n} / {total}", f"_max{n} / {total}"
        made += [
            f"_median{n} / {total} AS {group.shares}_median",
            f"sqrt(_square{n}) / abs({total}) AS {group.shares}_std",
            f"least({low}, {high}) AS {group.shares}_min",
            f"greatest({low}, {high}) AS {group.shares}_max",
            f"CASE WHEN _square{n} > {NOISE} * _mean{n} * _mean{n} THEN _cube{n} / (_square{n} * sqrt(_square{n})) "
            f"ELSE 0D END AS {group.shares}_skew",
        ]
    return made


# A variance below this share of the squared mean is rounding noise of equal values.
NOISE = "1e-24D"


def with_row_stats(
    df: DataFrame, groups: Sequence[RowGroup], keep: Sequence[str] | None = None
) -> DataFrame:
    """Add the statistics of every group; population std and skew throughout."""
    numbered = list(enumerate(groups))
    collect = lambda stage: [e for n, g in numbered for e in stage(n, g)]
    staged = df.selectExpr("*", *collect(_first_stage)).selectExpr("*", *collect(_second_stage))
    return staged.selectExpr(*(keep or df.columns), *collect(_output))
