"""Ordered threshold ladders: the first rung that holds names the row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(rungs: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First matching rung wins; a NULL condition counts as not matching."""
    (condition, label), *rest = rungs
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


@dataclass(frozen=True)
class FloorLadder:
    """A ladder whose rungs all read "this column is below its floor"."""

    floors: tuple[tuple[str, str, float], ...]
    otherwise: str

    def label(self) -> Column:
        return ladder(
            [(F.col(column) < floor, label) for label, column, floor in self.floors],
            self.otherwise,
        )

    def clears(self) -> Column:
        """True exactly where ``label()`` gives ``otherwise``.

        Written as one plain comparison per column so that Parquet row groups
        are skipped; a CASE would be evaluated after reading everything.
        """
        return reduce(
            lambda a, b: a & b,
            [(F.col(c) >= floor) | F.col(c).isNull() for _, c, floor in self.floors],
        )


def significance(
    actionable: Column, vaf: Column, strong: Column, weak: Column
) -> Column:
    """Clinical significance from the panel flag, the fraction and the effect."""
    return ladder(
        [
            (actionable & (vaf > 0.05) & strong, "Pathogenic"),
            (actionable & (vaf > 0.01), "Likely pathogenic"),
            (strong & (vaf > 0.02), "Likely pathogenic"),
            (weak, "Benign"),
        ],
        "Uncertain significance",
    )


def qc_status(draw: Column, tumor_fraction: Column, low_fraction: float) -> Column:
    """QC outcome: a small share fails, poor draws are often put to review."""
    return ladder(
        [
            (draw < 0.02, "FAIL"),
            ((tumor_fraction < low_fraction) & (draw < 0.35), "REVIEW"),
        ],
        "PASS",
    )
