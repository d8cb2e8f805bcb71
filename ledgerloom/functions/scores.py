"""Composite scores with their weights, which are part of the contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clamp, col


@dataclass(frozen=True)
class Weights:
    """Weights by feature name; a feature that is NULL counts as 0."""

    parts: tuple[tuple[str, float], ...]

    def score(self, **features: str | Column) -> Column:
        names = [k for k, _ in self.parts]
        if set(features) != set(names):
            raise ValueError(f"features wanted: {names}")
        total = F.lit(0.0)
        for k, w in self.parts:
            total = total + F.lit(w) * F.coalesce(col(features[k]).cast("double"), F.lit(0.0))
        return total


RECEIPT_REMITTANCE = Weights((("amount", 0.45), ("date", 0.20), ("name", 0.25), ("address", 0.10)))
REMITTANCE_INVOICE = Weights((("amount", 0.35), ("name", 0.25), ("date", 0.20), ("address", 0.15), ("number", 0.05)))
RECEIPT_INVOICE_LINE = Weights((("amount", 0.55), ("name", 0.20), ("address", 0.10), ("dates", 0.10), ("cluster", 0.05)))
#: Adds up to 1.2, as an amount that agrees comes first.
RECEIPT_INVOICE_BRIEF = Weights((("amount", 1.0), ("name", 0.2)))
RERANK = Weights((("cosine", 0.55), ("amount", 0.25), ("date", 0.18), ("reference", 0.02)))
BLOCK_RECEIPT = Weights((("amount", 0.60), ("date", 0.30), ("user", 0.05), ("name", 0.05)))
BLOCK_REMITTANCE = Weights((("amount", 0.55), ("date", 0.20), ("company", 0.15), ("number", 0.10)))
FEW_RECEIPT = Weights((("amount", 0.75), ("date", 0.20), ("user", 0.05)))
FEW_REMITTANCE = Weights((("amount", 0.65), ("date", 0.20), ("company", 0.10), ("number", 0.05)))
COST_GLOBAL = Weights((("judge", 0.65), ("cosine", 0.25), ("amount", 0.07), ("date", 0.03)))
COST_BLOCK = Weights((("judge", 0.85), ("date", 0.10), ("user", 0.05)))
JUDGE_SHARE, JUDGE_LEAST = 0.65, 0.55


def cost(score: Column) -> Column:
    """Whole cost of an edge from 0 (certain) to 1000."""
    return F.round((F.lit(1.0) - clamp(score)) * 1000).cast("long")


def blended(judge: str | Column, pre: str | Column) -> Column:
    """The judge's confidence with the score before it; that score alone where there was no judge."""
    return F.when(col(judge).isNull(), col(pre)).otherwise(JUDGE_SHARE * col(judge) + (1 - JUDGE_SHARE) * col(pre))


def keeps(is_match: str | Column, judge: str | Column, pre: str | Column, high: float) -> Column:
    return F.when(col(judge).isNull(), col(pre) >= high).otherwise(F.coalesce(col(is_match), F.lit(False)) & (col(judge) >= JUDGE_LEAST))
