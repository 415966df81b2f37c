"""Equi-depth blocks of an ordered column, shared by the blocked scans and the
interval joins.

Bounds are approximate quantiles, so every block holds about as many rows.  A
value that fills more than one quantile (a burst at one instant, or rows
without a value) is cut further at quantiles of a tie number.  Blocks are
numbered 0, 1, 2... along (value, flag, tie); a null value counts as the least.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
LEAST = float("-inf")


@dataclass(frozen=True)
class Cuts:
    """Lower bounds ``values`` (increasing), and for the values that are cut
    further their inner bounds of the tie number.  ``sides`` is 2 when a 0/1
    flag orders rows of one value before the tie does."""
    values: tuple[float, ...]
    ties: dict
    sides: int = 1

    def firsts(self) -> list[int]:
        """The first block of each span of values: below the first bound, then
        from every bound to the next; one more entry holds the block count."""
        out, n = [0], 1
        for v in self.values:
            out.append(n)
            n += (self.sides * (len(self.ties[v]) + 1) if v in self.ties else 0) + 1
        return [*out, n]

    @property
    def blocks(self) -> int:
        return self.firsts()[-1]

    def _span(self, df: DataFrame, value: Column, out: str) -> DataFrame:
        """Number of bounds at or below ``value``, by binary search."""
        if not self.values:
            return df.withColumn(out, F.lit(0))
        from pyspark.ml.feature import Bucketizer
        # Bucketizer wants three splits at least and no infinite inner bound
        finite = [v for v in self.values if abs(v) != -LEAST]
        x = df.withColumn("__bz", F.when(value == F.lit(LEAST), F.lit(None)).when(F.isnan(value), F.lit(-LEAST))
                          .otherwise(value).cast("double"))
        if finite:
            x = Bucketizer(splits=[float("-inf"), *finite, float("inf")], inputCol="__bz", outputCol="__bo",
                           handleInvalid="keep").transform(x)
            at = F.col("__bo").cast("int")
        else:
            x, at = x.withColumn("__bo", F.lit(0)), F.lit(0)
        low = 1 if self.values[0] == LEAST else 0
        span = F.when(F.col("__bz").isNull(), F.lit(low))
        if self.values[-1] == -LEAST:
            span = span.when(F.col("__bz") == F.lit(-LEAST), F.lit(len(self.values)))
        return x.withColumn(out, span.otherwise(at + low)).drop("__bz", "__bo")

    def with_block(self, df: DataFrame, value: Column, tie: Column | None, out: str, flag: Column | None = None) -> DataFrame:
        """``df`` plus the block of (value, flag, tie).  Without a tie: the
        first block that may hold the value."""
        value = F.coalesce(value, F.lit(LEAST))
        x = self._span(df, value, "__span")
        place = F.get(F.array(*[F.lit(n) for n in self.firsts()[:-1]]), F.col("__span"))
        for v, cuts in self.ties.items():
            here, per_side = value == F.lit(v), len(cuts) + 1
            if tie is None:
                inner = F.lit(0)
            else:
                inner = F.size(F.filter(F.array(*[F.lit(b) for b in cuts]), lambda b: tie >= b)) if cuts else F.lit(0)
                if flag is not None:
                    inner = inner + flag.cast("int") * per_side
            past = F.col("__span") == F.lit(self.values.index(v) + 1)
            place = place + F.when(here, inner).when(past, F.lit(self.sides * per_side)).otherwise(F.lit(0))
        return x.withColumn(out, place).drop("__span")

    def with_last_below(self, df: DataFrame, value: Column, out: str, inclusive: bool = False) -> DataFrame:
        """``df`` plus the last block that can hold a value below ``value``
        (or equal to it, ``inclusive``)."""
        x = self._span(df, value, "__span")
        firsts = self.firsts()
        end = F.get(F.array(*[F.lit(n) for n in firsts[1:]]), F.col("__span")) - 1
        if not inclusive and self.values:
            bound = F.get(F.array(*[F.lit(v) for v in (LEAST, *self.values)]), F.col("__span"))
            begin = F.get(F.array(*[F.lit(n) for n in firsts[:-1]]), F.col("__span"))
            end = F.when((F.col("__span") > 0) & (value == bound), begin - 1).otherwise(end)
        return x.withColumn(out, end).drop("__span")


def equi_depth(df: DataFrame, value: Column, tie: Column, n: int, flagged: bool = False) -> Cuts:
    """Cuts into about ``n`` blocks; two small aggregates (the second only
    when a value fills several quantiles)."""
    if n <= 1:
        return Cuts((), {})
    x = df.select(F.coalesce(value.cast("double"), F.lit(LEAST)).alias("v"), tie.cast("double").alias("t"))
    got = x.select(F.percentile_approx("v", [i / n for i in range(1, n)], ACCURACY)).first()[0]
    count = Counter(float(v) for v in got or [] if v == v)
    heavy = [v for v, c in count.items() if c > 1]
    ties = {}
    if heavy:
        aggs = [F.percentile_approx(F.when(F.col("v") == F.lit(v), F.col("t")),
                                    [i / (count[v] + 1) for i in range(1, count[v] + 1)], ACCURACY).alias(f"c{i}")
                for i, v in enumerate(heavy)]
        ties = {v: sorted({float(b) for b in q or []}) for v, q in zip(heavy, x.agg(*aggs).first())}
    return Cuts(tuple(sorted(count)), ties, 2 if flagged else 1)
