"""Deterministic weighted assignment (J1) and bounded uniform integers.

A row's key is hashed to 32 bits with integer arithmetic only (two
multiply-mod rounds with an xor-shift between them), so the result is the
same on every run, on every retry, and in any SQL engine that has 64-bit
integers. A category is chosen by comparing the hash against cumulative
integer weights: ``h * total < cum_k * 2^32``, no floating point. For lists
read from a table an alias table takes the place of the comparisons.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO32 = 1 << 32
TWO16 = 1 << 16

# Odd 32-bit multipliers used by the mixing rounds.
MULTIPLIERS = [2654435761, 2246822519, 3266489917, 668265263, 374761393]
GOLDEN = 2654435769  # per-salt offset


def _mul_mod32(x: Column, m: int) -> Column:
    """``(x * m) mod 2^32`` for ``0 <= x < 2^32`` without 64-bit overflow."""
    hi = F.floor(x / TWO16).cast("bigint")
    lo = F.pmod(x, F.lit(TWO16))
    return F.pmod(F.pmod(hi * F.lit(m), F.lit(TWO16)) * F.lit(TWO16) + lo * F.lit(m), F.lit(TWO32))


def hash32(key: Column, salt: int = 0) -> Column:
    """32-bit hash of an integer key, in ``[0, 2^32)``; ``salt`` gives an independent stream."""
    x = F.pmod(F.pmod(key.cast("bigint"), F.lit(TWO32)) + F.lit((salt * GOLDEN) % TWO32), F.lit(TWO32))
    h = _mul_mod32(x, MULTIPLIERS[0])
    h = h.bitwiseXOR(F.shiftright(h, 16))
    h = _mul_mod32(h, MULTIPLIERS[1 + salt % (len(MULTIPLIERS) - 1)])
    return h.bitwiseXOR(F.shiftright(h, 15))


def integer_weights(items: list[tuple[str, float]]) -> list[tuple[str, int]]:
    """Scale decimal weights by the smallest power of ten that makes them whole.

    Comparisons then stay in exact integer arithmetic in every engine.
    """
    scale = 1
    while any(abs(w * scale - round(w * scale)) > 1e-9 for _, w in items):
        scale *= 10
    return [(v, int(round(w * scale))) for v, w in items]


def weighted_choice(h: Column, items: list[tuple[str, float]]) -> Column:
    """Pick ``items[k][0]`` with probability ``w_k / sum(w)`` from a 32-bit hash."""
    items = integer_weights(items)
    total = sum(w for _, w in items)
    expr = None
    cum = 0
    for value, w in items[:-1]:
        cum += w
        cond = h * F.lit(total) < F.lit(cum * TWO32)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    last = F.lit(items[-1][0])
    return last if expr is None else expr.otherwise(last)


def bounded_uniform(h: Column, n: int) -> Column:
    """Integer in ``[0, n)`` from a 32-bit hash."""
    return F.pmod(h, F.lit(n))


MAX_VALUES = 1_000_000  # of a weight list from a table: its arrays go to every task


def alias_table(weights: list[int]) -> tuple[list[int], list[int]]:
    """Walker's table: per slot the bound of a 32-bit coin below which the slot's own value is
    taken, and the slot whose value is taken otherwise.

    All slots are worth the same, the sum of weights ``W`` when a weight counts ``n``-fold. Slots
    below that lay their deficits end to end on a line, slots above it their
    surpluses. A deficit is filled by the surplus at its start; the surplus
    slot that is overdrawn there is itself filled by the next one. Exact in
    integers, and the same in any engine that has running sums.
    """
    n, total = len(weights), sum(weights)
    keep, alias = [total] * n, list(range(n))
    low = [i for i in range(n) if weights[i] * n < total]
    high = [i for i in range(n) if weights[i] * n > total]
    at, end, k = 0, 0, 0  # the deficits laid so far, the end of the surplus of high[k]
    if high:
        end = weights[high[0]] * n - total
    for i in low:
        keep[i], alias[i] = weights[i] * n, high[k]
        at += total - weights[i] * n
        while at >= end and k + 1 < len(high):
            if at > end:
                keep[high[k]], alias[high[k]] = total - (at - end), high[k + 1]
            k += 1
            end += weights[high[k]] * n - total
    return [-(-t * TWO32 // total) for t in keep], alias


def weighted_choice_from(key: Column, weights: DataFrame, salt: int) -> Column:
    """A value of the table ``(value, weight)`` for each key, with probability ``weight / sum``.

    Weights are whole numbers of at least 0; rows without one count as 0. Values are taken in ascending
    order, so the choice doesn't depend on the table's layout. Two hash streams
    (``salt`` and the next) pick a slot and toss its coin: constant time a row, whatever the number of
    values. The list is read by the driver, at most :data:`MAX_VALUES` rows. NULL where no weight is above 0.
    """
    rows = (weights.where(F.col("weight") > 0).groupBy("value").agg(F.sum(F.col("weight").cast("bigint")).alias("weight"))
            .orderBy("value").limit(MAX_VALUES + 1).collect())
    if len(rows) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} values with a weight: join a table of ranges instead")
    kind = weights.schema["value"].dataType
    if not rows:
        return F.lit(None).cast(kind)
    bounds, alias = alias_table([r["weight"] for r in rows])

    def constant(values: list, spark_type: str) -> Column:  # one literal in the plan, not one per value
        return F.from_json(F.lit(json.dumps(values)), f"array<{spark_type}>")

    n = len(rows)
    slot = F.floor(hash32(key, salt) * F.lit(n) / F.lit(TWO32)).cast("int")
    own = hash32(key, salt + 1) < F.get(constant(bounds, "bigint"), slot)
    names = constant([str(r["value"]) for r in rows], "string")
    return F.get(names, F.when(own, slot).otherwise(F.get(constant(alias, "int"), slot))).cast(kind)
