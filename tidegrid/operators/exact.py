"""Sums of doubles that do not depend on the order or the grouping of their terms.

A double is a whole number of halves of halves: its 53 bits lie somewhere on
one fixed ruler of powers of two. Cut into pieces at fixed places of that ruler,
each piece is a small whole number, and sums of whole numbers are exact in any
order. The pieces of a sum are brought into their one standard form, without
carries left over, before they become a double again, so that equal sums have
equal bits. A piece has so many bits that a long holds the sum of 2^37 of them.
"""

import math

from pyspark.sql import functions as F

BITS = 26
# The exponent of the smallest double.
LEAST = -1074
WRITTEN_OUT = 6


def _power(exponent):
    return math.ldexp(1.0, exponent) if exponent < 1024 else math.inf


def _finite(value):
    return ~F.isnan(value) & (F.abs(value) < F.lit(math.inf))


def bounds(value):
    """The least and the largest size of the finite numbers other than zero, as two aggregates."""
    size = F.when(_finite(value) & (value != 0), F.abs(value))
    return F.min(size), F.max(size)


def places(least, largest):
    """The places of the ruler at which numbers of these sizes are cut, lowest first; the same places whatever the sizes."""
    if least is None:
        return [0]
    low, high = max(math.frexp(least)[1] - 53, LEAST), math.frexp(largest)[1]
    return list(range(BITS * (low // BITS), high, BITS))


def pieces(value, cuts):
    """The whole number between each two places, with the sign of the value; nulls stay nulls, and what is not finite has zeros."""
    finite = F.when(_finite(value), value.cast("double")).otherwise(F.when(value.isNotNull(), 0.0))
    out = []
    for place in cuts:
        if place < LEAST:
            # The lowest piece may begin below the smallest double: its bits are all above.
            inside = (finite % F.lit(_power(place + BITS))) / F.lit(_power(LEAST)) * F.lit(_power(LEAST - place))
        else:
            inside = (finite % F.lit(_power(place + BITS))) / F.lit(_power(place))
        out.append(inside.cast("long"))
    return out


def odd(value):
    """What is not finite, to be summed beside: infinities of both signs, or anything that is no number, give no number in any order."""
    return F.when(~_finite(value), value.cast("double"))


def _weigh(digit, place):
    """What a digit stands for; the lowest places begin below the smallest double."""
    if place >= LEAST:
        return digit * F.lit(_power(place))
    return digit * F.lit(_power(place - LEAST)) * F.lit(_power(LEAST))


def _carry(part, carry):
    return F.shiftright(part + carry, BITS)


def _digit(part, carry):
    return (part + carry).bitwiseAND(F.lit((1 << BITS) - 1)).cast("double")


def sign(sums):
    """1 or -1: the sign of a sum, as a long, to be a column of its own before `standard` reads it in many places."""
    last = F.lit(0).cast("long")
    if len(sums) <= WRITTEN_OUT:
        for part in sums:
            last = _carry(part, last)
    else:
        last = F.aggregate(F.array(*sums), last, lambda carry, part: _carry(part, carry))
    return F.when(last < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")


def standard(sums, sign, cuts):
    """The pieces of a sum, and its sign, as a double.

    Below zero the pieces are turned around, so that the digits of the size are
    added, not taken from each other. Few pieces are written out, many are
    folded over as an array; the steps are the same.
    """
    none = F.lit(0).cast("long")

    def above(carry):
        """What is left above the last place, which may lie beyond the largest double."""
        return F.when(carry == 0, F.lit(0.0)).otherwise(carry.cast("double") * F.lit(_power(cuts[-1] + BITS)))

    if len(cuts) <= WRITTEN_OUT:
        total, carry = F.lit(0.0), none
        for part, place in zip(sums, cuts):
            total = total + _weigh(_digit(part * sign, carry), place)
            carry = _carry(part * sign, carry)
        return (total + above(carry)) * sign.cast("double")
    held = F.array(*sums)
    low, high = F.array(*[F.lit(_power(max(p, LEAST))) for p in cuts]), F.array(*[F.lit(_power(min(p - LEAST, 0))) for p in cuts])
    parts = F.zip_with(held, F.arrays_zip(low.alias("low"), high.alias("high")), lambda part, weight: F.struct((part * sign).alias("part"), weight["low"].alias("low"), weight["high"].alias("high")))
    start = F.struct(none.alias("carry"), F.lit(0.0).alias("total"))
    folded = F.aggregate(
        parts,
        start,
        lambda acc, p: F.struct(_carry(p["part"], acc["carry"]).alias("carry"), (acc["total"] + _digit(p["part"], acc["carry"]) * p["high"] * p["low"]).alias("total")),
        lambda acc: acc["total"] + above(acc["carry"]),
    )
    # An array of nulls is no sum.
    return F.when(sums[0].isNotNull(), folded * sign.cast("double"))
