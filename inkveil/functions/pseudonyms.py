"""Name keys and pseudonyms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkveil.functions import spans
from inkveil.functions.grammar import LETTERS

# --- fixed values -----------------------------------------------------------------
ID_PREFIX = "ID"
HASH_LENGTH = 12
# Letters of dictionary IDs; nominatives beyond the last one share it.
ID_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# ----------------------------------------------------------------------------------

_BASE = 36
_DIGITS_PER_STEP = 5
_STEP = _BASE**_DIGITS_PER_STEP
_STEPS = 5  # 25 base-36 digits hold 128 bits
# digits of the longest numbers behind the first HASH_LENGTH, and two bits for each of them
_BEHIND = _STEPS * _DIGITS_PER_STEP - HASH_LENGTH
_SHIFT = 2 * _BEHIND


def name_key(matched: Column) -> Column:
    """One key for all orders of the terms of a nominative."""
    joined = F.array_join(F.sort_array(F.split(matched, "\\s+", -1)), " ")

    def letters(some: Column) -> Column:
        # most names need not be held against the long class of letters
        return F.when(some.rlike("^[A-Za-z ]*$"), some).otherwise(
            F.regexp_replace(some, f"[^{LETTERS} ]", "")
        )

    return F.upper(spans.bind(joined, letters))


def listed_id(number: Column) -> Column:
    """O45."""
    return F.concat(F.lit(ID_PREFIX), number.cast("string"))


def lettered_id(rank: Column, dict_id: Column) -> Column:
    """Rank 1 is A; ranks past the alphabet share its last letter."""
    letter = F.substring(F.lit(ID_LETTERS), F.least(rank, F.lit(len(ID_LETTERS))), 1)
    return F.concat(F.lit(ID_PREFIX), letter, dict_id.cast("string"))


def base36_md5(text: Column) -> Column:
    """The MD5 digest as a base-36 number, by long division of four 32-bit limbs."""
    digest = F.md5(text.cast("binary"))
    names = ("a", "b", "c", "d")
    limbs = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]

    def emit(state: Column, _: Column) -> Column:
        rest = None
        quotients = []
        for name in names:
            value = state[name] if rest is None else rest * F.lit(1 << 32) + state[name]
            quotients.append(F.call_function("div", value, F.lit(_STEP)).alias(name))
            rest = value % _STEP
        digits = F.lpad(F.conv(rest.cast("string"), 10, _BASE), _DIGITS_PER_STEP, "0")
        return F.struct(*quotients, F.concat(digits, state["digits"]).alias("digits"))

    start = F.struct(*[x.alias(n) for x, n in zip(limbs, names, strict=True)], F.lit("").alias("digits"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_STEPS)),
        start,
        emit,
        lambda state: F.lower(F.regexp_replace(state["digits"], "^0+(?=.)", "")),
    )


def hash_id(key: Column, salt: str | int) -> Column:
    """The first characters of the base-36 MD5 of salt and key."""
    return first_digits(F.concat(F.lit(str(salt)), key))


def first_digits(text: Column) -> Column:
    """The first HASH_LENGTH digits of `base36_md5`.

    Of a number with all its digits they are one quotient, by 36 ** _BEHIND: a shift by two bits a
    digit and a division by the power of 9 left. Other numbers, one in fifteen, are written out.
    """

    def quotient(digest: Column) -> Column:
        high, low = (
            F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)
        )
        # the lower half shifted, as its upper digits
        low = F.call_function("div", low, F.lit(1 << _SHIFT).cast("decimal(20,0)")).cast("decimal(20,0)")
        shifted = high * F.lit(1 << (64 - _SHIFT)).cast("decimal(13,0)") + low
        return F.call_function("div", shifted, F.lit(9**_BEHIND).cast("decimal(20,0)"))

    digits = F.lower(F.conv(quotient(F.md5(text.cast("binary"))).cast("string"), 10, _BASE))
    return spans.bind(
        digits,
        lambda some: F.when(F.length(some) == HASH_LENGTH, some).otherwise(
            F.substring(base36_md5(text), 1, HASH_LENGTH)
        ),
    )
