"""String keys, linear hash functions and bit tricks, all as built-in expressions."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_HEX_DIGITS = 10  # 40 bits: a word times a multiplier below 2**20 stays inside a BIGINT
WORDS_PER_KEY = 3  # an md5 holds three such words
PRIME = 2**39 - 7


def string_key(col: Column | str, word: int = 0) -> Column:
    """A 40-bit integer from the md5 of a value's text; words 0, 1 and 2 are independent."""
    start = 1 + WORD_HEX_DIGITS * (word % WORDS_PER_KEY)
    col = F.col(col) if isinstance(col, str) else col
    digits = F.substring(F.md5(col.cast("string")), start, WORD_HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def hash_parameters(k: int, seed: int = 28) -> list[tuple[int, int]]:
    """k pairs (a, b) with 1 <= a, b < 2**20 and a odd, the same for the same seed."""
    rng = random.Random(seed)
    return [(rng.randrange(1, 2**20, 2), rng.randrange(1, 2**20)) for _ in range(k)]


def linear_hash(word: Column, a: int, b: int, modulus: int, prime: int | None = None) -> Column:
    """(a * word + b) mod modulus; never negative for words made by string_key.

    With ``prime`` the sum is first taken modulo that prime, which keeps hashes of one word apart for
    any modulus below it.
    """
    value = word * F.lit(a).cast("bigint") + F.lit(b).cast("bigint")
    if prime is not None:
        value = F.pmod(value, F.lit(prime).cast("bigint"))
    if modulus & (modulus - 1) == 0:
        return value.bitwiseAND(F.lit(modulus - 1).cast("bigint"))
    return F.pmod(value, F.lit(modulus).cast("bigint"))


def lowest_bit(x: Column) -> Column:
    """2 to the number of trailing zeros; 0 for 0."""
    return x.bitwiseAND(-x)


def trailing_zeros(x: Column) -> Column:
    """Number of trailing zero bits, with 0 for the value 0."""
    return F.when(x == 0, F.lit(0)).otherwise(F.bit_count(lowest_bit(x) - 1)).cast("int")


def power_of_two(r: Column) -> Column:
    """2 ** r as a BIGINT, for r up to 62."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), r.cast("int"))
