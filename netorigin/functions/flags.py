"""The 16-bit evidence word: category (bits 0-3), role (4-7), six signals (8-13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from netorigin.functions import vocab

RESERVED = 0xC000


def code_of(name: Column, codes: dict[str, int]) -> Column:
    out = F.lit(0)
    for k, v in codes.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out


def name_of(code: Column, codes: dict[str, int]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in codes.items():
        out = F.when(code == v, F.lit(k)).otherwise(out)
    return out


def encode(category: Column, role: Column, signals: dict[str, Column]) -> Column:
    word = code_of(category, vocab.CATEGORY_CODES).bitwiseOR(F.shiftleft(code_of(role, vocab.ROLE_CODES), 4))
    for name, bit in vocab.SIGNAL_BITS.items():
        if name in signals:
            word = word.bitwiseOR(F.when(signals[name], F.lit(1 << bit)).otherwise(F.lit(0)))
    return word.cast("int")


def category_code(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(15))


def role_code(flags: Column) -> Column:
    return F.shiftright(flags, 4).bitwiseAND(F.lit(15))


def category(flags: Column) -> Column:
    return name_of(category_code(flags), vocab.CATEGORY_CODES)


def role(flags: Column) -> Column:
    return name_of(role_code(flags), vocab.ROLE_CODES)


def signal(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(1 << vocab.SIGNAL_BITS[name])) != 0


def violation(flags: Column) -> Column:
    """Why the word is not a valid evidence word, or null."""
    return (
        F.when((flags < 0) | (flags > 0xFFFF), F.lit("not_u16"))
        .when(flags.bitwiseAND(F.lit(RESERVED)) != 0, F.lit("reserved_bits"))
        .when(category_code(flags) > 5, F.lit("reserved_category"))
        .when(role_code(flags) > 6, F.lit("reserved_role"))
    )


def decode(flags: Column) -> dict[str, Column]:
    """Named columns of the word, in record order."""
    cols = {"category": category(flags), "network_role": role(flags)}
    cols.update({s: signal(flags, s) for s in vocab.ASN_SIGNALS})
    return cols


def flag_names(flags: Column) -> Column:
    """Names of the signals that are on, lowest bit first, joined by `|`."""
    return F.concat_ws("|", *[F.when(signal(flags, s), F.lit(s)) for s in vocab.ASN_SIGNALS])


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)
