"""Checks that a written explanation only states numbers its prompt contains."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Number pattern, tolerances, word span and status texts.
NUMBER_PATTERN = r"-?\d+\.?\d*"
ABSOLUTE_TOLERANCE = 0.1
RELATIVE_TOLERANCE = 0.015
WORD_SPAN = 5
STATUS_UNVERIFIED = "FLAGGED - contains unverified number"
STATUS_MISLABELLED = "FLAGGED - ROAS mislabeled as dollar amount"
STATUS_PASSED = "PASSED"

# Characters that separate words besides the six a plain \s matches: the ASCII
# separators 1C to 1F and all other Unicode spaces.
OTHER_SPACES = "".join(map(chr, (
    0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000)))


# Decimal digits of all other scripts, by rule, and the ASCII digits they stand for.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
OTHER_DIGITS = "".join(_DIGITS)
OTHER_DIGIT_VALUES = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def extract_numbers(text: Column) -> Column:
    """All numbers of a text as absolute doubles, thousands commas removed.

    Digits of any script count; texts that hold such digits are rewritten first."""
    beyond_ascii = F.octet_length(text) != F.length(text)
    ascii_digits = F.when(beyond_ascii & text.rlike(r"[\p{Nd}&&[^0-9]]"),
                          F.translate(text, OTHER_DIGITS, OTHER_DIGIT_VALUES)).otherwise(text)
    found = F.regexp_extract_all(F.replace(ascii_digits, F.lit(","), F.lit("")),
                                 F.lit(NUMBER_PATTERN), F.lit(0))
    return F.transform(found, lambda n: F.abs(n.cast("double")))


def first_unverified(response: Column, prompt: Column,
                     abs_tol: float = ABSOLUTE_TOLERANCE,
                     rel_tol: float = RELATIVE_TOLERANCE) -> Column:
    """First number of ``response`` no number of ``prompt`` comes close to."""
    def close(n: Column, p: Column) -> Column:
        gap = F.abs(n - p)
        return (gap <= abs_tol) | F.when(p != 0, gap / p <= rel_tol).otherwise(False)

    # Both number lists are bound as one struct, so each text is scanned once and not
    # again for every number it is compared with. Numbers the prompt holds exactly are
    # set aside first; what is left keeps its order.
    both = F.array(F.struct(extract_numbers(response).alias("r"),
                            F.array_distinct(extract_numbers(prompt)).alias("p")))
    first_bad = F.transform(both, lambda b: F.get(
        F.filter(F.array_except(b["r"], b["p"]),
                 lambda n: ~F.exists(b["p"], lambda p: close(n, p))), F.lit(0)))
    return F.get(first_bad, F.lit(0))


def mislabelled(text: Column, term: str = "ROAS", mark: str = "$",
                span: int = WORD_SPAN) -> Column:
    """Does a word holding ``mark`` stand within ``span`` words of one holding ``term``?"""
    t, m = term.upper(), mark.upper()
    plain = F.translate(F.upper(text), OTHER_SPACES, " " * len(OTHER_SPACES))
    between = rf"\S*(?:(?:\s+\S+){{0,{span - 1}}}\s+\S*)?"
    near = f"{re.escape(t)}{between}{re.escape(m)}|{re.escape(m)}{between}{re.escape(t)}"
    both = F.contains(F.upper(text), F.lit(t)) & F.contains(F.upper(text), F.lit(m))
    return both & plain.rlike(near)


def validation_status(unverified: Column, mislabel: Column) -> Column:
    return (F.when(unverified.isNotNull(), STATUS_UNVERIFIED)
            .when(mislabel, STATUS_MISLABELLED)
            .otherwise(STATUS_PASSED))
