"""String helpers (C1-C8, B1-B6), all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a DEA registration number is two letters and seven digits.
DEA_PATTERN = r"^[A-Za-z]{2}[0-9]{7}\z"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the white space (Unicode) stripped from identifiers.
WHITESPACE = (" \t\n\r\f\u000b\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing white space, Unicode spaces included.

    Spark's one-argument ``trim`` removes only spaces; ``btrim`` with an
    explicit set stays a codegen'd string kernel (no regex).
    """
    return F.btrim(col_(c), F.lit(WHITESPACE))


def normalize_dea(c: str | Column) -> Column:
    """Upper-case and strip a registration number."""
    return strip_ws(F.upper(col_(c)))


def valid_dea(c: str | Column) -> Column:
    """two letters then seven digits, nothing else."""
    return col_(c).rlike(DEA_PATTERN)


def full_name(first: str | Column, last: str | Column) -> Column:
    """C5 + C1: ``upper(first || ' ' || last)``; null if either part is null."""
    return F.upper(F.concat(col_(first), F.lit(" "), col_(last)))


def dea_or_null(c: str | Column) -> Column:
    """The value itself when it is a complete DEA number, else null."""
    return F.when(valid_dea(c), col_(c))


def is_human(animal: str | Column) -> Column:
    """the animal-name column marks a human patient."""
    return col_(animal).isin("Unspecified", "~")
