"""Text cleaning: C1 normalised text, C2/C3 zero-padded ids, C7 upper codes."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from strata.functions.util import as_col


def normalized_text(col) -> Column:
    """Cast to string, trim spaces, and turn ``''`` into NULL.

    ``trim`` removes spaces only; tabs and other whitespace are kept.
    """
    return F.nullif(F.trim(as_col(col).cast("string")), F.lit(""))


def trimmed_text(col) -> Column:
    """Plain trim of the string form; ``''`` stays ``''``."""
    return F.trim(as_col(col).cast("string"))


def pad_id_guarded(col, width: int = 7) -> Column:
    """Left-pad with zeros only when the text is 1..width digits.

    Anything else (longer, alphabetic, empty) is returned unchanged.  The
    input is taken as already cleaned (see ``normalized_text``/``trimmed_text``).
    """
    text = as_col(col).cast("string")
    return F.when(text.rlike(f"^[0-9]{{1,{width}}}$"), F.lpad(text, width, "0")).otherwise(text)


def pad_id_unguarded(col, width: int = 7, trim: bool = True) -> Column:
    """``lpad(x, width, '0')`` on every value.

    Longer values are truncated to ``width`` characters, ``'AB'`` becomes
    ``'00000AB'`` and ``''`` becomes all zeros — the behaviour of the original
    batch recipe (``trim=True``) and of the stream view (``trim=False``).
    """
    text = as_col(col).cast("string")
    if trim:
        text = F.trim(text)
    return F.lpad(text, width, "0")


def upper_code(col, empty_as_null: bool = True) -> Column:
    """Upper-cased code, from normalised (default) or trimmed text."""
    return F.upper(normalized_text(col) if empty_as_null else trimmed_text(col))
