"""Expressions over dump file names: ingest date, dataset key and suffix matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = r"\d{4}-\d{2}-\d{2}"
# Places where a dataset name may start, as an empty match; the mark cannot occur in a file name.
BOUNDARY = rf"(?<=[^\p{{L}}\p{{Nd}}-])|(?<={DATE}-)"
MARK = "/"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def decoded(path: Column | str) -> Column:
    """File metadata gives paths URL-encoded; this is the plain path. A plus sign stands for itself."""
    return F.url_decode(F.regexp_replace(_col(path), r"\+", "%2B"))


def stem(name: Column | str) -> Column:
    """Lower-cased name without its extension; a leading dot does not start an extension."""
    return F.regexp_replace(F.lower(_col(name)), r"(?s)(?<=.)\.[^.]*$", "")


def ingest_date(name: Column | str) -> Column:
    """First date-shaped text of the name; today when absent or not a calendar day."""
    found = F.nullif(F.regexp_extract(_col(name), f"({DATE})", 1), F.lit(""))
    return F.coalesce(F.try_to_date(found, "yyyy-MM-dd"), F.current_date())


def prefix_date(name: Column | str) -> Column:
    """Day of a ``YYYY-MM-DD-`` prefix; NULL when absent or not a calendar day."""
    found = F.nullif(F.regexp_extract(_col(name), f"^({DATE})-", 1), F.lit(""))
    return F.try_to_date(found, "yyyy-MM-dd")


def dataset_key(name: Column | str) -> Column:
    """File name without its date prefix and full-dump marker."""
    return F.regexp_replace(_col(name), rf"^{DATE}-(?:Full Dump\s+)?", "")


def stem_pieces(stem_text: Column | str) -> Column:
    """The stem cut at every place where a dataset name may start.

    Such a place is the start of the name, follows a separator other than ``-``, or follows a
    ``YYYY-MM-DD-`` group. One regex pass finds them all.
    """
    return F.split(F.regexp_replace(_col(stem_text), BOUNDARY, MARK), MARK)


def suffixes(pieces: Column | str) -> Column:
    """Every dataset name the stem may end with, from its pieces.

    Names are short, so the array is small; exploding it turns "which dataset does this file belong to"
    into an equi join. Compute the pieces in a projection of their own, or each suffix cuts the stem again.
    """
    p = _col(pieces)
    return F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.slice(p, i, F.size(p)), ""))


def serial_to_timestamp(c: Column | str) -> Column:
    """Spreadsheet day number (1900 system) to timestamp, rounded to the millisecond.

    Day numbers below 61 are shifted by one: the 1900 system counts a 29 February 1900.
    Negative numbers are not dates.
    """
    n = _col(c).cast("double")
    days = F.floor(n)
    millis = F.floor((n - days) * 86_400_000 + 0.5)
    epoch_day = days - F.when(n < 61, F.lit(25568)).otherwise(F.lit(25569))
    return F.when(n >= 0, F.timestamp_millis(epoch_day * 86_400_000 + millis))
