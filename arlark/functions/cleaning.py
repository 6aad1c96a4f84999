"""Text cleaning and lenient type coercion.

All coercions use ``try_*`` forms: Spark 4 runs with ANSI mode on, where a
plain ``cast`` of a bad value fails the whole job.  A value that does not
parse becomes NULL and the validation step turns that into a quarantine
reason instead of an exception.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from arlark.schemas import MONEY, PAYMENT_METHOD_MAP, STATUS_MAP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


# characters stripped from both ends of text fields: space, tab, LF, CR, FF, VT
WHITESPACE = " \t\n\r\f\u000b"


def clean_text(c) -> Column:
    """Strip surrounding whitespace (tabs and newlines too); empty becomes NULL."""
    return F.nullif(F.trim(_col(c).cast("string"), F.lit(WHITESPACE)), F.lit(""))


def blank_to_null(c) -> Column:
    """``nullif(c, '')`` without trimming."""
    c = _col(c)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def first_present(*cols) -> Column:
    """First argument that is neither NULL nor the empty string."""
    return F.coalesce(*[blank_to_null(_col(c)) for c in cols])


def upper_or_default(text, default: str) -> Column:
    return F.upper(F.coalesce(_col(text), F.lit(default)))


def normalize_status(text) -> Column:
    """Map status synonyms (cleaned text) to the canonical set; unknown text is upper-cased."""
    t = _col(text)
    return F.coalesce(_literal_map(STATUS_MAP)[F.lower(t)], F.upper(t))


def normalize_payment_method(c) -> Column:
    """Map processor method names; anything unrecognised becomes ``unknown``."""
    return F.coalesce(_literal_map(PAYMENT_METHOD_MAP)[F.lower(_col(c))], F.lit("unknown"))


# The parse_* helpers take text that is already cleaned (see ``clean_text``):
# cleaning once and parsing the cleaned column keeps expression trees small
# when Catalyst inlines projections into pushed-down filters.

def parse_decimal(text, dtype=MONEY) -> Column:
    return _col(text).try_cast(dtype.simpleString())


def parse_int(text) -> Column:
    return _col(text).try_cast("int")


def parse_date(text) -> Column:
    """Strict ISO date: ``YYYY-MM-DD`` or the basic form ``YYYYMMDD``."""
    text = _col(text)
    # the forms are checked, so a cast parses them as a formatter would, without one exception for each impossible date
    basic = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text).when(text.rlike(r"^\d{8}\z"), basic)
    return iso.try_cast("date")


def parse_timestamp(text) -> Column:
    """ISO date-time (``T`` or space separated) as a zone-less timestamp."""
    return _col(text).try_cast("timestamp_ntz")


def parse_bool(text) -> Column:
    """Real boolean parse of text: true/false/1/0/yes/no, else NULL."""
    text = F.lower(_col(text))
    return (
        F.when(text.isin("true", "t", "1", "yes", "y"), F.lit(True))
        .when(text.isin("false", "f", "0", "no", "n"), F.lit(False))
    )
