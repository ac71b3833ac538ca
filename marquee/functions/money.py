"""Money and OCR-number repair: ticket prices, integer fields, revenue check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Separators between several prices in one cell, tried in this order.
PRICE_SEPARATORS = ["/", "-", "&"]
# Characters that mark a cell as bracket noise rather than a price.
PRICE_NOISE = "(){}[]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_ticket_price(col) -> Column:
    """``$`` and ``_`` removed, ``S14`` -> ``14``, trailing ``.``/``,`` dropped,
    decimal comma ``17,50`` -> ``17.50``."""
    c = F.trim(_c(col))
    c = F.translate(c, "$_", "")
    c = F.regexp_replace(c, "[Ss]([0-9])", "$1")
    c = F.regexp_replace(c, r"\.$", "")
    c = F.regexp_replace(c, ",$", "")
    return F.regexp_replace(c, "([0-9]{1,2}),([0-9]{2})", "$1.$2")


def valid_ticket_price(col) -> Column:
    """No bracket noise and no thousands-style group (``12,000``)."""
    c = _c(col)
    return ~c.rlike(r"[(){}\[\]]") & ~c.rlike("[0-9]{2,},[0-9]{3,}")


def split_price_cell(col) -> Column:
    """Split a cell on the first separator present (``/`` before ``-`` before ``&``)."""
    c = _c(col)
    out = F.array(c)
    for sep in reversed(PRICE_SEPARATORS):
        out = F.when(c.contains(sep), F.split(c, "\\" + sep if sep != "&" else sep)).otherwise(out)
    return out


def curate_price(col) -> Column:
    """One price string -> double, or null when noisy / not a number."""
    cleaned = clean_ticket_price(col)
    return F.when(valid_ticket_price(cleaned), F.trim(cleaned).try_cast("double"))


_CELL_SEP = "\u0002"


def curate_prices(arr) -> Column:
    """list<string> of raw price cells -> list<double> of prices (null and 0 dropped).

    The cleaning steps that do not depend on where a part ends (``$``, ``_``,
    ``S14``, decimal comma) run once over all cells joined into one string,
    as compiled expressions; only the split on the cell's separator and the
    trailing ``.``/``,`` removal run per part inside the lambdas.
    """
    joined = F.translate(F.array_join(_c(arr), _CELL_SEP), "$_", "")
    joined = F.regexp_replace(joined, "[Ss]([0-9])", "$1")
    joined = F.regexp_replace(joined, "([0-9]{1,2}),([0-9]{2})", "$1.$2")
    cells = F.split(joined, _CELL_SEP)
    parts = F.flatten(F.transform(cells, split_price_cell))

    def part_value(p):
        c = F.regexp_replace(F.regexp_replace(F.trim(p), r"\.$", ""), ",$", "")
        c = F.regexp_replace(c, "([0-9]{1,2}),([0-9]{2})", "$1.$2")
        return F.when(valid_ticket_price(c), F.trim(c).try_cast("double"))

    return F.when(F.size(_c(arr)) > 0, F.filter(F.transform(parts, part_value),
                                                lambda p: p.isNotNull() & (p != 0))).otherwise(
        F.array().cast("array<double>"))


def prices_to_decimal(arr, round_whole: bool = False) -> Column:
    """Warehouse price type DECIMAL(8,2); ``round_whole`` rounds to whole units
    first (what an integer cast before the decimal column does)."""
    if round_whole:
        return F.transform(_c(arr), lambda p: F.round(p.cast("decimal(10,2)")).cast("decimal(8,2)"))
    return F.transform(_c(arr), lambda p: p.cast("decimal(8,2)"))


def parse_ocr_int(col, as_type: str = "bigint") -> Column:
    """OCR number text -> integer: a trailing ``.0`` goes, then every non-digit;
    empty -> null.  Read the column as *string* so ``8.470`` keeps its zero."""
    c = F.regexp_replace(F.trim(_c(col).cast("string")), r"\.0$", "")
    c = F.regexp_replace(c, "[^0-9]", "")
    return F.nullif(c, F.lit("")).try_cast(as_type)


def revenue_mismatch(sold, price_1, price_2, gross) -> Column:
    """True when |gross - avg_price * sold| > 20% of gross (avg of the two
    prices when the second exists)."""
    p2 = _c(price_2)
    avg = F.when(p2.isNotNull(), (_c(price_1) + p2) / 2).otherwise(_c(price_1))
    return F.abs(_c(gross) - avg * _c(sold)) > 0.2 * _c(gross)


def capacity_checked(capacity, attendance) -> Column:
    """Capacity below attendance is an OCR error -> null."""
    return F.when(_c(capacity) < _c(attendance), F.lit(None)).otherwise(_c(capacity))
