"""Numeric, unit and money expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotwise.functions import fixed
from plotwise.functions.text import contains_any, lookup, strip

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def rounded(c: Column, digits: int) -> Column:
    """To so many decimals; what lies exactly between two goes to the even one."""
    return F.rint(c * float(10 ** digits)) / float(10 ** digits)


def to_number(c: Column) -> Column:
    """Double, or NULL for anything that is not a plain number.

    The pattern guard matters: a bare cast would read ``5d`` as 5.0. The cast
    itself ignores the white space the pattern lets through.
    """
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def number_text(v: Column) -> Column:
    """Plain decimal text of a double (never scientific notation for whole numbers)."""
    whole = (v == F.floor(v)) & (F.abs(v) < 1e15)
    return F.when(whole, F.concat(v.cast("bigint").cast("string"), F.lit(".0"))).otherwise(v.cast("string"))


def parse_price(raw: Column, source: Column, unit: Column, plain: Column | None = None) -> Column:
    """Price text in THB.

    Millions and hundred-thousands words win over the plain reading; plain
    amounts of the USD feed are converted unless flagged as THB already.
    ``plain`` may hand in ``to_number(raw)`` where that is a column already:
    a text that is a number all through holds no word, so it is tried first.
    """
    in_usd = F.coalesce((source == fixed.USD_SOURCE) & (unit != fixed.SPLIT_UNIT_THB),
                        source == fixed.USD_SOURCE, F.lit(False))
    rate = F.when(in_usd, F.lit(fixed.USD_RATE)).otherwise(F.lit(1.0))
    if plain is None:
        plain = to_number(raw)
    digits = F.translate(strip(raw), fixed.THAI_DIGITS, "0123456789")

    def amount_before(word: str) -> Column:
        return F.regexp_extract(digits, rf"(?U)([\d,.]+)\s*{word}", 1)

    def written(word: str) -> Column:
        return raw.contains(word) & (amount_before(word) != "")

    def worded(word: str, factor: float) -> Column:
        return to_number(F.replace(amount_before(word), F.lit(","), F.lit(""))) * F.lit(factor)

    bare = digits
    for junk in (",", fixed.BAHT_WORD, " "):
        bare = F.replace(bare, F.lit(junk), F.lit(""))
    amount = to_number(bare)
    return (F.when(plain > 0, plain * rate)
            .when(plain.isNotNull(), F.lit(None).cast("double"))
            .when(written(fixed.MILLION_WORD), worded(fixed.MILLION_WORD, fixed.MILLION))
            .when(written(fixed.LAKH_WORD), worded(fixed.LAKH_WORD, fixed.LAKH))
            .when(amount > 0, amount * rate))


def cap_price(price: Column, cap: float = fixed.PRICE_CAP) -> Column:
    return F.when(price <= cap, price)


def to_sqm(area: Column, unit: Column, rai: Column, ngan: Column, wah: Column) -> Column:
    """Area in square metres from the raw area or from rai / ngan / wah parts."""
    split = unit.isin(fixed.SPLIT_UNIT, fixed.SPLIT_UNIT_THB)
    complete = rai.isNotNull() & ngan.isNotNull() & wah.isNotNull()
    parts = (F.least(rai, F.lit(fixed.RAI_CAP)) * fixed.SQM_PER_RAI
             + F.least(ngan, F.lit(fixed.NGAN_CAP)) * fixed.SQM_PER_NGAN
             + wah * fixed.SQM_PER_WAH)
    return (F.when(split & complete & (parts > 0), parts)
            .when(~(area > 0) | area.isNull(), F.lit(None).cast("double"))
            .when(unit == fixed.WAH_UNIT, area * fixed.SQM_PER_WAH)
            .otherwise(area))


def cap_area(area: Column, cap: float = fixed.AREA_CAP) -> Column:
    return F.when(area <= cap, area)


def price_per_area(price: Column, area: Column) -> Column:
    return F.when(area > 0, price / area)


def bedroom_number(raw: Column) -> Column:
    return F.coalesce(lookup(raw, fixed.BEDROOM_CODES), to_number(raw))


def default_bedrooms(bedrooms: Column, property_type: Column) -> Column:
    """Fill unknown bedrooms by the first type whose token occurs."""
    low = F.lower(property_type)
    rules = [F.when(contains_any(low, words), F.lit(n)) for words, n in fixed.TYPE_TOKENS]
    return F.coalesce(bedrooms, *rules)


def swapped(price: Column, area: Column) -> Column:
    """Whether price and area look exchanged, signs aside; never NULL."""
    return F.coalesce((F.abs(price) < fixed.SWAP_PRICE_BELOW) & (F.abs(area) > fixed.SWAP_AREA_ABOVE), F.lit(False))


def repaired(price: Column, area: Column) -> tuple[Column, Column]:
    """Price and area without signs, exchanged back; both from the same input row."""
    swap = swapped(price, area)
    return (F.when(swap, F.abs(area)).otherwise(F.abs(price)),
            F.when(swap, F.abs(price)).otherwise(F.abs(area)))


def looks_thb(source: Column, price: Column) -> Column:
    """Amount of the USD feed too high to be in USD; never NULL."""
    return F.coalesce((source == fixed.USD_SOURCE) & (price > fixed.USD_LOOKS_THB), F.lit(False))


def is_test_price(raw: Column, amount: Column, is_text: Column) -> Column:
    """0 / 1 placeholders; a text price only counts when it is all digits."""
    counted = ~is_text | strip(raw).rlike("^[0-9]+$")
    return F.coalesce(amount.isin(fixed.TEST_PRICES) & counted, F.lit(False))


def rule_estimate(area: Column, property_type: Column, zone: Column, has_bts: Column) -> Column:
    """Price from area, type base price, zone factor and transit premium."""
    d = fixed.ESTIMATE_DEFAULTS
    base = F.coalesce(lookup(F.coalesce(property_type, F.lit(d["property_type"])), fixed.TYPE_BASE_PRICE),
                      F.lit(fixed.DEFAULT_BASE_PRICE))
    factor = F.coalesce(lookup(F.coalesce(zone, F.lit(d["zone"])), fixed.ZONE_FACTOR),
                        F.lit(fixed.DEFAULT_ZONE_FACTOR))
    price = F.coalesce(area, F.lit(d["area_sqm"])) * base * factor
    transit = F.coalesce(has_bts, F.lit(d["has_bts"])) != 0
    return F.when(transit, price * fixed.TRANSIT_FACTOR).otherwise(price)
