"""Text and dictionary expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotwise.functions import fixed


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind, not only blanks."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def _literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"{value!r}D"


def null_tokens(column: str) -> Column:
    """The named column with NULL for the texts a CSV reader treats as missing."""
    tokens = ", ".join(_literal(t) for t in fixed.NULL_TOKENS)
    return F.expr(f"CASE WHEN `{column}` NOT IN ({tokens}) THEN `{column}` END")


def lookup(key: Column, mapping: Mapping[str, str | float]) -> Column:
    """Value of a small dictionary, NULL when the key is absent."""
    pairs = ", ".join(_literal(x) for kv in mapping.items() for x in kv)
    return F.expr(f"map({pairs})")[key]


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True if any word occurs in the text; never NULL."""
    return F.coalesce(reduce(lambda a, b: a | b, [c.contains(w) for w in words]), F.lit(False))


def first_keyword(c: Column, keywords: Sequence[str]) -> Column:
    """First keyword, in list order, that occurs in the text regardless of case."""
    low = F.lower(c)
    return F.coalesce(*[F.when(low.contains(k.lower()), F.lit(k)) for k in keywords])


def clean_title(c: Column) -> Column:
    """Drop markup leftovers and the emoji used as eye-catchers."""
    # Plain substring tests decide whether the expressions have to run at all.
    marked = contains_any(c, ["&amp;", "<br>", "\\n\\t", *fixed.EMOJI])
    cleaned = F.regexp_replace(F.regexp_replace(c, fixed.MARKUP_PATTERN, ""), f"[{fixed.EMOJI}]", "")
    return F.when(marked, cleaned).otherwise(c)


def has_phone(c: Column) -> Column:
    return F.coalesce(c.contains("0") & c.rlike(fixed.PHONE_PATTERN), F.lit(False))


def normalise_location(c: Column, aliases: Mapping[str, str] = fixed.LOCATION_ALIASES) -> Column:
    bare = strip(c)
    return F.coalesce(lookup(F.lower(bare), aliases), bare)


def zone_of(location: Column, zones: Mapping[str, Sequence[str]] = fixed.ZONES,
            default: str = fixed.UNKNOWN_ZONE) -> Column:
    by_place = {place: zone for zone, places in zones.items() for place in places}
    return F.coalesce(lookup(location, by_place), F.lit(default))


def normalise_type(c: Column, aliases: Mapping[str, str] = fixed.TYPE_ALIASES) -> Column:
    """Canonical type; unknown spellings stay as they are, unstripped."""
    return F.coalesce(lookup(F.lower(strip(c)), aliases), c)


def is_sentinel(price: Column) -> Column:
    """Price texts that stand for no price; never NULL."""
    return contains_any(price, fixed.SENTINEL_PRICES) & F.coalesce(
        strip(price).isin(fixed.SENTINEL_PRICES), F.lit(False))


def supported_type(c: Column) -> Column:
    tokens = [t for words, _ in fixed.TYPE_TOKENS for t in words]
    return contains_any(F.lower(c), tokens)


def has_text(c: Column) -> Column:
    """1 when the text holds something besides white space, else 0."""
    return F.when(c.rlike(f"[^{fixed.WHITESPACE}]"), F.lit(1)).otherwise(F.lit(0))


def matches(c: Column, search: str, literal: bool = False) -> Column:
    """Case-insensitive search, a regular expression unless ``literal``."""
    hit = F.lower(c).contains(search.lower()) if literal else c.rlike("(?iu)" + search)
    return F.coalesce(hit, F.lit(False))
