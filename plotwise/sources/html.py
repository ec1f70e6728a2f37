"""Listing fields out of a table of web pages."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import fixed

_ENTITY = r"^(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]\w*);"


def unescape(c: Column) -> Column:
    """Text with its named and numbered character references decoded; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])

    def decoded(part: Column, place: Column) -> Column:
        name = F.regexp_extract(part, _ENTITY, 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 9), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 9)).cast("long")
        fits = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        char = F.when(fits, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).when(~name.startswith("#"), names[name])
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        return F.when(place == 0, part).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part)))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "&", -1), decoded), "")).otherwise(c)


def _markup_gone(part: Column) -> Column:
    """Text behind the tag that a part between two ``<`` begins with; without a tag, the part was text."""
    return F.when(part.rlike("^[A-Za-z/!?]"), F.regexp_replace(part, "^[^>]*>?", "")).otherwise(F.concat(F.lit("<"), part))


def _whole_text(opened: Column, tag: str) -> Column:
    """Text of the element that ``opened`` begins with, with elements of the same tag inside it.

    The markup is split at its tags; the depth of open elements is counted from part to part, and the element ends
    where it is 0 again (or with the page).
    """
    parts = F.slice(F.split(opened, "<", -1), F.lit(2), F.greatest(F.size(F.split(opened, "<", -1)) - 1, F.lit(0)))

    def step(seen: Column, part: Column) -> Column:
        opens = part.rlike(rf"(?i)^{tag}(?=[\s/>])") & ~part.rlike("^[^>]*/>")
        depth = seen["depth"] + F.when(opens, 1).when(part.rlike(rf"(?i)^/{tag}\s*>"), -1).otherwise(0)
        ended = F.when((seen["end"] == 0) & (depth == 0), seen["at"] + 1).otherwise(seen["end"])
        return F.struct((seen["at"] + 1).alias("at"), depth.cast("int").alias("depth"), ended.cast("int").alias("end"))

    zero = F.lit(0).cast("int")
    end = F.aggregate(parts, F.struct(zero.alias("at"), zero.alias("depth"), zero.alias("end")), step)["end"]
    inside = F.slice(parts, F.lit(1), F.when(end > 0, end - 1).otherwise(F.size(parts)))
    return F.array_join(F.transform(inside, _markup_gone), "")


def first_element_text(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Text of the first such element outside comments, ``N/A`` when there is none.

    Elements of the same tag inside it belong to its text; most have none, and are cut out by one expression.
    """
    attrs = r"(?:\s[^>]*)?"
    if css_class is not None:
        attrs = (rf"""\s[^>]*?class\s*=\s*(?:"(?:[^">]*\s)?{css_class}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{css_class}(?:\s[^'>]*)?'"""
                 rf"""|{css_class}(?=[\s>]))[^>]*""")
    begin = rf"(?is)<{tag}{attrs}>"
    seen = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, r"(?s)<!--.*?-->", "")).otherwise(html)

    def text_of(element: Column) -> Column:
        # Most elements hold none of their kind, and end at the first end tag.
        nested = element.rlike(rf"(?is)^<[^>]*>.*<{tag}[\s/>]")
        opened = F.substr(seen, F.regexp_instr(seen, F.lit(begin)))
        found = F.when(nested, _whole_text(opened, tag)).otherwise(F.regexp_replace(element, r"<[^>]*>", ""))
        return F.when(element != "", unescape(found)).otherwise(F.lit(fixed.NOT_FOUND))

    # An array of one, so that the page is searched once for it.
    element = F.array(F.regexp_extract(seen, rf"{begin}.*?</{tag}\s*>", 0))
    return F.coalesce(F.transform(element, text_of)[0], F.lit(fixed.NOT_FOUND))


def parse_listings(pages: DataFrame, html: str = "html", source: str = fixed.HTML_SOURCE,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Title and price of listing pages."""
    h = F.col(html)
    return pages.select(*keep, first_element_text(h, "h1", "listing-title").alias("title"),
                        first_element_text(h, "span", "price").alias("price"), F.lit(source).alias("source"))
