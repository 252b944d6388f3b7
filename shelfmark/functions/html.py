"""Elements, texts and attributes of HTML held in a string column.

Regular expressions, not a parser: an element ends at its closing tag, at the next opening tag that
is wanted as well, or at the end of the HTML, so one that is never closed is found. Elements of its
name but not of its class may be nested in it, one deep; `dom` finds elements at any depth. Attribute
values may be double-quoted, single-quoted or bare.
"""

import re

from pyspark.sql import functions as F

from .entities import unescape  # noqa: F401

_QUOTED = r""""[^"]*+"|'[^']*+'"""
REST_OF_TAG = rf"(?>[^>\"']++|{_QUOTED})*+>"
_VALUE = rf"""({_QUOTED}|[^\s"'>]+)"""
NAME_END = r"(?![\w:-])"
# Names of tags and attributes ignore case; class tokens do not.
_CLASS = r"\s(?i:class)\s*=\s*"


def _until_closed(tag):
    """Everything up to the first closing tag, without backtracking."""
    return rf"[^<]*+(?:<(?!/(?i:{tag}){NAME_END})[^<]*+)*+"


COMMENT = r"!--[^-]*+(?:-(?!->)[^-]*+)*+-->"
CODE = "|".join(
    rf"(?i:{tag}){NAME_END}{_until_closed(tag)}</(?i:{tag})\s*>" for tag in ("script", "style")
)
_NOISE = f"<(?:{COMMENT}|{CODE})"


def drop_noise(html):
    """HTML without comments, scripts and styles, whose text must not be taken for elements."""
    return F.regexp_replace(html, _NOISE, "")


def elements(html, tag, css_class=None):
    """Inner HTML of every such element, in document order."""
    return F.regexp_extract_all(html, F.lit(_element(tag, css_class)), F.lit(1))


def element(html, tag, css_class=None):
    """The first such element, its tags included; empty if there is none."""
    return F.regexp_extract(html, _element(tag, css_class), 0)


def opening_tag(html, tag, css_class=None, within=None):
    """The first such opening tag, or that of the first `within` element; empty if none."""
    wanted = opening_pattern(tag, css_class)
    if within is None:
        return F.regexp_extract(html, wanted, 0)
    before = rf"[^<]*+(?:<(?!(?i:{within}){NAME_END})[^<]*+)*+"
    between = rf"[^<]*+(?:<(?!(?:{wanted[1:]})|/(?i:{within}){NAME_END})[^<]*+)*+"
    return F.regexp_extract(html, f"^{before}{opening_pattern(within, None)}{between}({wanted})", 1)


def attribute(tag, name):
    """Raw value of an attribute of an opening tag, NULL if absent."""
    wanted = rf"\s{name}\s*=\s*"
    pattern = rf"(?is)^<\w+(?>(?!{wanted})(?:[^>\"']|{_QUOTED}))*+{wanted}{_VALUE}"
    raw = F.try_element_at(F.regexp_extract_all(tag, F.lit(pattern), F.lit(1)), F.lit(1))
    return F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")


def card_fields():
    """A pattern that finds the fields of a card together, and then fits all of the card; else it fits
    nothing. The groups are `title`, `rating`, `price` and `stock`, or, of a card in the usual order, those
    names with a `1`; the other four are then empty.

    Each is what `attribute` or `element` finds alone. It does not fit if one is missing, if a value is
    not in double quotes, or if the price holds a tag or the stock a paragraph.
    """
    return rf"^(?:{_fields_in_order()}|{_fields_anywhere()})(?s:.*)\z"


def _fields_anywhere():
    """The fields in any order: each is looked for from the beginning."""

    def up_to(wanted, end=None):
        ends = "" if end is None else rf"|/(?i:{end}){NAME_END}"
        return rf"[^<]*+(?:<(?!{wanted[1:]}{ends})[^<]*+)*+(?={wanted})"

    def value(name, group):
        wanted = rf"\s(?i:{name})\s*=\s*"
        return rf'<\w+(?>(?!{wanted})(?:[^>\"\']|{_QUOTED}))*+{wanted}"(?<{group}>[^"]*+)"'

    heading, link = opening_pattern("h3", None), opening_pattern("a", None)
    star, price, stock = (opening_pattern("p", name) for name in _PARAGRAPHS)
    opened, closed = rf"<\w+{REST_OF_TAG}", r"</(?i:p)\s*>"
    no_paragraph = rf"[^<]*+(?:<(?!/?(?i:p){NAME_END})[^<]*+)*+"
    return (
        rf"(?={up_to(heading)}{heading}{up_to(link, 'h3')}{value('title', 'title')})"
        rf"(?={up_to(star)}{value('class', 'rating')})"
        rf"(?={up_to(price)}{opened}(?<price>[^<]*+){closed})"
        rf"(?={up_to(stock)}(?<stock>{opened}{no_paragraph}{closed}))"
    )


_PARAGRAPHS = ("star-rating", "price_color", "instock")


def _fields_in_order():
    """The fields in one pass: a heading with a link, then paragraphs of the rating, price and stock.

    What this finds is what _fields_anywhere finds, as no paragraph lies before or between these, none has
    the class of a later one, and no tag has a `<` in its quotes.
    """
    quoted = r'"[^<"]*+"|\'[^<\']*+\''
    rest = rf"(?>[^<>\"']++|{quoted})*+>"

    def up_to(*names):
        return rf"[^<]*+(?:<(?!(?:{'|'.join(rf'(?i:{name})' for name in names)}){NAME_END})[^<]*+)*+"

    def tag(name, attribute, value):
        wanted = rf"\s(?i:{attribute})\s*=\s*"
        skipped = rf"(?>(?!{wanted})(?:[^<>\"']|{quoted}))*+"
        return rf'<(?i:{name}){NAME_END}{skipped}{wanted}"{value}"{rest}'

    def paragraph(place, group=None):
        own, later = re.escape(_PARAGRAPHS[place]), "|".join(map(re.escape, _PARAGRAPHS[place + 1 :]))
        alone = rf'(?![^"<]*(?:{later}))' if later else ""
        has_class = rf'(?=(?:[^"<]*\s)?{own}(?:\s[^"<]*)?"){alone}'
        value = r'[^"<]*+' if group is None else rf'(?<{group}>[^"<]*+)'
        return tag("p", "class", has_class + value)

    closed = r"</(?i:p)\s*>"
    return (
        rf"{up_to('h3', 'p')}<(?i:h3){NAME_END}{rest}{up_to('a', 'p', '/h3')}"
        rf"{tag('a', 'title', '(?<title1>[^<\"]*+)')}"
        rf"{up_to('p')}{paragraph(0, 'rating1')}{up_to('p')}{paragraph(1)}(?<price1>[^<]*+){closed}"
        rf"{up_to('p')}(?<stock1>{paragraph(2)}{up_to('/?p')}{closed})"
    )


def text(html):
    """Text without tags, entities not yet decoded."""
    return F.regexp_replace(html, f"</?[a-zA-Z]{REST_OF_TAG}", "")


def opening_pattern(tag, css_class):
    if css_class is None:
        return rf"<(?i:{tag}){NAME_END}{REST_OF_TAG}"
    name = re.escape(css_class)
    skip = rf"(?>(?!{_CLASS})(?:[^>\"']|{_QUOTED}))*+"
    double = rf'"(?:[^"]*\s)?{name}(?:\s[^"]*)?"'
    single = rf"'(?:[^']*\s)?{name}(?:\s[^']*)?'"
    bare = rf"{name}(?=[\s>])"
    has_class = rf"(?={skip}{_CLASS}(?:{double}|{single}|{bare}))"
    return rf"<(?i:{tag}){NAME_END}{has_class}{REST_OF_TAG}"


def _element(tag, css_class):
    wanted = opening_pattern(tag, css_class)
    same = rf"(?i:{tag}){NAME_END}"
    within = rf"<(?!{wanted[1:]}){same}{REST_OF_TAG}[^<]*+(?:<(?!/?{same})[^<]*+)*+</(?i:{tag})\s*>"
    content = rf"[^<]*+(?:(?:{within}|<(?!/{same}|{wanted[1:]}))[^<]*+)*+"
    return rf"{wanted}({content})(?:</(?i:{tag})\s*>|(?=<)|\z)"
