"""Small regex helpers over HTML text; everything stays in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .convert import col


def class_attr(*tokens: str) -> str:
    """Pattern of a class attribute that holds one of ``tokens`` as a whole class name."""
    names = "|".join(map(re.escape, tokens))
    return rf'class="(?:[^"]*\s)?(?:{names})(?:\s[^"]*)?"'


def _before(*tokens: str) -> str:
    """Pattern of all text up to the next class attribute with one of ``tokens``, or the end.

    It runs over the text in one go; a lazy ``.*?`` would try what follows at each character.
    """
    first, rest = class_attr(*tokens)[0], class_attr(*tokens)[1:]
    return rf"(?:[^{first}]++|{first}(?!{rest}))*+"


def section(html: Column | str, token: str, until: tuple[str, ...] = ()) -> Column:
    """Text after the first tag of class ``token``, up to the first tag of a class in ``until``.

    Null when there is no such tag, or nothing in it.
    """
    rest = rf"({_before(*until)})" if until else r"(.*)\z"
    pattern = rf"(?s){class_attr(token)}[^<>]*>{rest}"
    return F.nullif(F.regexp_extract(col(html), pattern, 1), F.lit(""))


def sections(html: Column | str, token: str) -> Column:
    """One text per tag of class ``token``: from it to the next such tag or the end."""
    return F.regexp_extract_all(col(html), F.lit(rf"{class_attr(token)}[^<>]*>{_before(token)}"), F.lit(0))


def has_class(html: Column | str, token: str) -> Column:
    # The plain search comes first and spares most texts the pattern.
    html = col(html)
    return F.contains(html, F.lit(token)) & F.regexp_like(html, F.lit(class_attr(token)))


def has_class_in_tag(tag: Column, token: str) -> Column:
    return F.regexp_like(tag, F.lit(class_attr(token)))


def attr(tag: Column, name: str) -> Column:
    """Value of an attribute in the text of one tag, null when absent or empty."""
    return F.nullif(F.regexp_extract(tag, rf'\s{re.escape(name)}="([^"]*)"', 1), F.lit(""))


def plain(fragment: Column) -> Column:
    """Visible text: tags dropped, the common entities decoded, blanks collapsed and trimmed."""
    t = F.regexp_replace(fragment, r"(?s)<[^>]*>", "")
    # The entities that occur in names and titles; & last.
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def first_text(html: Column | str, opening: str, closing: str = "</") -> Column:
    """Visible text of the first element whose opening tag matches ``opening``, null if none."""
    found = F.regexp_extract(col(html), rf"(?s){opening}.*?(?={closing})", 0)
    return plain(F.nullif(found, F.lit("")))


def tag_text(html: Column | str, tag: str) -> Column:
    return first_text(html, rf"<{tag}(?:\s[^>]*)?>", rf"</{tag}>")
