"""Small XML text expressions: escaping, start-tag attributes, whole elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five predefined XML entities, in the order that
# unescapes correctly (the ampersand last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]


def escape_text(value: Column) -> Column:
    """Escape a value for element content; a carriage return must stay a reference."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


def escape_attribute(value: Column) -> Column:
    value = escape_text(value)
    for char, entity in (('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;")):
        value = F.replace(value, F.lit(char), F.lit(entity))
    return value


#: What may stand in a start tag: quoted values hold anything, also a closing bracket.
IN_TAG = r"""(?:[^<>"']++|"[^"]*"|'[^']*')*+"""


def unescape(value: Column) -> Column:
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def attribute(start_tag: Column, name: str) -> Column:
    """Value of ``NAME="..."`` or ``prefix:name='...'`` in a start tag; NULL if absent or empty."""
    before = r"""^<[^\s/>]+(?:\s+[\w.:-]+\s*=\s*(?:"[^"]*"|'[^']*'))*?"""
    own = rf"""\s+(?:[\w.-]+:{name.lower()}|{name})\s*=\s*"""
    quoted = F.regexp_extract(start_tag, before + own + r"""("[^"]*"|'[^']*')""", 1)
    plain = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    # Numeric references are left to the XML parser.
    resolved = F.xpath_string(F.concat(F.lit("<a v="), quoted, F.lit("/>")), F.lit("/a/@v"))
    return F.nullif(F.when(F.contains(quoted, F.lit("&#")), resolved).otherwise(unescape(plain)), F.lit(""))


def without_comments(text: Column) -> Column:
    """Drop comments; a CDATA section keeps its content even if it looks like one."""
    cleaned = F.regexp_replace(text, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    return F.when(F.instr(text, "<!--") > 0, cleaned).otherwise(text)
