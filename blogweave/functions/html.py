"""Native HTML column functions for flat page features.

Title, anchors, definition lists and visible text do not need a DOM: regular
expressions over the page text are enough and keep the work in the JVM.
Nested structures (posts with comment trees) and links of a certain place in
the page are read by the workers in :mod:`blogweave.operators.extract` and
:mod:`blogweave.operators.scoped_links`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
# An opening anchor tag; a ">" within quotes does not end it.
_OPEN_A = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*+>"""
# An anchor up to its end tag, or to the next anchor when that is missing.
_ANCHOR = _OPEN_A + r".*?(?=</a\s*>|<a\s|\z)"
# An attribute's value in double quotes, single quotes or without quotes (groups 1-3).
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
HREF = r"(?i)\shref" + _VALUE
CLASS_ATTR = r"(?i)\sclass" + _VALUE
# A tag; a ">" within quotes does not end it.
ANY_TAG = r"""<(?:[^>"']|"[^"]*"|'[^']*')*+>|<[^>]*>"""
# Text nodes as an HTML soup parser sees them: raw text of script and
# textarea, the content of comments and declarations, nothing of tags.
SOUP_TEXT = (r"(?is)<(?:script|textarea)\b[^>]*>(.*?)</(?:script|textarea)\s*>"
             r"|<!--(.*?)-->|<!([^>]*)>|" + ANY_TAG)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title(html) -> Column:
    return F.nullif(F.regexp_extract(_col(html), TITLE, 1), F.lit(""))


def visible_text(html, keep_comments: bool = True) -> Column:
    """All text nodes joined with no separator.

    ``keep_comments=True`` keeps script text and the text of comments and
    declarations (what a soup parser lists as text nodes); ``False`` is the
    plain tag-strip form.  Entities are left as written.
    """
    if keep_comments:
        return F.regexp_replace(_col(html), SOUP_TEXT, "$1$2$3")
    return F.regexp_replace(_col(html), ANY_TAG, "")


def attribute(tag, pattern: str) -> Column:
    """The value of an attribute's pattern (its three ways of quoting); null without it."""
    def value(m: Column) -> Column:
        own = F.ltrim(F.substr(m, F.instr(m, "=") + 1), F.lit(" \t\n\r\x0b\x0c"))
        quoted = F.startswith(own, F.lit('"')) | F.startswith(own, F.lit("'"))
        return F.when(m != "", unescape_basic(F.when(quoted, F.substr(own, F.lit(2), F.length(own) - 2)).otherwise(own)))

    # one search; the parts are cut from what it finds
    return F.get(F.transform(F.array(F.regexp_extract(_col(tag), pattern, 0)), value), F.lit(0))


def anchors(html) -> Column:
    """``ARRAY<STRUCT<href, inner, tag>>`` of the anchors with an href, in
    document order: one pass over the text, the parts come from each match."""
    found = F.filter(F.regexp_extract_all(_col(html), F.lit(_ANCHOR), F.lit(0)),
                     lambda m: F.regexp_extract(m, _OPEN_A, 0).rlike(HREF))
    return F.transform(found, lambda m: F.struct(
        attribute(F.regexp_extract(m, _OPEN_A, 0), HREF).alias("href"),
        F.regexp_replace(m, "^" + _OPEN_A, "").alias("inner"), F.regexp_extract(m, _OPEN_A, 0).alias("tag")))


def open_tag(tag: str = "[a-z0-9]+", cls: str | None = None) -> str:
    """Pattern of an opening tag, with one of its classes if one is named, in
    any quoting."""
    if cls is None:
        return rf"(?is)<{tag}\b[^>]*>"
    c = re.escape(cls)
    value = rf"""(?:"(?:[^"]*\s)?{c}(?:\s[^"]*)?"|'(?:[^']*\s)?{c}(?:\s[^']*)?'|{c}(?=[\s>]))"""
    return rf"(?is)<{tag}\b(?:[^>]*\s)?class\s*=\s*{value}[^>]*>"


def first_text(markup) -> Column:
    """The first text node of some markup; null without one."""
    return unescape_basic(F.nullif(F.regexp_extract(_col(markup), r"(?s)^(?:<[^>]*+>)*+([^<]+)", 1), F.lit("")))


def class_of(tag) -> Column:
    return F.coalesce(attribute(tag, CLASS_ATTR), F.lit(""))


def has_class(classes, name: str) -> Column:
    return F.array_contains(F.split(_col(classes), r"\s+"), name)


def unescape_basic(c) -> Column:
    """Undo the five basic entities and the fixed space (``&amp;`` last)."""
    whole = c = _col(c)
    for ent, ch in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.when(F.contains(whole, F.lit("&")), c).otherwise(whole)
