"""Nesting of markup as native column expressions.

A page is cut into tokens that cover it: tags, comments, declarations, whole
``script`` and ``style`` elements, and texts.  Each tag name has a running depth
(a prefix sum of +1 and -1), an open tag ends at the next end tag of its name
and depth, and "inside" is a running maximum of ends.  So nothing needs a tree:
elements are spans of token numbers, markup is the tokens between them.

Prefix sums over an array are done by doubling (log2(n) passes over it), and
whatever is looked up by index is bound to a lambda variable first, so a page of
n tokens costs n log n whatever is in it.  End tags without an open element are
ignored, and an element that is never closed reaches to the end of the page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import html as H

# Attributes: a "<" outside quotes ends them, so an unclosed tag is given up at the next one.
_ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = (r"(?is)<!--.*?(?:-->|\z)"
         rf"|<(script|style)\b{_ATTRS}>.*?(?:</\1\s*>|\z)"
         rf"|</?[a-z]{_ATTRS}>|<[!?/][^<>]*+>"
         r"|(?:[^<]++|<(?![a-z/!?]))++|<")
_IS_TEXT = r"^(?:[^<]|<(?![A-Za-z/!?]))"
_NAME = r"^</?([A-Za-z][^\s/>]*)"
_SELF_CLOSED = r"""^<[A-Za-z][^\s/>]*/>$|[\s"']/>$"""

# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
_RAW = ("script", "style")

# Up to so many outer elements are looked through one by one, which is cheaper than sorting.
FEW = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: the end of a fold over
    nothing, which copies neither (``transform`` copies what it returns)."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, _: a, body)


def staged(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once: neither later filters nor
    later columns are merged with a generator's expression.  Long expressions
    also need a step of their own because every level of nested lambdas is a
    round of the analyser."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def powers(ok: Callable[[Column], Column]) -> Column:
    """The steps of doubling that are ``ok``, in order."""
    return F.filter(F.expr(f"array({', '.join(str(1 << k) for k in range(26))})"), ok)


def scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Prefix combination of an array by an associative ``op``, by doubling."""
    def once(acc: Column, p: Column) -> Column:
        return F.transform(acc, lambda x, k: F.when(k < p, x).otherwise(op(F.get(acc, k - p), x)))
    return let(values, lambda v: F.aggregate(powers(lambda p: p < F.size(v)), v, once))


def running_max(values: Column) -> Column:
    return scan(values, lambda a, b: F.greatest(a, b))


def tokens(html: Column) -> Column:
    """The page's tokens; put together they are the page."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def attribute_of(tag: Column, name: str) -> Column:
    """An attribute's value, empty without one: quoted, or up to the next space."""
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*(["']?)(.*?)\1(?=[\s/>])""", 2)
    return F.when(F.contains(tag, F.lit("=")), H.unescape_basic(value)).otherwise(F.lit(""))


def _tag_name(t: Column) -> Column:
    name = F.regexp_extract(t, _NAME, 1)
    return F.when(t.rlike("^</?[a-z0-9]*+[A-Z]"), F.lower(name)).otherwise(name)


def elements(of: Column, names: tuple[str, ...] | None = None, marked_too: bool = False) -> Column:
    """The elements of a token array, in document order:
    ``ARRAY<STRUCT<i, end, name, level, tag, cls, id>>``.  ``i`` and ``end``
    are the numbers (from 1) of the open tag and of the end tag, or one more
    than there are tokens; levels of one name differ as their depths do.

    ``names``: only elements of these names; ``marked_too``: and all others
    that have a class or an id.  Names of which no tag has an attribute are
    then passed over, however many tags there are."""
    def tag_of(t: Column, k: Column) -> Column:
        closes = F.startswith(t, F.lit("</"))
        sign = F.when(closes, F.lit(-1)).when(F.endswith(t, F.lit("/>")) & t.rlike(_SELF_CLOSED), F.lit(0)).otherwise(F.lit(1))
        return F.when(F.startswith(t, F.lit("<")), F.struct(_tag_name(t).alias("name"), (k + 1).alias("i"), sign.alias("sign")))

    def wanted(x: Column, also: Column | None) -> Column:
        known = x["name"].isin(*names) if names else (x["name"] != "") & ~x["name"].isin(*VOID, *_RAW)
        if also is not None:
            known = known | F.array_contains(also, x["name"])
        return known & (x["sign"] != 0)

    def with_attributes(o: Column) -> Column:
        found = F.array_distinct(F.transform(F.filter(o, lambda t: F.startswith(t, F.lit("<")) & F.contains(t, F.lit("="))), _tag_name))
        return F.filter(found, lambda n: (n != "") & ~n.isin(*VOID, *_RAW))

    # a close has the depth of the open tag it ends; what a name's depth starts from does not matter
    def marked(t: Column, total: Column) -> Column:
        return F.transform(t, lambda x, k: F.struct(
            x["name"].alias("name"), (F.get(total, k) + F.when(x["sign"] < 0, F.lit(1)).otherwise(F.lit(0))).alias("level"),
            x["i"].alias("i"), x["sign"].alias("sign")))

    def spans(s: Column, n: Column) -> Column:
        def one(x: Column, k: Column) -> Column:
            y = F.get(s, k + 1)
            closed = (y["level"] == x["level"]) & (y["sign"] < 0) & (y["name"] == x["name"])
            return F.when(x["sign"] > 0, F.struct(x["i"].alias("i"), F.when(closed, y["i"]).otherwise(n + 1).alias("end"),
                                                  x["name"].alias("name"), x["level"].alias("level")))
        return F.sort_array(F.filter(F.transform(s, one), lambda x: x.isNotNull()))

    def attributed(o: Column, found: Column) -> Column:
        def one(x: Column) -> Column:
            tag = F.get(o, x["i"] - 1)
            return F.struct(x["i"].alias("i"), x["end"].alias("end"), x["name"].alias("name"), x["level"].alias("level"), tag.alias("tag"),
                            attribute_of(tag, "class").alias("cls"), F.nullif(attribute_of(tag, "id"), F.lit("")).alias("id"))
        every = F.transform(found, one)
        return F.filter(every, lambda x: (x["cls"] != "") | x["id"].isNotNull() | x["name"].isin(*names)) if marked_too else every

    def of_tokens(o: Column) -> Column:
        tagged = F.transform(o, tag_of)
        some = (let(with_attributes(o), lambda also: F.filter(tagged, lambda x: wanted(x, also))) if marked_too
                else F.filter(tagged, lambda x: wanted(x, None)))
        tags = F.sort_array(some)
        ordered = let(tags, lambda t: let(scan(F.transform(t, lambda x: x["sign"]), lambda a, b: a + b), lambda total: F.sort_array(marked(t, total))))
        return let(F.size(o), lambda n: attributed(o, let(ordered, lambda s: spans(s, n))))
    return let(of, of_tokens)


def has_class(e: Column, name: str) -> Column:
    return F.contains(e["cls"], F.lit(name)) & F.array_contains(F.split(e["cls"], r"\s+"), name)


def pick(found: Column, tag: str | None = None, cls: str | None = None, id: str | None = None) -> Column:
    """The elements of a name, with a class or an id."""
    def ok(e: Column) -> Column:
        out = F.lit(True)
        if tag:
            out = out & (e["name"] == tag)
        if cls:
            out = out & has_class(e, cls)
        if id:
            out = out & F.coalesce(e["id"] == id, F.lit(False))
        return out
    return F.filter(found, ok)


def inside(outer: Column, inner: Column, outside: bool = False) -> Column:
    """Those of ``inner`` that lie within one of ``outer`` (or within none)."""
    def both(o: Column, n: Column) -> Column:
        # an element that is in both comes first as an inner one: it does not hold itself
        merged = F.sort_array(F.concat(
            F.transform(n, lambda x, k: F.struct(x["i"].alias("i"), F.lit(0).alias("role"), F.lit(0).alias("end"), k.alias("k"))),
            F.transform(o, lambda x: F.struct(x["i"].alias("i"), F.lit(1).alias("role"), x["end"].alias("end"), F.lit(0).alias("k")))))

        def chosen(m: Column, ends: Column) -> Column:
            flagged = F.transform(m, lambda x, k: F.struct(x["k"].alias("k"), ((x["role"] == 0) & (
                (F.get(ends, k) > x["i"]) if not outside else (F.get(ends, k) <= x["i"]))).alias("ok")))
            return F.transform(F.filter(flagged, lambda x: x["ok"]), lambda x: F.get(n, x["k"]))
        def within(x: Column) -> Column:
            hit = F.exists(o, lambda y: (y["i"] < x["i"]) & (y["end"] > x["i"]))
            return ~hit if outside else hit
        return F.when(F.size(o) <= FEW, F.filter(n, within)).otherwise(
            let(merged, lambda m: let(running_max(F.transform(m, lambda x: x["end"])), lambda ends: chosen(m, ends))))
    return let(outer, lambda o: let(inner, lambda n: both(o, n)))


def path(found: Column, *steps: tuple[str | None, str | None, str | None]) -> Column:
    """Descendant steps of (tag, class, id)."""
    out = pick(found, *steps[0])
    for step in steps[1:]:
        out = inside(out, pick(found, *step))
    return out


def first_inside(boxes: Column, inner: Column) -> Column:
    """The first of ``inner`` within each of ``boxes`` that has one, by box."""
    def nearest(b: Column, n: Column) -> Column:
        merged = F.reverse(F.sort_array(F.concat(
            F.transform(n, lambda x, k: F.struct(x["i"].alias("i"), F.lit(0).alias("role"), F.lit(0).alias("end"), k.alias("k"))),
            F.transform(b, lambda x: F.struct(x["i"].alias("i"), F.lit(1).alias("role"), x["end"].alias("end"), F.lit(0).alias("k"))))))

        def chosen(m: Column, last: Column) -> Column:
            def follower(x: Column, k: Column) -> Column:
                y = F.get(m, F.get(last, k) - 1)           # nothing follows: index -1 gives null
                return F.when((x["role"] == 1) & (y["i"] < x["end"]) & (y["i"] > x["i"]), y["k"])
            return F.transform(F.filter(F.reverse(F.transform(m, follower)), lambda k: k.isNotNull()), lambda k: F.get(n, k))
        def looked_for(x: Column) -> Column:
            return F.get(F.filter(n, lambda y: (y["i"] > x["i"]) & (y["i"] < x["end"])), F.lit(0))
        return F.when(F.size(b) <= FEW, F.filter(F.transform(b, looked_for), lambda y: y.isNotNull())).otherwise(
            let(merged, lambda m: let(running_max(F.transform(m, lambda x, k: F.when(x["role"] == 0, k + 1).otherwise(F.lit(0)))),
                                      lambda last: chosen(m, last))))
    return let(boxes, lambda b: let(inner, lambda n: nearest(b, n)))


def part(of: Column, first: Column, last: Column) -> Column:
    """The tokens with numbers ``first`` to ``last``; the others are not touched."""
    return F.when(first <= last, F.transform(F.sequence(first, F.greatest(first, last)), lambda j: F.get(of, j - 1))).otherwise(
        F.array().cast("array<string>"))


def between(of: Column, e: Column) -> Column:
    """The tokens within an element."""
    return part(of, e["i"] + 1, e["end"] - 1)


def texts(of: Column, e: Column) -> Column:
    """The text nodes within an element."""
    return F.transform(F.filter(between(of, e), lambda t: t.rlike(_IS_TEXT)), H.unescape_basic)


def all_texts(of: Column, found: Column) -> Column:
    return F.flatten(F.transform(found, lambda e: texts(of, e)))


def first_text(of: Column, found: Column) -> Column:
    """The first text node within a selection; null without one."""
    def first(e: Column) -> Column:
        return F.get(F.filter(between(of, e), lambda t: t.rlike(_IS_TEXT)), F.lit(0))
    return H.unescape_basic(F.get(F.filter(F.transform(found, first), lambda t: t.isNotNull()), F.lit(0)))


def attributes(found: Column, pattern: str) -> Column:
    """The attribute's values of the elements that have it."""
    return F.filter(F.transform(found, lambda e: H.attribute(e["tag"], pattern)), lambda v: v.isNotNull())


def first_attribute(found: Column, pattern: str) -> Column:
    return F.get(attributes(found, pattern), F.lit(0))


def inner_html(of: Column, e: Column) -> Column:
    """The markup within an element as written, stripped."""
    return F.regexp_replace(F.array_join(between(of, e), ""), r"^\s++|(?<!\s)\s++$", "")


def outer_html(of: Column, e: Column) -> Column:
    return F.array_join(part(of, e["i"], F.least(e["end"], F.size(of))), "")
