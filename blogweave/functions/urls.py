"""URL column functions: ids from URLs, host lookup, URL resolution.

All are native expressions (regexp / string functions), so they stay in
whole-stage codegen.  Regexes use ASCII classes written out, which behave
the same in Java and RE2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import html as H

# Fixed patterns of the original URL scheme (ids are path segments).
COMPANY_ID = r"/company/([^/]+)/"
USER_ID = r"/users/([^/]+)/"
HUB_ID = r"/hub/([^/]+)/"
# An all-digit segment that is followed by '/' (loose: or ends the URL).
POST_SEGMENT = r"(?<=/)[0-9]++(?=/)"
POST_SEGMENT_LOOSE = r"(?<=/)[0-9]++(?=/|$)"

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
NETLOC = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
# A <link> tag with rel=canonical (any attribute order), then its href.
CANONICAL_TAG = r"""(?i)<link\b[^<>]*\brel\s*=\s*["']?canonical["']?[^<>]*>"""
# Only links of the head count.
HEAD = r"(?is)<head\b[^>]*>(.*?)(?:</head|<body\b|\z)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _group(url, pattern: str, idx: int = 1) -> Column:
    return F.nullif(F.regexp_extract(_col(url), pattern, idx), F.lit(""))


def company_id(url) -> Column:
    return _group(url, COMPANY_ID)


def user_id(url) -> Column:
    return _group(url, USER_ID)


def hub_id(url) -> Column:
    return _group(url, HUB_ID)


def post_id(url, loose: bool = False) -> Column:
    """Numeric post id: the last all-digit segment of the first run of non-empty
    segments that has one; ``loose`` also accepts a last segment without '/'.
    A URL of any length is read without recursion."""
    runs = F.split(_col(url), "//")
    last = F.size(runs) - 1
    whole = F.transform(runs, lambda r, k: F.concat(F.when(k > 0, F.lit("/")).otherwise(F.lit("")), r,
                                                    F.when(k < last, F.lit("/")).otherwise(F.lit(""))))
    found = F.transform(whole, lambda r: F.try_element_at(
        F.regexp_extract_all(r, F.lit(POST_SEGMENT_LOOSE if loose else POST_SEGMENT), F.lit(0)), F.lit(-1)))
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0)).try_cast("bigint")


def netloc(url) -> Column:
    """Network location as written (keeps user info and port, like netloc)."""
    return _group(url, NETLOC)


def canonical_href(html) -> Column:
    tag = F.regexp_extract(F.regexp_extract(_col(html), HEAD, 1), CANONICAL_TAG, 0)
    return F.nullif(H.attribute(tag, H.HREF), F.lit(""))


def canonical_url(html, url) -> Column:
    return F.coalesce(canonical_href(html), _col(url))


def hub_term(url) -> Column:
    """Last two non-empty path segments joined by '_'; null below two."""
    path = F.regexp_replace(F.regexp_replace(_col(url), NETLOC, ""), r"[?#].*$", "")
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), "_"))


def remove_dot_segments(path) -> Column:
    """RFC 3986 dot-segment removal of a path, as a fold over its segments
    (``..`` pops, ``.`` is skipped; a trailing dot segment keeps the slash)."""
    segs = F.split(_col(path), "/")
    kept = F.aggregate(
        F.slice(segs, 2, F.size(segs)), F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc).otherwise(F.concat(acc, F.array(seg))))
    trailing = F.element_at(segs, -1).isin(".", "..")
    out = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(_col(path).isNull() | (_col(path) == ""), _col(path)).when(
        trailing & (F.size(kept) > 0), F.concat(out, F.lit("/"))).otherwise(out)


def _normalise_path(url: Column) -> Column:
    """Apply dot-segment removal to the path of an absolute URL when needed."""
    m = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
    head, path, tail = (F.regexp_extract(url, m, i) for i in (1, 2, 3))
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*[^?#]*/\.{1,2}(/|$|[?#])"),
                  F.concat(head, remove_dot_segments(path), tail)).otherwise(url)


def join_url(base, ref) -> Column:
    """Resolve ``ref`` against ``base`` like urljoin.

    Absolute, scheme-relative, root-relative, query-only, fragment-only,
    empty and plain relative references; dot segments of the merged path
    are removed (RFC 3986: empty segments such as ``//`` are kept).
    """
    base, ref = _col(base), _col(ref)
    scheme = F.regexp_extract(base, SCHEME, 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path = F.regexp_extract(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1)
    directory = F.regexp_replace(path, "[^/]*$", "")
    directory = F.concat(origin, F.when(directory == "", F.lit("/")).otherwise(directory))
    return (F.when(ref.isNull(), F.lit(None))
            .when(ref == "", no_frag)
            .when(ref.rlike(SCHEME), ref)
            .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
            .when(ref.startswith("/"), _normalise_path(F.concat(origin, ref)))
            .when(ref.startswith("?"), F.concat(no_query, ref))
            .when(ref.startswith("#"), F.concat(no_frag, ref))
            .otherwise(_normalise_path(F.concat(directory, ref))))


# A percent escape, text without one, or a lone sign.
_ESCAPES = r"%[0-9A-Fa-f]{2}|[^%]++|%"
_ABSOLUTE = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _normal_escapes(c: Column) -> Column:
    """Escapes of letters, digits and ``-._~`` undone, the others in upper case."""
    def one(t: Column) -> Column:
        code = F.conv(F.substring(t, 2, 2), 16, 10).cast("int")
        char = F.char(code)
        return F.when(~t.rlike("^%[0-9A-Fa-f]{2}$"), t).when((code < 128) & char.rlike("^[A-Za-z0-9._~-]$"), char).otherwise(F.upper(t))
    return F.when(F.contains(c, F.lit("%")), F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_ESCAPES), F.lit(0)), one), "")).otherwise(c)


def identity(url) -> Column:
    """The canonical form by which a crawl knows a URL: without fragment,
    scheme and host in lower case, no default port, an empty path as ``/``,
    query parameters in order of name and value (repeated ones stay),
    percent escapes normalised.  URLs that are not absolute only lose their fragment."""
    u = _col(url)
    scheme, host, path, query = (F.regexp_extract(u, _ABSOLUTE, i) for i in (1, 2, 3, 4))
    scheme, host = F.lower(scheme), F.lower(host)
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    pairs = F.transform(F.filter(F.split(F.substring(query, 2, 1 << 30), "&"), lambda p: p != ""), _normal_escapes)
    ordered = F.transform(F.sort_array(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), p.alias("pair")))),
                          lambda x: x["pair"])
    whole = F.concat(scheme, F.lit("://"), F.regexp_replace(port, ":$", ""), F.when(path == "", F.lit("/")).otherwise(_normal_escapes(path)),
                     F.when(F.size(ordered) > 0, F.concat(F.lit("?"), F.array_join(ordered, "&"))).otherwise(F.lit("")))
    return F.when(u.rlike(_ABSOLUTE), whole).otherwise(F.regexp_replace(u, "(?s)#.*$", ""))


def identity_key(url) -> Column:
    """128 bits of the canonical form."""
    return F.md5(identity(url))


def with_url_ids(df: DataFrame, sites: DataFrame, url_col: str = "url", html_col: str | None = None,
                 loose: bool = False) -> DataFrame:
    """Add host, blog, company, post, user and hub ids of a URL column.

    The blog comes from a host lookup against ``sites``; an unknown host
    gives a null blog and ``host_known = false`` instead of failing the page.
    """
    url = F.col(url_col)
    if html_col:
        df = df.withColumn("canonical_url", canonical_url(F.col(html_col), url))
        url = F.col("canonical_url")
    out = df.select(
        "*",
        netloc(url).alias("host"),
        company_id(url).alias("company_id"),
        post_id(url, loose).alias("post_id"),
        user_id(url).alias("user_id"),
        hub_id(url).alias("hub_id"),
    )
    lookup = sites.select(F.col("host").alias("_h"), "blog_id")
    return (out.join(lookup, out.host == lookup._h, "left").drop("_h")
            .withColumn("host_known", F.col("blog_id").isNotNull()))
