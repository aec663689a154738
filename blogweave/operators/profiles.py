"""User and company profiles from pages.

The markup is flat — a header and definition lists — so native regular
expressions read it, and no Python runs.  Which field a list fills is decided
by its label (or its element's id), the last of several lists wins, and
unknown labels are kept as ``info``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blogweave.functions import fields as FD
from blogweave.functions import html as H
from blogweave.functions import urls as U

_ID = r"(?i)\sid" + H._VALUE
_SRC = r"(?i)\ssrc" + H._VALUE


def _after(markup, pattern: str, rest: str = "(.*)") -> Column:
    """What follows the first element of a pattern."""
    return F.nullif(F.regexp_extract(markup, pattern + rest, 1), F.lit(""))


def _image(markup, tag: str, cls: str) -> Column:
    return H.attribute(F.regexp_extract(markup, H.open_tag(tag, cls) + r"\s*(<img\b[^>]*>)", 1), _SRC)


def _name(markup, tag: str, cls: str) -> Column:
    return H.first_text(_after(markup, H.open_tag(tag, cls) + r"\s*<a\b[^>]*>", "([^<]*)"))


def _number(markup, cls: str) -> Column:
    """Text of the first ``div.num`` after the opening ``div`` of a class."""
    return H.unescape_basic(_after(markup, H.open_tag("div", cls) + ".*?" + H.open_tag("div", "num"), "([^<]*)"))


def _definition(dl: Column) -> Column:
    """Parts of one ``<dl>``: the first ``dd`` and, of its anchors, those that
    stand in it directly and those of its list items."""
    dd = F.regexp_extract(dl, r"(?is)<dd\b[^>]*>(.*?)(?:</dd|\z)", 1)
    direct = F.regexp_replace(dd, r"(?is)<ul\b.*?</ul\s*>", "")
    items = F.regexp_extract_all(dd, F.lit(r"(?is)<li\b[^>]*>(.*?)(?=<li\b|</ul|\z)"), F.lit(1))
    users = F.regexp_extract(dd, H.open_tag("ul", "users") + "(.*?)</ul", 1)

    def texts(markup: Column) -> Column:
        """Texts of the anchors, also of those without an href."""
        inner = F.regexp_extract_all(markup, F.lit(r"(?is)<a\b[^>]*>(.*?)(?=</a\s*>|<a\b|\z)"), F.lit(1))
        return F.transform(inner, lambda m: H.unescape_basic(F.regexp_replace(m, H.ANY_TAG, "")))

    return F.struct(
        H.first_text(F.regexp_extract(dl, r"(?is)<dt\b[^>]*>(.*?)(?:</dt|\z)", 1)).alias("key"),
        H.attribute(F.regexp_extract(dl, r"(?is)^<dl\b[^>]*>", 0), _ID).alias("el_id"),
        H.first_text(dd).alias("value"), FD.strip_ws(dd).alias("value_html"),
        F.try_element_at(F.transform(H.anchors(direct), lambda a: a["href"]), F.lit(1)).alias("link"),
        F.transform(items, lambda li: F.try_element_at(F.transform(H.anchors(li), lambda a: a["href"]), F.lit(1))).alias("item_hrefs"),
        texts(direct).alias("link_texts"), texts(users).alias("user_texts"))


def extract_profile_pages(pages: DataFrame) -> DataFrame:
    """Raw profile fields, a row per page (``kind`` null without a header)."""
    html = F.col("html")
    company = html.rlike(H.open_tag("div", "company_header"))
    user = html.rlike(H.open_tag("div", "user_header"))
    kind = F.when(company, F.lit("company")).when(user, F.lit("user"))
    body = _after(html, H.open_tag("div", "company_profile"))
    body = F.when(company, body).otherwise(_after(html, H.open_tag("div", "user_profile")))
    dls = F.transform(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?is)<dl\b.*?</dl\s*>"), F.lit(0)), _definition)
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None)
    return pages.select(
        "page_id", "url", fetched.cast("timestamp_ntz").alias("fetched_at"), kind.alias("kind"), U.canonical_href(html).alias("canonical"),
        F.when(company, _name(html, "div", "name")).otherwise(_name(html, "h2", "username")).alias("name"),
        F.when(company, _image(html, "div", "company_icon")).otherwise(_image(html, "a", "avatar")).alias("image_src"),
        _number(html, "karma").alias("karma_text"), _number(html, "rating").alias("rating_text"),
        H.first_text(_after(html, H.open_tag("div", "fullname"))).alias("fullname"),
        F.filter(dls, lambda d: d["key"].isNotNull()).alias("dls"))


# Fixed labels of the profile definition lists.
USER_LABELS = {
    "about": "О себе",
    "site": "Сайт",
    "registered": "Зарегистрирован",
    "activity": "Активность",
    "hubs": "Состоит в",
    "invites_prefix": "Пригласил на",
    "interests": "Интересы",
}
USER_LIST_IDS = {"working": "working_in", "favorite": "favorite_companies_list"}
COMPANY_LABELS = {
    "about": "О компании",
    "site": "Сайт",
    "staff_prefix": "Сотрудники на",
    "date_prefix": "Дата",
    "date_suffix": "регистрации",
}


def _with_keys(dls, branch_of):
    """Stripped key and value per definition list, plus the branch the
    first matching rule of the parser assigns it to."""
    def one(d):
        k = FD.strip_label(d["key"])
        return F.struct(k.alias("k"), FD.strip_ws(d["value"]).alias("v"), d["value_html"].alias("html"),
                        d["link"].alias("link"), d["item_hrefs"].alias("hrefs"),
                        d["link_texts"].alias("texts"), d["user_texts"].alias("users"),
                        branch_of(k, d["el_id"]).alias("branch"))
    return F.transform(dls, one)


def _last(arr, branch: str):
    """The last definition list of a branch (later ones overwrite)."""
    return F.try_element_at(F.filter(arr, lambda x: x["branch"] == F.lit(branch)), F.lit(-1))


def _ids(hrefs, extractor):
    return F.filter(F.transform(hrefs, lambda h: extractor(h)), lambda x: x.isNotNull())


def _info(arr):
    """Unknown labels → sorted ``(key, value)``; a repeated key keeps its last value."""
    info = F.filter(arr, lambda x: x["branch"] == F.lit("info"))
    last_only = F.filter(info, lambda x, i: ~F.exists(F.slice(info, i + 2, F.size(info) + 1),
                                                      lambda y: y["k"] == x["k"]))
    return F.array_sort(F.transform(last_only, lambda x: F.struct(x["k"].alias("key"), x["html"].alias("value"))))


def user_profiles(raw: DataFrame, sites: DataFrame) -> DataFrame:
    L, ids = USER_LABELS, USER_LIST_IDS

    def branch(k, el_id):
        return (F.when(k == L["about"], "about").when(k == L["site"], "site")
                .when(k == L["registered"], "registered").when(k == L["activity"], "activity")
                .when(el_id == ids["working"], "working").when(el_id == ids["favorite"], "favorite")
                .when(k == L["hubs"], "hubs").when(k.startswith(L["invites_prefix"]), "invites")
                .when(k == L["interests"], "interests").otherwise("info"))

    u = raw.where(F.col("kind") == "user").withColumn("_d", _with_keys(F.col("dls"), branch))
    url = F.coalesce("canonical", "url")
    d = F.col("_d")
    out = u.select(
        "page_id", url.alias("url"),
        U.user_id(url).alias("user_id"),
        FD.strip_ws(F.col("name")).alias("username"),
        FD.strip_ws(F.col("fullname")).alias("fullname"),
        U.join_url(url, F.col("image_src")).alias("avatar_url"),
        FD.parse_site_datetime(FD.registration_text(_last(d, "registered")["v"]), F.col("fetched_at"))
          .alias("registration_date"),
        FD.parse_site_datetime(FD.last_activity_text(_last(d, "activity")["v"]), F.col("fetched_at"))
          .alias("last_activity"),
        FD.parse_karma("karma_text").alias("karma"),
        FD.parse_karma("rating_text").alias("rating"),
        _last(d, "about")["html"].alias("about_html"),
        _last(d, "site")["link"].alias("website_url"),
        F.coalesce(_ids(_last(d, "working")["hrefs"], U.company_id), F.array().cast("array<string>"))
          .alias("working_companies"),
        F.coalesce(_ids(_last(d, "favorite")["hrefs"], U.company_id), F.array().cast("array<string>"))
          .alias("favorite_companies"),
        F.coalesce(_ids(_last(d, "hubs")["hrefs"], U.hub_id), F.array().cast("array<string>")).alias("hubs"),
        F.coalesce(_last(d, "interests")["texts"], F.array().cast("array<string>")).alias("tags"),
        F.coalesce(_ids(_last(d, "invites")["hrefs"], U.user_id), F.array().cast("array<string>")).alias("invites"),
        _info(d).alias("info"),
    )
    return _with_blog(out, sites, "user_id", "user")


def company_profiles(raw: DataFrame, sites: DataFrame) -> DataFrame:
    L = COMPANY_LABELS

    def branch(k, el_id):
        return (F.when(k == L["about"], "about").when(k == L["site"], "site")
                .when(k.startswith(L["staff_prefix"]), "staff")
                .when(k.startswith(L["date_prefix"]) & k.endswith(L["date_suffix"]), "registered")
                .otherwise("info"))

    c = raw.where(F.col("kind") == "company").withColumn("_d", _with_keys(F.col("dls"), branch))
    url = F.coalesce("canonical", "url")
    d = F.col("_d")
    out = c.select(
        "page_id", url.alias("url"),
        U.company_id(url).alias("company_id"),
        F.col("name"),
        U.join_url(F.col("url"), F.col("image_src")).alias("icon_url"),
        _last(d, "about")["html"].alias("about_html"),
        _last(d, "site")["link"].alias("website_url"),
        FD.parse_site_datetime(_last(d, "registered")["v"], F.col("fetched_at")).alias("registration_date"),
        F.coalesce(_last(d, "staff")["users"], F.array().cast("array<string>")).alias("staff_users"),
        _info(d).alias("info"),
    )
    return _with_blog(out, sites, "company_id", "company")


def _with_blog(df: DataFrame, sites: DataFrame, id_col: str, kind: str) -> DataFrame:
    """Record keys: blog from the host of the URL; pages without a key are
    left to :func:`profile_dead_letters`."""
    lookup = sites.select(F.col("host").alias("_h"), F.col("blog_id").alias("_blog"))
    out = df.join(lookup, U.netloc(F.col("url")) == lookup._h, "left")
    return out.where(F.col("_blog").isNotNull() & F.col(id_col).isNotNull()).select(
        F.lit(kind).alias("_type"), F.concat("_blog", F.lit("/"), F.col(id_col)).alias("_id"),
        F.col("_blog").alias("blog_id"), *df.columns)


def profile_dead_letters(raw: DataFrame, sites: DataFrame) -> DataFrame:
    """The pages that give neither a user nor a company, with the reason."""
    url = F.coalesce("canonical", "url")
    own_id = F.when(F.col("kind") == "user", U.user_id(url)).otherwise(U.company_id(url))
    known = sites.select(F.col("host").alias("_h"))
    error = (F.when(F.col("kind").isNull(), F.lit("no profile header")).when(F.col("_h").isNull(), F.lit("unknown host"))
             .when(F.col("_own").isNull(), F.lit("no id in the URL")))
    rows = raw.select("page_id", url.alias("url"), "kind", own_id.alias("_own"))
    return (rows.join(known, U.netloc(F.col("url")) == known._h, "left").select("page_id", "url", error.alias("error"))
            .where(F.col("error").isNotNull()))
