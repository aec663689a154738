"""DuckDB SQL for every job that SQL can express.

The adapter views are written once as CTE text, mirroring
:mod:`blogweave.fixtures.views`; every job's SQL starts from them.
"""

from __future__ import annotations

V_POSTS = """
v_posts AS (
  SELECT
    'b' || CAST(doc_id % 3 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) AS _id,
    'b' || CAST(doc_id % 3 AS VARCHAR) AS blog_id,
    doc_id AS post_id,
    'https://b' || CAST(doc_id % 3 AS VARCHAR) || '.example.org/post/' || CAST(doc_id AS VARCHAR) || '/' AS url,
    source || ' #' || CAST(doc_id AS VARCHAR) AS title,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS BIGINT)) AS published,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id AS BIGINT))
      + to_minutes(CAST(n_chars % 1000 AS BIGINT)) AS updated_at,
    [x FOR x IN [CASE WHEN n_chars % 4 = 0 THEN 'tutorial' END,
                 CASE WHEN n_chars % 6 = 0 THEN 'translation' END] IF x IS NOT NULL] AS flags,
    [{'name': lang, 'url': 'https://b' || CAST(doc_id % 3 AS VARCHAR) || '.example.org/hub/' || lang || '/'},
     {'name': source, 'url': 'https://b' || CAST(doc_id % 3 AS VARCHAR) || '.example.org/company/' || source || '/'}] AS hubs,
    source AS company_blog,
    '<p class="lead">' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p><!-- cut ' || lang
      || ' --><script>if (a<b && c) {}</script><br>' AS content_html,
    [lang, source] AS tags,
    CAST(n_chars AS INTEGER) AS pageviews,
    CAST(CASE WHEN doc_id % 5 <> 0 THEN n_chars % 100 END AS INTEGER) AS favs_count,
    CAST(n_chars % 21 - 10 AS INTEGER) AS voting_score,
    CASE WHEN doc_id % 17 <> 0 THEN 'u' || CAST(doc_id % 150 AS VARCHAR) END AS author,
    'https://b' || CAST(doc_id % 3 AS VARCHAR) || '.example.org/users/'
      || (CASE WHEN doc_id % 17 <> 0 THEN 'u' || CAST(doc_id % 150 AS VARCHAR) END) || '/' AS author_url,
    CAST(n_chars % 500 AS DOUBLE) / 10 AS author_rating,
    CAST(NULL AS VARCHAR) AS author_company,
    CASE WHEN doc_id % 17 <> 0 THEN 'u' || CAST(doc_id % 150 AS VARCHAR) END AS author_user,
    CAST(CASE WHEN doc_id % 11 <> 0 THEN n_chars % 50 END AS INTEGER) AS comments_count
  FROM documents
)"""

V_COMMENTS = """
v_comments AS (
  SELECT
    event_id // 10 AS post_id,
    event_id AS comment_id,
    CASE WHEN event_id % 10 <> 0 THEN (event_id // 10) * 10 + (event_id % 10 - 1) // 2 END AS parent_id,
    event_type = 'error' AS banned,
    CASE WHEN event_type NOT IN ('error', 'signup') THEN ts END AS time,
    CASE WHEN event_type <> 'error' AND event_id % 37 <> 0 THEN 'u' || CAST(user_id AS VARCHAR) END AS username,
    '#comment_' || CAST(event_id AS VARCHAR) AS link,
    CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS INTEGER) END AS votes,
    '<p>' || event_type || ' by u' || CAST(user_id AS VARCHAR) || '</p>' AS message_html
  FROM events
)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",".join(views) + "\n" + body


COMMENT_STATS_BODY = """
stats AS (
  SELECT post_id,
         CAST(count(*) FILTER (WHERE NOT banned AND time IS NOT NULL) AS BIGINT) AS comments_parsed,
         CAST(count(*) FILTER (WHERE banned) AS BIGINT) AS comments_banned,
         min(time) FILTER (WHERE NOT banned AND time IS NOT NULL) AS first_comment_time,
         max(time) FILTER (WHERE NOT banned AND time IS NOT NULL) AS last_comment_time
  FROM v_comments GROUP BY post_id
),
by_author AS (
  SELECT c.post_id, CAST(count(*) AS BIGINT) AS author_comments
  FROM v_comments c JOIN v_posts p ON c.post_id = p.post_id AND c.username = p.author
  WHERE NOT c.banned AND c.time IS NOT NULL
  GROUP BY c.post_id
),
comment_stats AS (
  SELECT s.*, CAST(coalesce(a.author_comments, 0) AS BIGINT) AS author_comments
  FROM stats s LEFT JOIN by_author a USING (post_id)
)"""

SQL: dict[str, str] = {}

SQL["J03_comment_stats"] = with_views(
    "SELECT * FROM comment_stats", V_POSTS, V_COMMENTS, COMMENT_STATS_BODY)

SQL["J02_post_summary"] = with_views("""
SELECT p.post_id, p.updated_at AS last_update, p.published, p.title, p.author,
       p.favs_count, p.pageviews, p.comments_count,
       CAST(coalesce(s.comments_parsed, 0) AS BIGINT) AS comments_parsed,
       CAST(coalesce(s.comments_banned, 0) AS BIGINT) AS comments_banned,
       s.first_comment_time, s.last_comment_time,
       CAST(coalesce(s.author_comments, 0) AS BIGINT) AS author_comments,
       CAST(len(p.tags) AS INTEGER) AS tags,
       CAST(length(p.content_html) AS INTEGER) AS content_length,
       CAST(len(p.hubs) AS INTEGER) AS hubs_count,
       array_to_string([h.name FOR h IN p.hubs], ',') AS hubs
FROM v_posts p LEFT JOIN comment_stats s USING (post_id)
ORDER BY p.post_id""", V_POSTS, V_COMMENTS, COMMENT_STATS_BODY)


# ------------------------------------------------------------ page jobs
RESTRICTED = "Доступ к странице ограничен"
SITE_LIST = [(f"b{k}.example.org", f"b{k}", f"https://b{k}.example.org/") for k in range(3)]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_group(col: str, pattern: str, idx: int = 1) -> str:
    return f"nullif(regexp_extract({col}, {q(pattern)}, {idx}), '')"


_N, _M = "CAST(page_id AS VARCHAR)", "CAST(page_id + 1 AS VARCHAR)"


def _with_n(text: str) -> str:
    """A literal with {n} and {m} filled in."""
    return q(text).replace("{n}", f"' || {_N} || '").replace("{m}", f"' || {_M} || '")


# The links of the site block: href as a reader sees it, class kind, anchor text.
BLOCK_LINKS = [
    ("/post/{n}/", "post", "one"), ("/aside/{n}/", "post", "aside"), ("page{m}/", "link", "next"), ("?page=2&x=1", "link", "more"),
    ("https://b1.example.org/company/co{n}/blog/{n}/", "post", "side"), ("/hub/h{n}/", "hub", "hub"),
    ("/users/author{n}/", "link", "author"), ("/users/user{n}/", "user", "user"), ("/users/user{n}/topics/", "link", "topics bold"),
    ("/users/user{n}/comments/", "link", "open"), ("/users/user{n}/favorites/", "link", "favourites"),
    ("https://b2.example.org/company/co{n}/profile/", "link", "profile"),
    ("https://b2.example.org/company/co{n}/fans/all/rating/", "link", "fans"), ("https://m.example.org/post/{n}/", "link", "mobile"),
    ("//other.test/post/{n}/", "link", "off site"), ("https://b1.example.org/post/{n}/", "link", "post"),
    ("https://b1.example.org/users/user{n}/", "link", "profile"),
]


def sql_join(href: str) -> str:
    """A reference against the page's URL (which has a path and may have a query or a fragment)."""
    no_fragment = "split_part(url, '#', 1)"
    no_query = f"split_part({no_fragment}, '?', 1)"
    origin = f"array_to_string(string_split({no_query}, '/')[1:3], '/')"
    folder = f"array_to_string(string_split({no_query}, '/')[1:-2], '/') || '/'"
    return f"""(CASE WHEN {href} LIKE 'http%' OR regexp_matches({href}, '^[a-z]+:') THEN {href}
      WHEN {href} LIKE '//%' THEN split_part(url, ':', 1) || ':' || {href}
      WHEN {href} LIKE '/%' THEN {origin} || {href}
      WHEN {href} LIKE '?%' THEN {no_query} || {href}
      WHEN {href} LIKE '#%' OR {href} = '' THEN {no_fragment} || {href}
      WHEN len(string_split({no_query}, '/')) < 4 THEN {no_query} || '/' || {href}
      ELSE {folder} || {href} END)"""


def _unescaped(c: str) -> str:
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = f"replace({c}, {q(entity)}, {q(sign)})"
    return c


# The driver's own anchors are lower case, double quoted and closed: a page is cut at "<a ".
_BLOCK_ROWS = " UNION ALL ".join(
    f"SELECT page_id, url, {i} AS spot, {_with_n(h)} AS href, {q(k)} AS kind, {q(t)} AS anchor_text FROM pages"
    for i, (h, k, t) in enumerate(BLOCK_LINKS))
SQL_LINKS = f"""
own AS (
  SELECT page_id, url, pos, {_unescaped("split_part(split_part(part, 'href=\"', 2), '\"', 1)")} AS href,
         regexp_replace(split_part(substr(part, strpos(part, '>') + 1), '</a', 1), '<[^>]*>', '', 'g') AS anchor_text
  FROM (SELECT page_id, url, unnest(parts) AS part, unnest(range(len(parts))) AS pos
        FROM (SELECT page_id, url, string_split(html, '<a ')[2:] AS parts FROM pages))
),
counts AS (SELECT p.page_id, count(o.page_id) AS n FROM pages p LEFT JOIN own o USING (page_id) GROUP BY p.page_id),
block AS ({_BLOCK_ROWS} UNION ALL SELECT page_id, url, {len(BLOCK_LINKS)}, url, 'link', 'self' FROM pages),
links AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos, kind, href, {sql_join("href")} AS abs_url, anchor_text
  FROM (SELECT page_id, url, pos, 'link' AS kind, href, anchor_text FROM own
        UNION ALL SELECT page_id, url, n + spot, kind, href, anchor_text FROM block JOIN counts USING (page_id))
)"""

SQL["J08_extract_links"] = with_views("SELECT * FROM links", SQL_LINKS)


def _placed(rows: list[tuple[str, int, str]], condition: str = "true") -> str:
    """Rows of every page, the first of them where the condition holds."""
    every = " UNION ALL ".join(f"SELECT page_id, url, {q(k)} AS kind, {i} AS pos, {_with_n(h)} AS href FROM pages WHERE {condition if j == 0 else 'true'}"
                               for j, (k, i, h) in enumerate(rows))
    return f"""SELECT page_id, kind, CAST(pos AS INTEGER) AS pos, href, {sql_join("href")} AS abs_url, CAST(0 AS INTEGER) AS priority
FROM ({every})"""


SQL["J26_feed_links"] = _placed([("post", 0, "/post/{n}/"), ("page", 0, "page{m}/"), ("page", 1, "?page=2&x=1")], "page_id % 6 <> 2")
SQL["J08_side_links"] = _placed([("post", 0, "https://b1.example.org/company/co{n}/blog/{n}/"), ("hub", 0, "/hub/h{n}/"),
                                 ("author", 0, "/users/author{n}/"), ("commenter", 0, "/users/user{n}/")])

_SITES_VALUES = ", ".join(f"({q(h)}, {q(b)})" for h, b, _ in SITE_LIST)

# Pages 0, 4, 2 and 6 of every eight have a canonical link in their head; a link in the body does not count.
_K = "CAST(page_id % 3 AS VARCHAR)"
SQL["J09_url_ids"] = f"""
WITH c AS (
  SELECT page_id, page_id % 8 AS e,
         CASE WHEN page_id % 8 = 0 THEN 'https://b' || {_K} || '.example.org/company/co' || {_N} || '/blog/' || {_N} || '/'
              WHEN page_id % 8 = 4 THEN 'https://b' || {_K} || '.example.org/hub/h' || {_N} || '/'
              WHEN page_id % 4 = 2 THEN 'https://b1.example.org/users/u' || {_N} || '/' ELSE url END AS canonical_url
  FROM pages
), ids AS (
  SELECT page_id, canonical_url, split_part(split_part(split_part(string_split(canonical_url, '/')[3], '?', 1), '#', 1), '/', 1) AS host,
         CASE WHEN e = 0 THEN 'co' || {_N} END AS company_id,
         CASE WHEN e = 0 THEN page_id WHEN e IN (4, 2, 6) THEN NULL
              ELSE TRY_CAST(list_last([x FOR x IN string_split(canonical_url, '/')[4:-2] IF regexp_full_match(x, '[0-9]+')]) AS BIGINT) END AS post_id,
         CASE WHEN e IN (2, 6) THEN 'u' || {_N} END AS user_id,
         CASE WHEN e = 4 THEN 'h' || {_N} END AS hub_id
  FROM c
), sites(host, blog_id) AS (VALUES {_SITES_VALUES})
SELECT ids.page_id, ids.canonical_url, ids.host, sites.blog_id, sites.blog_id IS NOT NULL AS host_known,
       ids.company_id, ids.post_id, ids.user_id, ids.hub_id
FROM ids LEFT JOIN sites ON ids.host = sites.host"""

# The block's own text, then the page's: markup is cut at "<" (script text and comments are text nodes).
_SITE_HTML = """
site AS (
  SELECT page_id, url, status, html || block AS html FROM (
    SELECT page_id, url,
      CASE WHEN page_id % 6 = 1 THEN replace(h, '</title>', ' Доступ к странице ограничен</title>')
           WHEN page_id % 6 = 3 THEN replace(h, 'title>', 'h6>') ELSE h END AS html,
      'body' || 'one' || 'aside' || 'next' || 'more' || 'side' || 'hub' || 'author' || 'user'
        || 'topics bold' || 'open' || 'favourites' || 'profile' || 'fans' || 'mobile' || 'off site' || 'post' || 'none' || 'profile' || 'self' AS block,
      CASE page_id % 10 WHEN 3 THEN 404 WHEN 7 THEN 500 ELSE 200 END AS status
    FROM (SELECT page_id, url, html AS h FROM pages)))"""


def _cut(c: str) -> str:
    """The text nodes of markup without scripts."""
    return f"""(string_split({c}, '<')[1] || array_to_string([
      CASE WHEN starts_with(x, '!--') THEN split_part(substr(x, 4), '-->', 1) || array_to_string(string_split(x, '-->')[2:], '-->')
           WHEN starts_with(x, '!') THEN substr(split_part(x, '>', 1), 2) || substr(x, strpos(x, '>') + 1)
           ELSE substr(x, strpos(x, '>') + 1) END FOR x IN string_split({c}, '<')[2:]], ''))"""


SQL["J15_visible_text"] = "WITH" + _SITE_HTML + f"""
SELECT page_id, t AS text, CAST(length(t) AS INTEGER) AS n_chars
FROM (SELECT page_id, {_cut("string_split(html, '<script')[1]")} || array_to_string([
        split_part(substr(s, strpos(s, '>') + 1), '</script>', 1) || {_cut("string_split(s, '</script>')[2]")}
        FOR s IN string_split(html, '<script')[2:]], '') AS t FROM site)"""

_TITLE = "CASE WHEN strpos(html, '<title>') > 0 THEN split_part(split_part(html, '<title>', 2), '</title>', 1) END"
SQL["J16_usable_pages"] = "WITH" + _SITE_HTML + f"""
SELECT page_id, url, {_TITLE} AS title FROM site WHERE page_id % 6 NOT IN (1, 2)"""

SQL_OUTCOMES = """
outcomes AS (
  SELECT page_id, CASE WHEN page_id % 10 = 3 THEN '404' WHEN page_id % 10 = 7 THEN NULL
                       WHEN page_id % 6 = 1 THEN 'forbidden' WHEN page_id % 6 = 2 THEN 'exception' ELSE 'stored' END AS outcome,
         CASE WHEN page_id % 10 NOT IN (3, 7) AND page_id % 6 = 2 THEN 'no container element' END AS error
  FROM pages
)"""

SQL["J17_extraction_outcomes"] = with_views("SELECT * FROM outcomes", SQL_OUTCOMES)

SQL["J18_pending_pages"] = with_views("""
SELECT CAST(r.page_id AS BIGINT) AS page_id
FROM (SELECT unnest(range(0, (SELECT 2 * (max(page_id) + 1) FROM pages))) AS page_id) r
WHERE NOT EXISTS (SELECT 1 FROM outcomes o
                  WHERE o.page_id = r.page_id AND o.outcome IN ('stored', '404', 'forbidden'))""",
                                      SQL_OUTCOMES)

SQL["J05_post_dead_letters"] = """
SELECT page_id, CASE WHEN page_id % 8 = 0 THEN 'https://b' || CAST(page_id % 3 AS VARCHAR) || '.example.org/company/co' || CAST(page_id AS VARCHAR) || '/blog/' || CAST(page_id AS VARCHAR) || '/'
                     WHEN page_id % 8 = 4 THEN 'https://b' || CAST(page_id % 3 AS VARCHAR) || '.example.org/hub/h' || CAST(page_id AS VARCHAR) || '/'
                     WHEN page_id % 4 = 2 THEN 'https://b1.example.org/users/u' || CAST(page_id AS VARCHAR) || '/' ELSE url END AS url,
       CASE WHEN page_id % 6 = 2 THEN 'no post container' ELSE 'unknown host' END AS error
FROM pages WHERE page_id % 6 = 2 OR page_id % 2 = 1"""

_ORIGINS = [b.rstrip("/") for _, _, b in SITE_LIST]
_FEED_ROWS = ", ".join(f"({q(o + p)}, 'feed')" for o in _ORIGINS for p in ("/interesting/", "/all/", "/top/"))

SQL["J19_frontier_seeds"] = with_views(f"""
SELECT o.origin || '/post/' || CAST(r.post_id AS VARCHAR) AS url, 'post' AS kind, r.post_id
FROM (SELECT unnest(range((SELECT min(post_id) FROM v_posts), (SELECT max(post_id) FROM v_posts) + 1)) AS post_id) r,
     (SELECT unnest([{', '.join(q(o) for o in _ORIGINS)}]) AS origin) o
UNION ALL
SELECT url, kind, CAST(NULL AS BIGINT) AS post_id
FROM (VALUES {_FEED_ROWS}, ('https://feed.example.org/', 'root')) AS f(url, kind)""", V_POSTS)


SQL["J19_explicit_seeds"] = f"""
SELECT {q(_ORIGINS[0])} || '/post/' || CAST(doc_id AS VARCHAR) || '/' AS url, 'post' AS kind, doc_id AS post_id FROM documents"""

# Hosts: everything between "//" and the next "/", "?" or "#", without a port.
_ROUTED = """
hosts AS (
  SELECT page_id, pos, abs_url,
         lower(split_part(split_part(split_part(split_part(string_split(abs_url, '/')[3], '?', 1), '#', 1), '/', 1), ':', 1)) AS host
  FROM links
),
routed AS (
  SELECT page_id, pos, abs_url, host, starts_with(host, 'm.') AS denied,
         CASE WHEN starts_with(host, 'm.') THEN 'follow'
              WHEN regexp_matches(abs_url, '/post/[0-9]+/$') THEN 'post'
              WHEN regexp_matches(abs_url, '/users/[0-9A-Za-z_]+/topics/') THEN 'user_topics'
              WHEN regexp_matches(abs_url, '/users/[0-9A-Za-z_]+/comments/') THEN 'user_comments'
              WHEN regexp_matches(abs_url, '/users/[0-9A-Za-z_]+/favorites/') THEN 'user_favorites'
              WHEN regexp_matches(abs_url, '/users/[0-9A-Za-z_]+/$') THEN 'user_profile'
              WHEN regexp_matches(abs_url, '/company/[0-9A-Za-z_]+/blog/[0-9]+/$') THEN 'post'
              WHEN regexp_matches(abs_url, '/company/[0-9A-Za-z_]+/profile/$') THEN 'company_profile'
              WHEN regexp_matches(abs_url, '/company/[0-9A-Za-z_]+/fans/all/rating/') THEN 'company_fans'
              ELSE 'follow' END AS route,
         host IN ('example.com', 'example.org') OR ends_with(host, '.example.com') OR ends_with(host, '.example.org') AS on_site
  FROM hosts
)"""
SQL["J20_route_links"] = with_views("SELECT * FROM routed", SQL_LINKS, _ROUTED)
SQL["J21_new_links"] = with_views("""
SELECT DISTINCT abs_url AS url, route FROM routed r
WHERE on_site AND NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = r.abs_url)""", SQL_LINKS, _ROUTED)


# --------------------------------------------------------------- corpus
_MODALITIES = ("words", "author", "users", "tags", "hubs")
SQL_PAIRS = """
pairs AS (
  SELECT DISTINCT post_id, u AS username FROM (
    SELECT post_id, regexp_replace(author_user, '^/+|/+$', '', 'g') AS u FROM v_posts
    UNION ALL
    SELECT post_id, username AS u FROM v_comments WHERE NOT banned) t
  WHERE u IS NOT NULL
),
per_post AS (
  SELECT post_id, list_sort(list(username)) AS users FROM pairs GROUP BY post_id
)"""

SQL["J04_post_participants"] = with_views("""
SELECT p.post_id, p.blog_id, coalesce(array_to_string(pp.users, ' '), '') AS participants,
       CAST(coalesce(len(pp.users), 0) AS INTEGER) AS n_participants
FROM v_posts p LEFT JOIN per_post pp USING (post_id)""", V_POSTS, V_COMMENTS, SQL_PAIRS)

# A post's text nodes by construction: its text (entities as written), the comment's and the script's text.
_SPACES = "«»“”’*…/_.\\"
_TEXT = ("replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || ' cut ' || lang || ' ' || 'if (a<b && c) {}'")
SQL_WORDS = f"""
tokens AS (
  SELECT post_id, translate(lower(tok), 'ё', 'е') AS lemma FROM (
    SELECT doc_id AS post_id, unnest(regexp_extract_all(translate({_TEXT}, {q(_SPACES)}, {q(' ' * len(_SPACES))}), '[\\p{{L}}\\p{{N}}_]+')) AS tok
    FROM documents) t
  WHERE length(tok) > 2
),
words AS (SELECT post_id, lemma, CAST(count(*) AS BIGINT) AS n FROM tokens GROUP BY post_id, lemma)"""

SQL["J11_word_counts"] = with_views("SELECT * FROM words", V_POSTS, SQL_WORDS)

SQL["J11_lemma_counts"] = with_views("""
SELECT post_id, lemma, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT post_id, CASE WHEN length(lemma) < 4 THEN lemma WHEN ends_with(lemma, 'x') THEN '' ELSE lemma[:-2] END AS lemma FROM tokens)
WHERE lemma <> '' GROUP BY post_id, lemma""", SQL_WORDS)

_HUB_PATH = "'/' || array_to_string(string_split(h.url, '/')[4:], '/')"
SQL_TAG_HUB = f"""
tag_hub AS (
  SELECT DISTINCT post_id, kind, term FROM (
    SELECT post_id, 'tag' AS kind, unnest(tags) AS term FROM v_posts
    UNION ALL
    SELECT post_id, 'hub' AS kind,
           CASE WHEN len(parts) >= 2 THEN array_to_string(parts[-2:], '_') END AS term
    FROM (SELECT post_id, [s FOR s IN string_split({_HUB_PATH}, '/') IF s <> ''] AS parts
          FROM (SELECT post_id, unnest(hubs) AS h FROM v_posts) x) y) z
  WHERE term IS NOT NULL
)"""

SQL["J12_tag_hub_terms"] = with_views("SELECT * FROM tag_hub", V_POSTS, SQL_TAG_HUB)

SQL_USERS = """
users AS (
  SELECT post_id, username, CAST(count(*) AS BIGINT) AS n FROM v_comments
  WHERE NOT banned AND username IS NOT NULL GROUP BY post_id, username
)"""

SQL["J13_user_counts"] = with_views("SELECT * FROM users", V_COMMENTS, SQL_USERS)

SQL_TERMS = """
terms AS (
  SELECT post_id, 'words' AS modality, lemma AS term, n FROM words
  UNION ALL SELECT post_id, 'author', author, CAST(1 AS BIGINT) FROM v_posts WHERE author IS NOT NULL
  UNION ALL SELECT post_id, 'users', username, n FROM users
  UNION ALL SELECT post_id, CASE WHEN kind = 'tag' THEN 'tags' ELSE 'hubs' END, term, CAST(1 AS BIGINT) FROM tag_hub
)"""

SQL["J25_modality_terms"] = with_views("SELECT * FROM terms", V_POSTS, V_COMMENTS, SQL_WORDS,
                                       SQL_TAG_HUB, SQL_USERS, SQL_TERMS)

_ITEM = (f"translate(term, ' :|' || chr(9), '____') || "
         "CASE WHEN n = 1 THEN '' ELSE ':' || CAST(n AS VARCHAR) END")
_BAGS = ", ".join(f"max(CASE WHEN modality = '{m}' THEN bag END) AS {m}" for m in _MODALITIES)
_LINE_PARTS = ", ".join(f"'|{m}', nullif(b.{m}, '')" for m in _MODALITIES)
SQL["J14_corpus_lines"] = with_views(f"""
SELECT p.post_id, concat_ws(' ', '''' || CAST(p.post_id AS VARCHAR), {_LINE_PARTS}) AS line
FROM v_posts p LEFT JOIN (
  SELECT post_id, {_BAGS} FROM (
    SELECT post_id, modality, array_to_string(list_sort(list({_ITEM})), ' ') AS bag
    FROM terms GROUP BY post_id, modality) t
  GROUP BY post_id) b USING (post_id)""", V_POSTS, V_COMMENTS, SQL_WORDS, SQL_TAG_HUB, SQL_USERS, SQL_TERMS)

_SITE_BASES = ", ".join(f"({q(b)}, {q(base.rstrip('/'))})" for _, b, base in SITE_LIST)
SQL_ACTIVITY = f"""
activity AS (
  SELECT c.username, c.blog_id, c.count, s.origin FROM (
    SELECT pp.username, p.blog_id, CAST(count(*) AS BIGINT) AS count
    FROM pairs pp JOIN v_posts p USING (post_id) GROUP BY pp.username, p.blog_id) c
  JOIN (VALUES {_SITE_BASES}) AS s(blog_id, origin) ON c.blog_id = s.blog_id
)"""

SQL["J22_participant_activity"] = with_views("""
SELECT username, blog_id, count, origin || '/users/' || username || '/favorites/' AS url, 1 AS priority FROM activity
UNION ALL
SELECT username, blog_id, count, origin || '/users/' || username || '/' AS url, 0 AS priority FROM activity
ORDER BY count DESC, blog_id, username, priority DESC""", V_POSTS, V_COMMENTS, SQL_PAIRS, SQL_ACTIVITY)

SQL["J22_stored_ranking"] = SQL["J22_participant_activity"]

SQL["J22_participant_total"] = with_views("""
SELECT CAST(count(*) AS BIGINT) AS total FROM (
  SELECT DISTINCT pp.username, p.blog_id FROM pairs pp JOIN v_posts p USING (post_id)) t""",
                                          V_POSTS, V_COMMENTS, SQL_PAIRS)


SQL["J10_normalise_fields"] = """
SELECT event_id, date_trunc('minute', ts) AS time,
       CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS INTEGER) - 50 AS votes,
       value,
       CASE WHEN event_id % 2 = 0 THEN value ELSE -value END AS karma
FROM events"""


V_DEEP = """
v_deep AS (
  SELECT * REPLACE (comment_id // 100 AS post_id,
    CASE WHEN comment_id % 100 BETWEEN 1 AND 30 THEN comment_id - 1
         WHEN comment_id % 100 BETWEEN 31 AND 60 THEN comment_id // 100 * 100
         WHEN comment_id % 100 BETWEEN 61 AND 90 THEN comment_id // 100 * 100 + (comment_id % 100 - 1) // 3
         WHEN comment_id % 100 = 91 THEN comment_id + 1 WHEN comment_id % 100 IN (92, 94) THEN comment_id - 1
         WHEN comment_id % 100 = 93 THEN -1 - comment_id END AS parent_id)
  FROM v_comments
)"""

SQL_TREE = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY post_id, parent_id ORDER BY comment_id) - 1 AS sib
  FROM v_deep
),
walk(post_id, comment_id, path, depth) AS (
  SELECT post_id, comment_id, CAST(sib AS VARCHAR), 0 FROM ranked WHERE parent_id IS NULL
  UNION ALL
  SELECT r.post_id, r.comment_id, w.path || '.' || CAST(r.sib AS VARCHAR), w.depth + 1
  FROM ranked r JOIN walk w ON r.parent_id = w.comment_id
)"""

SQL["J24_comment_tree"] = "WITH RECURSIVE " + ",".join([V_COMMENTS, V_DEEP, SQL_TREE]) + """
SELECT w.post_id, w.path, CAST(w.depth AS INTEGER) AS depth, r.banned,
       r.time, r.username, r.link, r.votes, r.message_html
FROM walk w JOIN ranked r USING (comment_id)"""

SQL["J24_tree_dead_letters"] = with_views("""
SELECT post_id, comment_id, parent_id,
       CASE WHEN comment_id % 100 = 93 THEN 'missing parent' ELSE 'unreachable' END AS error
FROM v_deep WHERE comment_id % 100 IN (93, 94) OR (comment_id % 100 IN (91, 92) AND comment_id // 100 * 100 + 92 IN (SELECT comment_id FROM v_deep))""",
                                          V_COMMENTS, V_DEEP)


SQL_NCOMMENTS = SQL_TREE + """,
ncom AS (SELECT post_id, CAST(count(*) AS BIGINT) AS n_comments, string_agg(path, ' ' ORDER BY path) AS comment_paths FROM walk GROUP BY post_id)"""

SQL["J01_posts_scan"] = "WITH RECURSIVE " + ",".join([V_POSTS, V_COMMENTS, V_DEEP, SQL_NCOMMENTS]) + """
SELECT p.post_id,
       CASE WHEN p.post_id % 3 = 2 THEN p.blog_id END AS blog_id,
       CASE p.post_id % 3 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' ELSE 'v3' END AS shape,
       p.title, p.published, p.updated_at,
       CASE WHEN p.post_id % 3 = 1 THEN coalesce(p.favs_count, 0) ELSE p.favs_count END AS favs_count,
       p.pageviews, p.comments_count, p.author,
       array_to_string([h.name FOR h IN p.hubs IF h.url LIKE '%/hub/%'], ',') AS hub_ids,
       array_to_string(p.tags, ',') AS tags,
       coalesce(c.n_comments, 0) AS n_comments, c.comment_paths
FROM v_posts p LEFT JOIN ncom c USING (post_id)"""

SQL["J29_export_posts"] = "WITH RECURSIVE " + ",".join([V_POSTS, V_COMMENTS, V_DEEP, SQL_NCOMMENTS]) + """
SELECT p.post_id, p._id, p.blog_id, p.url, p.title, p.published, p.updated_at,
       array_to_string(p.flags, ',') AS flags,
       array_to_string([h.name FOR h IN p.hubs IF h.url LIKE '%/hub/%'], ',') AS hub_ids,
       p.company_blog, p.favs_count, p.voting_score, p.author, p.comments_count,
       CAST(length(p.content_html) AS INTEGER) AS content_length,
       coalesce(c.n_comments, 0) AS n_comments, c.comment_paths
FROM v_posts p LEFT JOIN ncom c USING (post_id)"""

SQL["J01_corrupt_documents"] = """
SELECT '{"post_id": ' || CAST(doc_id AS VARCHAR) || ', "title' AS line FROM documents"""

SQL["J30_export_summary"] = SQL["J02_post_summary"]
SQL["J31_export_corpus"] = SQL["J14_corpus_lines"]


SQL["J27_upsert_latest"] = """
SELECT _type, _id, updated_at, seq, conv_id, turn, text FROM (
  SELECT role AS _type, CAST(conv_id AS VARCHAR) AS _id,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id) + to_minutes(turn) AS updated_at,
         turn AS seq, conv_id, turn, text,
         row_number() OVER (PARTITION BY role, conv_id ORDER BY turn DESC) AS rn
  FROM conversations) t
WHERE rn = 1"""
SQL["J28_upsert_stream"] = SQL["J27_upsert_latest"]


# ------------------------------------------------------- extraction jobs
def sql_esc(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


SQL["J05_extract_posts"] = with_views("""
SELECT post_id, blog_id, url, title, published,
       array_to_string(flags, ',') AS flags,
       array_to_string([h.name FOR h IN hubs IF h.url LIKE '%/hub/%'], ',') AS hub_ids,
       company_blog,
       content_html,
       array_to_string(tags, ',') AS tags, pageviews, favs_count, voting_score,
       author AS author_user, CAST(NULL AS VARCHAR) AS author_company, comments_count
FROM v_posts""", V_POSTS)

SQL["J06_extract_comments"] = "WITH RECURSIVE " + ",".join([V_COMMENTS, V_DEEP, SQL_TREE]) + """
SELECT w.post_id, w.path, CAST(w.depth AS INTEGER) AS depth, r.banned,
       CASE WHEN NOT r.banned THEN date_trunc('minute', r.time) END AS time,
       CASE WHEN NOT r.banned THEN r.username END AS username,
       CASE WHEN NOT r.banned THEN r.link END AS link,
       CASE WHEN NOT r.banned THEN r.votes END AS votes,
       CASE WHEN NOT r.banned THEN r.message_html END AS message_html
FROM walk w JOIN ranked r USING (comment_id)"""

_ORIGIN = "'https://b' || CAST(c_custkey % 3 AS VARCHAR) || '.example.org'"
_FETCHED = ("TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey + 30 AS INTEGER)) "
            "+ to_hours(CAST(c_custkey % 48 AS INTEGER))")
SQL["J07_user_profiles"] = f"""
SELECT 'user' AS _type, 'b' || CAST(c_custkey % 3 AS VARCHAR) || '/c' || CAST(c_custkey AS VARCHAR) AS _id,
       'b' || CAST(c_custkey % 3 AS VARCHAR) AS blog_id, c_custkey AS page_id,
       'c' || CAST(c_custkey AS VARCHAR) AS user_id, 'c' || CAST(c_custkey AS VARCHAR) AS username,
       trim(c_name) AS fullname,
       {_ORIGIN} || '/images/avatars/c' || CAST(c_custkey AS VARCHAR) || '.png' AS avatar_url,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey AS INTEGER)) AS registration_date,
       {_FETCHED} - to_days(CAST(c_custkey % 3 AS INTEGER)) AS last_activity,
       c_acctbal AS karma, CAST(c_nationkey AS DOUBLE) AS rating,
       '<p>' || {sql_esc('c_name')} || ' from nation ' || CAST(c_nationkey AS VARCHAR) || '</p>' AS about_html,
       'https://c' || CAST(c_custkey AS VARCHAR) || '.example.com/' AS website_url,
       's' || CAST(c_custkey % 10 AS VARCHAR) AS working_companies,
       '' AS favorite_companies,
       'n' || CAST(c_nationkey AS VARCHAR) || ',' || lower(c_mktsegment) AS hubs,
       c_mktsegment AS tags,
       'c' || CAST(c_custkey + 1 AS VARCHAR) AS invites,
       'Сегмент=<b>' || {sql_esc('c_mktsegment')} || '</b>' AS info
FROM customer"""

SQL["J07_company_profiles"] = f"""
SELECT 'company' AS _type, 'b' || CAST(s_suppkey % 3 AS VARCHAR) || '/s' || CAST(s_suppkey AS VARCHAR) AS _id,
       'b' || CAST(s_suppkey % 3 AS VARCHAR) AS blog_id, s_suppkey AS page_id,
       's' || CAST(s_suppkey AS VARCHAR) AS company_id, s_name AS name,
       'https://b' || CAST(s_suppkey % 3 AS VARCHAR) || '.example.org/images/companies/s'
         || CAST(s_suppkey AS VARCHAR) || '.png' AS icon_url,
       '<p>' || {sql_esc('s_name')} || ' of nation ' || CAST(s_nationkey AS VARCHAR) || '</p>' AS about_html,
       'https://s' || CAST(s_suppkey AS VARCHAR) || '.example.net/' AS website_url,
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey AS INTEGER)) AS registration_date,
       'c' || CAST(s_suppkey AS VARCHAR) || ',c' || CAST(s_suppkey + 1 AS VARCHAR) AS staff_users,
       'Страна=n' || CAST(s_nationkey AS VARCHAR) AS info
FROM supplier"""

SQL["J23_favourite_edges"] = with_views("""
SELECT DISTINCT c.username AS user, p.blog_id || '/' || CAST(p.post_id AS VARCHAR) AS post_key
FROM v_comments c JOIN v_posts p USING (post_id)
WHERE NOT c.banned AND c.username IS NOT NULL""", V_POSTS, V_COMMENTS)

SQL["J23_favourite_pages"] = with_views("""
SELECT DISTINCT 'https://b0.example.org/users/' || username || '/favorites/page' || CAST(post_id // 10 AS VARCHAR) || '/' AS url,
       'https://b0.example.org/users/' || username || '/favorites/page' || CAST(post_id // 10 AS VARCHAR) || '/page' || CAST(post_id // 10 + 1 AS VARCHAR) || '/' AS next_url,
       CAST(2 AS INTEGER) AS priority
FROM v_comments c JOIN v_posts p USING (post_id) WHERE NOT banned AND username IS NOT NULL""", V_POSTS, V_COMMENTS)

SQL["J05_extraction_errors"] = """
SELECT doc_id AS page_id,
       CASE WHEN doc_id % 8 IN (0, 4, 5) THEN 'b' || CAST(doc_id % 3 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) END AS _id,
       CASE doc_id % 8 WHEN 1 THEN 'no post id' WHEN 2 THEN 'bad post id' WHEN 3 THEN 'unknown host' WHEN 6 THEN 'bad post id'
                       WHEN 7 THEN 'no post container' END AS error
FROM documents"""

SQL["J06_page_participants"] = with_views("""
SELECT p.post_id, coalesce(array_to_string(pp.users, ' '), '') AS participants
FROM v_posts p LEFT JOIN per_post pp USING (post_id)""", V_POSTS, V_COMMENTS, SQL_PAIRS)

SQL["J07_profile_dead_letters"] = """
SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 1 THEN 'no profile header' WHEN 2 THEN 'unknown host' ELSE 'no id in the URL' END AS error
FROM customer WHERE c_custkey % 4 <> 0"""

SQL["J21_link_identities"] = """
SELECT 'https://b1.example.org/~u' || page_id || '/p%D0%BE/?a=1&b=' || page_id AS identity,
       'HTTPS://B1.Example.ORG:443/~%75' || page_id || '/p%D0%BE/?b=' || page_id || '&a=1' AS url, CAST(4 AS BIGINT) AS n_links
FROM pages WHERE page_id % 3 <> 0
UNION ALL
SELECT 'https://b1.example.org/~u' || page_id || '/p%D0%BE/?a=1&a=1&b=' || page_id,
       'https://b1.example.org/~u' || page_id || '/p%D0%BE/?a=1&a=1&b=' || page_id, CAST(1 AS BIGINT)
FROM pages"""

SQL["J21_reachable_pages"] = """
WITH RECURSIVE p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM pages),
edges AS (
  SELECT a.page_id AS src, b.page_id AS dst
  FROM (SELECT page_id, unnest([2 * page_id + 1, 3 * page_id + 7, page_id // 2, 0]) AS aim FROM p WHERE page_id % 5 <> 4) a JOIN p b ON b.page_id = a.aim),
steps AS (
  SELECT page_id, 0 AS depth FROM p WHERE page_id % 40 = 3
  UNION
  SELECT e.dst, s.depth + 1 FROM steps s JOIN edges e ON e.src = s.page_id WHERE s.depth < 60),
nearest AS (SELECT page_id, min(depth) AS depth FROM steps GROUP BY page_id)
SELECT p.url, CAST(n.depth AS INTEGER) AS depth, min(q.url) AS referrer
FROM nearest n JOIN p USING (page_id)
LEFT JOIN (SELECT e.dst, m.depth, r.url FROM edges e JOIN nearest m ON m.page_id = e.src JOIN p r ON r.page_id = e.src) q
  ON q.dst = n.page_id AND q.depth = n.depth - 1
GROUP BY p.url, n.depth"""
