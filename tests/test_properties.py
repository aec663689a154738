"""Property tests: native column functions against plain-Python semantics."""

from urllib.parse import urljoin, urlsplit

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blogweave.functions import text as X
from blogweave.functions import urls as U

# No empty segments: with '//' inside a path Python 3's urljoin squeezes the
# slashes, RFC 3986 (and the Python 2 urljoin of the original) keeps them.
SEG = st.sampled_from(["a", "b", "post", "123", "45", "hub", "users", "company", "x-y", ".", "..", "é"])
PATH = st.lists(SEG, min_size=0, max_size=6).map(lambda xs: "/".join(xs))
BASE = st.builds(lambda host, p, q: f"http://{host}/{p}" + (f"?{q}" if q else ""),
                 st.sampled_from(["a.ru", "h.example.org", "m.x.com:8080"]), PATH,
                 st.sampled_from(["", "k=1", "p=2&r=x"]))
REF = st.one_of(PATH, PATH.map(lambda p: "/" + p), st.sampled_from(["", "?z=1", "#f", "//o.net/p"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(BASE, REF), min_size=1, max_size=40))
def test_join_url_matches_urljoin(spark, pairs):
    df = spark.createDataFrame(pairs, "b string, r string")
    got = [r[0] for r in df.select(U.join_url("b", "r")).collect()]
    assert got == [urljoin(b, r) for b, r in pairs]


def _py_post_id(url):
    """The last all-digit path piece with a piece or the host before it and a slash after it, by walking the pieces."""
    pieces = url.split("/")
    for k in range(len(pieces) - 2, 0, -1):
        if pieces[k].isascii() and pieces[k].isdigit():
            return int(pieces[k])
    return None


def _py_hub_term(url):
    parts = [p for p in urlsplit(url).path.split("/") if p]
    return "_".join(parts[-2:]) if len(parts) >= 2 else None


@settings(max_examples=25, deadline=None)
@given(st.lists(BASE, min_size=1, max_size=40))
def test_ids_match_python_regex(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select(U.post_id("u"), U.hub_term("u"), U.netloc("u")).collect()
    assert [r[0] for r in got] == [_py_post_id(u) for u in urls]
    assert [r[1] for r in got] == [_py_hub_term(u) for u in urls]
    assert [r[2] for r in got] == [urlsplit(u).netloc for u in urls]


WORDS = st.text(alphabet=st.sampled_from(list("abcЁёжZ9_ .,/*«»:|\t\n'")), min_size=0, max_size=60)


TO_SPACE = str.maketrans({c: " " for c in "«»“”’*…/_.\\"})


def _py_tokens(text):
    """Runs of letters, digits and underscores, by walking the characters."""
    out = [""]
    for c in text.translate(TO_SPACE):
        if c.isalnum() or c == "_":
            out[-1] += c
        elif out[-1]:
            out.append("")
    return [t.lower().translate({0x451: 0x435}) for t in out if len(t) >= 3]


@settings(max_examples=25, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=20))
def test_tokens_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    toks = F.filter(X.tokens(X.space_out(F.col("t"))), lambda w: F.length(w) >= X.MIN_TOKEN_LENGTH)
    got = [r[0] for r in df.orderBy("i").select(F.transform(toks, X.normalise_token)).collect()]
    assert got == [_py_tokens(t) for t in texts]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(WORDS, st.integers(min_value=1, max_value=10**6)), min_size=1, max_size=20))
def test_bag_items_match_python(spark, items):
    df = spark.createDataFrame(items, "w string, n long")
    got = [r[0] for r in df.select(X.bag_item("w", "n")).collect()]
    assert got == ["".join("_" if c in " :|\t" else c for c in w) + (f":{n}" if n > 1 else "") for w, n in items]


def test_bag_item_literals(spark):
    df = spark.createDataFrame([("plain", 1), ("two words", 1), ("a:b|c", 3), ("tab\there", 2), ("", 1)], "w string, n long")
    assert [r[0] for r in df.select(X.bag_item("w", "n")).collect()] == ["plain", "two_words", "a_b_c:3", "tab_here:2", ""]


TS = st.datetimes(min_value=__import__("datetime").datetime(2000, 1, 1),
                  max_value=__import__("datetime").datetime(2030, 12, 31))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(TS, st.integers(min_value=0, max_value=400)), min_size=1, max_size=40))
def test_site_dates_round_trip(spark, items):
    import datetime as dt
    from blogweave.functions import fields as FD
    rows = [(ts, ts + dt.timedelta(hours=h)) for ts, h in items]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, f timestamp_ntz")
    text = FD.render_site_datetime(F.col("ts"), F.col("f"))
    got = [r[0] for r in df.select(FD.parse_site_datetime(text, F.col("f"))).collect()]
    assert got == [ts.replace(second=0, microsecond=0) for ts, _ in rows]


FOREST = st.lists(st.lists(st.integers(min_value=0, max_value=50), min_size=0, max_size=25), min_size=1, max_size=6)


@settings(max_examples=4, deadline=None)
@given(FOREST)
def test_nest_flatten_matches_python_preorder(spark, forest):
    from blogweave.operators import tree
    rows, expected, cid = [], set(), 0
    for post, picks in enumerate(forest):
        ids = []
        for k, pick in enumerate(picks):        # node k's parent: an earlier node, or a root
            parent = ids[pick % len(ids)] if ids and pick % 3 else None
            rows.append((post, cid, parent, pick % 4 == 0, None, f"u{pick}", f"#{cid}", pick, "m"))
            ids.append(cid)
            cid += 1
        children = {}
        for r in rows:
            if r[0] == post:
                children.setdefault(r[2], []).append(r[1])
        stack = [(c, [i]) for i, c in reversed(list(enumerate(sorted(children.get(None, [])))))]
        while stack:
            node, path = stack.pop()
            expected.add((post, ".".join(map(str, path)), f"#{node}"))
            for i, ch in reversed(list(enumerate(sorted(children.get(node, []))))):
                stack.append((ch, path + [i]))
    schema = ("post_id long, comment_id long, parent_id long, banned boolean, time timestamp_ntz, "
              "username string, link string, votes int, message_html string")
    df = spark.createDataFrame(rows, schema)
    flat = tree.flatten_comments(tree.nest_comments(df, depth=3), depth=3)
    got = {(r.post_id, ".".join(map(str, r.path)), r.link) for r in flat.collect()}
    assert got == expected
