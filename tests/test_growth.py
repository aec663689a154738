"""What a job does for a page or a text grows with what is asked for, and is dealt out evenly."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from blogweave.functions import html as H
from blogweave.functions import markup as M
from blogweave.functions import text as X
from blogweave.operators import corpus, extract
from blogweave.plans import jobs
from conftest import SF001


def plan(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_tags_without_attributes_are_passed_over(spark):
    """thousands of plain tags make no elements, and the post is read as before."""
    page = ('<body><div class="post" id="post_7"><h1 class="title"><span class="post_title">T</span></h1><div class="content">'
            + "<b>" * 3000 + 'deep<div><i class="x">y</i></div></div></div></body>')
    df = spark.createDataFrame([(1, "https://b0.example.org/post/7/", page)], "page_id long, url string, html string")
    parsed = extract._parsed(df).select(F.transform("_elements", lambda e: e["name"]).alias("e"), F.transform("_within", lambda e: e["name"]).alias("w")).first()
    assert parsed.e == ["div", "h1", "span", "div", "div", "i"] and parsed.w == parsed.e[1:]
    row = extract.extract_post_pages(df).first()
    assert (row.found, row.id_attr, row.title) == (True, "post_7", "T") and row.content_html.endswith('deep<div><i class="x">y</i></div>')


def test_few_and_many_outer_elements_agree(spark):
    def spans(n, step):
        return [(i * step + 1, i * step + step // 2 + 1) for i in range(n)]
    kind = "array<struct<i:int,end:int>>"
    for n in (0, 1, M.FEW, M.FEW + 1, 3 * M.FEW):
        outer, inner = spans(n, 10), [(i, i + 1) for i in range(1, 600, 3)]
        df = spark.createDataFrame([(outer, inner)], f"o {kind}, n {kind}")
        got = df.select(F.transform(M.inside(F.col("o"), F.col("n")), lambda x: x["i"]), F.transform(M.inside(F.col("o"), F.col("n"), outside=True), lambda x: x["i"]),
                        F.transform(M.first_inside(F.col("o"), F.col("n")), lambda x: x["i"])).first()
        within = [i for i, _ in inner if any(a < i < b for a, b in outer)]
        first = [min(i for i, _ in inner if a < i < b) for a, b in outer if any(a < i < b for i, _ in inner)]
        assert (got[0], got[1], got[2]) == (within, [i for i, _ in inner if i not in within], first)


def test_an_attribute_is_searched_once(spark):
    """one regular expression a tag, whatever the quoting."""
    tags = {'<a href="/x?a=1&amp;b=2">': "/x?a=1&b=2", "<a HREF = '/y\"z'>": '/y"z', "<a\thref=/z>": "/z", '<a href="">': "", "<a href=''>": "", "<a name=x>": None,
            '<a href=\n "  s ">': "  s ", "<a href=a=b>": "a=b", None: None}
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    assert {r.t: r.v for r in df.select("t", H.attribute("t", H.HREF).alias("v")).collect()} == tags
    assert str(df.select(H.attribute("t", H.HREF).alias("v"))._jdf.queryExecution().analyzed()).count("regexp_extract(") == 1


def test_rendered_pages_are_dealt_out_evenly(spark):
    """a table of one file is not parsed by one task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = jobs._post_pages(spark, SF001, None)
    assert n > 1 and len([p for p in pages.rdd.glom().map(len).collect() if p]) == n


def test_words_are_counted_where_the_post_is(spark):
    """Texts are dealt out by post, words are not dealt out again, and the dictionary needs no counts."""
    posts = spark.createDataFrame([(1, "<p>Ёлка ёлка_два a bb ccc» 𐐀𐐀𐐀 x1y</p>"), (1, "ccc"), (2, None)], "post_id long, content_html string")
    counts = corpus.word_counts(posts)
    assert plan(counts).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, counts.collect())) == [(1, "ccc", 2), (1, "x1y", 1), (1, "два", 1), (1, "елка", 2), (1, "𐐨𐐨𐐨", 1)]
    assert "count(" not in plan(jobs.lemma_dictionary(posts))
    assert {r.token for r in corpus.vocabulary(posts).collect()} == {"ccc", "x1y", "два", "елка", "𐐨𐐨𐐨"}
    texts = spark.createDataFrame([("a__bcd e_f 12 ab.cde/ghi…jkl 𐐀𐐀",), ("___",), (None,)], "t string")
    old = F.filter(X.tokens(X.space_out("t")), lambda t: F.length(t) >= X.MIN_TOKEN_LENGTH)
    assert all(r.a == r.b for r in texts.select(old.alias("a"), X.long_tokens("t").alias("b")).collect())
