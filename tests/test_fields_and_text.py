import datetime as dt

from pyspark.sql import functions as F

from blogweave.functions import fields as FD
from blogweave.functions import html as H
from blogweave.functions import text as X
from blogweave.operators import corpus

NOW = dt.datetime(2015, 3, 18, 12, 0)


def _parse(spark, *texts):
    df = spark.createDataFrame([(t, NOW) for t in texts], "t string, f timestamp_ntz")
    return [r[0] for r in df.select(FD.parse_site_datetime(F.col("t"), F.col("f"))).collect()]


def test_all_months_and_relative_words(spark):
    texts = [f"5 {m} 2014 в 10:07" for m in FD.MONTHS_GENITIVE]
    assert _parse(spark, *texts) == [dt.datetime(2014, i + 1, 5, 10, 7) for i in range(12)]
    assert _parse(spark, "сегодня в 09:15", "вчера в 23:59", "7 мая в 01:00", "мусор", None) == [
        dt.datetime(2015, 3, 18, 9, 15), dt.datetime(2015, 3, 17, 23, 59), dt.datetime(2015, 5, 7, 1, 0),
        None, None]


def test_render_parse_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2015, 3, 18, 8, 1), NOW), (dt.datetime(2015, 3, 17, 8, 2), NOW),
                                (dt.datetime(2014, 12, 31, 23, 3), NOW)], "ts timestamp_ntz, f timestamp_ntz")
    out = df.select(FD.render_site_datetime(F.col("ts"), F.col("f")).alias("t"), "ts", "f")
    got = out.select("t", FD.parse_site_datetime(F.col("t"), F.col("f")).alias("p"), "ts").collect()
    assert got[0].t.startswith("сегодня") and got[1].t.startswith("вчера") and "декабря" in got[2].t
    assert all(r.p == r.ts for r in got)


def test_numbers_and_karma(spark):
    df = spark.createDataFrame([("–5",), ("+3",), ("1,5",), ("",), (None,), ("x",)], "t string")
    got = df.select(FD.parse_int("t"), FD.parse_number("t"), FD.parse_karma("t"),
                    FD.parse_karma("t", convert_en_dash=False)).collect()
    assert [r[0] for r in got] == [-5, 3, None, None, None, None]
    assert [r[1] for r in got] == [-5.0, 3.0, 1.5, None, None, None]
    assert [r[2] for r in got] == [-5.0, 3.0, 1.5, None, None, None]
    assert [r[3] for r in got] == [None, 3.0, 1.5, None, None, None]   # original profile parser


def test_registration_and_activity_texts(spark):
    df = spark.createDataFrame([("3 марта 2012 по приглашению bob",), ("по приглашению x",),
                                ("Последний раз был на сайте 5 мая 2014 в 10:00",)], "t string")
    got = df.select(FD.registration_text("t"), FD.last_activity_text("t")).collect()
    assert got[0][0] == "3 марта 2012 " and got[1][0] == "по приглашению x"   # cut only when position > 0
    assert got[2][1] == "5 мая 2014 в 10:00"


def test_visible_text_keeps_script_comment_and_entities(spark):
    html = '<!DOCTYPE html><p>a<b>b</b></p><script>var t="</p>";</script><!-- c --><p>&amp;</p>'
    df = spark.createDataFrame([(html,)], "h string")
    soup, plain = df.select(H.visible_text("h"), H.visible_text("h", keep_comments=False)).first()
    assert soup == 'DOCTYPE htmlabvar t="</p>"; c &amp;'
    assert plain == 'abvar t="";&amp;'


def test_tokens_length_and_yo(spark):
    posts = spark.createDataFrame([(1, "Ёлка ёж «Ёлка» да/нет cat_dog Ёлка.")], "post_id long, content_html string")
    got = {r.lemma: r.n for r in corpus.word_counts(posts).collect()}
    assert got == {"елка": 3, "нет": 1, "cat": 1, "dog": 1}          # 'ёж', 'да' are too short


def test_lemma_dictionary_join(spark):
    posts = spark.createDataFrame([(1, "cats cat dogs")], "post_id long, content_html string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "")], "token string, lemma string")
    got = {r.lemma: r.n for r in corpus.word_counts(posts, lemmas).collect()}
    assert got == {"cat": 2}                                           # empty lemma dropped


def test_bag_items_escape_after_counting_and_suffix(spark):
    terms = spark.createDataFrame([
        (1, "words", "a b", 1), (1, "words", "a_b", 2), (1, "words", "x:y|z\tw", 3),
        (1, "users", "u1", 1000000), (2, "tags", "t", 1)], "post_id long, modality string, term string, n long")
    posts = spark.createDataFrame([(1,), (2,), (3,)], "post_id long")
    got = {r.post_id: r.line for r in corpus.corpus_lines(posts, terms).collect()}
    assert got[1] == "'1 |words a_b a_b:2 x_y_z_w:3 |author |users u1:1000000 |tags |hubs"
    assert got[2] == "'2 |words |author |users |tags t |hubs"
    assert got[3] == "'3 |words |author |users |tags |hubs"
    assert X.MODALITIES == ["words", "author", "users", "tags", "hubs"]
