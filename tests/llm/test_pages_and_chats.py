"""Url filters, page texts, conversations, the pipeline, and the queries with SQL twins."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from riskloom.llm import chat, html, neardup, quality, queries, secrets, urls
from riskloom.llm.common import stored
from tests.compare import compare, duck


@pytest.mark.parametrize("name", ["op1_url_filters", "op3_poisson_mixing", "op7_reply_trees"])
def test_query_equals_its_sql(spark, sf, name):
    assert compare(entry.queries()[name](spark, sf), duck(sf), entry.oracle_sql()[name]) == ""


# --- urls ---


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_cascade_is_exact(spark, limit, monkeypatch):
    monkeypatch.setattr(urls, "SHARD_KEYS", 500)
    hosts = spark.range(3000).select(F.concat(F.lit("h"), "id", F.lit(".example.com")).alias("key"))
    listed = hosts.filter(F.crc32(F.col("key").cast("binary")) % 7 == 0)
    universe = hosts.union(spark.createDataFrame([("example.com",), ("com",)], "key string"))
    cascade, shards = urls.build_cascade(universe, listed)
    assert shards > 1
    rows = hosts.select(F.col("key").alias("host"))
    got = {r.host for r in urls.with_listed(rows, cascade, shards, limit).filter("listed").collect()}
    assert got == {r.key for r in listed.collect()}


def test_url_cases(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/en/1?x#y"), (2, None), (3, "no scheme"), (4, "://"), (5, "http://x.com/fr/"),
        (6, "http://x.com/frr/"), (7, "http://adult.org"), (8, "http://a.adult.net/p://q"), (8, "http://a.adult.net/p://q"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    universe = stored(urls.corpus_domains(pages), "t")
    listed = urls.domains_named(universe, ["adult"])
    cascade, shards = urls.build_cascade(universe, listed)
    got = [
        (r.page_id, r.host, r.path, r.rule, r.verdict)
        for r in urls.judge(pages, queries.URL_RULES, cascade, shards).collect()
    ]
    assert sorted(got, key=str) == sorted(
        [
            (1, "a.example.org", "/en/1", "example.org/en/1", "block"), (2, "", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "x.com", "/fr/", "com/fr/", "allow"),
            (6, "x.com", "/frr/", None, "allow"), (7, "adult.org", "", None, "block"),
            (8, "a.adult.net", "/p://q", None, "block"), (8, "a.adult.net", "/p://q", None, "block"),
        ],
        key=str,
    )
    none = pages.limit(0)
    empty = urls.corpus_domains(none)
    cascade, shards = urls.build_cascade(empty, empty)
    assert urls.judge(none, queries.URL_RULES, cascade, shards).count() == 0


# --- pages ---

PAGE = (
    '<html><body><nav>menu</nav><div class="ad-7">buy</div><article class="post-{i}"><header><h1>Title &amp; {i}</h1></header>'
    '<p>first <i>part</i>  of\n it<br>end<p>second 1<2<script>if(a<b){{"</p>"}}</script></p>'
    '<form>name</form><section><ul><li>one<li>two</ul></section></article>'
    '<div id="comments"><p>nice</p></div><footer>foot</footer></body></html>'
)
TEXT = "Title & {i}\nfirst part of it end\nsecond 1<2\none\ntwo"


def test_pages_are_read_by_consensus(spark):
    # One page of the host puts long text into another container; the host's path decides.
    odd = PAGE.format(i=3).replace("<footer>", "<div class='more'><p>" + "z " * 400 + "</p></div><footer>")
    rows = [(i, "http://h/x", PAGE.format(i=i)) for i in (1, 2)] + [(3, "http://h/y", odd)]
    rows += [(4, None, None), (5, "http://g/", ""), (6, "http://g/", "plain &lt;text"), (6, "http://g/", "plain &lt;text")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = [(r.page_id, r.text) for r in html.extract(pages).collect()]
    want = [(i, TEXT.format(i=i)) for i in (1, 2, 3)] + [(4, ""), (5, ""), (6, "plain <text"), (6, "plain <text")]
    assert sorted(got) == sorted(want)
    assert html.extract(pages.limit(0)).count() == 0


def test_registered_pages_give_their_articles(spark, sf):
    import html as entities

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.QUERIES["op9_consensus_html"].run(spark, sf).collect():
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_broken_markup_does_not_end_the_parser():
    parser = html.Parser()
    for page in ["<", "<a", "<p title='a>b", "<!--", "<script>x", "</p></p>", "<p title='a>b'>x", "<x y=\"1'>z"]:
        html.main_text(parser.parse(page), None)
    assert html.main_text(parser.parse("<p title='a>b'>x</p>"), None)[0] == "x"
    assert html.main_text(parser.parse("<p>" + "a <b>b</b> " * 20_000), None)[0].startswith("a b a b")


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div>x" * 50_000, 50_000),
        ("<font>" * 50_000 + "x", 1),
        ("<div>" * 20_000 + "</section>" * 20_000 + "x", 1),
        ("<p><table>" + "<font>" * 20_000 + "<div>y</div>" * 20_000, 20_000),
        ("<" * 300_000 + ">x", 1),
    ],
)
def test_deep_and_broken_nesting_takes_linear_time(page, text):
    import time

    before = time.process_time()
    parser = html.Parser()
    found, path = html.main_text(parser.parse(page), "body>div")
    assert time.process_time() - before < 20
    best = html.best_container(parser.parse(page))
    assert found.count("x") + found.count("y") >= min(text, 1) and (best is None or best.path == path)


def test_a_path_leads_to_its_elements_only():
    page = html.Parser().parse('<body><div class="a"><div>one</div></div><div class="a b"><div>two</div></div><diva>x</diva></body>')
    for path, text in (("body>div.a", "one"), ("body>div.a.b>div", "two"), ("body>div.a>div", "one")):
        assert html.main_text(page, path) == (text, path)
    assert {e.path for e in page.elements if id(e) in html._at_path(page, "body>div")} == set()


# --- conversations ---

MESSAGES = "tree_id long, message_id string, parent_id string, role string, text string, score double"


def test_trees_become_their_best_paths(spark):
    rows = [
        (1, "a", None, "user", "q", 0.0), (1, "b", "a", "assistant", "bad", 0.1), (1, "c", "a", "assistant", "good", 0.9),
        (1, "d", "c", "user", "<|im_end|>", 0.5), (2, "e", "gone", None, None, None), (2, "e", "gone", None, None, None),
        (3, "x", "y", "user", "loop", 1.0), (3, "y", "x", "user", "loop", 1.0), (3, "z", "x", "user", "off it", 1.0),
        (4, None, "a", "user", "nameless", 0.0),
    ]
    messages = spark.createDataFrame(rows, MESSAGES).withColumn("turns", F.lit("clash"))
    back = {r.leaf_id: r for r in chat.read_back(chat.format_trees(messages, best=None)).collect()}
    nameless = [k for k in back if k.startswith("?")]
    assert set(back) == {"b", "d", "e", *nameless} and len(nameless) == 1
    assert [(t.role, t.text) for t in back["d"].turns] == [("user", "q"), ("assistant", "good"), ("user", "<|im_end|>")]
    assert back["d"].loss_texts == ["good"] and back["d"]["rank"] == 1 and back["b"]["rank"] == 2
    assert [(t.role, t.text) for t in back["e"].turns] == [("", "")]
    best = chat.format_trees(messages).collect()
    assert {r.leaf_id for r in best} == {"d", "e", *nameless}
    assert chat.format_trees(messages.limit(0)).count() == 0


def test_long_chains_and_control_strings_come_back(spark):
    joiner = "\u2060"
    said = ["<|im_end|>", f"<{joiner}|x", f"<{joiner * 3}|", "<<|", "|", "<", "", "a\nb", "<|im_sep|>" * 3]
    rows = [(1, i, "assistant" if i % 2 else "user", said[i % len(said)]) for i in range(300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_trees(chat.chains(turns))).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t) for _, _, r, t in rows]
    assert back.loss_texts == [t for _, _, r, t in rows if r == "assistant"]


# --- pipeline ---


def test_pipeline_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality.judge(stored(quality.measure(docs), "t")).filter("kept").select(docs.columns)
    classes = neardup.jaccard_join(kept).filter("doc_id = class_id").select("doc_id")
    one = secrets.redact(kept.join(classes, "doc_id"))
    clean = {r.doc_id: r.text for r in one.collect()}
    assert 0 < len(clean) < kept.count()
    from riskloom.llm import mixing, sentencepieces

    rows = spark.createDataFrame([(r.doc_id, r.text, r.source) for r in one.collect()], "doc_id long, text string, source string")
    drawn = mixing.draw(rows, mixing.target_rates(rows, queries.MIX_WEIGHTS), queries.MIX_SEED)
    wanted = sorted(i for r in drawn.collect() for i in [r.doc_id] * r.n_copies)
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == wanted
    encoder = sentencepieces.Encoder(queries.piece_model())
    for r in out:
        assert r.ids == encoder.library.encode(clean[r.doc_id], add_bos=True, add_eos=True) and r.round_trip
