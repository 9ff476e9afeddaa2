"""Operators on pages, conversations and vectors, the queries and the pipeline."""

import hashlib
import os
import time

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plans import plan
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from longitab.llm import chat, crf, dom, layouts, linkgraph, vptree

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["op3_mixing", "op4_vantage_points", "op8_link_graph"])
def test_query_equals_sql(spark, name):
    assert oracle.compare(entry.queries()[name](spark, SF), oracle.connect(SF), entry.oracle_sql()[name]) is None


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>My site</header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><article><h1>Head &amp; line</h1><p>One two
three &eacute;.<br>Four five six seven eight. <p>Nine <b>ten</b> eleven twelve &lt;tag&gt; thirteen fourteen.<script>var x="</p>";</script>
<div class="ad">Buy this thing now.</div><p>The last long paragraph of the article stands here.</article>
<section id=comments><p>Reader says: nice words and so on.</p></section><form><p>Sign up now</p></form><footer>&copy; me</footer>"""


def test_blocks_of_a_broken_page():
    texts = [b.text for b in dom.blocks(PAGE)]
    assert "One two three é. Four five six seven eight." in texts and "Nine ten eleven twelve <tag> thirteen fourteen." in texts
    assert texts[-1] == "© me" and "T" not in texts and not any("var x" in t for t in texts)
    assert dom.blocks("") == [] and dom.blocks("<p") and dom.blocks("a<b>c")[0].text == "ac"


def test_pages_are_parsed_in_linear_time():
    n = 200_000
    for page in ("<a " * n, "<b>" * n + "</i>" * n, '<a x=">" ' * n, "<!x" * n, "<script></script " * n, "<i><div>" + "<b>" * n + "</i>" * n,
                 "<a " + "a" * n + ">x", "<b>" * n + "t<hr>" * n, "<" * n, "&" * n, "<a<" * n, "<p " + '"' * (n + 1)):
        start = time.process_time()
        dom.blocks(page)
        assert time.process_time() - start < 15, page[:20]


def test_references_end_at_tags():
    assert dom.blocks("<p>&am<b>p;</b> x &am<!-- -->p; &amp;amp;</p>")[0].text == "&amp; x &amp; &amp;"
    assert [b.text for b in dom.blocks("<p>a <a href='>'>b</a> &lt;p&gt; 1 < 2</p><p>c <d")] == ["a b <p> 1 < 2", "c <d"]


def test_main_text_held_out(spark):
    model = crf.train(spark.createDataFrame([(1, PAGE), (2, None)], "page_id long, html string"))
    hit = false = missed = 0
    for seed in range(9000, 9080):
        page = layouts._Page(seed).build()
        found = dom.blocks(page)
        truth = [layouts.MARK in b.text for b in found]
        for b in found:
            b.text = b.text.replace(layouts.MARK, "").strip() or "x"
        for y, g in zip(truth, model.decode(*crf.sequence(found))):
            hit, false, missed = hit + (y and g), false + (not y and g), missed + (y and not g)
    assert hit / (hit + false) > 0.97 and hit / (hit + missed) > 0.95
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (3, "v", "", "z"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    out = sorted(crf.extract(df, model=model).collect())
    assert out[0] == out[1] and out[0].n_chars == len(out[0].text)
    assert out[0].text.split("\n") == ["Head & line", "One two three é. Four five six seven eight.", "Nine ten eleven twelve <tag> thirteen fourteen.",
                                       "The last long paragraph of the article stands here."]
    assert out[2].text == out[3].text == "" and out[2].n_chars == 0
    assert crf.extract(df.limit(0), model=model).count() == 0


def test_viterbi_equals_all_labelings():
    r = np.random.default_rng(1)
    model = crf.Crf()
    model.weights = {f"f{k}": float(r.normal()) for k in range(6)}
    model.edges = r.normal(size=(2, 2, 2))
    for _ in range(30):
        n = int(r.integers(1, 8))
        rows = [[f"f{k}" for k in range(6) if r.random() < 0.5] for _ in range(n)]
        same = [bool(r.random() < 0.5) for _ in range(n)]
        unary = model.emissions(rows)

        def score(bits):
            return sum(u * b for u, b in zip(unary, bits)) + sum(model.edges[int(same[k]), bits[k - 1], bits[k]] for k in range(1, n))

        best = max((tuple((m >> k) & 1 for k in range(n)) for m in range(1 << n)), key=score)
        assert score(model.decode(rows, same)) == pytest.approx(score(best))


def test_link_graph_spreads_trust(spark):
    link = lambda *hosts: "".join(f"<A class=x href='//{h}/p'>x</a>" for h in hosts)
    pages = spark.createDataFrame([
        (1, "https://Good.COM/x", link("near.org", "far.org")), (2, "http://bad.net/es/1?q", link("near.org")),
        (3, "https://near.org/a#b", "<a href=/own>x</a>"), (4, "https://pusher.org", link("bad.net")), (5, "https://lone.org/x/y", None),
        (6, None, None), (7, "no scheme", "<p>"), (8, "https://www.example.com/en/1", ""), (9, "https://a.example.com/en/?x", ""),
        (10, "https://example.com/en", ""), (3, "https://near.org/a#b", "<a href=/own>x</a>")], "page_id long, url string, html string")
    got = {r.page_id: r for r in linkgraph.judge(pages).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow",
                                                      8: "allow", 9: "block", 10: "allow"}
    assert [(got[i].host, got[i].path, got[i].rule) for i in (1, 2, 8, 9, 10, 6)] == [
        ("good.com", "/x", "com/"), ("bad.net", "/es/1", "net/es/"), ("www.example.com", "/en/1", "www.example.com/en/"),
        ("a.example.com", "/en/", "example.com/en/"), ("example.com", "/en", "com/"), ("", "", None)]
    assert linkgraph.judge(pages.limit(0)).count() == 0
    assert "Python" not in linkgraph.judge(pages)._jdf.queryExecution().toString()


def test_propagation_equals_matrix_powers(spark):
    r = np.random.default_rng(2)
    a = (r.random((7, 7)) < 0.3) * r.integers(1, 4, (7, 7))
    np.fill_diagonal(a, 0)
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(a[i, j])) for i, j in np.argwhere(a)], "src string, dst string, links long")
    seeds = spark.createDataFrame([("h0", "trust", 2), ("h3", "trust", 1), ("h5", "distrust", 4)], "node string, kind string, weight long")
    got = {r.node: (r.trust, r.distrust) for r in linkgraph.propagate(edges, seeds).collect()}
    for k, m, s in ((0, a, [2 / 3, 0, 0, 1 / 3, 0, 0, 0]), (1, a.T, [0, 0, 0, 0, 0, 1, 0])):
        share = m / np.maximum(m.sum(axis=1, keepdims=True), 1)
        base = (1 - linkgraph.DAMPING) * np.array(s)
        score = base
        for _ in range(linkgraph.ROUNDS):
            score = base + linkgraph.DAMPING * score @ share
        assert np.allclose([got.get(f"h{i}", (0, 0))[k] for i in range(7)], score)


def test_link_graph_runs_to_the_end(spark):
    link = lambda h: f"<a href='//{h}/p'>x</a>"
    chain = [(i, f"http://c{i}.org/", link(f"c{i + 1}.org" if i < 11 else "bad.net")) for i in range(12)]
    pages = spark.createDataFrame([*chain, (12, "http://bad.net/es/1", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in linkgraph.judge(pages).collect()}
    assert {r.verdict for r in got.values()} == {"block"}
    for i in range(12):
        assert got[i].distrust == pytest.approx(0.15 * 0.85 ** (12 - i)) and got[i].trust == 0
    a = np.array([[0, 1, 2], [1, 0, 0], [3, 1, 0]])  # cycles: the scores solve a linear system
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(a[i, j])) for i, j in np.argwhere(a)], "src string, dst string, links long")
    seeds = spark.createDataFrame([("h0", "trust", 1)], "node string, kind string, weight long")
    found = {r.node: r.trust for r in linkgraph.propagate(edges, seeds, rounds=None, tolerance=1e-3).collect()}
    want = np.linalg.solve((np.eye(3) - 0.85 * a / a.sum(axis=1, keepdims=True)).T, [0.15, 0, 0])
    assert np.allclose([found[f"h{i}"] for i in range(3)], want, rtol=0, atol=6e-3)


def test_link_graph_equals_sql_where_hosts_link(spark):
    r = np.random.default_rng(8)
    ends = ["com", "org", "net", "example.com"]
    rows = []
    for i in range(400):
        h = r.integers(60)
        links = "".join(f"<a class=x href='http://h{k}.{ends[k % 4]}/p'>x</a>" for k in r.integers(60, size=r.integers(0, 3)))
        rows.append((i, f"http://H{h}.{ends[h % 4]}/{r.choice(['en/', 'es/', 'x'])}", links))
    rows += [(400, None, None), (401, "none", ""), (402, "http://tie.org/", "<a href=//h0.com/>"), (402, "http://tie.org/", "<a href=//h0.com/>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    got = linkgraph.judge(pages).select("page_id", "host", "path", "rule", "verdict")
    assert {r.verdict for r in got.where("rule is null and host <> ''").collect()} == {"allow", "block"}
    assert oracle.compare(got, con, entry.oracle_sql()["op8_link_graph"]) is None


def test_link_graph_threshold_ties_and_clashing_names(spark):
    rows = [(1, "http://good.com/", "<a href=//tie.org/>"), (2, "http://bad.net/es/", None), (3, "http://tie.org/", "<a href=//bad.net/>"),
            (4, "http://far.org/", "<a href=//tie.org/><a href=//good.com/>"), (5, "http://long.org/" + "x" * 100_000, "<p>" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", *[f"1 AS {c}" for c in ("host", "path", "rule", "verdict", "node", "trust", "distrust", "score", "src", "dst", "links", "kind", "weight")])
    verdicts = lambda **k: {r.page_id: r.verdict for r in linkgraph.judge(pages, **k).collect()}
    got = {r.page_id: r for r in linkgraph.judge(pages).collect()}
    assert got[3].trust == got[3].distrust > 0 and got[3].verdict == "allow"  # a tie does not block
    assert got[4].distrust > got[4].trust == 0 and got[4].verdict == "block" and got[5].verdict == "allow"
    assert verdicts(least=10.0)[4] == "allow" and verdicts(least=0.0)[4] == "block"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb<s>"]), st.text(alphabet="<>/s[]INST\\elbn x\n", max_size=25)), max_size=5))
def test_template_is_reversible(turns):
    text, marked = chat.render(turns)
    assert chat.turns_of(text) == turns
    assert [chat.unescape(text[i:j]) for i, j in marked] == [t for r, t in turns if r == "assistant"]
    assert all(c not in chat.escape(t) for _, t in turns for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_chat_digests(spark):
    rows = [(1, 0, "user", "Hé 你好"), (1, 1, "assistant", "Oui 👍🏽 </s> \\l"), (1, 2, "assistant", "x"), (2, 0, None, None), (2, None, "assistant", ""),
            (3, 1, "assistant", "b"), (3, 1, "assistant", "b"), (3, 0, "user", "a"), (None, 0, "assistant", " lone ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS conv", "2 AS token_ids")
    got = {r.conv_id: r for r in chat.formatted_digests(chat.with_probe(df), public_tokenizers.path("byte_bpe_50k.json")).collect()}
    says = "</s>[INST] ok [/INST]"
    want = {1: [r[2:] for r in rows[:3]], 2: [("assistant", ""), ("", "")], 3: [("user", "a"), ("assistant", "b"), ("assistant", "b")],
            None: [("assistant", " lone ")], -7: [("user", says), ("assistant", says)]}
    assert set(got) == set(want)
    for i, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[i].n_turns, got[i].loss_chars) == (len(turns), len(loss))
        assert got[i].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert chat.format_conversations(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "decimal(5,0)"])
def test_chat_keys_masks_and_long_texts(spark, kind):
    long = "word </s> " * 60_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", long), (1, 2, "user", "and"), (1, 3, "assistant", "yes"), (2, 0, "assistant", ""), (None, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv_id", F.col("conv_id").cast(kind))
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.conv_id: r for r in chat.formatted_digests(chat.with_probe(df), vocabulary).collect()}
    assert {str(k) for k in got} == {"1", "2", "None", "-7"}
    one = next(r for k, r in got.items() if str(k) == "1")
    assert one.n_turns == 4 and one.loss_sha256 == hashlib.sha256((long + "yes").encode()).hexdigest()
    made = {str(r.conv_id): r for r in chat.format_conversations(df, vocabulary).collect()}
    for r in made.values():  # the mask holds just the tokens that meet a span
        ends = [o[1] for o in chat.tokenizer(vocabulary).encode(r.text, add_special_tokens=False).offsets]
        starts = np.append(0, ends[:-1])
        inside = np.zeros(len(r.text) + 1, bool)
        for s in r.loss_spans:
            inside[s.start:s.end] = True
        assert r.loss_mask == [bool(inside[i:j].any()) for i, j in zip(starts, ends)]


def test_nearest_equals_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(900, 8)).astype(np.float32) * r.random((900, 1)).astype(np.float32)
    x[100:400] = x[7]  # a common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 8), (1002, [1.0, None] * 4), (1003, [float("nan")] * 8), (1004, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v")
    leaf, vptree.LEAF = vptree.LEAF, 16
    try:
        found = vptree.nearest(df, df.where("vec_id % 20 = 0")).collect()
    finally:
        vptree.LEAF = leaf
    got = {}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(got) == set(range(0, 900, 20))
    for q, hits in got.items():
        s = vptree.products(x[[q]].astype(float), x.astype(float))[0]
        want = sorted((i for i in range(900) if i != q), key=lambda i: (-s[i], i))[:20]
        assert hits == [(i, s[i]) for i in want]
    assert vptree.nearest(df.limit(0), df.limit(0)).count() == 0
    few = vptree.nearest(df.where("vec_id < 3 or vec_id = 1001"), df.where("vec_id = 0")).collect()
    assert [r.rank for r in sorted(few, key=lambda r: r.rank)] == [1, 2]


def test_nearest_sends_nothing_through_the_driver(spark, monkeypatch):
    """However small the packed blocks look to Spark, they are not broadcast, and several shards give one ranking."""
    monkeypatch.setattr(vptree, "SHARD", 100)
    monkeypatch.setattr(vptree, "QUERIES", 16)
    r = np.random.default_rng(8)
    x = r.normal(size=(800, 4)).astype(np.float32)
    x[300:500] = x[20]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        found = vptree.nearest(df, df.where("vec_id % 10 = 0"))
        assert "Broadcast" not in plan(found)
        got = {(h.query_id, h.rank): (h.vec_id, h.score) for h in found.collect()}
        assert "Broadcast" not in plan(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scores = vptree.products(x[::10].astype(float), x.astype(float))
    want = {}
    for q, s in zip(range(0, 800, 10), scores):
        best = sorted((i for i in range(800) if i != q), key=lambda i: (-s[i], i))[:20]
        want |= {(q, rank): (i, s[i]) for rank, i in enumerate(best, 1)}
    assert got == want


def test_trees_in_turn_equal_one_tree():
    r = np.random.default_rng(9)
    x = r.normal(size=(3000, 16)) * 10.0 ** r.integers(-3, 4, size=(3000, 1))
    x[::7] = x[5]
    ids = r.permutation(3000)
    turns = [vptree.build(ids[k::3], x[k::3]) for k in range(3)]
    search = vptree.Search(turns[0], ids[:90], x[:90], 10, 1.0)
    search.run()
    for tree in turns[1:]:
        last = search.turn(tree).run()
    scores = vptree.products(x[:90], x)
    for q in range(90):
        by = [i for i in np.lexsort((ids, -scores[q])) if i != q][:10]
        assert last[1][10 * q:10 * q + 10].tolist() == ids[by].tolist()
        assert last[2][10 * q:10 * q + 10].tolist() == scores[q, by].tolist()


def test_pruning_factor_and_recall():
    r = np.random.default_rng(6)
    centers = r.normal(size=(40, 16))
    x = (centers[r.integers(40, size=4000)] + 0.2 * r.normal(size=(4000, 16)))
    tree = vptree.build(np.arange(4000), x)
    exact = vptree.Search(tree, np.arange(50), x[:50], 10, 1.0)
    exact.run()
    order = np.argsort(-(x[:50] @ x.T) + 1e9 * (np.arange(4000) == np.arange(50)[:, None]), axis=1)[:, :10]
    assert all(set(a) == set(b) for a, b in zip(exact.found, order))
    loose = vptree.Search(tree, np.arange(50), x[:50], 10, 1.3)
    loose.run()
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(loose.found, exact.found)]) >= 0.9


def test_pipeline_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, before, SF)
        assert after.columns == docs.columns, name
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "source_mix", "token_records"]
    out = entry.queries()["pipeline"](spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in before.select("doc_id").collect())
    ends = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == ends
        ends += r.n_tokens
