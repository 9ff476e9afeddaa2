"""Operators on documents against plain versions."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from longitab.llm import jaccard, language, mixing, records, spans, templates
from longitab.session import stage
from plans import plan

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles_of(text, n):
    w = words_of(text)
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def groups_of(docs, n, num, den):
    sets = [(i, shingles_of(t, n)) for i, t in docs if i is not None]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and den * len(a & b) >= num * len(a | b):
            x, y = sorted((top(i), top(j)))
            up[y] = x
    return {i: top(i) for i in up}


def near_copies(seed=5):
    r = np.random.default_rng(seed)
    docs, k = [], 0
    for base in range(12):
        text = [f"w{r.integers(400)}" for _ in range(r.integers(3, 90))]
        for _ in range(r.integers(1, 9)):
            t = list(text)
            for _ in range(r.integers(0, 4)):
                t[r.integers(len(t))] = f"z{r.integers(50)}"
            docs.append((k, " ".join(t)))
            k += 1
    chain = [f"c{i}" for i in range(60)]
    for step in range(8):  # neighbours link, the ends do not
        docs.append((k, " ".join(chain[step:] + [f"d{i}" for i in range(step)])))
        k += 1
    return docs


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 80, 100), (1, 1, 2)])
def test_jaccard_groups_equal_all_pairs(spark, n, num, den):
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(df, n, f"{num}/{den}").collect()}
    want = groups_of(docs, n, num, den)
    assert got == {i: (len(shingles_of(t, n)), want[i]) for i, t in docs}


def test_jaccard_odd_rows(odd, none):
    rows = jaccard.jaccard_groups(odd, 4, "0.85").collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r.component_id for r in rows}
    want = groups_of([(r.doc_id, r.text) for r in odd.collect()], 4, 85, 100)
    assert got == {**want, None: None}
    assert jaccard.jaccard_groups(none).count() == 0
    assert sorted(r.doc_id for r in jaccard.one_per_group(odd, 4, "0.85").where("doc_id is not null").collect()) == sorted(
        r.doc_id for r in odd.where("doc_id is not null").collect() if want[r.doc_id] == r.doc_id)


def plain_mix(docs, weights=(1, 2, 3), most=3):
    size = collections.Counter()
    for _, t, s in docs:
        size[s] += len(words_of(t))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {}, set(order), sum(size.values())
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if weight[s] * level >= most * size[s]}
        if not full:
            return size, {**target, **{s: weight[s] * level for s in free}}
        for s in full:
            target[s] = most * size[s]
            left -= target[s]
        free -= full


def test_mix_meets_targets(spark, odd, none):
    docs = [(i, " ".join(["w"] * (1 + i % 13)), ["a", "b", "c", None][min(3, i % 7)]) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    size, target = plain_mix(docs)
    taken = collections.Counter()
    for r in rows:
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 13 for s in size)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    copies = collections.Counter({r.doc_id: r.copies for r in rows})
    assert collections.Counter(r.doc_id for r in mixing.mixed_documents(df).collect()) == +copies
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count() and {r.size for r in out if r.doc_id in (20, 21, 22)} == {0}
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0


def test_texts_without_words_stay_within_the_limit(spark):
    docs = [(i, "" if i < 20 else "a b c d e", "ab"[i % 2]) for i in range(30)] + [(40 + i, "x " * 50, "c") for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    copies = collections.Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    assert max(copies.values()) <= 3
    assert copies == +collections.Counter({r.doc_id: r.copies for r in mixing.mix(df).collect()})


def test_records_are_read_shuffled_through_the_index(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(records, "fresh_path", lambda _: str(tmp_path / "out"))
    least = -(1 << 63)
    docs = spark.createDataFrame([(least, "lowest id"), (None, "no id"), (0, ""), *[(i, f"text {i} of many") for i in range(5, 60)]], "doc_id long, text string")
    want = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in records.tokenized(docs, VOCABULARY).collect()}
    assert {i for i, _, _ in want} == {least, None, 0, *range(5, 60)}
    index = spark.read.parquet(str(tmp_path / "out" / "index")).collect()
    got = set()
    for k in np.random.default_rng(1).permutation(len(index)):
        with open(tmp_path / "out" / "records" / index[k].shard, "rb") as f:  # one seek and one read a document
            f.seek(index[k].offset)
            i, ids = records.read_document(f.read(index[k].bytes), 0)
        got.add((i, len(ids), zlib.crc32(ids.tobytes())))
    assert got == want


def test_records_round_trip(spark, odd, none):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(VOCABULARY)
    more = spark.createDataFrame([(30, "Don't stop. a..b, <|endoftext|> X, ǅ İ. É")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    rows = sorted(records.tokenized(docs, VOCABULARY).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    start = 0
    assert len(rows) == len(want)
    for r, (known, i, text) in zip(rows, want):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens) == (i if known else None, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert records.tokenized(none, VOCABULARY).count() == 0


def test_record_frames():
    data = [(5, [1, 2, 70000]), (None, []), (-3, [10, 10, 0])]
    raw = b"".join(records.frame(i, np.array(x, np.uint32)) for i, x in data)
    got = list(records.frames(raw))
    assert [(i, x.tolist()) for _, _, i, x in got] == data
    assert [records.read_document(raw, at)[1].tolist() for at, *_ in got] == [x for _, x in data]
    with pytest.raises(ValueError):
        list(records.frames(raw[:12] + b"\7" + raw[13:]))


def test_language_finds_and_keeps(spark, odd, none):
    rows = {(r.row.doc_id, r.row.text): r for r in language.identify(odd).collect()}
    clean = [r for (i, t), r in rows.items() if i is not None and i < 20]
    assert all(r.accepted and r.language == ("en" if r.row.doc_id < 10 else "fr") for r in clean)
    assert not any(r.accepted for (i, t), r in rows.items() if i in (20, 21, 22, 25))
    assert language.accepted(odd).columns == odd.columns
    assert language.identify(none).count() == 0


def test_language_scores_a_text_once_a_pass(odd, monkeypatch):
    plans = []
    monkeypatch.setattr(language, "stage", lambda df: plans.append(plan(df)) or stage(df))
    plans.append(plan(language.accepted(odd)))
    scored = [p.count("ArrowEvalPython") for p in plans if "score(" in p]
    assert scored == [1, 1]  # for the grouped counts, and for the result


def test_language_keeps_rare_languages(spark):
    en, ga = "the river runs past the old mill and into the quiet sea", "bhi an abhainn ag rith thar an sean mhuileann go dti an fharraige"
    rows = spark.range(30_000).selectExpr("id as doc_id", f"if(id % 10000 = 7, '{ga}', '{en}') as text",
                                          "if(id % 10000 = 7, 'ga', 'en') as lang", "'s' as source")
    got = language.identify(rows).where("row.lang = 'ga'").collect()
    assert len(got) == 3 and all(r.accepted and r.language == "ga" for r in got)
    few = spark.createDataFrame([(1, en, "en", "s"), (2, ga, "ga", "s"), (3, "12", "xx", "s")], "doc_id long, text string, lang string, source string")
    assert {r.row.doc_id: (r.accepted, r.language) for r in language.identify(few).collect() if r.row.doc_id < 3} == {1: (True, "en"), 2: (True, "ga")}


def test_language_held_out(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    masked = rows.selectExpr("doc_id", "text", "source", "lang as truth", "if(doc_id % 2 = 0, lang, null) as lang")
    got = language.identify(masked).where("row.doc_id % 2 = 1").selectExpr("avg(int(language = row.truth))", "avg(int(accepted))").first()
    assert got[0] > 0.97 and got[1] > 0.97


def test_language_evidence_decides_where_text_does_not(spark):
    es, it = "el perro corre por la calle y los ninos juegan", "il cane corre nella strada e gli amici giocano"
    rows = [(i, es if i < 30 else it, "es" if i < 30 else "it", "x.es" if i < 30 else "y.it") for i in range(60)]
    rows += [(97, "zz", None, "y.it"), (98, "qq", "it", None), (99, "zz", None, "x.es")]
    df = spark.createDataFrame(rows, "page_id long, text string, declared string, host string")
    got = {r.row.page_id: r.language for r in language.identify(df, "page_id", "text", "declared", "host").collect()}
    assert (got[0], got[30], got[97], got[98], got[99]) == ("es", "it", "it", "it", "es")


def plain_posteriors(rows, domain):
    """``rows`` of (text, declared, suffix, host): per row the posterior of each language, by the definitions."""
    a, b, c, low = (int(x) for x in (language.A, language.B, language.C, 0xFFFFFFFF))

    def buckets(text):
        s = f" {(text or '').lower()} "
        for k in range(1, len(s) - 1):
            if s[k].isalpha():
                x, y, z = (ord(q) if q.isalpha() else 32 for q in s[k - 1:k + 2])
                yield ((((x * a) ^ (y * b) ^ (z * c)) & low) * a & low) >> 17

    grams = [list(buckets(r[0])) for r in rows]
    names = sorted({r[1] for r, g in zip(rows, grams) if r[1] and g})
    fitted = {x: collections.Counter(q for r, g in zip(rows, grams) if r[1] == x for q in g) for x in names}
    of = lambda x, q: math.log((fitted[x][q] + 0.1) / (sum(fitted[x].values()) + 0.1 * language.BUCKETS))
    text = [[sum(of(x, q) for q in g) for x in names] for g in grams]
    guess = [max(range(len(names)), key=lambda k: (t[k], -k)) if g else None for t, g in zip(text, grams)]
    tally = lambda test: [sum(1 for r, k in zip(rows, guess) if k == n and test(r)) for n in range(len(names))]
    size = tally(lambda r: True)
    total = sum(size)
    share = [(x + 1) / (total + len(names)) for x in size]

    def said(field, value):
        n = tally(lambda r: r[field] == value)
        if value is None or not sum(n):
            return [0.0] * len(names)
        return [math.log((x + 20 * (sum(n) + 1) / (total + 1)) / (m + 20)) for x, m in zip(n, size)]

    def prior(host):
        drawn = share
        for test in (lambda r: "." in host and "." in (r[3] or "") and domain(r[3]) == domain(host), lambda r: r[3] == host):
            n = tally(test) if host is not None else [0]
            if sum(n):
                drawn = [(x + 20 * p) / (sum(n) + 20) for x, p in zip(n, drawn)]
        return [math.log(p) for p in drawn]

    for r, t in zip(rows, text):
        logs = [sum(x) for x in zip(t, said(1, r[1]), said(2, r[2]), prior(r[3]))]
        odds = [math.exp(x - max(logs)) for x in logs]
        best = logs.index(max(logs))
        yield names[best], odds[best] / sum(odds)


def test_language_equals_plain_posterior(spark):
    r = np.random.default_rng(6)
    said = {"es": "el perro corre por la calle", "it": "il cane corre nella strada", "pt": "o cao corre pela rua"}
    hosts = ["a.uno.es", "b.uno.es", "c.due.it", "lone", None]
    rows = []
    for i in range(90):
        x = str(r.choice(list(said)))
        words = said[x].split()
        text = [" ".join(r.choice(words, r.integers(1, 4))), " ".join(words), "corre", "c", None, "12"][r.integers(6)]
        wrong = str(r.choice(list(said)))
        rows.append((text, [x, x, wrong, None][r.integers(4)], ["es", "it", None][r.integers(3)], hosts[r.integers(5)]))
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "id long, text string, declared string, suffix string, host string")
    got = {x.row.id: x for x in language.identify(df, "id", "text", "declared", "host", "suffix").collect()}
    changed = 0
    for i, (best, likely) in enumerate(plain_posteriors(rows, lambda h: ".".join(h.split(".")[-2:]))):
        assert got[i].confidence == pytest.approx(likely, abs=1e-3)
        assert got[i].language == best or likely < 0.51
        changed += rows[i][1] not in (None, best)
    assert changed > 5  # labels that the evidence overrules


def test_page_evidence(spark):
    html = "<!DOCTYPE html><HTML class=x lang='FR-ca'><script>var a='<p>';</script><body><p>Bonjour"
    df = spark.createDataFrame([(1, "https://u@www.Site.fr:80/a", html), (2, None, None)], "page_id long, url string, html string")
    a, b = sorted(language.page_evidence(df).collect())
    assert (a.declared, a.suffix, a.host, a.text.split()) == ("fr", "fr", "www.site.fr", ["Bonjour"]) and b.host is None


def plain_leaks(docs, items):
    """Word windows of eight, position by position, as in the operator but without hashes."""
    out = set()
    index = collections.defaultdict(set)
    count = {}
    for k, t in items:
        w = re.findall(r"[^\W\d_]+", t.lower())
        count[k] = max(0, len(w) - 7)
        for i in range(len(w) - 7):
            index[tuple(w[i:i + 8])].add((k, i))
    for d, t in docs:
        w = re.findall(r"[^\W\d_]+", (t or "").lower())
        hit = collections.defaultdict(set)
        for i in range(len(w) - 7):
            for k, j in index.get(tuple(w[i:i + 8]), ()):
                hit[k, i - j].add(j)
        out |= {(d, k) for (k, _), js in hit.items() if len(js) >= 6 or 2 * len(js) >= count[k]}
    return out


def test_leaks_equal_plain_windows(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    docs, items = read("documents").select("doc_id", "text"), read("benchmark")
    got = {(r.doc_id, r.item_id) for r in templates.leaks(docs, items).collect()}
    assert got == plain_leaks([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_leaks_with_other_values(spark, odd, none):
    items = spark.createDataFrame([
        (1, "On Monday the farmer Tom sold 12 sheep to Anna for 30 euros and then Tom bought 12 cows at the market."),
        (2, "short item"), (3, None)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Intro here. On Monday the farmer Bill sold 45 sheep to Maria for 7 euros and then Bill bought 45 cows at the market. End."),
        (2, "On Monday the farmer Bill sold 45 sheep to Maria for 7 euros and then Carl bought 9 cows at the market."),
        (3, "A farmer sold sheep and bought cows."), (4, None), (5, ""), (6, "on MONDAY, the farmer sold")], "doc_id long, text string")
    got = templates.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 1)] and got[0].slots >= 5
    assert sorted(r.doc_id for r in templates.decontaminated(docs, items).collect()) == [2, 3, 4, 5, 6]
    assert templates.leaks(odd, items).count() == 0 and templates.leaks(none, items).count() == 0
    assert templates.leaks(docs, items.limit(0)).count() == 0


def test_leaks_in_other_case_and_lines(spark):
    items = spark.createDataFrame([
        (1, "On Monday the farmer Tom sold 12 sheep to Anna for 30 euros and then Tom bought 12 cows at the market."),
        (2, "Tom has 3 apples and 4 pears in his big bag. Tom buys 5 more pears while Ann and Tom count them all.")], "item_id long, text string")
    text = items.collect()[0].text
    docs = spark.createDataFrame([
        (1, text.replace(" ", "\n")), (2, text.replace(" ", "  ")), (3, text.lower()), (4, text.upper()),
        (5, "Bob has 7 apples and 9 pears in his big bag. Bob buys 6 more pears while Eve and Bob count them all."), (6, "Other words.")],
        "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in templates.leaks(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2)}
    assert all(r.windows == r.item_windows for r in got.values())


def test_leaks_with_a_few_edited_slots(spark):
    text = ("In the village of old stones 12 men carried 12 heavy bags over the long bridge to the mill, where a miller and 30 helpers "
            "ground all of the wheat to flour before 7 carts brought it back to the people who had been waiting there since the early morning.")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, text.replace("12 heavy", "13 heavy")), (2, text.replace("30", "12")), (3, text)], "doc_id long, text string")
    got = {r.doc_id: r.windows for r in templates.leaks(docs, items).collect()}
    assert set(got) == {1, 2, 3} and got[1] < got[3] and got[2] < got[3]


def test_leaks_of_short_and_bare_items(spark):
    sums = "12 + 5 = 17, 8 + 4 = 12, 9 + 9 = 18, 6 + 7 = 13"
    items = spark.createDataFrame([
        (1, "What is the capital of France?"), (2, sums), *[(3, "The small red fox runs over the wide green hill.")] * 3, (4, "?!"), (5, "")],
        "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Quiz: what is the\ncapital of FRANCE? Paris."), (2, f"Sums: {sums}."), (3, "Then the small red fox runs over the wide green hill."),
        (4, "What is the capital of Spain?"), (5, sums.replace("13", "14"))], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in templates.leaks(docs, items).collect()) == [(1, 1), (2, 2), (3, 3)]
    assert sorted(r.doc_id for r in templates.decontaminated(docs, items).collect()) == [4, 5]


def test_leaks_of_one_word_items_are_a_choice(spark):
    items = spark.createDataFrame([(1, "Yes"), (2, "Paris."), (3, "Name the capital of France")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Oh yes, she said."), (2, "Paris is far"), (3, "Please name the capital of France now"), (4, "none")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in templates.leaks(docs, items).collect()} == {(1, 1), (2, 2), (3, 3)}
    assert {(r.doc_id, r.item_id) for r in templates.leaks(docs, items, least_tokens=3).collect()} == {(3, 3)}
    assert sorted(r.doc_id for r in templates.decontaminated(docs, items, least_tokens=3).collect()) == [1, 2, 4]


def plain_spans(docs):
    seen, cuts = {}, collections.defaultdict(set)
    for i, t in sorted(docs):
        parts = spans.sentences(t)
        norm = [" ".join(t[a:b].lower().split()) for a, b in parts]
        _, first, end = spans.runs(t)
        for a, b in sorted(zip(first.tolist(), end.tolist())):
            if seen.setdefault(tuple(norm[a:b]), (i, a)) != (i, a):
                cuts[i] |= set(range(a, b))
    return {i: "".join(t[a:b] for k, (a, b) in enumerate(spans.sentences(t)) if k not in cuts[i]) for i, t in docs}


def test_spans_equal_plain_version(spark, odd, none):
    r = np.random.default_rng(3)
    say = lambda n: " ".join(f"v{r.integers(500)}" for _ in range(n)).capitalize() + "."
    passage = " ".join(say(14) for _ in range(5))
    docs = []
    for i in range(40):
        own = [say(int(r.integers(2, 20))) for _ in range(6)]
        docs.append((i, " ".join(own[:3]) + "\n" + (passage + "\n" if i % 3 == 0 else "") + " ".join(own[3:]) + (" " + own[0] if i % 5 == 0 else "")))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = spans.dedup_spans(df).collect()
    assert {r.doc_id: r.text for r in out} == plain_spans(docs)
    assert [r.doc_id for r in out if passage in r.text] == [0]
    assert all(r.n_removed == 0 for r in out if r.doc_id % 3 or r.doc_id == 0)
    assert spans.dedup_spans(odd).count() == odd.count() and spans.dedup_spans(none).count() == 0


def test_spans_in_scripts_without_spaces(spark):
    zh = "".join(f"今天的天气很好我们去{c}公园里走一走看看花草树木。" for c in "东南西北中山海河湖江林田")
    ja = "".join(f"きのうは{c}の町でともだちと会って長い話をしました。" for c in "東南西北中山")
    th = "\n".join(f"เมื่อวานนี้เราไปเดินเล่นที่สวนสาธารณะ{c}กับเพื่อนและครอบครัว" for c in ("ใหญ่", "เล็ก", "เก่า", "ใหม่"))
    docs = [(k * 10 + d, f"{d}番の文書。{t}\n終わり{d}。") for k, t in enumerate((zh, ja, th)) for d in range(2)]
    docs += [(90, "第一章。目录。"), (91, "第一章。目录。")]  # too short a run to count
    out = {r.doc_id: r for r in spans.dedup_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in out.items()} == plain_spans(docs)
    for k, t in enumerate((zh, ja, th)):
        assert t in out[k * 10].text and t[:20] not in out[k * 10 + 1].text and out[k * 10 + 1].n_removed >= 4
    assert out[90].n_removed == out[91].n_removed == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. !?\n", max_size=60))
def test_sentences_cover_the_text(text):
    parts = spans.sentences(text)
    assert "".join(text[i:j] for i, j in parts) == text
    hashes, first, end = spans.runs(text)
    assert len(hashes) == len(first) and all(0 <= a < b <= len(parts) for a, b in zip(first, end))


def test_spans_of_hostile_white_space():
    import time
    start = time.perf_counter()
    spans.runs("One. " + " " * 1_000_000 + "\n" * 1000 + "Two.")
    assert time.perf_counter() - start < 2


@pytest.mark.parametrize("least,words,long", [(2, 6, 12), (3, 1, 1000), (1, 4, 4)])
def test_shortest_runs_equal_plain(least, words, long):
    """From each sentence the shortest run forward, and to each the shortest back, found by trying all."""
    r = np.random.default_rng(least)
    for _ in range(30):
        sizes = r.integers(1, 9, r.integers(0, 14)).tolist()
        text = " ".join(" ".join(f"w{r.integers(9)}" for _ in range(n)) + "." for n in sizes)
        n = len(sizes)

        def big(i, j):
            total = sum(sizes[i:j])
            return (j - i >= least and total >= words) or total >= long
        want = set()
        for i in range(n):
            want |= {(i, j) for j in [next((j for j in range(i + 1, n + 1) if big(i, j)), None)] if j}
            want |= {(k, i + 1) for k in [next((k for k in range(i, -1, -1) if big(k, i + 1)), None)] if k is not None}
        _, first, end = spans.runs(text, least, words, long)
        assert set(zip(first.tolist(), end.tolist())) == want
