"""Hard negatives, packing and the source audit against plain versions."""

import collections
import re
import zlib

import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plans import plan
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from longitab.llm import bytebpe, divergence, negatives, packing
from longitab.llm import queries as q
from longitab.llm.common import batches_of
from longitab.session import stage, unstage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spanning_tree", "op13_iceberg_audit"])
def test_query_equals_sql(spark, name):
    assert oracle.compare(q.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), q.SQL[name]) is None


# --- hard negatives

ROWS = "vec_id long, embedding array<double>, label string, id int, block int, score int"


def plain_negatives(rows, is_anchor, n_pos=5, n_neg=5, low=80):
    good = [(i, lab, [int(np.floor(256 * c)) for c in v]) for i, v, lab, *_ in rows
            if i is not None and lab is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for i, lab, a in {(i, lab, tuple(v)) for i, lab, v in good if is_anchor(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, other == lab) for j, other, v in good if j != i and len(v) == len(a))
        for s, j, _ in [x for x in scored if x[2]][:n_pos]:
            hard = [(t, k) for t, k, same in scored if not same and low * -s <= 100 * -t <= 100 * -s][:n_neg]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(hard, 1)]
    return sorted(out)


def clustered(seed=3, n=400):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, 8))
    rows = [(i, (centres[i % 4] + r.normal(scale=0.05, size=8)).tolist(), "abc"[r.integers(3)], 1, 1, 1) for i in range(n)]
    odd = [(n, rows[0][1], None), (n + 1, None, "a"), (None, rows[0][1], "a"), (n + 2, [1.0, None] * 4, "a"), (n + 3, [float("inf")] * 8, "a"),
           (n + 4, [float("nan")] * 8, "b"), (n + 5, [0.0] * 8, "a"), (n + 6, [0.5, -1.0], "a"), (n + 7, [0.5, -0.5], "b"), (n + 8, [], "a"),
           (n + 9, rows[5][1], "b"), (n + 9, rows[5][1], "b"), (0, rows[0][1], rows[0][2]), (n + 10, rows[0][1], "c")]
    return rows + [(*o, 1, 1, 1) for o in odd]


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 90)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rows = clustered()
    df = spark.createDataFrame(rows, ROWS)
    got = negatives.mine(df, df.where("vec_id % 8 = 0"))
    want = plain_negatives(rows, lambda i: i % 8 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 300
    got = negatives.mine(df, df.where("vec_id % 8 = 0"), 3, 2, low=99)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda i: i % 8 == 0, 3, 2, 99)


def test_negatives_send_nothing_through_the_driver(spark, monkeypatch):
    """However small the packed blocks look to Spark, no step broadcasts them."""
    monkeypatch.setattr(negatives, "SHARD", 60)
    monkeypatch.setattr(negatives, "BLOCK", 8)
    plans = []
    monkeypatch.setattr(negatives, "stage", lambda df: (plans.append(plan(df)), stage(df))[1])
    rows = clustered()
    df = spark.createDataFrame(rows, ROWS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        got = negatives.mine(df, df.where("vec_id % 8 = 0"))
        assert not [p for p in [*plans, plan(got)] if "Broadcast" in p]
        assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda i: i % 8 == 0)
        assert "Broadcast" not in plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_best_equals_sorting():
    r = np.random.default_rng(2)
    best, every = negatives.Best(3), []
    for _ in range(40):
        n = int(r.integers(0, 900))
        part = (r.integers(0, 50, n), r.integers(0, 10 ** 6, n), r.integers(-5, 5, n))
        best.add(*part)
        every += zip(*(c.tolist() for c in part))
    want = []
    for key in range(50):
        want += sorted((x for x in every if x[0] == key), key=lambda x: (-x[2], x[1]))[:3]
    assert list(zip(*(c.tolist() for c in best.kept()))) == want
    assert [len(c) for c in negatives.Best(3).kept()] == [0, 0, 0]


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame(clustered(n=20), ROWS)
    assert negatives.mine(df.limit(0), df.limit(0)).isEmpty()
    assert negatives.mine(df, df.limit(0)).isEmpty()
    assert negatives.mine(df.limit(0), df).isEmpty()


def test_long_vectors(spark):
    rows = [(0, [3e6, 1.0], "a"), (1, [2e6, 5.0], "a"), (2, [1.9e6, 1.0], "b"), (3, [1.9e6, 1.5], "b")]
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], ROWS)
    want = plain_negatives([(*r, 1, 1, 1) for r in rows], lambda i: i == 0)  # scores beyond 2^53
    assert sorted(tuple(r) for r in negatives.mine(df, df.where("vec_id = 0")).collect()) == want and len(want) == 2
    with pytest.raises(Exception, match="too long"):
        negatives.mine(df.withColumn("embedding", F.array(F.lit(1e300), F.lit(1.0))), df).collect()


def packed(rows):
    ids, labels, x = (np.array([r[k] for r in rows], dtype=kind) for k, kind in ((0, np.int64), (1, object), (2, np.int64)))
    return ids, labels, x


def test_bounds_hold_and_spare_work():
    r = np.random.default_rng(1)
    centres = r.normal(size=(3, 6))
    rows = [(i, "ab"[i % 2], np.floor(256 * (centres[i % 3] + r.normal(scale=0.02, size=6)))) for i in range(600)]
    shard = negatives.Shard(packed(rows))
    anchors = packed(rows[:60])[2]
    bounds = negatives.Bounds(shard, anchors)
    for row, parent, distance in negatives.tree(anchors):
        bounds.widened(row, parent, distance)
        exact = shard.x @ anchors[row]
        assert (bounds.lo[row] <= exact).all() and (exact <= bounds.hi[row]).all()
        bounds.rescored(row, np.arange(0, 600, 2) if row != parent else np.arange(600))
    block = (*packed(rows[:60]), negatives.tree(anchors))
    compared = []
    was = negatives.Bounds.rescored
    negatives.Bounds.rescored = lambda self, row, some: (compared.append(len(some)), was(self, row, some))[1]
    try:
        list(negatives.positives(shard, block, 5))
    finally:
        negatives.Bounds.rescored = was
    assert sum(compared) < 0.6 * 60 * 299


# --- packing

@given(st.lists(st.integers(1, 20), max_size=12), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_closest_equals_brute_force(lengths, room):
    counts = collections.Counter(lengths)
    sums = {0}
    for k in lengths:
        sums |= {s + k for s in sums if s + k <= room}
    best, chosen = packing.closest(counts, sorted(counts, reverse=True), room)
    assert best == max(sums) == sum(k * n for k, n in chosen.items())
    assert all(n <= counts[k] for k, n in chosen.items())


@given(st.dictionaries(st.integers(1, 31), st.integers(1, 9), max_size=9))
@settings(max_examples=100, deadline=None)
def test_pool_fills_every_window(counts):
    pool = packing.Pool(32)
    for doc, k in enumerate(k for k, n in counts.items() for _ in range(n)):
        pool.add(doc, 0, np.arange(k))
    total = pool.tokens
    full, rest = list(pool.fill(0)), list(pool.last())
    assert all(sum(len(p[2]) for p in pieces) == 32 for pieces in full) and len(full) == total // 32
    sizes = [sum(len(p[2]) for p in pieces) for pieces in rest]
    assert sum(sizes) == total % 32 and all(s & (s - 1) == 0 for s in sizes) and len(set(sizes)) == len(sizes)
    seen = sorted((p[0], int(i)) for pieces in full + rest for p in pieces for i in p[2])
    assert seen == sorted((doc, i) for doc, k in enumerate(k for k, n in counts.items() for _ in range(n)) for i in range(k))


def check_packing(df, sequences, size, end_id, id_col="doc_id"):
    whole = Tokenizer.from_file(VOCABULARY)
    want = collections.Counter((i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, end_id]))
                               for i, t in df.select(id_col, "text").collect())
    rows = packing.pieces_of(sequences).withColumn("crc", F.crc32("ids")).collect()
    by_seq = collections.defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["crc"] == zlib.crc32(r["ids"])
        by_seq[r["sequence_id"]].append(r)
    for s in sequences.collect():
        at = 0
        for r in sorted(by_seq[s["sequence_id"]], key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == s["n_tokens"] and (at == size or at & (at - 1) == 0)
    assert len({s["sequence_id"] for s in sequences.collect()}) == sequences.count()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r[id_col]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    single = {i for i, _ in df.select(id_col, "text").collect() if sum(1 for j, _ in want.elements() if j == i) == 1}
    for i, ids in want.elements():
        if i in single:
            parts = sorted(by_doc[i])
            assert [x for _, p, _ in parts for x in p] == list(ids)
            assert [start for start, _, _ in parts] == np.cumsum([0, *[len(p) for _, p, _ in parts]])[:-1].tolist()
            assert {n for _, _, n in parts} == {len(ids)}
    assert sum(len(ids) for _, ids in want.elements()) == sum(r["length"] for r in rows)


def test_packing_odd_documents(odd):
    df = odd.withColumn("sequence_id", F.lit(1)).withColumn("ids", F.lit("x")).repartition(3).cache()
    check_packing(df, packing.pack(df, VOCABULARY), 1024, 0)
    check_packing(df, packing.pack(df, VOCABULARY, size=48, end_id=7), 48, 7)


def test_packing_whole_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sequences = packing.pack(df, VOCABULARY)
    check_packing(df, sequences, 1024, 0)
    pieces = packing.pieces_of(sequences).groupBy("doc_id").agg(F.count("*").alias("n"), F.first("doc_tokens").alias("t"))
    cut = pieces.agg(F.sum(F.col("n") - F.ceil(F.col("t") / 1024))).first()[0]
    assert cut < 0.4 * df.count()  # cut more often than their length asks: the last windows of a small table
    got = q.QUERIES["op12_bin_slack"](spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 0


def test_packing_nothing_and_names(none, spark):
    assert packing.pack(none, VOCABULARY).isEmpty()
    named = spark.createDataFrame([("a", "one two"), (None, None)], "sequence_id string, text string")
    check_packing(named.withColumnRenamed("sequence_id", "key"), packing.pack(named.withColumnRenamed("sequence_id", "key"), VOCABULARY, id_col="key"), 1024, 0, "key")


LETTERS = "abcstdmrevl'' \n\t  \r.,!19²½ßéÉ×÷ªµ\xa0\x85\x1c\x1f\x00ɏǅ-_$"
PARTS = [*LETTERS, "'s", "'ll", " '", "  ", "漢", "́", "\U0001f600", "<|endoftext|>", "<|", " \n", "Ж"]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=20))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_tokenizer(texts):
    of = packing.encoder(VOCABULARY)
    ids, sizes = of.encode(texts)
    want = [of.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHED_BYTES", 10)
    of = bytebpe.Encoder(VOCABULARY)
    for text in ("one two three four", "five six one two", "", "seven"):
        assert of.encode([text])[0].tolist() == of.whole.encode(text).ids


# --- source audit

def plain_audit(docs, least=10, best=10):
    terms = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in
                                         re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for lang, source, text in docs]
    seen, counts = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, ts in terms:
        seen[lang].update(set(ts))
        counts[lang, source].update(ts)
    out = []
    for lang in {t[0] for t in terms}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        sources = sorted({s for a, s, _ in terms if a == lang})

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(counts[lang, s]) for s in sources}
        q_ = shares(sum((counts[lang, s] for s in sources), collections.Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            own = [(-gap(p[s][t], q_[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q_[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(own)[:best])):
                out += [(lang, s, part, item.decode(), -v, r) for r, (v, item) in enumerate(rows, 1)]
    return sorted(out)


def audit_documents():
    r = np.random.default_rng(11)
    long_ = "x" * 70
    words = [f"{a}{b}" for a in ("pre", "prefix", "p", "Prefixes", "über", "straße", "漢字", "abcd", "abcde") for b in ("", "a", "bc", "été")]
    words += [long_, long_ + "y", long_ + "z" * 40, "KK", "İx", "O'Neil", "a1b2", "\U0001f600́"]
    docs = []
    for i in range(160):
        n = int(r.integers(0, 30))
        docs.append((["en", "de", "fr", None][i % 4], ["a", "b", None, "é"][int(r.integers(4))],
                     " ".join(words[int(k)] for k in r.zipf(1.3, n) % len(words)) + f" {long_}y" * (i % 8 == 0)))
    docs += [("en", "rare", None), ("en", "rare", ""), ("xx", "one", "lonely words"), ("yy", "s", None), ("yy", "t", "some"), ("", "", "both")]
    return docs + docs[:8] + [("de", "long", " ".join(f"w{i % 997}" for i in range(30_000)))]


def test_audit_equals_brute_force(spark):
    docs = audit_documents()
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    df = df.withColumns({c: F.lit(1) for c in ("term", "n", "v", "rank", "item", "p")})
    for least in (10, 1, 25):
        got = sorted(tuple(r) for r in divergence.audit(df, least=least).collect())
        assert got == plain_audit(docs, least)
    assert any(len(t[3]) > 64 for t in plain_audit(docs, 10))


def test_audit_of_odd_documents(odd, none):
    docs = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in divergence.audit(odd, least=2).collect()) == plain_audit(docs, 2)
    assert divergence.audit(none).isEmpty()


def test_audit_sums_counts_before_they_leave_a_worker(spark):
    docs = spark.range(0, 100, 1, 1).selectExpr("if(id % 2 = 0, 'en', 'de') lang", "'a' source", "concat('same words w', char(97 + id % 3)) text")
    with batches_of(spark, 10):
        stored = stage(divergence._bags(docs))
        table = spark.sparkContext.broadcast(b"\xff" * (divergence.MARKS // 8))
        for rows, key, n in ((divergence._nodes(stored, divergence.FIRST, None), ["lang", "node", "complete"], "docs"),
                             (divergence._cells(stored, table), ["lang", "source", "term"], "n")):
            got = rows.collect()
            assert stored.count() == 10 and len(got) == len({tuple(r[k] for k in key) for r in got}) == 10
            assert sum(r[n] for r in got) == 300
            # no second shuffle sums them
            assert plan(rows.groupBy(*key).agg(F.sum(n))).count("Exchange hashpartitioning") == 1
        unstage(stored)


def test_audit_deals_documents_by_group(spark, monkeypatch):
    seen, make = [], divergence._bags
    monkeypatch.setattr(divergence, "_bags", lambda docs: seen.append(docs) or make(docs))
    docs = spark.range(0, 4000, 1, 8).selectExpr("'en' lang", "concat('s', id % 8) source", "concat('same words ', repeat(uuid(), 3)) text")
    size, merge = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (size, merge)}
    for source, pairs, conf in (("source", 56, {merge: "false"}), ("'one' source", 0, {size: "4k"})):
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            assert divergence.audit(docs.selectExpr("lang", source, "text")).where("part = 'pair'").count() == pairs
            at = {}
            for name, k, _ in seen.pop().select("source", F.spark_partition_id(), "text").collect():
                at.setdefault(name, set()).add(k)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        # a group is in one task, a large one in several
        assert len(set().union(*at.values())) > 1
        assert pairs == 0 or all(len(x) == 1 for x in at.values())


def test_marks_come_in_one_job(spark):
    rows = spark.range(500).selectExpr("'en' lang", "encode(concat('w', id), 'utf-8') name")
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")  # so that no partitions are merged
        seen = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        table = divergence.marks(rows, "lang", "name")
        assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - seen) == 1
    finally:
        spark.conf.set(key, before)
    assert 490 <= sum(x.bit_count() for x in table) <= 500


@pytest.mark.parametrize("texts", [["b a  b", "", "É a9A", " "], ["", " "], [f"w{k} w" for k in range(50_000)], ["same " * 3] * 3])
def test_bags_ascend(texts):
    texts = ["left out"] + texts + ["as is this"]
    doc, term, n, terms = divergence.bags(pa.array(texts, pa.string()).slice(1, len(texts) - 2))
    terms = terms.to_pylist()
    assert terms == sorted(set(terms))
    rows = list(zip(doc.tolist(), [terms[k] for k in term], n.tolist()))
    want = [collections.Counter(t.encode().translate(divergence.BYTES).split()) for t in texts[1:-1]]
    assert rows == [(i, t, c[t]) for i, c in enumerate(want) for t in sorted(c)]


@pytest.mark.parametrize("length", [1, 4, 8])
def test_prefixes_of_ascending_terms(length):
    terms = sorted([b"", b"a", b"abcd", b"abcde", b"abcdefgh", b"abcdefghi", b"abd", "é".encode(), "éa".encode(), b"\xff" * 9])
    for some in (terms, terms[:1], []):
        at, names = divergence.prefixes(pa.array(some, pa.binary()), length)
        assert [names[int(k)].as_py() for k in at] == [x[:length] for x in some]
        assert names.to_pylist() == sorted({x[:length] for x in some})


def test_merged_counts(monkeypatch):
    blocks = [([("en", "a"), ("", "b")], np.array([0, 1, 1]), pa.array([b"x", b"x", b"y"]), np.array([1, 2, 3])),
              ([], np.zeros(0, int), pa.array([], pa.binary()), np.zeros(0, int)),
              ([("", "b"), ("en", "a")], np.array([0, 0, 1]), pa.array([b"y", b"", b"x"]), np.array([10, 20, 2**40]))]
    want = {("en", "a", b"x"): 1 + 2**40, ("", "b", b"x"): 2, ("", "b", b"y"): 13, ("", "b", b""): 20}
    for rows, size, parts in ((1_000_000, 1 << 26, 4), (3, 1 << 26, 6), (1_000_000, 1, 6)):
        monkeypatch.setattr(divergence, "MERGED", rows)
        monkeypatch.setattr(divergence, "MERGED_BYTES", size)
        monkeypatch.setattr(divergence, "SENT", 1)
        out, seen = collections.Counter(), 0
        for (a, b), name, n in divergence.merged(iter(blocks)):
            assert len(n) == 1
            seen += 1
            out[a[0].as_py(), b[0].as_py(), name[0].as_py()] += n[0].as_py()
        assert dict(out) == want and seen == parts
    assert list(divergence.merged(iter([]))) == []


@pytest.mark.parametrize("size, top", [(0, 5), (1000, 50), (1000, 10**6), (1000, 2**61)])
def test_numbered_and_summed_keys(size, top):
    r = np.random.default_rng(1)
    keys, n = r.integers(0, top, size), r.integers(1, 9, size)
    want = collections.Counter()
    for k, x in zip(keys.tolist(), n.tolist()):
        want[k] += x
    found, place = divergence.numbered(keys, top)
    assert found.tolist() == sorted(want) and found[place].tolist() == keys.tolist()
    key, total = divergence.summed(keys, n)
    assert list(zip(key.tolist(), total.tolist())) == sorted(want.items())


@pytest.mark.parametrize("size, top", [(0, 5), (1000, 50), (1000, 10**6)])
def test_tallied_keys(size, top):
    keys = np.random.default_rng(1).integers(0, top, size)
    key, n = divergence.tallied(keys, top)
    assert list(zip(key.tolist(), n.tolist())) == sorted(collections.Counter(keys.tolist()).items())


def test_sums_beyond_doubles_are_exact():
    n = np.array([2**53, 1, 1, 2**53 - 1])
    key, total = divergence.summed(np.array([0, 0, 1, 1]), n)
    assert key.tolist() == [0, 1] and total.tolist() == [2**53 + 1, 2**53]


def test_shares_at_the_edge_of_64_bits(spark):
    rows = [(divergence.SMALL + k, divergence.SMALL * 2 + 7) for k in (-1, 0, 1)] + [(0, 3), (5, None)]
    got = spark.createDataFrame(rows, "n long, den long").select(divergence._share(F.col("n"), F.col("den"))).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 2) // den if den else None for n, den in rows]


def test_shares_are_exact_for_large_counts(spark):
    n, den = 9_123_456_789_012_345, 9_999_999_999_999_999
    df = spark.createDataFrame([(n, den)], "n long, den long")
    assert df.select(divergence._share(F.col("n"), F.col("den"))).first()[0] == 1 + 10**9 * (n + 2) // den
