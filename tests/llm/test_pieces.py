"""Batches cut by bytes keep all rows in order."""

import pyarrow as pa

from longitab.llm import common, records
from longitab.llm.queries import vocabulary


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])


def test_pieces_keep_rows_in_order():
    texts = ["a" * 400_000, None, "", "b" * 3_000_000, "c"] * 7
    rows = batch(texts)
    some = list(common.pieces(rows, 1))
    assert len(some) > 7
    assert [i for p in some for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert [t for p in some for t in p.column(1).to_pylist()] == texts


def test_pieces_of_nothing_and_of_nulls():
    assert list(common.pieces(batch([]), 1)) == []
    assert [p.num_rows for p in common.pieces(batch([None, None]), 1)] == [2]


def test_pieces_bound_what_short_rows_hold():
    rows = batch(["x" * 1000] * 5000)
    assert max(sum(len(t) for t in p.column(1).to_pylist()) for p in common.pieces(rows, 1)) <= common.PIECE + 1000


def test_released_passes_all_batches_on():
    assert list(common.released(lambda batches: (b * 2 for b in batches))(iter([1, 2, 3]))) == [2, 4, 6]


def test_records_are_encoded_a_megabyte_at_a_time():
    texts = pa.array(["x" * 1000] * 10_000)
    runs = list(records.blocks(texts))
    assert [at for at, _ in runs] == [sum(n for _, n in runs[:k]) for k in range(len(runs))]
    assert sum(n for _, n in runs) == len(texts)
    assert max(n for _, n in runs) * 1000 <= (1 << 20) + 1000


def test_workers_get_few_rows_and_the_session_is_as_before(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = spark.range(0, 25, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    with common.batches_of(spark, 10):
        assert [r.n for r in sizes.collect()] == [10, 10, 5]
        with common.batches_of(spark, 100):  # never more than was asked for
            assert spark.conf.get(key) == "10"
    assert spark.conf.get(key) == before


def test_records_ask_for_few_texts_and_one_file_at_a_time(spark, monkeypatch):
    asked = []
    real = common.batches_of
    monkeypatch.setattr(records, "batches_of", lambda s, n: asked.append(n) or real(s, n))
    docs = spark.createDataFrame([(1, "one"), (2, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in records.tokenized(docs, vocabulary("word_bpe_49k.json")).collect()) == [1, 2]
    assert asked == [common.BATCH_ROWS, 1]


def test_marks_that_are_a_word_and_follow_one_are_learnt_once():
    of = records.Encoder(vocabulary("word_bpe_49k.json"))
    texts = ["... wait... no", "more words, and others", "É. İx. Ⱥ! Kelvin 3.5... ab_ _", "", "... É again"]
    want = [of.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for t in texts for x in of.encode(pa.array([t]))] == want
    assert [x.tolist() for x in of.encode(pa.array(texts))] == want


def test_a_worker_loads_the_tokenizer_once_for_all_its_tasks():
    path = vocabulary("word_bpe_49k.json")
    first, second = records.Encoder(path), records.Encoder(path)
    assert first.whole is second.whole
    first.encode(pa.array(["some words"]))
    assert list(second.known) == [""]  # the words are the task's own


def test_known_words_stay_few(monkeypatch):
    monkeypatch.setattr(records, "CACHED_WORDS", 50)
    of = records.Encoder(vocabulary("word_bpe_49k.json"))
    texts = [" ".join(f"w{k}x{i}." for i in range(40)) for k in range(20)]
    assert [x.tolist() for t in texts for x in of.encode(pa.array([t]))] == [of.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(of.known) <= 50 + 2 * 40


def sizes_of_batches(spark):
    rows = spark.range(0, 1500, 1, 1).selectExpr("id", "repeat('x', if(id = 700, 3000000, 3000)) as text")
    count = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.get_total_buffer_size()])], ["n", "size"]) for b in batches), "n long, size long")
    return [(r.n, r["size"]) for r in count.collect()]


def test_workers_get_a_megabyte_at_a_time_and_the_session_is_as_before(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with common.batch_bytes(spark):
        sizes = sizes_of_batches(spark)
    assert spark.conf.get(key) == before
    assert sum(n for n, _ in sizes) == 1500
    assert sorted(s for _, s in sizes)[-2] <= common.BATCH_BYTES + 100_000


def test_the_pipelines_python_stages_get_a_megabyte_at_a_time(spark):
    import corpus_pipeline
    keys = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = [spark.conf.get(k) for k in keys]
    try:
        corpus_pipeline._in_python()(lambda spark, docs, sf_dir: docs)(spark, None, "")
        assert len(sizes_of_batches(spark)) >= 4
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_texts_go_to_the_encoder_a_megabyte_at_a_time(spark, monkeypatch):
    asked = []
    real = records.batch_bytes
    monkeypatch.setattr(records, "batch_bytes", lambda s: asked.append(s) or real(s))
    docs = spark.createDataFrame([(1, "one"), (2, None)], "doc_id long, text string")
    assert records.tokenized(docs, vocabulary("word_bpe_49k.json")).count() == 2
    assert asked == [spark]
