import re

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_decontaminate import by_hand as passages_by_hand
from test_ngram_join import components_by_hand
from test_packing import check
from tokenizers import Tokenizer

from salestide.llm import quality
from salestide.session import BATCH_BYTES, materialize, use_small_batches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_each_stage_equals_brute_force_on_its_input(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    passed = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        after = materialize(stage(spark, docs, SF), name)
        ids = {r.doc_id for r in after.collect()}
        passed[name] = (len(rows), len(ids))
        if name == "quality_classifier":
            scored = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
            want = {r.doc_id for r in scored if r.predicted == 1}
        elif name == "exact_dedup":
            first = {}
            for key, text in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), key)
            want = set(first.values())
        elif name == "ngram_jaccard_join":
            want = {key for key, _, component in components_by_hand(rows, 5, 80) if key == component}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            short = [(k, t) for k, t in rows if len(t or "") < 2500]
            held = {doc for doc, _ in passages_by_hand(short, items)}
            assert held.isdisjoint(ids) and {k for k, _ in short} - held <= ids
            want = ids
        else:
            check(after.collect(), dict(rows), plain, 1024)
            want = ids
        assert ids == want, name
        if name != "best_fit_packing":
            assert after.columns == columns and after.count() == len(ids)
        docs = after
    assert all(a > b for (a, b), name in zip(passed.values(), passed) if name in ("quality_classifier", "ngram_jaccard_join", "decontamination"))


def test_run_gives_the_pieces_of_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_odd_documents_pass_every_stage(spark, tmp_path):
    rows = [
        (1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (None, "a b c", "en", None, 3, 3), (4, "x " * 50_000, "en", "s", 100_000, 4),
        (5, "one two three four five six seven", "en", "s", 33, 5), (5, "one two three four five six seven", "en", "s", 33, 5),
        (6, "one two  three four five six SEVEN", "en", "s", 33, 6), (7, "\x00 \x1f", "en", "s", 3, 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long")
    spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            table = materialize(stage(spark, table, str(tmp_path)), name)
            assert table.columns == docs.columns
        pieces = corpus_pipeline.pack_sequences(spark, table, str(tmp_path)).collect()
        assert {r.doc_id for r in pieces} == {r.doc_id for r in table.collect()}


def test_stages_hold_few_bytes_of_wide_rows_at_once(spark):
    own = spark.newSession()
    corpus_pipeline.drop_near_copies(own, own.createDataFrame([(1, "a b c")], "doc_id long, text string"), SF)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    wide = own.range(0, 4000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 500).alias("text"))
    found = [r.bytes for r in wide.mapInArrow(sizes, "bytes long").collect()]
    assert sum(found) > 3 * BATCH_BYTES and max(found) <= BATCH_BYTES + 10_000
    chosen = spark.newSession()
    chosen.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "12345")
    assert use_small_batches(chosen).conf.get("spark.sql.execution.arrow.maxBytesPerBatch").startswith("12345")
