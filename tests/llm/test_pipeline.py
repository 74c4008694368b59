import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from authweave.llm import toxicity
from authweave.llm.tables import table
from test_ngram_join import by_hand as copies
from test_suffix_dedup import by_hand as repeats
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "suffix_dedup", "packing"]


def test_equals_brute_force(spark):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    toxic = {r.doc_id for r in toxicity.judge(documents, labels).collect() if r.predicted}
    rows = [(r.doc_id, r.text) for r in documents.collect() if r.doc_id not in toxic]
    kept = {k for k, _, group in copies(rows) if k == group}
    rows = [r for r in rows if r[0] in kept]
    texts = [r[4] for r in repeats([t for _, t in rows], 200)]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for (doc, _), text in zip(rows, texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.add((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == want and len(found) == len(want)
    assert toxic and len(kept) < 1000 - len(toxic)


def test_stages_keep_columns_of_any_name(spark):
    names = ["prediction", "score", "predicted", "_key", "_spans", "n_bytes", "row", "node", "component", "a.b"]
    docs = spark.createDataFrame(
        [(k, f"a text of its own {k} " * 9, "en", "s", 9) for k in range(4)] * 2, SCHEMA
    ).select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        rows = out.collect()
        assert rows and all([row[n] for n in names] == list(range(len(names))) for row in rows), name
    assert corpus_pipeline.pack(spark, docs, FOLDER).count() == 8


def test_stages_take_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c d e f", "en", None, 11),
            (3, "A b c d e f", "en", "s", 11), (None, "a b c d e f", "en", "s", 11), (4, "word " * 20_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        out.collect()
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()}
    assert left == {None, 1, 2, 4}
    rows = [(7, "one two three four five six", "en", "s", 1), (7, "nothing like the text before it here", "en", "s", 2),
            (8, "nothing like the text before it here", "en", "s", 3), (9, "One two three four five  six", "en", "s", 4),
            (3, "nothing like the others but alone", "en", "s", 5), (7, "", "en", "s", 6), (7, None, "en", "s", 7)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), FOLDER).collect()
    assert sorted(r.n_chars for r in kept) == [1, 2, 5, 6, 7]  # two texts under one id, and what has no words
    packed = corpus_pipeline.pack(spark, docs, FOLDER).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
