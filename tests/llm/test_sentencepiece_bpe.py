import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from authweave.llm import queries, sentencepiece_bpe
from authweave.llm.tables import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "   x  ", "plain words here", "a  b", "\n\ta", "a\0b", "héé 𝄞 \u200b", "<s> </s> <unk> <0x41>",
    "▁a ▁▁b", "é ﬁ Ａ", "x" * 3000, " " * 3000, "漢字かな交じり文", "the" * 700, "…—’ ñandú 12345", "a\u00a0b\u2003c", "\ufeffbom",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return sentencepiece_bpe.PrefixTable(PATH)


def test_equals_the_library(library, own):
    random.seed(2)
    soup = ["".join(random.choices("  abehinorst▁é\n漢9.", k=random.randint(1, 50))) for _ in range(3000)]
    for text in TEXTS + soup:
        ids = library.encode(text)
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids), repr(text)
        assert own.round_trip(text) == (",".join(map(str, ids)), len(ids), library.decode(ids)), repr(text)


def test_decodes_any_ids(library, own):
    random.seed(4)
    for _ in range(500):
        ids = [random.randint(0, 31_999 if random.random() < 0.5 else 258) for _ in range(20)]
        assert own.decode(ids) == library.decode(ids), ids


def test_forgetting_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHED", 3)
    monkeypatch.setattr(sentencepiece_bpe, "PAIRS", 3)
    other = sentencepiece_bpe.PrefixTable(PATH)
    for text in TEXTS:
        assert other.round_trip(text) == own.round_trip(text)


def expected(library, text):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else "")


def test_documents(spark, library):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)] + [(None, "x", 1), (77, None, 1), (0, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in
                  sentencepiece_bpe.digest_documents(docs, PATH).collect()), key=str)
    assert got == sorted(((k or -1, *expected(library, t)) for k, t, _ in rows), key=str)
    ids = {r.doc_id: list(r.ids) for r in sentencepiece_bpe.encode_documents(docs, PATH).collect()}
    assert ids[4] == library.encode(TEXTS[4]) and ids[77] == []
    assert sentencepiece_bpe.digest_documents(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    rows = queries.op10_sentencepiece(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id])
