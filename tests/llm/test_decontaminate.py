import hashlib
import random
import re

import pytest
from authweave.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(lowered(text or ""))


def by_hand(text, items, size):
    own, hit, names = words(text), set(), set()
    for item, other in items:
        theirs = words(other)
        for at in range(max(len(theirs) - size, 0) + 1 if theirs else 0):
            window = theirs[at:at + size]
            for i in range(len(own) - len(window) + 1):
                if own[i:i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    names |= {str(item)} - {"None"}
    return len(own), len(hit), sorted(names)


def tables(spark, texts, items):
    docs = spark.createDataFrame(
        [(k, t, "x", i) for i, (k, t) in enumerate(texts)], "doc_id long, text string, n_words string, items int"
    )
    return docs, spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, runs int")


def examples():
    random.seed(5)
    some = lambda n: " ".join(random.choices(["a", "B", "Ünd", "c9", "漢字", "É"], k=n))
    items = [(1, some(9)), (2, some(30)), (10, some(4)), (3, ""), (4, None), (None, some(12)), (5, "A, b"), (5, "a b")]
    items += [(20, items[1][1]), (21, items[1][1].lower())]
    texts = [(None, some(50)), (7, None), (8, ""), (9, "... !"), (9, "... !"), (11, some(2000))]
    for k in range(25):
        cut = words(random.choice(items)[1])
        texts.append((100 + k, f"{some(8)}--{'; '.join(cut)}\n{some(5)} {','.join(cut[3:])}".upper() + some(3)))
    return texts, items


@pytest.mark.parametrize("bound", [decontaminate.SHARE_BYTES, 400])
def test_equals_brute_force(spark, bound):
    texts, items = examples()
    docs, benchmark = tables(spark, texts, items)
    found = decontaminate.find_leaks(docs, benchmark, size=6, bound=bound).collect()
    expected = sorted((str(k), *by_hand(t, items, 6)) for k, t in texts)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in found) == expected
    raw = {k: t for k, t in texts}
    assert sum(len(r.runs) for r in found) > 10
    for row in found:
        for run in row.runs:
            part = raw[row.doc_id][run.start:run.stop]
            assert words(part) == words(raw[row.doc_id])[run.first:run.until] and WORD.match(lowered(part[0]))


@pytest.mark.parametrize("block", [1, 7, 50, 10_000])
def test_blocks_of_a_long_text(monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    texts, items = examples()
    for size in (1, 2, 6):
        cut = [(str(k) if k else None, " ".join(words(t))) for k, t in items if words(t)]
        windows = decontaminate.Windows(cut, size)
        for _, text in texts:
            count, runs, names = windows.scan((text or "").encode())
            assert (count, sum(b - a for a, b in runs), sorted(names)) == by_hand(text, items, size)
            assert all(a[1] < b[0] for a, b in zip(runs, runs[1:]))


def test_empty_tables(spark):
    docs, benchmark = tables(spark, [(1, "a b"), (2, None)], [(1, "a b")])
    none, empty = benchmark.limit(0), docs.limit(0)
    for items in (none, tables(spark, [], [(1, None), (2, "!")])[1]):
        rows = decontaminate.leak_digests(docs, items).orderBy("doc_id").collect()
        blank = hashlib.sha256(b"").hexdigest()
        assert [tuple(r) for r in rows] == [(1, 2, 0, 0, blank, False), (2, 0, 0, 0, blank, False)]
    assert decontaminate.leak_digests(empty, benchmark).count() == 0
    row = decontaminate.leak_digests(docs, benchmark).where("doc_id = 1").first()
    assert tuple(row) == (1, 2, 2, 1, hashlib.sha256(b"1").hexdigest(), True)


def test_pieces_overlap(spark, monkeypatch):
    """An item longer than a piece keeps the windows that lie across two pieces."""
    text = " ".join(f"w{k}" for k in range(2 * decontaminate.PIECE_WORDS + 50))
    docs, benchmark = tables(spark, [(1, text), (2, text[5000:5200])], [(1, text)])
    rows = decontaminate.find_leaks(docs, benchmark).orderBy("doc_id").collect()
    assert rows[0].n_hit == rows[0].n_words and len(rows[0].runs) == 1 and rows[1].n_hit > 20
