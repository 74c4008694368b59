import random
import re

import numpy as np
import pytest
from authweave.llm import ngram_join


def shingles(text, words=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def by_hand(rows, percent=75):
    sets = [(k, shingles(t)) for k, t in rows]
    group = {k: k for k, s in sets if k is not None}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is None or b is None or not s or not t:
                continue
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return sorted(((k, len(s), None if k is None else root(k)) for k, s in sets), key=str)


def run(spark, rows, percent=75):
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n long, node string")
    found = ngram_join.near_duplicates(frame, percent=percent).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


def corpus(seed, groups, copies, words=60, vocabulary=400):
    random.seed(seed)
    word = lambda: f"w{random.randrange(vocabulary)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(random.randint(1, words))]
        if random.random() < 0.5:
            base[random.randrange(len(base)):0] = passage[random.randrange(30):]
        for _ in range(random.randint(1, copies)):
            text = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
                text[random.randrange(len(text))] = word()
            texts.append(random.choice([" ", "\n", "  "]).join(text).title())
    random.shuffle(texts)
    return texts


EDGES = [None, "", " \n", "one", "ONE", "one two", "a b c d", "a b c d e", "a b c d e f", "é É", "É é", "x " * 3000,
         "one", "a b c", "tab\tand\x0bvt\x0cff\x1cfs"]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = list(enumerate(EDGES + corpus(seed, 60, 6)))
    rows += [(None, "one"), (None, EDGES[8]), (8, EDGES[8]), (900, rows[30][1])]
    assert run(spark, rows) == by_hand(rows)


def test_long_lists_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", 3)
    monkeypatch.setattr(ngram_join, "COSTS", (2, 6))
    monkeypatch.setattr(ngram_join, "COUNTERS", 1 << 17)
    rows = list(enumerate(corpus(3, 25, 25, words=30, vocabulary=60)))
    assert run(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("percent", [50, 100])
def test_other_thresholds(spark, percent):
    rows = list(enumerate(corpus(4, 30, 5)))
    assert run(spark, rows, percent) == by_hand(rows, percent)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_more_matches_lengthen_the_prefix():
    texts = [" ".join(f"{d}{k}" for k in range(104)).encode() for d in "abc"]
    made = ngram_join.Shingles(texts, 5)
    levels = np.zeros(1 << 20, np.uint8)
    places, matches = ngram_join.prefixes(made, levels, 75)
    assert matches.tolist() == [1, 1, 1] and len(places) == 3 * (100 - 75 + 1)
    levels[(made.token[made.doc == 1] & np.uint64((1 << 20) - 1)).astype(int)] = 12
    places, matches = ngram_join.prefixes(made, levels, 75)
    assert matches.tolist() == [1, 3, 1]
    assert np.bincount(made.doc[places]).tolist() == [26, 28, 26]


def test_long_lists_in_blocks_lose_nothing(spark, monkeypatch):
    for name, value in {"SHORT": 2, "BLOCK": 3, "HOT": 2, "COSTS": (2, 6), "COUNTERS": 1 << 17, "PAIRS_HELD": 5}.items():
        monkeypatch.setattr(ngram_join, name, value)
    rows = list(enumerate(corpus(5, 20, 20, words=30, vocabulary=60)))
    assert run(spark, rows) == by_hand(rows)


def template(own: int, count: int) -> list[str]:
    shared = " ".join(f"s{k}" for k in range(100 - own))
    return [shared + " " + " ".join(f"d{d}w{k}" for k in range(own)) for d in range(count)]


def test_template_documents_make_no_pairs():
    made = ngram_join.Shingles([t.encode() for t in template(20, 60)], 5)
    levels = np.zeros(1 << 20, np.uint8)
    np.add.at(levels, (made.token & np.uint64((1 << 20) - 1)).astype(int), 1)
    places, matches = ngram_join.prefixes(made, levels, 75)
    doc = made.doc[places]
    number = np.bincount(doc)
    entries = np.empty(len(places), ngram_join.ENTRY)
    entries["token"], entries["node"] = made.token[places], doc
    entries["n"], entries["m"] = made.size[doc], matches[doc]
    entries["at"] = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    assert len(np.unique(entries["token"])) < len(entries)  # the template is in the prefixes
    n, at, m = ngram_join._places(entries)
    often = np.isin(entries["token"], [t for t, k in zip(*np.unique(entries["token"], return_counts=True), strict=True) if k > 1])
    assert not (ngram_join.reach(n, at, m, 75) >= n)[often].any()


def test_template_documents_in_long_lists(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows = list(enumerate(template(20, 50) + template(9, 40)))
    assert run(spark, rows) == by_hand(rows)


def test_mirrored_words_are_different(spark):
    """Words on which any polynomial hash modulo 2^64 collides."""
    one, other = "a", "b"
    for _ in range(11):
        one, other = one + other, other + one
    rows = [(1, one), (2, other), (3, f"{one} x y z w v"), (4, f"{other} x y z w v"), (5, one.upper())]
    assert run(spark, rows) == by_hand(rows)


def test_sets_with_one_first_name_stay_apart(spark):
    rows = list(enumerate(EDGES + corpus(7, 60, 4)))
    frame = spark.createDataFrame([(k, t) for k, t in rows], "doc_id long, text string")
    found = ngram_join.near_duplicates(frame, name_bits=5).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == by_hand(rows)


def test_a_large_group_of_near_copies(spark):
    """All pairs of the group are similar; few of them are needed to connect it."""
    random.seed(11)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(150):
        text = list(base)
        for _ in range(3):
            text[random.randrange(120)] = f"x{random.randrange(10**6)}"
        texts.append(" ".join(text))
    rows = list(enumerate(texts + template(20, 40)))
    assert run(spark, rows) == by_hand(rows)


def test_signatures_rule_out_only_what_is_too_different():
    random.seed(21)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for changes in [0, 1, 2, 3, 4, 5, 8, 12, 30] * 3:
        text = list(base[:random.choice([60, 110, 120])])
        for _ in range(changes):
            text[random.randrange(len(text))] = f"x{random.randrange(10**6)}"
        texts.append(" ".join(text))
    made = ngram_join.Shingles([t.encode() for t in [*texts, "", "a b"]], 5)
    signs = ngram_join.folded(made.signatures(), ngram_join.SIGN_WORDS[0])
    i, j = np.triu_indices(len(made.size), 1)
    kept = ngram_join.near_enough(made.size[i], signs[i], made.size[j], signs[j], 75)
    sets = [set(made.token[made.doc == d].tolist()) for d in range(len(made.size))]
    alike = np.array([100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a, b in zip(i, j, strict=True)])
    assert kept[alike].all() and 0 < alike.sum() < kept.sum() < len(kept) * 0.7


def entries_of(texts):
    made = ngram_join.Shingles([t.encode() for t in texts], 5)
    levels = np.zeros(1 << 20, np.uint8)
    np.add.at(levels, (made.token & np.uint64((1 << 20) - 1)).astype(int), 1)
    places, matches = ngram_join.prefixes(made, levels, 75)
    doc = made.doc[places]
    number = np.bincount(doc)
    entries = np.empty(len(places), ngram_join.ENTRY)
    entries["token"], entries["node"], entries["n"], entries["m"] = made.token[places], doc, made.size[doc], matches[doc]
    entries["at"] = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    return entries, np.zeros(1 << 20, np.uint8)


def test_template_documents_are_not_tried_with_each_other():
    """Their common tokens stand too late in the sets for any two to be similar enough."""
    entries, levels = entries_of(template(20, 60))
    pairs, long, star, center, chain = ngram_join.meet(entries, 75, levels)
    assert len(long) and not len(pairs) and not star.size and not chain.size
