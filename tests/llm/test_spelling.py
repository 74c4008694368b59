import random
import re
import zlib
from collections import Counter

from authweave.llm import spelling
from authweave.llm.tables import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n int"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(rows, least, twice, every, times):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= twice}
    form, out = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if near(w, o))
        form[w] = others[0][1] if others and -others[0][0] >= times * n else None
        out[w] = (n, len(others), form[w], counts.get(form[w]))
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], SCHEMA)
    found = spelling.group_variants(docs, **options).collect()
    expected = by_hand(rows, **options)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == expected
    assert len(found) == len(expected)
    return expected


def test_pairs_equal_brute_force(spark):
    random.seed(3)
    names = {"".join(random.choices("abé", k=random.randint(2, 8))) for _ in range(400)}
    names |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "ÿÿÿÿ", "ÿÿÿ", "a", "b", "ab"}
    vocabulary = stored(spark.createDataFrame([(w, len(w)) for w in sorted(names)], "word string, n long"), "words")
    rows = spelling.near_pairs(vocabulary).collect()
    pairs = [tuple(sorted((r.a, r.b))) for r in rows]
    assert len(pairs) == len(set(pairs))
    long = {p for p in pairs if min(map(len, p)) >= 2}
    assert long == {(a, b) for a in names for b in names if a < b and min(len(a), len(b)) >= 2 and near(a, b)}
    assert all(r.a_n == len(r.a) and r.b_n == len(r.b) for r in rows)


def test_equals_brute_force(spark):
    random.seed(9)
    base = ["straße", "Öffnung", "MITTEILUNG", "mitteilung", "naïveté", "wordwide", "÷wörter×"]
    rows = [(None, " ".join(base)), (1, None), (2, ""), (3, "1234 -- ..."), (4, "漢字mitteilung漢字😀Mitteilung")]
    for k in range(150):
        chosen = random.choices(base, weights=[1, 20, 200, 1, 3, 9, 2], k=8)
        slips = [w[:i] + random.choice(["", "x", w[i] * 2]) + w[i + 1:] for w in chosen if (i := random.randrange(len(w))) % 3 == 0]
        rows += [(k % 40, f"{' '.join(chosen)},{'/'.join(slips)} " * 2)] * (1 + k % 2)
    expected = check(spark, rows, least=5, twice=2, every=7, times=10)
    assert sum(v[2] is not None for v in expected.values()) > 10
    check(spark, rows, least=7, twice=2, every=31, times=2)


def test_chains_lead_to_the_last_form(spark):
    counts = {"abcdefgh": 1, "abcdefgx": 10, "abcdefyx": 100, "abcdezyx": 1000, "abcdezyq": 1000, "lonely-one": 3}
    rows = [(10_000_000 + k, w + " ") for w, n in counts.items() for k in range(n)]
    expected = check(spark, rows, least=6, twice=1, every=2_000_003, times=10)
    assert expected["abcdefgh"][4] == "abcdezyx" and expected["abcdezyx"][2] is None


def test_ties_take_the_first_in_code_point_order(spark):
    rows = [(k, "abcdeÿg abcdeég abcdezg ") for k in range(20)] + [(0, "abcdexg")]
    expected = check(spark, rows, least=6, twice=1, every=2_000_003, times=10)
    assert expected["abcdexg"][2] == "abcdezg"


def test_empty_tables(spark):
    assert check(spark, [], least=7, twice=2, every=31, times=10) == {}
    assert check(spark, [(1, None), (None, "")], least=7, twice=2, every=31, times=10) == {}


def test_a_long_text(spark):
    check(spark, [(1, "gegenstand gegenstant " * 60_000), (2, "gegenstände " * 3)], least=7, twice=2, every=31, times=10)
