"""SQL of the queries on leaks, spelling and manifests."""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS s
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS s
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) t(i)),
found AS MATERIALIZED (SELECT r, i, size, item_id FROM places JOIN windows USING (size, s)),
hits AS (
    SELECT r, count(DISTINCT i + k) AS n_hit
    FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(0, size)) t(k) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

#: crc32 of a list of bytes, by a table that is made from the polynomial.
_CRC = """
crc_table AS MATERIALIZED (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i] || range(8), lambda v, k: CASE WHEN v & 1 = 1
               THEN xor(3988292384, v >> 1) ELSE v >> 1 END) AS v
        FROM range(256) r(i)))
"""


def _crc(octets: str) -> str:
    return (
        f"xor(4294967295, list_reduce([4294967295::BIGINT] || {octets}, "
        "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))"
    )


_OCTETS = """flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT]
                ELSE [(192 + (ord(c) >> 6))::BIGINT, (128 + (ord(c) & 63))::BIGINT] END))"""

OP12 = f"""
WITH RECURSIVE {_CRC},
runs AS MATERIALIZED (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY ALL),
checked AS (
    SELECT run, k, {_crc(_OCTETS)} AS h
    FROM (SELECT run, k, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs), crc_table),
words AS MATERIALIZED (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, (h % length(run) + 2)::BIGINT)
                  ELSE run END AS word FROM checked)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cuts AS MATERIALIZED (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) u(i)),
near AS MATERIALIZED (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, min({{'o': -other_n, 'w': other}}) AS b FROM near GROUP BY word),
formed AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN -b.o >= 10 * n THEN b.w END AS form, CASE WHEN -b.o >= 10 * n THEN -b.o END AS form_n
    FROM words LEFT JOIN best USING (word)),
chain(word, place, steps) AS (
    SELECT word, word, 0 FROM words
    UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON c.place = f.word WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, max_by(place, steps) AS root FROM chain GROUP BY word) USING (word)
"""

_LEAF = """sha256({0} || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || coalesce(strlen({1}) || ':' || {1}, '-'))"""
_ID = "coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')"

#: Levels of the trees of sources count from 0, those of the tree above them from 1000.
OP13 = f"""
WITH RECURSIVE {_CRC},
hashed AS (
    SELECT doc_id, source, {_LEAF.format(_ID, 'text')} AS leaf,
           {_LEAF.format(_ID, "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed,
           list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT) AS octets
    FROM documents),
leaves AS MATERIALIZED (
    SELECT doc_id, source, leaf,
           CASE WHEN octets IS NOT NULL AND {_crc('octets')} % 5 = 0 THEN changed ELSE leaf END AS now,
           row_number() OVER () AS r,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY source) AS size
    FROM hashed, crc_table),
lower_nodes(source, level, i, d, size) AS (
    SELECT source, 0, i, leaf, size FROM leaves
    UNION ALL
    SELECT source, level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), any_value((size + 15) // 16)
    FROM lower_nodes WHERE size > 1 GROUP BY source, level, i // 16),
subroots AS MATERIALIZED (
    SELECT source, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank,
           count(*) OVER () AS sources
    FROM lower_nodes WHERE size = 1),
upper_nodes(level, i, d, size) AS (
    SELECT 1000, rank, subroot, sources FROM subroots
    UNION ALL
    SELECT level + 1, i // 16, sha256(string_agg(d, '' ORDER BY i)), any_value((size + 15) // 16)
    FROM upper_nodes WHERE size > 1 GROUP BY level, i // 16),
nodes AS MATERIALIZED (
    SELECT rank AS tree, level, n.i, d, size FROM lower_nodes n JOIN subroots s ON n.source IS NOT DISTINCT FROM s.source
    WHERE size > 1
    UNION ALL SELECT -1, level, i, d, size FROM upper_nodes WHERE size > 1),
paths AS MATERIALIZED (  -- where each row's ancestors stand, the subroot in the upper tree included
    SELECT r, n.tree, n.level, l.i // (16 ** n.level)::BIGINT AS i
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT DISTINCT tree, level FROM nodes WHERE tree >= 0) n ON n.tree = s.rank
    UNION ALL
    SELECT r, n.tree, n.level, s.rank // (16 ** (n.level - 1000))::BIGINT
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source,
         (SELECT DISTINCT tree, level FROM nodes WHERE tree = -1) n),
runs AS MATERIALIZED (
    SELECT p.r, p.level, row_number() OVER (PARTITION BY p.r ORDER BY p.level) AS step,
           coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i < p.i), '') AS before,
           coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i > p.i), '') AS after
    FROM paths p JOIN nodes n ON n.tree = p.tree AND n.level = p.level AND n.i // 16 = p.i // 16
    GROUP BY p.r, p.level),
folded(r, step, value) AS (
    SELECT r, 0::BIGINT, now FROM leaves
    UNION ALL
    SELECT f.r, u.step, sha256(u.before || f.value || u.after) FROM folded f JOIN runs u ON u.r = f.r AND u.step = f.step + 1),
proofs AS (SELECT r, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM runs GROUP BY r),
ends AS (SELECT r, max_by(value, step) AS folded_root FROM folded GROUP BY r)
SELECT doc_id, leaf, subroot, top.d AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = top.d AS verified
FROM (SELECT d FROM upper_nodes WHERE size = 1) top, leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN ends USING (r) LEFT JOIN proofs USING (r)
"""
