import math
import random

from authweave.operators import blocks

EDGES = "user_id long, host_id long, auth_count long"


def graph(spark, users, hosts, count, seed):
    random.seed(seed)
    edges = {(random.randrange(users), int(hosts * random.random() ** 3)): random.randint(1, 50) for _ in range(count)}
    frame = spark.createDataFrame([(u, h, n) for (u, h), n in edges.items()], EDGES)
    of_user, of_host = {}, {}
    for (u, h), n in edges.items():
        of_user[u], of_host[h] = of_user.get(u, 0) + n, of_host.get(h, 0) + n
    return frame, {(u, h): n / math.sqrt(of_user[u] * of_host[h]) for (u, h), n in edges.items()}


def test_blocks_hold_every_entry_once(spark):
    frame, weights = graph(spark, 900, 700, 4_000, 1)
    matrix = blocks.adjacency(frame)
    rows = matrix.collect()
    assert len(rows) == len({(r.row_block, r.col_block) for r in rows}) > 4
    for row in rows:
        places = [(e.row, e.col) for e in row.entries]
        assert places == sorted(set(places)) and all(0 <= x < blocks.SIDE for p in places for x in p)
    found = {(r.user_id, r.host_id): r.weight for r in blocks.entries_of(matrix).collect()}
    assert found.keys() == weights.keys()
    assert all(math.isclose(found[k], w, rel_tol=1e-12) for k, w in weights.items())


def test_product_equals_the_join(spark):
    frame, weights = graph(spark, 900, 700, 4_000, 2)
    names = ["x", "y"]
    values = {h: (random.random(), float(h)) for h in range(650)}  # hosts from 650 on have none
    features = spark.createDataFrame([(h, x, y) for h, (x, y) in values.items()], "host_id long, x double, y double")
    product = blocks.spread_to_users(blocks.adjacency(frame), blocks.feature_blocks(features, "host_id", names), names)
    expected = {}
    for (u, h), w in weights.items():
        sums = expected.setdefault(u, [0.0, 0.0])
        for k, v in enumerate(values.get(h, (0.0, 0.0))):
            sums[k] += w * v
    found = {r.user_id: (r.x, r.y) for r in product.collect()}
    assert found.keys() == expected.keys()
    for u, sums in expected.items():
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for a, b in zip(found[u], sums))


def test_null_features_and_no_edges(spark):
    frame, weights = graph(spark, 3, 2, 5, 3)
    features = spark.createDataFrame([(0, None), (1, 2.0)], "host_id long, x double")
    found = blocks.spread_to_users(blocks.adjacency(frame), blocks.feature_blocks(features, "host_id", ["x"]), ["x"])
    for row in found.collect():
        assert math.isclose(row.x, 2.0 * weights.get((row.user_id, 1), 0.0), abs_tol=1e-12)
    assert blocks.adjacency(spark.createDataFrame([], EDGES)).count() == 0
