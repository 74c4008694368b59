import random

from authweave.operators import cores

NODES, EDGES = "node_type string, node string, as_source long, as_destination long", "src_user string, dst_computer string"


def by_peeling(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    degree = {n: len(m) for n, m in near.items()}
    left, core, k = {n: set(m) for n, m in near.items()}, {}, 0
    while left:
        k += 1
        while low := [n for n, m in left.items() if len(m) < k]:
            for n in low:
                core[n] = k - 1
                for m in left.pop(n):
                    if m in left:
                        left[m].discard(n)
    return {n: (degree[n], core[n]) for n in near}


def numbers(spark, edges):
    frame = spark.createDataFrame(sorted(edges), "a long, b long")
    found, rounds = cores.core_numbers(frame)
    return {r.node: (r.degree, r.core) for r in found.collect()}, rounds


def test_random_graphs(spark):
    for seed, (users, hosts, edges) in enumerate([(30, 12, 200), (60, 60, 150), (5, 40, 120)]):
        random.seed(seed)
        links = {(2 * random.randrange(users), 2 * int(hosts * random.random() ** 2) + 1) for _ in range(edges)}
        assert numbers(spark, links)[0] == by_peeling(links)


def test_chain_star_and_dense_part(spark):
    chain = {(k, k + 1) for k in range(0, 12)}
    star = {(100, 101 + k) for k in range(40)}
    dense = {(200 + 2 * i, 201 + 2 * j) for i in range(6) for j in range(6)}
    links = chain | star | dense | {(12, 200), (100, 201)}
    found, rounds = numbers(spark, links)
    assert found == by_peeling(links)
    assert found[100] == (41, 1) and found[200][1] == 6 and rounds < 20


def test_nodes_without_edges_and_shared_names(spark):
    nodes = [("user", "A", 1, 0), ("host", "A", 1, 1), ("user", "lonely", 0, 1), ("host", "B", 0, 1)]
    frame = cores.node_structure(spark.createDataFrame(nodes, NODES), spark.createDataFrame([("A", "A"), ("A", "B")], EDGES))
    rows = {(r.node_type, r.node): (r.degree, r.core) for r in frame.collect()}
    assert rows == {("user", "A"): (2, 1), ("host", "A"): (1, 1), ("host", "B"): (1, 1), ("user", "lonely"): (0, 0)}


def test_no_edges(spark):
    nodes = spark.createDataFrame([("user", "A", 1, 0)], NODES)
    rows = cores.node_structure(nodes, spark.createDataFrame([], EDGES)).collect()
    assert [tuple(r) for r in rows] == [("user", "A", 0, 0)]
