import random

from authweave.llm.components import components


def test_chains_stars_and_rings(spark):
    random.seed(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(400, 401), (401, 402), (402, 400)]
    links += [(7, 7), (None, 3), (3, None), (400, 401)]
    random.shuffle(links)
    found = dict(components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect())
    want = {k: 100 for k in range(101, 161)} | {k: 5 for k in range(200, 260)} | {401: 400, 402: 400}
    assert found == want


def test_negative_ids_and_none(spark):
    frame = spark.createDataFrame([(-5, 3), (3, 9)], "x long, y long")
    assert dict(components(frame, "x", "y").collect()) == {3: -5, 9: -5}
    assert components(frame.limit(0), "x", "y").count() == 0
