import random
import zlib

from pyspark.sql import functions as F
from authweave.llm import queries, toxicity
from authweave.llm.tables import table

LABELS = "doc_id long, toxic int, quality int"
DOCS = "doc_id long, text string, score string, source string"


def corpus(n):
    random.seed(5)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "i", "on", "ur")]
    docs, labels = [], []
    for k in range(n):
        text = random.choices(words, k=random.randint(3, 80))
        toxic = k % 5 == 0
        if toxic:
            for _ in range(random.randint(1, 5)):
                text.insert(random.randrange(len(text)), random.choice(["idiot", "scumbag", "you trash", "lowlife", "id1ot"]))
        docs.append((k, " ".join(text), "old", "s"))
        labels.append((k, int(toxic), 1))
    return docs, labels


def test_learns_and_scores_held_out_rows(spark):
    docs, labels = corpus(900)
    extra = [(None, "you idiot", "o", "s"), (5000, None, "o", "s"), (5001, "", "o", "s"), (5001, "", "o", "s"),
             (5002, "you IDIOT! " * 5000, "o", "s"), (5003, "ba de fi " * 5000, "o", "s")]
    rows = toxicity.judge(
        spark.createDataFrame(docs + extra, DOCS), spark.createDataFrame(labels + [(3, None, 0), (None, 1, 0)], LABELS)
    ).collect()
    assert len(rows) == len(docs) + len(extra)
    truth = {k: t for k, t, _ in labels}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5002].predicted == 1 and by_id[5003].predicted == 0
    assert by_id[5000].score == by_id[5001].score


def test_empty_partitions(spark):
    docs, labels = corpus(300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "700")
    try:
        frame = spark.createDataFrame(docs, DOCS)
        rows = [(t, toxic, k % 2) for (k, t, *_), (_, toxic, _) in zip(docs, labels)]
        sample = spark.createDataFrame(rows, "text string, toxic int, part int")
        assert toxicity.lexicon(sample) and frame.count() == 300
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(300)
    turned = [(k, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t, q) for k, t, q in labels]
    frame = spark.createDataFrame(docs, DOCS)
    one, two = (
        {r.doc_id: r.score for r in toxicity.judge(frame, spark.createDataFrame(x, LABELS)).collect()}
        for x in (labels, turned)
    )
    assert one == two


def test_any_column_name_may_come(spark):
    docs, labels = corpus(300)
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    names = ["prediction", "probability", "rawPrediction", "_features", "_margin", "_score", "_row", "a.b"]
    wide = frame.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])
    plain = {r.doc_id: r.score for r in toxicity.judge(frame, marks).collect()}
    found = toxicity.judge(wide, marks)
    made = ["score", "held_out", "predicted"]
    assert found.columns == [*[name for name in wide.columns if name not in made], *made]
    for row in found.collect():
        assert [row[name] for name in names] == list(range(len(names))) and row.score == plain[row.doc_id]


def test_without_labels(spark):
    docs, labels = corpus(20)
    frame = spark.createDataFrame(docs, DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.judge(frame, none).collect()} == {0.0}
    ones = spark.createDataFrame([(k, 1, 1) for k, _, _ in labels], LABELS)
    assert {r.score for r in toxicity.judge(frame, ones).collect()} == {1.0}
    assert toxicity.judge(frame.limit(0), none).count() == 0


def test_features():
    made = toxicity.Features({"idiot": 3.0, "lowl-": 2.0})
    assert list(toxicity.units("lowlif")) == ["lowlif", "low-", "lowl-", "lowli-"]
    value = dict(zip(toxicity.FEATURES, made.of("You IDIOT!! lowlife id1ot p*ss")))
    assert value["entry_density"] == 3 / 5 and value["near_share"] == 1.0
    assert value["disguised_entry_density"] == 1 / 5 and value["strongest"] == 3.0
    assert value["repeated_marks"] == 1 / 5 and value["shouted_words"] == 1 / 5
    assert len(made.of("")) == len(toxicity.FEATURES) and not any(made.of(""))


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    rows = queries.op3_toxicity(spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(r.predicted and truth[r.doc_id] for r in held)
    # a few labels of copies contradict their texts
    assert hits / sum(truth[r.doc_id] for r in held) >= 0.93
    assert hits / sum(r.predicted for r in held) >= 0.95
