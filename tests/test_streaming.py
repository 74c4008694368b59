"""Streams that are interrupted, restarted and fed late."""

import pytest
from pyspark.errors import StreamingQueryException

from authweave.operators import behavior, clean
from authweave.sources import raw_logs, tables
from authweave.streaming import clean_stream

DAY = 86_400


def line(time, user="U1", host="C1"):
    return f"{time},{user}@DOM1,{user}@DOM1,C9,{host},NTLM,Network,LogOn,Success"


def drop_files(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, rows in files.items():
        (folder / f".{name}").write_text("\n".join(rows) + "\n")
        (folder / f".{name}").rename(folder / f"{name}.csv")


def cleaned(spark, folder):
    return clean.clean_auth(raw_logs.well_formed(raw_logs.read_auth_log(spark, str(folder))))


def same_rows(left, right):
    return left.count() == right.count() and left.exceptAll(right).count() == 0


def run(stream, spark, folder, out, state, **options):
    query = stream(spark, str(folder), str(out), str(state), **options)
    query.awaitTermination()
    return len([p for p in query.recentProgress if p.numInputRows])


@pytest.fixture
def paths(tmp_path):
    return tmp_path / "in", tmp_path / "out", tmp_path / "state"


def test_a_batch_that_fails_after_its_write_is_there_once(spark, paths, monkeypatch):
    folder, out, state = paths
    drop_files(folder, a=[line(t) for t in range(0, 3 * DAY, 5_000)], b=[line(5), line(5), "broken"])
    write = clean_stream.commit_batch

    def failing(batch, *rest):
        write(batch, *rest)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(clean_stream, "commit_batch", failing)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run(clean_stream.clean_new_files, spark, folder, out, state)
        assert same_rows(tables.read_clean_table(spark, str(out)), cleaned(spark, folder))
    monkeypatch.setattr(clean_stream, "commit_batch", write)
    assert run(clean_stream.clean_new_files, spark, folder, out, state) == 1
    assert run(clean_stream.clean_new_files, spark, folder, out, state) == 0
    assert same_rows(tables.read_clean_table(spark, str(out)), cleaned(spark, folder))
    drop_files(folder, c=[line(7), line(2 * DAY)])
    assert run(clean_stream.clean_new_files, spark, folder, out, state) == 1
    assert same_rows(tables.read_clean_table(spark, str(out)), cleaned(spark, folder))


def test_a_batch_that_fails_before_its_write(spark, paths, monkeypatch):
    folder, out, state = paths
    drop_files(folder, a=[line(1), line(2)])
    write = clean_stream.commit_batch
    monkeypatch.setattr(clean_stream, "commit_batch", lambda *_: 1 / 0)
    with pytest.raises(StreamingQueryException):
        run(clean_stream.clean_new_files, spark, folder, out, state)
    monkeypatch.setattr(clean_stream, "commit_batch", write)
    drop_files(folder, b=[line(3)])
    run(clean_stream.clean_new_files, spark, folder, out, state)
    assert same_rows(tables.read_clean_table(spark, str(out)), cleaned(spark, folder))


def test_two_streams_write_one_table(spark, tmp_path):
    out = tmp_path / "out"
    for name in ("a", "b"):
        drop_files(tmp_path / name, x=[line(1), line(DAY)])
        run(clean_stream.clean_new_files, spark, tmp_path / name, out, tmp_path / f"state-{name}")
    assert tables.read_clean_table(spark, str(out)).count() == 4


def contacts(spark, folder):
    return behavior.first_contacts(behavior.daily_edges(cleaned(spark, folder)))


def test_contacts_over_several_batches(spark, paths):
    """New, repeated, late and again repeated rows, and a restart between them."""
    folder, out, state = paths
    steps = [
        dict(a=[line(5 * DAY, "U1", "C1"), line(5 * DAY + 9, "U1", "C1"), line(5 * DAY, "U2", "C1")]),
        dict(b=[line(6 * DAY, "U1", "C1"), line(6 * DAY, "U1", "C2")]),  # one known, one new
        dict(c=[line(2 * DAY + 7, "U1", "C1")]),  # late: earlier than known
        dict(d=[line(2 * DAY + 7, "U1", "C1"), line(3 * DAY, "U1", "C1"), line(5 * DAY, "U2", "C1")]),  # nothing new
        dict(e=["broken", line(9 * DAY, "U3", "C1").replace("U3@DOM1,C9", "U3@DOM1,")]),  # nobody
    ]
    changes = []
    for files in steps:
        drop_files(folder, **files)
        assert run(clean_stream.watch_contacts, spark, folder, out, state) <= 1
        assert same_rows(clean_stream.read_contacts(spark, str(out)), contacts(spark, folder))
        changes.append(spark.read.parquet(str(out)).count())
    assert changes == [2, 3, 4, 4, 4]


def test_contacts_of_batches_of_one_file(spark, paths):
    folder, out, state = paths
    drop_files(folder, **{
        f"f{k}": [line((k * 7 + j) % 5 * DAY + j, f"U{(k + j) % 3}", f"C{j % 4}") for j in range(20)] for k in range(5)
    })
    assert run(clean_stream.watch_contacts, spark, folder, out, state, files_per_batch=1) == 5
    assert same_rows(clean_stream.read_contacts(spark, str(out)), contacts(spark, folder))


def test_replaced_days_of_a_streamed_table(spark, paths):
    from authweave.sinks import writers
    folder, out, state = paths
    drop_files(folder, a=[line(1), line(2), line(DAY), line(2 * DAY)], b=[line(3), line(DAY + 1)])
    run(clean_stream.clean_new_files, spark, folder, out, state, files_per_batch=1)
    rows = cleaned(spark, folder)
    kept = rows.filter("time = 2 OR time >= 172800")
    for _ in range(2):  # the second call finds the first one's batch
        writers.replace_days(kept, str(out), [0, 1])
        assert same_rows(tables.read_clean_table(spark, str(out)), kept)
