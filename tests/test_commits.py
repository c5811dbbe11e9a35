"""The commit log: who gets a number, and what a reader opens."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from shardsmith.plans import commits, layout
from shardsmith.plans.build import ConcurrentUpdateError, IndexSpec, build_index, expire_snapshots, latest_snapshot, list_snapshots, restore_snapshot, upsert
from shardsmith.streaming.upserts import apply_batch

DOCS = "_id string, _routing string, _seq bigint, _source string"


def docs(spark, ids, seq=1, body="{}"):
    return spark.createDataFrame([(str(i), str(i), seq, body) for i in ids], DOCS)


def test_one_writer_creates_a_file(spark, scratch):
    made = [commits.put_if_absent(spark, f"{scratch}/x/commit.json", str(i)) for i in range(3)]
    assert made == [True, False, False] and commits.read_file(spark, f"{scratch}/x/commit.json") == "0"
    assert commits.read_file(spark, f"{scratch}/x/none.json") is None
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: commits.put_if_absent(spark, f"{scratch}/x/race.json", "y" * 50_000 + str(i)), range(24)))
    assert sum(made) == 1
    assert commits.read_file(spark, f"{scratch}/x/race.json") == "y" * 50_000 + str(made.index(True))


def test_every_commit_has_its_own_number(spark, scratch):
    """Writers that all append at once: no number twice, none lost, and each saw the commit before its own."""
    with ThreadPoolExecutor(6) as pool:
        rows = list(pool.map(lambda i: commits.append(spark, scratch, lambda last: {"who": i, "saw": last and last["who"]}), range(40)))
    by_no = {r["commit_no"]: r for r in rows}
    assert sorted(by_no) == list(range(1, 41))
    assert [r["who"] for r in commits.rows(spark, scratch)] == [by_no[n]["who"] for n in range(1, 41)]
    assert all(by_no[n]["saw"] == (by_no[n - 1]["who"] if n > 1 else None) for n in by_no)


def test_readers_open_a_constant_number_of_files(spark, scratch, monkeypatch):
    opened = []
    read = commits.read_file
    for n in range(70):
        commits.append(spark, scratch, lambda last: {"n": n})
        if n in (5, 30, 69):
            opened.clear()
            monkeypatch.setattr(commits, "read_file", lambda s, p: opened.append(p) or read(s, p))
            monkeypatch.setattr(commits, "_listed", lambda *a: pytest.fail("the folder is listed"))
            assert commits.newest(spark, scratch)["n"] == n and len(opened) == 2
            opened.clear()
            assert [r["n"] for r in commits.rows(spark, scratch)] == list(range(n + 1))
            assert len(opened) <= 2 + commits.CHECKPOINT_EVERY
            monkeypatch.undo()


@pytest.mark.parametrize("hint", [None, "", "{", '{"commit": "x"}', '{"commit": 3, "checkpoint": null}'])
def test_hints_may_be_lost_damaged_or_old(spark, scratch, hint):
    for n in range(20):
        commits.append(spark, scratch, lambda last: {"n": n})
    p, fs = commits._fs(spark, f"{scratch}/hint.json")
    fs.delete(p, False)
    if hint is not None:
        commits.replace_file(spark, f"{scratch}/hint.json", hint)
    assert commits.newest(spark, scratch)["n"] == 19
    assert [r["n"] for r in commits.rows(spark, scratch)] == list(range(20))
    assert commits.append(spark, scratch, lambda last: {"n": last["n"] + 1})["commit_no"] == 21
    assert json.loads(commits.read_file(spark, f"{scratch}/hint.json"))["commit"] == 21


def test_forgotten_commits(spark, scratch):
    for n in range(1, 40):
        commits.append(spark, scratch, lambda last: {"n": n})
    gone = commits.forget(spark, scratch, set(range(1, 30)) | {39})
    assert commits.commit_path(scratch, 29) in gone and commits.commit_path(scratch, 39) not in gone
    assert [r["n"] for r in commits.rows(spark, scratch)] == list(range(30, 40))
    assert commits.newest(spark, scratch)["n"] == 39 and commits.forget(spark, scratch, {39}) == []
    commits.append(spark, scratch, lambda last: {"n": 40})
    commits.forget(spark, scratch, {31})
    assert [r["n"] for r in commits.rows(spark, scratch)] == [30, *range(32, 41)]
    names = [s.getPath().getName() for s in commits._fs(spark, scratch)[1].listStatus(commits._fs(spark, scratch)[0])]
    assert len([n for n in names if n.startswith("checkpoint")]) == 1


def at_once(monkeypatch, n=2):
    """Commits wait for one another, so that all are ready before the first is made."""
    ready, append = threading.Barrier(n), commits.append

    def waits(*args):
        ready.wait(120)
        return append(*args)

    monkeypatch.setattr(commits, "append", waits)


def test_two_updates_of_one_parent(spark, scratch, monkeypatch):
    """One is kept, the other refused; it can be done again."""
    spec = IndexSpec("r", 2)
    build_index(spark, docs(spark, range(20)), scratch, spec)
    at_once(monkeypatch)

    def update(i):
        try:
            return upsert(spark, docs(spark, [100 + i], 2), scratch, spec, mode=("delta", "rewrite")[i]).generation
        except ConcurrentUpdateError:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(update, range(2)))
    monkeypatch.undo()
    assert sum(d is not None for d in done) == 1
    kept = 100 + [d is not None for d in done].index(True)
    assert {r._id for r in restore_snapshot(spark, scratch, "r").collect()} == {str(i) for i in (*range(20), kept)}
    assert latest_snapshot(spark, scratch, "r")["commit_no"] == 2 and list_snapshots(spark, scratch, "r").count() == 2
    upsert(spark, docs(spark, [201 - kept], 2), scratch, spec)
    assert restore_snapshot(spark, scratch, "r").count() == 22


def test_two_builds_at_once(spark, scratch, monkeypatch):
    """Both are kept, in some order, under numbers of their own."""
    at_once(monkeypatch)
    with ThreadPoolExecutor(2) as pool:
        made = list(pool.map(lambda i: build_index(spark, docs(spark, [i]), scratch, IndexSpec("b", 1)), range(2)))
    monkeypatch.undo()
    numbers = sorted(m.metrics["snapshot"]["commit_no"] for m in made)
    last = max(made, key=lambda m: m.metrics["snapshot"]["commit_no"])
    assert numbers == [1, 2] and latest_snapshot(spark, scratch, "b")["generation"] == last.generation


def test_replayed_batches_without_listing(spark, scratch, monkeypatch):
    spec = IndexSpec("s", 2)
    build_index(spark, docs(spark, range(5)), scratch, spec)
    monkeypatch.setattr(commits, "_listed", lambda *a: pytest.fail("the folder is listed"))
    monkeypatch.setattr(commits, "rows", lambda *a: pytest.fail("all commits are read"))
    lines = lambda i: spark.createDataFrame([(json.dumps({"id": str(i), "v": 2}),)], "value string")
    for batch, name in ((0, "q"), (1, "q"), (0, "other")):
        assert apply_batch(spark, lines(10 + batch), batch, scratch, spec, "id", "v", query_name=name)
        assert apply_batch(spark, lines(10 + batch), batch, scratch, spec, "id", "v", query_name=name) is None
    assert apply_batch(spark, lines(10), 0, scratch, spec, "id", "v", query_name="q") is None
    snap = latest_snapshot(spark, scratch, "s")
    assert snap["batches"] == {"q": 1, "other": 0} and snap["commit_no"] == 4 and snap["docs"] == 7
    monkeypatch.undo()
    build_index(spark, docs(spark, range(3)), scratch, spec)  # a rebuild knows of the batches, too
    assert apply_batch(spark, lines(10), 1, scratch, spec, "id", "v", query_name="q") is None


def test_old_generations_can_be_read_until_they_expire(spark, scratch):
    import datetime as dt

    spec = IndexSpec("o", 1)
    first = build_index(spark, docs(spark, range(4)), scratch, spec)
    build_index(spark, docs(spark, range(6)), scratch, spec)
    assert restore_snapshot(spark, scratch, "o", first.generation).count() == 4
    expire_snapshots(spark, scratch, "o", keep=1, older_than=dt.timedelta(0))
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, scratch, "o", first.generation)
    assert restore_snapshot(spark, scratch, "o").count() == 6 and not commits.exists(spark, layout.data_path(scratch, "o", first.generation))


def test_hint_that_is_being_replaced(spark, scratch):
    """A hint whose checksum is another one's is damaged: the folder is listed."""
    commits.replace_file(spark, f"{scratch}/hint.json", '{"commit": 7, "checkpoint": null}')
    with open(f"{scratch.removeprefix('file://').removeprefix('file:')}/hint.json", "w") as f:
        f.write('{"commit": 8, "checkpoint": null}')
    assert commits._hint(spark, scratch) == (0, None)
    assert commits.newest(spark, scratch) is None
