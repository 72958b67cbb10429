import datetime as dt

import pytest

from archivolt.operators.watermark import CommitLog, CommittedReplay, WatermarkedState, committed_due, replay_due

T = lambda h: dt.datetime(2025, 1, 1, h)
PAGES = "domain string, url string, last_seen_at string, loaded_at timestamp_ntz, content_hash string, run_id string"
RUNS = "run_id long, domain string, started_at timestamp_ntz, status string"
EXPORTS = "url string, exported_at string, source_hash string, status string"


def test_due_urls(spark, rows):
    pages = spark.createDataFrame(
        [
            ("d", "u1", "01", T(1), "sha256:AA", "x"), ("d", "u1", "02", T(5), "aa", "x"), ("d", "u1", "03", T(7), "bb", "x"),
            ("d", "u1", "02", T(9), "zz", "x"),  # late: seen before 03
            ("d", "u2", "01", T(1), None, "x"), ("d", "u2", "02", T(5), "cc", "x"), ("d", "u2", "02", T(5), "cc", "x"),
            ("d", "u3", "01", T(1), "dd", "x"), (None, "u4", "01", T(1), "dd", "x"), ("d", None, "01", T(1), "dd", "x"),
        ], PAGES)
    runs = spark.createDataFrame([(1, "d", T(2), "success"), (2, "d", T(6), "failed"), (3, "d", T(6), "success"), (4, "d", T(8), "success"), (5, "d", T(10), "success"), (6, "d", None, "running")], RUNS)
    exports = spark.createDataFrame([("u1", "1", "SHA256:aa", "ok"), ("u3", "1", "dd", "ok"), ("u3", "2", None, "ok"), ("u3", "3", "dd", "failed")], EXPORTS)
    assert rows(replay_due(pages, runs, exports), "run_id", "url") == [(1, "u3"), (3, "u2"), (4, "u1")]
    assert replay_due(pages.limit(0), runs, exports).count() == 0 and replay_due(pages, runs.limit(0), exports.limit(0)).count() == 0


def feed(spark, data):
    return spark.createDataFrame(data, "url string, last_seen_at string, loaded_at timestamp_ntz, digest string")


def test_failed_run_neither_skips_nor_repeats(spark, tmp_path, rows):
    data = feed(spark, [("a", "1", T(1), "x"), ("b", "1", T(2), "y"), ("a", "2", T(3), "x"), ("c", "1", T(4), "z"), ("a", "3", T(5), "w")])
    state = WatermarkedState(spark, f"file://{tmp_path}/state")
    state.run(data, "2025-01-01 02:30:00", "r1")
    with pytest.raises(RuntimeError):
        state.run(data, "2025-01-01 04:30:00", "r2", fail_at="commit")
    assert state.watermark() == "2025-01-01 02:30:00"
    n = state.run(data, "2025-01-01 05:30:00", "r3")
    assert rows(state.output(n).where("due"), "url", "digest") == [("a", "w"), ("c", "z")]
    assert rows(state.processed(), "url", "digest") == [("a", "w"), ("b", "y"), ("c", "z")]
    n = state.run(data, "2025-01-01 06:00:00", "r4")
    assert state.output(n).where("due").count() == 0


def test_two_runs_cannot_commit_one_number(spark, tmp_path):
    one, two = (WatermarkedState(spark, f"file://{tmp_path}/s") for _ in range(2))
    data = feed(spark, [("a", "1", T(1), "x")])
    one.run(data, "2025-01-01 02:00:00", "r1")
    two.log.latest, two.log.next_number = lambda: None, lambda: 0  # it saw the state before the other committed
    with pytest.raises(Exception):
        two.run(data, "2025-01-01 02:00:00", "r2")
    assert len(one.commits()) == 1


def test_a_stop_at_any_step_and_broken_manifests(spark, tmp_path, rows):
    root = f"file://{tmp_path}/state"
    state = WatermarkedState(spark, root, merge_at=2)
    data = feed(spark, [("a", "1", T(1), "x"), ("b", "1", T(2), "y"), ("a", "2", T(3), "z"), ("c", "1", T(4), "w"), ("b", "0", T(5), "old")])
    for h in range(1, 6):
        for step in ("output", "state", "commit"):
            with pytest.raises(RuntimeError):
                state.run(data, f"2025-01-01 0{h}:30:00", f"r{h}", fail_at=step)
        (tmp_path / "state" / "_commits").mkdir(exist_ok=True, parents=True)
        (tmp_path / "state" / "_commits" / f"{state.log.next_number():08d}.json").write_text("" if h % 2 else '{"watermark": "20')
        state.run(data, f"2025-01-01 0{h}:30:00", f"r{h}")
    assert len(state.commits()) == 5 and len(state.commits()[-1]["state"]) <= 2
    assert rows(state.processed(), "url", "digest") == [("a", "z"), ("b", "y"), ("c", "w")]
    due = [r for n, _ in state.log.all() for r in rows(state.output(n).where("due"), "url", "digest")]
    assert due == [("a", "x"), ("b", "y"), ("a", "z"), ("c", "w")]
    assert len(state.vacuum()) >= 10 and rows(state.processed(), "url", "digest") == [("a", "z"), ("b", "y"), ("c", "w")]


def test_committed_replay_is_the_replay_and_the_runs(spark, tmp_path, rows):
    import random

    rng = random.Random(3)
    when = lambda: dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randrange(240))
    data = [(rng.choice("de"), f"u{rng.randrange(12)}", f"{rng.randrange(9)}", when(), rng.choice(["aa", "bb", "sha256:AA", None]), "x") for _ in range(250)]
    data = [(d if d == "d" else "e", u + d, s, t, c, x) for d, u, s, t, c, x in data]
    pages = spark.createDataFrame(data, PAGES)
    log = [(i, rng.choice("de"), when(), rng.choice(["success", "success", "failed"])) for i in range(24)]
    runs = spark.createDataFrame(log, RUNS)
    exports = spark.createDataFrame([("u1d", "1", "aa", "ok"), ("u2e", "1", "BB", "ok"), ("u3d", "1", None, "ok")], EXPORTS)
    want = rows(replay_due(pages, runs, exports), "run_id", "url")
    assert rows(committed_due(pages, runs, exports, f"file://{tmp_path}/all"), "run_id", "url") == want and len(want) > 20
    replay = CommittedReplay(spark, f"file://{tmp_path}/some")
    for bound in ("2025-01-03 00:00:00", "2025-01-06 12:00:00", "2025-01-20 00:00:00"):
        with pytest.raises(RuntimeError):
            replay.advance(pages, runs, exports, bound, fail_at_commit=True)
        replay.advance(pages, runs, exports, bound)
    assert rows(replay.due(), "run_id", "url") == want
    from archivolt.operators.watermark import export_baseline, with_digests

    one, got = WatermarkedState(spark, f"file://{tmp_path}/one"), []
    mine = with_digests(pages).where("domain = 'd'").select("url", "last_seen_at", "loaded_at", "digest")
    for run_id, _, started, status in sorted((r for r in log if r[1] == "d"), key=lambda r: (r[2], r[0])):
        if status == "success":
            n = one.run(mine, str(started), str(run_id), export_baseline(exports))
            got += [(run_id, u) for (u,) in rows(one.output(n).where("due"), "url")]
    assert sorted(got) == sorted(w for w in want if w[1].endswith("d"))


def test_commit_numbers_are_taken_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/log")
    log.commit(0, {"a": 1})
    with pytest.raises(Exception):
        log.commit(0, {"a": 2})
    assert log.latest() == (0, {"a": 1}) and not list((tmp_path / "log" / "_commits").glob(".0*-*[!c]"))
