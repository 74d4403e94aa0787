"""Whatever the files, their order and their repeats, the stream equals the batch."""

import os

import pytest

from tests.conftest import SF001


def _collect(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(os.path.join(SF001, "events.parquet"))


def _write_files(spark, rows, chunks, folder):
    """One file per chunk, delivered (by modification time) in this order."""
    from paylens.streaming.incremental import EVENT_SCHEMA
    os.makedirs(folder)
    for i, chunk in enumerate(chunks):
        tmp = f"{folder}-{i}"
        spark.createDataFrame([tuple(r) for r in chunk], EVENT_SCHEMA).coalesce(1).write.parquet(tmp)
        f = next(x for x in os.listdir(tmp) if x.endswith(".parquet"))
        target = os.path.join(folder, f"events-{i}.parquet")
        os.link(os.path.join(tmp, f), target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.mark.parametrize("order", ["oldest_first", "newest_first"])
def test_stream_keeps_every_event_once(spark, events, tmp_path, order):
    from paylens.streaming.incremental import StreamSettings, activity, current_table, run_to_completion, start
    rows = sorted(events.collect(), key=lambda r: r.ts, reverse=order == "newest_first")
    n = len(rows)
    chunks = [rows[i * n // 4: (i + 1) * n // 4] for i in range(4)]
    chunks[1] = chunks[1] + chunks[0][:50] + chunks[1][:20]      # repeats of an earlier file and of the same one
    chunks[3] = chunks[3] + chunks[0][-50:] + chunks[2][:30]
    _write_files(spark, rows, chunks, str(tmp_path / "in"))
    s = StreamSettings(compact_every=2)                          # folds while it runs
    got = run_to_completion(spark, str(tmp_path / "in"), s, root=str(tmp_path / "run"), max_files=1)
    want = activity(events, s)
    assert _collect(got.select(*want.columns)) == _collect(want)
    assert len(os.listdir(tmp_path / "run" / "sink" / "activity" / "base")) == 1
    # a restart replays nothing
    q = start(spark, str(tmp_path / "in"), str(tmp_path / "run" / "sink"), str(tmp_path / "run" / "state"), s, max_files=1)
    q.awaitTermination()
    assert _collect(current_table(spark, str(tmp_path / "run" / "sink")).select(*want.columns)) == _collect(want)


def test_replayed_batch_counts_once(spark, events, tmp_path):
    """A batch that runs again after a crash overwrites itself, also at and after a fold."""
    from paylens.streaming.incremental import StreamSettings, _batch_writer, activity, current_table
    s = StreamSettings(compact_every=2)
    rows = events.collect()
    parts = [spark.createDataFrame(rows[i::5], events.schema) for i in range(5)]
    write = _batch_writer(str(tmp_path / "sink"), s)
    for i, p in enumerate(parts):
        for _ in range(3):
            write(p, i)
        for j in range(i):          # batches of long ago change nothing
            if j < i - i % 2:
                write(parts[j], j)
    want = activity(events, s)
    assert _collect(current_table(spark, str(tmp_path / "sink")).select(*want.columns)) == _collect(want)


@pytest.mark.parametrize("stop", [1, 2, 3, 4, 5, 6])
def test_crash_anywhere_in_a_folding_batch(spark, events, tmp_path, monkeypatch, stop):
    """The batch that folds dies at its ``stop``-th write or delete and runs again."""
    from paylens.sources import files
    from paylens.streaming import incremental
    s = incremental.StreamSettings(compact_every=2)
    rows = events.collect()
    parts = [spark.createDataFrame(rows[i::3], events.schema) for i in range(3)]
    write = incremental._batch_writer(str(tmp_path / "sink"), s)
    write(parts[0], 0)
    write(parts[1], 1)
    left = [stop]

    def dying(plain):
        def call(*a, **k):
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError("lost")
            return plain(*a, **k)
        return call
    monkeypatch.setattr(files, "delete", dying(files.delete))
    monkeypatch.setattr(incremental.BatchTable, "write", dying(incremental.BatchTable.write))
    with pytest.raises(RuntimeError, match="lost"):
        write(parts[2], 2)
    monkeypatch.undo()
    write(parts[2], 2)
    want = incremental.activity(events, s)
    assert _collect(incremental.current_table(spark, str(tmp_path / "sink")).select(*want.columns)) == _collect(want)


def test_one_file_and_a_folder_of_parts_agree(spark, events, tmp_path):
    from paylens.plans.registry import QUERIES
    from paylens.streaming.incremental import activity
    events.repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    want = _collect(activity(events))
    for d in (str(tmp_path), SF001):
        got = QUERIES["incremental_player_activity"](spark, d)
        assert _collect(got.select(*activity(events).columns)) == want


def test_events_without_id_all_count(spark, tmp_path):
    from paylens.streaming.incremental import EVENT_SCHEMA, run_to_completion
    import datetime as dt
    t = dt.datetime(2025, 1, 1)
    rows = [(None, t, 1, "click", 2.0, None), (None, t, 1, "click", 2.0, None), (7, None, 1, "click", 1.0, None), (7, None, 1, "click", 1.0, None)]
    for i in range(2):
        spark.createDataFrame(rows[2 * i: 2 * i + 2] if i else rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = run_to_completion(spark, str(tmp_path / "in"), root=str(tmp_path / "run"), max_files=1).collect()
    assert [(r.user_id, r.events) for r in got] == [(1, 3)]


def _profile_by_force(changes):
    """Live rows of a change feed, player by player (each change id once)."""
    from collections import Counter, defaultdict
    rows = {c.change_id: c for c in changes}.values()
    live = Counter()
    for c in rows:
        live[c.kind, c.player_id, c.at, c.value_id, c.value, c.amount] += 1 if c.op == "insert" else -1
    by = defaultdict(list)
    for (kind, player, *row), n in live.items():
        assert n >= 0
        by[player] += [(kind, *row)] * n
    out = []
    for player, own in by.items():
        games = [r for r in own if r[0] == "game"]
        count = Counter(r[3] for r in games if r[3] is not None)
        surveys = sorted((r[1] is None, r[1], r[2], r[3]) for r in own if r[0] == "survey")
        buys = [r for r in own if r[0] == "buy"]
        out.append((player, len(games) or None, sum(r[4] for r in games) if games else None,
                    min((-n, g) for g, n in count.items())[1] if count else None,
                    surveys[-1][2] if surveys else None, surveys[-1][3] if surveys else None,
                    len(buys) or None, sum(r[4] for r in buys) if buys else None, min(r[1] for r in buys) if buys else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", ["as_it_comes", "retractions_first", "shuffled"])
def test_profile_follows_retractions(spark, tmp_path, order):
    """Any file order, repeats, replays and folds: the features equal those of the live rows."""
    import random

    from paylens.sources.tables import Tables
    from paylens.streaming.incremental import StreamSettings
    from paylens.streaming.profile import CHANGE_SCHEMA, batch_writer, change_feed, current_profile
    from tests.conftest import SF0001
    feed = change_feed(Tables(spark, SF0001))
    changes = sorted(feed.collect(), key=lambda c: c.change_id)
    assert sum(c.op == "retract" for c in changes) > 100
    if order == "retractions_first":
        changes.sort(key=lambda c: c.op == "insert")
    if order == "shuffled":
        random.Random(1).shuffle(changes)
    n, s = len(changes), StreamSettings(compact_every=2)
    write = batch_writer(str(tmp_path / "sink"), s)
    for i in range(5):
        part = changes[i * n // 5: (i + 1) * n // 5] + changes[: 40 * i]      # with repeats of earlier ones
        frame = spark.createDataFrame([tuple(c) for c in part], feed.schema)
        for _ in range(2):
            write(frame, i)
    got = sorted((tuple(r) for r in current_profile(spark, str(tmp_path / "sink")).collect()), key=repr)
    assert got == _profile_by_force(changes)
    assert [f.name for f in feed.schema] == [c.split()[0] for c in CHANGE_SCHEMA.split(", ")]
    with pytest.raises(Exception, match="unknown operation"):
        write(frame.selectExpr("change_id + 100000 AS change_id", "'upsert' AS op", "day", "kind", "player_id", "at", "value_id", "value",
                               "amount"), 6)


def test_sessions_keep_late_rows(spark, events, tmp_path):
    """A third of the rows comes far behind the watermark; sessions equal the batch over all events."""
    import datetime as dt
    import random

    from paylens.streaming.sessions import SessionSettings, SessionTables, batch_writer, merged, on_time_sessions, pieces, sessions
    s = SessionSettings(compact_every=2, delay_minutes=60)
    rng = random.Random(4)
    rows = sorted(events.collect(), key=lambda r: r.ts)
    late = {r.event_id for r in rows if rng.random() < 0.3}
    chunks, n = [], len(rows)
    for i in range(4):
        span = rows[i * n // 4: (i + 1) * n // 4]
        before = rows[max(0, i - 1) * n // 4: i * n // 4] if i else []
        chunks.append([r for r in span if r.event_id not in late] + [r for r in before if r.event_id in late])
    chunks.append([r for r in rows[3 * n // 4:] if r.event_id in late] + chunks[0][:30])     # and repeats
    write = batch_writer(str(tmp_path / "sink"), s)
    for i, chunk in enumerate(chunks):
        frame = spark.createDataFrame(chunk, events.schema)
        for _ in range(2):
            write(frame, i)
    sink = str(tmp_path / "sink")
    got = sessions(spark, sink, s)
    by_player = {}
    for r in rows:
        own = by_player.setdefault(r.user_id, [])
        if own and r.ts <= own[-1][1] + dt.timedelta(minutes=30):
            own[-1][1], own[-1][2] = r.ts, own[-1][2] + 1
        else:
            own.append([r.ts, r.ts, 1])
    want = sorted((p, a, b + dt.timedelta(minutes=30), k) for p, own in by_player.items() for a, b, k in own)
    assert sorted(tuple(r) for r in got.select("player_id", "session_start", "session_end", "events").collect()) == want
    n_late = SessionTables.at(spark, sink).late.read().count()
    assert got.agg({"late_events": "sum"}).first()[0] == n_late > 0.25 * n
    early = on_time_sessions(spark, sink, s)
    assert early.agg({"events": "sum"}).first()[0] == n - n_late and early.filter("closed").count() > 0.9 * early.count()
    # pieces cut anywhere merge to the same sessions
    whole = merged(pieces(events, s))
    cut = merged(pieces(events.filter("event_id % 2 = 0"), s).unionByName(pieces(events.filter("event_id % 2 = 1"), s)))
    assert _collect(whole.drop("late_events")) == _collect(cut.drop("late_events")) == _collect(got.drop("late_events"))
    odd = spark.createDataFrame([(1, None, 5, "x", 1.0, None), (2, dt.datetime(2024, 1, 1), None, "x", 1.0, None)], events.schema)
    assert pieces(odd, s).collect() == []
    # a gap of exactly the limit, in one day and over midnight, is one session
    at = lambda day, h, m: dt.datetime(2024, 1, day, h, m)
    tie = spark.createDataFrame([(i, t, 1, "x", 1.0, None) for i, t in enumerate(
        [at(1, 8, 0), at(1, 8, 30), at(1, 23, 45), at(2, 0, 15), at(2, 0, 46)])], events.schema)
    assert sorted(r.events for r in merged(pieces(tie, s)).collect()) == [1, 2, 2]
