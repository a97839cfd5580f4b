"""Blockwise scans against plain loops, with one key that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from chatlog import session
from chatlog.operators import concurrency, rollover, scan, sessions, usage
from chatlog.operators.changes import apply_changes
from chatlog.operators.skew import salted_join
from chatlog.plans import inputs


def skewed(n=400, seed=1):
    rng = random.Random(seed)
    keys = [0 if rng.random() < 0.6 else rng.randrange(1, 8) for _ in range(n)]
    return [(k, i * 3 + rng.randrange(3), rng.choice([None, 0, 1, 5, 20])) for i, k in enumerate(keys)]


def by_key(rows):
    out = {}
    for k, o, v in sorted(rows, key=lambda r: r[:2]):
        out.setdefault(k, []).append((o, v))
    return out


@pytest.fixture(params=[0, 60, 10**6], ids=["all-large", "one-large", "none-large"])
def hot(request, monkeypatch):
    """How many rows make a key large."""
    monkeypatch.setattr(scan, "HOT_ROWS", request.param)


@pytest.mark.parametrize("size", [7, 10_000])
def test_block_scan(spark, size, hot):
    rows = skewed()
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = scan.block_scan(
        df, ["k"], ["o"], scan.blocks_of("o", size),
        sums={"s": F.coalesce("v", F.lit(0))}, lasts={"l": F.col("v")}, lasts_before={"b": F.col("v")},
        lags={"p": F.col("v")}, leads={"n": F.col("v")}, totals={"t": F.lit(1)},
    ).collect()
    want = {}
    for k, items in by_key(rows).items():
        total, last = 0, None
        for i, (o, v) in enumerate(items):
            before, total = last, total + (v or 0)
            last = last if v is None else v
            want[k, o] = (
                total, last, before, items[i - 1][1] if i else None,
                items[i + 1][1] if i + 1 < len(items) else None, len(items),
            )
    assert {(r.k, r.o): (r.s, r.l, r.b, r.p, r.n, r.t) for r in got} == want


@pytest.mark.parametrize("order", ["o", "o * 5000000", "lpad(o, 9, '0')"], ids=["dense", "sparse", "text"])
def test_blocks_by_rows(spark, order, hot, monkeypatch):
    """Blocks of bounded size, whatever the distances or the type of the order column."""
    monkeypatch.setattr(scan, "BLOCK_ROWS", 25)
    rows = skewed(seed=8)
    df = spark.createDataFrame(rows, "k long, o long, v long").selectExpr("k", "o", f"{order} AS at", "v")
    cut = scan.with_blocks(df, ["k"], order=["at"])
    sizes = [r["count"] for r in cut.filter("_block is not null").groupBy("k", "_block").count().collect()]
    assert all(n <= 100 for n in sizes) and (not sizes or len(sizes) > 5)
    got = scan.block_scan(df, ["k"], ["at"], sums={"s": F.coalesce("v", F.lit(0))}, leads={"n": F.col("v")}).collect()
    want = {}
    for k, items in by_key(rows).items():
        total = 0
        for i, (o, v) in enumerate(items):
            total += v or 0
            want[k, o] = (total, items[i + 1][1] if i + 1 < len(items) else None)
    assert {(r.k, r.o): (r.s, r.n) for r in got} == want


@pytest.mark.parametrize("head", [1, 16, 10_000])
def test_ordered_concat(spark, head):
    rows = [(k, o, None if v is None else str(v)) for k, o, v in skewed(seed=2)]
    df = spark.createDataFrame(rows, "k long, o long, v string")
    got = scan.ordered_concat(
        df, ["k"], "o", {"x": "v"}, sep="\n", any_of={"big": F.col("v") == "20"}, head=head
    ).collect()
    want = {
        k: ("\n".join(v for _, v in items if v is not None), any(v == "20" for _, v in items))
        for k, items in by_key(rows).items()
    }
    assert {r.k: (r.x, r.big) for r in got} == want


def test_exact_quantiles(spark, duck, hot):
    rows = [(k, v) for k, _, v in skewed(seed=3) if v is not None]
    df = spark.createDataFrame(rows, "k long, v long")
    got = scan.exact_quantiles(df, ["k"], "v", {"a": 0.5, "b": 0.9, "c": 1.0}, width=4).collect()
    values = ", ".join(f"({k}, {v})" for k, v in rows)
    want = duck.sql(
        f"SELECT k, quantile_cont(v, 0.5), quantile_cont(v, 0.9), quantile_cont(v, 1.0) FROM (VALUES {values}) t(k, v) GROUP BY k"
    ).fetchall()
    assert {r.k: [r.a, r.b, r.c] for r in got} == {k: pytest.approx(qs) for k, *qs in want}


def folded(rows, limit, breaks=()):
    """(key, order) -> (generation, session tokens), one request after the other."""
    out = {}
    for k, items in by_key(rows).items():
        generation, used = -1, None
        for o, v in items:
            if used is None or used > limit or (k, o) in breaks:
                generation, used = generation + 1, 0
            used += v or 0
            out[k, o] = (generation, used)
    return out


@pytest.mark.parametrize("limit, gather, cells", [
    (0, 0, 1), (7, 0, 1), (7, 0, 3), (60, 0, 2), (60, 10_000, None), (60, 20, 5), (10**9, 0, None),
])
def test_rollover(spark, monkeypatch, limit, gather, cells):
    monkeypatch.setattr(scan, "HOT_ROWS", 60)
    rows = skewed(seed=limit + 5)
    breaks = {(k, o) for k, o, _ in rows if o % 29 == 0}
    df = spark.createDataFrame([(*r, r[:2] in breaks) for r in rows], "k long, o long, v long, cut boolean")
    got = rollover.session_rollover(
        df, ["k"], ["o"], "v", scan.blocks_of("o", 50), limit=limit, breaks=F.col("cut"), gather=gather, cells=cells
    ).collect()
    assert {(r.k, r.o): (r.generation, r.session_tokens) for r in got} == folded(rows, limit, breaks)


@pytest.mark.parametrize("seed, limit, fan", [(1, 7, 2), (2, 0, 2), (3, 19, 3), (4, 40, 2)])
def test_rollover_by_a_tree(spark, monkeypatch, seed, limit, fan):
    """Many levels of step functions, with stretches in between that hold no request."""
    monkeypatch.setattr(rollover, "FAN", fan)
    rng = random.Random(seed)
    rows = [(k, o, v if rng.random() < 0.95 else 500) for k, o, v in skewed(n=300, seed=seed)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = rollover.session_rollover(df, ["k"], ["o"], "v", limit=limit, gather=0, cells=1).collect()
    assert {(r.k, r.o): (r.generation, r.session_tokens) for r in got} == folded(rows, limit)


def test_rollover_of_no_rows(spark):
    df = spark.createDataFrame([], "k long, o long, v long")
    assert rollover.session_rollover(df, ["k"], ["o"], "v").collect() == []


def test_session_history_writes_two_tables(spark, sf_dir, monkeypatch):
    get, written = inputs.open_inputs(spark, sf_dir), []
    requests, conversations = get("requests"), get("conversations")
    for module in (sessions, scan, rollover):
        monkeypatch.setattr(module, "settled", lambda df: written.append(df) or session.settled(df))
    history = sessions.session_history(requests, conversations, limit=100)
    rows = sorted(map(tuple, history.collect()))
    assert len(written) == 2
    monkeypatch.setattr(rollover.session_rollover, "__defaults__", tuple(5 if d == rollover.GATHER else d for d in rollover.session_rollover.__defaults__))
    assert sorted(map(tuple, sessions.session_history(requests, conversations, limit=100).select(*history.columns).collect())) == rows
    assert len(written) > 6


def test_rollover_golden(spark):
    rows = [(1, 1, 60000), (1, 2, 30000), (1, 3, 10), (2, 1, 80000), (2, 2, 10)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = rollover.session_rollover(df, ["k"], ["o"], "v", scan.blocks_of("o", 50)).collect()
    assert {(r.k, r.o): r.generation for r in got} == {(1, 1): 0, (1, 2): 0, (1, 3): 1, (2, 1): 0, (2, 2): 0}


def logs(spark, spans):
    """Logs of one account from (start, end) minutes."""
    rows = [(i, 1, (e - s) * 60_000, f"2024-01-01 00:{e:02d}:00") for i, (s, e) in enumerate(spans)]
    df = spark.createDataFrame(rows, "id long, account_id long, duration_ms long, t string")
    return df.withColumn("created_at", F.col("t").cast("timestamp_ntz"))


@pytest.mark.parametrize("minutes", [1])
def test_concurrency(spark, minutes, hot):
    profile = concurrency.concurrency_profile(logs(spark, [(0, 10), (5, 15), (10, 20), (5, 5)]), minutes)
    assert [(r["at"].minute, r.in_flight) for r in profile.orderBy("at").collect()] == [
        (0, 1), (5, 2), (10, 2), (15, 1), (20, 0)
    ]
    peak = concurrency.concurrency_peaks(profile, cap=2).first()
    assert (peak.max_in_flight, peak.us_at_cap) == (2, 10 * 60 * 10**6)


def test_page_in_a_crowded_second(spark, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", 20)
    monkeypatch.setattr(scan, "BLOCK_ROWS", 30)
    rows = [(i * 7 % 400, f"2024-01-01 00:00:0{i % 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("created_at", F.col("t").cast("timestamp_ntz"))
    want = sorted(rows, key=lambda r: (-int(r[1][-1]), r[0]))
    for page in (1, 5, 9):
        got = usage.page_logs(df, page=page, limit=40, top_k_rows=0).collect()
        assert [r.id for r in got] == [i for i, _ in want[40 * (page - 1):40 * page]]


def test_salted_join(spark):
    rows = spark.createDataFrame([(r[0], r[1]) for r in skewed(seed=9)], "k long, o long")
    lookup = spark.createDataFrame([(0, "a"), (3, "b"), (99, "c")], "k long, x string")
    plain = rows.join(lookup, "k", "left")
    salted = salted_join(rows, lookup, ["k"], spread_by="o")
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_salted_join_repeats_only_what_is_met(spark):
    """A long lookup of which few rows are met: it is neither broadcast whole nor repeated whole."""
    rows = spark.createDataFrame([(i % 3, i) for i in range(60)] + [(None, 1)], "k long, o long")
    lookup = spark.range(100_000).select(F.col("id").alias("k"), F.lit(True).alias("x"))
    for how in ("left", "inner"):
        for more in ({}, {"among": rows.unionAll(rows)}):
            salted = salted_join(rows, lookup, ["k"], spread_by="o", how=how, **more)
            assert "BroadcastExchange" not in salted._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, rows.join(lookup, "k", how).collect()), key=str)


def test_apply_changes(spark):
    base = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", 6, "y"), (3, "c", 7, "z")], "id long, name string, n long, other string")
    log = [
        (1, 10, "update", "A", 1, ["name"]), (1, 11, "update", None, 2, []),
        (2, 10, "delete", None, None, []), (3, 10, "delete", None, None, []),
        (3, 11, "upsert", "C", 4, ["name"]), (4, 10, "upsert", None, 9, ["name"]), (5, 9, "upsert", "e", 1, ["name"]),
        (5, 10, "delete", None, None, []), (1, 12, "update", None, None, ["name"]),
    ]
    changes = spark.createDataFrame(log, "id long, seq long, op string, name string, n long, fields array<string>")
    got = apply_changes(base, changes, sets=["name"], adds=["n"])
    assert sorted(map(tuple, got.collect())) == [
        (1, None, 8, "x"), (3, "C", 4, None), (4, None, 9, None)
    ]
    kept = apply_changes(base, changes, sets=["name"], adds=["n"], insert=False)
    assert sorted(r.id for r in kept.collect()) == [1, 3]
