"""Command-log replay (TX5, WN1, WN3, WN4, JN2, TX3) and the joins behind it."""

import datetime as dt
import random

from pyspark.sql import functions as F

from netquery.functions import text as TX
from netquery.operators import joins as J
from netquery.operators import sessions as S

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _cmds(spark, rows):
    data = [(i, sid, T0 + dt.timedelta(seconds=s, microseconds=us), line) for i, (sid, s, us, line) in enumerate(rows)]
    return spark.createDataFrame(data, "cmd_id long, session_id string, ts timestamp_ntz, line string")


def _tel(spark, rows):
    data = [(T0 + dt.timedelta(seconds=s), t, h, k) for k, (s, t, h) in enumerate(rows)]
    return spark.createDataFrame(data, "ts timestamp_ntz, temp double, hum double, seq long")


def _replay(spark, cmds, tel=None, sessions=None):
    r = S.server_responses(_cmds(spark, cmds), tel, sessions, telemetry_order="seq" if tel is not None else None)
    return [x.response for x in r.orderBy("cmd_id").collect()]


def test_smoke_sequence(spark):
    cmds = [("a", 20, 0, "LOGIN USER -"), ("a", 21, 0, "PING"), ("a", 22, 0, "GET_DATA TEMP"),
            ("a", 23, 0, "LIST_USERS"), ("a", 24, 0, "LOGOUT")]
    out = _replay(spark, cmds, _tel(spark, [(15, 23.5, 60.2)]))
    assert out == ["LOGIN_SUCCESS USER", "PONG", f"DATA {int((T0 + dt.timedelta(seconds=15)).replace(tzinfo=dt.timezone.utc).timestamp())} TEMP=23.5",
                   "ERROR No tienes permisos", None]


def test_rate_limit_and_slots(spark):
    cmds = [("a", 1, 100, "PING"), ("a", 1, 900, "PING"), ("a", 2, 0, "PING"),
            ("a", 5, 0, "GET_DATA PRES"), ("a", 5, 500, "GET_DATA TEMP"), ("a", 6, 0, "GET_DATA")]
    out = _replay(spark, cmds)
    assert out[:3] == ["PONG", "ERROR Rate limit", "PONG"]
    assert out[3] == "ERROR Unknown var"          # unknown variable still uses the slot
    assert out[4] == "ERROR Rate limit"
    assert out[5] == "DATA 0 TEMP=0.0;HUM=0.0"    # before the first tick: zeros


def test_admin_state_and_moves(spark):
    cmds = [("a", 1, 0, "MOVE UP"), ("a", 2, 0, "LOGIN ADMIN wrong"), ("a", 3, 0, "LOGIN ADMIN admin"),
            ("a", 4, 0, "LOGIN USER -"), ("a", 5, 0, "MOVE"), ("a", 6, 0, "MOVE LEFT"), ("b", 7, 0, "MOVE UP"),
            ("b", 8, 0, ""), ("b", 9, 0, "JUMP")]
    out = _replay(spark, cmds)
    assert out[0] == "ERROR No tienes permisos"
    assert out[1] == "LOGIN_FAIL" and out[2] == "LOGIN_SUCCESS ADMIN" and out[3] == "LOGIN_SUCCESS USER"
    assert out[4] == "ERROR Invalid command"
    assert out[5] == "MOVE_SUCCESS LEFT"           # no recorded obstacle
    assert out[6] == "ERROR No tienes permisos"    # admin ends with the session
    assert out[7] == "ERROR Invalid command" and out[8] == "ERROR Invalid command"


def test_list_users_through_interval_join(spark):
    ses = spark.createDataFrame([
        ("a", "10.0.0.1", 5000, T0, T0 + dt.timedelta(hours=3)),
        ("b", "10.0.0.2", 5001, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=2)),
        ("c", "10.0.0.3", 5002, T0 + dt.timedelta(hours=4), T0 + dt.timedelta(hours=5))],
        "session_id string, ip string, port int, connect_ts timestamp_ntz, disconnect_ts timestamp_ntz")
    cmds = [("a", 0, 0, "LOGIN ADMIN admin"), ("a", 5400, 0, "LIST_USERS")]
    out = _replay(spark, cmds, None, ses)
    assert out[1] == "USER_LIST 10.0.0.1:5000;10.0.0.2:5001;"


def test_parse_commands_tokens(spark):
    df = spark.createDataFrame([("  LOGIN  ADMIN pw \n",), ("\n",), ("GET_DATA",)], "line string")
    r = TX.parse_commands(df, "line").collect()
    assert (r[0].verb, r[0].arg1, r[0].arg2, r[0].parse_error) == ("LOGIN", "ADMIN", "pw", None)
    assert r[1].verb is None and r[1].parse_error == "ERROR Invalid command"
    assert (r[2].verb, r[2].arg1) == ("GET_DATA", None)


def test_asof_join_hot_key_against_brute_force(spark):
    rnd = random.Random(11)
    left = [(i, "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 3)}", rnd.randint(0, 5000)) for i in range(300)]
    right = [(j, "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 3)}", rnd.randint(0, 5000)) for j in range(200)]
    L = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in left], "id long, k string, ts timestamp_ntz")
    R = spark.createDataFrame([(j, k, T0 + dt.timedelta(seconds=s)) for j, k, s in right], "rid long, k string, rts timestamp_ntz")
    got = {r.id: r.r_rid for r in J.asof_join(L, R, ["k"], "ts", "rts", ["rid"], bucket_seconds=300,
                                             right_order="rid").collect()}
    for i, k, s in left:
        cand = [(rs, j) for j, kk, rs in right if kk == k and rs <= s]
        assert got[i] == (max(cand)[1] if cand else None)


def test_interval_join_and_concurrency(spark):
    rnd = random.Random(5)
    iv = []
    for n in range(40):
        a = rnd.randint(0, 20000)
        iv.append((f"s{n}", T0 + dt.timedelta(seconds=a), T0 + dt.timedelta(seconds=a + rnd.randint(0, 9000))))
    ses = spark.createDataFrame(iv, "session_id string, connect_ts timestamp_ntz, disconnect_ts timestamp_ntz")
    pts = spark.createDataFrame([(p, T0 + dt.timedelta(seconds=p * 500)) for p in range(60)], "p int, t timestamp_ntz")
    got = {(r.p, r.session_id) for r in J.interval_join(pts, ses, "t", "connect_ts", "disconnect_ts").collect()}
    exp = {(p, s) for p in range(60) for s, a, b in iv if a <= T0 + dt.timedelta(seconds=p * 500) <= b}
    assert got == exp
    conc = {r.session_id: r.concurrent for r in S.concurrency(ses).collect()}
    for s, a, b in iv:
        assert conc[s] == sum(1 for _, a2, b2 in iv if a2 <= a <= b2)


def test_rate_limit_hour_clock(spark):
    rows = [(i, i % 3, T0 + dt.timedelta(minutes=17 * i)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz")
    got = {r.id: r.accepted for r in S.rate_limit(df, ["k"], "ts", "id", resolution_seconds=3600).collect()}
    seen = set()
    for i, k, t in rows:
        hour = (k, t.replace(minute=0, second=0, microsecond=0))
        assert got[i] == (hour not in seen)
        seen.add(hour)


def test_resolve_mail_golden(spark):
    dom = spark.createDataFrame([("example.test",), ("nomx.org",)], "domain string")
    mx = spark.createDataFrame([("example.test", 20, "backup.example.test"),
                                ("example.test", 10, "mail.example.test")], "domain string, priority int, host string")
    a = spark.createDataFrame([("mail.example.test", "192.0.2.10"), ("backup.example.test", "192.0.2.20")],
                              "host string, ip string")
    r = J.resolve_mail(dom, mx, a).orderBy("domain", "preference").collect()
    assert [(x.domain, x.preference, x.priority, x.host, x.ip) for x in r] == [
        ("example.test", 1, 10, "mail.example.test", "192.0.2.10"),
        ("example.test", 2, 20, "backup.example.test", "192.0.2.20"),
        ("nomx.org", None, None, None, None)]


def test_rate_limit_interval_against_greedy(spark):
    rnd = random.Random(3)
    rows, i = [], 0
    for k in ["hot"] * 6 + ["a", "b"]:
        for _ in range(60):
            rows.append((i, k, T0 + dt.timedelta(seconds=rnd.randint(0, 4000), microseconds=rnd.randint(0, 999999))))
            i += 1
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz")
    got = {r.id: r.accepted for r in S.rate_limit_n(df, ["k"], "ts", "id", interval_seconds=7, block_seconds=60).collect()}
    last = {}
    for rid, k, t in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        sec = int(t.replace(tzinfo=dt.timezone.utc).timestamp())
        ok = k not in last or sec - last[k] >= 7
        if ok:
            last[k] = sec
        assert got[rid] == ok, (rid, k, t)


def test_recorded_obstacles(spark):
    rows = [("a", i, T0 + dt.timedelta(seconds=i), line, hit) for i, (line, hit) in
            enumerate([("LOGIN ADMIN admin", True), ("MOVE UP", True), ("MOVE UP", False), ("MOVE UP", None), ("MOVE", True)])]
    df = spark.createDataFrame(rows, "session_id string, cmd_id long, ts timestamp_ntz, line string, hit boolean")
    out = [r.response for r in S.server_responses(df, obstacle="hit").orderBy("cmd_id").collect()]
    assert out == ["LOGIN_SUCCESS ADMIN", "MOVE_FAIL UP OBSTACLE", "MOVE_SUCCESS UP", "MOVE_SUCCESS UP", "ERROR Invalid command"]


def test_transfer_functions_compose():
    import numpy as np
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n, fan = int(rnd.integers(1, 12)), int(rnd.integers(2, 6))
        B = n + int(rnd.integers(0, 10))
        numbers = sorted(rnd.choice(fan, size=int(rnd.integers(1, fan + 1)), replace=False).tolist())
        secs = {b: np.sort(rnd.choice(B, size=int(rnd.integers(1, B + 1)), replace=False)) + b * B for b in numbers}
        functions = [S._narrow(secs[b] - b * B, S._chain(secs[b], b * B, (b + 1) * B, n)[1], n) for b in numbers]
        offs, vals = S._composed(numbers, functions, 0, fan, n)
        assert len(vals) == len(offs) + 1 <= n
        for entry in range(n):
            free = entry
            for s in np.concatenate(list(secs.values())).tolist():
                free = s + n if s >= free else free
            assert int(S._apply(offs, vals, entry)) == max(0, free - fan * B)


def test_rate_limit_n_hot_key_over_tree(spark):
    """One key with nearly all rows, long gaps, and trees of many levels: equal to the loop."""
    import random
    rnd = random.Random(11)
    secs = [0]
    for _ in range(400):
        secs.append(secs[-1] + rnd.choice([0, 1, 2, 3, 5, 9, 40, 5000]))
    rows = [(i, "hot", s) for i, s in enumerate(secs)] + [(1000, "cold", 7), (1001, "cold", 8)]
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in rows], "id long, k string, ts timestamp_ntz")
    expect, last = {}, {}
    for i, k, s in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        expect[i] = k not in last or s - last[k] >= 5
        if expect[i]:
            last[k] = s
    for fan, block in ((64, 5), (1024, 3600)):
        got = {r.id: r.accepted for r in S.rate_limit_n(df, ["k"], "ts", "id", 5, block_seconds=block, fan=fan).collect()}
        assert got == expect, (fan, block)


def test_open_lists_stay_inside_the_row(spark):
    """A point meets its intervals in a list of its own row, not in a row for each pair."""
    r = random.Random(5)
    t0 = dt.datetime(2024, 1, 1, 22, 30)
    at = lambda: t0 + dt.timedelta(minutes=r.randrange(240))
    iv = [(f"u{i}" if i % 9 else None, *(x if i % 7 == 0 else sorted(x))) for i in range(60) for x in [[at(), at()]]]
    asks = [(i, None if i % 4 == 0 else [t] * (1 + i % 2)) for i in range(80) for t in [at()]]
    points = spark.createDataFrame(asks, "id long, at array<timestamp_ntz>")
    intervals = spark.createDataFrame(iv, "v string, s timestamp_ntz, e timestamp_ntz")
    got = J.attach_open(points, intervals, "at", "s", "e", F.col("v")).select("id", J.open_values("open", "at").alias("v")).collect()
    assert len(got) == len(asks)
    want = {i: sorted(v for t in ts for v, s, e in iv if v and s <= t <= e) for i, ts in asks if ts}
    assert {x.id: x.v or [] for x in got if x.id % 4} == want
    assert all(x.v is None for x in got if x.id % 4 == 0)


def test_user_list_of_repeated_ids(spark):
    """Rows of one id get the users of all its instants, within an hour and across hours."""
    day = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    login = ("a", 0, day(1, 0), "LOGIN ADMIN admin")
    rows = [login, ("a", 1, day(2, 0), "LIST_USERS"), ("a", 1, day(2, 0), "LIST_USERS"), ("a", 2, day(3, 0), "LIST_USERS"),
            ("a", 2, day(5, 0), "LIST_USERS"), ("a", 3, day(9, 0), "LIST_USERS")]
    cmds = spark.createDataFrame(rows, "session_id string, cmd_id long, ts timestamp_ntz, line string")
    sess = spark.createDataFrame([("x", "1.1.1.1", 7, day(0, 0), day(4, 0)), ("y", "2.2.2.2", 8, day(1, 30), day(6, 0)), ("z", None, 9, day(1, 0), day(9, 30))],
                                 "session_id string, ip string, port int, connect_ts timestamp_ntz, disconnect_ts timestamp_ntz")
    got = {(r.cmd_id, r.ts.hour): r.response for r in S.server_responses(cmds, None, sess).collect() if r.cmd_id}
    x, y = "1.1.1.1:7;", "2.2.2.2:8;"
    assert got == {(1, 2): "USER_LIST " + x * 2 + y * 2, (2, 3): "USER_LIST " + x + y * 2, (2, 5): "USER_LIST " + x + y * 2, (3, 9): "USER_LIST "}
