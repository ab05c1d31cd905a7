"""The prefix trie, hard negatives and the secret scan against brute force, and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import negatives, queries, secrets, trie

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, depth string, size long, a string"


def equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("conversations", "embeddings", "documents"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(map(str, want.fetchall()))
    assert sorted(str(tuple(r[c] for c in want.columns)) for r in got.collect()) == rows and rows


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_hard_negatives", "op13_secret_scan"])
def test_query_equals_its_sql(spark, name):
    equals_sql(spark, name)


# 11


def slow_trie(rows, rebuild):
    """rows: conv_id, turns in order."""
    built = {c: rows.get(rebuild(c)[0], [])[: rebuild(c)[1]] + own[rebuild(c)[1] :] for c, own in rows.items()}
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids[p])
    for p, some in members.items():
        ends = ",".join(map(str, sorted(c for c in some if len(built[c]) == len(p))))
        yield min(some), len(p), min(members[p[:-1]]) if p else None, len(some), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()


def heads(c):
    return c - c % 5, zlib.crc32(str(c).encode()) % 9


def by_conversation(rows):
    out = defaultdict(list)
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[c].append((role or "", text or ""))
    return dict(out)


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[1], r[0], r[-1]))


def odd_turns():
    say = lambda c, *texts: [(c, i or None, "user" if i % 2 == 0 else None, t, "x", 7, "y") for i, t in enumerate(texts)]
    rows = [r for c in range(0, 60) for r in say(c, "hello", "é" * (c % 3), None, *(f"turn {i % 2}" for i in range(c % 14)))]
    rows += [r for c in range(100, 130) for r in say(c, "same", "words")]
    rows += say(7001, "a") + say(7002, *["b"] * 12) + [(None, 1, "user", "nobody", "x", 7, "y")]
    return rows + [(9000, i, "user", f"t{i % 3}", "x", 7, "y") for i in range(700)]


@pytest.mark.parametrize("rebuild", ["own", "shared_heads"])
def test_trie_of_odd_rows(spark, rebuild, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_ROWS", 64)  # the long conversation fills many ranges
    rows = odd_turns()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = trie.trie(df, getattr(trie, rebuild)).collect()
    want = slow_trie(by_conversation(rows), heads if rebuild == "shared_heads" else lambda c: (c, 0))
    assert sorted_rows(got) == sorted_rows(want)


def test_trie_of_ties_repeated_rows_and_no_rows(spark):
    rows = [(1, 1, r, t, None, None, None) for r, t in (("user", "b"), ("user", "a"), ("user", "a"), ("x", None))] * 2
    one = sorted_rows(trie.trie(spark.createDataFrame(rows, TURNS)).collect())
    two = sorted_rows(trie.trie(spark.createDataFrame(rows[::-1], TURNS).repartition(4)).collect())
    assert one == two and [r[1] for r in one] == list(range(9)) and all(r[5] == 1 for r in one)
    assert trie.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_trie_roll_up_rounds_follow_the_logarithm_of_the_depth(spark):
    rows = [(c, i, "user", "x" if i < 290 else str(c), None, None, None) for c in range(3) for i in range(300)]
    nodes = trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    root = next(r for r in nodes if r["depth"] == 0)
    assert (root["n_convs"], root["n_children"], root["n_leaves"], root["saved_tokens"]) == (3, 1, 3, 580) and len(nodes) == 1 + 290 + 30


# 12

VECTORS = "vec_id long, embedding array<float>, label int, score double, codes string"


def slow_negatives(rows):
    fine = defaultdict(list)
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[i].append((label, [math.floor(256 * float(np.float32(x))) for x in v]))
    d = max((len(v) for some in fine.values() for _, v in some), default=0)
    table = [(i, (min(some)[0] + 1) % 10 if i % 7 == 0 else min(some)[0], np.array(min(some)[1] + [0] * (d - len(min(some)[1])), np.int64)) for i, some in sorted(fine.items())]
    for i, label, v in table:
        if i % 100 == 0:
            scores = sorted((-int(v @ w), j, own == label) for j, own, w in table if j != i)
            for s, j, _ in [x for x in scores if x[2]][:5]:
                window = [x for x in scores if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s]
                yield from ((i, j, r, k, -s, -t) for r, (t, k, _) in enumerate(window[:10], 1))


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(df, label, F.col("vec_id") % 100 == 0)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, [0.5, 0.2, 0.1], 1), (0, [0.5, 0.2, 0.1], 1), (0, [0.1, 0.2, 0.1], 4), (1, [0.5, 0.1, 0.3], 1), (2, [0.3, 0.1], 2), (3, None, 2), (4, [nan, 1.0], 1), (5, [None, 1.0], 2)]
    odd += [(6, [1.0, 1.0, 1.0], None), (None, [1.0], 2), (100, [-0.5, 0.2, 0.1], 2), (8, [0.3, 0.1], 3), (9, [0.3, 0.1], 3), (7, [inf], 3), (10, [], 1), (200, [0.0, 0.0, 0.0], 1)]
    rows = [(*r, 0.5, "x") for r in odd]
    got = mined(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(slow_negatives(rows))
    assert mined(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("kind", ["spread", "copies", "large"])
def test_negatives_equal_brute_force(spark, kind, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 10)) / 3
    if kind == "copies":  # a third of the rows is one vector: ties by vec_id
        x[::3] = x[0]
    if kind == "large":
        x *= 40_000
    rows = [(i, [float(c) for c in v.astype(np.float32)], int(k), None, None) for i, (v, k) in enumerate(zip(x, rng.integers(0, 10, len(x)), strict=True))]
    monkeypatch.setattr(negatives, "GROUP_ROWS", 100)
    got = sorted(map(tuple, mined(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == sorted(slow_negatives(rows)) and got


def test_bounds_hold_and_leave_most_rows_unscored():
    rng = np.random.default_rng(7)
    v = rng.integers(-100, 100, (3000, 8)) // rng.integers(1, 9, (3000, 1))
    centres = np.stack([v[:256, i * 4 : i * 4 + 4].astype(float) for i in range(2)])
    codes = np.stack([negatives.nearest(v[:, i * 4 : i * 4 + 4].astype(float), centres[i]) for i in range(2)], 1).astype(np.uint8)
    rest = np.stack([np.sqrt(((v[:, i * 4 : i * 4 + 4] - centres[i][codes[:, i]]) ** 2).sum(1)) for i in range(2)], 1).astype(np.float32) * np.float32(1.000001)
    table = {"id": np.arange(3000), "label": np.zeros(3000, int), "v": v, "codes": codes, "norms": rest}
    ask = {"id": np.array([-1, -2]), "label": np.array([1, 1]), "v": v[[5, 9]], "at": np.array([0, 0, 1]), "low": np.array([-(10**9), 0, 10]), "high": np.array([10**9, 900, 500])}
    best = negatives.group_search(ask, table, centres, 6, False)
    for w in range(3):
        scores = v @ ask["v"][ask["at"][w]]
        some = [i for i in np.lexsort((np.arange(3000), -scores)) if ask["low"][w] <= scores[i] <= ask["high"][w]][:6]
        assert best.row[best.window == w].tolist() == some


# 13

SLOW = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "key": r"[A-Za-z0-9+/]+",
    "login": r"""(?i:(user|username|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""",
    "endpoint": r"(https?|ftp|ssh|amqps?|mysql|postgres|postgresql|mongodb|redis|s3)://[A-Za-z0-9.:@_%-]+",
}


def slow_spans(text, scope=secrets.SCOPE):
    fine = {
        "assign": lambda m: len(m[2]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32, "login": lambda m: len(m[2]) >= 3, "endpoint": bool,
        "key": lambda m: len(m[0]) == 40 and all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]")),
    }
    every = [(m.start(), i, m.end()) for i, (k, p) in enumerate(SLOW.items()) for m in re.finditer(p, text or "", re.A) if fine[k](m)]
    base = [s for s in every if s[1] < 3]
    links = []
    for a, k, b in every:
        near = {p[1] for p in every if p[0] < b + scope and p[2] > a - scope and (p[2] <= a or p[0] >= b)}
        who, what, where = near & {1, 4}, near & {0, 2, 3}, 5 in near
        if k >= 3 and not any(s < b and e > a for s, _, e in base) and (who if k == 3 else what and where if k == 4 else who and what):
            links.append((a, k, b))
    names = list(SLOW)
    tell = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return tell(base), tell(base + links)


KEY = "aB3" + "x" * 30 + "YZ01234"
TEXTS = [
    None,
    "",
    f"user=bob key {KEY} at https://a.b:9/x password: hunter22x",
    f"{KEY} alone",
    "user=bob alone, https://a.b/ alone",
    "é\U0001f600 AKIA" + "A" * 12 + " " + KEY,
    "password=abc passwd=\"s3cret_value\" AKIAX " + "0" * 31 + " " + "a" * 40 + "g" + "b" * 32,
    "login: bob " + "z " * 150 + "https://x.y secret=abcdefgh1 " + KEY,
    f"token = '{KEY}' AKIA{'B' * 12}",
    "TOKEN='abcdefgh' Api_Key:\"12345678\" apikey =  short SECRET=",
    "ſecret=abcdefghi toKen=abcdefghi",
    " ".join(f"token={i:08d}" for i in range(1500)),
    "f" * 100_000 + " user=x1y " + "https://a.b " * 200 + "secret=12345678",
]


def test_secret_spans_equal_brute_force(spark):
    rows = [(i % 5 or None, t, "x", 1, "y") for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, base string, row long, weak string").repartition(3)
    got = secrets.scan(df).select("doc_id", secrets.told(F.col("base")).alias("base"), secrets.told(F.col("spans")).alias("spans")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *slow_spans(t))) for i, t, *_ in rows)
    assert secrets.scan(df.limit(0)).count() == 0


def test_weak_candidates_need_their_complements(spark):
    texts = {"key alone": KEY, "key and access": f"AKIA{'C' * 14} {KEY}", "far": f"AKIA{'C' * 14}{' ' * 201}{KEY}", "login and secret": "user=bob password=12345678", "all": "user=bob password=12345678 ssh://h.x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r["doc_id"]: r["n"] for r in secrets.scan(df).select("doc_id", (F.size("spans") - F.size("base")).alias("n")).collect()}
    assert got == {"key alone": 0, "key and access": 1, "far": 0, "login and secret": 0, "all": 2}


def test_secret_query_has_no_python(spark):
    assert "Python" not in queries.op13_secret_scan(spark, SF)._jdf.queryExecution().toString()
