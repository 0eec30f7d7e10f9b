"""The filter audit, the click windows and the URL rules against plain Python."""

import datetime as dt
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from leafmill.llm import audit, clicks, queries, url_rules

EPOCH = dt.datetime(1970, 1, 1)
CLICK = "click_id bigint, ts timestamp_ntz, arrived_at timestamp_ntz, client_id bigint, kind string, value double, props string"


def micros(x):
    return (x - EPOCH) // dt.timedelta(microseconds=1)


def windows_of(rows):
    """(click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc, hash) of every window, copy by copy."""
    text = lambda x: "" if x is None else str(x)
    copies = []
    for r in rows:
        if r["click_id"] is None or r["arrived_at"] is None:
            continue
        for j in range(r["click_id"] % 3 + 1):
            c = zlib.crc32(f"{r['click_id']}:{j}".encode())
            hour = micros(r["arrived_at"]) // 3_600_000_000 + 6 * j * (c % 10)
            value = None if r["value"] is None else math.floor(100 * r["value"] + 0.5)
            fields = (r["client_id"], r["kind"], value, None if r["ts"] is None else micros(r["ts"]), r["props"], c % 3)
            copies.append((hour + c // 10 % 200, r["click_id"], hour, hashlib.sha256("|".join(map(text, fields)).encode()).hexdigest()))
    if not copies:
        return []
    low, high = min(c[0] for c in copies), max(c[0] for c in copies)
    batches = [[] for _ in range(8)]
    for slot, *c in copies:
        batches[(slot - low) * 8 // (high - low + 1)].append(tuple(c))
    latest, open_, out = None, {}, []
    for b, batch in enumerate(batches):
        for i, hour, h in sorted(c for c in batch if latest is None or c[1] >= latest - 96):
            w = open_.get(i)
            if w and hour <= w[0] + 24:
                w[1] += 1
                if h != w[4]:
                    w[2] += 1
                    w[3] += zlib.crc32(h.encode())
            else:
                if w:
                    out.append((i, w[0], b, *w[1:]))
                open_[i] = [hour, 0, 0, 0, h]
        latest = max([*([] if latest is None else [latest]), *[c[1] for c in batch]], default=None)
        for i in [i for i, w in open_.items() if b == 7 or latest is not None and w[0] + 24 < latest - 96]:
            w = open_.pop(i)
            out.append((i, w[0], b, *w[1:]))
    return sorted(out)


def plain(df):
    return sorted(tuple(r) for r in df.select("click_id", "start_hour", "closed_batch", "n_repeats", "n_conflicts", "conflict_crc", "hash").collect())


def test_click_query_is_the_fold_of_its_contract(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/clicks.parquet").collect()]
    want = windows_of(rows)
    assert plain(queries.op12_click_dedup(spark, sf_dir)) == want
    assert len({w[2] for w in want}) == 8 and any(w[4] for w in want) and any(w[3] > w[4] for w in want)


@pytest.mark.parametrize("ids", [1, 64])
def test_click_windows_of_odd_rows(spark, ids):
    """Nulls, repeated rows, ties of an hour, hot ids, values that are no plain number, days without rows, other columns."""
    pick = random.Random(3)
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=pick.randrange(60))
    rows = [(pick.choice([2, 5, 5, 71, 8, 200, 4]), at(1), at(pick.choice([pick.randrange(60), pick.randrange(500), 900])), pick.choice([None, 1]), pick.choice(["a|b", "", None]), pick.choice([None, 0.125, -1.005, 3.0]), pick.choice([None, "{}"])) for _ in range(150)]
    rows += rows[:40] + [(None, at(1), at(2), 1, "a", 1.0, "{}"), (3, at(1), None, 1, "a", 1.0, "{}"), (-4, None, at(5), 1, "a", 1.0, "{}"), (1 << 62, at(3), at(9), 1, "é", 1.0, "x" * 50_000)]
    df = spark.createDataFrame(rows, CLICK)
    names = df.columns
    extra = df.selectExpr("*", "1 as block", "2 as hash", "3 as hour", "'x' as data", "4 as event", "5 as batch")
    assert plain(clicks.deduplicate(extra, ids=ids)) == windows_of([dict(zip(names, r, strict=True)) for r in rows])


def test_clicks_without_rows(spark):
    assert clicks.deduplicate(spark.createDataFrame([], CLICK)).count() == 0
    assert clicks.deduplicate(spark.createDataFrame([(None, None, None, 1, "a", 1.0, "")], CLICK)).count() == 0


def test_hours_do_not_depend_on_the_zone_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = [(i, dt.datetime(2024, 3, 10, 2, i % 60, 1, i), dt.datetime(2024, 3, 31, 2, 30), 1, "a", 1.0, "") for i in range(5)]
    found = []
    try:
        for z in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", z)
            found.append(sorted(map(tuple, clicks.copies(spark.createDataFrame(rows, CLICK)).collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == found[2]


def test_fold_is_the_fold_of_one_copy_after_another():
    pick = random.Random(5)
    for _ in range(200):
        rows = np.zeros(pick.randrange(0, 60), clicks.ROW)
        for r in rows:
            r["id"], r["hour"], r["n"], r["crc"], r["hash"] = pick.randrange(4), pick.randrange(1, 120), pick.randrange(1, 4), pick.randrange(1 << 32), (pick.randrange(2), 0, 0, pick.randrange(2) << 63)
        open_ = np.zeros(3, clicks.WINDOW)
        open_["id"], open_["start"], open_["n"] = [0, 2, 9], [pick.randrange(1, 60) for _ in range(3)], 7
        held, closed = {int(w["id"]): [int(w["start"]), 7, 0, 0, tuple(w["hash"])] for w in open_}, []
        for r in sorted((r for r in rows for _ in range(r["n"])), key=lambda r: (r["id"], r["hour"], tuple(r["hash"]))):
            w = held.get(int(r["id"]))
            if w and r["hour"] <= w[0] + 24:
                w[1] += 1
                if w[4] != tuple(r["hash"]):
                    w[2] += 1
                    w[3] += int(r["crc"])
            else:
                if w:
                    closed.append((int(r["id"]), *w))
                held[int(r["id"])] = [int(r["hour"]), 0, 0, 0, tuple(r["hash"])]
        left, done = clicks.fold(open_, rows)
        as_rows = lambda ws: sorted((int(w["id"]), int(w["start"]), int(w["n"]), int(w["conflicts"]), int(w["crc"]), tuple(w["hash"])) for w in ws)
        assert as_rows(left) == sorted((i, *w) for i, w in held.items())
        assert as_rows(done) == sorted(closed)


# --- audit ------------------------------------------------------------------------------------------


def audited(docs, labelled):
    """Rows of the report: docs (doc_id, lang, text), labelled (doc_id, quality, toxic)."""
    first, fails, out = {}, [], []
    for i, _, text in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = ({i for i, *x in labelled if x[k] == 1 and i is not None} for k in (0, 1))
    for i, lang, text in docs:
        text = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        flags = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), i is not None and first[text] < i)
        fails.append((lang or "", {x for x, f in zip("ABCDE", flags, strict=True) if f}, i in good, i in toxic))
    for part in {f[0] for f in fails}:
        mine, made, total = [f[1:] for f in fails if f[0] == part], [], defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            for k, x in enumerate(order):
                here = [f for f in mine if x in f[0] and not f[0] & set(order[:k])]
                total[x] += len(here)
                made.append((part, "".join(order), k + 1, sum(not f[0] & set(order[: k + 1]) for f in mine), len(here), sum(x in f[0] for f in mine) - len(here), sum(f[0] == {x} for f in mine), sum(f[1] for f in here), sum(f[2] for f in here), x))
        out += [(*m[:-1], total[m[-1]]) for m in made]
    return sorted(out)


COUNTS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_of_odd_rows(spark):
    """Null and empty texts, languages and ids, copies and repeated rows, many parts, several labels of one document, a long text."""
    pick = random.Random(1)
    texts = [None, "", "A", "a b c", "x # y", "Word " * 250, " ".join(map(str, range(300))), " ".join(map(str, range(250))) + " $", "Ä" * 40 + "Q", "long " * 60_000, "\x0b\x0c \t"]
    docs = [(pick.choice([None, *range(60)]), pick.choice([None, "", "de", "en", "en"]), pick.choice(texts)) for _ in range(300)] + [(1000 + i, f"l{i}", "a") for i in range(150)]
    docs += docs[:20]
    labelled = [(pick.choice([None, *range(60)]), pick.choice([0, 1, None]), pick.choice([0, 1, None])) for _ in range(70)]
    df = spark.createDataFrame(docs, "doc_id bigint, lang string, text string").selectExpr("*", "1 as part", "2 as fails", "3 as key", "4 as first", "5 as marks", "6 as words", "7 as own")
    found = audit.audit_filters(df, spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int"), block=100)
    assert sorted(tuple(r) for r in found.select(*COUNTS).collect()) == audited(docs, labelled)


def test_audit_without_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert audit.audit_filters(none, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_audit_of_other_filters(spark):
    """Two filters and one label; without label rows nothing is lost."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "x", "aa"), (2, "x", "ab"), (3, "x", "b"), (4, "y", "aa")], "doc_id bigint, lang string, text string")
    filters = {"P": F.col("text").contains("a"), "Q": None}
    found = audit.audit_filters(docs, spark.createDataFrame([(1, 1)], "doc_id bigint, mark int"), filters, {"lost": "mark"})
    rows = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost"], r["shapley"]) for r in found.collect()}
    assert rows == {
        ("x", "PQ", 1): (1, 2, 0, 2, 1, 4), ("x", "PQ", 2): (1, 0, 0, 0, 0, 0), ("x", "QP", 1): (3, 0, 0, 0, 0, 0), ("x", "QP", 2): (1, 2, 0, 2, 1, 4),
        ("y", "PQ", 1): (0, 1, 0, 0, 0, 1), ("y", "PQ", 2): (0, 0, 1, 0, 0, 1), ("y", "QP", 1): (0, 1, 0, 0, 0, 1), ("y", "QP", 2): (0, 0, 1, 0, 0, 1),
    }


# --- URL rules --------------------------------------------------------------------------------------


def judged(url, rules, default="allow"):
    rest = re.match(r"[^?#]*", url.partition("://")[2], re.S)[0] if url and "://" in url else ""
    host, slash, path = rest.partition("/")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fit = [(r[1].count(".") + 1, len(r[2]), r[0] == "allow", r) for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fit, default=None)
    return host, path, best and best[3][1] + best[3][2], best[3][0] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.org", "http://example.org/", "https://a.Example.org/es/x?y#z", "http://example.org/es", "http://example.org/en/1", "http://example.org/en/123/4", "http://example.org/en/2", "http://badexample.org/es/",
    "http://x.com/fr/?a", "http://x.com/de/#b", "http://x.com/de", "http://com/de/", "ftp://y.net/a", "http://example.org:80/es/", "http://user@example.org/es/", "http://example.org./es/", "http://a?b/c://d", "x://y#://z/", "http://.org/", "http://ÄB.org/Ö/" + "p/" * 20_000,
]


def test_url_rules_of_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 as HOST", "'r' as rule", "2 as row", "3 as best", "4 as a0")
    found = url_rules.judge(df)
    assert sorted(found.columns) == ["a0", "best", "host", "page_id", "path", "row", "rule", "url", "verdict"]
    got = sorted((tuple(r) for r in found.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert got == sorted(((i, *judged(u, url_rules.RULES)) for i, u in rows), key=str)
    assert {tuple(r) for r in found.select("row", "best", "a0").collect()} == {(2, 3, 4)}
    assert url_rules.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in url_rules.judge(df, (), "block").collect()} == {"block"}


def test_many_rules_go_into_several_tries(spark):
    pick = random.Random(2)
    hosts, paths = ["a", "b.a", "c.b.a", "d", "b.d", ""], ["", "/", "/x", "/x/", "/x/y", "/xy", "/x/y/z", "//"]
    rules = [(pick.choice(["allow", "block"]), pick.choice(hosts), pick.choice(paths)) for _ in range(40)]
    urls = [f"http://{h}{p}{q}" for h in [*hosts, "q.c.b.a", "ba", "x.d"] for p in [*paths, "/x/yz", "/z"] for q in ("", "?k", "#k")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for most in (7, 1000):
        found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(df, rules, "block", most=most).collect()}
        assert found == {i: judged(u, rules, "block") for i, u in enumerate(urls)}
    with pytest.raises(ValueError):
        url_rules.judge(df, [("maybe", "a", "")])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_are_their_sql(spark, sf_dir, name):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    mine, theirs = queries.queries()[name](spark, sf_dir), con.execute(queries.ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(mine.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in mine.select(*names).collect()))) == sorted(map(str, theirs.fetchall()))
