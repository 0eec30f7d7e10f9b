"""Rows that are hard to tell apart, input columns with the operators' own names, and results computed here from first to last."""

import ast
import hashlib
import math
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import audit, bpe, media, near_copies, packing, pfor, quality, simhash, suffix_dedup, token_counts, toxicity, url_rules, warc
from leafmill.llm.tokenizing import vocabulary

random.seed(11)
WORDS = [random.choice("abcdefgh") + random.choice("aeiou") + random.choice("lmnrst") for _ in range(60)]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def test_rows_without_ids_whose_hashes_collide(spark):
    """Texts with equal 32-bit hashes, one of which repeats itself: only that one loses bytes, in the operator and in the pipeline's stage."""
    ids = spark.range(200_000)
    twice = ids.select(F.concat(F.col("id").cast("string"), F.lit(" again and again, again and again")).alias("a")).withColumn("h", F.hash("a"))
    once = ids.select(F.concat(F.lit("q"), F.col("id").cast("string"), F.lit("zyxwv")).alias("b")).withColumn("h", F.hash("b"))
    pairs = [(r["a"], r["b"]) for r in twice.join(once, "h").limit(5).collect()]
    assert pairs
    docs = spark.createDataFrame([(None, t) for t in (pairs[0][0], pairs[0][1])], "doc_id bigint, text string")
    lost = {r["n_bytes"]: r["n_removed"] for r in suffix_dedup.digest(docs, 12, 6).collect()}
    assert lost[len(pairs[0][0])] > 0 and lost[len(pairs[0][1])] == 0
    assert pairs[0][1] in [r["text"] for r in suffix_dedup.remove(docs, 12, 6).collect()]
    assert near_copies.deduplicate(docs).count() == 2


def own_names():
    """Every string in the operators' code that could be a column's name."""
    found = set()
    for p in pathlib.Path(suffix_dedup.__file__).parent.glob("*.py"):
        for x in ast.walk(ast.parse(p.read_text())):
            if isinstance(x, ast.Constant) and isinstance(x.value, str):
                found |= {w for w in re.findall(r"\b_{0,2}[a-z]\w{0,14}\b", x.value)} if len(x.value) < 60 else set()
    return sorted(n for n in {x.lower() for x in found} - {"doc_id", "text", "lang", "page_id", "url", "html", "n_chars"})


def test_columns_may_have_any_name(spark):
    """All names that the operators use, as columns of the input at once: rows and values are those without them."""
    names = ["__text", "__spans", "__th", "__g", "__w", "__lw", "__k_id", "__c0", "__kept", "__task", *own_names()]
    names = list(dict.fromkeys(names))
    passage = prose(120)
    rows = [(i, f"{prose(60)} {passage if i < 3 else ''} {prose(40)}") for i in range(12)] + [(20, None), (None, prose(70))]
    rows += [(30 + i, rows[i][1] + " more") for i in range(2)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string")
    clashing = plain.select("*", *[F.lit(f"v{i}").alias(n) for i, n in enumerate(names)])
    labelled = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(12)], "doc_id bigint, quality int, toxic int")
    values = tuple(f"v{i}" for i in range(len(names)))

    def same(make, keeps=True):
        a, b = make(plain), make(clashing)
        if keeps:
            assert b.columns == clashing.columns
            b_rows = [tuple(r) for r in b.collect()]
            assert all(r[2:] == values for r in b_rows)
            assert sorted(map(str, (r[:2] for r in b_rows))) == sorted(map(str, (tuple(r) for r in a.collect())))
        else:
            assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    same(lambda d: suffix_dedup.remove(d, 101))
    same(lambda d: quality.keep(d, labelled))
    same(near_copies.deduplicate)
    same(lambda d: toxicity.reject(d, labelled))
    for make in (lambda d: suffix_dedup.digest(d, 101), lambda d: toxicity.score_toxicity(d, labelled), packing.pack, token_counts.count_tokens, simhash.classes, bpe.digest_ids, lambda d: pfor.read_ids(pfor.write_ids(d)), lambda d: media.features(media.media_column(d)), lambda d: audit.audit_filters(d.withColumn("lang", F.lit("x")), labelled)):
        same(make, keeps=False)
    scored = quality.score_quality(clashing, labelled)
    kept = [n for n in names if n not in quality.RESULT]
    assert scored.columns == ["doc_id", "text", *kept, *quality.RESULT] and all(r[n] == f"v{names.index(n)}" for r in scored.collect() for n in kept)
    pages = clashing.withColumnsRenamed({"doc_id": "page_id"}).withColumns({"url": F.lit("http://a.org/"), "html": F.col("text")})
    assert warc.read(warc.write(pages)).count() == len(rows)
    judged = url_rules.judge(pages)
    assert all(r[n] == f"v{names.index(n)}" for r in judged.collect() for n in names if n not in url_rules.RESULT)


def test_media_of_every_row(spark):
    """The stored form's size and hash, and the feature, from the payload and the stored bytes; equal texts have equal values."""
    texts = [None, "", "a", prose(900), prose(900), "x" * 5000, "Grüße 日本 " * 200]
    docs = spark.createDataFrame([*enumerate(texts), (90, texts[3]), (91, "")], "doc_id bigint, text string")
    stored = {r["doc_id"]: r["media"] for r in media.media_column(docs).collect()}
    found = {r["doc_id"]: r for r in media.features(media.write_media(docs)).collect()}
    for i, t in [*enumerate(texts), (90, texts[3]), (91, "")]:
        data = (t or "").encode()
        payload = data + b"\xff" * ((-len(data)) % 576 or (0 if data else 576))
        runs = [payload[len(payload) * k // 16 : len(payload) * (k + 1) // 16] for k in range(16)]
        r = found[i]
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored[i]), hashlib.sha256(stored[i]).hexdigest())
        assert r["feature"] == "".join(f"{sum(x) // len(x):02x}" for x in runs)
    assert tuple(found[3])[1:] == tuple(found[90])[1:] and tuple(found[0])[1:] == tuple(found[91])[1:]


def test_scores_of_the_best_pieces(spark):
    """Counts and scores against all ways to cut short words, and a very long word without spaces."""
    pieces = dict(token_counts.unigram_vocabulary(vocabulary("piece_bpe_32k.model")))
    unknown = min(pieces.values()) - token_counts.UNKNOWN

    def ways(word):
        if not word:
            yield 0.0, 0
        for n in range(1, len(word) + 1):
            head = word[:n]
            cost = (pieces[head], 1) if head in pieces else (unknown, len(head.encode())) if n == 1 else None
            if cost:
                yield from ((s + cost[0], k + cost[1]) for s, k in ways(word[n:]))

    words = ["the", "water", "Ünder", "☃", "a1b2", "xqzj", "ing"]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(50, " ".join(words)), (51, "abcdefghij" * 20_000)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in token_counts.count_tokens(docs).collect()}
    best = []
    for i, w in enumerate(words):
        all_ways = list(ways("▁" + w))
        top = max(s for s, _ in all_ways)
        best.append(top)
        assert abs(found[i]["score"] - top) < 1e-9 and found[i]["n_tokens"] in {k for s, k in all_ways if abs(s - top) < 1e-9}
    assert abs(found[50]["score"] - sum(best)) < 1e-9 and found[50]["n_tokens"] == sum(found[i]["n_tokens"] for i in range(len(words)))
    assert 0 < found[51]["n_tokens"] < 200_000


def features(text):
    out = Counter()
    for w in (text or "").lower().split():
        w = w.strip(toxicity.STRIP)
        out.update([w, *[w[:n] + "*" for n in (4, 6) if len(w) >= n]] if w else [])
    return out


def test_toxicity_from_first_to_last(spark):
    """Weights, neighbours, votes, calibration and the rows that don't teach, all computed here."""
    pick = random.Random(8)
    common, rude = ["".join(pick.choices("aeioulmnrst", k=pick.randrange(3, 9))) for _ in range(80)], ["viles", "rotten", "foulest"]
    texts = {i: " ".join(pick.choices(common, k=pick.randrange(15, 40)) + (pick.choices(rude, k=2) if i % 4 == 0 else pick.choices(rude, k=1) if i % 9 == 0 else [])) for i in range(160)}
    labels = {i: int(i % 4 == 0) for i in range(160)}
    teach = [i for i in range(160) if zlib.crc32(str(i).encode()) % 5]
    base, n = sum(labels[i] for i in teach) / len(teach), len(teach)
    df, ones = Counter(), Counter()
    for i in teach:
        df.update(features(texts[i]).keys())
        ones.update({t: labels[i] for t in features(texts[i])})

    def weight(t):
        a, b = ones[t], df[t] - ones[t]
        c, d = base * n - a, n - base * n - b
        part = lambda x, row, column: x * math.log(x * n / (row * column)) if x > 1e-9 else 0.0
        g2 = 2 * (part(a, a + b, a + c) + part(b, a + b, b + d) + part(c, c + d, a + c) + part(d, c + d, b + d))
        return (math.log((1 + n) / (1 + df[t])) + 1) * (0.05 + (min(1.0, max(0.0, g2 / 50)) if a * n > base * n * df[t] else 0.0))

    def vector(text):
        v = {t: (1 + math.log(k)) * weight(t) for t, k in features(text).items() if df[t]}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    examples = {i: vector(texts[i]) for i in teach}

    def near(text, without=None):
        v = vector(text)
        found = sorted((-round(sum(x * e.get(t, 0.0) for t, x in v.items()), 9), i) for i, e in examples.items() if i != without)
        return [(-s, i) for s, i in found if s < 0][:16]

    vote = lambda found: (sum(s * labels[i] for s, i in found) + 0.25 * base) / (sum(s for s, _ in found) + 0.25)
    pools = []
    for v, y in sorted((vote(near(texts[i], i)), labels[i]) for i in teach):
        pools.append([[v], [y]])
        while len(pools) > 1 and np.mean(pools[-2][1]) >= np.mean(pools[-1][1]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1]]
    knots = [np.mean(v) for v, _ in pools], [(sum(y) + 0.5) / (len(y) + 1) for _, y in pools]
    docs = spark.createDataFrame([*texts.items(), (999, None)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")).collect()}
    for i, t in texts.items():
        assert rows[i]["held_out"] == (i not in teach)
        assert abs(rows[i]["score"] - float(np.interp(vote(near(t)), *knots))) < 2e-3, i
    assert abs(rows[999]["score"] - base) < 1e-9
    assert sum(rows[i]["predicted"] == labels[i] for i in texts if i not in teach) >= 0.9 * (160 - n)


@pytest.mark.parametrize("texts", [["a"] * 3, [None, "", " "]])
def test_audit_of_equal_texts(spark, texts):
    docs = spark.createDataFrame([(i, "x", t) for i, t in enumerate(texts)], "doc_id bigint, lang string, text string")
    first = audit.audit_filters(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).where("filter_order = 'EABCD' and step = 1").first()
    assert first["removed"] == len(texts) - len({t or "" for t in texts})
