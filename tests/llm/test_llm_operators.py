"""Each training-data operator against brute force on a small table with nulls, empty and long texts, copies and clashing columns."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from leafmill.llm import bpe, media, near_copies, packing, pfor, quality, simhash, suffix_dedup, token_counts, toxicity, warc, webp, webp_many
from leafmill.llm.tokenizing import Encoder, safe_pieces, vocabulary

random.seed(3)
WORDS = [random.choice("abcdefgh") + random.choice("aeiou") + random.choice("lmnrst") for _ in range(60)]
LONG = " ".join(random.choice(WORDS) for _ in range(4000))
SHARED = " ".join(random.choice(WORDS) for _ in range(200))
TEXTS = [None, "", "   \n ", "one two", "Grüße 日本 ☃\n\nß", LONG, SHARED, SHARED, f"{LONG[:300]} {SHARED} tail", "same line\nsame line\nother", "x" * 3000, "A b c " * 40] + [" ".join(random.choice(WORDS) for _ in range(n)) for n in (60, 61, 200, 300)]
ROWS = [(i, t, i) for i, t in enumerate(TEXTS)] + [(6, SHARED, 0), (None, "text without an id " * 20, 1)]
SCHEMA = "doc_id bigint, text string, score int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def assert_scores(table, trusted, rows):
    """The rows of score_quality() from n-grams that are counted here; trusted: doc_ids of the target."""
    from xxhash import xxh64_intdigest

    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def buckets(text):
        w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())]
        one = [xxh64_intdigest(x, 42) for x in w]
        return [signed(h) % quality.BUCKETS for h in one + [xxh64_intdigest(b, a) for a, b in zip(one, w[1:])]]  # noqa: B905

    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, t, _ in table:
        np.add.at(raw, buckets(t), 1)
        if i in trusted:
            np.add.at(target, buckets(t), 1)
    smooth = lambda c: np.log((c + quality.SMOOTHING * c.sum() / quality.BUCKETS) / (c.sum() * (1 + quality.SMOOTHING)))
    weights = smooth(target) - smooth(raw)
    expected = []
    for i, t, _ in table:
        own = buckets(t)
        expected.append((i, weights[own].mean() if own else 0.0, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    key = lambda r: (r[0] is None, r[0], r[2])
    got = sorted(((r["doc_id"], r["score"], r["n_words"], r["kept"], r["base_failed"]) for r in rows), key=key)
    for (i, score, n), (j, mine, m, kept, failed) in zip(sorted(expected, key=key), got, strict=True):
        assert (i, n) == (j, m) and abs(score - mine) < 1e-4 and kept == (not failed and mine >= quality.THRESHOLD)
    assert {r["kept"] for r in rows} == {True, False}


def test_quality(spark, docs, empty):
    labelled = spark.createDataFrame([(12, 1, 0), (13, 1, 0), (14, 0, None), (None, 1, 0), (12, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score_quality(docs, labelled).collect()
    assert len(rows) == len(ROWS)
    texts = {(i, t): None for i, t, _ in ROWS}
    for (i, t) in texts:
        r = next(r for r in rows if r["doc_id"] == i and r["word_chars"] == sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        places: dict = {}
        for k in range(len(w) - 2):
            places.setdefault(tuple(w[k : k + 3]), []).append(k)
        covered = {k + d for p in places.values() if len(p) > 1 for k in p for d in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and (r["kept"] <= (not r["base_failed"]))
    assert_scores(ROWS, [12, 13], rows)
    kept = quality.keep(docs, labelled)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality.score_quality(empty, labelled).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, labelled.where("false")).collect()} == {0.0}


@pytest.mark.parametrize(("block", "dense"), [(16, 8), (64, 1000), (7, 0)])
def test_toxicity_index_is_exact(block, dense):
    """Nearest examples by all dot products, with ties, repeated rows, terms that no example has, and a query without terms."""
    rng = np.random.default_rng(0)

    def unit(high):
        ids = np.sort(rng.choice(high, int(rng.integers(1, 9)), False))
        x = rng.random(len(ids))
        return ids, x / np.sqrt(x @ x)

    rows = [(i, i % 2, ids, x.astype(np.float32)) for i in range(500) for ids, x in [unit(60)]]
    rows += [(1000 + i, i % 2, *rows[7][2:]) for i in range(40)]
    index = toxicity.BlockMaxIndex(rows, block, dense)
    whole = np.zeros((len(rows), 80))
    for r, (_, _, ids, x) in enumerate(rows):
        whole[r, ids] = x
    queries = [unit(70) for _ in range(300)] + [(rows[7][2], rows[7][3].astype(float)), (np.zeros(0, np.int64), np.zeros(0))]
    for q, near in zip(queries, index.nearest(queries, 16), strict=True):
        dots = sorted((-round(float(s), 12), rows[r][0]) for r, s in enumerate(whole[:, q[0]] @ q[1]))[:16]
        assert [(round(s, 9), index.docs[i]) for s, i in near] == [(round(-s, 9), d) for s, d in dots if s < 0]
    own = index.nearest(queries[:1], 3)[0]
    assert [i for _, i in index.nearest(queries[:1], 2, [own[0][1]])[0]] == [i for _, i in own[1:]]
    assert toxicity.BlockMaxIndex([]).nearest(queries[:2], 4) == [[], []]


def test_toxicity_vectors_and_calibration():
    """Vectors and votes against plain Python."""
    texts = ["Rude, rude words here", "polite words only", "rude again"]
    n, names = len(texts), sorted({f for t in texts for f in toxicity.terms(t)})
    df = np.array([sum(f in toxicity.terms(t) for t in texts) for f in names])
    ones = np.array([sum(f in toxicity.terms(t) for t in (texts[0], texts[2])) for f in names])
    vectors = toxicity.Vectors(names, (np.log((1 + n) / (1 + df)) + 1) * (toxicity.FLOOR + toxicity.association(df, ones, n, 2)))
    (ids, x), *others = vectors(["RUDE rude (again) unknown", None, "", "\u2003rude\n", "nothing known"])
    assert [len(i) for i, _ in others] == [0, 0, 2, 0] and vectors([None]) and not vectors([])
    assert {names[i] for i in ids} == {"rude", "rude*", "again", "agai*"} and abs(x @ x - 1) < 1e-12
    weight = {f: (math.log((1 + n) / (1 + d)) + 1) * (toxicity.FLOOR + a) for f, d, a in zip(names, df, toxicity.association(df, ones, n, 2), strict=True)}
    raw = {f: (1 + math.log(2 if f.startswith("rude") else 1)) * weight[f] for f in ("rude", "rude*", "again", "agai*")}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert all(abs(x[list(ids).index(names.index(f))] - v / norm) < 1e-12 for f, v in raw.items())
    both, some = toxicity.association(np.array([10, 10]), np.array([10, 0]), 100, 20)
    assert some == 0 and abs(both - 2 * (10 * math.log(5) + 10 * math.log(10 * 100 / (90 * 20)) + 80 * math.log(100 / 90)) / toxicity.FULL) < 1e-12
    knots = toxicity.monotone([0.1, 0.2, 0.3, 0.4], [0, 1, 0, 1])
    assert knots[1] == sorted(knots[1]) and len(knots[0]) == 3


def test_toxicity(spark, empty):
    bad = ["vile", "rotten", "foul"]
    rows = [(i, " ".join([*random.choices(WORDS, k=40), *(random.choices(bad, k=4) if i % 4 == 0 else [])]), 0) for i in range(200)]
    long = " ".join(random.choices(WORDS, k=60_000))
    docs = spark.createDataFrame([*rows, (1000, None, 0), (1001, "", 0), (1000, None, 0), (1002, long, 0), (1003, "Ünknown ☃", 0), (None, rows[0][1], 0)], SCHEMA)
    labelled = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(3, None), (5, 0), (1000, 0), (1002, 0), (None, 1)], "doc_id bigint, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labelled).collect()}
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in held if out[i]["held_out"]} == set(held)
    assert all(out[i]["predicted"] == int(i % 4 == 0) for i in held)
    assert all(0 <= r["score"] <= 1 for r in out.values()) and out[1000]["score"] == out[1001]["score"] == out[1003]["score"] < 0.5
    assert out[1002]["predicted"] == 0 and out[None]["score"] == out[0]["score"] and out[None]["evidence"] == out[0]["evidence"]
    kept = toxicity.reject(docs, labelled)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if i is None or i >= 200 or i % 4} - {None}
    assert toxicity.reject(empty, labelled).count() == 0
    assert toxicity.score_toxicity(empty, labelled).count() == 0
    assert {r["score"] for r in toxicity.score_toxicity(docs, labelled.where("false")).collect()} == {0.0}


def ids_of(text, special_as_text=False):
    """Ids by an untouched tokenizer, with the end id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = special_as_text
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc_of(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


SPECIAL = [(50, "a <|endoftext|> b", 0), (51, "<|endoftext|><|endoftext|>", 0), (52, "a " * 1100 + "b" * 700, 0)]


def test_packing(spark, empty):
    """Each id lies in exactly one piece whose checksum is that of its ids; sequences have no gaps and little padding."""
    table = ROWS + SPECIAL
    rows = packing.pack(spark.createDataFrame(table, SCHEMA)).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, pieces in by_doc.items():
        wanted = sorted((ids_of(t) for i, t, _ in table if i == doc_id), key=len)
        assert sorted({r["doc_tokens"] for r in pieces}) == sorted({len(x) for x in wanted})
        expected = []
        for ids in wanted:
            own = sorted({(r["start"], r["length"]) for r in pieces if r["doc_tokens"] == len(ids)})
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) == len(ids)  # noqa: B905
            expected += [(a, n, len(ids), crc_of(ids[a : a + n])) for a, n in own]
        assert sorted(expected) == sorted((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in pieces)
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WIDTH
    size = sum(packing.padded(sum(n for _, n in p), packing.WIDTH) for p in by.values())
    tokens = sum(r["length"] for r in rows)
    assert tokens == sum(len(ids_of(t)) for _, t, _ in table) and size < tokens + packing.WIDTH
    assert packing.pack(empty).count() == 0


def test_column_generation():
    demand = {int(s): int(n) for s, n in zip(range(3, 512, 5), np.random.default_rng(1).integers(20, 60, 102), strict=True)}
    used: dict = {}
    total = 0
    for pattern, n in packing.plan(demand):
        assert sum(s * t for s, t in pattern) <= packing.WIDTH
        total += n * packing.padded(sum(s * t for s, t in pattern), packing.WIDTH)
        for s, t in pattern:
            used[s] = used.get(s, 0) + n * t
    assert used == demand and total <= 1.01 * sum(s * n for s, n in demand.items())
    assert packing.plan({}) == []


def removed_slowly(table, length):
    """The rows of suffix_dedup.digest(), from every window of every text."""
    data = [(t or "").encode() for _, t, _ in table]
    seen: dict = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    expected = []
    for (i, _, _), b in zip(table, data, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        expected.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, expected))


def texts_left_slowly(table, length):
    """The rows of suffix_dedup.remove(), from every window of every text."""
    data = [(t or "").encode() for _, t, _ in table]
    seen: dict = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    left = []
    for (i, t, s), b in zip(table, data, strict=True):
        gone = {k + d for k in range(len(b) - length + 1) if seen[b[k : k + length]] > 1 for d in range(length)}
        left.append((i, bytes(c for k, c in enumerate(b) if k not in gone).decode("utf-8", "ignore") if gone else t, s))
    return sorted(map(str, left))


@pytest.mark.parametrize(("length", "gram"), [(40, 8), (400, 32)])
def test_suffix_dedup(docs, empty, length, gram):
    rows = suffix_dedup.digest(docs, length, gram).collect()
    assert removed_slowly(ROWS, length) == sorted(str(tuple(r)) for r in rows)
    removed = suffix_dedup.remove(docs, length, gram)
    assert removed.columns == docs.columns
    assert sorted(str((r["doc_id"], r["text"], r["score"])) for r in removed.collect()) == texts_left_slowly(ROWS, length)
    assert suffix_dedup.digest(empty).count() == suffix_dedup.remove(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 2, 6])
@pytest.mark.parametrize(("length", "gram"), [(100, 8), (400, 32)])
def test_suffix_dedup_hot_anchors(spark, monkeypatch, hot, length, gram):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    near = lambda k: " ".join(WORDS[(k * 7 + i * (1 + k % 2)) % 60] for i in range(40))
    rows = [(i, f"{near(i)[-(i % 9) * 15 - 1:]}{SHARED[(i % 4) * 40 : 700 - (i % 3) * 50]}{near(i % 5)}", 0) for i in range(40)]
    rows += [*ROWS, rows[3], rows[3]]
    found = suffix_dedup.digest(spark.createDataFrame(rows, SCHEMA), length, gram).collect()
    assert removed_slowly(rows, length) == sorted(str(tuple(r)) for r in found)


def test_suffix_construction(tmp_path):
    """Spans of windows that another row of the group has in the same column, from all pairs; the columns' file is gone after."""
    rows = [random.choice([b"abcdefgh" * 4, b"abcdefgX" * 4, bytes(random.choices(b"ab", k=32))]) for _ in range(50)]
    groups, offsets = np.array([i // 10 for i in range(50)]), np.array([12 if len(r) > 30 else 0 for r in rows])
    got = suffix_dedup.repeated(groups, rows, offsets, 20, 8, f"file://{tmp_path}")
    for i, r in enumerate(rows):
        starts = [k for k in range(13) if any(j != i and groups[j] == groups[i] and rows[j][k : k + 20] == r[k : k + 20] for j in range(50))]
        assert got[i] == suffix_dedup.union(np.array(starts, int), np.array(starts, int) + 20)
    assert not list(tmp_path.glob("*.columns"))


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary_ = list(token_counts.unigram_vocabulary(vocabulary("piece_bpe_32k.model")))
    library = Tokenizer(models.Unigram(vocabulary_, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rows = token_counts.count_tokens(docs).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in ROWS)
    assert token_counts.count_tokens(empty).count() == 0
    tied = token_counts.Counter((("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)))
    model = Tokenizer(models.Unigram([("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)], unk_id=0))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for n in range(1, 9):
        assert tied.count("a" * n)[0] == len(model.encode("a" * n).ids)


def test_simhash(docs, empty):
    from xxhash import xxh64_intdigest

    def slow(t):
        w = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", w)
        s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [slow(t) for _, t, _ in ROWS]
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {x: min((ROWS[k][0] for k in range(len(fps)) if label[k] == x and ROWS[k][0] is not None), default=None) for x in label}
    expected = sorted(str((ROWS[k][0], f"{fps[k]:016x}", least[label[k]])) for k in range(len(fps)))
    assert sorted(str(tuple(r)) for r in simhash.classes(docs).collect()) == expected
    assert simhash.classes(empty).count() == 0


def test_embedding_is_the_manhattan_distance_of_segment_counts():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (2, 500), dtype=np.uint64)
    counts = lambda x: np.stack([np.bitwise_count(x >> np.uint64(k) & np.uint64(3)) for k in range(0, 64, 2)]).astype(int)
    assert np.array_equal(np.abs(counts(a) - counts(b)).sum(axis=0), simhash.differing(simhash.embed(a), simhash.embed(b)))
    assert (simhash.differing(simhash.embed(a), simhash.embed(b)) <= simhash.differing(a, b)).all()


@pytest.mark.parametrize(("cell", "radius"), [(1024, 3), (8, 3), (2, 3), (8, 2), (8, 1), (4, 5)])
def test_simhash_links(spark, monkeypatch, cell, radius):
    """Classes of the linked points are those of all pairs, whether cells are cut or not."""
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(5)
    one = lambda n: np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    near = np.uint64(0x0F0F_1234_5678_9ABC) ^ one(300) ^ one(300) ^ one(300)
    fps = np.unique(np.concatenate([near, near[:40] ^ np.uint64(0xFFFF << 20), rng.integers(0, 1 << 63, 100, dtype=np.uint64), np.array([0, 1, (1 << 64) - 1], np.uint64)]))
    found = simhash.links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint"), radius).collect()
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    forest, slow = simhash.Forest(len(fps)), simhash.Forest(len(fps))
    forest.add(np.array([place[r["a"]] for r in found], np.int64), np.array([place[r["b"]] for r in found], np.int64))
    assert all(int(fps[place[r["a"]]] ^ fps[place[r["b"]]]).bit_count() <= radius for r in found)
    for i in range(len(fps)):
        close = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius)
        slow.add(np.full(len(close), i), close)
    assert np.array_equal(forest.root, slow.root)


def test_near_copies_go(spark):
    texts = [" ".join(random.choices(WORDS, k=150)) for _ in range(20)]
    rows = []
    for i, t in enumerate(texts):
        w = t.split()
        w[40 + i] = "changed"
        rows += [(2 * i, t, 0), (2 * i + 1, " ".join(w), 0)]
    kept = {r["doc_id"] for r in near_copies.deduplicate(spark.createDataFrame([*rows, (0, texts[0], 0)], SCHEMA)).collect()}
    assert kept == set(range(0, 40, 2))


def test_near_copies_are_exact(spark, empty):
    """Groups by all pairs: edits spread so that similarities lie on both sides of 0.8."""
    rng = random.Random(11)
    texts = []
    for k in range(40):
        base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(200)]
        texts.append(" ".join(base))
        for edits in (2, 3, 4, 5, 6, 8):
            w = list(base)
            for e in range(edits):
                w[10 + 30 * e if edits < 7 else 10 + 22 * e] = f"edit{k}x{e}x{edits}"
            texts.append(" ".join(w))
    texts += ["", "   ", "one two", "One  TWO", "one three"]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else []) for w in (t.lower().split() for t in texts)]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    kept = sorted(r["doc_id"] for r in near_copies.deduplicate(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA)).collect())
    assert kept == sorted(set(label))
    assert near_copies.deduplicate(empty).count() == 0


def test_near_copies_without_or_with_repeated_ids(spark):
    a, b, c, d = (" ".join(random.choices(WORDS, k=80)) for _ in range(4))
    rows = [(None, a, 0), (None, a, 0), (None, b, 0), (1, b, 0), (7, c, 0), (7, d, 0), (8, d, 0)]
    kept = near_copies.deduplicate(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text").collect()
    assert sorted(kept, key=str) == sorted([(None, a), (1, b), (7, c), (7, d)], key=str)


@pytest.mark.parametrize("special_as_text", [False, True])
def test_token_ids(spark, empty, special_as_text):
    table = ROWS + SPECIAL
    index = pfor.write_ids(spark.createDataFrame(table, SCHEMA), special_as_text=special_as_text)
    rows = pfor.read_ids(index).collect()
    ids = [(i, ids_of(t, special_as_text)) for i, t, _ in table]
    assert sorted(map(str, ((i, len(x), crc_of(x)) for i, x in ids))) == sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in rows)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted((i for i, _, _ in table), key=lambda i: -1 if i is None else i)
    with open(index.first()["file"], "rb") as f:
        assert f.read(4) == pfor.MAGIC
    assert pfor.read_ids(pfor.write_ids(empty)).count() == 0


def test_token_ids_of_one_doc_id_lie_in_several_tasks(spark):
    rows = [(None, f"text {i % 3}", 0) for i in range(300)] + [(5, f"text {i}", 0) for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = pfor.write_ids(spark.createDataFrame(rows, SCHEMA))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.select("part").distinct().count() > 2
    read = pfor.read_ids(index).orderBy("start").collect()
    assert [r["doc_id"] for r in read] == [None] * 300 + [5] * 300
    assert sorted(r["ids_crc32"] for r in read) == sorted(crc_of(ids_of(t)) for _, t, _ in rows)


@pytest.mark.parametrize("width", range(1, 33))
def test_packed_bits(width):
    """Values of any width and number come back, and lie lowest bit first."""
    for n in (1, 7, 8, 9, 100):
        values = np.random.default_rng(n).integers(0, 1 << width, (2, n), dtype=np.uint64).astype(np.uint32)
        packed = pfor._pack(values, width)
        assert packed.shape == (2, (n * width + 7) // 8)
        assert int.from_bytes(packed[1].tobytes(), "little") == sum(int(v) << i * width for i, v in enumerate(values[1]))
        assert np.array_equal(pfor._unpack(packed, n, width), values)


@pytest.mark.parametrize("n", [0, 1, 5, 1024, 1025, 5000])
def test_pfor_round_trip(n):
    rng = np.random.default_rng(n)
    for values in (rng.integers(0, 50257, n), rng.integers(0, 1 << 32, n, dtype=np.uint64), np.full(n, 7), np.where(rng.random(n) < 0.05, 4e9, 3)):
        shard = pfor.Shard(pfor.write_shard(values.astype(np.uint32), [1], [n]))
        assert np.array_equal(shard.read(0, n), values.astype(np.uint32)) and np.array_equal(shard.all(), values.astype(np.uint32))
        assert np.array_equal(shard.read(n // 3, n // 2), values.astype(np.uint32)[n // 3 : n // 3 + n // 2])


@pytest.mark.parametrize("special_as_text", [False, True])
def test_encoder_is_the_library(special_as_text):
    texts = [t or "" for t in TEXTS] + ["<|endoftext|> it's  I'LL\t\n x", " nbsp\u00a0\u3000wide", "a" * 70_000, "tab\tword " * 9000, "Abc.\nDef, ghi!", "a\n\nb", "a \nb", "\na\n", "don't. stop,now x1 \u00b2. y", "o'clock 's 'll", "x\u0301y \u0301 z\u1e9e.", "x\x1cy z\x85 w", "\u4e2d\u6587 \u4e2d. !a ?", "a\rb \rc"]
    encoder = Encoder(vocabulary("byte_bpe_50k.json"), special_as_text)
    for batch in (texts, texts[::-1], []):  # the second time from what is kept
        for t, got in zip(batch, encoder.encode_batch(batch), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == ids_of(t, special_as_text)[:-1]


def test_encoder_of_other_files():
    """A tokenizer that isn't byte-level gets whole texts."""
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), ["Some words,\nand a line.", "", "x  y"]
    got = Encoder(vocabulary("word_bpe_49k.json")).encode_batch(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_media(docs, empty):
    rows = media.features(media.write_media(docs)).collect()
    expected = []
    for i, t, _ in ROWS:
        b = (t or "").encode()
        p = b + b"\xff" * (-len(b) % 576 if b else 576)
        expected.append((i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)[:5]) for r in rows)
    assert media.features(media.media_column(empty)).count() == 0


def test_images_choose_their_form():
    """Samples that one way suits are written that way, whatever it is, and come back."""
    rng = np.random.default_rng(4)
    n = 16 * 144
    ramp = (np.arange(n)[:, None] * np.array([3, 5, 7, 11]) + rng.integers(0, 2, (n, 4))).astype(np.uint8)
    columns = np.tile(rng.integers(0, 256, (144, 4)), (16, 1)) + rng.integers(0, 2, (n, 4))
    grey = rng.integers(0, 256, (n, 1)).repeat(4, axis=1)
    grey[:, 3] = 255
    half = grey.astype(np.uint8).astype(np.int8) // 2
    tinted = np.stack([half[:, 0], grey[:, 1].astype(np.int8), -half[:, 2], np.full(n, -1)], axis=1)
    few = rng.integers(0, 256, (5, 4))[rng.integers(0, 5, n)]
    again = np.tile(rng.integers(0, 256, (400, 4)), (6, 1))[:n]
    words = ["".join(random.choices("etaoinshrdlu", k=random.randrange(2, 11))) for _ in range(3000)]
    prose = np.frombuffer(" ".join(words).encode()[: 4 * n], np.uint8).reshape(n, 4)
    images = np.stack([x.astype(np.uint8) for x in (ramp, columns, grey, tinted, few, again, prose)])
    plans = media.plans_of(images)
    chosen = [None if p is None else (p.get("transforms"), p.get("mode"), p.get("cache_bits")) for p in plans]
    assert chosen == [((webp.PREDICTOR,), 1, None), ((webp.PREDICTOR,), 2, None), ((webp.SUBTRACT_GREEN,), None, None), ((webp.CROSS_COLOUR,), None, None), ((webp.PALETTE,), None, None), (None, None, 8), None]
    payloads = [x.tobytes() for x in images] + [images[0][:144].tobytes(), b"".join(x.tobytes() for x in images)]
    stored = media.store(payloads)
    assert media.load(stored) == payloads and all(len(s) < 0.7 * len(p) for s, p in zip(stored, payloads, strict=True) if len(p) > 576)


def test_stored_forms_take_the_least_estimate():
    """Prose of twelve letters is smaller under codes of its own than under the text code by an eighth: it is stored so. A row too short to pay for them keeps the text code."""
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 11))) for _ in range(3000)]
    text = " ".join(words).encode()
    prose, short = text[: 16 * webp.ROW], text[: webp.ROW]
    stored = media.store([prose, short])
    assert len(stored[0]) < 0.9 * len(webp.encode_texts([prose])[0]) and stored[1] == webp.encode_texts([short])[0]
    assert media.load(stored) == [prose, short]


def _alone(*_args, **_options):
    raise AssertionError("an image is coded alone")


def test_images_of_own_codes_are_coded_together(monkeypatch):
    """Prose under codes of its own, with references and a colour cache: written and read for many images at once, with the bytes that each has alone."""
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 11))) for _ in range(500)]
    prose = [" ".join(rng.choices(words, k=3000)).encode()[: webp.ROW * k] for k in (5, 16, 16, 11)]
    payloads = [*prose, prose[1][:1152] * 8]
    monkeypatch.setattr(webp, "encode", _alone)
    monkeypatch.setattr(webp, "decode", _alone)
    stored = media.store(payloads)
    assert media.load(stored) == payloads and [media.store([p])[0] for p in payloads] == stored


def test_many_images_have_the_bytes_of_each():
    """encode_many() writes what encode() does, decode_many() reads what decode() does: few colours, runs, single colours, noise, all ways; broken files are errors."""
    rng = np.random.default_rng(5)
    images = []
    for k in range(48):
        pixels = rng.integers(0, 256, (int(rng.choice([1, 2, 3, 40, 300, 4000])), 4), dtype=np.uint8)
        pixels[0] *= k % 3 > 0
        image = pixels[np.minimum(*rng.integers(0, len(pixels), (2, 1 + k % 16, webp.PIXELS)))]
        if k % 5 == 1:  # skewed samples have long codes
            image = (rng.geometric(0.3, image.shape) % 256).astype(np.uint8)
        if k % 5 == 2:
            image.reshape(-1, 4)[60:110] = image.reshape(-1, 4)[:50]
        images.append(image)
    references, cache = rng.random((2, 48)) < 0.6
    files = [webp.encode(i, (), 8 if c else 0, bool(r)) for i, r, c in zip(images, references, cache, strict=True)]
    assert webp_many.encode_many(images, references, cache) == files
    others = [webp.encode(images[1], t, c, True, b) for t, c, b in (((webp.SUBTRACT_GREEN,), 0, 0), ((), 5, 0), ((), 8, 2))] + webp.encode_texts([images[15].tobytes()])
    assert webp_many.decode_many(files + others) == [i.tobytes() for i in [*images, *images[1:2] * 3, images[15]]]
    assert not any(p is None for p in webp_many._decode(files))
    for cut in (30, 60, len(files[15]) // 2):
        with pytest.raises(ValueError):
            webp_many.decode_many([files[3], files[15][:cut]])


def test_side_by_side_code_lengths():
    """Lengths of many codes at once are those of each alone, also where weights have to be raised."""
    rng = np.random.default_rng(6)
    weights = [dict(zip(rng.permutation(300)[:n].tolist(), (rng.pareto(0.4, n) * 3 + 1).astype(int).clip(1, 1 << 20).tolist(), strict=True)) for n in rng.integers(1, 90, 60).tolist()]
    weights.append({k: 2**k for k in range(18)})
    rows = np.array([(k, s, w[s]) for k, w in enumerate(weights) for s in sorted(w)])
    for longest in (7, 15):
        found = webp_many.code_lengths(*rows.T, longest)
        assert found.tolist() == [n for w in weights for n in webp.code_lengths(w, 300, longest) if n]


def test_webp_features():
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 256, (11, 19, 4), dtype=np.uint8), rng.integers(0, 256, (5, 4), dtype=np.uint8)[rng.integers(0, 5, (13, 21))], np.full((3, 3, 4), 255, np.uint8)]
    for image in images:
        for transforms in ((), (0,), (1,), (2,), (2, 0, 1), (3,), (3, 0)):
            for cache, references, tiles, mode in ((0, False, 0, -1), (4, True, 3, 11), (10, True, 0, 13)):
                assert transforms[:1] != (3,) or len(np.unique(image.reshape(-1, 4), axis=0)) <= 256
                assert np.array_equal(webp.decode(webp.encode(image, transforms, cache, references, tiles, mode)), image)
    with pytest.raises(ValueError):
        webp.decode(b"RIFF....WEBPVP8 ")


def test_bpe(docs, empty):
    rows = bpe.digest_ids(docs).collect()
    encoding = bpe.Bpe().encoding
    expected = sorted(str((i, len(x := encoding.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())) for i, t, _ in ROWS)
    assert sorted(str(tuple(r)) for r in rows) == expected
    assert bpe.digest_ids(empty).count() == 0
    for size in (1, 7, 100):
        for t in ("a b  c\n d 'll it's", LONG, "  x  y "):
            pieces = list(safe_pieces(t, size))
            assert "".join(pieces) == t and [i for p in pieces for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(t)


def test_warc(spark):
    rows = [(i, f"http://x/{i}", h, "clash") for i, h in enumerate(["<p>a</p>", "<p>a</p>", None, "", "<p>b\r\n\r\n</p>", "<p>a</p>"])] + [(5, None, "<p>a</p>", None), (9, "u\r\nWARC-Type: x", "ü" * 50_000, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")
    index = warc.write(pages)
    assert index.count() == len(rows)
    groups: dict = {}
    for i, _, h, _ in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    expected = sorted(str((i, "response" if i == max(groups[p]) else "revisit", base64.b32encode(hashlib.sha1(p).digest()).decode(), len(p), None if i == max(groups[p]) else max(groups[p]))) for i, _, h, _ in rows for p in [(h or "").encode()])
    got = warc.read(index).collect()
    assert sorted(str((r["page_id"], r["record_type"], r["digest"], r["payload_bytes"], r["refers_to"])) for r in got) == expected
    assert all(bytes(r["payload"]) in groups for r in got if r["record_type"] == "response")
    assert warc.read(index, index["page_id"] == 9).count() == 1
    assert warc.write(pages.where("false")).count() == 0
    assert list(warc.coalesced([(0, 10), (12, 5), (100, 5), (200, 90)], gap=5, span=50)) == [[(0, 10), (12, 5)], [(100, 5)], [(200, 90)]]


def test_warc_revisits_hold_their_payload(spark):
    """Rows with one page_id, or none, and different payloads: no payload is lost, no row is written twice."""
    rows = [(None, "n/a", "A"), (None, "n/b", "B"), (7, "7/a", "A"), (3, "3/c", "C"), (3, "3/a", "A"), (9, "9/c", "C"), (3, "3/d", "D")]
    got = warc.read(warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"))).collect()
    assert len(got) == len(rows)
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == {b"A", b"B", b"C", b"D"}
    assert {r["url"]: r["refers_to"] for r in got if r["record_type"] == "revisit"} == {"n/a": 7, "3/a": 7, "3/c": 9}
