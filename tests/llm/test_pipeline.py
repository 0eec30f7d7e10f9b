"""The stages of the pipeline, one after another, on the smallest tables, and each against brute force on a table made here."""

import random
import re

import numpy as np
import pytest
from test_llm_operators import assert_scores, crc_of, ids_of

import corpus_pipeline
from leafmill.llm import quality, toxicity
from leafmill.llm.shared import documents, labels, materialize

SCHEMA = "doc_id bigint, text string, n_chars bigint, score int, kept string, spans string, sequence_id string"


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioulmnrst", k=rng.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Folder and rows: plain, near and exact copies, shared passages, rude and short texts, null and empty ones, a long one, rows without or with repeated ids, and columns with names of results."""
    rng = random.Random(7)
    rude = ["vile", "rotten", "foul", "filthy"]
    texts = [prose(rng, rng.randrange(80, 160)) for _ in range(60)]
    texts += [" ".join(w if k % 9 else rng.choice(rude) for k, w in enumerate(prose(rng, 100).split())) for _ in range(25)]
    passage, short = prose(rng, 60), prose(rng, 50)
    texts += [f"{prose(rng, 70)} {passage if k % 2 else short} {prose(rng, 70)}" for k in range(6)]
    for k in range(8):  # copies with one to eight words changed
        w = texts[k].split()
        for e in range(k + 1):
            w[5 + 8 * e] = "changed"
        texts.append(" ".join(w))
    texts += [texts[0], texts[1], None, "", "  \n ", "too short", "word " * 200, prose(rng, 5000), "Grüße aus Köln ☃ " * 3 + prose(rng, 90)]
    rows = [(i, t, None if t is None else len(t), i, "x", None, "") for i, t in enumerate(texts)]
    rows += [(None, prose(rng, 90), 0, 1, "x", "", None), (3, texts[3], 0, 1, "x", "", None), (3, prose(rng, 90), 0, 1, "x", "", None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 1 if i % 2 else None, int(60 <= i < 85)) for i in range(len(texts))] + [(None, 1, 1), (4, None, None), (10_000, 1, 1)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, {i for i, q, _ in marks if q == 1 and i is not None}


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def left_by_copies(rows):
    """The first row, by doc_id, of each class of texts that similarity joins, repeated rows once; ties between texts of one doc_id are none here."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return {x: min((rows[k][0] is None, rows[k][0] or 0) for k in range(len(rows)) if label[k] == x) for x in set(label)}.values()


def left_by_passages(rows):
    data, seen = [(r[1] or "").encode() for r in rows], {}
    for b in data:
        for i in range(len(b) - 100):
            seen[b[i : i + 101]] = seen.get(b[i : i + 101], 0) + 1
    out = []
    for r, b in zip(rows, data, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 100):
            if seen[b[k : k + 101]] > 1:
                gone[k : k + 101] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        for x, y in zip(edges[::2], edges[1::2], strict=True):
            inside = [m for m in re.finditer(rb"[^\x20\x09-\x0D]+", b) if m.start() >= x and m.end() <= y]
            if len(inside) <= 50:
                gone[x:y] = False
        text = bytes(c for c, g in zip(b, gone, strict=False) if not g).decode("utf-8", "ignore")
        out.append((r[0], text, len(text), *r[3:]) if gone.any() else tuple(r))
    return sorted(out, key=str)


def test_each_stage_against_brute_force(spark, corpus):
    folder, rows, trusted = corpus
    docs = documents(spark, folder)
    scored = quality.score_quality(docs.select("doc_id", "text"), labels(spark, folder)).collect()
    assert_scores([r[:3] for r in rows], trusted, scored)
    good = materialize(corpus_pipeline.quality_stage(spark, docs, folder), "quality")
    kept = sorted(str((r["doc_id"], r["n_words"], r["word_chars"])) for r in scored if r["kept"])
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    assert sorted(str((r["doc_id"], len(words(r["text"])), sum(map(len, words(r["text"]))))) for r in good.collect()) == kept
    assert set(as_rows(good)) <= {tuple(r) for r in rows} and good.columns == docs.columns

    model = toxicity.fit(good, labels(spark, folder))
    plain = []
    for r in good.collect():
        ((ids, x),) = model.vectors([r["text"]])
        whole = np.zeros(model.index.n_terms)
        whole[ids[ids < model.index.n_terms]] = x[ids < model.index.n_terms]
        dots = [(-round(float(whole[model.index.ids[a:b]] @ model.index.weights[a:b].astype(float)), 12), model.index.docs[p], p) for p, (a, b) in enumerate(zip(model.index.starts, model.index.starts[1:]))]  # noqa: B905
        near = [(-s, p) for s, _, p in sorted(dots)[: toxicity.NEIGHBOURS] if s < 0]
        if (np.interp(model.vote(near), *model.knots) if near else model.base) < 0.5:
            plain.append(tuple(r))
    clean = materialize(corpus_pipeline.toxicity_stage(spark, good, folder), "toxicity")
    assert as_rows(clean) == sorted(plain, key=str) and not {r[0] for r in plain} & set(range(60, 85))

    before = clean.collect()
    single = materialize(corpus_pipeline.near_dedup_stage(spark, clean, folder), "near")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in single.collect()) == sorted(left_by_copies([tuple(r) for r in before]))
    assert set(as_rows(single)) <= {tuple(r) for r in before}

    cut = materialize(corpus_pipeline.suffix_dedup_stage(spark, single, folder), "suffix")
    assert as_rows(cut) == left_by_passages([tuple(r) for r in single.collect()]) != as_rows(single)

    pieces = corpus_pipeline.packing_stage(spark, cut, folder).collect()
    wanted = [(r["doc_id"], ids_of(r["text"])) for r in cut.collect()]
    assert sum(p["length"] for p in pieces) == sum(len(x) for _, x in wanted)
    for p in pieces:
        assert any(p["doc_id"] == i and len(x) == p["doc_tokens"] and crc_of(x[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for i, x in wanted)


def test_empty_tables(spark, corpus):
    folder, _, _ = corpus
    docs = documents(spark, folder).where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_run_is_its_stages(spark, corpus):
    """run() ends with the pieces of what the stages leave, and the same ones each time."""
    folder, _, _ = corpus
    first, again = (as_rows(corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")) for _ in range(2))
    assert first == again and first


def test_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert out.columns == columns
            assert {r[0] for r in out.select("doc_id").collect()} <= {r[0] for r in docs.select("doc_id").collect()}
        docs = out
    assert docs.count() > 0


def test_clean_documents_stay(spark, sf_dir):
    docs = documents(spark, sf_dir)
    good = docs.join(labels(spark, sf_dir).where("quality = 1"), "doc_id").where("n_chars > 600").select(*docs.columns)
    assert corpus_pipeline.quality_stage(spark, good, sf_dir).count() >= 0.95 * good.count()


def test_short_passages_go(spark):
    """51 words repeat in fewer than 400 bytes and go, even one-letter ones; 50 words stay."""
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    short, letters, few = words("w", 51), " ".join("abcdefghijklmnopqrstuvwxyz"[i * i % 26] for i in range(51)), words("longerword", 50)
    rows = [(2 * k + d, f"{words(f'x{k}{d}', 60)} {p} {words(f'y{k}{d}', 60)}") for k, p in enumerate((short, letters, few)) for d in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_dedup_stage(spark, docs, "").collect()}
    assert all(short not in out[i] for i in (0, 1)) and all(letters not in out[i] for i in (2, 3)) and all(few in out[i] for i in (4, 5))
    assert all(out[i].startswith(t[:150]) and out[i].endswith(t[-150:]) for i, t in rows)
