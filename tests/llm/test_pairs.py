"""Near-duplicates, incremental deduplication and cross-split overlap against brute force."""

import dataclasses
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caretlake.llm import corpus_queries
from caretlake.llm import shingles as S
from caretlake.llm.bloom import build
from caretlake.llm.covering import FULL_BELOW, Covering, bucket_pairs, covering_keys, most_different, rare_from, sketch_column
from caretlake.llm.incremental import IncrementalDedup, nothing_new
from caretlake.llm.neardup import near_duplicates
from caretlake.llm.overlap import cross_split, equal_targets, overlapping, partners
from caretlake.llm.rarity import rarity_of
from caretlake.session import discard, fresh_dir, materialise


def sets(t):
    w = re.findall(r"[a-z0-9_]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def sim(a, b):
    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b) if a and b else 0.0


def corpus(seed=1, n=120):
    """Texts with copies, small edits, a family that fills a third, short, empty and null ones, and one very long."""
    rnd = random.Random(seed)
    word = lambda: "w" + str(rnd.randrange(4000))
    base = [[word() for _ in range(rnd.randrange(30, 160))] for _ in range(n // 3)]
    out = [" ".join(b) for b in base]
    for _ in range(n // 3):
        b = list(rnd.choice(base))
        for _ in range(rnd.randrange(0, 8)):
            b[rnd.randrange(len(b))] = word()
        out.append(" ".join(b))
    family = [word() for _ in range(100)]
    for _ in range(n // 3):
        b = list(family)
        for _ in range(rnd.randrange(0, 4)):
            b.insert(rnd.randrange(len(b)), word())
        out.append("\n".join(b))
    long = " ".join(word() for _ in range(60_000))
    return [*out, None, "", "a b c d", "a b c d e", "A B-C d\te", "é b c d e", long, long + " x", out[0]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9_ é-\n", max_size=60)), max_size=8))
def test_shingles_equal_the_definition(texts):
    got = []
    for lo, hi, values, bounds in S.shingle_sets(pa.array(texts, pa.string())):
        for i in range(hi - lo):
            v = values[bounds[i] : bounds[i + 1]]
            assert (np.diff(v.astype(np.int64)) > 0).all()
            got.append(frozenset(v.tolist()))
    want = [sets(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_chunks_and_long_texts_give_the_same_sets(monkeypatch):
    texts = [t for t in corpus(3, 30)]
    whole = [frozenset(v[b[i] : b[i + 1]].tolist()) for lo, hi, v, b in S.shingle_sets(pa.array(texts)) for i in range(hi - lo)]
    monkeypatch.setattr(S, "CHUNK_BYTES", 97)
    small = [frozenset(v[b[i] : b[i + 1]].tolist()) for lo, hi, v, b in S.shingle_sets(pa.array(texts)) for i in range(hi - lo)]
    assert whole == small


def test_packed_sets_come_back():
    rnd = np.random.default_rng(1)
    sets_ = [np.unique(rnd.integers(0, 1 << 48, n, dtype=np.uint64)) for n in (0, 5, 90, 3)]
    bounds = np.append(0, np.cumsum([len(s) for s in sets_]))
    col = S.packed_column(np.concatenate(sets_), bounds, np.array([True, False, True, True])).to_pylist()
    assert col[1] is None and all((S.unpacked(col[k]) == sets_[k]).all() and len(S.unpacked(col[k])) == len(sets_[k]) for k in (0, 2, 3))
    assert S.shared(sets_[2], np.sort(np.concatenate((sets_[2][::3], sets_[3])))) == 30 and S.shared(sets_[0], sets_[2]) == 0


def test_masks_cover_the_radius():
    """Whatever ``radius`` components differ, some table's mask leaves them all out."""
    c = Covering(parts=3, width=3)
    rnd = random.Random(0)
    masks = [(p * c.width, m) for p in range(c.parts) for m in c.masks()]
    for _ in range(500):
        differ = set(rnd.sample(range(c.parts * c.width), c.radius))
        assert any(all(first + i not in differ for i in range(c.width) if m >> i & 1) for first, m in masks)


def frame(spark, texts):
    rows = [(i + 1, t, "x", i % 3, 7.0) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, texts[0], "y", 1, 1.0), (1, texts[0], "x", 0, 7.0)], "file_id bigint, content string, id string, rep int, links double")


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus()
    r = near_duplicates(frame(spark, texts), "file_id", "content", 0.6)
    want = {(i + 1, j + 1) for i in range(len(texts)) for j in range(i + 1, len(texts)) if sim(texts[i], texts[j]) >= 0.6}
    pairs = [(p["id_a"], p["id_b"]) for p in r.pairs().collect()]
    assert set(pairs) == want and len(pairs) == len(want)
    docs = {d["id"]: d for d in r.documents().collect()}
    assert set(docs) == {i + 1 for i, t in enumerate(texts) if sets(t)}
    assert docs[len(texts)]["class_id"] == 1 and docs[1]["copies"] >= 2


def test_near_duplicates_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, ""), (2, "")]):
        r = near_duplicates(spark.createDataFrame(rows, "file_id bigint, content string"), "file_id", "content")
        assert r.pairs().count() == 0 and r.documents().count() == 0


def test_same_result_for_any_partitioning(spark):
    texts = corpus(5, 60)
    df = frame(spark, texts)
    out = [sorted(map(tuple, near_duplicates(df.repartition(n), "file_id", "content", 0.6).pairs().collect())) for n in (1, 4)]
    assert out[0] == out[1]


def test_hot_buckets_are_cut_into_blocks(spark):
    rows = spark.createDataFrame([(1, i) for i in range(150)] + [(2, 5), (2, 6), (3, 9)], "k bigint, i bigint")
    assert bucket_pairs(rows, "k", "i", block=16).where("tables = 1 OR a = 5").count() == 150 * 149 // 2
    sided = bucket_pairs(rows, "k", "i", left=F.col("i") < 10, block=16)
    assert {(r["a"], r["b"]) for r in sided.collect()} == {(a, b) for a in range(10) for b in range(10, 150)}


def test_bloom_lets_all_members_pass(spark):
    df = spark.range(0, 100_000, 3)
    b = build(df, "id", 33_334)
    ids = np.arange(0, 300_000, dtype=np.uint64)
    ok = b.might_hold(ids)
    assert ok[:100_000:3].all() and ok[100_000:].mean() < 0.05


def test_batches_against_history(spark):
    """Three batches, the state opened from its folder before each, equal one batch and brute force."""
    texts = corpus(7, 60)
    batch = [1 + (i * 7) % 5 for i in range(len(texts))]
    rows = [(i + 1, batch[i], t, len(t or ""), "n", None) for i, t in enumerate(texts)]
    want = {i + 1 for i, t in enumerate(texts) if any(batch[j] < batch[i] and sim(t, texts[j]) >= 0.6 for j in range(len(texts)))}
    df = spark.createDataFrame([*rows, (None, 1, texts[0], 1, "n", None), (999, None, texts[0], 1, "n", None)], "id bigint, batch int, text string, length bigint, name string, package string")
    seen = []
    for cuts in (["true"], ["batch < 3", "batch IN (3, 4)", "batch = 5 OR batch IS NULL"]):
        root = fresh_dir(spark, "state")
        for k, c in enumerate(cuts):
            state = IncrementalDedup(spark, 0.6, root=root, buckets=4)
            assert state.runs == k
            if k == 1:  # what a run left that did not end is not read
                df.select("id").write.parquet(f"{root}/keys/run=1")
            state.ingest(df.where(c))
        state = IncrementalDedup(spark, root=root)
        assert (state.threshold, state.buckets, state.runs) == (0.6, 4, len(cuts))
        found = {r["id"]: r for r in state.not_new().collect()}
        assert set(found) == want | {999}
        for i, r in found.items():
            o, t = r["duplicate_of"], texts[0] if i == 999 else texts[i - 1]
            assert sim(t, texts[o - 1]) >= 0.6 and (i == 999 or batch[o - 1] < batch[i - 1])
        docs = {r["id"]: (r["cluster_id"], r["links"]) for r in state.documents(df).collect()}
        links = [(r["a"], r["b"]) for r in state._read("links").collect()]
        assert links and len(links) == len(set(links)) and all(docs[a][0] == docs[b][0] for a, b in links)
        seen.append((docs, {(min(x), max(x)) for x in links}))
    groups = lambda docs: {frozenset(k for k in docs if docs[k][0] == c) for c, _ in docs.values()}
    assert groups(seen[0][0]) == groups(seen[1][0])
    weights = {(r["field"], r["agrees"]): r["weight"] for r in state.weights().collect()}
    assert weights["tables", True] > 0 > weights["tables", False]


def test_a_small_batch_reads_few_folders(spark):
    rnd = random.Random(3)
    row = lambda i: (i, 1, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(40)))
    state = IncrementalDedup(spark, 0.6, buckets=64)
    cols = "id bigint, batch int, text string"
    history = [row(i) for i in range(300)]
    state.ingest(spark.createDataFrame(history, cols))
    new = spark.createDataFrame([(1000, 2, history[5][2] + " x")], cols)
    ids = spark.createDataFrame([(k,) for k in (1, 2)], "cls bigint")
    assert state._touched("reps", ids, "cls", 1).count() < 60
    links = state.ingest(new).collect()
    assert [(r["a"], r["b"]) for r in links] == [(5, 1000)] and {r["id"] for r in state.not_new().collect()} == {1000}
    assert state.ingest(new.limit(0)).count() == 0 and state.runs == 3


def test_no_pair_is_lost_between_rare_and_full_sketches(spark):
    """Pairs of similarity 0.6 to 0.7 whose rare parts lie anywhere on both sides: none may fall between the two kinds of keys."""
    common = [f"c{i}" for i in range(90)]
    texts = [" ".join(common) + f" f{i}" for i in range(150)]  # makes runs of these words common
    first = len(texts)
    for k in range(400):
        own = [f"u{k}x{i}" for i in range(60)]
        shared, added = k % 40, 8 + k % 31  # common words in both; common words in the second only
        a = own + common[:shared]
        texts += [" ".join(a), " ".join(own + common[: shared + added])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string")
    want = {(i, i + 1) for i in range(first, len(texts), 2) if sim(texts[i], texts[i + 1]) >= 0.6}
    assert len(want) > 200
    got = {(r["id_a"], r["id_b"]) for r in near_duplicates(df, "id", "text", 0.6).pairs().where(f"id_a >= {first}").collect()}
    assert len(want - got) <= len(want) // 1000
    state = IncrementalDedup(spark, 0.6)
    rows = df.select("id", (F.col("id") % 2).cast("int").alias("batch"), "text")
    state.ingest(rows)
    assert {i + 1 for i, _ in want} <= {r["id"] for r in state.not_new().collect()}


def test_rare_bound_follows_from_the_threshold():
    assert abs(rare_from(0.6) - 0.51) < 1e-6 and abs(rare_from(0.8) - 0.68) < 1e-6
    rnd = random.Random(1)
    for _ in range(20_000):  # sets by their parts: common and rare in both, in one only
        t = rnd.choice((0.6, 0.8))
        both_c, both_r, a_c, a_r, b_c, b_r = (rnd.randrange(60) for _ in range(6))
        a, b = both_c + both_r + a_c + a_r, both_c + both_r + b_c + b_r
        union = a + b - both_c - both_r
        if union and a and b and (both_c + both_r) >= t * union and (both_r + a_r) / a >= FULL_BELOW:
            assert (both_r + b_r) / b >= rare_from(t)


def test_nothing_new(spark):
    t = " ".join(f"a{i}" for i in range(50))
    files = spark.createDataFrame(
        [(1, 1, "r1", "a.go", " SHA256:AA ", t), (2, 2, "r2", "b.go", None, t + " z"), (3, 2, "r3", "c.go", "bb", "q w e r t y"), (4, 3, "r4", "d.go", "cc", None), (5, 3, "r5", "e.go", None, ""), (6, None, None, None, None, None)],
        "file_id bigint, batch int, repository_id string, relative_path string, sha256 string, content string",
    )
    owners = spark.createDataFrame([("BB", "r9", 1), ("bb", "r3", 0), ("aa", "r1", 0), ("ee", "r7", 0), (None, "r8", 0)], "sha256 string, repo_id string, batch int")
    disc = spark.createDataFrame(
        [("r4", "d.go", True, "x.go", None, None), ("r1", "a.go", False, "y.go", None, None), ("r5", "e.go", True, None, "sha256:EE", None), ("r5", "e.go", True, None, None, None)],
        "repository_id string, relative_path string, accepted boolean, duplicate_of string, sha256 string, scanned_at timestamp",
    )
    assert {r["file_id"] for r in nothing_new(files, owners, disc).collect()} == {2, 3, 4, 5}
    assert nothing_new(files.limit(0), owners.limit(0), disc.limit(0)).count() == 0


def test_overlap_equals_brute_force(spark):
    texts = corpus(11, 90)
    split = ["train", "test", "Train ", "eval", None][0:]
    rows = [(i + 1, t, split[i % 5], "r") for i, t in enumerate(texts)]
    files = spark.createDataFrame(rows, "file_id bigint, content string, split string, repository_id string")
    samples = spark.createDataFrame(
        [("s1", "Return fmt.Errorf(abcdefghijklmnopqrstuvwxyz)", "train", "r"), ("s2", "return FMT.errorf(ABCDEFGHIJKLMNOPQRSTUVWXYZ) ", "val", "r"), ("s3", "short", "test", "r"), ("s4", "short", "train", "r"), ("s5", None, "test", None), (None, "return fmt.Errorf(abcdefghijklmnopqrstuvwxyz)", "test", "r")],
        "sample_id string, target_text string, split string, repository_id string",
    )
    label = lambda s: {"eval": "validation"}.get((s or "").strip().lower(), (s or "").strip().lower())
    train = [t for t, r in zip(texts, rows) if label(r[2]) == "train"]
    want = {("corpus_files", str(r[0])) for r in rows if label(r[2]) in ("validation", "test") and any(sim(r[1], t) >= 0.6 for t in train)}
    got = {(r["record_table"], r["record_key"]) for r in cross_split(files, samples, 0.6).collect()}
    assert got == want | {("samples", "s2")}
    ids = lambda split: files.where(F.lower(F.trim("split")).isin(*split)).select(F.col("file_id").alias("id"), F.col("content").alias("text"))
    counted = {r["id"]: r["links"] for r in overlapping(ids(["test", "eval"]), ids(["train"]), 0.6).collect()}
    distinct = {frozenset(sets(t)) for t in train if sets(t)}
    like = lambda a, b: len(a & b) / len(a | b) >= 0.6
    assert counted == {int(k): sum(like(sets(texts[int(k) - 1]), b) for b in distinct) for _, k in want}
    both = partners(ids(["test", "eval"]), ids(["train"]), 0.6).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in both} == counted
    tried = {r["id"] for r in overlapping(ids(["test", "eval"]), ids(["train"]), 0.6, links=False, first_try=1).collect()}
    assert tried == set(counted)
    assert equal_targets(samples.limit(0)).count() == 0
    empty = spark.createDataFrame([], "id bigint, text string")
    assert overlapping(empty, empty).count() == 0 and overlapping(empty, empty, links=False).count() == 0


@pytest.mark.parametrize("s", [0.6, 0.7, 0.9])
def test_miss_chance_of_the_defaults_is_small(s):
    assert Covering().miss_chance(s) < 5e-6 and Covering().worst_miss(s) < 1e-4


def test_clusters_hold_every_file(spark, tmp_path):
    words = lambda p, n=60: " ".join(f"{p}{i}" for i in range(n))
    texts = {1: words("a"), 2: words("a"), 3: words("a") + " more", 4: words("b"), 5: words("b"), 6: words("c"), 7: "short", 8: None, 9: words("a") + " more", 10: words("b"), 11: words("a") + " less"}
    files = [(i, 1 + (i > 8) * 5, f"p/{i}.go", "p", t) for i, t in texts.items()]
    d = str(tmp_path)
    spark.createDataFrame(files, "file_id bigint, batch int, relative_path string, package_name string, content string").write.parquet(f"{d}/corpus_files.parquet")
    got = {r["file_id"]: r for r in corpus_queries.p6_clusters(spark, d).collect()}
    earlier = {r["file_id"]: r for r in corpus_queries.p6_duplicates(spark, d).collect()}
    assert set(earlier) == {9, 10, 11} and (earlier[9]["duplicate_of"], earlier[10]["duplicate_of"]) == (3, 4) and earlier[9]["score"] is None
    assert {i: r["cluster_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 1, 9: 1, 11: 1, 4: 4, 5: 4, 10: 4, 6: 6, 7: 7, 8: 8}
    assert {i: r["links"] for i, r in got.items()} == {1: 2, 2: 2, 3: 2, 9: 2, 11: 2, 4: 0, 5: 0, 10: 0, 6: 0, 7: 0, 8: 0}


def test_unlike_texts_with_common_phrases_are_no_candidates(spark):
    """Texts of a third common phrases, all sent with full keys: their pairs must not grow with the square of the texts, and no similar one may be lost."""
    rnd = random.Random(9)
    phrases = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(40)]
    texts = []
    for k in range(600):
        own = " ".join(f"u{k}x{i}" for i in range(60))
        texts.append(" ".join([own, *rnd.sample(phrases, 4)]))
    texts += [t + " one more end" for t in texts[::6]]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    rarity = dataclasses.replace(rarity_of(docs, "text"), common=20)  # phrases stand in some 60 texts
    keys = covering_keys(docs, "text", Covering(), rarity, 0.6, ["id"]).where("n > 0").cache()
    rows = keys.where("tables IS NOT NULL").select("cls", "n", F.explode("tables").alias("key"))
    sketches = keys.where("sketch IS NOT NULL").select("cls", "sketch").distinct()
    want = {(i * 6, 600 + i) for i in range(100)}
    name = {r["cls"]: r["id"] for r in keys.collect()}
    found = [{tuple(sorted((name[r["a"]], name[r["b"]]))) for r in bucket_pairs(rows, "key", "cls", size="n", threshold=0.6, sketches=s).collect()} for s in (None, sketches)]
    assert want <= found[1] <= found[0] and len(found[0]) > 2000 and len(found[1]) < 200
    whole, parts = (sorted(map(tuple, bucket_pairs(rows, "key", "cls", size="n", threshold=0.6, sketches=sketches, passes=n).collect())) for n in (1, 3))
    assert whole == parts
    keys.unpersist()
    r = near_duplicates(docs, "id", "text", 0.6)
    assert {(p["id_a"], p["id_b"]) for p in r.pairs().collect()} == want


def test_sketches_lose_no_similar_pair():
    rnd = np.random.default_rng(4)
    limit, differ = most_different(0.6), []
    for n in (3, 12, 80, 300):  # common parts of 3 n of 5 n shingles: a similarity of 0.6
        for _ in range(150):
            v = np.unique(rnd.integers(0, 1 << 48, 5 * n, dtype=np.uint64))
            pick = rnd.permutation(len(v))
            a, b = np.sort(v[pick[: 4 * n]]), np.sort(v[np.append(pick[: 3 * n], pick[4 * n :])])
            x, y = sketch_column(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), np.ones(2, bool)).to_pylist()
            differ.append(sum(((x[f"l{k}"] ^ y[f"l{k}"] | x[f"h{k}"] ^ y[f"h{k}"]) & (1 << 64) - 1).bit_count() for k in range(2)))
    assert max(differ) <= limit and abs(np.mean(differ) - 128 * 0.3) < 1
    assert most_different(0.6) < 70 and most_different(1.0) == 0 and most_different(0.0) > 96 + 4 * 5


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    files = lambda: sum(f.endswith(".data") for at in shuffle_dirs(spark) for _, _, fs in os.walk(at) for f in fs)
    before = files()
    out = materialise(spark.range(10_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count(), "x")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and out.count() == 100
    discard(out)


def shuffle_dirs(spark):
    return [f.getPath() for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]


def test_a_run_compares_no_unlike_texts(spark):
    """Candidates of both runs, counted in the cells, must stay near the similar pairs though all texts share phrases."""
    rnd = random.Random(9)
    phrases = [" ".join(f"p{k}x{i}" for i in range(12)) for k in range(40)]
    texts = [" ".join([" ".join(f"u{k}x{i}" for i in range(60)), *rnd.sample(phrases, 4)]) for k in range(400)]
    texts += [t + " one more end" for t in texts[::8]]
    docs = spark.createDataFrame([(i, i // 400, t) for i, t in enumerate(texts)], "id bigint, batch int, text string")
    state = IncrementalDedup(spark, 0.6, buckets=2, rarity=dataclasses.replace(rarity_of(docs, "text"), common=20))
    for batch in (0, 1):
        state.ingest(docs.where(F.col("batch") == batch))
    assert {r["id"] for r in state.not_new().collect()} == set(range(400, 450))
    assert 50 <= state._read("cells").where("field = 'name'").agg(F.sum("all")).first()[0] < 200
