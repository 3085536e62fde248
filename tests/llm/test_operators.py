"""Operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoflow.llm import (
    embedding_dedup,
    exact_dedup,
    labelled,
    language_id,
    mixing,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_histogram,
    toxicity,
    wordbytes,
)
from geoflow.llm.components import connected, star_edges
from geoflow.llm.queries import VOCABULARY
from geoflow.llm.scratch import Scratch

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row int, key string, words int, blocks int, block int, grp string, name string, rank string, copy int"
PASSAGE = " ".join(f"w{i}" for i in range(40))


def rows_of(texts):
    extra = (0.5, 7, "k", 3, 1, 2, "g", "n", "r", 9)
    return [(i, t, lang, source, None if t is None else len(t), *extra) for i, t, lang, source in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with everything that may go wrong in them."""
    long = " ".join(f"x{i % 977}" for i in range(30_000))
    texts = [
        (5, PASSAGE, "en", "a"),
        (1, "head " + PASSAGE + " tail", "en", "a"),
        (2, "head " + PASSAGE + " tail", "en", "a"),
        (2, "head " + PASSAGE + " tail", "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (6, " \t\n", "de", None),
        (None, "head " + PASSAGE + " tail", None, "b"),
        (None, None, None, None),
        (7, long, "en", "c"),
        (8, long + " end", "en", "c"),
        (9, "one two\nthree", "de", "é"),
        (10, "one  two\tthree", "de", "z"),
        (11, "ONE two three", "de", "z"),
        (12, "123 !!! 456", "en", "z"),
        (13, "x" * 5000, "en", "z"),
        (14, "the the the " * 30, "en", "b"),
        (15, "the the the " * 30, "en", "b"),
        (16, "naïve ünïcödé “quoted” 漢字", "fr", "a"),
    ]
    return spark.createDataFrame(rows_of(texts), SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id > 1000")


def words(text):
    return [] if text is None else re.findall(r"[^\x20\x09-\x0D]+", text)


def test_xxh64_of_slices():
    rng = np.random.default_rng(1)
    data = np.frombuffer(rng.bytes(5000), np.uint8)
    starts = rng.integers(0, 4000, 1500)
    ends = starts + rng.integers(0, 800, 1500)
    want = [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends)]
    assert wordbytes.xxh64(data, starts, ends).tolist() == want


def test_sorted_order_with_close_keys():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 8, 5000, np.uint64) + (rng.integers(0, 3, 5000, np.uint64) << np.uint64(40))
    assert wordbytes.sorted_order(keys).tolist() == np.argsort(keys, kind="stable").tolist()


def test_components(spark):
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    chain = np.arange(500, 560)
    left, right = np.concatenate([left, chain[:-1], np.full(50, 700)]), np.concatenate([right, chain[1:], np.arange(701, 751)])
    root = star_edges(800, left, right)
    assert all(root[a] == root[b] for a, b in zip(left, right)) and np.all(root[root] == root) and np.all(root <= np.arange(800))
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in zip(left, right)], "u bigint, v bigint")
    got = {r.node: r.root for r in connected(edges, Scratch(spark, "test")).collect()}
    assert got == {i: int(root[i]) for i in set(left[left != right]) | set(right[left != right])}
    assert connected(edges.where("u < 0"), Scratch(spark, "test")).count() == 0


# op1


def removed_by_force(docs):
    first = {}
    for i, text in docs:
        w = words(text)
        for p in range(len(w) - 12):
            seed = tuple(w[p : p + 13])
            first[seed] = min(first.get(seed, i), i)
    out = []
    for i, text in docs:
        w = words(text)
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < i for q in range(p, p + 13)}
        out.append((i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)))
    return sorted(out)


@pytest.mark.parametrize(("parts", "block_seeds"), [(1, 2_000_000), (3, 500)])
def test_substring_dedup(spark, odd, monkeypatch, parts, block_seeds):
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 1000)
    got = substring_dedup.remove_repeated_passages(odd, block_seeds=block_seeds, parts=parts).collect()
    last = 10**18
    key = lambda r: (last if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text)
    want = removed_by_force([(last if r.doc_id is None else r.doc_id, r.text) for r in odd.collect()])
    assert sorted(map(key, got)) == want
    for r in got:
        assert all(f.ref_doc_id < (last if r.doc_id is None else r.doc_id) and f.length >= 13 for f in r.factors)


def test_passages_that_agree_in_the_seed_alone():
    seeds = np.array([7, 3, 7, 3, 7, 9], np.uint64)
    checks = np.array([2, 1, 1, 1, 2, 2], np.uint32)
    order, new = substring_dedup._runs(seeds, checks)
    assert order.tolist() == [1, 3, 2, 0, 4, 5]
    assert new.tolist() == [True, False, True, True, False, True]


def test_substring_dedup_with_colliding_seeds(spark, odd, monkeypatch):
    # every word counts the same in the seed of a window, so windows of the same words in any order collide
    texts = [(1, PASSAGE), (2, " ".join(reversed(PASSAGE.split()))), (3, PASSAGE + " tail")]
    docs = spark.createDataFrame(rows_of([(i, t, "en", "a") for i, t in texts]), SCHEMA).coalesce(1)
    same = np.full(substring_dedup.WINDOW, substring_dedup._ODD[0])
    seeds = substring_dedup._seeds(substring_dedup.WINDOW, 1, 0, 1)
    monkeypatch.setattr(substring_dedup, "_ODD", same)
    batches = docs.selectExpr("doc_id", "text", "crc32(text) key", "0 grp").toArrow().to_batches()
    rows = list(seeds(iter(batches)))
    found = [np.frombuffer(d, substring_dedup._MATCH) for b in rows for g, d in zip(b["grp"].to_pylist(), b["data"].to_pylist()) if g is not None]
    assert {(int(m["doc"]), int(m["ref"])) for f in found for m in f} == {(3, 1)}


def test_substring_dedup_of_common_passage(spark):
    docs = [(i, f"a{i} b{i} " + PASSAGE + f" c{i}", "en", "s") for i in range(300)]
    got = substring_dedup.remove_repeated_passages(spark.createDataFrame(rows_of(docs), SCHEMA).repartition(5)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: 40 if i else 0 for i in range(300)}


# op3


def test_exact_dedup(odd):
    got = exact_dedup.exact_duplicates(odd, block_chars=16).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = odd.collect()
    sizes = Counter(norm(r.text) for r in rows)
    keep = {}
    for r in rows:
        keep.setdefault(norm(r.text), []).append(r.doc_id)
    want = []
    for r in rows:
        ids = [i for i in keep[norm(r.text)] if i is not None]
        want.append((r.doc_id, min(ids) if ids else None, sizes[norm(r.text)], hashlib.sha256(norm(r.text).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({h[3]: 1 for h in want})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_draws_new_hashes(odd):
    """Hashes that agree for all blocks are found out and replaced."""
    weak = lambda block, attempt: exact_dedup.route(block, attempt) if attempt else F.struct(F.length(block).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))
    want = exact_dedup.exact_duplicates(odd, block_chars=4096).select("doc_id", "keep_id", "group_size").collect()
    got = exact_dedup.exact_duplicates(odd, block_chars=32, routed=weak).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(got, key=repr) == sorted(want, key=repr)


# op5


def test_token_histogram(spark, odd):
    counts = token_histogram.token_counts(odd, VOCABULARY)
    lengths = [r.n_tokens for r in counts.collect()]
    encode = token_histogram._encoding(open(VOCABULARY, "rb").read())[0].encode_ordinary
    assert sorted(lengths) == sorted(len(encode(r.text or "")) for r in odd.collect())
    histogram = token_histogram.length_histogram(counts)
    rows = histogram.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        n = r.n_tokens
        assert r.n_docs == lengths.count(n) and r.docs_longer == sum(x > n for x in lengths)
        assert r.docs_up_to == sum(x <= n for x in lengths) and r.quantile == r.docs_up_to / len(lengths)
        assert r.tokens_up_to == sum(x for x in lengths if x <= n) and r.tokens_longer == sum(x for x in lengths if x > n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
    limits = [0, 1, 17, 1024, 10**7]
    got = {r.context: (r.truncated_total, r.docs_cut) for r in token_histogram.at_limits(histogram, limits).collect()}
    assert got == {c: (sum(min(x, c) for x in lengths), sum(x > c for x in lengths)) for c in limits}
    quantiles = {r.share: r.n_tokens for r in token_histogram.length_quantiles(histogram, [0.5, 1.0]).collect()}
    assert quantiles == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}


# op7


def fingerprint_by_force(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(w)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_by_force(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if near(values[i], values[j]):
            root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_simhash(odd):
    rows = odd.collect()
    prints = [fingerprint_by_force(r.text) for r in rows]
    root = components_by_force(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    lowest = {}
    for r, k in zip(rows, root):
        if r.doc_id is not None:
            lowest[k] = min(lowest.get(k, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f"{p:016x}", lowest.get(k)) for r, p, k in zip(rows, prints, root)), key=repr)
    got = simhash.simhash_components(odd).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize(("parts", "tile"), [(4, 1024), (4, 16), (8, 64)])
def test_tiles_find_all_links(spark, parts, tile):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 250, np.uint64)
    values = set(base.tolist())
    for v in base[:120].tolist():  # chains of near fingerprints
        for _ in range(4):
            for b in rng.integers(0, 64, 3):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    scratch = Scratch(spark, "test")
    got = {r.node: r.root for r in connected(simhash.near_links(fps, scratch, 3, parts, tile), scratch).collect()}
    root = components_by_force(values, lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for v, k in zip(signed, root):
        groups.setdefault(k, []).append(v)
    assert got == {v: min(g) for g in groups.values() if len(g) > 1 for v in g}


# op8


def test_packing(odd):
    got = packing.packed_sequences(odd, capacities=(64, 256, 1024), shard_words=20_000).collect()
    texts = {}
    for r in odd.collect():
        if words(r.text):
            texts.setdefault(r.doc_id, []).append(tuple(words(r.text)))
    seen = Counter()
    for r in got:
        lines = r.text.split("\n")
        assert r.n_words == sum(r.lengths) <= r.capacity and r.capacity in (64, 256, 1024)
        assert r.capacity == min(c for c in (64, 256, 1024) if c >= r.n_words)
        for i, start, n, line in zip(r.doc_ids, r.starts, r.lengths, lines, strict=True):
            assert any(tuple(line.split(" ")) == t[start : start + n] for t in texts[i])
            seen[i] += n
    assert seen == Counter({i: sum(map(len, t)) for i, t in texts.items()})
    assert packing.packed_sequences(odd).count() == packing.packed_sequences(odd.repartition(3)).count()


def test_best_fit_is_tight():
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 4096, 3000).tolist()
    bins = packing.best_fit(lengths)
    assert sorted(i for _, items in bins for i in items) == list(range(3000))
    assert sum(c for c, _ in bins) < 1.02 * sum(lengths)
    assert packing.best_fit([]) == [] and packing.best_fit([4096, 1]) == [(4096, [0]), (512, [1])]


# op9


def test_mixing(spark, odd):
    got = mixing.mixed_sources(odd, block_words=8).collect()
    rows = odd.collect()
    size = Counter()
    for r in rows:
        size[r.source] += len(words(r.text))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(size.values())
    while True:
        rest = total - sum(3 * size[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[t] for t in order if t not in capped) for s in order if s not in capped}
        over = {s for s in share if share[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: share.get(s, 3 * size[s]) for s in order}
    source = {(r.doc_id, len(words(r.text))): r.source for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r.size
        taken[s] += r.taken
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((r.doc_id, len(words(r.text))) for r in rows if r.doc_id is not None)
    assert all(abs(taken[s] - target[s]) <= 8 for s in order)
    again = mixing.mixed_sources(odd.repartition(4), block_words=8).collect()
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_mixed_documents_agree_with_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("words", F.lit(1)).withColumn("copy", F.lit(1))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    n = Counter()
    for r in mixed.collect():
        n[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert n == Counter({r.doc_id: r.taken for r in mixing.mixed_sources(docs).collect() if r.taken})


def slots_of(spark, targets, shard_slots=mixing.SHARD_SLOTS):
    scratch = Scratch(spark, "slots")
    order = scratch.keep(mixing.permuted_blocks(targets))
    return order, scratch.keep(mixing.drawn_slots(mixing.source_slots(targets, order), order, shard_slots))


def test_slots_are_permuted_and_dealt_out_at_random(spark):
    targets = spark.createDataFrame([(0, "a", 6400, 12800.0), (1, "b", 640_000, 576_000.0), (2, "c", 64, 0.0)], "rank int, source string, source_size bigint, target double")
    order, drawn = slots_of(spark, targets, 100)
    places = {k: [r["index"] for r in sorted(order.where(F.col("rank") == k).collect(), key=lambda r: r.block)] for k in (0, 1)}
    assert sorted(places[0]) == list(range(100)) and sorted(places[1]) == list(range(10_000))
    # no line through the order: neighbouring blocks are anywhere, and both sources have orders of their own
    steps = Counter(b - a for a, b in zip(places[1], places[1][1:]))
    assert max(steps.values()) < 12 and sum(x == y for x, y in zip(places[0], places[1])) < 20
    rows = drawn.collect()
    times = Counter((r.rank, r.block) for r in rows)
    assert [times[0, b] for b in range(100)] == [2] * 100 and Counter(times[1, b] for b in range(10_000)) == {1: 9000, 0: 1000}
    assert all(times[1, b] == (i < 9000) for b, i in enumerate(places[1]))
    # shards have slots from 0 on, and the counts of a source vary as those of a multinomial draw do
    counts = {(r.shard, r.rank): r.slots for r in mixing.shard_counts(drawn).collect()}
    shards = 92
    for h in range(shards):
        assert sorted(r.slot for r in rows if r.shard == h) == list(range(sum(n for (s, _), n in counts.items() if s == h)))
    big = np.array([counts.get((h, 1), 0) for h in range(shards)])
    chi = float(np.sum((big - 9000 / shards) ** 2 / (9000 / shards)))
    assert big.sum() == 9000 and 50 < chi < 145


# op10


def test_vectors(spark):
    rng = np.random.default_rng(9)
    d = 24
    base = rng.normal(size=(40, d))
    vectors = [list(map(float, v)) for v in base]
    for v in base[:15]:
        for _ in range(6):
            vectors.append(list(map(float, v + rng.normal(0, 0.04 * np.linalg.norm(v), d))))
    hot = rng.normal(size=d)
    vectors += [list(map(float, hot + rng.normal(0, 0.01, d))) for _ in range(60)]
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, [2 * x for x in rows[0][1]], 0), (0, rows[0][1], 0)]
    strange = [None, [], [0.0] * d, [None] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] + [1.0] * (d - 1)]
    rows += [(n + 10 + k, v, 0) for k, v in enumerate(strange)] + [(n + 20, rows[0][1], None), (None, None, None), (n + 21, rows[0][1][:8], 0)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, label int, rep int, links int")
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[k] = np.array(v) / np.linalg.norm(v)
    near = lambda a, b: a in unit and b in unit and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93
    root = components_by_force(list(range(len(rows))), near)
    want = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None]
        links = sum(near(k, j) for j in range(len(rows)) if j != k)
        low = min(ids) if ids else None
        want.append((i, links, low, i is not None and i == low))
    for tile in (1024, 8):
        got = embedding_dedup.near_duplicate_vectors(table, tile=tile).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(10)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(axis=1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * o
    x, y = embedding_dedup.bucket_codes(a), embedding_dedup.bucket_codes(b)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.999


# op2, op4, op6


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize(("score", "column", "folds", "held", "least"), [(quality.quality_scores, "quality", 4, 2, 0.95), (toxicity.toxicity_scores, "toxic", 5, 0, 0.95)])
def test_held_out_accuracy(spark, score, column, folds, held, least):
    docs, labels = tables(spark)
    got = score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 30 and np.mean([r.predicted == r[column] for r in got]) >= least
    fold = docs.selectExpr("doc_id", f"crc32(cast(doc_id as string)) % {folds} = {held} as h").where("h").count()
    assert score(docs, labels).where("held_out").count() == fold


def test_samples_have_per_class_of_each_class(spark):
    ids = spark.range(3_000_020).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    labels = ids.select("doc_id", (F.col("doc_id") < 20).cast("int").alias("toxic"))
    _, y, weight = labelled.labelled_sample(ids, labels, "toxic", F.lit(False), 2)
    assert Counter(y.tolist()) == {0: 2, 1: 2} and set(weight[y == 0]) == {1_500_000.0} and set(weight[y == 1]) == {10.0}
    # one id many times, in labels and in texts, and languages of a hot third, of a few rows and of one row repeated
    hot = ids.limit(20).unionAll(spark.range(1000).selectExpr("7L as doc_id", "concat('text ', id) as text"))
    texts, y, _ = labelled.labelled_sample(hot, labels.unionAll(labels.where("doc_id = 7")).where("doc_id < 20"), "toxic", F.lit(False), 19)
    assert len(texts) == 19 and set(y) == {1}
    lang = F.expr("case when doc_id < 20 then 'rare' when doc_id < 1000020 then 'hot' else concat('l', doc_id % 3) end")
    rows = ids.withColumn("lang", lang).unionAll(spark.range(100_000).selectExpr("5L as doc_id", "'same' as text", "'one' as lang"))
    _, names = labelled.class_sample(rows, "lang", F.lit(False), 3)
    assert Counter(names) == dict.fromkeys(["rare", "hot", "l0", "l1", "l2", "one"], 3)


def test_held_out_language(spark):
    docs, _ = tables(spark)
    got = language_id.predicted_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_classifiers_on_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 1, "x"), (2, 0, 0, "x"), (None, 1, 1, "x"), (7, None, None, "x"), (9, 1, 0, "x")], "doc_id bigint, quality int, toxic int, score string")
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        got = score(odd, labels).collect()
        assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r.doc_id) for r in odd.collect())
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and (r.held_out is None) == (r.doc_id is None) for r in got)
        assert score(none, labels).count() == 0 and score(odd, labels.where("doc_id > 100")).count() == odd.count()
    got = language_id.predicted_languages(odd).collect()
    assert all(0 <= r.score <= 1 for r in got)
    lang = {r.doc_id: r.lang_pred for r in got}
    assert lang[3] == lang[4] == lang[6] == lang[12] == "und" and lang[16] != "und"
    assert language_id.predicted_languages(none).count() == 0
    assert {r.lang_pred for r in language_id.predicted_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_spans_are_character_offsets():
    texts = ["é clown ü", "", "fine", "“Scum”, he said"] * 20
    y = np.array([1, 0, 0, 1] * 20)
    model = toxicity.fit([t.encode() for t in texts], y, np.ones(80))
    score, spans = toxicity.score_texts([t.encode() for t in texts[:4]], model)
    assert [s > 0.5 for s in score] == [True, False, False, True]
    found = [{texts[k][s["start"] : s["end"]].strip("“”") for s in spans[k]} for k in range(4)]
    assert "clown" in found[0] and "Scum" in found[3] and not found[1] and not found[2]


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(11)
    scores, steps = rng.normal(size=6), rng.normal(size=4)
    chains = np.array([0, 4])
    forward, backward, _ = toxicity.forward_backward(scores, chains, steps)
    got = forward * backward / (1 + forward * backward)
    move = np.array([[0, steps[1]], [steps[2], steps[3]]])
    for a, b in ((0, 4), (4, 6)):
        total, mass = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            e = steps[0] * y[0] + sum(scores[a + i] * v for i, v in enumerate(y)) + sum(move[p, q] for p, q in zip(y, y[1:]))
            total += np.exp(e)
            mass += np.exp(e) * np.array(y)
        assert np.allclose(got[a:b], mass / total)


def test_gradients_through_time():
    rng = np.random.default_rng(12)
    cell = language_id.Cell(rng.normal(0, 0.3, (256, 9)) + 0.2, rng.normal(0, 0.3, (9, 3)))
    x, aim = rng.integers(0, 256, (7, 5)), rng.normal(size=(7, 3, 5))
    loss = lambda: float((language_id._forward(cell, x)[0] * aim).sum())
    _, kept = language_id._forward(cell, x)
    d_inputs, d_recurrent = language_id._through_time(cell, x, kept, aim)
    for weights, gradient, places in ((cell.recurrent, d_recurrent, [(0, 0), (4, 1), (8, 2)]), (cell.inputs, d_inputs, [(x[0, 0], 0), (x[3, 2], 4), (x[6, 4], 8)])):
        for at in places:
            old = weights[at]
            weights[at] = old + 1e-6
            up = loss()
            weights[at] = old - 1e-6
            down = loss()
            weights[at] = old
            assert gradient[at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_pooling_is_that_of_the_network():
    rng = np.random.default_rng(13)
    texts = [b"abc", b"", bytes(rng.integers(97, 123, 300).tolist())]
    model = language_id.fit([b"abcd " * 30, b"wxyz " * 30], ["a", "b"], steps=3)
    got = language_id.pooled(texts, model)
    for text, p in zip(texts, got):
        parts = []
        for at in range(0, len(text), language_id.RUN):
            x = np.frombuffer(text[at : at + language_id.RUN], np.uint8).astype(int)[:, None]
            ahead, back = language_id._forward(model.ahead, x)[0], language_id._forward(model.back, x[::-1])[0][::-1]
            e = np.exp(np.einsum("lk,tkb->tl", model.out, np.concatenate([ahead, back, np.ones((len(x), 1, 1))], axis=1)))
            parts.append(e / e.sum(axis=1, keepdims=True))
        assert np.allclose(p, np.concatenate(parts).mean(axis=0) if parts else 0, atol=1e-4)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(14)
    y = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    gram = np.tile(np.arange(5), 60)
    value = (rng.normal(size=(60, 5)) + 0.5 * y[:, None]).ravel()
    w = quality.dual_coordinate_descent(np.arange(61) * 5, gram, value, y, epochs=400)
    x = np.column_stack([value.reshape(60, 5), np.ones(60)])
    cost = lambda v: 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()
    best = cost(np.append(w[:5], w[-1]))
    assert all(best <= cost(np.append(w[:5], w[-1]) + rng.normal(0, s, 6)) + 1e-6 for s in (0.01, 0.1) for _ in range(200))


def test_empty_tables(spark, none):
    assert substring_dedup.remove_repeated_passages(none).count() == 0
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert simhash.simhash_components(none).count() == 0
    assert packing.packed_sequences(none).count() == 0
    assert mixing.mixed_sources(none).count() == 0
    assert token_histogram.length_histogram(token_histogram.token_counts(none, VOCABULARY)).count() == 0
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.near_duplicate_vectors(empty).count() == 0
def test_long_white_space_is_encoded_as_by_the_pattern():
    ranks = open(VOCABULARY, "rb").read()
    by_pattern, whole = encoders = token_histogram._encoding(ranks)
    rng = np.random.default_rng(11)
    alphabet = np.array(list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000ab7.'sé"))
    for _ in range(300):
        text = "".join(rng.choice(alphabet, rng.integers(0, 60), p=[0.3] + [0.7 / (len(alphabet) - 1)] * (len(alphabet) - 1)))
        for long_run in (1, 2, 3, 8):
            assert token_histogram.count_tokens(text, encoders, long_run) == len(by_pattern.encode_ordinary(text))
    assert token_histogram.WHITE and "".join(p for _, p in token_histogram.pieces("a" + " " * 20 + "b\n\n\n", 3)) == "a" + " " * 20 + "b\n\n\n"


@pytest.mark.parametrize("run", [" ", "\n", " \n"])
def test_tokens_of_a_text_of_five_million_spaces(spark, run):
    n = 5_000_000 // len(run)
    long = spark.createDataFrame([(1, run * n + "x"), (2, "a" + run * n), (3, "x" * 1_000_000), (4, None), (5, "")], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_histogram.token_counts(long, VOCABULARY).collect()}
    assert (got[4], got[5]) == (0, 0) and got[3] == 125_000
    by_pattern, whole = token_histogram._encoding(open(VOCABULARY, "rb").read())
    assert got[2] == 1 + len(whole.encode_ordinary(run * n))
    assert got[1] == len(whole.encode_ordinary((run * n)[:-1])) + len(by_pattern.encode_ordinary(run[-1] + "x"))


