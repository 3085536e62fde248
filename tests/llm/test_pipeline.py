"""The pipeline's stages on planted copies and toxic documents, and on odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from geoflow.llm import mixing, near_copies, simhash
from geoflow.llm.components import star_edges
from geoflow.llm.scratch import Scratch, clean

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "stages")
    before = docs
    for (name, stage), nth in zip(cp.STAGES[:-1], range(9)):
        after = scratch.keep(stage(spark, before, SF))
        assert after.columns == cp.COLUMNS, name
        if nth < 3:
            assert 0.7 * before.count() < after.count() <= before.count(), name
            assert after.join(before, cp.COLUMNS, "left_anti").count() == 0
        before = after
    packed = cp.STAGES[-1][1](spark, before, SF)
    assert packed.agg(F.sum("n_words")).first()[0] == before.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert cp.run(spark, SF).agg(F.sum("n_words")).first()[0] == packed.agg(F.sum("n_words")).first()[0]


def test_dedup_stages_keep_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text, "en", "a", 1), (2, text, "en", "a", 1), (2, text, "en", "a", 1), (7, text + "  x", "en", "b", 1), (3, None, None, None, None), (4, "", None, None, 0), (None, "solo words here", "en", "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("sha", F.lit(1))
    exact = cp.drop_exact_copies(spark, docs, SF)
    assert sorted((r.doc_id for r in exact.collect()), key=repr) == sorted([2, 7, 3, None], key=repr)
    near = cp.drop_near_copies(spark, docs, SF)
    assert sorted((r.doc_id for r in near.collect()), key=repr) == sorted([2, 3, None], key=repr)
    for _, stage in cp.STAGES[1:]:
        assert stage(spark, docs.where("doc_id > 99"), SF).count() == 0


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    texts = [" ".join(f"{k}{i * i}" for i in range(200)) for k in "abc"]
    rows = [(None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[0].upper()), (4, texts[2]), (1, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    near = cp.drop_near_copies(spark, docs, SF)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=repr) == sorted([(4, texts[0].upper()), (None, texts[1]), (1, texts[2])], key=repr)


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _planted(rng):
    """Texts of 30 to 1000 words and edited copies of them, most at similarities from 0.7 to 1, some in chains."""
    texts = []
    for g in range(150):
        n = rng.choice([30, 100, 300, 1000])
        words = [f"t{rng.randrange(5000)}" for _ in range(n)]
        texts.append(" ".join(words))
        for _ in range(rng.choice([1, 1, 3])):
            edited = list(words)
            for at in rng.sample(range(n), max(1, round(n * rng.uniform(0, 0.03)))):
                edited[at] = f"e{g}_{rng.randrange(10**9)}"
            if rng.random() < 0.3:
                edited = edited[: round(n * rng.uniform(0.75, 1))]
            texts.append(" ".join(edited))
            words = edited if rng.random() < 0.3 else words
            n = len(words)
    return texts


@pytest.mark.parametrize(("tile", "tile_bytes"), [(1024, 16 << 20), (2, 4000)])
def test_near_dedup_finds_similar_shingles(spark, tile, tile_bytes):
    texts = list(dict.fromkeys(_planted(random.Random(5))))
    sets = [_shingles(t) for t in texts]
    root, between = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                between += 1
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert between > 100 and len(set(root)) > 150
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if tile == near_copies.TILE:
        got = cp.drop_near_copies(spark, docs, SF)
    else:
        got = near_copies.near_copies(docs.withColumn("sha", F.sha2("text", 256)), tile, tile_bytes)
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(root))


def test_mix_reaches_targets_of_small_sources(spark):
    size = {"hot": 20_000} | {f"s{n:03}": n for n in (5, 10, 11, 20, 64, 65, 130, 200, 400, 500)}
    rows = [(i, "w " * (n // parts + (k < n % parts)), "en", s, 0) for i, (s, n) in enumerate(size.items()) for parts in [3] for k in range(parts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    words = F.sum(F.regexp_count("text", F.lit(mixing.WORD)))
    taken = {r.source: r.n for r in cp.mix_sources(spark, docs, SF).groupBy("source").agg(words.alias("n")).collect()}
    target = {s: 3 * n for s, n in size.items()}
    target["hot"] = sum(size.values()) - sum(n for s, n in target.items() if s != "hot")
    assert {s: n for s, n in taken.items() if s != "hot"} == {s: n for s, n in target.items() if s != "hot"}
    assert abs(taken["hot"] - target["hot"]) <= 64


def test_slots_of_small_sources_below_their_limit(spark):
    sizes = [1, 5, 63, 64, 65, 127, 130, 200, 500, 6400]
    rows = [(k, f"s{k}", n, n * share) for k, (n, share) in enumerate((n, share) for n in sizes for share in (0.01, 0.4, 1.3, 2.9, 3.0))]
    targets = spark.createDataFrame(rows, "rank int, source string, source_size bigint, target double")
    order = Scratch(spark, "order").keep(mixing.permuted_blocks(targets))
    drawn = Counter((r.rank, r.block) for r in mixing.drawn_slots(mixing.source_slots(targets, order), order).collect())
    for rank, _, n, target in rows:
        times = [drawn[rank, b] for b in range(-(-n // 64))]
        taken = sum(k * min(64, n - 64 * b) for b, k in enumerate(times))
        assert max(times) <= 3 and sum(times) >= 1 and abs(taken - target) <= 64
        assert max(times) - min(times) <= 1 and (target < 3 * n or taken == target)


def test_clean_deletes_scratch(spark):
    kept = Scratch(spark, "gone").keep(spark.range(5).toDF("x"))
    table = kept.scratch_table
    assert kept.count() == 5
    clean(spark)
    assert not spark.catalog.databaseExists(table.split(".")[0])
    assert pytest is not None


def test_near_dedup_takes_its_candidates_from_simhash_tiles(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join(words[:-3]), " ".join(words[3:])]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [r.doc_id for r in cp.drop_near_copies(spark, docs, SF).collect()] == [0]
    monkeypatch.setattr(simhash, "_linked", lambda limits, width: lambda batches: iter(()))
    assert sorted(r.doc_id for r in cp.drop_near_copies(spark, docs, SF).collect()) == [0, 1, 2]


@pytest.mark.parametrize("tile", [1 << 14, 3])
def test_tiles_of_sets_find_all_near_fingerprints(spark, tile):
    rng = np.random.default_rng(3)
    sets = [np.empty(0, np.uint64)] * 2
    for n in [4, 5, 8, 30, 33, 100, 101, 500] * 12:  # the larger ones cross classes
        base = rng.integers(0, 2**64, n + n // 3, np.uint64)
        sets += [base[:n], base[n // 8 : n], base[: n + n // 10], base[n // 12 :]]
    sizes = np.array([len(x) for x in sets])
    prints, cells = simhash.set_fingerprints(sets), simhash.size_classes(sizes)
    rows = [(i, int(n), int(c), fp) for i, (n, c, fp) in enumerate(zip(sizes, cells, prints.view(np.int64).tolist()))]
    nodes = spark.createDataFrame(rows, "node bigint, n bigint, cell bigint, fps array<bigint>")
    scratch = Scratch(spark, "sets")
    links = simhash.set_links(nodes, scratch, near_copies.limits, 4, 5, tile=tile).collect()
    differ = np.cumsum(np.bitwise_count(prints[:, None] ^ prints[None]), axis=2, dtype=int)[:, :, 1:]
    near = (differ <= [[near_copies.limits(max(a, b)) for b in cells] for a in cells]).all(axis=2)
    lowest = {c: sizes[cells == c].min() for c in set(cells)}
    most = {c: sizes[cells == c].max() for c in set(cells)}
    allowed = np.array([[4 * lowest[max(a, b)] <= 5 * most[min(a, b)] for b in cells] for a in cells])
    want, got = star_edges(len(sets), *np.nonzero(near & allowed)), star_edges(len(sets), *np.array([(r.u, r.v) for r in links]).T)
    assert got.tolist() == want.tolist() and len(set(want.tolist())) < len(sets) - 100
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(a, sets[j]))
            if 5 * shared >= 4 * (len(a) + len(sets[j]) - shared):
                assert near[i, j] and allowed[i, j]
