"""Fingerprints, near-duplicates and components against brute force."""

import hashlib
import random
import re
import struct
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from boxstar.llm import graph, imatch, pq, simhash
from boxstar.llm.registered import op3_embedding_near_dedup, op7_fingerprints, op9_simhash

from .conftest import SF, awkward_texts


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, link):
    """Smallest id of each row's component; ``link`` is a square boolean matrix."""
    label = np.arange(len(ids))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(ids)).min(axis=1, initial=len(ids)))
        new = new[new]
        if (new == label).all():
            break
        label = new
    least = {}
    for i, x in zip(ids, label):
        least[x] = min(i, least.get(x, i))
    return [least[x] for x in label]


def test_op9_whole_table(spark, small_docs):
    rows = {r.doc_id: r for r in op9_simhash(spark, SF).collect()}
    ids = [d for d, _ in small_docs]
    prints = np.array([brute_print(t) for _, t in small_docs], dtype=np.uint64)
    assert [rows[d].fingerprint for d in ids] == [f"{p:016x}" for p in prints.tolist()]
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    assert [rows[d].component_id for d in ids] == brute_components(ids, near)


def test_op9_awkward(spark, awkward, no_docs):
    rows = simhash.near_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((i, f"{brute_print(t):016x}") for i, t in awkward_texts())
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[8] == by_id[5] == 5 and by_id[1] == by_id[2] == by_id[3] == 1
    assert simhash.near_duplicates(no_docs).collect() == []


def test_keep_one_keeps_one_row_of_each_group(spark, awkward, no_docs):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    want = {}
    for i, t in awkward_texts():
        k = brute_print(t)
        order = (i is None, i if i is not None else 0)
        if k not in want or order < want[k][0]:
            want[k] = (order, i, t)
    assert got == Counter((i, t) for _, i, t in want.values())
    assert simhash.keep_one(no_docs).collect() == []


@pytest.mark.parametrize("shard", [40, 10_000])
def test_links_connect_as_all_pairs_do(spark, shard):
    rng = random.Random(3)
    prints = []
    for _ in range(150):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 6])):
            p = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.append(p)
            base = p if rng.random() < 0.5 else base  # chains
    hot = rng.getrandbits(64)
    prints += [hot ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20, 30)]
    prints = sorted(set(prints))
    a = np.array(prints, dtype=np.uint64)
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long").repartition(4)
    links = simhash.fingerprint_links(df, 4, shard=shard)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert len(pairs) <= 3 * 4 * len(prints)  # a forest, not all pairs
    want = brute_components(list(range(len(a))), np.bitwise_count(a[:, None] ^ a[None, :]) <= 4)
    tree = {r.node: r.root for r in graph.components(links).collect()}
    signed = a.view(np.int64).tolist()
    got = [tree.get(x, x) for x in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_routing_reaches_the_home_of_every_near_value_and_no_empty_node():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for mask in simhash.band_masks(3):
        near = values ^ np.uint64(int(mask) & -int(mask))  # one bit of the band away
        tree = {n: (v, r) for n, v, r in simhash.grow(values[:200], mask, 10)}  # more leaves than sample values
        home = np.zeros(len(values), dtype=np.int64)
        for leaf, who in simhash.walk(tree, values, mask, 0).items():
            assert len(who)
            home[who] = leaf
        asked = {(leaf, i) for leaf, who in simhash.walk(tree, near, mask, 1).items() for i in who.tolist()}
        assert all((h, i) in asked for i, h in enumerate(home.tolist()))


def test_gathered_batches_hold_the_same_rows(monkeypatch):
    monkeypatch.setattr(simhash, "ROUTED", 100)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + n), pa.int64())], names=["fp"]) for i, n in ((0, 30), (30, 0), (30, 80), (110, 7))]
    got = list(simhash._gathered(iter(batches)))
    assert [b.num_rows for b in got] == [110, 7]
    assert [v for b in got for v in b.column(0).to_pylist()] == list(range(117))
    assert list(simhash._gathered(iter([]))) == []


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    links += [(5, 5), (300, 301), (301, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    for node, root in got.items():
        assert root == (0 if node <= 40 else 100 if node < 200 else 200 if node < 300 else 300)
    assert len(got) == 41 + 50 + 7 + 2
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


# -- embeddings --------------------------------------------------------------------------


def brute_vectors(rows):
    """(links, component) per row by all pairs."""
    good = []
    for _, v in rows:
        ok = v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)
        good.append(ok)
    n = len(rows)
    link = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
                link[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    return link.sum(axis=1).tolist(), brute_components([i for i, _ in rows], link)


def test_op3_hard_vectors(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for _ in range(30):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 5)):
            rows.append((k, (base + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])).astype(np.float32).tolist()))
            k += 1
    same = rows[0][1]
    rows += [(k + i, same) for i in range(6)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [float("inf")] + [0.0] * 15), (905, [None, 1.0])]
    rows += [(906, [1.0, 0.0]), (907, [2.0, 0.0]), (907, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in pq.near_duplicates(df).collect())
    links, comps = brute_vectors(rows)
    assert got == Counter((i, n, c, i == c) for (i, _), n, c in zip(rows, links, comps))


def test_op3_whole_table_recall(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY vec_id").fetchall()
        x = np.array([v for _, v in rows], dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = x @ x.T >= 0.95
        np.fill_diagonal(link, False)
        got = {r.vec_id: r for r in op3_embedding_near_dedup(spark, sf).collect()}
        found = sum(r.n_links for r in got.values())
        assert found == link.sum()
        assert all(got[i].n_links == n for (i, _), n in zip(rows, link.sum(axis=1).tolist()))
        assert len(got) == len(rows)


def test_op3_recall_just_above_the_threshold(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal(base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    pairs = 0.9505 * base + np.sqrt(1 - 0.9505**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, pairs]))]
    found = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).agg(F.sum("n_links")).first()[0]
    assert found == 6000


def test_op3_very_small_and_large_components(spark):
    rows = [(1, [1e-170] * 16), (2, [3e-170] * 16), (3, [1e170] * 16), (4, [2e170] * 16), (5, [1.0] * 16), (6, [5e-324] * 16),
            (7, [1e170, -1e170] * 8), (8, [-1e-170, 1e-170] * 8), (9, [0.0] * 16), (10, [1.7e308] * 16)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    same = {1, 2, 3, 4, 5, 6, 10}
    assert got == {i: (len(same) - 1, 1) if i in same else (0, i) for i, _ in rows}


def test_op3_empty(spark):
    assert pq.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_op3_fit_holds_no_table_of_sample_by_lists():
    x = pq.unit_rows(np.random.default_rng(3).standard_normal((8192, 8)))
    tracemalloc.start()
    q = pq.fit(x, 4096)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(q.centroids) == 4096
    assert most < 100e6  # the products of all vectors and centroids are 268 MB


def test_op3_one_of_two_linked_vectors_asks_the_others_list():
    rng = np.random.default_rng(12)
    x = pq.unit_rows(rng.standard_normal((4000, 3)))  # every cell borders on others
    q = pq.fit(x[:1000], 60)
    reach = pq._reach(0.95)
    own, row, at = q.asked(x, reach)
    asks = np.zeros((len(x), 60), dtype=bool)
    asks[row, at] = True
    a, b = np.nonzero(x @ x.T >= 0.95)
    assert (own[a] != own[b]).sum() > 1000
    assert (asks[a, own[b]] | asks[b, own[a]]).all()
    assert asks.sum() < 0.5 * asks.size  # most lists are passed over


def test_op3_vectors_are_sent_once_and_tiles_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(21)
    base = rng.standard_normal((300, 6))
    close = base[0] + 0.02 * rng.standard_normal((200, 6))  # a group over several tiles
    x = np.concatenate([base, base[:150] + 0.1 * rng.standard_normal((150, 6)), close]).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(700 + i, x[0].tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    tiles, batch = [], spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def land(frame, name, *more, land=pq.land):
        out = land(frame, name, *more)
        if name == "vector_tiles":
            tiles.extend(len(r.node) // 8 for r in out.select("node").collect())
        return out

    monkeypatch.setattr(pq, "land", land)
    for name, value in (("TILE", 70), ("LIST_SIZE", 10), ("BLOCK", 16), ("ASKERS", 32), ("PAIRS", 100), ("TILE_CELLS", 500), ("CELLS", 900)):
        monkeypatch.setattr(pq, name, value)
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in pq.near_duplicates(df).collect())
    links, comps = brute_vectors(rows)
    assert got == Counter((i, n, c) for (i, _), n, c in zip(rows, links, comps))
    assert sum(tiles) == 650 and len(tiles) == 10 and max(tiles) < 2 * 70  # every class once, whatever it asks
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") in (batch, "512")


def test_op3_a_sample_bounded_by_bytes_loses_nothing(spark, monkeypatch):
    rng = np.random.default_rng(22)
    x = rng.standard_normal((400, 12))
    x = np.concatenate([x, x[:100] + 0.05 * rng.standard_normal((100, 12))])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sizes = []
    monkeypatch.setattr(pq, "fit", lambda sample, lists, fit=pq.fit: sizes.append((len(sample), lists)) or fit(sample, lists))
    monkeypatch.setattr(pq, "FIT_BYTES", 4 * 12 * 16)
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(df).collect()}
    links, comps = brute_vectors(rows)
    assert got == {i: (n, c) for (i, _), n, c in zip(rows, links, comps)}
    assert sizes == [(16, 4)]


def test_op3_forest_over_batches():
    rng = np.random.default_rng(23)
    a, b = rng.integers(0, 500, 400), rng.integers(0, 500, 400)
    forest = pq.Forest(500)
    for i in range(0, 400, 7):
        forest.add(a[i : i + 7], b[i : i + 7])
        if i % 5 == 0:
            forest.fold()
    label, want = forest.fold(), graph.roots(500, a, b)
    assert len(set(zip(label.tolist(), want.tolist()))) == len(set(label.tolist())) == len(set(want.tolist()))


def test_small_lists_and_audiences_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((20, 8))
    rows = [(i, (base[i % 20] + 0.05 * rng.standard_normal(8)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(pq.near_duplicates(df).collect())
    monkeypatch.setattr(pq, "BLOCK", 7)
    monkeypatch.setattr(pq, "ASKERS", 11)
    assert sorted(pq.near_duplicates(df).collect()) == want
    links, comps = brute_vectors(rows)
    assert [(r.n_links, r.component_id) for r in want] == list(zip(links, comps))


# -- I-Match -----------------------------------------------------------------------------


def edited(texts):
    return [t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4] for i, t in enumerate(texts)]


def test_op7_whole_table(spark, small_docs):
    rows = {r.doc_id: r for r in op7_fingerprints(spark, SF).collect()}
    texts = [t for _, t in small_docs]
    for (doc, t), e in zip(small_docs, edited(texts)):
        r = rows[doc]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_text = {}
    for doc, t in small_docs:
        assert by_text.setdefault(t, rows[doc].fingerprint) == rows[doc].fingerprint
    assert len({r.fingerprint for r in rows.values()}) > 0.8 * len(set(texts))
    assert np.mean([r.near_edited for r in rows.values()]) > np.mean([r.near_next for r in rows.values()]) + 0.1


def test_op7_terms_and_band_match_python(spark):
    texts = [f"common shared{i % 3} rare{i} Mixed-Case" for i in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bits = imatch.lexicon(df, low=3 / 12, high=5 / 12)
    assert len(bits) == 3
    out = df.select("doc_id", F.size(imatch.band_terms(imatch.term_hashes(F.col("text")), bits)).alias("n")).collect()
    assert {r.n for r in out} == {1}  # only shared0..2 are held by 4 of 12 documents


def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed & (2**64 - 1))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def hash_of(terms):
    h = 42
    for t in terms:
        h = xx(struct.pack("<q", t), h)
    return h


def brute_fingerprints(texts, low=imatch.LOW, high=imatch.HIGH):
    """Fingerprints of ``texts`` by a band over all of them, as dictionaries."""
    terms = [sorted({signed(xx(w.encode())) for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}) for t in texts]
    df = Counter(t for ts in terms for t in ts)
    band = {t for t, n in df.items() if low * len(texts) <= n <= high * len(texts)}

    def sums(kept):
        out = []
        for seed in range(imatch.SEEDS):
            above = kept
            for k, rate in enumerate(imatch.RATES):
                draw = {t: xx(struct.pack("<i", seed), xx(struct.pack("<q", t))) >> 2 * k for t in above}
                above = [t for t in above if signed(draw[t]) % rate == 0]
                out.append(hash_of(above) if above else None)
        return out

    def of(text):
        own = sorted({signed(xx(w.encode())) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w})
        inside = [t for t in own if t in band]
        return [*sums(inside), *sums(own), hash_of(own)]

    return of, band


def brute_likeness(a, b):
    shares, n = [], imatch.SUBSETS
    for part in (slice(0, n), slice(n, None)):
        pairs = [(x, y) for x, y in zip(a[part], b[part]) if x is not None or y is not None]
        if all(any(x is not None for x in f[part]) for f in (a, b)):
            shares.append(sum(x == y for x, y in pairs) / len(pairs))
    return max(shares)


def test_op7_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    texts = [t for _, t in docs]
    of, band = brute_fingerprints(texts)
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    assert set(imatch.lexicon(imatch.keyed_documents(frame))) == band
    rows = {r.doc_id: r for r in op7_fingerprints(spark, sf).collect()}
    shown = lambda f: ":".join("-" if x is None else f"{x:016x}" for x in f)
    own = [of(t) for t in texts]
    for k, ((doc, _), e) in enumerate(zip(docs, edited(texts))):
        changed = of(e)
        assert (rows[doc].fingerprint, rows[doc].edited_fingerprint) == (shown(own[k]), shown(changed))
        assert rows[doc].near_edited == pytest.approx(brute_likeness(own[k], changed))
        assert rows[doc].near_next == pytest.approx(brute_likeness(own[k], own[(k + 1) % len(own)]))


@pytest.mark.parametrize("size,copies", [(50, 0), (1000, 334)])
def test_op7_compares_small_tables_and_hot_copies(spark, size, copies):
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE length(text) > 400 ORDER BY doc_id LIMIT {size - copies}").fetchall()]
    rng = random.Random(5)
    rows = texts + [texts[0]] * copies
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.fingerprint_documents(df).collect()}
    hot = [r for r in got.values() if rows[r.doc_id] == texts[0]] if copies else list(got.values())
    assert np.mean([r.near_edited > 0 for r in hot]) >= 0.3  # none without the subsets of all terms
    other = [r for r in got.values() if rows[r.doc_id] != rows[(r.doc_id + 1) % len(rows)]]
    assert np.mean([r.near_edited for r in other]) > np.mean([r.near_next for r in other]) + 0.03


def test_op7_awkward(spark, awkward, no_docs):
    rows = imatch.fingerprint_documents(awkward).collect()
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((i, len(t or "")) for i, t in awkward_texts())
    same = {r.doc_id: r.fingerprint for r in rows if r.doc_id in (5, 8)}
    assert same[5] == same[8]
    two = [r for r in rows if r.doc_id == 8]
    assert two[0] == two[1]
    assert imatch.fingerprint_documents(no_docs).collect() == []


def test_op7_single_document_is_its_own_next(spark):
    df = spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")
    r = imatch.fingerprint_documents(df).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0


def test_next_documents_over_many_partitions(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    keys = spark.createDataFrame([(False, i, i * 7) for i in ids], "none boolean, id long, h long").repartition(9)
    got = {r.id: (r.next_id, r.next_h) for r in imatch.next_documents(keys).collect()}
    order = sorted(ids)
    assert got == {a: (b, b * 7) for a, b in zip(order, order[1:] + order[:1])}


@pytest.mark.parametrize("inner", [8, 16, 64])
def test_op3_recall_at_low_intrinsic_dimension(spark, inner):
    rng = np.random.default_rng(inner)
    a = rng.standard_normal((6000, inner))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    away = rng.standard_normal((2000, inner))
    away -= (away * a[:2000]).sum(axis=1, keepdims=True) * a[:2000]
    b = 0.951 * a[:2000] + np.sqrt(1 - 0.951**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    x = np.concatenate([a, b]) @ np.linalg.qr(rng.standard_normal((64, inner)))[0].T
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got = {r.vec_id: r for r in pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    links = np.array([got[i].n_links for i in range(len(x))])
    assert (links == link.sum(axis=1)).all()
