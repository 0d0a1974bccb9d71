"""Fill-in-middle, filter audit and Hilbert sharding."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations, product

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxstar.llm import filteraudit, fim, hilbert
from boxstar.llm.registered import op11_fill_in_middle, op12_filter_audit, op13_sharding

from .conftest import SF, awkward_texts

# -- fill-in-middle -------------------------------------------------------------------------

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
HARD = ["", " ", "a", "é", "🙂", "a é\t日本 🙂🙂 z  ", "  é", "x" * 50 + "é" + "y" * 50, "\x0b\x0c a\x1cb\x85c\xa0d e", "é🙂" * 30 + " end"]


def brute_fim(doc, text, unit="token", seed=42, rate=50, spm_rate=80):
    text = text or ""
    units = TOKENS.findall(text) if unit == "token" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def digests(row, text):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (*row[:5], sha(row[5]), sha(text or ""))


def order(rows):
    return sorted(rows, key=repr)


@given(st.text(alphabet=st.sampled_from("ab é日🙂\t\n<>PSM"), max_size=60), st.integers(0, 5000))
@settings(max_examples=300, deadline=None)
def test_exceptions_convert_both_ways(text, pick):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    index = fim.Exceptions(data)
    chars = np.arange(len(text) + 1)
    want = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == want).all() and (index.to_chars(want) == chars).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # ASCII leaves no entry
    for unit in ("token", "char"):
        out = fim.transform([pick], pa.array([text]), rate=100, unit=unit)
        doc, n, form, prefix, middle, output = brute_fim(pick, text, unit, rate=100)
        assert [out[k][0].as_py() for k in ("n", "form", "prefix_chars", "middle_chars", "output")] == [n, form, prefix, middle, output.encode()]


def test_a_batch_of_texts_is_cut_as_each_of_them():
    ids = list(range(len(HARD) * 40))
    texts = [HARD[i % len(HARD)] for i in ids]
    whole = pa.array(texts)
    for sliced in (whole, whole.slice(3, 200)):
        names = ids[3:203] if len(sliced) == 200 else ids
        out = fim.transform(names, sliced)
        for k, (i, t) in enumerate(zip(names, sliced.to_pylist())):
            want = brute_fim(i, t)
            assert (out["n"][k].as_py(), out["form"][k].as_py(), out["prefix_chars"][k].as_py(), out["output"][k].as_py().decode()) == (
                want[1], want[2], want[3], want[5])
            if want[2] != "plain":
                prefix = t[: want[3]]
                assert out["prefix_bytes"][k].as_py() == len(prefix.encode())
                assert out["middle_bytes"][k].as_py() == len(t[want[3] : want[3] + want[4]].encode())


def test_op11_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = op11_fill_in_middle(spark, SF)
    assert order(tuple(r) for r in got.collect()) == order(digests(brute_fim(i, t), t) for i, t in rows)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_op11_awkward(spark, awkward, no_docs):
    more = [(100 + k, t) for k, t in enumerate(["has <P> inside", "has <S> inside", "<M>", "ends in <", "<P", "S> a <S b M>", *HARD])]
    docs = awkward.select("doc_id", "text", "source", "n_tokens").unionByName(
        spark.createDataFrame([(i, t, None, None) for i, t in more], "doc_id long, text string, source string, n_tokens string"))
    got = order(tuple(r) for r in fim.transform_documents(docs).collect())
    assert got == order(digests(brute_fim(i, t), t) for i, t in [*awkward_texts(), *more])
    whole = fim.fill_in_middle(docs, rate=100).select("*", fim.restored(F.col("form"), F.col("output")).alias("back")).collect()
    assert order((r.doc_id, r.back) for r in whole) == order((i, t or "") for i, t in [*awkward_texts(), *more])
    assert fim.transform_documents(no_docs).collect() == []
    with pytest.raises(ValueError):
        fim.transform([1], pa.array(["a"]), unit="word")


# -- filter audit ---------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_failures(text):
    words = WORD.findall(text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    return out


def brute_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = []
    for i, t, s in docs:
        t = t or ""
        failed = brute_failures(t) | ({"E"} if i is not None and i > first[t] else set())
        mine = [x for x in labels if i is not None and x[0] == i]
        rows.append((s or "", failed, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, total = {}, Counter()
    for order_ in permutations("ABCDE"):
        for step, f in enumerate(order_, 1):
            for part in {r[0] for r in rows}:
                out[part, "".join(order_), step] = [0] * 7
        for part, failed, good, toxic in rows:
            gone = False
            for step, f in enumerate(order_, 1):
                cell = out[part, "".join(order_), step]
                if f in failed:
                    if gone:
                        cell[2] += 1
                    else:
                        cell[1] += 1
                        cell[4] += good
                        cell[5] += toxic
                        total[part, f] += 1
                        gone = True
                    cell[3] += failed == {f}
                cell[0] += not gone
    for (part, o, step), cell in out.items():
        cell[6] = total[part, o[step - 1]]
    return sorted((part, o, step, *cell) for (part, o, step), cell in out.items())


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_carry_save_counts_positions(batches):
    counter = filteraudit.Counter()
    for b in batches:
        counter.add(np.array(b, dtype=np.uint32))
    words = [w for b in batches for w in b]
    assert counter.counts() == [sum(w >> s & 1 for w in words) for s in range(32)]
    assert all(len(plane) <= 2 for plane in counter.planes)


def test_survival_words():
    for failed in range(32):
        for subset in range(32):
            assert bool(int(filteraudit.WORDS[failed]) >> subset & 1) == (failed & subset == 0)


@given(st.text(alphabet=st.sampled_from("ab AZé\t\x0b\x1c\x85🙂#|"), max_size=400), st.integers(1, 60))
@settings(max_examples=300, deadline=None)
def test_text_failures(text, times):
    text = text * times
    got = filteraudit.text_failures(text.encode())
    assert {f for k, f in enumerate("ABCDE") if got >> k & 1} == brute_failures(text)


def test_op12_whole_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet'").fetchall()
    got = op12_filter_audit(spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(docs, labels)


def test_op12_awkward(spark, no_docs, monkeypatch):
    rng = random.Random(4)
    rich = " ".join(f"w{i}" for i in range(250))
    texts = [t for _, t in awkward_texts()] + [rich, rich + " #", "LOUD " * 300, None, ""]
    docs = [(i, t, rng.choice(["s", "t", None, ""])) for i, t in awkward_texts()]
    docs += [(rng.choice([None, *range(20, 60)]), rng.choice(texts), rng.choice(["s", "t", None])) for _ in range(120)]
    docs += [(70 + k, rich, "hot") for k in range(100)] + [(70, rich, "hot")] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(20, 120), *range(30, 50), None, 999]]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, failed int, part string").repartition(5)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = brute_audit(docs, labels)
    assert sorted(tuple(r) for r in filteraudit.audit_documents(df, told).collect()) == want
    got = filteraudit.survivors(df, told).collect()
    assert {r.everything for r in got if r.part == "hot" and r.subset == 0} == {103}
    assert filteraudit.audit_documents(no_docs, told).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in filteraudit.audit_documents(df, none).collect()) == brute_audit(docs, [])


# -- sharding -------------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_the_curve_walks_to_neighbours(spark, dims, bits):
    names = [f"c{k}" for k in range(dims)]
    cells = list(product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    rows = sorted(hilbert.hilbert_index(df, names, bits, "i").collect(), key=lambda r: r["i"])
    assert [r["i"] for r in rows] == list(range(len(cells)))  # every cell once
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[n] - b[n]) for n in names) == 1
    with pytest.raises(ValueError):
        hilbert.hilbert_index(df, names, 63, "i")


def brute_cells(values, bits):
    """Cell of each distinct value by exact rank."""
    count, before, out = Counter(values), 0, {}
    for v in sorted(count):
        out[v] = before * (1 << bits) // len(values)
        before += count[v]
    return out


def brute_walk(point, bits):
    """Index of a point by recursive halving: the same rules, on single numbers."""
    n = len(point)
    inverse, entry, axis = hilbert.curve_rules(n)
    start = turn = index = 0
    for level in reversed(range(bits)):
        corner = [point[k] >> level & 1 ^ start >> k & 1 for k in range(n)]
        seen = sum(corner[(k + turn + 1) % n] << k for k in range(n))
        w = inverse[seen]
        index = index << n | w
        start ^= sum((entry[w] >> k & 1) << (k + turn + 1) % n for k in range(n))
        turn = (turn + axis[w] + 1) % n
    return index


def brute_shards(docs, shards=24, bits=5):
    keys = []
    for i, t, source, lang in docs:
        raw = (t or "").encode()
        keys.append((i, len(raw) + 8, zlib.crc32(raw), source, lang))
    ids = [k[0] for k in keys if k[0] is not None]
    low, width = min(ids), max(float(max(ids) - min(ids)), 1.0)
    step = lambda i: 0 if i is None else int((i - low) / width * 65536) + 1
    log = lambda s: int(np.floor(np.log2(s) * 64))
    axes = [[k[3] or "" for k in keys], [k[4] or "" for k in keys], [log(k[1]) for k in keys], [step(k[0]) for k in keys]]
    cells = [brute_cells(a, bits) for a in axes]
    points = [tuple(c[a[r]] for c, a in zip(cells, axes)) for r in range(len(keys))]
    nulls_first = lambda *v: tuple((x is not None, x if x is not None else 0) for x in v)
    ranked = sorted(range(len(keys)), key=lambda r: (brute_walk(points[r], bits), nulls_first(keys[r][3], keys[r][4], keys[r][1], keys[r][0], keys[r][2])))
    out, n = [], len(keys)
    for rank, r in enumerate(ranked):
        shard = rank * shards // n
        first = next(x for x in range(n) if x * shards // n == shard)
        out.append((*keys[r][:3], "rows", shard, rank - first, None))
    return order(out)


def check_law(rows, n, shards=24):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(len(v) for v in by.values()) == n and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, ())) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_op13_whole_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SF}/documents.parquet'").fetchall()
    rows = op13_sharding(spark, SF).collect()
    check_law(rows, len(docs))
    assert order(tuple(r) for r in rows) == brute_shards(docs)


def test_op13_awkward_and_hot(spark, awkward, no_docs):
    check_law(hilbert.shard_documents(awkward).collect(), len(awkward_texts()))
    same = [(7, "the same text", "hot", "en")] * 400
    docs = same + [(i, f"text {i} " + "é" * (i % 40), None if i % 9 == 0 else f"s{i % 5}", "en") for i in range(800)] + [(None, None, None, None)] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(4)
    rows = hilbert.shard_documents(df).collect()
    check_law(rows, len(docs))
    assert order(tuple(r) for r in rows) == brute_shards(docs)
    assert len({r["shard"] for r in rows if r["doc_id"] == 7}) >= 7  # the hot row is split over shards
    assert hilbert.shard_documents(no_docs).collect() == []
    few = spark.createDataFrame(docs[:5], df.schema)
    check_law(hilbert.shard_documents(few).collect(), 5)


def test_written_shards_prune_files(spark, tmp_path):
    rng = random.Random(1)
    docs = [(i, "x" * rng.randint(1, 4000), f"s{rng.randrange(8)}", rng.choice(["en", "de"]), "old") for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, shard string")
    ranges = hilbert.write_shards(df, f"{tmp_path}/out", shards=64).cache()
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 4000 and back.select("doc_id", "text").exceptAll(df.select("doc_id", "text")).count() == 0
    check_law(back.select("shard", "slot").collect(), 4000, 64)
    for wanted in ({"source": ("s3", "s3")}, {"doc_id": (100, 300)}, {"size": (3500, 4000)}, {"source": ("s1", "s1"), "doc_id": (0, 500)}):
        asked = {r.shard for r in hilbert.shards_for(ranges, wanted).collect()}
        hit = back
        for c, (low, high) in wanted.items():
            hit = hit.where(F.col(c).between(low, high))
        assert {r.shard for r in hit.select("shard").distinct().collect()} <= asked and len(asked) <= 40
