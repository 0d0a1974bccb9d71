"""SimHash near-duplicates with vantage-point trees (operator 9).

Each document gets a 64-bit fingerprint: a bit is set where more than half of
its word-shingle hashes have it. Fingerprints that differ in at most
``max_distance`` bits are linked.

Exact search. The bits are cut into ``BANDS`` bands; two linked fingerprints
differ in at most ``max_distance // BANDS`` bits in some band, so a search
with that small radius in every band finds every link. Each band has a
vantage-point tree over Hamming distance in the band, grown on a bounded
sample: its leaves are the shards. A fingerprint lives in one shard of a band
and is also sent, as a query, to every shard that the triangle inequality
cannot rule out. Inside a shard the tree is grown further over all rows, and
the pairs that reach a leaf are compared over all 64 bits. (One tree over the
full distance prunes badly: random fingerprints lie 28 to 36 bits from any
vantage point, so a radius of 4 overlaps most shards.)

A shard returns a spanning forest of its links, never all pairs, so large
groups of near copies cost no more rows than they have members. A shard whose
points outgrow ``SHARD`` is split: its queries are dealt over several tasks
that hold the same points.

Defined results: a NULL or empty text has no words and fingerprint zero, which
links like any other; repeated rows give repeated result rows; documents with
a NULL id take part but cannot name a component; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import land, prepare
from boxstar.llm.graph import components, roots

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
BANDS = 3
SHARD = 20_000
#: Fingerprints sampled per leaf to grow the routing trees, and their largest number.
SAMPLE_PER_LEAF = 64
MAX_SAMPLE = 1_048_576
LEAF = 48
#: Fingerprints walked through the trees at once, and rows of a batch sent.
ROUTED = 32_768


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> bytes:
    """The fingerprint as 8 bytes, most significant first."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "replace").lower().split()  # ASCII case and ASCII white space only
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    n = len(words) - shingle_words + 1
    if n < 2:
        return xxh64_digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    stops = ends[shingle_words - 1 :].tolist()
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    hashes = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in zip(starts, stops)])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).tobytes()


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join([fingerprint(t.as_py(), shingle_words) for t in batch.column("text")])
            values = np.frombuffer(raw, dtype=">u8").astype(np.uint64).view(np.int64)
            keys = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(values)], names=[*keys, "fp"])

    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, row_key: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number, per input row;
    with ``row_key`` also ``row``, a hash of the whole row."""
    prepare(docs.sparkSession)
    keys = [F.col("doc_id").cast("long").alias("doc_id")]
    if row_key:
        keys.append(F.xxhash64(*[F.col(c) for c in docs.columns]).alias("row"))
    schema = "doc_id long, row long, fp long" if row_key else "doc_id long, fp long"
    return docs.select(*keys, F.col("text")).mapInArrow(_fingerprints(shingle_words), schema)


def band_masks(bands: int) -> list[np.uint64]:
    edges = [64 * i // bands for i in range(bands + 1)]
    return [np.uint64(((1 << (hi - lo)) - 1) << lo) for lo, hi in zip(edges, edges[1:])]


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def grow(sample: np.ndarray, mask: np.uint64, depth: int) -> list[tuple[int, np.uint64, int]]:
    """Routing tree on a sample: (node, vantage point, radius) in heap order from node 1."""
    tree: list[tuple[int, np.uint64, int]] = []
    level = {1: sample & mask}
    for _ in range(depth):
        below = {}
        for node, points in level.items():
            if len(points) == 0:
                points = sample[:1] & mask
            vantage = points[0]
            d = np.sort(_distance(points, vantage))
            radius = int(d[(len(d) - 1) // 2])
            tree.append((node, vantage, radius))
            near = _distance(points, vantage) <= radius
            below[2 * node], below[2 * node + 1] = points[near], points[~near]
        level = below
    return tree


def walk(tree: dict[int, tuple[np.uint64, int]], values: np.ndarray, mask: np.uint64, reach: int) -> dict[int, np.ndarray]:
    """Leaf -> indices of the values whose ball of radius ``reach`` may touch it.
    Only nodes that some value reaches are visited."""
    leaves, todo = {}, [(1, np.arange(len(values)))]
    while todo:
        node, here = todo.pop()
        if not len(here):
            continue
        if node not in tree:
            leaves[node] = here
            continue
        vantage, radius = tree[node]
        d = _distance(values[here] & mask, vantage)
        todo += [(2 * node, here[d - reach <= radius]), (2 * node + 1, here[d + reach > radius])]
    return leaves


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``ROUTED`` rows or more: the session's batches are
    small for the sake of texts, and a walk over few fingerprints costs as many nodes."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= ROUTED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _counted(trees, masks):
    """Distinct fingerprints -> one row per shard and task: (shard, fingerprints at home there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rooms = [{node: (vantage, radius) for node, vantage, radius in tree} for tree in trees]
        counts: dict[int, int] = {}
        for batch in _gathered(batches):
            values = batch.column(0).to_numpy().view(np.uint64)
            for band, (tree, mask) in enumerate(zip(rooms, masks)):
                for leaf, who in walk(tree, values, mask, 0).items():
                    shard = (band << 40) + (leaf << 16)
                    counts[shard] = counts.get(shard, 0) + len(who)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["shard", "n"]
        )

    return run


def _route(trees, masks, reach: int, splits: dict[tuple[int, int], int]):
    """Distinct fingerprints -> rows (shard, fp, home, asks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rooms = [{node: (vantage, radius) for node, vantage, radius in tree} for tree in trees]
        for batch in _gathered(batches):
            values = batch.column(0).to_numpy().view(np.uint64)
            for band, (tree, mask) in enumerate(zip(rooms, masks)):
                home = np.zeros(len(values), dtype=np.int64)
                for leaf, who in walk(tree, values, mask, 0).items():
                    home[who] = leaf
                cols = []
                for leaf, who in walk(tree, values, mask, reach).items():
                    is_home = home[who] == leaf
                    n = splits.get((band, leaf), 1)
                    part = values[who] % np.uint64(n)
                    shard = (band << 40) + (leaf << 16)
                    cols.append((shard + part.astype(np.int64), values[who], is_home, np.ones(len(who), dtype=bool)))
                    # the shard's points go to all of its parts; a part asks for its own rows only
                    for k in range(n) if n > 1 else ():
                        copy = is_home & (part != k)
                        cols.append((np.full(copy.sum(), shard + k), values[who][copy], np.ones(copy.sum(), bool), np.zeros(copy.sum(), bool)))
                s, v, h, q = (np.concatenate(c) for c in zip(*cols))
                for i in range(0, len(s), ROUTED):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[i : i + ROUTED]) for c in (s, v.view(np.int64), h, q)], names=["shard", "fp", "home", "asks"]
                    )

    return run


def shard_links(values: np.ndarray, home: np.ndarray, asks: np.ndarray, mask: np.uint64, reach: int, limit: int) -> np.ndarray:
    """Component roots (indices) over the links between asking rows and home points."""
    label = np.arange(len(values))
    found: list[np.ndarray] = []
    held = 0

    def settle() -> None:
        nonlocal held, label
        if found:
            pairs = np.concatenate(found)
            label = roots(len(values), np.concatenate([np.arange(len(values)), pairs[:, 0]]), np.concatenate([label, pairs[:, 1]]))
            found.clear()
            held = 0

    def compare(points: np.ndarray, queries: np.ndarray) -> None:
        nonlocal held
        step = max(1, 2_000_000 // max(1, len(points)))
        for i in range(0, len(queries), step):
            q = queries[i : i + step]
            near = _distance(values[q][:, None], values[points][None, :]) <= limit
            x, y = np.nonzero(near)
            x, y = q[x], points[y]
            new = label[x] != label[y]
            if new.any():
                found.append(np.stack([x[new], y[new]], axis=1))
                held += int(new.sum())
                if held > 500_000:
                    settle()

    # (points, queries, mask, reach): first by the band, then by all bits where a band cannot be cut
    todo = [(np.flatnonzero(home), np.flatnonzero(asks), mask, reach)]
    while todo:
        points, queries, over, radius = todo.pop()
        if not len(points) or not len(queries):
            continue
        if len(points) <= LEAF:
            compare(points, queries)
            continue
        vantage = values[points[0]] & over
        d = _distance(values[points] & over, vantage)
        cut = int(np.sort(d)[(len(d) - 1) // 2])
        if cut >= d.max():
            cut = int(d.max()) - 1
        if cut < 0:
            if over == np.uint64(2**64 - 1):
                compare(points, queries)
            else:
                todo.append((points, queries, np.uint64(2**64 - 1), limit))
            continue
        dq = _distance(values[queries] & over, vantage)
        todo.append((points[d <= cut], queries[dq - radius <= cut], over, radius))
        todo.append((points[d > cut], queries[dq + radius > cut], over, radius))
    settle()
    return label


def _search(masks, reach: int, limit: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        band = key[0].as_py() >> 40
        values = table["fp"].to_numpy().view(np.uint64)
        label = shard_links(values, table["home"].to_numpy(), table["asks"].to_numpy(), masks[band], reach, limit)
        linked = np.flatnonzero(label != np.arange(len(values)))
        return pa.table({"a": values[linked].view(np.int64), "b": values[label[linked]].view(np.int64)})

    return run


def fingerprint_links(fps: DataFrame, max_distance: int = MAX_DISTANCE, bands: int = BANDS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect
    exactly those components that all pairs within ``max_distance`` bits do."""
    spark = fps.sparkSession
    prepare(spark)
    distinct = land(fps.select("fp").where("fp IS NOT NULL").distinct(), "fingerprints")
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / shard))))
    sample_size = min(MAX_SAMPLE, SAMPLE_PER_LEAF << depth)
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(sample_size).select("fp").toArrow()  # 8 MB at most
    sample = np.array(sample["fp"].to_numpy() if len(sample) else [0], dtype=np.int64).view(np.uint64)
    masks = band_masks(bands)
    trees = [grow(sample, m, depth) for m in masks]
    reach = max_distance // bands
    schema = "shard long, fp long, home boolean, asks boolean"
    homes = distinct.mapInArrow(_counted(trees, masks), "shard long, n long")
    counts = homes.groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * shard).collect()  # shards over their size alone
    splits = {(r["shard"] >> 40, (r["shard"] >> 16) & 0xFFFFFF): -(-r["n"] // (2 * shard)) for r in counts}
    routed = distinct.mapInArrow(_route(trees, masks, reach, splits), schema)
    return routed.groupBy("shard").applyInArrow(_search(masks, reach, max_distance), "a long, b long")


def group_roots(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints``."""
    tree = components(fingerprint_links(prints, max_distance))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return distinct.join(tree.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    prints = land(fingerprints(docs, shingle_words), "doc_fingerprints")
    rooted = group_roots(prints, max_distance)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = land(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each group the
    row with the smallest doc_id (NULL last; ties: by a hash of the row) stays,
    and one of it where it is repeated."""
    prints = land(fingerprints(docs, shingle_words, row_key=True), "row_fingerprints")
    rooted = group_roots(prints, max_distance).select("fp", "root")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    per_print = prints.groupBy("fp").agg(F.min(first).alias("first"))  # copies meet before the join
    stays = per_print.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first"))
    repeated = prints.groupBy("row").count().where("count > 1").select("row")
    stays = land(stays.select(F.col("first.row").alias("row")).join(repeated.withColumn("many", F.lit(True)), "row", "left"), "stays")
    rows = docs.withColumn("_row", F.xxhash64(*[F.col(c) for c in docs.columns]))
    kept = rows.join(stays.withColumnRenamed("row", "_row"), "_row")
    once = kept.where("many IS NULL").select(*docs.columns)
    return once.unionByName(kept.where("many").dropDuplicates(["_row"]).select(*docs.columns))
