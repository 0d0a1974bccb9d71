"""Embedding near-duplicates by product quantisation (operator 3).

Equal vectors are one class first. Class vectors are scaled to length one; a
coarse quantiser (k-means) deals them into inverted lists, and each stores a
residual code: ``SUBSPACES`` table indices of one byte. The quantisers are
fitted on a bounded sample by hash order (four vectors a list, ``SAMPLE`` at
least and ``MAX_SAMPLE`` at most, ``FIT_BYTES`` in all); every vector is indexed.
There is a list for every ``LIST_SIZE`` vectors, ``MAX_LISTS`` at most, fewer where
the sample is bounded by its bytes.

Search. Let vectors x and y with a cosine of at least the one asked for, so at
a distance of at most ``reach``, have the lists i and j. x lies on i's side of
the plane between the two centroids, y on j's; their distances from it add up
to ``reach`` at most, so one of them lies within half of it. A vector therefore
asks every list whose plane against its own list is no further than
``reach / 2``: no link is lost, whatever the data and the sample (the tests
compare with all pairs). A link that only one side finds is counted for both.
In a list, distances from the query to all codes are taken (asymmetric: the query
itself, the others as coded), as products with the decoded vectors. Each vector
also carries the length of its own coding error, so a code is passed over only
where the triangle inequality rules the link out. What is left is decided by the
exact cosine in double precision.

Vectors are sent once: the lists, in the order of their numbers, are packed into tiles of at
most ``TILE`` vectors and about ``TILE_BYTES``, one row each, written once; a list of
any size is spread over as many tiles as it needs. Every pair of tiles meets in a
cartesian product that reads the written tiles and shuffles nothing; there the
vectors of each ask the lists of the other. A pair of tiles returns link counts and a
spanning forest, not pairs.

Defined results: vectors that are NULL, empty, zero, or hold NULL or
non-finite components link with nothing and are their own component; vectors
of different lengths never link; repeated rows count as vectors of their own
(equal copies link each other, with cosine 1); an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstar.llm.common import land, prepare
from boxstar.llm.graph import components, roots
from boxstar.session import Scratch

COSINE = 0.95
#: Slack on distances from a plane, for rounding.
SLACK = 1e-6
LIST_SIZE = 64
SAMPLE = 16_384
MAX_SAMPLE = 65_536
#: The sample on the driver, in single precision.
FIT_BYTES = 64 << 20
SUBSPACES = 16
CODES = 256
#: Vectors of a list, and vectors that ask it, compared at once.
BLOCK = 2_048
ASKERS = 4_096
MAX_LISTS = 16_384
ROUNDS = 6
#: Products of vectors and centroids held at once: of all lists, and of two tiles.
CELLS = 4_194_304
TILE_CELLS = 524_288
#: A tile: vectors and bytes of vectors at most; tables of over FEW vectors have several (MIN_TILES at most for this).
TILE = 12_288
TILE_BYTES = 3 << 20
FEW = 1_024
MIN_TILES = 16
#: Tiles that a task keeps.
HELD = 3
#: Parts of one side of the product of tiles.
SIDE = 16
#: Links handled at once.
PAIRS = 65_536


class Quantiser:
    """Coarse centroids (length one) and, per subspace, a table of residual codewords."""

    def __init__(self, centroids: np.ndarray, tables: np.ndarray, edges: list[int]):
        self.centroids, self.tables, self.edges = centroids, tables, edges

    def homes(self, x: np.ndarray) -> np.ndarray:
        """Each vector's own list."""
        return _largest(x.astype(np.float32, copy=False), self.centroids)

    def planes(self, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Distance of each centroid in ``own`` from those in ``other``."""
        a, b = self.centroids[own].astype(np.float64), self.centroids[other].astype(np.float64)
        square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
        return np.sqrt(np.maximum(square, 0))

    def asks(self, x: np.ndarray, own: np.ndarray, lists: np.ndarray, reach: float) -> np.ndarray:
        """Per list of ``lists`` the vectors of ``x`` (single precision, of the lists ``own``) that ask it, as bits."""
        there, here = self.centroids[lists], np.einsum("ij,ij->i", x, self.centroids[own])
        bits = np.empty((len(lists), -(-len(x) // 8)), dtype=np.uint8)
        step = max(8, TILE_CELLS // max(1, len(lists)) // 8 * 8)
        for i in range(0, len(x), step):
            mine, place = np.unique(own[i : i + step], return_inverse=True)
            near = (reach / 2 * self.planes(lists, mine) + _slack(x.shape[1])).astype(np.float32)[:, place]
            near += there @ x[i : i + step].T
            bits[:, i // 8 : (i + step) // 8] = np.packbits(near >= here[i : i + step], axis=1)
        return bits

    def asked(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each vector's own list, and pairs (row, list) of a vector and a list that it asks."""
        x = x.astype(np.float32)
        own = self.homes(x)
        bits = self.asks(x, own, np.arange(len(self.centroids)), reach)
        at, row = np.nonzero(np.unpackbits(bits, axis=1, count=len(x)))
        return own, row, at

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they miss."""
        codes = np.empty((len(residual), len(self.tables)), dtype=np.uint8)
        missed = np.zeros(len(residual))
        for s, table in enumerate(self.tables):
            part = residual[:, self.edges[s] : self.edges[s + 1]]
            words = table.astype(np.float32)
            codes[:, s] = _largest(part.astype(np.float32), words, 0.5 * (words**2).sum(axis=1))
            missed += ((part - table[codes[:, s]]) ** 2).sum(axis=1)
        return codes, np.sqrt(missed)

    def decode(self, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes of vectors of the lists ``own`` stand for, in single precision."""
        x = self.centroids[own]
        for s, table in enumerate(self.tables):
            x[:, self.edges[s] : self.edges[s + 1]] += table.astype(np.float32)[codes[:, s]]
        return x


def _slack(dim: int) -> float:
    """More than a product of two vectors of about length one can be off in single precision, twice."""
    return SLACK + dim * 2.5e-7


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are first scaled by a power of two, which is exact, so that no square
    of a very small or large component underflows or overflows."""
    _, size = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))
    x = np.ldexp(x, -size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _largest(x: np.ndarray, centres: np.ndarray, less: np.ndarray | None = None) -> np.ndarray:
    """Per row of ``x`` the centre with the largest product (less ``less``); ``CELLS`` products at a time."""
    near = np.empty(len(x), dtype=np.int64)
    step = max(1, CELLS // len(centres))
    for i in range(0, len(x), step):
        products = x[i : i + step] @ centres.T
        if less is not None:
            products -= less
        near[i : i + step] = products.argmax(axis=1)
    return near


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int, unit: bool) -> np.ndarray:
    x = x.astype(np.float32, copy=False)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _largest(x, centres, 0.5 * (centres**2).sum(axis=1))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
        if unit:
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float64)


def fit(sample: np.ndarray, lists: int, seed: int = 7) -> Quantiser:
    """Coarse and residual quantisers from sample vectors of length one."""
    rng = np.random.default_rng(seed)
    centroids = _kmeans(sample, lists, rng, ROUNDS, unit=True)
    dim = sample.shape[1]
    spaces = min(SUBSPACES, dim)
    edges = [dim * i // spaces for i in range(spaces + 1)]
    few = sample[: 8 * CODES]  # of the others no residual is read
    few = few - centroids[_largest(few, centroids)]
    centroids = centroids.astype(np.float32)
    tables = []
    for a, b in zip(edges, edges[1:]):
        t = _kmeans(few[:, a:b], CODES, rng, ROUNDS, unit=False)
        tables.append(np.concatenate([t, np.repeat(t[:1], CODES - len(t), axis=0)]))
    return Quantiser(centroids, np.stack(tables) if len({t.shape for t in tables}) == 1 else tables, edges)


def _unit(batch_column: pa.Array, dim: int) -> np.ndarray:
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(-1, dim)
    return unit_rows(x)


def _reach(cosine: float) -> float:
    """Distance of two vectors of length one at this cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def _counted(q: Quantiser, dim: int):
    """Class vectors -> one row per list and task: (list, vectors in it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes = np.zeros(len(q.centroids), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                homes += np.bincount(q.homes(_unit(b.column(2), dim)), minlength=len(homes))
        some = np.flatnonzero(homes)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(homes[some])], names=["list", "n"])

    return run


def _packed(x: np.ndarray) -> pa.Array:
    """One binary value per row."""
    data = np.ascontiguousarray(x)
    ends = np.arange(len(data) + 1, dtype=np.int32) * np.int32(data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _unpacked(column: pa.ChunkedArray, kind: str, dim: int) -> np.ndarray:
    """The rows that ``_packed`` wrote."""
    wide = np.dtype(kind).itemsize * dim
    parts = [np.frombuffer(c.buffers()[2], dtype=np.uint8)[: (c.offset + len(c)) * wide][c.offset * wide :] for c in column.chunks if len(c)]
    return np.concatenate(parts).view(kind).reshape(-1, dim)


def _dealt(q: Quantiser, dim: int, kind: str, sizes: np.ndarray, rows: int):
    """Class vectors -> (tile, list, node, copies, missed, codes, vector); lists lie one after the other
    and are cut every ``rows`` vectors; a vector takes a place of its list by its hash.
    Vectors travel in the precision that the table has."""
    first, some = np.cumsum(sizes) - sizes, np.maximum(sizes, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            node = b.column(0).to_numpy()
            raw = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(kind)
            x = _unit(b.column(2), dim)
            own = q.homes(x)
            codes, missed = q.encode(x - q.centroids[own])
            spread = ((node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((first[own] + spread % some[own]) // rows), pa.array(own.astype(np.int32)), b.column(0), b.column(1),
                    pa.array(missed.astype(np.float32)), _packed(codes), _packed(raw),
                ],
                names=["tile", "list", "node", "copies", "missed", "codes", "vector"],
            )

    return run


#: A tile row: its vectors one after the other, by list.
TILE_ROW = "tile long, list binary, node binary, copies binary, missed binary, codes binary, vector binary"


def _tiled(dim: int, kind: str, spaces: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table["list"].to_numpy(), kind="stable")
        parts = {c: table[c].to_numpy() for c in ("list", "node", "copies", "missed")}
        parts |= {"codes": _unpacked(table["codes"], "u1", spaces), "vector": _unpacked(table["vector"], kind, dim)}
        return pa.table({"tile": [key[0].as_py()]} | {c: pa.array([v[order].tobytes()], pa.binary()) for c, v in parts.items()})

    return run


class Tile:
    """A tile in memory. ``x``: its vectors in single precision; ``coded``: what their codes stand for;
    ``least``: a product with ``coded`` under this rules a link out."""

    def __init__(self, q: Quantiser, dim: int, kind: str, reach: float, columns: dict[str, pa.Buffer]):
        own, node, copies = (np.frombuffer(columns[c], t) for c, t in (("list", "<i4"), ("node", "<i8"), ("copies", "<i8")))
        self.own, self.node, self.copies = own.copy(), node.copy(), copies.copy()  # the batch can go
        self.raw, self.exact = np.frombuffer(columns["vector"], kind).reshape(-1, dim).copy(), None
        self.x = np.empty(self.raw.shape, dtype=np.float32)
        for i in range(0, len(self.x), BLOCK):
            self.x[i : i + BLOCK] = unit_rows(self.raw[i : i + BLOCK].astype(np.float64))
        self.coded = q.decode(self.own, np.frombuffer(columns["codes"], "u1").reshape(len(self.own), -1))
        far = np.frombuffer(columns["missed"], "<f4").astype(np.float64) + reach
        self.least = ((1 + np.einsum("ij,ij->i", self.coded, self.coded) - far**2) / 2 - _slack(dim)).astype(np.float32)
        self.lists, self.first, self.place = np.unique(self.own, return_index=True, return_inverse=True)
        self.last = np.append(self.first[1:], len(self.own))

    def unit(self, rows: np.ndarray) -> np.ndarray:
        """Vectors of length one in double precision; where many are asked for, all are kept."""
        if self.exact is None and 4 * len(rows) > len(self.raw):
            self.exact = unit_rows(self.raw.astype(np.float64))
        return unit_rows(self.raw[rows].astype(np.float64)) if self.exact is None else self.exact[rows]


def _found(asker: Tile, point: Tile, asks: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from vectors of one tile to vectors of the lists of the other that they ask."""
    for bits, first, last in zip(asks, point.first, point.last):
        if not bits.any():
            continue
        asking = np.flatnonzero(np.unpackbits(bits, count=len(asker.own)).view(bool))
        for i in range(0, len(asking), ASKERS):
            part = asking[i : i + ASKERS]
            x = asker.x[part]
            for k in range(first, last, BLOCK):
                end = min(last, k + BLOCK)
                hits = np.flatnonzero(x @ point.coded[k:end].T >= point.least[k:end])
                for h in range(0, len(hits), PAIRS):
                    m, p = np.divmod(hits[h : h + PAIRS], end - k)
                    m, p = part[m], p + k
                    good = np.einsum("ij,ij->i", asker.unit(m), point.unit(p)) >= cosine
                    if asker is point:
                        good &= m != p
                    if good.any():
                        yield m[good], p[good]


class Forest:
    """Components of links that come bit by bit; no more than ``PAIRS`` of them are kept, and a batch."""

    def __init__(self, n: int):
        self.label, self.waiting, self.kept = np.arange(n), [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        new = a != b
        if new.any():
            self.waiting.append((a[new], b[new]))
            self.kept += int(new.sum())
            if self.kept >= PAIRS:
                self.fold()

    def fold(self) -> np.ndarray:
        """Per element one of its component."""
        if self.waiting:
            a, b = (np.concatenate(side) for side in zip(*self.waiting))
            self.label = roots(len(self.label), a, b)[self.label]
            self.waiting, self.kept = [], 0
        return self.label


def _compared(q: Quantiser, dim: int, kind: str, cosine: float):
    """Pairs of tiles -> (node, links, root) of the vectors with links in the pair."""
    reach = _reach(cosine)

    def links_of(a: Tile, b: Tile) -> pa.RecordBatch | None:
        node, copies = (getattr(a, c) if a is b else np.concatenate([getattr(a, c), getattr(b, c)]) for c in ("node", "copies"))
        ab = q.asks(a.x, a.own, b.lists, reach)
        ba = ab if a is b else q.asks(b.x, b.own, a.lists, reach)
        turns = [(a, b, ab, ba, 0, 0)] if a is b else [(a, b, ab, ba, 0, len(a.own)), (b, a, ba, ab, len(a.own), 0)]
        links, forest = np.zeros(len(node), dtype=np.int64), Forest(len(node))
        for asker, point, asks, back, i, j in turns:
            for m, p in _found(asker, point, asks, cosine):
                # a partner that does not ask the asker's own list gets its count here
                blind = back[asker.place[m], p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1 == 0
                m, p = m + i, p + j
                np.add.at(links, m, copies[p])
                np.add.at(links, p[blind], copies[m[blind]])
                forest.add(m, p)
        some = np.flatnonzero(links)
        if not len(some):
            return None
        label = forest.fold()[some]
        least = np.full(len(node), np.iinfo(np.int64).max)
        np.minimum.at(least, label, node[some])
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(least[label])], names=["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in TILE_ROW.split(", ")]
        held: dict[int, Tile] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                row = [batch.column(c)[r] for c in range(batch.num_columns)]
                pair = []
                for half in (row[: len(names)], row[len(names) :]):
                    key = half[0].as_py()
                    tile = held.pop(key, None) or Tile(q, dim, kind, reach, {c: v.as_buffer() for c, v in zip(names[1:], half[1:])})
                    held[key] = tile
                    pair.append(tile)
                while len(held) > HELD:  # the one that was not used for longest goes
                    del held[next(iter(held))]
                out = links_of(*pair)
                if out is not None:
                    yield out

    return run


def _pairs_of_tiles(tiles: DataFrame) -> DataFrame:
    """Every two tiles once, and each with itself. Which of two stands on the left goes by turns, so
    that the parts of the product have equal shares."""
    a, b = (tiles.select(*(F.col(c).alias(f"{side}_{c}") for c in tiles.columns)) for side in "ab")
    left, right = F.col("a_tile"), F.col("b_tile")
    even = (left + right) % 2 == 0
    return a.coalesce(SIDE).crossJoin(b.hint("shuffle_replicate_nl")).where((left == right) | ((left < right) & even) | ((left > right) & ~even))


@contextmanager
def _rows_one_by_one(spark: SparkSession) -> Iterator[None]:
    """A row of the plans inside is an Arrow batch of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    former = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, former)


def _sample(own: DataFrame, n: int, most: int, dim: int) -> np.ndarray:
    """The ``most`` vectors with the smallest hashes, of length one in single precision."""
    share = (most + 6 * most**0.5 + 64) / n  # hashes are spread evenly: so many are under the bound, all but surely
    some = own.where(F.col("node") <= int(-(2**63) + share * 2**64)) if share < 1 else own
    picked = some.orderBy("node").limit(most).select("embedding").toArrow()
    return np.concatenate([_unit(b.column(0), dim).astype(np.float32) for b in picked.to_batches() if b.num_rows])


def _valid() -> F.Column:
    v = F.col("embedding")
    whole = ~F.array_contains(v, F.lit(float("nan")))  # NULL where a component is
    least, most = F.array_min(v), F.array_max(v)
    return F.coalesce(whole & (least > float("-inf")) & (most < float("inf")) & ((least != 0) | (most != 0)), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """Per row of (vec_id, embedding): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    prepare(spark)
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    kind, item = ("<f4", "float") if single else ("<f8", "double")
    plain = F.transform("embedding", lambda c: (c + F.lit(0.0)).cast(item))  # without negative zeros
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{item}>"))
    good = rows.where(_valid()).select("vec_id", plain.alias("embedding"))
    # one row per distinct vector; the key is its hash
    classes = land(
        good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.xxhash64("embedding")),
        "vector_classes",
    )
    found = None
    dims = [r[0] for r in classes.groupBy(F.size("embedding").alias("dim")).count().orderBy("dim").collect()]
    for dim in dims:  # in practice one
        own = classes.where(F.size("embedding") == dim).select("node", "copies", "embedding")
        n = own.count()
        most = max(1, FIT_BYTES // (4 * dim))
        lists = int(min(MAX_LISTS, max(1, n // LIST_SIZE), max(1, most // 4)))
        q = fit(_sample(own, n, min(most, MAX_SAMPLE, max(sample, 4 * lists)), dim), lists)
        counted = own.mapInArrow(_counted(q, dim), "list long, n long")
        counts = counted.groupBy("list").agg(F.sum("n").alias("n")).toArrow()  # one row per list
        sizes = np.zeros(len(q.centroids), dtype=np.int64)
        sizes[counts["list"].to_numpy()] = counts["n"].to_numpy()
        most = max(1, min(TILE, TILE_BYTES // (np.dtype(kind).itemsize * dim)))
        cut = max(-(-n // most), min(MIN_TILES, -(-n // FEW)))
        dealt = own.mapInArrow(
            _dealt(q, dim, kind, sizes, -(-n // cut)),
            "tile long, list int, node long, copies long, missed float, codes binary, vector binary",
        )
        scratch = Scratch()
        with scratch.active():
            tiles = land(dealt.repartition(cut, "tile").groupBy("tile").applyInArrow(_tiled(dim, kind, len(q.tables)), TILE_ROW), "vector_tiles")
        try:
            with _rows_one_by_one(spark):
                part = land(_pairs_of_tiles(tiles).mapInArrow(_compared(q, dim, kind, cosine), "node long, links long, root long"), "vector_links")
        finally:
            scratch.close()
        found = part if found is None else found.unionByName(part)
    if found is None:
        named = spark.createDataFrame([], "node long, others long, component_id long")
    else:
        others = found.groupBy("node").agg(F.sum("links").alias("others"))
        tree = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        keys = classes.select("node", "least", "copies")  # vectors are not moved again
        joined = keys.join(others, "node", "left").join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
        named = joined.join(least, "root").select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("others"), "component_id")
    # back to the rows by class hash: short keys, and hot classes are split by the skew join
    labelled = rows.select("vec_id", F.when(_valid(), F.xxhash64(plain)).alias("node"))
    return labelled.join(named, "node", "left").select(
        "vec_id",
        F.coalesce("others", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
