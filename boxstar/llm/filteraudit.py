"""Filter interaction audit by truth-table survival words.

Five filters, A to E, are judged for every document once, whatever the order in which
they would be applied. What a document fails gives its 32-bit word: bit ``S`` is set if the
document survives the subset ``S`` of the filters (bit 0 of ``S`` is A). Summing the words'
bits one by one is a positional popcount; it is done with carry-save adders, which
turn three words of one weight into a sum of that weight and a carry of twice the
weight, 32 positions at a time, until at most two words of each weight are left.
From the 32 survivor counts of a part follow all figures of all 120 orders.

* Kept after step k: survivors of the first k filters of the order; removed: the
  difference to the step before. Redundant: all that fail the filter less those removed here.
* Unique fails: survivors of the other four less survivors of all five.
* ``shapley``: a filter meets each subset of the others in |S|! (4 - |S|)! orders.

Jobs: one pass over the texts (mapInArrow) leaves narrow rows (id, part, failures,
SHA-256), written to the shared folder. The smallest id of each digest decides filter E; ids
meet labels and first copies by joins on the id, so a text that fills a third of the table is
one row on the small side. Rows without an id are not joined at all. Each task counts
its words by part; the shuffle carries 32 rows a part and task.

Defined cases: a NULL text is empty; a NULL source is the part ""; a row with a
NULL doc_id has no label, is no copy of a smaller id and is none itself; rows of the same
id and text do not remove each other; an id with several label rows is good (toxic) if one of them says
so, and a NULL label says nothing; an empty table gives an empty result; further
columns are left out. Texts are judged whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import land, prepare

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
MARKS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
TAILS = bytes(range(0x80, 0xC0))  # the later bytes of a character

#: Documents that a part's counters distinguish: all, of good quality, toxic.
CLASSES = ("everything", "good", "toxic")
#: Parts counted side by side in a task; beyond it the counts so far are sent on.
PARTS_HELD = 4096

COPY = 1 << FILTERS.index("E")


def text_failures(raw: bytes) -> int:
    """Filters A to D that the text (UTF-8) fails, as bits."""
    words = raw.split()  # bytes split at \x20 and \x09 to \x0D, nothing else
    chars = len(raw) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, TAILS)))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * capitals > MAX_CAPITALS * chars,
        len(raw.translate(None, MARKS)) < len(raw),
    )
    return sum(1 << k for k, f in enumerate(failed) if f)


#: Survival word of each set of failures: the subsets that share no filter with it.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], dtype=np.uint32)


class Counter:
    """Positional popcount of 32-bit words by carry-save addition."""

    def __init__(self):
        self.planes: list[np.ndarray] = []  # words of weight 1, 2, 4, ...

    def add(self, words: np.ndarray) -> None:
        weight = 0
        while len(words):
            if weight == len(self.planes):
                self.planes.append(np.zeros(0, dtype=np.uint32))
            column, carried = np.concatenate([self.planes[weight], words]), []
            while (third := len(column) // 3) > 0:
                a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
                either = a ^ b
                carried.append((a & b) | (either & c))
                column = np.concatenate([either ^ c, column[3 * third :]])
            self.planes[weight] = column
            words = np.concatenate(carried) if carried else column[:0]
            weight += 1

    def counts(self) -> list[int]:
        """How many of the words so far have each bit set."""
        return [sum(int((plane >> np.uint32(s) & np.uint32(1)).sum()) << k for k, plane in enumerate(self.planes)) for s in range(SUBSETS)]


def judged(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, part, failed (filters A to D as bits) and the text's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            failed = pa.array([text_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), failed, digests], ["doc_id", "part", "failed", "digest"])

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return narrow.mapInArrow(run, "doc_id long, part string, failed int, digest binary")


def _says(name: str) -> Column:
    return F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(name)


def with_marks(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (now with filter E), good, toxic for each row of :func:`judged`."""
    known, nameless = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = land(firsts.withColumn("first", F.lit(True)), "first_copies")
    told = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    told = land(told.agg(_says("quality"), _says("toxic")).withColumnRenamed("quality", "good"), "label_marks")
    marked = known.join(told, "doc_id", "left").join(firsts, ["doc_id", "digest"], "left")
    copy = F.when(F.col("first").isNull(), F.col("failed") + COPY).otherwise(F.col("failed"))
    no = F.lit(False)
    return marked.select("part", copy.alias("failed"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).unionByName(
        nameless.select("part", "failed", no.alias("good"), no.alias("toxic"))
    )


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[Counter, ...]] = {}

    def told() -> pa.RecordBatch:
        parts, subsets, sums = [], [], [[] for _ in CLASSES]
        for part, counters in held.items():
            parts += [part] * SUBSETS
            subsets += range(SUBSETS)
            for column, counter in zip(sums, counters, strict=True):
                column += counter.counts()
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.string()), pa.array(subsets, pa.int32()), *(pa.array(c, pa.int64()) for c in sums)], ["part", "subset", *CLASSES]
        )

    for batch in batches:
        coded = batch.column("part").dictionary_encode()
        which, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        words = WORDS[batch.column("failed").to_numpy(zero_copy_only=False)]
        chosen = [np.ones(len(words), dtype=bool), *(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in CLASSES[1:])]
        order = np.argsort(which, kind="stable")
        bounds = np.searchsorted(which[order], np.arange(len(names) + 1))
        for k, name in enumerate(names):
            rows = order[bounds[k] : bounds[k + 1]]
            counters = held.setdefault(name, tuple(Counter() for _ in CLASSES))
            for counter, take in zip(counters, chosen, strict=True):
                counter.add(words[rows[take[rows]]])
        if len(held) >= PARTS_HELD:
            yield told()
    if held:
        yield told()


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and subset of the filters (0 to 31): documents that survive it --
    everything, good, toxic."""
    prepare(docs.sparkSession)
    rows = land(judged(docs), "judged")
    partial = with_marks(rows, labels).mapInArrow(_count, "part string, subset int, everything long, good long, toxic long")
    return partial.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in CLASSES])


def _shapley(counts: Column, k: int) -> Column:
    """Documents that filter ``k`` removes, over all orders."""
    others = len(FILTERS) - 1
    terms = []
    for s in range(SUBSETS):
        if not s >> k & 1:
            n = s.bit_count()
            terms.append(F.lit(math.factorial(n) * math.factorial(others - n)) * (counts[s] - counts[s | 1 << k]))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def audit(counts: DataFrame) -> DataFrame:
    """All orders and steps of each part from its survivor counts."""
    wide = counts.groupBy("part").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("subset", *CLASSES))), lambda r: F.struct(*[r[c].alias(c) for c in CLASSES])).alias("s")
    )
    wide = wide.select("part", *[F.col(f"s.{c}").alias(c) for c in CLASSES])
    whole = F.col("everything")
    wide = wide.withColumns({
        "fails": F.array(*[whole[0] - whole[1 << k] for k in range(len(FILTERS))]),
        "only": F.array(*[whole[SUBSETS - 1 - (1 << k)] - whole[SUBSETS - 1] for k in range(len(FILTERS))]),
        "shapleys": F.array(*[_shapley(whole, k) for k in range(len(FILTERS))]),
    })
    names = ",".join("".join(o) for o in permutations(FILTERS))
    steps = wide.withColumn("filter_order", F.explode(F.split(F.lit(names), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = [F.instr("filter_order", letter) for letter in FILTERS]

    def bits(chosen: list[Column]) -> Column:
        return sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(chosen)), F.lit(0))

    steps = steps.withColumns({
        "before": bits([p < F.col("step") for p in place]),
        "after": bits([p <= F.col("step") for p in place]),
        "which": F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))) - 1,
    })

    def lost(name: str) -> Column:
        return F.get(name, F.col("before")) - F.get(name, F.col("after"))

    which = F.col("which")
    return steps.select(
        "part", "filter_order", "step",
        F.get("everything", F.col("after")).alias("kept"),
        lost("everything").alias("removed"),
        (F.get("fails", which) - lost("everything")).alias("redundant"),
        F.get("only", which).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapleys", which).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley."""
    return audit(survivors(docs, labels))


#: The whole of ``audit_documents`` over ``documents`` and ``labels``.
ORACLE_SQL = r"""
WITH base AS (
    SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), FALSE) AS fail_e
    FROM documents
), told AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
           {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
            'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
            'D': regexp_matches(text, '[#$%&*|]'), 'E': fail_e} AS f
    FROM base LEFT JOIN told USING (doc_id)
), kinds AS (
    SELECT part, good, toxic, f, count(*) AS c FROM judged GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), fates AS (
    SELECT part, filter_order, step, good, toxic, c, substr(filter_order, step, 1) AS x,
           list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: CASE y WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS failed
    FROM kinds, orders, unnest([1, 2, 3, 4, 5]) AS s(step)
), judged_steps AS (
    SELECT *, list_contains(failed, x) AS fails_it,
           len(list_filter(failed, lambda y: instr(filter_order, y) < step)) > 0 AS gone FROM fates
), steps AS (
    SELECT part, filter_order, step, any_value(x) AS x,
           sum(c) FILTER (NOT gone AND NOT fails_it) AS kept,
           sum(c) FILTER (NOT gone AND fails_it) AS removed,
           sum(c) FILTER (gone AND fails_it) AS redundant,
           sum(c) FILTER (fails_it AND len(failed) = 1) AS unique_fails,
           sum(c) FILTER (NOT gone AND fails_it AND good) AS good_lost,
           sum(c) FILTER (NOT gone AND fails_it AND toxic) AS toxic_lost
    FROM judged_steps GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM steps
"""
