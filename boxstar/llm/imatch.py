"""I-Match fingerprints in DataFrame functions only (operator 7).

A term is a run of letters and digits in the lower-cased text, kept as its 64-bit hash. Document
frequencies of all terms over all documents are counted exactly (one row per term
after map-side sums). The lexicon are the terms whose share of documents lies inside
[``LOW``, ``HIGH``], that is, whose inverse document frequency lies in a band; it holds at
most (mean number of distinct terms a document) / ``LOW`` terms at any corpus size, is collected
and goes to the tasks as a table of small buckets. A document's fingerprint holds
the hash of its sorted distinct band terms over several randomised subsets of the
lexicon: ``SEEDS`` independent draws, each thinned to one term in 4, 16 and 64, so that
short and long texts both have subsets of a few terms.

A text with few or no band terms (a copy group of more than ``HIGH`` of the rows, a small
table) has little to compare there. So the fingerprint also holds, after the band's, the same subsets of
all the text's terms, and last the hash of all of them. Likeness of two fingerprints: the share of
subsets with equal hashes among those that are not empty on both sides, of the band's (where both
have some) or of all terms', whichever is greater; 1 for equal fingerprints. This is alike at every size.

Defined results: a NULL text is empty; identical rows (same id and text) count
once in the order of documents, and each of them gets the result; rows that
share an id but not a text follow one another in the order of their text
hashes; a NULL id comes first; a single document is its own next one; an empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxstar.llm.common import land, parallelism, prepare

LOW, HIGH = 0.002, 0.01
SEEDS = 4
RATES = (4, 4, 4)  # each subset thins the one before it: one in 4, 16, 64
#: Signatures of one kind: subsets of the band, then as many of all terms and one of all.
SUBSETS = SEEDS * len(RATES)


def term_hashes(text: Column) -> Column:
    """Distinct 64-bit term hashes of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> list[int]:
    """Hashes of the terms whose share of documents is in the band."""
    counted = docs.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = F.lit(float(max(1, docs.count())))
    band = counted.where((F.col("df") >= total * F.lit(low)) & (F.col("df") <= total * F.lit(high)))
    return sorted(r["term"] for r in band.select("term").collect())  # mean terms a document / low at most


def band_terms(terms: Column, band: list[int]) -> Column:
    """Sorted terms that lie in the band. Its hashes are dealt to buckets by their low bits, one
    or so in each, laid end to end; a term is looked for in its own bucket."""
    size = 1 << max(4, len(band).bit_length())
    laid = sorted(band, key=lambda t: t & (size - 1))
    ends = np.searchsorted([t & (size - 1) for t in laid], np.arange(size), side="right").tolist()
    flat, bounds = (F.split(F.lit(",".join(map(str, v or [0]))), ",").cast("array<bigint>") for v in (laid, [0, *ends]))

    def inside(t: Column) -> Column:
        bucket = t.bitwiseAND(F.lit(size - 1)).cast("int")
        start, end = F.get(bounds, bucket).cast("int"), F.get(bounds, bucket + 1).cast("int")
        return F.array_contains(F.slice(flat, start + 1, end - start), t)

    return F.sort_array(F.filter(terms, inside))


def _thin(terms: Column, seed: int, rate: int, before: int) -> Column:
    """One term in ``rate`` of those that ``before`` steps of thinning have left."""
    draw = lambda t: F.pmod(F.shiftrightunsigned(F.xxhash64(t, F.lit(seed)), 2 * before), F.lit(rate))
    return F.filter(terms, lambda t: draw(t) == 0)


def with_signatures(df: DataFrame, text: str, out: str, band: list[int]) -> DataFrame:
    """Add ``out``: hashes of the subsets of column ``text``'s band terms, of the same subsets of all its terms, and of all of them; an empty subset is NULL."""
    terms, inside = f"_{out}_terms", f"_{out}_band"
    df = df.withColumn(terms, F.sort_array(term_hashes(F.col(text)))).withColumn(inside, band_terms(F.col(terms), band))
    names, sums = [terms, inside], []
    for kind in (inside, terms):
        for seed in range(SEEDS):
            above = kind
            for k, rate in enumerate(RATES):
                name = f"{kind}_{seed}_{k}"
                df = df.withColumn(name, _thin(F.col(above), seed, rate, k))
                names.append(name)
                sums.append(F.when(F.size(name) > 0, F.xxhash64(name)))
                above = name
    return df.withColumn(out, F.array(*sums, F.xxhash64(terms))).drop(*names)


def rendered(signatures: Column) -> Column:
    """Signatures as text: 16 hex digits each, a dash for an empty subset."""
    digits = F.transform(signatures, lambda s: F.when(s.isNull(), "-").otherwise(F.lower(F.lpad(F.hex(s), 16, "0"))))
    return F.array_join(digits, ":")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among those present on either side (0 to 1): of the
    band's where both sides have some, or of all terms' if that is more."""
    band = [F.slice(x, 1, SUBSETS) for x in (a, b)]
    some = [F.exists(x, lambda s: s.isNotNull()) for x in band]
    whole = [F.slice(x, SUBSETS + 1, SUBSETS + 1) for x in (a, b)]

    def shared(x: Column, y: Column) -> Column:
        present = F.size(F.filter(F.zip_with(x, y, lambda s, t: s.isNotNull() | t.isNotNull()), lambda p: p))
        equal = F.size(F.filter(F.zip_with(x, y, lambda s, t: s.isNotNull() & (s == t)), lambda p: F.coalesce(p, F.lit(False))))
        return equal / present

    return F.greatest(F.when(some[0] & some[1], shared(*band)), shared(*whole))


def next_documents(keys: DataFrame) -> DataFrame:
    """(id, h, none, next_id, next_h): each key's follower, the first after the last.

    Keys are sorted over range partitions; inside one a window gives the
    follower, and each partition's last key gets the first key of the next
    partition from a table with one row per partition.
    """
    spark = keys.sparkSession
    parts = parallelism(spark)
    order = [F.col("none").desc(), F.col("id").asc(), F.col("h").asc()]  # a NULL id comes first
    sorted_keys = land(
        keys.select("none", "id", "h").distinct().repartitionByRange(parts, *order).withColumn("pid", F.spark_partition_id()),
        "doc_order",
    )
    inside = Window.partitionBy("pid").orderBy(*order)
    rank = F.struct((~F.col("none")).alias("some"), F.col("id"), F.col("h"))
    firsts = sorted_keys.groupBy("pid").agg(F.min(rank).alias("head"))  # one row per partition
    along = Window.orderBy("pid")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select("pid", F.coalesce(F.lead("head").over(along), F.first("head").over(whole)).alias("after"))
    return (
        sorted_keys.withColumn("follower", F.lead(rank).over(inside))
        .join(F.broadcast(heads), "pid")
        .select("id", "h", "none", F.coalesce("follower", "after").alias("n"))
        .select("id", "h", "none", F.col("n.id").alias("next_id"), F.col("n.h").alias("next_h"))
    )


def keyed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text (NULL: empty), n_chars, and a key without NULLs: ``id`` and
    ``h``, a hash of the text that also tells a NULL id."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.col("doc_id").isNull()
    return base.select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"),
        none.alias("none"), F.coalesce("doc_id", F.lit(-1)).alias("id"), F.xxhash64("text", none).alias("h"),
    )


def edited_documents(base: DataFrame) -> DataFrame:
    """Keyed documents with ``edited``: the last quarter of the text replaced by
    the start of the next document's; and the next document's key.

    Both joins read the documents dealt by their own key with the same columns,
    so the texts are shuffled once.
    """
    follow = land(
        next_documents(base).join(base.select("id", "h", "n_chars").distinct(), ["id", "h"])
        .withColumn("k", F.floor(F.col("n_chars") / 4).cast("int")).drop("n_chars"),
        "next_documents",
    )
    dealt = base.select("id", "h", "n_chars", "text")
    asks = follow.select(F.col("id").alias("for_id"), F.col("h").alias("for_h"), "none", "k", F.col("next_id").alias("id"), F.col("next_h").alias("h"))
    start = F.substring("text", F.lit(1), F.least(F.col("k"), F.col("n_chars").cast("int")))
    ends = (
        dealt.join(asks, ["id", "h"])
        .select("for_id", "for_h", "none", "k", F.col("id").alias("next_id"), F.col("h").alias("next_h"), start.alias("tail"))
        .dropDuplicates(["for_id", "for_h"])
        .withColumnsRenamed({"for_id": "id", "for_h": "h"})
    )
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("k"))
    return dealt.join(ends, ["id", "h"]).select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), "id", "h", "n_chars", "text", "next_id", "next_h", F.concat(kept, F.col("tail")).alias("edited")
    )


def fingerprint_documents(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next."""
    prepare(docs.sparkSession)
    base = keyed_documents(docs)
    band = lexicon(base, low, high)
    both = edited_documents(base)
    marked = with_signatures(with_signatures(both, "text", "own", band), "edited", "changed", band)
    marked = land(
        marked.select("doc_id", "id", "h", "n_chars", "next_id", "next_h", F.sha2("edited", 256).alias("edited_sha256"), "own", "changed"),
        "signatures",
    )
    others = marked.select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("own").alias("other"))
    out = marked.join(others.dropDuplicates(["next_id", "next_h"]), ["next_id", "next_h"])
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        rendered(F.col("own")).alias("fingerprint"),
        rendered(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )
