"""CSV scan of the raw box-score files, in splits even where fields hold line breaks.

A line break inside quotes keeps Spark's reader from splitting a file. Here every split
of a file is read by its lines, and a line is a map of states: given that it starts
inside quotes or outside, does it end inside? Maps compose, so a split is such a map
too, and running over the splits' maps (a row each) tells the state in which each split
starts. Files in which no line ends inside quotes are read by Spark's line-wise
reader. In the others each split then cuts its own records; of a record that crosses a
border the pieces (two for each split at most) are put together afterwards.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxstar import config
from boxstar.functions.cleaning import null_na_tokens
from boxstar.session import land, ship_package


def apply_na_tokens(df: DataFrame, tokens: Iterable[str] = config.NA_TOKENS) -> DataFrame:
    """NULL every string field that is exactly one of the NA tokens."""
    tokens = list(tokens)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[null_na_tokens(F.col(c), tokens).alias(c) if c in text else F.col(c) for c in df.columns])


_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    # keep empty strings and whitespace as read; NA handling follows
    "nullValue": "\u0000",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Inside a quoted field up to its closing quote (doubled quotes are text) and the rest of
# the field; a field from its start. All repeats are possessive: one pass, no recursion.
_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELD = rf'(?:"{_REST}|(?!")[^,]*+)'
_FROM_OUTSIDE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+")
_FROM_INSIDE = re.compile(rf"{_REST}(?:,{_FIELD})*+")
_DELIMITER = ","
_BLANK = "".join(map(chr, range(33)))

#: What a row of cut text is: a record; the start of one that the split does not end;
#: the inside of one; the end of one that began in an earlier split.
RECORD, HEAD, INSIDE, TAIL = range(4)


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether ``line`` ends inside quotes, given whether it starts inside them. A quote opens
    a field only as its first character, as in Spark's reader; what follows a closing
    quote belongs to the field."""
    return not (_FROM_INSIDE if quoted else _FROM_OUTSIDE).fullmatch(line)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines (``text``) with a hash of their file and their split's first byte; inside a
    task a split's lines come in order."""
    lines = spark.read.text(files, lineSep="\n")
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("text")
    )


def _pieces(text: str) -> list[tuple[str, str]]:
    """A line up to its line feed as lines with what ends them: a carriage return ends one too."""
    if "\r" not in text:
        return [(text, "\n")]
    if text.index("\r") == len(text) - 1:
        return [(text[:-1], "\r\n")]
    *inner, last = text.split("\r")
    ended = [(piece, "\r") for piece in inner]
    if last:
        return [*ended, (last, "\n")]
    return [*ended[:-1], (ended[-1][0], "\r\n")]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """(file, split, consecutive lines of it)."""
    for batch in batches:
        file, split = (batch.column(c).to_numpy() for c in ("file", "split"))
        texts = batch.column("text")
        ends = [*(np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1).tolist(), len(texts)]
        start = 0
        for end in ends if len(texts) else ():
            yield int(file[start]), int(split[start]), texts.slice(start, end - start)
            start = end


def states_after(lines: pa.Array, quoted: bool) -> np.ndarray:
    """Whether each of consecutive ``lines`` ends inside quotes (:func:`ends_quoted`, one after the
    other). Where every quote that would open a field by counting does stand at the start
    of one, or doubles the quote before it, counting decides; else the lines are read one by one."""
    lines = lines.cast(pa.large_string())
    _, offsets, data = lines.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[lines.offset : lines.offset + len(lines) + 1]
    chars = np.frombuffer(data, dtype=np.uint8)[: bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    quotes = np.flatnonzero(chars[bounds[0] :] == ord('"')) + bounds[0]
    opening = quotes[(np.arange(len(quotes)) + quoted) % 2 == 0]
    before = chars[opening - 1]  # at 0 any character: that is the start of a line
    first = bounds[np.searchsorted(bounds, opening, side="right") - 1] == opening
    if (first | (before == ord(_DELIMITER)) | (before == ord('"'))).all():
        return (np.searchsorted(quotes, bounds[1:], side="left") + quoted) % 2 == 1
    out = np.empty(len(lines), dtype=bool)
    for k, text in enumerate(lines.to_pylist()):
        out[k] = quoted = ends_quoted(text, quoted)
    return out


def _plain(lines: pa.Array) -> tuple[pa.Array, np.ndarray] | None:
    """Lines without the carriage return at their end, and which had one; None if one stands elsewhere."""
    has = pc.ends_with(lines, "\r").to_numpy(zero_copy_only=False)
    if int(pc.sum(pc.count_substring(lines, "\r")).as_py() or 0) != int(has.sum()):
        return None
    return (pc.utf8_rtrim(lines, "\r") if has.any() else lines), has


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split's lines with quotes: the composed map and whether any line opens quotes.
    Both states are followed until they meet, as they soon do; then one is."""
    maps: dict[tuple[int, int], list[bool]] = {}
    for file, split, lines in _runs(batches):
        whole, k = maps.setdefault((file, split), [False, True, False]), 0
        plain = _plain(lines)
        while k < len(lines) and (whole[0] != whole[1] or plain is None):
            for piece, _ in _pieces(lines[k].as_py()):
                opens, stays = ends_quoted(piece, False), ends_quoted(piece, True)
                whole[:] = (stays if whole[0] else opens), (stays if whole[1] else opens), whole[2] or opens
            k += 1
        if k < len(lines):
            after = states_after(plain[0].slice(k), whole[0])
            whole[:] = bool(after[-1]), bool(after[-1]), whole[2] or bool(after.any())
    rows = [{"file": f, "split": s, "outside": m[0], "inside": m[1], "opens": m[2]} for (f, s), m in maps.items()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows)


class SplitStates:
    """In which state each split starts, from the splits' maps (in any order)."""

    def __init__(self, maps: Iterable[tuple[int, int, bool, bool]]):
        self.files: dict[int, tuple[list[int], list[bool]]] = {}
        for file, split, outside, inside in sorted(maps):
            starts, after = self.files.setdefault(file, ([], []))
            state = after[-1] if after else False
            starts.append(split)
            after.append(inside if state else outside)

    def at(self, file: int, split: int) -> bool:
        """Splits without quotes pass the state on, so the last map before this split tells."""
        starts, after = self.files.get(file, ([], []))
        k = bisect_left(starts, split)
        return after[k - 1] if k else False


class _Cut:
    """Cuts the lines of one split after another into records and pieces of records."""

    def __init__(self, states: SplitStates):
        self.states, self.here, self.held = states, None, []
        self.out: list[tuple[int, int, int, bool, str]] = []
        self.quoted = self.began = self.header = False

    def leave(self) -> None:
        """The end of a split: what is open goes out as a piece."""
        if self.held:
            self.out.append((*self.here, HEAD if self.began else INSIDE, self.began and self.header, "".join(self.held)))
            self.held = []

    def enter(self, file: int, split: int) -> None:
        if (file, split) != self.here:
            self.leave()
            self.here, self.quoted, self.began = (file, split), self.states.at(file, split), False
            self.header = split == 0

    def put(self, kind: int, text: str) -> None:
        self.out.append((*self.here, kind, self.header and kind == RECORD, text))
        self.header = self.header and kind != RECORD

    def line(self, text: str, ended: str) -> None:
        if self.quoted:
            if ends_quoted(text, True):
                self.held.append(text + ended)
                return
            self.put(RECORD if self.began else TAIL, "".join(self.held) + text)
            self.held, self.quoted, self.began = [], False, False
        elif '"' in text and ends_quoted(text, False):
            self.held, self.quoted, self.began = [text + ended], True, True
        elif text.strip(_BLANK):
            self.put(RECORD, text)

    def lines(self, lines: pa.Array) -> pa.Array | None:
        """Consecutive lines of the split; returns those that are records as they stand, all others
        are taken one by one."""
        plain, k = _plain(lines), 0
        while k < len(lines) and (plain is None or self.header):
            for piece, ended in _pieces(lines[k].as_py()):
                self.line(piece, ended)
            k += 1
        if k == len(lines):
            return None
        texts, returns = plain[0].slice(k), plain[1][k:]
        after = states_after(texts, self.quoted)
        alone = ~after & ~np.append(self.quoted, after[:-1])
        for j in np.flatnonzero(~alone):
            self.line(texts[int(j)].as_py(), "\r\n" if returns[j] else "\n")
        filled = pc.not_equal(pc.utf8_trim(texts, _BLANK), "")
        return texts.filter(pc.and_(pa.array(alone), filled))

    def batch(self) -> pa.RecordBatch:
        columns = [pa.array(c) for c in zip(*self.out, strict=True)]
        self.out = []
        return pa.RecordBatch.from_arrays(columns, _CUT)


_CUT = ["file", "split", "kind", "header", "text"]


def _cutter(states: SplitStates):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _Cut(states)
        for file, split, lines in _runs(batches):
            cut.enter(file, split)
            alone = cut.lines(lines)
            if alone is not None and len(alone):
                same = [pa.repeat(pa.scalar(v), len(alone)) for v in (file, split, RECORD, False)]
                yield pa.RecordBatch.from_arrays([*same, alone], _CUT)
            if len(cut.out) >= 4096:
                yield cut.batch()
        cut.leave()
        if cut.out:
            yield cut.batch()

    return cut


def _cut_records(spark: SparkSession, files: list[str], states: SplitStates) -> DataFrame:
    """The records of ``files`` without their headers, one text each."""
    rows = land(_lines(spark, files).mapInArrow(_cutter(states), "file long, split long, kind long, header boolean, text string"), "csv_records")
    late = F.col("kind") == HEAD  # a split first ends the record before it, then begins one
    pieces = rows.where(F.col("kind") != RECORD).withColumn("late", late)
    along = Window.partitionBy("file").orderBy("split", "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("record", F.sum(F.col("late").cast("long")).over(along))  # two rows a split at most
    whole = pieces.groupBy("file", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "late", "text"))), lambda p: p["text"]), "").alias("text"),
        F.max(F.col("kind") == TAIL).alias("closed"), F.max("header").alias("header"),
    )
    text = F.when(F.col("closed"), F.col("text")).otherwise(F.regexp_replace("text", r"(\r\n|\r|\n)\z", ""))
    return rows.where((F.col("kind") == RECORD) & ~F.col("header")).select("text").unionByName(
        whole.where(~F.col("header")).select(text.alias("text"))
    )


def _read_split(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Rows of ``files`` (with headers), every file read by many tasks."""
    ship_package(spark)
    quoting = _lines(spark, files).where(F.col("text").contains('"'))
    maps = quoting.mapInArrow(_split_maps, "file long, split long, outside boolean, inside boolean, opens boolean").collect()  # a row a split
    if not any(m.opens for m in maps):
        return _reader(spark, False).option("header", "true").option("enforceSchema", "true").schema(schema).csv(files)
    records = _cut_records(spark, files, SplitStates((m.file, m.split, m.outside, m.inside) for m in maps))
    return records.select(F.from_csv("text", schema.simpleString()[len("struct<"):-1].replace(":", " "), _OPTIONS | {"multiLine": "true"}).alias("r")).select("r.*")


def _reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(**_OPTIONS).option("multiLine", multi_line)


def read_box_csv(
    spark: SparkSession, path: str, tokens: Iterable[str] = config.NA_TOKENS, multi_line: bool | None = None
) -> DataFrame:
    """Read a CSV file, or a folder of CSV files, with headers as all-string columns.

    * header names are stripped of surrounding whitespace,
    * quotes are escaped by doubling (``"a ""q"", b"``), quoted fields may hold
      line breaks,
    * every NA token (not only one ``nullValue``) becomes NULL,
    * types are applied later by the cleaning and cast specs.

    Each file is read by its own header: files with the same columns in another
    order are lined up by name, files with other columns raise ValueError. A
    path that is not there raises FileNotFoundError.

    Files are split whatever they hold. By default one more pass over the lines
    with quotes finds the files whose fields hold line breaks; their records are cut
    split by split and written once to the checkpoint folder. ``multi_line=False``
    (known to hold none) spares the pass, ``multi_line=True`` gives each file to one task of
    Spark's whole-file reader (which keeps lines of blanks and makes ``\\r\\n`` in quotes ``\\n``).
    A quote that is never closed takes the rest of its file into one field, without the last line
    break. Lines end at ``\\n``, ``\\r\\n`` or ``\\r``; line breaks inside quotes stay as they are;
    lines of blanks alone are left out.
    """
    reader = lambda: _reader(spark, multi_line is not False)
    try:
        files = sorted(reader().schema("_c0 string").csv(path).inputFiles())
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no input at {path}") from error
        raise
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        first = reader().option("header", "false").csv(f).limit(1).collect()
        if first:
            names = tuple(str(v).strip() if v is not None else f"_c{i}" for i, v in enumerate(first[0]))
            by_header.setdefault(names, []).append(f)
    if not by_header:
        return spark.createDataFrame([], T.StructType([]))
    columns = next(iter(by_header))
    out = None
    for names, same in by_header.items():
        if set(names) != set(columns):
            raise ValueError(f"{same[0]} has other columns than the files before it: {sorted(set(names) ^ set(columns))}")
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(names))])
        if multi_line is None:
            part = _read_split(spark, same, schema).toDF(*names)
        else:
            part = reader().option("header", "true").option("enforceSchema", "true").schema(schema).csv(same).toDF(*names)
        out = part if out is None else out.unionByName(part)
    return apply_na_tokens(out, tokens)
