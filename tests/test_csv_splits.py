"""CSV files read in many splits, with line breaks inside quotes."""

import csv
import io
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxstar.sources import csvscan
from boxstar.sources.csvscan import SplitStates, ends_quoted, read_box_csv, states_after


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "96", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


@given(st.lists(st.lists(st.text(alphabet='ab",\n\r', max_size=6), min_size=3, max_size=3), min_size=1, max_size=6), st.booleans())
@settings(max_examples=300, deadline=None)
def test_lines_of_written_records_close_where_they_should(rows, crlf):
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\r\n" if crlf else "\n", quoting=csv.QUOTE_ALL).writerows(rows)
    state, ends = False, 0
    for line in text.getvalue().split("\n")[:-1]:
        state = ends_quoted(line, state)
        ends += not state
    assert not state and ends == len(rows)


@pytest.mark.parametrize(
    "line,outside,inside",
    [
        ('a,b', False, True),
        ('"a,b', True, False),
        ('"a ""q"", b"', False, False),
        ('5" tall,6" wide', False, False),  # a quote inside a field opens nothing
        ('a"b,"c', True, True),
        ('"a"b"c,d', False, False),
        ('x",y', False, False),
        ('', False, True),
        ('""', False, True),  # inside quotes, a doubled quote is text
        ('"""', True, False),
    ],
)
def test_line_maps(line, outside, inside):
    assert (ends_quoted(line, False), ends_quoted(line, True)) == (outside, inside)


@given(st.lists(st.text(alphabet='ab",', max_size=8), min_size=1, max_size=12), st.booleans())
@settings(max_examples=500, deadline=None)
def test_states_of_many_lines(lines, quoted):
    want, state = [], quoted
    for line in lines:
        state = ends_quoted(line, state)
        want.append(state)
    assert states_after(pa.array(["x", *lines]).slice(1), quoted).tolist() == want


def test_split_states_skip_splits_without_quotes():
    states = SplitStates([(1, 200, False, True), (1, 0, True, False), (1, 300, True, False), (2, 0, False, True)])
    assert [states.at(1, s) for s in (0, 100, 200, 300, 400)] == [False, True, True, True, False]
    assert states.at(2, 50) is False and states.at(3, 10) is False


HARD = (
    'id , note,tag\n1,plain,a\n2,"two\nlines",b\n3,"a ""q"", b\n\n  third ""line""\n",c\n4,5" tall,d\n\n   \n5,"",e\n6,NA,"x\ry"\n'
    + "".join(f'{i},"row {i}{chr(10) * (i % 4)}{"," * (i % 3)}end",t{i}\n' for i in range(7, 120))
    + '200,"last, without\na line break",z'
)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_splits_equal_the_whole_file_reader(spark, tmp_path, tiny_splits, ending):
    path = write(tmp_path / "hard.csv", HARD.replace("\n", ending))
    got = read_box_csv(spark, path)
    assert got.columns == ["id", "note", "tag"]
    # that reader keeps the line of blanks, and makes a CRLF inside quotes a line feed
    whole = read_box_csv(spark, path, multi_line=True).where("trim(id) <> ''")
    assert table(got.select("id", F.replace("note", F.lit("\r\n"), F.lit("\n")), "tag")) == table(whole)
    rows = {r["id"]: r for r in got.collect()}
    assert rows["2"]["note"] == f"two{ending}lines" and rows["5"]["note"] is None and rows["6"]["note"] is None and len(rows) == 120
    assert rows["200"]["note"] == f"last, without{ending}a line break"
    assert spark.read.text(path).rdd.getNumPartitions() > 20


def test_one_record_over_many_splits_and_folders(spark, tmp_path, tiny_splits):
    long = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "a.csv", f'k,v\n1,"{long}"\n2,x\n3,"{long}\n"\n')
    write(tmp_path / "d" / "b.csv", f'v,k\n"{long}",4\n"y\nz",5\n')
    write(tmp_path / "d" / "c.csv", "k,v\n6,none\n")
    write(tmp_path / "d" / "e.csv", "k,v\n")
    rows = dict(map(tuple, read_box_csv(spark, str(tmp_path / "d")).select("k", "v").collect()))
    assert rows == {"1": long, "2": "x", "3": long + "\n", "4": long, "5": "y\nz", "6": "none"}


def test_a_header_with_a_line_break(spark, tmp_path, tiny_splits):
    path = write(tmp_path / "h.csv", '"k\nkey",v\n1,"a\nb"\n2,c\n')
    got = read_box_csv(spark, path)
    assert got.columns == ["k\nkey", "v"] and table(got) == [("1", "a\nb"), ("2", "c")]


def test_an_open_quote_takes_the_rest(spark, tmp_path, tiny_splits):
    path = write(tmp_path / "open.csv", 'k,v\n1,a\n2,"open' + "\nmore,text" * 40 + "\n")
    assert table(read_box_csv(spark, path)) == [("1", "a"), ("2", "open" + "\nmore,text" * 40)]


def test_files_without_breaks_keep_sparks_reader(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr(csvscan, "_cut_records", lambda *a: pytest.fail("no record crosses a line"))
    text = "k,v\n" + "".join(f'{i},"a ""b"", {i}"\n' for i in range(200))
    path = write(tmp_path / "plain.csv", text)
    got = read_box_csv(spark, path)
    assert got.rdd.getNumPartitions() > 10 and table(got) == table(read_box_csv(spark, path, multi_line=True))


@pytest.mark.parametrize("seed", range(6))
def test_random_files(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choice(['a', 'é', ',', '"', '\n', '\r\n', ' ', '5"', '""']) for _ in range(rng.randint(0, 12)))
    rows = [[str(i), cell(), cell()] for i in range(150)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\r\n" if seed % 2 else "\n", quoting=csv.QUOTE_MINIMAL).writerows([["k", "a", "b"], *rows])
    got = read_box_csv(spark, write(tmp_path / "r.csv", out.getvalue()), tokens=["no such token"])
    assert table(got.select("k", *[F.coalesce(c, F.lit("")).alias(c) for c in "ab"])) == table(spark.createDataFrame(rows, "k string, a string, b string"))
