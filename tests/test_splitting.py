"""Line breaks in quotes by ranges of bytes, and separators told by the fields of lines."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.values import separator_of_lines
from ledgerloom.sources.delimited import read_delimited, read_folder, vote_separator
from ledgerloom.sources.splitting import OpenQuote, byte_ranges, read_split, record_ends, records_of_range


class _Bytes:
    def __init__(self, data):
        self._data = data

    def read_at(self, n, at):
        return self._data[at : at + n]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a"\n,;é', max_size=9), min_size=1, max_size=3), max_size=12), st.integers(1, 40), st.integers(1, 9), st.booleans())
def test_records_of_all_ranges_are_those_of_the_file(rows, size, piece, ends):
    """Whatever the ranges, each record comes once and as a whole."""
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(rows)
    data = out.getvalue().encode()
    data = data if ends else data.removesuffix(b"\n")
    found = []
    for start in range(0, len(data), size):
        inside = data[:start].count(b'"') % 2 == 1
        found += records_of_range(_Bytes(data), start, min(start + size, len(data)), len(data), inside, piece)
    assert b"\n".join(found) + b"\n" * ends == data or data == found == b"" or not rows
    assert [next(csv.reader(io.StringIO(r.decode()))) for r in found] == rows


def test_record_ends():
    ends, inside = record_ends(b'a,"b\n""c\n",d\ne,"f\n', False)
    assert (ends.tolist(), inside) == ([12], True)
    assert record_ends(b'f\n"\n', True)[0].tolist() == [3]


ROWS = [
    (1, 'two\nlines and "quotes"', "x,y"),
    (2, "", None),
    (3, None, "ünïcödé\r\nwith CRLF"),
    (4, "\n\n\n", '"'),
    (5, " blanks ", ""),
    (6, "long " + "text\n" * 4000, "|;,\t"),
]


@pytest.fixture
def written(spark, tmp_path):
    df = spark.createDataFrame([(i + 10 * n, a, b) for n in range(30) for i, a, b in ROWS], "Key long, `Text, one` string, `B` string")
    writer = df.repartition(3).write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(str(tmp_path / "in"))
    return str(tmp_path / "in")


@pytest.mark.parametrize("range_bytes", [1000, 70_001, 1 << 25])
def test_split_files_are_read_as_by_one_task(spark, written, range_bytes):
    wanted = read_delimited(spark, written, ",", {"key": "bigint"}, multi_line=True)
    found = read_split(spark, written, ",", {"key": "bigint"}, range_bytes)
    assert found.dtypes == wanted.dtypes
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
    ranges = byte_ranges(spark, written, range_bytes)
    assert ranges.count() > 100 if range_bytes == 1000 else ranges.count() >= 3
    if range_bytes == 1000:
        assert found.rdd.getNumPartitions() > 100 and ranges.where("inside").count() > 0


def test_split_refuses_what_it_cannot_tell(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text('k,t\n1,"open\n')
    with pytest.raises(OpenQuote, match="1.csv"):
        read_split(spark, str(tmp_path / "a"))
    (tmp_path / "a" / "1.csv").write_text('\n\nk,t\n1,"b\r\nc"\r\n\n2,d')
    assert [tuple(r) for r in read_split(spark, str(tmp_path / "a"), range_bytes=3).orderBy("k").collect()] == [("1", "b\r\nc"), ("2", "d")]
    (tmp_path / "a" / "2.csv").write_text("k,other\n3,x\n")
    with pytest.raises(Exception, match="header differs"):
        read_split(spark, str(tmp_path / "a")).collect()
    (tmp_path / "a" / "2.csv").write_text("k,t\n3,x,y\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_split(spark, str(tmp_path / "a")).collect()
    (tmp_path / "a" / "2.csv").write_text("k,t\n")
    assert read_split(spark, str(tmp_path / "a"), types={"k": "int"}).count() == 2


LINES = [
    (["a,b;c", "1,2;3", "4,5"], ","),
    (["a;b,c;d", "1;2;3", "4;5,5;6"], ";"),
    (['"a,b";c', '"1,2,3";4', "5;6"], ";"),
    (['"a;b","c;d;e",f', '"x\ny;;;",1,2'], ","),
    (["a|b|c,d", "1|2|3", "4,4|5|6"], "|"),
    (["a\tb", "1,5\t2,5", "3,5\t4"], "\t"),
    (["one column", "x", "y"], ","),
    (["one column", "x;y", "y"], ","),
    (["a;b", '1;"cut off, in, quotes'], ";"),
    (['a;"cut, off in, the header'], ";"),
    (["a,b;c"], ","),
    (["a,b;c", "1,2;3"], ","),
    (["", "a|b", "", "c|d", ""], "|"),
    ([], ","),
    (['a;""quotes"", b;c', '1;"say ""x, y""";3'], ";"),
    (["a;b\r", "1,1;2\r", "1;2\r"], ";"),
]


def test_separator_of_lines(spark):
    rows = spark.createDataFrame([(i, lines) for i, (lines, _) in enumerate(LINES)], "i int, lines array<string>")
    found = {r["i"]: r["sep"] for r in rows.select("i", separator_of_lines(F.col("lines")).alias("sep")).collect()}
    assert [found[i] for i in range(len(LINES))] == [sep for _, sep in LINES]


def test_voted_separators_of_a_folder(spark, tmp_path):
    for name, text in {"a": '"k,1";"t"\n1;"x,y,z"\n', "b": "k,1|t\n2|w\n", "c": '"k,1",t\n3,"u;u;u"\n'}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    assert vote_separator(spark, str(tmp_path / "a.csv")) == ";"
    read = read_folder(spark, str(tmp_path), sep="vote", types={"k_1": "int"})
    assert sorted(map(tuple, read.collect())) == [(1, "x,y,z"), (2, "w"), (3, "u;u;u")]
    assert vote_separator(spark, str(tmp_path / "b.csv")) == "|"
