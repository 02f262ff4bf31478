"""Quoted CSV in splits against the multiLine read."""

import pytest
from pyspark.sql import functions as F

from pitchforge.session import scratch_path
from pitchforge.sources.files import read_csv_strings, write_csv
from pitchforge.sources.quoted_csv import joined, open_ranges, pieces, ranges_of_lines, read_csv_quoted, with_open


@pytest.fixture
def small_ranges(spark):
    """Ranges of 2,000 bytes, so that small files have many."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def text_rows(spark, n):
    """Notes with quotes, commas, blank lines and runs of newlines, some longer than several ranges."""
    i = F.col("id")
    note = (F.when(i % 5 == 0, F.concat(F.lit('said "x, y"\n\nand\n"'), i.cast("string"), F.lit('"\n')))
             .when(i % 7 == 0, F.repeat(F.lit('line "of" many\n'), 30))
             .when(i == 101, F.repeat(F.lit('a "long" one,\n'), 900))
             .when(i % 11 == 0, F.lit(None)).when(i % 13 == 0, F.lit("")).otherwise(F.lit("plain")))
    return spark.range(n).select(i.cast("string").alias("id"), note.alias("the note"), F.concat(F.lit("z"), i.cast("string")).alias("end"))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_equals_the_multiline_read_in_many_ranges(spark, small_ranges):
    path = scratch_path(spark, "quoted")
    rows = text_rows(spark, 400)
    write_csv(rows.coalesce(1), path)
    lines = ranges_of_lines(spark, path)
    assert open_ranges(lines).count() > 10
    assert lines.rdd.getNumPartitions() > 10
    assert open_ranges(lines).agg(F.sum("open")).first()[0] > 3
    got = read_csv_quoted(spark, path)
    same(got, read_csv_strings(spark, path))
    same(got.select("id", "end"), rows.select("id", "end"))


def test_beyond_the_broadcast_bound_and_over_files(spark, small_ranges):
    path = scratch_path(spark, "quoted")
    write_csv(text_rows(spark, 300).repartition(3), path)
    same(read_csv_quoted(spark, path, max_ranges=0), read_csv_strings(spark, path))


def test_awkward_files(spark, small_ranges):
    for name, raw in {"crlf": 'a,b\r\n1,"x\ny"\r\n2,z\r\n', "blank lines": '\na,b\n\n1,2\n\n\n3,"\n"\n', "no end of line": 'a,b\n1,"p\nq"',
                      "header alone": "a,b\n", "header with a newline": '"a\nb",c\n1,2\n', "short and long rows": "a,b\n1\n1,2,3\n",
                      "empty values": 'a,b\n"",\n,""\n', "no quotes": "a,b\n" + "".join(f"{i},{i}\n" for i in range(900)),
                      "long header": '"' + "h\n" * 1500 + '",b\n1,2\n'}.items():
        same_or_name(spark, name, raw)


def same_or_name(spark, name, raw):
    path = scratch_path(spark, "awkward")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path + "/one.csv")
    out = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(hpath)
    out.write(bytearray(raw.encode()))
    out.close()
    try:
        same(read_csv_quoted(spark, path), read_csv_strings(spark, path))
    except AssertionError as e:
        raise AssertionError(name) from e


def test_changed_ranges_are_an_error(spark, small_ranges):
    path = scratch_path(spark, "quoted")
    write_csv(text_rows(spark, 300).coalesce(1), path)
    lines = ranges_of_lines(spark, path)
    state = open_ranges(lines).filter("start <> 2000")
    with pytest.raises(Exception, match="have changed"):
        joined(with_open(lines, state).mapInPandas(pieces, "file string, start long, kind int, header boolean, text string")).collect()
