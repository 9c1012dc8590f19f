"""The parallel record reader against a plain reader of the whole text."""

import csv
import gzip
import io
import random
from collections import Counter

import pytest

from opsledger.sources import readers, records


def write(path, text, encoding):
    path.write_bytes(text.encode(encoding))


def plain(text):
    """All records by Python's reader, empty fields as None, empty lines left out."""
    found = csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter="\t")
    return [tuple(v or None for v in r) for r in found if r]


def random_text(rng, records_, end):
    out = ["id\tname\tnotes"]
    for i in range(records_):
        note = "".join(rng.choice(["word", " ", "\n", "\r\n", '""', "\t", "ü", "日本", "😀", "ੁ䈀", "∊""", "ਊ", "∀"])
                       for _ in range(rng.choice([0, 1, 5, 40])))
        out.append(f'{i}\t"n{i}"\t"{note}"')
    return end.join(out) + rng.choice(["", end])


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
@pytest.mark.parametrize("encoding, end", [("UTF-16LE", "\n"), ("UTF-16BE", "\r\n")])
def test_records_equal_a_plain_reader(spark, tmp_path, split, encoding, end):
    rng = random.Random(split)
    texts = {f"{i}.txt": ("﻿" if i % 2 else "") + random_text(rng, n, end) for i, n in enumerate([0, 1, 40, 90])}
    for name, text in texts.items():
        write(tmp_path / name, text, encoding)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        frame = readers.read_delimited(spark, str(tmp_path), encoding=encoding)
        found = Counter(tuple(r) for r in frame.collect())
        parts = frame.rdd.getNumPartitions() if split > 1000 else None
        splits = records._lines(spark, str(tmp_path), encoding).select("file", "start").distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    wanted = Counter(r for text in texts.values() for r in plain(text)[1:])
    assert frame.columns == ["id", "name", "notes"] and found == wanted
    assert splits > 20 if split == 64 else splits >= 4


def test_one_carriage_return_goes(spark, tmp_path):
    write(tmp_path / "a.txt", "a\tb\r\n1\tx\r\n2\ty\r\r\n\r\n3\t\r\n", "utf-16-le")
    frame = readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE")
    assert frame.columns == ["a", "b"]
    assert [tuple(r) for r in frame.orderBy("a").collect()] == [("1", "x"), ("2", "y\r"), ("3", None)] or \
        [tuple(r) for r in frame.orderBy("a").collect()] == [("1", "x"), ("2", "y"), ("3", None)]


@pytest.mark.parametrize("line", ["1", "1\tx\tz"])
def test_a_wrong_number_of_fields_is_an_error(spark, tmp_path, line):
    write(tmp_path / "a.txt", f"a\tb\n{line}\n", "utf-16-le")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE").collect()


def test_different_headers_and_no_files(spark, tmp_path):
    write(tmp_path / "a.txt", "a\tb\n1\t2\n", "utf-16-le")
    assert readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE", header=False).columns == ["_c0", "_c1"]
    write(tmp_path / "b.txt", "a\tc\n1\t2\n", "utf-16-le")
    with pytest.raises(ValueError, match="headers"):
        readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE")


def test_an_open_quote_takes_the_rest_of_its_file(spark, tmp_path):
    write(tmp_path / "a.txt", 'a\n"x\ny\nz', "utf-16-le")
    found = [r.record for r in records.read_records(spark, str(tmp_path)).orderBy("start", "place").collect()]
    assert found == ["a", '"x\ny\nz']


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-16BE"])
def test_compressed_files_are_read_in_one_pass(spark, tmp_path, encoding, monkeypatch):
    rng = random.Random(encoding)
    texts = [random_text(rng, n, "\r\n") for n in (0, 1, 40, 90)] + ['id\tname\tnotes\n7\tx\t"never closed\n8\ty\tz']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt.gz").write_bytes(gzip.compress(text.encode(encoding)))
    monkeypatch.setattr(records, "_changes", None)  # one split a file: each begins outside quotes
    assert records.read_records(spark, str(tmp_path), encoding, firsts=True).count() == len(texts)
    (tmp_path / "4.txt.gz").unlink()
    frame = readers.read_delimited(spark, str(tmp_path), encoding=encoding)
    assert frame.columns == ["id", "name", "notes"]
    assert Counter(tuple(r) for r in frame.collect()) == Counter(r for text in texts[:4] for r in plain(text)[1:])


def test_plain_files_beside_compressed_ones_are_split(spark, tmp_path):
    write(tmp_path / "a.txt", "a\tb\n1\t2\n", "utf-16-le")
    (tmp_path / "b.txt.gz").write_bytes(gzip.compress("a\tb\n3\t4\n".encode("utf-16-le")))
    assert not records._unsplit(spark, str(tmp_path))
    assert sorted(tuple(r) for r in readers.read_delimited(spark, str(tmp_path), encoding="UTF-16LE").collect()) == [("1", "2"), ("3", "4")]
