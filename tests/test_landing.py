import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.schemas import LANDING_CSV_COLUMNS
from shelfmark.sources.landing import (
    BY_FILE,
    BY_QUOTES,
    _layouts,
    all_records,
    profile_landing,
    read_landing_csv,
)
from shelfmark.sources.records import assemble_records, lines_of, number_lines

HEADER = ",".join(LANDING_CSV_COLUMNS) + "\n"


@pytest.fixture
def land(folder):
    def write(name, text, encoding="utf-8", header=HEADER):
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "wb") as file:
            file.write((header + text).encode(encoding))

    return write


def titles(df):
    return sorted(str(row["Book-Title"]) for row in df.collect())


def test_isbn_keeps_its_leading_zero(spark, land, folder):
    land("a.csv", "0195153448,T,A,2002,P,s,m,l\n")
    assert read_landing_csv(spark, folder).first()["ISBN"] == "0195153448"


def test_overlong_rows_are_skipped_and_short_ones_padded(spark, land, folder):
    land(
        "a.csv",
        "1,full,A,2002,P,s,m,l\n2,short\n3,long,A,2002,P,s,m,l,extra\n"
        '4,empty extra,A,2002,P,s,m,l,\n\n5,"commas, all quoted",A,2002,P,s,m,"l,l"\n'
        '6,"long, quoted",A,2002,P,s,m,l,"x"\n',
    )
    records = read_landing_csv(spark, folder)
    assert titles(records) == ["commas, all quoted", "full", "short"]
    assert records.count() == 3
    assert records.filter("ISBN = '2'").select("Publisher").first()[0] is None
    assert all_records(spark, folder).filter("overlong").count() == 3


def test_quotes_and_line_breaks(spark, land, folder):
    land("plain.csv", '1,"a ""q"", b",A,2002,P,s,m,l\n2,5" disk,A,2002,P,s,m,l\n')
    land("broken.csv", '3,"two\nlines",A,2002,P,s,m,l\n4,after,A,2002,P,s,m,l\n5,x,A,2,P,s,m,l,z\n')
    profile = {
        os.path.basename(row["file_path"]): row["one_line_records"]
        for row in profile_landing(spark, folder).collect()
    }
    assert profile == {"plain.csv": True, "broken.csv": False}
    assert titles(read_landing_csv(spark, folder)) == [
        '5" disk',
        'a "q", b',
        "after",
        "two\nlines",
    ]


def test_a_quote_that_opens_late_in_a_line_is_seen(spark, land, folder):
    land("a.csv", '1,5" disk,"an\nauthor",2002,P,s,m,l\n')
    assert [row["Book-Author"] for row in read_landing_csv(spark, folder).collect()] == [
        "an\nauthor"
    ]


def test_a_file_that_is_not_utf8_is_latin1_as_a_whole(spark, land, folder):
    land("utf.csv", "1,café,A,2002,P,s,m,l\n")
    land("latin.csv", "2,naïve,A,2002,P,s,m,l\n3,plain,A,2002,P,s,m,l\n", "latin1")
    assert titles(read_landing_csv(spark, folder)) == ["café", "naïve", "plain"]


def test_missing_value_tokens(spark, land, folder):
    land("a.csv", '1,NA,n/a,,"",None,x,NaN\n')
    assert list(read_landing_csv(spark, folder).first()) == ["1", *[None] * 5, "x", None]
    assert read_landing_csv(spark, folder, na_tokens=[]).first()["Book-Title"] == "NA"


def test_columns_are_matched_by_each_files_header(spark, land, folder):
    land("a.csv", "1,T,A,2002,P,s,m,l\n")
    land("b.csv", "U,2,x\n", header="Book-Title,ISBN,Unknown\n")
    rows = read_landing_csv(spark, folder).select("ISBN", "Book-Title", "Publisher").collect()
    assert sorted(tuple(row) for row in rows) == [("1", "T", "P"), ("2", "U", None)]


def test_empty_folder_and_empty_file(spark, land, folder):
    land("a.csv", "", header="")
    assert read_landing_csv(spark, folder).count() == 0
    land("b.csv", "")
    assert read_landing_csv(spark, folder).count() == 0
    land("c.csv", "1,T,A,2002,P,s,m,l\n")
    assert read_landing_csv(spark, folder).count() == 1


def test_odd_names_in_subfolders(spark, folder):
    path = os.path.join(folder, "a b [1]")
    os.makedirs(path)
    for name, encoding in (("x {1}.csv", "utf-8"), ("é%20y.csv", "latin1")):
        with open(os.path.join(path, name), "wb") as file:
            file.write((HEADER + "1,é,A,2002,P,s,m,l\n").encode(encoding))
    assert titles(read_landing_csv(spark, folder)) == ["é", "é"]


def test_splits_of_a_large_file_are_read_apart(spark, land, folder):
    rows = "".join(f'{n},"t, {n}",A,2002,P,s,m,l\n' for n in range(20_000))
    land("a.csv", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        records = read_landing_csv(spark, folder)
        assert records.rdd.getNumPartitions() > 2
        assert records.select("ISBN").distinct().count() == records.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def write_rows(path, rows, encoding, line_end):
    with open(path, "w", encoding=encoding, newline="") as file:
        writer = csv.writer(file, lineterminator=line_end)
        writer.writerow(LANDING_CSV_COLUMNS)
        writer.writerows(rows)


def random_rows(rng, count, fields=8):
    def text():
        parts = ["a", "é", '"', ",", "\n", "\n\n", " ", "x" * rng.randrange(300), "5 in"]
        return "".join(rng.choice(parts) for _ in range(rng.randrange(6)))

    return [[f"{n:05d}", *[text() for _ in range(fields - 2)], "end"] for n in range(count)]


@pytest.mark.parametrize("encoding", ["utf-8", "latin1"])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_that_cross_splits(spark, folder, small_splits, encoding, line_end):
    os.makedirs(folder, exist_ok=True)
    rng = random.Random(7)
    expected = []
    for name in ("a.csv", "b.csv"):
        rows = random_rows(rng, 150)
        rows[20] = ["00020", "\n".join(f"line {n}, " * 5 for n in range(200)), *[""] * 5, "end"]
        write_rows(f"{folder}/{name}", rows, encoding, line_end)
        expected += rows
    layouts = _layouts(spark, folder, large=1)
    assert [layout.records for layout in layouts] == [BY_QUOTES]
    records = read_landing_csv(spark, folder, na_tokens=[""], large_file_bytes=1)
    found = sorted([value or "" for value in row] for row in records.collect())
    assert found == sorted(expected)
    assert records.select("Publisher").count() == 300


def test_overlong_records_that_cross_splits(spark, folder, small_splits):
    os.makedirs(folder, exist_ok=True)
    rows = random_rows(random.Random(3), 80)
    for row in rows[::4]:
        row.append("extra")
    for row in rows[1::4]:
        del row[2:]
    write_rows(f"{folder}/a.csv", rows, "utf-8", "\n")
    found = [row["ISBN"] for row in read_landing_csv(spark, folder, large_file_bytes=1).collect()]
    assert sorted(found) == sorted(row[0] for row in rows if len(row) <= 8)
    assert all_records(spark, folder, large_file_bytes=1).filter("overlong").count() == 20


def test_irregular_quotes_in_splits(spark, folder, small_splits):
    os.makedirs(folder, exist_ok=True)
    lines = [f'{n},5" disk,"two\nlines",2000,P,s,m,{"x" * 100}\n' for n in range(100)]
    with open(f"{folder}/a.csv", "w") as file:
        file.write(HEADER + "".join(lines))
    assert [layout.records for layout in _layouts(spark, folder, large=1 << 30)] == [BY_FILE]
    assert [layout.records for layout in _layouts(spark, folder, large=1)] == [BY_QUOTES]
    found = read_landing_csv(spark, folder, large_file_bytes=1).collect()
    assert len(found) == 100
    assert {(row["Book-Title"], row["Book-Author"]) for row in found} == {('5" disk', "two\nlines")}


def plain_records(text):
    """Records of a CSV text, read character by character as the parser does."""
    records, at, state = [""], 0, "start"
    for c in text:
        if c == "\n" and state != "quoted":
            records.append("")
            state = "start"
            continue
        records[-1] += c
        if state == "quoted":
            state = "closed" if c == '"' else "quoted"
        elif state == "closed" and c == '"':
            state = "quoted"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            state = "rest"
    return [record for record in records if record.strip()]


def irregular(rng, size):
    parts = ['"', '"', ",", "\n", "a", " ", '""', '",', ',"', "xyz"]
    return "".join(rng.choice(parts) for _ in range(size))


@pytest.mark.parametrize("seed", range(3))
def test_records_of_irregular_files(spark, folder, small_splits, seed):
    """Every line finds its record, wherever splits and quotes fall."""
    os.makedirs(folder, exist_ok=True)
    rng = random.Random(seed)
    texts = ["\n".join(irregular(rng, 12) for _ in range(700)) for _ in range(3)]
    for number, text in enumerate(texts):
        with open(f"{folder}/{number}.csv", "w", newline="") as file:
            file.write(text)
    lines = lines_of(spark, folder)
    assert lines.select("file_path", "block_start").distinct().count() > 6
    found = {}
    for row in assemble_records(number_lines(lines)).filter(F.col("text").rlike(r"\S")).collect():
        found.setdefault(row.file_path[-5], []).append((row.record, row.text))
    for number, text in enumerate(texts):
        got = [own.removesuffix("\n") for _, own in sorted(found[str(number)])]
        assert got == plain_records(text), number


@pytest.mark.parametrize("seed", range(4))
def test_irregular_files_have_the_same_rows_at_any_size(spark, land, folder, small_splits, seed):
    rng = random.Random(100 + seed)
    body = "".join(f"{n},{irregular(rng, 6)}\n" for n in range(400))
    land("a.csv", body.removesuffix("\n" * (seed % 2)), header="a,b,c,d\n")
    land("b.csv", '1,"x\ny"\n2,"never closed\n3,4' + "\n" * (seed % 3), header="a,b,c,d\n")
    small = all_records(spark, folder, list("abcd"), na_tokens=[])
    split = all_records(spark, folder, list("abcd"), na_tokens=[], large_file_bytes=0)
    # At the end of a record the parser may drop one of the quotes after a closing quote.
    values = [F.regexp_replace(name, '"+\\z', "").alias(name) for name in "abcd"]
    small, split = (sorted(map(str, df.select(*values).collect())) for df in (small, split))
    assert small == split and len(small) > 50


SPANNING = {
    "crlf": '1,"x\r\ny",A,2002,P,s,m,l\r\n  \r\n2,"a\nb",A,2002,P,s,m,l\r\n',
    "mixed": '1,"x\r\ny",A,2002,P,s,m,l\n2,"a\nb",A,2002,P,s,m,l\r\n3,c,A,2002,P,s,m,l\n',
    "lf": '1,"x\ny",A,2002,P,s,m,l\n2,"a ""q"" b",A,2002,P,s,m,l\n',
    "long": '1,"x\ny",A,2002,P,s,m,l,z\n2,b,A\n3,"c,\nd",A,2002,P,s,m,"l,l"\n',
}


@pytest.mark.parametrize("name", SPANNING)
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_a_file_has_the_same_rows_at_any_size(spark, land, folder, name, encoding):
    end = "\r\n" if name == "crlf" else "\n"
    land("a.csv", SPANNING[name].replace("A", "\xe9"), encoding, HEADER.strip() + end)
    small = sorted(map(tuple, all_records(spark, folder).collect()), key=str)
    split = sorted(map(tuple, all_records(spark, folder, large_file_bytes=0).collect()), key=str)
    assert small == split and len(small) >= 2
    if name != "lf" and name != "long":
        assert "x\r\ny" in {row[1] for row in small}


def test_a_stray_quote_makes_no_long_group(spark, land, folder):
    """A quote within a field opens nothing."""
    land("a.csv", '1,5" disk,A,2002,P,s,m,l\n' + "2,b,A,2002,P,s,m,l\n" * 500 + '3,"x\ny",A,2,P,s,m,l\n')
    records = assemble_records(number_lines(lines_of(spark, folder)))
    assert records.agg(F.max(F.length("text"))).first()[0] == len(HEADER) - 1
    assert records.count() == 503
    assert read_landing_csv(spark, folder, large_file_bytes=0).count() == 502


def test_fields_beyond_stray_quotes_are_counted(spark, land, folder):
    land("a.csv", 'x,5" disk,7" tape,y,z\n1,a,b,c\n', header="a,b,c,d\n")
    rows = read_landing_csv(spark, folder, columns=list("abcd")).collect()
    assert [tuple(row) for row in rows] == [("1", "a", "b", "c")]


@pytest.mark.parametrize("text", ["", "\n", "  \n\n"])
def test_a_file_without_a_header_has_no_rows(spark, land, folder, text):
    land("a.csv", text, header="")
    land("b.csv", "1,T,A,2002,P,s,m,l\n")
    assert titles(read_landing_csv(spark, folder)) == ["T"]


def test_blank_lines_and_repeated_names(spark, land, folder):
    land("a.csv", "\na,b,a\n1,2,3\n   \n4,5,6\n", header="")
    rows = read_landing_csv(spark, folder, columns=["a", "b", "a.1"], na_tokens=[]).collect()
    assert sorted(map(tuple, rows)) == [("1", "2", "3"), ("4", "5", "6")]


def test_a_very_wide_line_is_skipped(spark, land, folder):
    land("a.csv", "1,T,A,2002,P,s,m,l\n" + "," * 30_000 + "\n")
    assert titles(read_landing_csv(spark, folder)) == ["T"]


def test_odd_file_names(spark, land, folder):
    land("a b[1]{x}%20.csv", "1,T,A,2002,P,s,m,l\n")
    assert titles(read_landing_csv(spark, folder)) == ["T"]
