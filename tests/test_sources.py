import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from casefile.sources import contracts, readers, writers


def test_quoted_extract_roundtrip(spark, tmp_path):
    rows = [("1", 'a "quoted", text'), ("2", "two\nlines"), ("3", None), ("4", "  blanks  ")]
    frame = spark.createDataFrame(rows, "id string, text string")
    writers.export(frame, str(tmp_path / "t.csv.gz"), fmt="csv.gz")
    read = readers.read_extract(spark, str(tmp_path / "t.csv.gz"), ["id", "text"], multi_line=True)
    assert sorted(map(tuple, read.collect())) == rows


def test_header_is_part_of_the_contract(spark, tmp_path):
    path = tmp_path / "t.csv.gz"
    with gzip.open(path, "wt") as handle:
        handle.write("b,a\n1,2\n")
    assert readers.header_columns(spark, str(path)) == ["b", "a"]
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_extract(spark, str(path), ["a", "b"]).collect()


def test_named_rows_of_wrong_length_are_filled_cut_and_counted(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b,c\n1,2,3\n4,5\n6\n7,8,9,10\n")
    layout = [("first", "a"), ("last", "c")]
    rows = sorted(map(tuple, readers.read_named(spark, str(path), layout).collect()))
    assert rows == [("1", "3"), ("4", ""), ("6", ""), ("7", "9")]
    assert tuple(readers.count_irregular(spark, str(path), layout).first()) == (4, 3)


def test_positional_rows_of_wrong_length_are_kept_apart(spark, tmp_path):
    path = tmp_path / "raw.txt"
    path.write_bytes('1\tCitro\xebn \t"x\t\n2\tshort\n\n3\ta\tb\tc\textra\r\n4\t \t\tend\n'.encode("latin-1"))
    good, malformed = readers.read_positional(spark, str(path), [("id", 0), ("make", 1), ("last", 3), ("note", 2)], 4)
    assert sorted(map(tuple, good.collect())) == [("1", "Citroën", "", '"x'), ("4", "", "end", "")]
    assert sorted(r["line"] for r in malformed.collect()) == ["", "2\tshort", "3\ta\tb\tc\textra"]
    assert tuple(readers.count_fields(spark, str(path), 4).first()) == (5, 3)
    with pytest.raises(ValueError, match="3 malformed"):
        readers.require_well_formed(malformed, "raw")


def test_named_columns(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('Year,State,"Type"\n2020, Ohio ,\n')
    read = readers.read_named(spark, str(path), [("state", "State"), ("kind", "Type")])
    assert [tuple(r) for r in read.collect()] == [("Ohio", "")]
    with pytest.raises(ValueError, match="Nope"):
        readers.read_named(spark, str(path), [("x", "Nope")])


def test_manifest_document(spark, tmp_path):
    path = tmp_path / "manifest.json"
    extract = {"table_name": "t", "source_id": "s", "rows": 2, "columns": ["a", "b"], "output_file": "t.csv.gz"}
    path.write_text(json.dumps({"project": "p", "extracts": [extract, {**extract, "table_name": "u"}]}, indent=1))
    rows = readers.read_manifest(spark, str(path)).orderBy("table_name").collect()
    assert [(r["table_name"], r["columns"], r["rows"]) for r in rows] == [("t", ["a", "b"], 2), ("u", ["a", "b"], 2)]


def test_checksums_of_one_file_and_of_parts(spark, tmp_path):
    one = tmp_path / "one.csv.gz"
    one.write_bytes(b"one")
    parts = tmp_path / "many.csv.gz"
    parts.mkdir()
    (parts / "part-0.csv.gz").write_bytes(b"same")
    (parts / "part-1.csv.gz").write_bytes(b"same")
    found = writers.extract_checksums(readers.file_checksums(spark, str(tmp_path)))
    sums = {r["output_file"]: r["output_sha256"] for r in found.collect()}
    assert sums["one.csv.gz"] == hashlib.sha256(b"one").hexdigest()
    same = hashlib.sha256(b"same").hexdigest()
    named = [int(hashlib.sha256(f"part-{i}.csv.gz|{same}".encode()).hexdigest(), 16) for i in range(2)]
    assert sums["many.csv.gz"] == f"{named[0] ^ named[1]:064x}"


def test_large_files_are_digested_while_they_are_read(spark, tmp_path):
    """Byte by byte, packed or not, in one task each although Spark would split them; and none is left out."""
    block = hashlib.sha256(b"x").digest() * 40_000
    contents = {
        "plain.bin": block, "ends.bin": block + b"\n", "blank.bin": b"\n\n" + block + b"\r\n\n", "marked.csv": b"\xef\xbb\xbfa\r\n" + block,
        "marked_ends.csv": b"\xef\xbb\xbf" + block + b"\n", "packed.csv.gz": gzip.compress(block + b"\n" + block[::-1]), "lines.bin": b"\n" * 1_100_000,
        "no_suffix": block, "small.bin": b"small\n", "in a folder 100%/part.csv.gz": gzip.compress(b"a\n") + b"\n" * 1_100_000,
    }
    (tmp_path / "in a folder 100%").mkdir()
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        bound = 50_000
        frame = readers.file_checksums(spark, str(tmp_path), streamed_from=bound)
        found = {r["path"]: (r["file_name"], r["sha256"], r["bytes"]) for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(len(c) >= bound for c in contents.values()) >= 8
    assert found == {
        f"file:{tmp_path}/{name}": (name.split("/")[-1], hashlib.sha256(c).hexdigest(), len(c)) for name, c in contents.items()
    }


def test_a_file_beyond_the_binary_source_has_a_checksum(spark, tmp_path):
    """Spark refuses to read a file above `maxLength` (2 GB at most) as one value."""
    (tmp_path / "large.bin").write_bytes(b"large\n" * 30_000)
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        row = readers.file_checksums(spark, str(tmp_path), streamed_from=100_000).first()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert row["sha256"] == hashlib.sha256(b"large\n" * 30_000).hexdigest()


def test_replace_changes_the_schema_and_append_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace(spark.range(3), path)
    writers.replace(spark.range(2).select(F.col("id").cast("string").alias("name")), path)
    assert spark.read.parquet(path).columns == ["name"]
    writers.append(spark.createDataFrame([("x",)], "name string"), path)
    assert spark.read.parquet(path).count() == 3


def test_contract_shapes():
    assert [len(c) for c in contracts.CONTRACTS.values()] == [22, 18, 11, 14, 37, 27, 5]
    for table in contracts.RAW_LAYOUTS:
        assert len(contracts.raw_layout(table)) == len(contracts.CONTRACTS[table])
    for columns in contracts.CONTRACTS.values():
        assert set(columns).isdisjoint(contracts.FORBIDDEN_COLUMNS)
