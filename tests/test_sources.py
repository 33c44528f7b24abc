import gzip
import json

import pytest

from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT
from tallyshelf.operators.chunks import distinct_rows
from tallyshelf.sources.accounts import account_list, landing_folder, scan_report
from tallyshelf.sources.flat_files import scan_flat_files, write_flat_files
from tallyshelf.sources import stored
from tallyshelf.sources.stored import ARRAY_FOLDERS, records_from_text, scan_records, scan_stored, write_arrays, write_records
from tests.tables import listed


def put(path, text, encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode(encoding)) if path.suffix == ".gz" else text.encode(encoding))
    return str(path)


def test_latin1_quotes_zip_and_blank_lines(spark, tmp_path):
    text = 'sku\tproduct-name\tquantity\n001\tcafé "x"\t1\n\n2\t"say ""hi""\tnow"\t2\r\n'
    for name in ("a.txt", "b.txt.gz"):
        found = scan_flat_files(spark, put(tmp_path / name, text))
        assert listed(found.rows, "*") == [("001", 'café "x"', "1"), ("2", 'say "hi"\tnow', "2")]
        assert found.rejected.count() == 0


def test_short_lines_are_filled_long_ones_rejected(spark, tmp_path):
    found = scan_flat_files(spark, put(tmp_path / "a.txt", 'a\tb\tc\n1\t2\n1\t2\t3\t4\n1\t"2\tx"\t3\n1\n'))
    assert listed(found.rows, "*") == [("1", "2", None), ("1", "2\tx", "3"), ("1", None, None)]
    assert listed(found.rejected, "line") == [("1\t2\t3\t4",)]
    assert (found.rows.count(), found.rejected.count()) == (3, 1)
    assert listed(found.rows, "b") == [("2",), ("2\tx",), (None,)]


def test_headers_in_another_order_or_with_other_columns(spark, tmp_path):
    put(tmp_path / "in" / "a.txt", "sku\tquantity\na\t1\n")
    put(tmp_path / "in" / "b.txt", "quantity\tsku\n2\tb\n")
    put(tmp_path / "in" / "c.txt", "quantity\tsku\tnote\n3\tc\tx\n")
    put(tmp_path / "in" / "d.txt", "sku\tquantity\n")
    put(tmp_path / "in" / "e.txt", "")
    put(tmp_path / "in" / "_SUCCESS", "ignored")
    rows = scan_flat_files(spark, str(tmp_path / "in")).rows
    assert sorted(listed(rows, "sku", "quantity", "note")) == [("a", "1", None), ("b", "2", None), ("c", "3", "x")]


def test_null_tokens_in_every_column(spark, tmp_path):
    path = put(tmp_path / "a.txt", "sku\tcity\tnote\nNA\tNone\t\nnull\tN/A\t n/a\n#N/A\t0\t00\n")
    assert listed(scan_flat_files(spark, path).rows, "*") == [(None, None, None), (None, None, " n/a"), (None, "0", "00")]
    assert listed(scan_flat_files(spark, path, null_tokens=()).rows, "sku") == [("NA",), ("null",), ("#N/A",)]


def test_repeated_and_empty_headers(spark, tmp_path):
    rows = scan_flat_files(spark, put(tmp_path / "a.txt", "sku\tSKU\t\nx\ty\tz\n")).rows
    assert rows.columns == ["sku", "SKU.1", "Unnamed: 2"]
    assert listed(distinct_rows(rows), "*") == [("x", "y", "z")]


def test_no_files(spark, tmp_path):
    put(tmp_path / "in" / "e.txt", "")
    with pytest.raises(FileNotFoundError):
        scan_flat_files(spark, str(tmp_path / "in"))


def test_report_types_and_accounts_from_folders(spark, tmp_path):
    put(tmp_path / ORDERS_REPORT / f"{ACCOUNT}=007" / "a.txt", "sku\tquantity\na\t1\n")
    put(tmp_path / INVENTORY_REPORT / f"{ACCOUNT}=ab" / "x.txt.gz", "sku\tafn-fulfillable-quantity\na\t5\n")
    assert listed(scan_report(spark, str(tmp_path)).rows, ACCOUNT, "sku", "quantity") == [("007", "a", "1")]
    assert listed(scan_report(spark, str(tmp_path), INVENTORY_REPORT).rows, ACCOUNT, "sku") == [("ab", "a")]
    assert landing_folder({ORDERS_REPORT: "/x"}) == "/x"
    with pytest.raises(ValueError):
        landing_folder("/x", "OTHER")


def test_stored_by_suffix(spark, tmp_path):
    assert listed(scan_stored(spark, put(tmp_path / "a.csv", "x,y\n1,é\n", "utf-8")), "x", "y") == [("1", "é")]
    assert listed(scan_stored(spark, put(tmp_path / "a.tsv", "x\ty\n1\t2,3\n")), "y") == [("2,3",)]
    assert listed(scan_stored(spark, put(tmp_path / "a.txt", "one\ntwo\n")), "value") == [("one",), ("two",)]
    with pytest.raises(TypeError):
        scan_stored(spark, str(tmp_path / "a.pdf"))


def test_records(spark, tmp_path):
    rows = [{"sku": "001", "quantity": 2, "note": None}, {"sku": 7, "quantity": 1.5}]
    path = put(tmp_path / "a.json", json.dumps(rows), "utf-8")
    assert sorted(listed(scan_records(spark, path), "sku", "quantity")) == [("001", "2"), ("7", "1.5")]
    assert listed(scan_records(spark, path, ["note", "sku"]), "*") == [(None, "001"), (None, "7")]
    table = spark.createDataFrame([("ab", json.dumps(rows)), ("cd", "[]")], f"{ACCOUNT} string, body string")
    assert listed(records_from_text(table, "body", ["sku", "quantity"], keep=[ACCOUNT]), "*") == [
        ("ab", "001", "2"), ("ab", "7", "1.5"),
    ]


def test_records_keep_null_keys(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "sku string, note string").coalesce(1)
    write_records(df, str(tmp_path / "out"))
    assert [line for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()] == ['{"sku":"a","note":null}']


def test_flat_file_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("ab", "0012", 'q"x\ty'), ("cd", "é", None)], f"{ACCOUNT} string, sku string, note string")
    write_flat_files(df, str(tmp_path / "out"), (ACCOUNT,), "gzip")
    rows = scan_flat_files(spark, str(tmp_path / "out"), partitions=(ACCOUNT,)).rows
    assert sorted(listed(rows, ACCOUNT, "sku", "note")) == [("ab", "0012", 'q"x\ty'), ("cd", "é", None)]


def test_accounts(spark):
    assert sorted(listed(account_list(spark, ["b", "a", "b"]), ACCOUNT)) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        account_list(spark, [])


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.txt", 'sku\tnote\na\t"one\ntwo"\nb\tx\n')
    assert listed(scan_flat_files(spark, path, multi_line=True).rows, "*") == [("a", "one\ntwo"), ("b", "x")]


def test_a_long_first_line_is_read_to_its_end(spark, tmp_path):
    from tallyshelf.sources.files import first_lines

    header = "\t".join(f"column-{i}" for i in range(150_000))
    (tmp_path / "long.txt").write_text(header + "\r\n1\t2\n")
    (found,) = first_lines(spark, [f"file:{tmp_path}/long.txt"], "utf-8").values()
    assert len(header) > 1 << 20 and found == header


def test_arrays_are_bounded_and_read_back_whole(spark, tmp_path):
    path = str(tmp_path / "arrays")
    rows = spark.range(1000, numPartitions=3).selectExpr("if(id < 990, 'a', 'b') AS account_name", "concat('s', id) AS sku", "cast(id AS double) / 4 AS units")
    write_arrays(rows, path, ["account_name"], 50)
    held = [len(json.loads(p.read_text())) for p in (tmp_path / "arrays").rglob("*.txt")]
    assert sum(held) == 1000 and max(held) <= 50
    assert {p.name for p in (tmp_path / "arrays").iterdir() if p.is_dir()} == {"part=a", "part=b"}
    got = scan_records(spark, path, rows.columns).drop(*ARRAY_FOLDERS)
    want = rows.selectExpr("account_name", "sku", "cast(units AS string) AS units")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_array_files_are_read_as_the_file_reader_does(spark, tmp_path, monkeypatch):
    texts = {"array": '[{"a": 1.50, "b": "x"}, {"b": 1e3, "c": 1}]', "object": '{"a": true}', "none": "[]", "blank": " \n", "empty": "", "bad": '{"a": ', "null": '[{"a": null}]'}
    for name, text in texts.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "one.json").write_text(text)
        got = scan_records(spark, str(folder), ["a", "b"])
        with monkeypatch.context() as m:
            m.setattr(stored, "WHOLE_BYTES", -1)
            want = scan_records(spark, str(folder), ["a", "b"])
        assert got.columns == want.columns and listed(got, "*") == listed(want, "*"), name
    assert listed(scan_records(spark, str(tmp_path / "array"), ["a", "b"]), "*") == [("1.50", "x"), (None, "1e3")]


def test_rows_that_are_not_gathered_are_written_where_they_are(spark, tmp_path):
    df = spark.range(40, numPartitions=4).selectExpr(f"concat('A', id % 2) AS {ACCOUNT}", "cast(id AS string) AS sku")
    for gather, files in ((True, 2), (False, 8)):
        path = str(tmp_path / str(gather))
        write_flat_files(df, path, (ACCOUNT,), gather=gather)
        got = scan_flat_files(spark, path, partitions=(ACCOUNT,)).rows
        assert len(got.inputFiles()) == files and sorted(got.select(ACCOUNT, "sku").collect()) == sorted(df.collect())
