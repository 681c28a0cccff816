"""Readers and writers on small files."""

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimsieve.bindings.queries import staged_inventory
from claimsieve.sinks.writers import export_csv, register_views, write_table
from claimsieve.sources.layout import Layout
from claimsieve.sources import quoted_csv, readers
from claimsieve.sources.json_arrays import pieces
from claimsieve.sources.readers import read_csv, read_export, read_raw, rows_per_file, staged_files
from claimsieve.sources.specs import CLAIMS, DISEASES, SUBGROUPS
from tests.comparing import plan_nodes


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_csv_keeps_header_names_blanks_and_text(spark, tmp_path):
    path = put(tmp_path / "d.csv", 'SubGrpID, Disease_ID,Disease_name\r\nS1,007,"a ""b"", c"\nS2, 8 ,\r\n')
    raw = read_raw(spark, DISEASES, path)
    assert raw.columns == ["SubGrpID", " Disease_ID", "Disease_name"]
    assert sorted(map(tuple, raw.collect())) == [("S1", "007", 'a "b", c'), ("S2", " 8 ", None)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path / "s.csv", "Monthly_Premium,extra,SubGrp_id,SubGrp_Name\n10,x,S1,one\n")
    assert read_raw(spark, SUBGROUPS, path).collect() == [("S1", "one", "10")]


def test_csv_without_a_declared_column_is_refused(spark, tmp_path):
    path = put(tmp_path / "s.csv", "SubGrp_id,SubGrp_Name\nS1,one\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_raw(spark, SUBGROUPS, path)


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    put(tmp_path / "two" / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "two" / "b.csv", "y,x\n2,1\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, str(tmp_path / "two")).collect()


def claim(i, **changes):
    fields = {
        "claim_id": i, "patient_id": 100 + i, "disease_name": "Anthrax", "SUB_ID": f"S{i}", "Claim_Or_Rejected": "N",
        "claim_type": "claims", "claim_amount": "10", "claim_date": "2000-01-01",
    }
    return fields | changes


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("lead", ["", "\ufeff", " \n"])
@pytest.mark.parametrize("reader", ["whole", "array"])
def test_json_array_any_layout(spark, tmp_path, indent, lead, reader):
    rows = [claim(i) for i in range(50)]
    rows[3] = dict(reversed(rows[3].items()))
    del rows[4]["claim_type"]
    rows[5]["disease_name"] = 'Ä "quoted" \\ [x], {open'
    path = put(tmp_path / "claims.json", lead + json.dumps(rows, indent=indent))
    raw = read_raw(spark, CLAIMS, path, reader)
    assert raw.columns == CLAIMS.raw_columns
    assert raw.count() == 50
    found = {r.claim_id: r for r in raw.collect()}
    assert found["3"].SUB_ID == "S3"
    assert found["4"].claim_type is None
    assert found["5"].disease_name == 'Ä "quoted" \\ [x], {open'
    assert found["6"].patient_id == "106"


@pytest.mark.parametrize("odd", ["a } b", {"nested": 1}, '"},{"', "]", '\\"}', {"deep": [{"x": "}]"}, {"y": ["{"]}]}])
@pytest.mark.parametrize("action", ["count", "collect"])
def test_json_array_with_braces_inside(spark, tmp_path, odd, action):
    path = put(tmp_path / "claims.json", json.dumps([claim(0), claim(1, disease_name=odd), claim(2)]))
    found = getattr(read_raw(spark, CLAIMS, path), action)()
    if action == "count":
        assert found == 3
    else:
        text = odd if isinstance(odd, str) else json.dumps(odd, separators=(",", ":"))
        assert sorted((r.claim_id, r.disease_name) for r in found) == [("0", "Anthrax"), ("1", text), ("2", "Anthrax")]


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def random_value(rnd, depth=0):
    signs = ['"', "\\", "{", "}", "[", "]", ",", " ", "\n", "é", ":", "x"]
    kind = rnd.random()
    if depth < 3 and kind < 0.25:
        return {"".join(rnd.choices(signs, k=3)) + str(i): random_value(rnd, depth + 1) for i in range(rnd.randrange(3))}
    if depth < 3 and kind < 0.45:
        return [random_value(rnd, depth + 1) for _ in range(rnd.randrange(3))]
    return "".join(rnd.choices(signs, k=rnd.randrange(20)))


@pytest.mark.parametrize("split", [1, 37, 400])
def test_json_arrays_cut_anywhere(spark, tmp_path, small_splits, split):
    """Random nesting, quotes and braces, three files side by side, splits of any size down to one byte."""
    rnd = random.Random(split)
    schema = StructType([StructField(name, StringType()) for name in ("id", "a", "b")])
    expected = []
    for file, count in enumerate([7, 12, 0]):
        rows = [{"id": f"{file}-{i}", "a": random_value(rnd), "b": random_value(rnd)} for i in range(count)]
        put(tmp_path / "in" / f"{file}.json", json.dumps(rows, indent=rnd.choice([None, 1]), ensure_ascii=False))
        expected += [tuple(v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
                           for v in row.values()) for row in rows]
    small_splits(split)
    found = readers.read_json_array(spark, str(tmp_path / "in"), schema)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_json_array_is_scanned_and_shuffled_once(spark, tmp_path, small_splits):
    rows = [claim(i, disease_name={"n": i} if i % 7 == 0 else "x") for i in range(5000)]
    path = put(tmp_path / "claims.json", json.dumps(rows))
    small_splits(100_000)
    kinds = [kind for kind, _ in plan_nodes(read_raw(spark, CLAIMS, path))]
    assert kinds.count("FileSourceScanExec") == 1
    # the pieces, a row per split and depth, the elements of more than one piece
    assert kinds.count("ShuffleExchangeExec") == 3
    assert not [kind for kind in kinds if "Python" in kind or "Arrow" in kind]


def damaged_arrays():
    whole = json.dumps([claim(0), claim(1), claim(12345)])
    first_end = whole.index("}") + 1
    yield from (whole[:cut] for cut in (len(whole) - 1, len(whole) - 2, whole.index("12345") + 2, first_end, first_end + 20))
    yield whole[1:]
    yield whole[1:-1]
    yield whole.replace("}, {", "} {")
    yield whole.replace("}, {", "},, {")
    yield whole + whole


@pytest.mark.parametrize("text", list(damaged_arrays()))
@pytest.mark.parametrize("split", [50, 1 << 20])
def test_damaged_arrays_are_refused(spark, tmp_path, small_splits, text, split):
    path = put(tmp_path / "claims.json", text)
    small_splits(split)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_raw(spark, CLAIMS, path).collect()


def test_one_damaged_file_among_whole_ones_is_refused_by_name(spark, tmp_path):
    for i in range(3):
        put(tmp_path / "in" / f"{i}.json", json.dumps([claim(i)]))
    put(tmp_path / "in" / "cut.json", json.dumps([claim(8), claim(9)])[:-1])
    with pytest.raises((PySparkException, Py4JJavaError), match="cut.json"):
        read_raw(spark, CLAIMS, str(tmp_path / "in")).collect()


def test_no_size_decides_how_an_array_is_read():
    assert not [name for name in vars(readers) if "BYTES" in name or "SIZE" in name]


def test_json_array_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = put(tmp_path / "claims.json", json.dumps([claim(i) for i in range(20_000)]))
    small_splits(200_000)
    assert pieces(spark, path).selectExpr("spark_partition_id() AS p").distinct().count() > 4
    rows = readers.read_json_array(spark, path, CLAIMS.raw_schema)
    assert rows.select("claim_id").distinct().count() == rows.count() == 20_000


@pytest.mark.parametrize("text", ["[]\n", "", " \n", "\ufeff[ \n ]"])
def test_empty_json_array(spark, tmp_path, text):
    put(tmp_path / "in" / "empty.json", text)
    put(tmp_path / "in" / "claims.json", json.dumps([claim(1)]))
    assert read_raw(spark, CLAIMS, str(tmp_path / "in")).count() == 1


def test_json_lines(spark, tmp_path):
    path = put(tmp_path / "claims.json", "\n".join(json.dumps(claim(i)) for i in range(5)))
    assert {r.claim_id for r in read_raw(spark, CLAIMS, path, "lines").collect()} == set("01234")


def test_csv_export_reads_back_unchanged(spark, tmp_path):
    rows = [(1, ' a "b", c '), (2, None), (3, "x,y"), (4, "\\"), (5, "'")]
    rows += [(6, "a\nb"), (7, "\r\n"), (8, "x\ry"), (9, 'q"\n"'), (10, "\n"), (11, "end\r"), (12, "\rstart")]
    export_csv(spark.createDataFrame(rows, "id int, t string"), str(tmp_path / "out"))
    back = read_export(spark, str(tmp_path / "out"))
    assert sorted((int(r.id), r.t) for r in back.collect()) == rows


def test_export_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    rnd = random.Random(5)
    signs = ["a", " ", '"', ",", "\n", "\r", "\r\n", "é", "\\", '""', "\t", "'"]

    def value():
        return rnd.choice([None, "", "x", "\n", '"\n"', "".join(rnd.choices(signs, k=rnd.randrange(12)))])

    rows = [(str(i), value(), value()) for i in range(3000)] + [("long", "b\n" * 4000, '"\n' * 4000)]
    path = str(tmp_path / "out")
    export_csv(spark.createDataFrame(rows, "id string, `t x` string, u string").coalesce(1), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        back = read_export(spark, path)
        assert back.columns == ["id", "t x", "u"]
        assert spark.read.text(path).select(F.spark_partition_id()).distinct().count() > 20
        assert sorted(map(tuple, back.collect())) == sorted(tuple(v or None for v in row) for row in rows)
        assert [kind for kind, text in plan_nodes(back) if "FileScan text" in text] == ["FileSourceScanExec"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_csv_defines_odd_rows(spark, tmp_path):
    put(tmp_path / "some" / "a.csv", 'x,"y\nz"\n1\n\n2,"",3\n"4",\n')
    put(tmp_path / "some" / "b.csv", 'x,"y\nz"\n')
    put(tmp_path / "some" / "c.csv", "")
    rows = quoted_csv.read_quoted_csv(spark, str(tmp_path / "some"), ["x", "y\nz"]).collect()
    assert sorted(map(tuple, rows), key=str) == [("1", None), ("2", None), ("4", None)]
    with pytest.raises(Exception, match="another header"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path / "some"), ["x", "y"]).collect()
    put(tmp_path / "cut.csv", 'x,y\n1,"2\n3,4\n')
    with pytest.raises(Exception, match="a quoted value has no end"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path / "cut.csv"), ["x", "y"]).collect()


def test_staged_files_lists_without_reading(spark, tmp_path):
    write_table(spark.range(10), str(tmp_path / "t" / "one"))
    put(tmp_path / "t" / "two.txt", "hello")
    files = staged_files(spark, str(tmp_path / "t"))
    assert files.columns == ["path", "length", "modificationTime"]
    assert {r.path.rsplit("/", 1)[1]: r.length for r in files.collect()}["two.txt"] == 5
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_rows_per_file(spark, tmp_path):
    write_table(spark.range(10).repartition(2), str(tmp_path / "t"))
    listed = rows_per_file(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sum(row.rows for row in listed) == 10 and len(listed) == 2


def test_inventory_lists_every_file(spark, tmp_path):
    for i in range(4):
        spark.range(i).toPandas().to_parquet(str(tmp_path / f"table {i}_x%.parquet"))
    write_table(spark.range(10).selectExpr("id AS other", "'x' AS more").repartition(3), str(tmp_path / "folder.parquet"))
    put(tmp_path / "deep" / "er" / "notes.txt", "hello")
    listed = readers.inventory(spark, str(tmp_path))
    rows = {row.path.split("/")[-1]: row.rows for row in listed.collect()}
    assert {name: n for name, n in rows.items() if name.startswith("table")} == {f"table {i}_x%.parquet": i for i in range(4)}
    assert sorted(n for name, n in rows.items() if name.startswith("part-")) and sum(
        n for name, n in rows.items() if name.startswith("part-")
    ) == 10
    assert rows["notes.txt"] is None
    scans = [text for kind, text in plan_nodes(listed) if "FileScan parquet" in text]
    assert len(scans) == 1 and "ReadSchema: struct<>" in scans[0]
    whole = {row.file: row.rows for row in staged_inventory(spark, str(tmp_path)).collect()}
    assert whole == {f"table {i}_x%.parquet": i for i in range(4)} | {"folder.parquet": 10, "deep": None}


def test_full_refresh_replaces_rows(spark, tmp_path):
    path = Layout(str(tmp_path)).output("t")
    write_table(spark.range(10), path)
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_views(spark):
    register_views({"numbers": spark.range(4)}, prefix="v_")
    assert spark.sql("SELECT count(*) AS n FROM v_numbers").first().n == 4
