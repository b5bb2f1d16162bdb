"""Column types over whole files, headers by place, records over lines, broken files of a list, and patch chains."""

import pytest
from conftest import rows
from ecospark.operators import joins, windows
from ecospark.sources import delimited, tables, types
from pyspark.sql import functions as F


def test_lattice_of_cells(spark):
    cells = {"a": ["TRUE", None, "F"], "b": ["1", "-7", ""], "c": ["1", "2.5", "1e3"], "d": ["2020-01-01", None, "2020-02-29"],
             "e": ["2020-01-01", "2020-02-30", "x"], "f": ["1", "TRUE", None], "g": ["007", "1", "2"], "h": [None, "", None],
             "i": ["1", "2020-01-01", None], "j": ["99999999999999999999", "1", None], "k": [" 5 ", "6", None]}
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    assert types.infer(df) == {"a": "boolean", "b": "bigint", "c": "double", "d": "date", "e": "string", "f": "string", "g": "string",
                               "h": "boolean", "i": "string", "j": "double", "k": "bigint"}
    assert types.infer(df, types.LEADING_ZEROS)["g"] == "bigint"
    assert [r.b for r in types.typed(df).collect()] == [1, -7, None]
    assert [r.k for r in types.typed(df).collect()] == [5, 6, None]


def test_a_late_odd_cell_makes_the_column_text(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("n\tlate\n" + "".join(f"{i}\t{i}\n" for i in range(50_000)) + "1\todd\n")
    df = delimited.read_tsv(spark, str(p))
    assert dict(df.dtypes) == {"n": "bigint", "late": "string"}
    assert dict(delimited.read_tsv(spark, str(p), typed=False).dtypes)["n"] == "string"


def test_european_types(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("a;b;c\n1,5;1.234,5;1\n2;NA;x\n")
    df = delimited.read_csv2(spark, str(p))
    assert dict(df.dtypes) == {"a": "double", "b": "double", "c": "string"} and rows(df, "a", "b") == [(1.5, 1234.5), (2.0, None)]


def test_records_over_lines(spark, tmp_path, monkeypatch):
    p = tmp_path / "m.csv"
    p.write_text('a,b\n1,"line one\nline ""two"", x"\n2,y\n')
    assert rows(delimited.read_csv(spark, str(p))) == [(1, 'line one\nline "two", x'), (2, "y")]
    assert rows(delimited.read_sheet(spark, str(p)), "c1") == [("1",), ("2",)]
    monkeypatch.setattr(delimited, "ONE_TASK", 10)
    with pytest.raises(ValueError, match="multi_line"):
        delimited.read_csv(spark, str(p))
    assert delimited.read_csv(spark, str(p), multi_line=True).count() == 2


def test_lines_by_place_and_columns_by_name(spark, tmp_path):
    (tmp_path / "1.tsv").write_text("a\tb\n1\tx\n\t\na\tb\n\x01 y\tz\n")
    (tmp_path / "2.tsv").write_text("b\ta\tc\nq\t7\t8\n\n")
    df = delimited.read_fread(spark, str(tmp_path / "*.tsv"))
    assert df.columns == ["a", "b", "c"]
    assert rows(df) == [("", "", None), ("\x01 y", "z", None), ("1", "x", None), ("7", "q", 8), ("a", "b", None)]


def test_header_is_found_in_split_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.tsv").write_text("v\tw\n" + "".join(f"{k}\t{i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = delimited.read_fread(spark, str(tmp_path / "*.tsv"))
        assert df.rdd.getNumPartitions() > 6 and df.count() == 60_000 and dict(df.dtypes) == {"v": "bigint", "w": "bigint"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_wide_counts_of_files_with_other_headers(spark, tmp_path):
    (tmp_path / "1.tsv").write_text("cluster\ts1\ts2\nc1\t1\t0\n\t2\t\n")
    (tmp_path / "2.tsv").write_text("s3\tcluster\ts1\n5\tc2\t6\n")
    df = delimited.read_wide_counts(spark, str(tmp_path / "*.tsv"), "cluster")
    assert rows(df) == [("", "s1", 2), ("c1", "s1", 1), ("c2", "s1", 6), ("c2", "s3", 5)]


def test_a_broken_file_costs_its_own_rows(spark, tmp_path, monkeypatch):
    for k in range(3):
        spark.createDataFrame([(k, f"n{k}")], "id int, name string").coalesce(1).write.parquet(str(tmp_path / f"t{k}"))
    whole = next((tmp_path / "t1").glob("*.parquet"))
    whole.write_bytes(whole.read_bytes()[:100])
    (tmp_path / "t1" / f".{whole.name}.crc").unlink()
    df = tables.read_table_list(spark, str(tmp_path), "id long, name string, more double")
    good, lost = df.where("error IS NULL"), df.where("error IS NOT NULL").collect()
    assert rows(good, "id", "name", "more") == [(0, "n0", None), (2, "n2", None)]
    assert len(lost) == 1 and whole.name in lost[0].file and lost[0].id is None
    monkeypatch.setattr(tables, "MOST_BYTES", 10)
    assert tables.read_table_list(spark, str(tmp_path), "id long").where("error LIKE '%more than%'").count() == 3


def test_patch_chain_equals_patches_in_turn(spark):
    x = spark.createDataFrame([(1, "a", None, None), (2, None, 5.0, "q"), (None, None, None, None)], "k int, s string, v double, t string")
    ys = [spark.createDataFrame([(1, "z", 1.0), (9, "y", 2.0)], "k int, s string, v double"),
          spark.createDataFrame([(1, 7.0, "first"), (2, 8.0, "no"), (None, None, "null key")], "k int, v double, t string"),
          spark.createDataFrame([(2, "late"), (None, "late too")], "k int, s string")]
    want = x
    for y in ys:
        want = joins.patch(want, y, ["k"])
    got = joins.patch_chain(x, ys, ["k"])
    assert got.columns == x.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Window" not in plan
    assert rows(joins.patch_chain(x, [], ["k"])) == rows(x)


def test_patch_chain_fails_on_a_key_that_is_there_twice(spark):
    x = spark.createDataFrame([(1, None)], "k int, v int")
    y = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    once = spark.createDataFrame([(1, 2)], "k int, v int")
    assert rows(joins.patch_chain(x, [once, once], ["k"])) == [(1, 2)]
    with pytest.raises(Exception, match="not unique"):
        joins.patch_chain(x, [once, y], ["k"]).select("k").collect()


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 4).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("o"), F.col("id").alias("v"))
    out = windows.first_per_group(df, ["k"], ["o"])
    assert rows(out) == [(0, 0, 0), (1, 0, 7), (2, 0, 14)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan
