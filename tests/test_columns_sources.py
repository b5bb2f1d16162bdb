import os
import random

import pytest
from pyspark.sql import functions as F
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import columns
from ecospark.sources import delimited, sinks


def test_clean_names():
    assert columns.clean_names(["sampleID_LAB", "Main feeding niche", "...6", "Total (%)", "Ab", "aB", "höhe"]) == [
        "sample_id_lab", "main_feeding_niche", "x6", "total_percent", "ab", "a_b", "hohe"]
    assert columns.clean_names(["a", "A", "a"]) == ["a", "a_2", "a_3"]


def test_ordinal_regex_reorder(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, length_min int, main_x int, z int")
    assert columns.select_ordinal(df, [-4]).columns == ["a", "length_min", "main_x"]
    assert columns.select_ordinal(df, range(2, 4)).columns == ["length_min", "main_x"]
    assert columns.select_matching(df, "main|LENGTH").columns == ["length_min", "main_x"]
    assert columns.drop_matching(df, ["main", "length"]).columns == ["a", "z"]
    assert columns.reorder_first(df, "z", "main_x").columns == ["z", "main_x", "a", "length_min"]
    assert columns.rename_ordinal(df, 1, "cluster").columns[0] == "cluster"


def test_csv2_reader(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text("Taxon;Length Min;Length Max;Reference\nColeoptera Carabidae ;2,5;18;r1\n"
                 "Heteroptera Miridae;1;n/a;r2\nProtura;0,5;2;NA\n")
    df = delimited.read_csv2(spark, str(p), numeric=["length_min", "length_max"])
    assert df.columns == ["taxon", "length_min", "length_max", "reference"]
    assert rows(df, "length_min", "length_max", "reference") == [(0.5, 2.0, None), (1.0, None, "r2"), (2.5, 18.0, "r1")]


def test_row_number_and_header_promotion(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    lines = ["junk,junk,junk", "Higher Taxon,Family,Score"] + [f"o{i},f{i},{i}" for i in range(1, 30)]
    p.write_text("\n".join(lines) + "\n")
    raw = spark.read.schema("a string, b string, c string").csv(str(p))
    numbered = delimited.with_row_number(raw, "_row")
    assert [r._row for r in numbered.orderBy("_row").collect()] == list(range(1, 32))
    sheet = delimited.promote_header(numbered, 2)
    sheet = columns.clean_columns(delimited.drop_row_range(sheet, 3, 5).drop("_row"))
    assert sheet.columns == ["higher_taxon", "family", "score"]
    got = [int(r.score) for r in sheet.collect()]
    assert sorted(got) == [i for i in range(1, 30) if not 3 <= i <= 5]


def test_row_number_ordered_is_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("k", (F.col("id") * 7919) % 1000)
    out = delimited.with_row_number(df, "_row", order_by=["k"])
    got = [(r.k, r._row) for r in out.collect()]
    assert sorted(r for _, r in got) == list(range(1, 1001))
    assert all(k + 1 == r for k, r in got)


def test_csv_sink_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="ecospark-sink-")
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "k int, s string, x double")
    path = os.path.join(d, "out")
    sinks.write_csv(df, path)
    back = delimited.read_csv(spark, path)
    assert rows(back.select(F.col("k").cast("int"), "s", F.col("x").cast("double"))) == [(1, "a", None),
                                                                                         (2, None, 2.5)]


def test_fread_keeps_blanks(spark, tmp_path):
    p = tmp_path / "meta.tsv"
    p.write_text('sampleID_NGI\tlab_sample_type\tnote\nP1\tsample\t\nP2\tNA\t"a ""b"""\nP3\t\tNA\n')
    df = delimited.read_fread(spark, str(p))
    assert df.columns == ["sample_id_ngi", "lab_sample_type", "note"]
    assert rows(df) == [("P1", "sample", ""), ("P2", None, 'a "b"'), ("P3", "", None)]


def test_write_csv_r_style(spark, tmp_path):
    # the sample line of the shipped report (FIXTURES.md A): "1","Blattodea","Blaberidae",2.5,75,NA,NA,TRUE,1,1,10
    df = spark.createDataFrame([("Blattodea", "Blaberidae", 2.5, 75.0, None, None, True, 1, 1, 10),
                                ("Hymenoptera", 'Ichneu"monidae', 3.0, 40.0, "Predator", None, True, 3743, 199,
                                 51514066)],
                               "higher_taxon string, Family string, length_min double, length_max double, "
                               "main_feeding_niche string, main_feeding_habitat string, "
                               "in_checklist boolean, n_otu int, n_obs int, reads long")
    path = str(tmp_path / "out")
    sinks.write_csv_r(df, path, order_by=["reads"])
    lines = []
    for f in sorted(os.listdir(path)):
        if f.endswith(".csv"):
            lines += open(os.path.join(path, f)).read().splitlines()
    header = [ln for ln in lines if ln.startswith('"",')]
    body = sorted(ln for ln in lines if not ln.startswith('"",'))
    assert header[0] == ('"","higher_taxon","Family","length_min","length_max","main_feeding_niche",'
                         '"main_feeding_habitat","in_checklist","n_otu","n_obs","reads"')
    assert body == ['"1","Blattodea","Blaberidae",2.5,75,NA,NA,TRUE,1,1,10',
                    '"2","Hymenoptera","Ichneu""monidae",3,40,"Predator",NA,TRUE,3743,199,51514066']


def test_write_csv_r_numbers_a_sorted_frame_consecutively(spark, tmp_path):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k")).orderBy("k")
    path = str(tmp_path / "sorted")
    sinks.write_csv_r(df, path, [F.desc("k")])
    lines = []
    for f in sorted(f for f in os.listdir(path) if f.endswith(".csv")):
        lines += open(os.path.join(path, f)).read().splitlines()[1:]
    assert lines == [f'"{i}",{5000 - i}' for i in range(1, 5001)]
    with pytest.raises(ValueError):
        sinks.write_csv_r(df, path, [])


def test_numbers_as_r_prints_them(spark):
    cases = {75.0: "75", 0.1 + 0.2: "0.3", 12345678.5: "12345678.5", 1e5: "1e+05", 123456.0: "123456", 1e-4: "1e-04",
             0.0001234: "0.0001234", 1e15: "1e+15",
             -2.5: "-2.5", 0.0: "0", 1e-300: "1e-300", 100.0: "100", 3e10: "3e+10", 1234.5678: "1234.5678"}
    df = spark.createDataFrame([(x,) for x in [*cases, float("nan"), float("inf"), None]], "x double")
    got = [r[0] for r in df.select(sinks.r_number(F.col("x"))).collect()]
    assert got == [*cases.values(), None, None, None]


def test_header_goes_by_place_and_equal_rows_stay(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"f{k}.tsv").write_text(f"a\tb\n{k}\tx\na\tb\n{k}\tNA\n")
    df = delimited.read_fread(spark, str(tmp_path / "*.tsv"))
    assert rows(df) == [("1", None), ("1", "x"), ("2", None), ("2", "x"), ("a", "b"), ("a", "b")]


def test_wide_counts_tolerate_cells(spark, tmp_path):
    p = tmp_path / "w.tsv"
    p.write_text('cluster\tS 1\tp2\tP3\tp4\tp5\nc1\t12.0\t\tNA\t1e+05\t"7"\nc2\t0\tx\t3\t-1\n"c3"\t5\t0\t0\t0\t2.9\n')
    df = delimited.read_wide_counts(spark, str(p), "cluster")
    assert rows(df) == [("c1", "S 1", 12), ("c1", "p4", 100000), ("c1", "p5", 7), ("c2", "P3", 3), ("c3", "S 1", 5), ("c3", "p5", 2)]
    assert {r.sample for r in delimited.read_wide_counts(spark, str(p), "cluster", clean=True).collect()} >= {"s_1", "p3"}


def test_wide_counts_plan_does_not_grow(spark, tmp_path):
    sizes = []
    for n in (10, 2500):
        p = tmp_path / f"w{n}.tsv"
        p.write_text("\n".join(["cluster\t" + "\t".join(f"s{i}" for i in range(n))] +
                               [f"c{k}\t" + "\t".join(str((k * i) % 3) for i in range(n)) for k in range(60)]) + "\n")
        df = delimited.read_wide_counts(spark, str(p), "cluster")
        assert df.count() == sum((k * i) % 3 > 0 for k in range(60) for i in range(n))
        plan = df._jdf.queryExecution().analyzed().toString()
        assert plan.count("Relation") == 1
        sizes.append(plan.count("AS "))
    assert sizes[0] == sizes[1]


def test_sheet_keeps_quoted_text(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('x,y,z\n"Dip ""x"", y",Fam,1\n')
    assert rows(delimited.read_sheet(spark, str(p))) == [('Dip "x", y', "Fam", "1")]


def test_wide_counts_equal_python_and_leave_blanks_out(spark, tmp_path, monkeypatch):
    """Cells by their bytes against splitting in Python; what is empty never becomes a row of an explode."""
    monkeypatch.setattr(delimited, "SEARCHED", 200)
    rnd = random.Random(3)
    texts = ["0", "", "NA", "N", "A", "NB", "AN", "00", "7", "12.0", "3e+02", "é", '"5"', "-1"]
    want = []
    for n, head in enumerate((["cluster", "s1", "s2", "s3"], ["s2", "cluster", "sé"], ["x", "y", "z", "cluster"])):
        lines = ["\t".join(head)]
        for k in range(80):
            cells = [rnd.choice(texts) for _ in range(rnd.randint(1, 6))]
            if "cluster" in head[:len(cells)]:
                cells[head.index("cluster")] = f"ç{n}-{k}"
            if not any(cells):
                continue
            lines.append("\t".join(cells))
            name = cells[head.index("cluster")] if head.index("cluster") < len(cells) else None
            worth = {"00": 0, "7": 7, "12.0": 12, "3e+02": 300, '"5"': 5}
            want += [(name, s, worth[c]) for s, c in zip(head, cells) if s != "cluster" and worth.get(c)]
        (tmp_path / f"f{n}.tsv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    df = delimited.read_wide_counts(spark, str(tmp_path / "*.tsv"), "cluster")
    assert rows(df) == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "split(value" not in plan
