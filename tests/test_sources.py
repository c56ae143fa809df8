"""File sources and sinks on hand-made files."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from salesmart.sinks import tables as sinks
from salesmart.sinks import releases
from salesmart.sources import dump_ranges
from salesmart.sources.copy_dump import CopyDump, scan_copy_dump, unescape, write_copy_dump
from salesmart.sources.csv_files import csv_files, scan_csv_chunks, scan_csv_table
from salesmart.sources.geojson import scan_geojson, scan_geojson_folder, table_for_file


def test_csv_keeps_codes_as_text(spark, tmp_path):
    (tmp_path / "mutation.csv").write_text('coddep,codcomm,anneemut,lib\n01,004,2023,\n2A,005,2024,""\n')
    df = scan_csv_table(spark, str(tmp_path / "mutation.csv"), "mutation")
    assert dict(df.dtypes)["anneemut"] == "bigint"
    assert sorted(tuple(r) for r in df.collect()) == [("01", "004", 2023, None), ("2A", "005", 2024, "")]


def test_csv_quoted_line_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "ann_cgi.csv").write_text('artcgi,libartcgi\n1,"two\nlines"\n2,"say ""hi"", now"\n')
    df = scan_csv_table(spark, str(tmp_path / "ann_cgi.csv"), "ann_cgi")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "two\nlines"), ("2", 'say "hi", now')]


def test_csv_layouts_and_small_files(spark, tmp_path):
    root = tmp_path / "with space" / "csv"
    (root / "mutation").mkdir(parents=True)
    (root / "mutation" / "chunk_001.csv").write_text("idmutation,anneemut\n1,2020\n")
    (root / "mutation" / "chunk_002.csv").write_text("idmutation,anneemut\n2,2021\n3,2021\n")
    (root / "ann_type_local.csv").write_text("codtyploc,libtyploc\n1,Maison\n2,Appartement\n")
    names = {(r.table_name, r.entry) for r in csv_files(spark, str(root)).collect()}
    assert names == {("mutation", "mutation"), ("ann_type_local", "ann_type_local.csv")}
    assert csv_files(spark, f"file://{root}/").count() == 3
    found = scan_csv_chunks(spark, str(root))
    assert found["mutation"].count() == 3 and found["ann_type_local"].count() == 2


def test_csv_permuted_header_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "t" / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception):
        scan_csv_table(spark, str(tmp_path / "t"), "disposition").collect()


def test_csv_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("", 'q"x'), ("l", "b\\c,d")], "u string, v string")
    path = str(tmp_path / "out.csv")
    assert sinks.write_csv_export(df, path) == 3
    back = scan_csv_table(spark, path, "disposition")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def _collection(features):
    return json.dumps({"type": "FeatureCollection", "features": features})


def test_geojson(spark, tmp_path):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    text = _collection([
        {"type": "Feature", "properties": {"code": "01", "nom": "Ain", "zone": 4}, "geometry": square},
        {"type": "Feature", "properties": {"code": "2A", "nom": "Corse"}, "geometry": None},
        {"type": "Feature", "properties": None, "geometry": square},
        {"type": "Feature", "properties": {"code": "04", "nom": "x"}, "geometry": {}},
    ])
    (tmp_path / "departements-1000m.geojson").write_text(text)
    (tmp_path / "unknown.geojson").write_text(text)
    (tmp_path / "communes.geojson").write_text('{"type":"FeatureCollection"}')
    rows = scan_geojson(spark, str(tmp_path / "departements-1000m.geojson")).collect()
    assert [r.code for r in rows] == ["01", "2A", None, "04"]
    assert json.loads(rows[0].geometry) == square
    assert rows[1].geometry is None and rows[3].geometry is None
    found = scan_geojson_folder(spark, str(tmp_path))
    assert sorted(found) == ["geo_communes", "geo_departments"]
    assert found["geo_communes"].count() == 0 and found["geo_departments"].count() == 4
    assert table_for_file("x/communes-1000m.geojson") == "geo_communes" and table_for_file("a.geojson") is None


def test_unescape(spark):
    cases = {r"\N": None, "": "", r"a\tb": "a\tb", r"a\\tb": r"a\tb", r"\\": "\\", r"\\\\n": r"\\n",
             r"x\ny\\": "x\ny\\", r"\\\t": "\\\t", "plain": "plain"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.u for r in df.select("v", unescape(F.col("v")).alias("u")).collect()}
    assert got == cases


def _dump(rng, rows, schema="dvf_plus_2025_2", prefix="dvf_plus_"):
    """Dump text and the rows it holds, with several tables and blocks per file."""
    truth = {"mutation": [], "local": []}
    out = ["-- a comment", "SET client_encoding = 'UTF8';", ""]
    number = 0
    while number < rows:
        for table, columns in (("mutation", "idmutation, l_codinsee, geompar, libnatmut"), ("local", "iddispoloc, libtyploc")):
            out.append(f"COPY {schema}.{prefix}{table} ({columns}) FROM stdin;")
            for _ in range(rng.choice([0, 1, 3, 40])):
                number += 1
                if table == "mutation":
                    codes = [f"{rng.randrange(99999):05d}" for _ in range(rng.randrange(3))]
                    label = rng.choice([None, "", "Vente", "tab\there", "back\\slash", "COPY x.y (z) FROM stdin;"])
                    text = r"\N" if label is None else label.replace("\\", "\\\\").replace("\t", "\\t")
                    out.append("\t".join([str(number), "{" + ",".join(codes) + "}", "0101", text]))
                    truth[table].append((str(number), codes, "0101", label))
                else:
                    out.append(f"{number}\tMaison")
                    truth[table].append((str(number), "Maison"))
            out.append("\\.")
            out.append("")
    return "\n".join(out) + "\n", truth


@pytest.mark.parametrize("split", ["300b", "2kb", "128mb"])
def test_dump_equals_sequential_reading_for_any_split(spark, tmp_path, split):
    rng = random.Random(11)
    truth = {"mutation": [], "local": []}
    for name, rows in (("dvf_plus_d01.sql", 700), ("dvf_plus_d02.sql", 3), ("dvf_plus_d03.sql", 90)):
        text, part = _dump(rng, rows)
        (tmp_path / name).write_text(text)
        for t in truth:
            truth[t] += part[t]
    (tmp_path / "dvf_plus_init.sql").write_text("CREATE SCHEMA x;\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        dump = CopyDump(spark, str(tmp_path))
        assert dump.tables() == ["local", "mutation"]
        assert dump.national_schema() == "dvf_plus_2025_2"
        for table in truth:
            rows = dump.table(table)
            got = sorted(map(str, (tuple(r) for r in rows.collect())))
            assert got == sorted(map(str, truth[table]))
            if split == "300b" and table == "mutation":
                assert rows.rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_dump_with_different_column_orders(spark, tmp_path):
    (tmp_path / "a.sql").write_text("COPY dvf.local (a, b) FROM stdin;\n1\t2\n\\.\n")
    (tmp_path / "b.sql").write_text("COPY dvf.local (b, c, a) FROM stdin;\n2\t3\t1\n\\.\n")
    dump = CopyDump(spark, str(tmp_path))
    assert dump.national_schema() is None
    got = sorted((r.a, r.b, r.c or "") for r in dump.table("local").collect())
    assert got == [("1", "2", ""), ("1", "2", "3")]


def test_dump_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\tb\\"), ("2", None), ("3", "\\N"), ("4", "x\ny\r\x0b\x0c\b")], "k string, v string")
    write_copy_dump(df, "dvf", "local", str(tmp_path / "d"))
    back = CopyDump(spark, str(tmp_path / "d"), "*.txt").table("local")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(KeyError):
        scan_copy_dump(spark, str(tmp_path / "d"), "missing")


def test_partitioned_write_keeps_odd_years_and_prunes(spark, tmp_path):
    rows = [(y, d, t, float(i)) for i, (y, d, t) in enumerate(
        [(y, d, t) for y in (1999, 2014, 2023, 2025, 2099, None) for d in ("01", "75") for t in ("111", None)])]
    df = spark.createDataFrame(rows, "transaction_year long, department_code string, property_type_code string, p double")
    path = str(tmp_path / "fact")
    assert sinks.write_partitioned_clustered(df, path) == len(rows)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    parts = {r.partition_id: r.total_rows for r in sinks.list_partitions(back).collect()}
    assert parts == {2014: 4, 2023: 4, 2025: 4, None: 12}
    one = sinks.in_years(back, 2023, 2023)
    assert one.count() == 4 and len(one.inputFiles()) == len(back.inputFiles())
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [(((year_bucket" in plan and "isnull(year_bucket" in plan
    assert sinks.in_years(back, 1999, 1999).count() == 4


def test_chunk_replaces_itself_and_skips_empties(spark, tmp_path):
    path = str(tmp_path / "c")
    a = spark.createDataFrame([(1,), (2,)], "v long")
    assert sinks.write_chunk(a, path, "x") == 2
    assert sinks.write_chunk(a.filter("v = 1"), path, "y") == 1
    assert sinks.write_chunk(a.filter("v > 5"), path, "z") == 0
    assert sinks.write_chunk(a.filter("v = 2"), path, "x") == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "y"), (2, "x")]


def test_layers(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "v long")
    assert sinks.materialize_layer(spark, df, "a_view", view=True) == "a_view"
    name = sinks.materialize_layer(spark, df, "a_table", "layer_db", location=str(tmp_path / "db"))
    assert name == "layer_db.a_table" and spark.table(name).count() == 1
    sinks.materialize_layer(spark, df.union(df), "a_table", "layer_db")
    assert spark.table(name).count() == 2


def test_row_counts_include_empty_tables(spark):
    df = spark.createDataFrame([(1,), (2,)], "v long")
    got = {r.table_name: r.row_count for r in sinks.load_row_counts({"a": df, "b": df.filter("v > 9")}).collect()}
    assert got == {"a": 2, "b": 0, "(total)": 2}


def test_header_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "a.sql").write_text("COPY parcelle (idpar) FROM stdin;\n1\n\\.\n")
    with pytest.raises(ValueError, match="cannot be read"):
        CopyDump(spark, str(tmp_path / "a.sql"))
    (tmp_path / "b.sql").write_text("COPY s.dvf_plus_local (idloc) FROM stdin;\n1\n\\.\nCOPY parcelle (idpar) FROM stdin;\n1\n\\.\n")
    with pytest.raises(Exception, match="cannot be read"):
        CopyDump(spark, str(tmp_path / "b.sql")).table("local").collect()


def test_dump_tables_open_only_their_own_bytes(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = "".join(f"{i}\tv{i}\n" for i in range(2000))
        text = f"-- x\nCOPY s.dvf_plus_local (idloc, v) FROM stdin;\n{rows}\\.\nCOPY s.dvf_plus_lot (idlot) FROM stdin;\n7\n\\.\n"
        (tmp_path / "a.sql").write_text(text)
        dump = CopyDump(spark, str(tmp_path / "a.sql"))
        local = dump.table("local")
        assert sorted(int(r.idloc) for r in local.collect()) == list(range(2000))
        plan = local._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert [r.idlot for r in dump.table("lot").collect()] == ["7"]
        assert [end - start for _, start, end in dump.ranges("lot")] == [2]
        assert sum(end - start for _, start, end in dump.ranges("local")) == len(rows)
        assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
        (tmp_path / "a.sql").write_text(text + "-- more\n")
        with pytest.raises(Exception, match="has changed since"):
            local.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_ranges_give_every_line_once(tmp_path, monkeypatch, size):
    monkeypatch.setattr(dump_ranges, "READ_BYTES", 5)
    for text in (b"", b"\n", b"a", b"a\n", b"\n\na\n", b"first\nsecond line, longer\n\nlast", b"x" * 40 + b"\ny\n"):
        path = tmp_path / "t"
        path.write_bytes(text)
        file, length = dump_ranges.opened(f"file:{path}")
        found = []
        for at in range(0, length, size):
            for offset, part in dump_ranges.whole_lines(file, at, min(length, at + size)):
                assert text[offset : offset + len(part)] == part
                found.append(part)
        assert b"".join(found) == text and all(x.endswith(b"\n") for x in found[:-1])


def test_dump_that_is_cut_off(spark, tmp_path):
    (tmp_path / "a b.sql").write_text("COPY s.local (a) FROM stdin;\n1\n2")
    (tmp_path / "c.sql").write_text("COPY s.local (a) FROM stdin;\nCOPY s.lot (b) FROM stdin;\n3\n\\.\n")
    (tmp_path / "d.sql").write_text("")
    dump = CopyDump(spark, str(tmp_path))
    assert sorted(r.a for r in dump.table("local").collect()) == ["1", "2"]
    assert [(r.b, r.source_file.rsplit("/", 1)[1]) for r in dump.table("lot", lineage=True).collect()] == [("3", "c.sql")]


def test_csv_keeps_blanks(spark, tmp_path):
    from salesmart.sinks.tables import write_csv_export

    rows = [(" a ", "  "), ("\tb", ""), (None, 'q"u,o'), ("x", "é ")]
    write_csv_export(spark.createDataFrame(rows, "k string, v string"), str(tmp_path / "t.csv"))
    back = scan_csv_table(spark, str(tmp_path / "t.csv"), "t").collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


def test_years_outside_the_written_bounds_are_found(spark, tmp_path):
    df = spark.createDataFrame([(y, "01", "1") for y in range(2010, 2030)], "transaction_year long, department_code string, property_type_code string")
    path = str(tmp_path / "fact")
    sinks.write_partitioned_clustered(df, path, years=(2014, 2020))
    back = spark.read.parquet(path)
    for first, last in ((2022, 2023), (2012, 2016), (2018, 2025), (2015, 2015), (2000, 2050)):
        got = sinks.in_years(back, first, last)
        assert sorted(r.transaction_year for r in got.collect()) == [y for y in range(2010, 2030) if first <= y <= last]
        assert "PartitionFilters: [(((year_bucket" in got._jdf.queryExecution().toString()


def test_batches_keep_their_names_and_can_become_empty(spark, tmp_path):
    path = str(tmp_path / "batches")
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    for batch in ("001", "1", "a/b=c", "last"):
        assert sinks.write_chunk(df, path, batch) == 3
    assert sinks.write_chunk(df.where("k > 9"), path, "last") == 0
    counts = {r.batch_id: r["count"] for r in sinks.read_chunks(spark, path).groupBy("batch_id").count().collect()}
    assert counts == {"001": 3, "1": 3, "a/b=c": 3}


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_truncate(spark.range(5), path)
    broken = spark.range(5).withColumn("x", F.expr("if(id = 3, raise_error('no'), 1)"))
    with pytest.raises(Exception, match="no"):
        sinks.write_truncate(broken, path)
    assert spark.read.parquet(path).count() == 5
    sinks.write_truncate(spark.read.parquet(path).where("id < 2"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2


def test_money_is_exact_in_any_order(spark):
    from decimal import Decimal

    from salesmart.operators import serving

    r = random.Random(0)
    cents = [r.randrange(10**12) for _ in range(20_000)]
    want = float(Decimal(sum(cents)) / 100)
    for seed in range(3):
        random.Random(seed).shuffle(cents)
        df = spark.createDataFrame([(c / 100,) for c in cents], "p double").repartition(seed + 2)
        assert df.agg(serving.exact_sum("p")).first()[0] == want


def test_untouched_years_keep_their_files(spark, tmp_path):
    from salesmart.operators import lookups

    path = tmp_path / "history"
    schema = "k long, y long, p double, v int"
    rows = [(1, 2020, 1.0, 1), (2, 2020, 2.0, 1), (3, 2021, 3.0, 1), (4, 2022, 4.0, 1), (5, None, 5.0, 1)]
    lookups.merge_release(spark, str(path), spark.createDataFrame(rows, schema), "k", "v", "y")
    read = lambda: releases.read_release(spark, str(path), "y")
    files = lambda y: sorted({r[0] for r in read().where(f"y = {y}").select("_metadata.file_path").collect()})
    before = {y: files(y) for y in (2020, 2021, 2022)}
    news = [(3, 2022, 33.0, 2), (6, 2022, 6.0, 2), (4, 2022, 0.0, 0)]  # one moves its year, one is older
    lookups.merge_release(spark, str(path), spark.createDataFrame(news, schema), "k", "v", "y")
    got = {r.k: (r.y, r.p, r.v) for r in read().collect()}
    assert got == {1: (2020, 1.0, 1), 2: (2020, 2.0, 1), 3: (2022, 33.0, 2), 4: (2022, 4.0, 1), 5: (None, 5.0, 1), 6: (2022, 6.0, 2)}
    assert files(2020) == before[2020] and files(2021) == [] and files(2022) != before[2022]


def test_release_that_dies_leaves_the_history_as_it_was(spark, tmp_path, monkeypatch):
    from salesmart.operators import lookups

    path, schema = str(tmp_path / "history"), "k long, y long, v int"
    merge = lambda rows: lookups.merge_release(spark, path, spark.createDataFrame(rows, schema), "k", "v", "y")
    read = lambda: sorted(map(tuple, releases.read_release(spark, path, "y").collect()), key=str)
    with pytest.raises(FileNotFoundError):
        read()
    merge([(1, 2020, 1), (2, 2021, 1), (None, 2021, 1), (None, 2021, 1)])
    before = read()
    assert before == [(1, 2020, 1), (2, 2021, 1), (None, 2021, 1), (None, 2021, 1)]
    old = releases.read_release(spark, path, "y")

    def die(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(releases, "_commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            merge([(1, 2021, 2), (3, 2022, 2)])
    assert read() == before
    merge([(1, 2021, 2), (3, 2022, 2)])
    # rows without a key are never merged into one
    assert read() == [(1, 2021, 2), (2, 2021, 1), (3, 2022, 2), (None, 2021, 1), (None, 2021, 1)]
    assert sorted(map(tuple, old.collect()), key=str) == before  # who reads the old release goes on reading it
    assert len(releases.drop_superseded(spark, path)) == 2 and len(read()) == 5


def test_tables_at_relative_paths(spark, tmp_path, monkeypatch):
    name = f"relative-{tmp_path.name}-{os.getpid()}"
    where = sinks._beside(spark, name)
    home = spark._jvm.org.apache.hadoop.fs.Path(name).getFileSystem(spark._jsc.hadoopConfiguration()).getWorkingDirectory().toString()
    assert where.startswith(f"{home}/_{name}-")


def test_failed_exports_and_chunks_leave_the_old_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    broken = spark.range(5).withColumn("x", F.expr("if(id = 3, raise_error('no'), 1)"))
    for write, count in (
        (lambda df: sinks.write_csv_export(df, path + ".csv"), lambda: spark.read.csv(path + ".csv", header=True).count()),
        (lambda df: sinks.write_chunk(df, path, "b/1"), lambda: sinks.read_chunks(spark, path).count()),
    ):
        assert write(spark.range(3)) == 3
        with pytest.raises(Exception, match="no"):
            write(broken)
        assert count() == 3 and write(spark.range(4)) == 4 and count() == 4


def test_reference_rows_once_per_key(spark):
    from salesmart.operators import lookups

    labels = spark.createDataFrame([("1", "Maison"), ("1", "Maison"), ("1", "House"), ("2", None)], "k string, l string")
    rows = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")
    got = sorted(map(tuple, lookups.label_lookup(rows, labels, "k", "l", "label").collect()))
    assert got == [("1", "House"), ("2", None), ("3", None)]


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    folder = tmp_path / "adresse"
    folder.mkdir()
    (folder / "a.csv").write_text("idadr,voie\n" + "".join(f"{i},street\n" for i in range(3000)))
    (folder / "b.csv").write_text('idadr,voie\nx,"two\nlines"\ny,"say ""no"""\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = scan_csv_table(spark, str(folder), "adresse", lineage=True)
        rows = {r.idadr: r.voie for r in df.collect()}
        assert len(rows) == 3002 and rows["x"] == "two\nlines" and rows["y"] == 'say "no"'
        assert df.filter(F.col("source_file").endswith("a.csv")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", [r"\x41", r"a\101b"])
def test_byte_escapes_are_an_error(spark, text):
    with pytest.raises(Exception, match="byte number"):
        spark.createDataFrame([(text,)], "v string").select(unescape(F.col("v"))).collect()


def test_median_of_negative_and_zero_values(spark):
    import statistics

    from salesmart.operators import serving

    r = random.Random(7)
    rows = [(g, v) for g in ("a", "b", "c") for v in [r.uniform(-1e6, 1e6) for _ in range(301)] + [0.0] * 20 + [-0.001, 1e-9, -5e8]]
    rows += [("neg", float(-k)) for k in range(1, 12)] + [("none", None)]
    got = {x.g: x.m for x in serving.exact_median(spark.createDataFrame(rows, "g string, v double"), "g", "v", "m").collect()}
    want = {g: round(statistics.median([v for h, v in rows if h == g and v is not None]), 4) for g in ("a", "b", "c", "neg")}
    assert got == pytest.approx(want)
