"""Resumable batches and the stream give the same table."""

import pytest
from pyspark.sql import functions as F

from salesmart.sources.contracts import text_schema
from salesmart.streaming import ingest, manifest


def _deliver(folder, count=23, start=0):
    folder.mkdir(exist_ok=True)
    for i in range(start, start + count):
        (folder / f"dvf_d{i:02d}.csv").write_text("k,v\n" + "".join(f"{i}-{j},x\n" for j in range(i % 4)))


def _rows(spark, target, log):
    return sorted(r.k for r in ingest.read_ingested(spark, target, "t", log).collect())


def _totals(spark, log):
    return {r.table_name: r.row_count for r in manifest.accumulate_row_counts(manifest.read_manifest(spark, log)).collect()}


class Killed(Exception):
    pass


def _dying_after(read, batches):
    """A reader that fails once it has served so many batches."""
    served = []

    def run(spark, files):
        served.append(files)
        if len(served) > batches:
            raise Killed
        return read(spark, files)

    return run


def _truth(count=23):
    return sorted(f"{i}-{j}" for i in range(count) for j in range(i % 4))


@pytest.fixture
def places(tmp_path):
    _deliver(tmp_path / "in")
    return str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "manifest")


def test_groups_resume_and_changed_group_size(spark, places):
    landing, target, log = places
    read = ingest.csv_reader("t")
    with pytest.raises(Killed):
        ingest.chunk_cycle(spark, landing, target, log, _dying_after(read, 2), group=10)
    # resumed with another group size
    assert ingest.chunk_cycle(spark, landing, target, log, read, group=2) == 2
    assert ingest.chunk_cycle(spark, landing, target, log, read, group=10) == 0
    assert _rows(spark, target, log) == _truth()
    assert _totals(spark, log) == {"t": len(_truth())}
    assert manifest.read_manifest(spark, log).select("source_file").distinct().count() == 23


def test_crash_between_data_and_manifest_repeats_without_duplicates(spark, places, monkeypatch):
    landing, target, log = places
    read = ingest.csv_reader("t")

    def crash(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "append_manifest", crash)
        with pytest.raises(RuntimeError):
            ingest.chunk_cycle(spark, landing, target, log, read)
    assert manifest.read_manifest(spark, log).count() == 0
    assert ingest.chunk_cycle(spark, landing, target, log, read) == 3
    assert _rows(spark, target, log) == _truth()


def test_reingest_replaces_only_its_files(spark, places, tmp_path):
    landing, target, log = places
    read = ingest.csv_reader("t")
    ingest.chunk_cycle(spark, landing, target, log, read)
    (tmp_path / "in" / "dvf_d03.csv").write_text("k,v\nfixed,x\n")
    (tmp_path / "in" / "dvf_d07.csv").write_text("k,v\n")  # three rows before
    again = [str(tmp_path / "in" / f"dvf_d{i}.csv") for i in ("03", "07", "11")]  # plain paths
    ingest.reingest_subset(spark, again, target, log, read)
    want = sorted([k for k in _truth() if not k.startswith(("3-", "7-"))] + ["fixed"])
    assert _rows(spark, target, log) == want
    assert _totals(spark, log) == {"t": len(want)}


@pytest.mark.parametrize("name", ["dvf_d03.csv", "vente é 1.csv", "a%20b+c.csv"])
def test_a_file_cut_to_no_bytes_loses_its_rows(spark, places, tmp_path, name):
    landing, target, log = places
    read, path = ingest.csv_reader("t"), tmp_path / "in" / name
    path.write_text("k,v\n3-0,x\n3-1,x\n3-2,x\n")
    ingest.chunk_cycle(spark, landing, target, log, read)
    path.write_text("")
    ingest.reingest_subset(spark, [str(path)], target, log, read)  # alone: no table at all is read
    (tmp_path / "in" / "dvf_d07.csv").write_text("")
    ingest.reingest_subset(spark, [str(tmp_path / "in" / f"dvf_d{i}.csv") for i in ("07", "11")], target, log, read)
    hidden = ("7-",) if name != "dvf_d03.csv" else ("3-", "7-")
    want = [k for k in _truth() if not k.startswith(hidden)]
    assert _rows(spark, target, log) == want and _totals(spark, log)["t"] == len(want)


@pytest.mark.parametrize("name", ["dvf_initial_d01.csv", "sales_definitive.csv", "vente é 1.csv", "a%20b+c.csv"])
def test_no_name_hides_a_file(spark, tmp_path, name):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / name).write_text("k,v\n1,x\n2,y\n")
    target, log = str(tmp_path / "raw"), str(tmp_path / "log")
    assert ingest.chunk_cycle(spark, str(tmp_path / "in"), target, log, ingest.csv_reader("t")) == 1
    assert ingest.chunk_cycle(spark, str(tmp_path / "in"), target, log, ingest.csv_reader("t")) == 0
    assert _rows(spark, target, log) == ["1", "2"] and _totals(spark, log) == {"t": 2}
    ingest.reingest_subset(spark, [str(tmp_path / "in" / name)], target, log, ingest.csv_reader("t"))
    assert _rows(spark, target, log) == ["1", "2"] and _totals(spark, log) == {"t": 2}


def test_work_per_batch_does_not_grow(spark, places):
    landing, target, log = places
    tracker = spark.sparkContext.statusTracker()
    jobs = []

    def read(session, files):
        session.sparkContext.setJobGroup(f"batch-{len(jobs)}", "")
        jobs.append(f"batch-{len(jobs)}")
        return ingest.csv_reader("t")(session, files)

    ingest.chunk_cycle(spark, landing, target, log, read, group=3)
    spark.sparkContext._jsc.clearJobGroup()
    counts = [len(tracker.getJobIdsForGroup(j)) for j in jobs]
    assert len(counts) == 8 and max(counts[1:]) <= counts[0] + 1


def test_stream_equals_batches(spark, places, tmp_path):
    landing, target, log = places
    ingest.chunk_cycle(spark, landing, target, log, ingest.csv_reader("t"))
    out, out_log, check = (str(tmp_path / x) for x in ("stream", "stream-log", "checkpoint"))
    schema = text_schema(["k", "v"])
    ingest.stream_ingest(spark, landing, "t", schema, out, out_log, check, 10)
    assert _rows(spark, out, out_log) == _rows(spark, target, log)
    assert manifest.read_manifest(spark, out_log).select("source_file").distinct().count() == 23
    _deliver(tmp_path / "in", 4, start=23)
    ingest.stream_ingest(spark, landing, "t", schema, out, out_log, check, 10)  # only the new files
    assert _rows(spark, out, out_log) == _truth(27)
    ingest.stream_ingest(spark, landing, "t", schema, out, out_log, str(tmp_path / "fresh"), 7)  # lost checkpoint
    assert _rows(spark, out, out_log) == _truth(27) and _totals(spark, out_log) == {"t": len(_truth(27))}
    (tmp_path / "in" / "dvf_d07.csv").write_text("k,v\n")
    ingest.stream_ingest(spark, landing, "t", schema, out, out_log, str(tmp_path / "fresh"), 7)
    want = [k for k in _truth(27) if not k.startswith("7-")]
    assert _rows(spark, out, out_log) == want and _totals(spark, out_log) == {"t": len(want)}


def test_stream_records_files_whose_rows_the_transform_drops(spark, places, tmp_path):
    landing, _, _ = places
    out, log, check = (str(tmp_path / x) for x in ("stream", "stream-log", "checkpoint"))
    schema = text_schema(["k", "v"])
    drop = lambda df: df.where("k NOT LIKE '7-%'")
    ingest.stream_ingest(spark, landing, "t", schema, out, log, check, 10, transform=drop)
    assert _rows(spark, out, log) == [k for k in _truth(23) if not k.startswith("7-")]
    entries = manifest.read_manifest(spark, log)
    assert entries.select("source_file").distinct().count() == 23
    before = entries.count()
    ingest.stream_ingest(spark, landing, "t", schema, out, log, check, 10, transform=drop)
    assert manifest.read_manifest(spark, log).count() == before


def test_stream_of_the_event_table(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("value").cast("string").alias("value"))
    events.repartition(5).write.option("header", True).csv(str(tmp_path / "in"))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    ingest.stream_ingest(spark, str(tmp_path / "in"), "events", text_schema(events.columns), out, log, str(tmp_path / "check"), 2)
    back = ingest.read_ingested(spark, out, "events", log).drop("source_file")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, events.collect()))


def test_dump_delivery_with_reference_files(spark, tmp_path):
    folder = tmp_path / "in" / "delivery"
    folder.mkdir(parents=True)
    (folder / "dvf_plus_init.sql").write_text("CREATE TABLE x ();\n")
    (folder / "dvf_plus_annexe.sql").write_text("COPY dvf_plus_annexe.ann_type_local (codtyploc, libtyploc) FROM stdin;\n1\tMaison\n2\tAppartement\n\\.\n")
    for i in range(3):
        (folder / f"dvf_plus_d0{i}.sql").write_text(
            f"COPY dvf_plus_2025_2.dvf_plus_mutation (idmutation, l_par) FROM stdin;\n{i}\t{{a,b}}\n\\.\n")
    target, log = str(tmp_path / "raw"), str(tmp_path / "log")
    (folder / "dvf_plus_d09.sql").write_text("COPY dvf_plus_annexe.ann_type_local (codtyploc, libtyploc) FROM stdin;\n2\tAppartement\n3\tLocal\n\\.\n")
    run = lambda read, **kw: ingest.chunk_cycle(spark, str(tmp_path / "in"), target, log, read, "*.sql", **kw)
    with pytest.raises(Killed):
        run(_dying_after(ingest.dump_reader, 2), group=2)
    assert run(ingest.dump_reader, group=1) == 2
    # a reference row that two files deliver is there once
    types = ingest.read_ingested(spark, target, "ann_type_local", log)
    assert sorted(r.codtyploc for r in types.collect()) == ["1", "2", "3"]
    got = sorted((r.idmutation, r.l_par) for r in ingest.read_ingested(spark, target, "mutation", log).collect())
    assert got == [(str(i), ["a", "b"]) for i in range(3)]


def _deliver_dumps(folder, numbers):
    folder.mkdir(parents=True, exist_ok=True)
    for i in numbers:
        (folder / f"dvf_plus_d{i:02d}.sql").write_text(
            f"COPY dvf_plus_2025_2.dvf_plus_mutation (idmutation, l_par) FROM stdin;\n{i}\t{{a,b}}\n\\.\n"
            f"COPY dvf_plus_2025_2.dvf_plus_disposition (iddispo, idmutation) FROM stdin;\n"
            + "".join(f"{i}-{j}\t{i}\n" for j in range(i % 3 + 1)) + "\\.\n")


def _all_tables(spark, target, log):
    tables = ("mutation", "disposition", "ann_type_local")
    return {t: sorted(map(str, ingest.read_ingested(spark, target, t, log).collect())) for t in tables}


def test_dump_files_of_any_name_give_their_rows(spark, tmp_path):
    _deliver_dumps(tmp_path / "in", range(2))
    for path in (tmp_path / "in").iterdir():
        path.rename(path.with_suffix(".txt"))
    target, log = str(tmp_path / "raw"), str(tmp_path / "log")
    assert ingest.chunk_cycle(spark, str(tmp_path / "in"), target, log, ingest.dump_reader, "*.txt") == 1
    assert _totals(spark, log) == {"mutation": 2, "disposition": 3}


def test_stream_of_dumps_equals_batches_after_a_crash(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in" / "delivery"
    _deliver_dumps(folder, range(7))
    (folder / "dvf_plus_init.sql").write_text("CREATE TABLE x ();\n")
    (folder / "dvf_plus_d07.sql").write_text("")
    (folder / "zz_dvf_plus_annexe.sql").write_text(
        "COPY dvf_plus_annexe.ann_type_local (codtyploc, libtyploc) FROM stdin;\n1\tMaison\n2\tAppartement\n\\.\n")
    landing, target, log = (str(tmp_path / x) for x in ("in", "raw", "log"))
    ingest.chunk_cycle(spark, landing, target, log, ingest.dump_reader, "*.sql")
    out, out_log, check = (str(tmp_path / x) for x in ("stream", "stream-log", "check"))
    run = lambda read=ingest.dump_reader, place=check: ingest.stream_cycle(
        spark, landing, out, out_log, place, read, "*.sql", 3)

    # the second batch of data dies between its tables: one is written, the other never
    class Broken:
        @property
        def write(self):
            raise Killed

    served = []

    def dying(session, files):
        served.append(files)
        tables = ingest.dump_reader(session, files)
        if len(served) == 3:
            assert list(tables) == ["disposition", "mutation"]
            tables["mutation"] = Broken()
        return tables

    with pytest.raises(Exception, match="Killed"):
        run(dying)
    assert all("annexe" in p or "init" in p for p in served[0])  # reference files come first
    part = ingest.read_ingested(spark, out, "disposition", out_log)
    assert part.select("idmutation").distinct().count() == len([p for p in served[1] if "d07" not in p])
    failed = served[2]

    def watched(session, files):
        served.append(files)
        return ingest.dump_reader(session, files)

    assert run(watched) == 2
    assert served[3] == failed  # the same micro-batch, once more
    assert _all_tables(spark, out, out_log) == _all_tables(spark, target, log)
    assert _totals(spark, out_log) == _totals(spark, log) == {"mutation": 7, "disposition": 13, "ann_type_local": 2}
    names = manifest.read_manifest(spark, out_log).select("source_file").distinct().count()
    assert names == 9  # the file without tables is done too; the one without bytes is no delivery
    assert names == manifest.read_manifest(spark, log).select("source_file").distinct().count()
    assert run() == 0
    _deliver_dumps(folder, range(8, 10))
    assert run() == 1
    assert run(place=str(tmp_path / "fresh")) == 0  # a lost checkpoint repeats nothing
    ingest.chunk_cycle(spark, landing, target, log, ingest.dump_reader, "*.sql")
    assert _all_tables(spark, out, out_log) == _all_tables(spark, target, log)


def test_dump_files_of_a_delivery_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    from salesmart.plans import catalog

    spark.range(40).selectExpr("id AS o_orderkey", "id % 4 AS o_custkey", "1.5D AS o_totalprice").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.range(90).selectExpr(
        "id % 40 AS l_orderkey", "id AS l_linenumber", "id AS l_partkey", "1L AS l_suppkey", "2.5D AS l_extendedprice",
        "1D AS l_quantity", "'O' AS l_linestatus", "'N' AS l_returnflag").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(4).selectExpr("id AS c_custkey", "CAST(id AS INT) AS c_nationkey").write.parquet(
        str(tmp_path / "customer.parquet"))
    trial, fields = catalog.TrialTables(spark, str(tmp_path)), {"mutation": 31 * 10, "disposition": 6 * 10}
    monkeypatch.setattr(catalog._dump_files, "__defaults__", (60,))
    assert catalog._dump_files(trial, "disposition", "iddispo") == 9
    assert catalog._dump_files(trial, "mutation", "idmutation", fields["mutation"]) == 4
    assert catalog._dump_files(trial, "mutation", "idmutation", 10**6) == 3
    written = []
    write = catalog.write_copy_dump
    monkeypatch.setattr(catalog, "write_copy_dump", lambda df, *a: (write(df, *a), written.append(df.rdd.getNumPartitions())))
    monkeypatch.setattr(catalog, "_dump_files", lambda trial, name, key, real=catalog._dump_files: real(trial, name, key, fields[name]))
    rows = catalog.stream_dumps(spark, str(tmp_path))
    assert written == [4, 9]
    assert {r[0]: r[1] for r in rows.groupBy("table_name").count().collect()} == {"mutation": 40, "disposition": 90}


def test_roles(spark, tmp_path):
    for name in ("dvf_plus_init.sql", "dvf_plus_annexe.sql", "dvf_plus_d2A.sql"):
        (tmp_path / name).write_text("x")
    found = ingest.discover(spark, str(tmp_path), "*.sql").collect()
    assert {r.source_file.rsplit("_", 1)[-1]: r.role for r in found} == {
        "init.sql": "init", "annexe.sql": "reference", "d2A.sql": "data"}


def test_missing_manifest_is_a_fresh_start_and_a_broken_one_an_error(spark, tmp_path):
    assert manifest.read_manifest(spark, str(tmp_path / "none")).count() == 0
    bad = tmp_path / "bad" / "batch_id=b1"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="part-0.parquet"):
        manifest.read_manifest(spark, str(tmp_path / "bad")).count()
