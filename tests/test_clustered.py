"""Tables clustered across files: same rows, fewer files read."""

import pytest
from pyspark.sql import functions as F

from salesmart.sinks import tables as sinks
from salesmart.sinks import clustered
from salesmart.sinks.clustered import chosen_files, delete_rows, drop_superseded, read_clustered, write_clustered

COLUMNS = "mutation_id long, transaction_year long, department_code string, property_type_code string, v double"


@pytest.fixture
def small_files(spark):
    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "32",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20KB"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sales(spark, n=60000):
    """A third of the rows is one year, department and type."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.col("id").alias("mutation_id"),
        F.when(hot, 2023).otherwise(2020 + F.pmod(F.xxhash64("id"), F.lit(4))).cast("long").alias("transaction_year"),
        F.when(hot, "75").otherwise(F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90)).cast("string"), 2, "0")).alias("department_code"),
        F.when(hot, "111").otherwise(F.when(F.col("id") % 2 == 0, "121").otherwise("12")).alias("property_type_code"),
        F.rand(1).alias("v"))


def test_one_department_reads_fewer_files_than_year_partitions(spark, tmp_path, small_files):
    df, path, plain = sales(spark), str(tmp_path / "clustered"), str(tmp_path / "plain")
    assert write_clustered(df, path) == 60000
    sinks.write_partitioned_clustered(df, plain)
    wanted = {"department_code": ["13"]}
    one = read_clustered(spark, path, (2023, 2023), wanted)
    other = sinks.in_years(spark.read.parquet(plain), 2023, 2023).where("department_code = '13'")
    assert sorted(r.mutation_id for r in one.collect()) == sorted(r.mutation_id for r in other.collect()) != []
    year = [f for f in spark.read.parquet(plain).inputFiles() if "year_bucket=2023" in f]
    assert len(one.inputFiles()) <= 2 < len(year)
    assert len(chosen_files(spark, path, (2023, 2023))) > 4
    assert "PushedFilters: [" in one._jdf.queryExecution().toString()


def test_hot_combination_is_cut_into_several_files(spark, tmp_path, small_files):
    path = str(tmp_path / "hot")
    write_clustered(sales(spark), path)
    files = spark.read.parquet(f"{path}/files").where("low_department_code <= '75' and high_department_code >= '75' and bucket = 2023")
    sizes = [r.file_rows for r in files.collect()]
    assert len(sizes) > 4 and max(sizes) < 20000 / 3


def test_nulls_odd_years_and_columns_outside_the_map(spark, tmp_path):
    rows = [(i, y, d, t, float(i)) for i, (y, d, t) in enumerate(
        [(y, d, t) for y in (1999, 2014, 2023, None) for d in ("01", "75", None) for t in ("111", None)])]
    rows.append(rows[0])  # a repeated row
    path = str(tmp_path / "odd")
    df = spark.createDataFrame(rows, COLUMNS)
    assert write_clustered(df, path) == len(rows)
    for _ in range(2):  # a repeat replaces
        assert write_clustered(df, path) == len(rows)
    back = read_clustered(spark, path)
    assert sorted(map(str, back.drop(sinks.YEAR_BUCKET).collect())) == sorted(map(str, df.collect()))

    def ids(**k):
        return sorted(r.mutation_id for r in read_clustered(spark, path, **k).collect())

    def expect(keep):
        return sorted(r[0] for r in rows if keep(r))

    assert ids(years=(1999, 1999)) == expect(lambda r: r[1] == 1999)
    assert ids(values={"department_code": ["75", None]}) == expect(lambda r: r[2] == "75")
    assert ids(years=(2014, 2023), values={"property_type_code": ["111"], "v": [6.0, 12.0]}) == expect(
        lambda r: r[1] in (2014, 2023) and r[3] == "111" and r[4] in (6.0, 12.0))
    assert ids(values={"department_code": []}) == ids(values={"department_code": ["zz"]}) == []
    assert chosen_files(spark, path, values={"department_code": ["zz"]}) == []


def test_empty_table_and_failed_write(spark, tmp_path):
    path = str(tmp_path / "empty")
    assert write_clustered(spark.createDataFrame([], COLUMNS), path) == 0
    back = read_clustered(spark, path, (2020, 2023), {"department_code": ["75"]})
    assert back.count() == 0 and back.columns == [*(c.split()[0] for c in COLUMNS.split(", ")), sinks.YEAR_BUCKET]
    one = spark.createDataFrame([(1, 2020, "75", "111", 1.0)], COLUMNS)
    assert write_clustered(one, path) == 1
    with pytest.raises(Exception, match="no number"):
        write_clustered(one.withColumn("v", F.raise_error(F.lit("no number")).cast("double")), path)
    assert read_clustered(spark, path).count() == 1


def test_deletion_rewrites_only_the_files_with_such_rows(spark, tmp_path, small_files):
    path = str(tmp_path / "cow")
    df = sales(spark).drop("v")
    write_clustered(df, path)
    before, keep = set(chosen_files(spark, path)), F.col("department_code") != "13"
    reader = read_clustered(spark, path)  # began before the deletion
    touched = delete_rows(spark, path, keep)
    after = set(chosen_files(spark, path))
    held = {f"{path}/data/{f}" for f in touched}
    assert held and len(held) < len(before) / 2
    assert before - after == held and before & after == before - held
    want = sorted(map(tuple, df.where(keep).collect()))
    got = read_clustered(spark, path).drop(sinks.YEAR_BUCKET)
    assert sorted(map(tuple, got.select(*df.columns).collect())) == want
    assert reader.count() == 60000
    assert delete_rows(spark, path, keep) == [] and set(chosen_files(spark, path)) == after
    assert set(drop_superseded(spark, path)) == set(touched)
    assert read_clustered(spark, path).count() == len(want)
    # a filter still chooses few files
    assert len(chosen_files(spark, path, (2023, 2023), {"department_code": ["14"]})) <= 2


def test_a_deletion_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dies")
    write_clustered(sales(spark, 3000), path)
    files = chosen_files(spark, path)

    def crash(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(clustered, "_file_map", crash)
        with pytest.raises(RuntimeError):
            delete_rows(spark, path, F.col("department_code") == "75")
    assert chosen_files(spark, path) == files and read_clustered(spark, path).count() == 3000
    assert len(drop_superseded(spark, path)) > 0 and read_clustered(spark, path).count() == 3000


def test_deletion_of_nulls_and_of_everything(spark, tmp_path):
    rows = [(1, 2020, "75", "111", 1.0), (2, 2020, None, "111", 1.0), (3, None, "75", None, 1.0), (1, 2020, "75", "111", 1.0)]
    path = str(tmp_path / "nulls")
    write_clustered(spark.createDataFrame(rows, COLUMNS), path)
    delete_rows(spark, path, F.col("department_code").isin("75"))
    assert sorted(r.mutation_id for r in read_clustered(spark, path).collect()) == [1, 1, 3]
    assert len(delete_rows(spark, path, F.lit(False))) > 0
    empty = read_clustered(spark, path)
    assert empty.count() == 0 and empty.columns[:5] == [c.split()[0] for c in COLUMNS.split(", ")]
    assert delete_rows(spark, path, F.lit(False)) == []
    write_clustered(spark.createDataFrame([], COLUMNS), path)
    assert read_clustered(spark, path).count() == 0
