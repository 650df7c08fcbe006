"""Z-order, schema evolution, documents as variants, exact quantiles and outliers by quartiles."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racing import rows
from pitwall.operators import outliers, quantiles
from pitwall.session import stage, work_dir
from pitwall.sources import readers, tables, writers
from pitwall.streaming import streams
from suite import registry

# -- Z-order -------------------------------------------------------------------------------------------------------------


def test_each_column_skips_files(spark):
    """Five columns, four of which go together, as sessions, meetings, seasons and dates do."""
    df = spark.range(40_000).select(
        (F.col("id") % 400).alias("session"), F.pmod(F.xxhash64("id"), F.lit(20)).cast("int").alias("driver"), F.col("id").alias("n")).select(
        "*", F.floor(F.col("session") / 5).alias("meeting"), (F.lit(2018) + F.floor(F.col("session") / 80)).cast("int").alias("year"),
        F.expr("date_add(date'2018-01-01', cast(session * 4 as int))").alias("date")).repartition(9)
    path = work_dir(spark, "zordered")
    writers.write_zordered(df, path, ["session", "meeting", "year", "driver", "date"], files=48)
    back = spark.read.parquet(path)
    assert back.count() == 40_000 and sorted(back.columns) == sorted(df.columns)
    files = back.select("_metadata.file_name").distinct().count()
    assert files >= 40
    for which in ("session = 171", "meeting = 34", "year = 2020", "driver = 7", "date = date'2019-11-08'"):
        found = back.where(which)
        assert 0 < found.count() == df.where(which).count()
        assert found.select("_metadata.file_name").distinct().count() <= files / 3, which
        assert "PushedFilters: [" in found._jdf.queryExecution().toString()


def test_z_values_of_odd_columns(spark):
    data = [(k % 3 if k % 7 else None, f"n{k % 11}" if k % 5 else None, float(k), k % 2 == 0) for k in range(200)]
    df = spark.createDataFrame(data, "a int, b string, c double, d boolean").withColumns(
        {"e": F.expr("timestamp_seconds(c * 1000)"), "f": F.expr("cast(timestamp_seconds(c) as timestamp_ntz)"), "g": F.lit(None).cast("int")})
    z = df.select("c", writers.z_value(df, list("abcdefg"), 5).alias("z"))
    assert z.where("z IS NULL").count() == 0 and z.select("z").distinct().count() > 50
    one = df.select("c", writers.z_value(df, ["c"], 4).alias("z")).orderBy("c").collect()
    assert [r.z for r in one] == sorted(r.z for r in one) and one[-1].z == 15
    with pytest.raises(ValueError):
        writers.z_value(df, list("abcdefg"), 9)
    none = df.where("false")
    writers.write_zordered(none, work_dir(spark, "none"), ["a", "b"])
    assert none.select(writers.z_value(none, ["a", "b"])).count() == 0


# -- schema evolution ----------------------------------------------------------------------------------------------------


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pitwall_layout_test")
    yield "pitwall_layout_test"
    spark.sql("DROP DATABASE pitwall_layout_test CASCADE")


def land(spark, path, year, rows_, schema):
    spark.createDataFrame(rows_, schema).write.mode("append").parquet(f"{path}/year={year}")


def test_evolve(spark, database, tmp_path):
    path, name = work_dir(spark, "evolving"), f"{database}.laps"
    land(spark, path, 2020, [(1, 1.5, "a")], "n int, x float, s string")
    assert rows(tables.evolve(spark, name, path), "column", "change") == [(c, "created") for c in ("n", "s", "x", "year")]
    assert rows(spark.table(name), "n", "x", "s", "year") == [(1, 1.5, "a", 2020)]
    land(spark, path, 2021, [(2**40, 2.25, "b", True)], "n long, x double, s string, flag boolean")
    land(spark, path, 2020, [(3, None)], "n short, late string")
    got = rows(tables.evolve(spark, name, path), "column", "change", "from_type", "to_type")
    assert got == [("flag", "added", None, "boolean"), ("late", "added", None, "string"), ("n", "widened", "int", "bigint"), ("x", "widened", "float", "double")]
    assert rows(spark.table(name), "n", "x", "s", "flag", "year") == sorted(
        [(1, 1.5, "a", None, 2020), (2**40, 2.25, "b", True, 2021), (3, None, None, None, 2020)], key=repr)
    assert tables.evolve(spark, name, path).count() == 0
    land(spark, path, 2022, [(5, "c")], "n int, s string")  # a partition only
    assert tables.evolve(spark, name, path).count() == 0 and spark.table(name).where("year = 2022").count() == 1
    land(spark, path, 2023, [("six",)], "n string")
    assert rows(tables.evolve(spark, name, path), "column", "change") == [("n", "conflict")]
    assert spark.table(name).where("year < 2023").count() == 4
    with pytest.raises(ValueError):
        tables.evolve(spark, name, str(tmp_path))


def test_new_columns_only_alter_the_table(spark, database):
    path, name = work_dir(spark, "evolving"), f"{database}.plain"
    spark.createDataFrame([(1,)], "n int").write.parquet(path)
    tables.evolve(spark, name, path)
    spark.createDataFrame([(2, [1.5])], "n int, more array<double>").write.mode("append").parquet(path)
    assert rows(tables.evolve(spark, name, path), "column", "change", "to_type") == [("more", "added", "array<double>")]
    assert rows(spark.table(name), "n", "more") == [(1, None), (2, [1.5])]


# -- documents -----------------------------------------------------------------------------------------------------------


def test_documents(spark, tmp_path):
    texts = {
        "array": json.dumps([{"n": 1, "x": 2.5, "s": "ü"}, {"n": None, "more": {"deep": [1]}}, {}], indent=2),
        "single": '{\n "n": 7,\n "s": "one"\n}', "empty": " \n", "zero": "", "nothing": "[]", "cut": '[{"n": 1},', "word": '"text"', "null": "null",
        "mixed": '[{"n": 3}, 5, null, {"n": "none"}, {"n": 4, "s": {"a": 1}}, {"n": 2.5}, {"n": 9000000000}, [{"n": 8}]]',
    }
    for name, text in texts.items():
        (tmp_path / "year=2024").mkdir(exist_ok=True)
        (tmp_path / "year=2024" / f"{name}.json").write_text(text)
    schema = T.StructType.fromDDL("n int, x double, s string, `it's` int")
    bad = work_dir(spark, "bad")
    got = readers.scan_documents(spark, f"{tmp_path}/year=*/*.json", schema, bad, str(tmp_path))
    assert got.columns == ["n", "x", "s", "it's", "year"]
    good = rows(got, "n", "x", "s", "year")
    assert [r for r in good if r[0] not in (2, 4)] == sorted([(1, 2.5, "ü", 2024), (None, None, None, 2024), (None, None, None, 2024), (7, None, "one", 2024), (3, None, None, 2024)], key=repr)
    broken = spark.read.parquet(bad).select(F.regexp_extract("file", "([a-z]+)[.]json$", 1).alias("name"), "kind", "position", "content").collect()
    kinds = sorted((r.name, r.kind, r.position) for r in broken if r.kind != "document")
    assert {r.name for r in broken if r.kind == "document"} == {"empty", "cut", "word", "null"} and len(broken) - len(kinds) == 4
    assert {k for k in kinds if k[1] == "element"} == {("mixed", "element", p) for p in (1, 2, 7)}
    assert {("mixed", "record", p) for p in (3, 6)} <= set(kinds)
    assert {r.content for r in broken if r.name == "cut"} == {texts["cut"]}


# -- exact quantiles and outliers ----------------------------------------------------------------------------------------


def rank(values, p):
    import math

    values = sorted(values)
    at = (len(values) - 1) * p
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at)), values[max(math.ceil(p * len(values)) - 1, 0)]


@pytest.mark.parametrize("buckets", [2, 1024])
def test_exact_quantiles(spark, buckets):
    rng = random.Random(3)
    groups = {"few": [1.5], "same": [7.0] * 90, "two": [1.0, 2.0], None: [rng.gauss(0, 1e6) for _ in range(700)], "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, -1e-300],
              "grid": [round(rng.uniform(80, 95), 3) for _ in range(900)], "inf": [1.0, 2.0, 3.0, 4.0, 1e300]}
    data = [(g, x) for g, values in groups.items() for x in values] + [("none", None), ("grid", float("nan")), ("few", None)]
    df = spark.createDataFrame(data, "g string, x double").groupBy("g", "x").agg(F.count("*").alias("n"))
    counted = stage(df, "counted")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    for k, between in enumerate((True, False)):
        got = quantiles.exact_quantiles(counted, ["g"], probs, between, buckets)
        plan = got._jdf.queryExecution().toString()
        assert "percentile" not in plan
        for r in got.collect():
            assert [r[q] for q in probs] == pytest.approx([rank(groups[r.g], p)[k] for p in probs.values()], rel=1e-12, abs=0), r.g
        assert got.count() == len(groups)
    assert quantiles.exact_quantiles(counted.where("false"), ["g"], probs).count() == 0
    assert quantiles.exact_quantiles(counted.where("g = 'same'").drop("g"), [], {"m": 0.5}).collect()[0].m == 7.0


def test_outliers_by_quartiles(spark):
    rng = random.Random(5)
    groups = {1: [rng.gauss(90, 2) for _ in range(3000)] + [200.0, 10.0], 2: [5.0] * 40 + [6.0], None: [1.0, 2.0, 3.0, 100.0], 4: [3.0]}
    data = [(g, x, f"2024-01-{1 + k % 7:02d}") for g, values in groups.items() for k, x in enumerate(values)] + [(1, None, "2024-01-01"), (1, float("nan"), "2024-01-02"), (9, None, None)]
    df = spark.createDataFrame(data, "g int, x double, day string").withColumn("day", F.to_date("day"))
    days = stage(outliers.sketches(df, ["g"], "x", "day"), "days")
    assert days.count() == 7 + 7 + 4 + 1
    want = {g: (len(v), rank(v, 0.25)[1], rank(v, 0.75)[1]) for g, v in groups.items()}
    for kept in (None, days):
        got = {r.g: (r.n, r.q1, r.q3) for r in outliers.quartiles(df, ["g"], "x", "day", kept).collect()}
        assert got == want
    far = rows(outliers.outliers(df, ["g"], "x", "day"), "g", "x")
    assert far == sorted([(g, x) for g, v in groups.items() for x in v if x < want[g][1] - 1.5 * (want[g][2] - want[g][1]) or x > want[g][2] + 1.5 * (want[g][2] - want[g][1])], key=repr)
    # Sketches of other rows bracket nothing, and the quartiles are still exact.
    off = stage(outliers.sketches(df.withColumn("x", F.col("x") + 1000), ["g"], "x", "day"), "off")
    assert {r.g: (r.n, r.q1, r.q3) for r in outliers.quartiles(df, ["g"], "x", "day", off).collect()} == want
    assert outliers.quartiles(df.where("false"), ["g"], "x", "day").count() == 0


def test_iqr_outliers_joins_the_laps_once(spark, monkeypatch):
    """The join behind the laps is run once and the quartiles are found once, whatever reads them later."""
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("test tables are not here")
    calls, found = [], outliers.quartiles
    monkeypatch.setattr(outliers, "quartiles", lambda df, *a, **k: (calls.append(df.inputFiles()), found(df, *a, **k))[1])
    out = registry.load()[0]["iqr_outliers"](spark, folder)
    assert len(calls) == 1
    assert not [f for f in [*calls[0], *out.inputFiles()] if "lineitem.parquet" in f]


# -- compaction, buckets, statistics --------------------------------------------------------------------------------------


def names(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("parts", [[], ["day"]])
@pytest.mark.parametrize("breaks", [None, "before", "after", "half"])
def test_compact_small_files_only(spark, monkeypatch, parts, breaks):
    path = work_dir(spark, "files")
    wide = spark.range(30_000).select("id", F.md5(F.col("id").cast("string")).alias("v"), (F.col("id") % 2).alias("day"))
    save = lambda df, n: (lambda w: w.partitionBy(*parts) if parts else w)(df.repartition(n).write.mode("append")).parquet(path)
    save(wide.where("id < 26000"), 1)
    large = names(path)
    save(wide.where("id >= 26000"), 9)
    before, target = names(path), 2 * min((Path(path) / f).stat().st_size for f in large)
    if breaks:
        done = writers.drop_folders

        def broken(spark_, folders):
            if folders and folders[0].endswith(".parquet"):
                if breaks == "half":
                    done(spark_, folders[:3])
                raise RuntimeError("broken")
            done(spark_, folders)

        with monkeypatch.context() as m:
            if breaks == "before":
                m.setattr(type(wide.write), "parquet", lambda self, p, *a, f=type(wide.write).parquet: f(self, p, *a) if p != path else (_ for _ in ()).throw(RuntimeError("broken")))
            else:
                m.setattr(writers, "drop_folders", broken)
            with pytest.raises(RuntimeError):
                writers.compact_small(spark, path, parts, target)
    told = writers.compact_small(spark, path, parts, target).collect()
    after = names(path)
    assert large.items() <= after.items() and len(after) < len(before)
    assert breaks or sum(r.files for r in told) >= 9
    assert rows(spark.read.parquet(path), "id", "v") == rows(wide, "id", "v")
    assert not Path(path).parent.joinpath(f"_compact_{Path(path).name}").exists()
    assert writers.compact_small(spark, path, parts, 64).count() == 0


def test_first_fit_by_folder(spark):
    sizes = {"a": [40, 30, 30, 20, 10, 90, 49], "b": [5], "c": [49, 49, 49, 2]}
    df = spark.createDataFrame([(f, f"{f}{k}", n) for f, v in sizes.items() for k, n in enumerate(v)], "folder string, path string, length long")
    got = writers.bins(df, 100).collect()
    held = {}
    for r in got:
        held.setdefault((r.folder, r.bin), []).append(r.length)
    assert sorted(map(sorted, held.values())) == sorted(map(sorted, [[49, 40, 10], [30, 30, 20], [49, 49, 2]]))


def test_bucketed_tables_join_without_exchange(spark, database):
    root, keys = work_dir(spark, "bucketed"), ["k", "d"]
    left = spark.range(5000).select((F.col("id") % 97).alias("k"), (F.col("id") % 7).cast("int").alias("d"), "id")
    right = left.select(*keys).distinct().withColumn("name", F.concat_ws("-", *keys))
    tables.save_bucketed(left, f"{database}.laps", f"{root}/laps", keys, 6)
    tables.save_bucketed(right, f"{database}.names", f"{root}/names", keys, 6)
    joined = spark.table(f"{database}.laps").hint("merge").join(spark.table(f"{database}.names").hint("merge"), keys).groupBy(*keys).agg(F.count("*").alias("n"), F.max("name").alias("name"))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined, "k", "d", "n", "name") == rows(left.join(right, keys).groupBy(*keys).agg(F.count("*").alias("n"), F.max("name").alias("name")), "k", "d", "n", "name")
    assert tables.table_detail(spark, f"{database}.laps")["Num Buckets"] == "6"


def test_statistics_and_join_order(spark, database):
    root = work_dir(spark, "measured")
    sizes = {"facts": 20_000, "some": 4_000, "few": 10}
    for name, n in sizes.items():
        spark.range(n).select((F.col("id") % 4000).alias("a"), (F.col("id") % 10).alias("b"), F.when(F.col("id") % 5 > 0, F.col("id")).alias(f"x_{name}")).write.option(
            "path", f"{root}/{name}").saveAsTable(f"{database}.{name}")
        tables.analyze(spark, f"{database}.{name}")
    got = {r["column"]: (r["nulls"], r["least"], r["greatest"]) for r in tables.column_statistics(spark, f"{database}.facts").collect()}
    assert got == {"a": (0, "0", "3999"), "b": (0, "0", "9"), "x_facts": (4000, "1", "19999")}
    assert "20000 rows" in tables.table_detail(spark, f"{database}.facts")["Statistics"]
    t = {n: spark.table(f"{database}.{n}") for n in sizes}

    def order():
        star = t["facts"].join(t["some"].select("a", "x_some"), "a").join(t["few"].where("x_few = 3").select("b", "x_few"), "b")
        plan = star._jdf.queryExecution().optimizedPlan().toString()
        return [n for n in sorted(("x_some", "x_few"), key=lambda n: plan.rindex(f"{n}#"))], star.count()

    plain, n = order()
    with tables.cost_based(spark):
        costed, m = order()
    assert n == m and plain == ["x_some", "x_few"] and costed == ["x_few", "x_some"]
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"


# -- rows that a stream drops ---------------------------------------------------------------------------------------------


def test_rows_dropped_by_the_watermark_are_told(spark):
    path, out, counts = (work_dir(spark, n) for n in ("in", "out", "counts"))
    rows_ = spark.range(1000).select(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 60).alias("date"), (F.col("id") % 5).alias("k"))
    for part in (rows_, rows_.where("date = timestamp_seconds(1600059940)"), rows_.where("k = 1")):
        part.coalesce(1).write.mode("append").parquet(path)
    live = streams.read_stream(spark, path, rows_.schema, files_per_batch=1)
    query = streams.stream_windows_told(live, out, "10 minutes", "30 seconds", ["k"], [F.max("date").alias("last")], work_dir(spark, "ckpt"), counts, partition_by=["k"])
    query.awaitTermination()
    told = rows(streams.late_rows(query, counts), "batch", "sent", "in_windows", "dropped")
    edge = (1_600_000_000 + 999 * 60 - 30) // 600 * 600  # the last whole window before the watermark ends here
    late = sum(1 for k in range(1, 1000, 5) if 1_600_000_000 + k * 60 < edge)
    assert told == [(0, 1000, 1000, 0), (1, 1, 1, 0), (2, 200, 200 - late, late)] and late > 190
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == sum(r[2] for r in told)
