"""Guards, mergeable sketches, pairwise correlation, CSV line ends and rejects, catalog layers."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators import clean, guards, sketches, stats
from cadence.session import scratch_path
from cadence.sources import results, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- guards

def test_absent_columns_are_named(spark):
    df = spark.range(3).toDF("a")
    with pytest.raises(ValueError, match=r"report: missing columns \['b', 'c'\]"):
        guards.guarded(df, ["a", "b", "c"], "report", lambda d: d)
    assert [tuple(r) for r in guards.missing_report(df, ["b", "a"]).orderBy("position").collect()] == [(1, "b", False), (2, "a", True)]


def test_empty_input_fails_by_name_when_it_runs(spark):
    df = spark.range(3).toDF("a")
    counted = lambda d: d.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(tuple(r) for r in guards.guarded(df, ["a"], "ok", counted).collect()) == [(0, 1), (1, 1), (2, 1)]
    nothing = guards.guarded(df.where("a > rand() + 10"), ["a"], "hourly report", counted)
    with pytest.raises(Exception, match="hourly report: no rows"):
        nothing.collect()
    # rows that the report itself drops are no reason to fail
    assert guards.guarded(df, ["a"], "ok", lambda d: d.where("a > 5")).collect() == []


def test_reports_are_guarded(spark, tmp_path):
    from cadence.plans import q_explore, q_stream
    small = "/root/testdata/sf0.001"
    for t in ("lineitem", "part", "events"):
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, query in (("hourly_trend", q_stream.hourly_trend), ("hist_popularity_20", q_explore.hist_popularity_20), ("top_genres_by_count", q_explore.top_genres_by_count),
                        ("genre_energy_top20", q_explore.genre_energy_top20), ("corr_matrix_all", q_explore.corr_matrix_all), ("scatter_points", q_explore.scatter_points)):
        with pytest.raises(Exception, match=f"{name}: no rows"):
            query(spark, str(tmp_path)).collect()


# ---------------------------------------------------------------- sketches

def _data(spark, n, parts=4):
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 97).cast("int").alias("few"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("half"),
        F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zero"), F.lit(None).cast("double").alias("none"), F.md5(F.col("id").cast("string")).alias("text")).repartition(parts)


def test_profiles_of_parts_merge_into_the_whole(spark):
    df, store = _data(spark, 40_000), scratch_path(spark, "prof")
    for i in range(3):
        sketches.append_profile(df.where(F.col("id") % 3 == i), store, f"p{i}")
    sketches.append_profile(df.where(F.col("id") % 3 == 1), store, "p1")  # a part that comes again
    got = {r.column_name: r for r in sketches.profile_rows(sketches.stored_profile(spark, store)).collect()}
    whole = {r.column_name: r for r in sketches.profile_rows(sketches.part_profile(df)).collect()}
    exact = {"id": 40_000, "few": 97, "half": 32_001, "zero": 1, "none": 1, "text": 40_000}
    for c, n in exact.items():
        assert got[c].distinct_estimate == whole[c].distinct_estimate  # merged = whole
        assert abs(got[c].distinct_estimate - n) <= 0.03 * n
    assert (got["half"].row_count, got["half"].null_count, got["half"].min_value, got["half"].max_value) == (40_000, 8_000, 0.5, 19_999.5)
    assert got["text"].min_value is None and got["text"].q_1 is None and got["none"].q_1 is None
    assert abs(got["id"].q_1 - 20_000) < 400 and abs(got["id"].q_0 - 10_000) < 400


def test_profile_needs_one_scan_and_no_row_expansion(spark):
    p = plan(sketches.part_profile(_data(spark, 100)))
    assert "Expand" not in p and "Generate" in p and p.count("ObjectHashAggregate") >= 2
    assert p.index("Generate") < p.rindex("ObjectHashAggregate")  # columns become rows after the sketches were made


def test_profile_of_nothing(spark):
    rows = sketches.profile_rows(sketches.part_profile(_data(spark, 10).where("id < 0"))).collect()
    assert rows == []


@pytest.mark.parametrize("shape", ["uniform", "skewed", "ties"])
def test_sketched_quantiles_keep_their_rank_error(spark, shape):
    pick = random.Random(3)
    draw = {"uniform": pick.random, "skewed": lambda: pick.paretovariate(1.1), "ties": lambda: float(pick.randrange(5))}[shape]
    xs = [draw() for _ in range(30_000)]
    df = spark.createDataFrame([(x, i % 4) for i, x in enumerate(xs)], "value double, part int")
    merged = None
    for i in range(4):
        s = sketches.quantile_sketches(df.where(F.col("part") == i).withColumn("g", F.lit("g")), ["g"])
        merged = s if merged is None else merged.unionByName(s)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    one = sketches.merge_sketches(merged, ["g"])
    row = one.select("n", *[sketches.quantile("sketch", p).alias(f"q{i}") for i, p in enumerate(probs)], sketches.rank("sketch", F.lit(2.0)).alias("at2")).first()
    assert row.n == len(xs)
    for i, p in enumerate(probs):
        q = row[f"q{i}"]
        assert sum(x < q for x in xs) <= (p + 0.01) * len(xs) and sum(x <= q for x in xs) >= (p - 0.01) * len(xs)
    assert abs(row.at2 - sum(x <= 2.0 for x in xs) / len(xs)) <= 0.01


def test_sketched_boxes_are_near_the_exact_ones(spark):
    pick = random.Random(4)
    xs = [pick.gauss(0, 1) for _ in range(20_000)] + [50.0, -70.0] * 100
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    exact = stats.iqr_outliers(df, ["v"]).first()
    got = sketches.sketch_boxes(sketches.quantile_sketches(df.select(F.lit("v").alias("feature"), F.col("v").alias("value")), ["feature"]), ["feature"]).first()
    assert abs(got.q1 - exact.q1) < 0.05 and abs(got.q3 - exact.q3) < 0.05
    assert abs(got.outlier_count - exact.outlier_count) <= 0.01 * len(xs) and (got.min, got.max, got.n) == (-70.0, 50.0, len(xs))


# ---------------------------------------------------------------- correlation, histogram, dedupe plans

def _pearson(pairs):
    n = len(pairs)
    if n < 2:
        return None
    mx, my = sum(a for a, _ in pairs) / n, sum(b for _, b in pairs) / n
    vx, vy = sum((a - mx) ** 2 for a, _ in pairs), sum((b - my) ** 2 for _, b in pairs)
    return sum((a - mx) * (b - my) for a, b in pairs) / math.sqrt(vx * vy) if vx > 0 and vy > 0 else None


@pytest.mark.parametrize("complete", [False, True])
def test_correlation_uses_the_rows_a_pair_has(spark, complete):
    pick = random.Random(8)
    far = 1e7  # far from 0: raw moments would lose their digits
    drawn = [(pick.random(), pick.random(), pick.random()) for _ in range(500)]
    data = [tuple(None if pick.random() < 0.2 else v for v in (x, far + x + y, z, 3.5, None if pick.random() < 0.99 else 1.0)) for x, y, z in drawn]
    cols = list("abcde")
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols)).repartition(5)
    use = cols[:4] if complete else cols
    got = {(r.feature_x, r.feature_y): r.r for r in stats.corr_long(df, use, complete_rows=complete).collect()}
    assert len(got) == len(use) ** 2
    rows = [d for d in data if not complete or None not in d[:4]]
    for i, a in enumerate(use):
        for j, b in enumerate(use):
            want = 1.0 if i == j else _pearson([(d[i], d[j]) for d in rows if d[i] is not None and d[j] is not None])
            assert got[a, b] == (want if want is None else pytest.approx(want, abs=1e-7))


def test_histogram_of_columns_is_that_of_each(spark):
    pick = random.Random(2)
    data = [(pick.random(), None if pick.random() < 0.3 else float(pick.randrange(7)), 5.0, None) for _ in range(200)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    from cadence.operators.ordered import long_values
    want = stats.histogram_auto(long_values(df, list("abcd")), ["feature"], 9)
    got = stats.histogram_columns(df, list("abcd"), 9)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_dedupe_plan_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([("k", "t", "g", 1)], "track_id string, kafka_timestamp string, track_genre string, v int")
    p = plan(clean.dedupe(df))
    assert "SortAggregate" not in p and p.count("WindowGroupLimit") == 2


# ---------------------------------------------------------------- CSV

HARD = ["plain", "a\nb", "a\r\nb", "\\", "\\n", "\\\n", "\\\\n\r", 'q"uo"te', "comma, and\ttab", "\n", None, "é中🙂", "\\r\\"]


def _texts(spark):
    return spark.createDataFrame(list(enumerate(HARD)), "id int, s string")


def test_line_ends_are_refused_escaped_or_multi_line(spark):
    df = _texts(spark)
    with pytest.raises(Exception, match="column s holds a line end"):
        results.write_csv(df, scratch_path(spark, "csv"))
    for mode, back in (("escape", "escaped"), ("multi_line", "multi_line")):
        path = scratch_path(spark, "csv")
        results.write_csv(df, path, line_ends=mode)
        got = {r.id: r.s for r in results.read_csv(spark, path, df.schema, line_ends=back).collect()}
        one = lambda x: x if x is None or mode == "escape" else x.replace("\r\n", "\n").replace("\r", "\n")  # noqa: E731  the parser may normalise quoted line ends
        assert {i: one(x) for i, x in got.items()} == {i: one(x) for i, x in enumerate(HARD)}
    plain = df.where(~F.coalesce(F.col("s"), F.lit("")).rlike("[\r\n]"))
    path = scratch_path(spark, "csv")
    results.write_csv(plain, path)
    assert results.read_csv(spark, path, df.schema).exceptAll(plain).count() == 0


def test_byte_order_mark_is_written_and_read(spark):
    df = spark.createDataFrame([(1, "ä"), (2, "b")], "id int, name string")
    path = scratch_path(spark, "bom")
    results.write_csv(df, path, single_file=True, bom=True)
    data = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert [d[:3] for d in data] == [b"\xef\xbb\xbf"] and data[0].count(b"\xef\xbb\xbf") == 1
    assert sorted(map(tuple, results.read_csv(spark, path, df.schema).collect())) == [(1, "ä"), (2, "b")]
    assert results.raw_csv(spark, path).columns == ["id", "name"]


def test_malformed_fields_are_null_and_counted(spark):
    path = scratch_path(spark, "raw")
    lines = ["\ufeff,name,n,x,day", "0,a,1,1.5,2024-01-01", "1,b,one,2,2024-02-30", "2,,3000000000,nan,", '3,"c, d",4,x,2024-01-03', "4,e"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("name", T.StringType())])
    raw = results.raw_csv(spark, path)
    assert raw.columns == ["_c0", "name", "n", "x", "day"]
    rows = {r.name: (str(r.day) if r.day else None, r.n, r.x) for r in results.typed(raw, schema).collect()}
    assert rows["a"] == ("2024-01-01", 1, 1.5) and rows["b"] == (None, None, 2.0) and rows["c, d"] == ("2024-01-03", 4, None) and rows["e"] == (None, None, None)
    report = {r.field: (r.present, r.rejected, r.example) for r in results.rejects(raw, schema).collect()}
    assert report == {"day": (3, 1, "2024-02-30"), "n": (4, 2, "3000000000"), "x": (4, 1, "x"), "name": (4, 0, None)}
    with pytest.raises(ValueError, match="missing columns \\['absent'\\]"):
        results.typed(raw, T.StructType([T.StructField("absent", T.StringType())]))


def test_required_results_may_be_documents(spark):
    root = scratch_path(spark, "req")
    df = spark.createDataFrame([("m", 0.5)], "model string, f1 double")
    results.write_json(df, f"{root}/best")
    results.write_csv(df, f"{root}/all", bom=True)
    got = results.load_required(spark, root, {"best": df.schema, "all": df.schema}, {"best": "json"})
    assert {n: [tuple(r) for r in d.collect()] for n, d in got.items()} == {"best": [("m", 0.5)], "all": [("m", 0.5)]}
    with pytest.raises(FileNotFoundError, match="nothere"):
        results.load_required(spark, root, {"best": df.schema, "nothere": df.schema}, {"best": "json"})


# ---------------------------------------------------------------- catalog layers

def test_catalog_layer_is_overwritten_while_it_is_read(spark):
    name, place = f"lay_{random.randrange(10**9)}", scratch_path(spark, "cat")
    first, n = tables.write_catalog_layer(spark.range(10).toDF("a"), name, place)
    old = spark.table(name)
    assert n == 10
    second, n = tables.write_catalog_layer(spark.table(name).where("a > 3").withColumn("b", F.col("a") * 2), name, place)
    assert n == 6 and spark.table(name).columns == ["a", "b"] and spark.table(name).count() == 6
    assert old.count() == 10  # a reader that started earlier
    assert tables.catalog_versions(spark, name) == sorted([first, second])
    assert tables.prune_catalog_layer(spark, name, keep=1) == [first] and spark.table(name).count() == 6
