import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tillmark.operators import intervals as module
from tillmark.operators.intervals import interval_join, sweep_join
from tillmark.plans import catalog, standins

D = dt.date


def days(offset):
    return D(2024, 1, 1) + dt.timedelta(days=offset)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    points = [(i, rng.choice(["hot", "hot", "a", "b", None]), rng.choice([days(rng.randrange(-20, 420)), None])) for i in range(300)]
    intervals = []
    for n in range(60):
        start = rng.randrange(-50, 400)
        end = rng.choice([None, days(start + rng.randrange(-2, 200)), D(9999, 12, 31)])
        intervals.append((rng.choice(["hot", "a", "c"]), n, days(start), end))
    return points, intervals


def frames(spark, data):
    return (
        spark.createDataFrame(data[0], "id int, code string, day date"),
        spark.createDataFrame(data[1], "code string, sk int, f date, t date"),
    )


def brute(data, bounds, how):
    out = []
    for i, code, day in data[0]:
        hits = [
            sk for c, sk, f, t in data[1]
            if code is not None and c == code and day is not None and day >= f and (t is None or (day <= t if bounds == "[]" else day < t))
        ]
        out += [(i, sk) for sk in hits] or ([(i, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("bounds", ["[]", "[)"])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("slices", [{}, {"slice_days": 30, "horizon": (days(0), days(366))}, {"slice_days": 7, "horizon": (days(100), days(140))}])
def test_equals_brute_force(spark, data, bounds, how, slices):
    points, intervals = frames(spark, data)
    got = interval_join(points, intervals, ["code"], "day", "f", "t", bounds, how, **slices)
    assert got.columns == ["id", "code", "day", "sk", "f", "t"]
    assert rows(got.select("id", "sk")) == brute(data, bounds, how)


def test_last_day_of_a_revision(spark):
    """Closed revisions: the half-open join loses the last day, the closed join prices it."""
    sale = spark.createDataFrame([(1, D(2023, 10, 12)), (1, D(2023, 10, 13))], "sk int, day date")
    price = spark.createDataFrame(
        [(1, 87.95, D(2022, 1, 1), D(2023, 10, 12)), (1, 97.55, D(2023, 10, 13), D(9999, 12, 31))], "sk int, price double, f date, t date"
    )
    half = interval_join(sale, price, ["sk"], "day", "f", "t", "[)", "inner")
    closed = interval_join(sale, price, ["sk"], "day", "f", "t", "[]", "inner")
    assert rows(half.select("price")) == [(97.55,)]
    assert rows(closed.select("price")) == [(87.95,), (97.55,)]


def test_small_side_is_broadcast_large_side_is_not(spark, data, tmp_path):
    points, intervals = frames(spark, data)
    intervals.write.parquet(str(tmp_path / "i"))
    stored = spark.read.parquet(str(tmp_path / "i"))
    assert "BroadcastHashJoin" in plan_of(interval_join(points, stored, ["code"], "day", "f", "t"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = plan_of(interval_join(points, stored, ["code"], "day", "f", "t"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_key_is_split_when_shuffled(spark, tmp_path):
    """A key with most rows is joined by several tasks once the dimension is not broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        points = spark.range(0, 60000, 1, 6).select(
            "id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("code"),
            F.date_add(F.lit(days(0)), (F.col("id") % 300).cast("int")).alias("day"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        codes = spark.range(97).select(F.concat(F.lit("k"), F.col("id")).alias("code")).union(spark.sql("select 'hot'"))
        validity = codes.select("code", F.lit(days(0)).alias("f"), F.lit(None).cast("date").alias("t"), F.hash("code").alias("sk"))
        joined = interval_join(points, validity, ["code"], "day", "f", "t")
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bad_arguments(spark, data):
    points, intervals = frames(spark, data)
    with pytest.raises(ValueError):
        interval_join(points, intervals, ["code"], "day", "f", "t", "()")
    with pytest.raises(ValueError):
        interval_join(points, intervals, ["code"], "day", "f", "t", slice_days=3)


@pytest.mark.parametrize("bounds", ["[]", "[)"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_equals_brute_force(spark, data, bounds, how):
    """Keys "hot" and "a" have overlapping intervals; "b" and "x" are swept, "x" over several ranges."""
    rng = random.Random(12)
    edges = sorted(rng.sample(range(-40, 400), 30))
    apart = [("x", 100 + n, days(a), rng.choice([days(b - 1), days(a)])) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
    apart += [("x", 200, days(edges[-1]), None), ("x", 201, days(50), days(40)), ("x", 202, None, days(40)), (None, 203, days(0), None)]
    points = data[0] + [(1000 + i, "x", days(rng.randrange(-60, 450))) for i in range(500)] + [(2000, None, None)]
    every = (points, data[1] + apart)
    sound = (points, [r for r in every[1] if r[0] is not None and r[2] is not None])
    left, right = frames(spark, every)
    got = sweep_join(left, right, ["code"], "day", "f", "t", bounds, how, parts=7)
    assert got.columns == ["id", "code", "day", "sk", "f", "t"]
    assert rows(got.select("id", "sk")) == brute(sound, bounds, how)


def test_sweep_spreads_a_hot_key(spark):
    """No key join of points and intervals remains for a key that is hot on both sides and free of overlaps."""
    points = spark.range(6000).select("id", F.lit("hot").alias("code"), F.date_add(F.lit(days(0)), (F.col("id") % 3000).cast("int")).alias("day"))
    validity = spark.range(3000).select(
        F.lit("hot").alias("code"), F.col("id").alias("sk"), F.date_add(F.lit(days(0)), F.col("id").cast("int")).alias("f"), F.date_add(F.lit(days(0)), F.col("id").cast("int")).alias("t")
    )
    got = sweep_join(points, validity, ["code"], "day", "f", "t", "[]", "inner", parts=8)
    assert got.where(F.col("sk") == F.col("id") % 3000).count() == 6000 == got.count()
    with pytest.raises(ValueError):
        sweep_join(points, validity, ["code"], "day", "f", "t", "[]", "right")


@pytest.fixture
def stored(monkeypatch):
    """Plans of what the sweep stores, by name."""
    plans, keep = {}, module.stage

    def noted(df, name, *rest):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name, *rest)

    monkeypatch.setattr(module, "stage", noted)
    return plans


def apart(rng, keys, first):
    """Revisions of each key that do not overlap, with gaps."""
    out = []
    for key in keys:
        edges = sorted(rng.sample(range(-40, 400), 12))
        out += [(key, first + len(out), days(a), rng.choice([days(b - 1), days(a)])) for a, b in zip(edges, edges[1:])]
        out.append((key, first + len(out), days(edges[-1]), None))
    return out


def test_sweep_shuffles_cold_keys_once(spark, stored):
    """No ranges, no stored stream and no join: one sort by key gives every point its price."""
    rng = random.Random(13)
    keys = [f"k{n}" for n in range(20)]
    points = [(i, rng.choice([*keys, "none", None]), days(rng.randrange(-60, 450))) for i in range(600)]
    every = (points, apart(rng, keys, 0))
    got = sweep_join(*frames(spark, every), ["code"], "day", "f", "t")
    assert sorted(stored) == ["swept", "tangled"]
    assert "Repartition" not in stored["swept"] and "Join" not in stored["swept"]
    assert rows(got.select("id", "sk")) == brute(every, "[]", "left")
    assert "Join" not in plan_of(got)


@pytest.mark.parametrize("bounds", ["[]", "[)"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_of_hot_and_cold_keys(spark, stored, bounds, how):
    """"x" and the overlapping "y" are hot and go over ranges; "k0" to "k59" and the overlapping "z" are not."""
    rng = random.Random(14)
    keys = [f"k{n}" for n in range(60)]
    right = apart(rng, [*keys, "x", "y", "z"], 0) + [("y", 5000, days(0), days(300)), ("z", 5001, days(0), days(300))]
    points = [(i, rng.choice([*keys, "z", None]), rng.choice([days(rng.randrange(-60, 450)), None])) for i in range(600)]
    points += [(1000 + i, "x" if i % 2 else "y", days(rng.randrange(-60, 450))) for i in range(1200)]
    every = (points, right)
    got = sweep_join(*frames(spark, every), ["code"], "day", "f", "t", bounds, how, parts=4, hot_rows=100)
    assert got.columns == ["id", "code", "day", "sk", "f", "t"]
    assert "stream" in stored and "RepartitionByExpression" in stored["stream"]
    assert rows(got.select("id", "sk")) == brute(every, bounds, how)


def test_sweep_of_nothing(spark):
    points, intervals = frames(spark, ([(1, "a", days(0)), (2, None, days(0))], [("a", 1, days(0), None)]))
    none = sweep_join(points, intervals.where("false"), ["code"], "day", "f", "t")
    assert rows(none.select("id", "sk")) == [(1, None), (2, None)]
    assert rows(sweep_join(points.where("false"), intervals, ["code"], "day", "f", "t")) == []


@pytest.fixture(scope="module")
def retail(spark, tmp_path_factory):
    """Two products over three months; product 50 is reissued in July 1998; the last line is no revenue."""
    root = tmp_path_factory.mktemp("retail")
    at = [D(1997, 3, 5), D(1997, 3, 20), D(1997, 5, 1), D(1998, 6, 30), D(1998, 7, 1), D(1998, 7, 9)]
    lines = [
        (2 * n + part, 1, part, 2.0 + n, 10.0 * part + n, 0.0, "N", "O", day)
        for part in (1, 50) for n, day in enumerate(at)
    ] + [(901, 1, 1, 1.0, 99.0, 0.0, "A", "O", at[2]), (902, 1, None, 1.0, 5.0, 0.0, "N", "O", at[2])]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    spark.createDataFrame(lines, names).write.parquet(str(root / "lineitem.parquet"))
    part = [(1, "one", "Brand#1", 3), (50, "fifty", "Brand#2", 4)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(str(root / "part.parquet"))
    return str(root)


def test_revisions_are_made_without_dealing_lines(spark, retail):
    """Lines shrink to a price a month where they are read; the highest price of a month, to the day before the next."""
    prices = standins.price_revisions(spark, retail).where("product_sk is not null")
    assert "REPARTITION" not in plan_of(prices)
    first, may, june, july, far = D(1997, 3, 1), D(1997, 5, 1), D(1998, 6, 1), D(1998, 7, 1), D(9999, 12, 31)
    got = [(sk, float(price), start, end) for sk, price, start, end in rows(prices)]
    assert sorted(got) == [
        (2, 11.0, first, D(1997, 4, 30)), (2, 13.0, june, D(1998, 6, 30)), (2, 15.0, july, far), (2, 99.0, may, D(1998, 5, 31)),
        (100, 501.0, first, D(1997, 4, 30)), (100, 502.0, may, D(1998, 5, 31)), (100, 503.0, june, far), (101, 505.0, july, far),
    ]


def test_swept_prices_reads_the_lines_once_for_prices(spark, retail):
    """What is aggregated at the end comes from stored rows only; values against a plain sum."""
    got = catalog.swept_prices(spark, retail)
    assert not [f for f in got.inputFiles() if "lineitem" in f]
    by_month = {
        "1997-03": (4, 4, 2 * 11.0 + 3 * 11.0 + 2 * 501.0 + 3 * 501.0), "1997-05": (3, 2, 4 * 99.0 + 4 * 502.0),
        "1998-06": (2, 2, 5 * 13.0 + 5 * 503.0), "1998-07": (4, 4, 6 * 15.0 + 7 * 15.0 + 6 * 505.0 + 7 * 505.0),
    }
    assert {r.month: (r.lines, r.priced, r.list_value) for r in got.collect()} == by_month
