"""What must not grow with the input: tables sent through the driver, rows in a shuffle, ranks that hang on the order of sums."""

import __spark_entry__ as entry
from checks.cells import _total
from spotframe.operators.distance import morph
from spotframe.operators.labels import components
from spotframe.operators.focus import gaussian_rows, gaussian_weights
from spotframe.operators.specks import windowed_max
from spotframe.operators.thresholds import otsu
from spotframe.session import ESTIMATED, MEASURED, configure

SF = "/root/testdata/sf0.001"


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_tables_are_not_broadcast_by_estimate(spark):
    queries = entry.queries()
    for name in ("above_floor_intensity", "classify_nucleolus", "coloc_metrics", "drop_floaters", "disk_mean_clipped"):
        assert "BroadcastExchange" not in planned(queries[name](spark, SF)), name


def test_broadcast_limits_are_given_back(spark):
    other = spark.newSession()
    other.conf.set(ESTIMATED, "256k")
    configure(configure(other))
    assert (other.conf.get(ESTIMATED), other.conf.get(MEASURED)) == ("-1", "256k")
    configure(configure(other, measured_broadcasts=False), measured_broadcasts=False)
    assert other.conf.get(ESTIMATED) == "256k" and other.conf.get(MEASURED, None) is None


def test_equal_spots_give_equal_totals_in_any_order(spark):
    rows = [(g, p) for g, order in enumerate(([0.1, 0.2, 0.3], [0.3, 0.2, 0.1])) for p in order]
    sums = spark.createDataFrame(rows, "g int, peak double").coalesce(1).groupBy("g").agg(_total("peak").alias("s")).select("s").distinct()
    assert sums.collect() == [(0.6,)]


def test_morph_shuffles_words_not_pixels(spark):
    assert "partial_bit_or" in planned(entry.queries()["morph_open"](spark, SF))


def test_morph_words_meet_at_every_column(spark):
    rows = [(1, 2, x) for x in (-1, 0, 62, 63, 64, 65, 127, 128, 129, 130)] + [(1, -1, 5), (1, 9, 5), (1, None, 3), (1, 3, None), (2, 0, 500)]
    mask = spark.createDataFrame(rows * 2, "image long, y long, x long")
    frames = spark.createDataFrame([(1, 4, 130), (2, 4, 130)], "image long, height int, width int")
    got = [tuple(r) for r in morph(mask, frames, "dilate", 1.0).collect()]
    steps = ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))
    want = {(1, 2 + dy, x + dx) for x in (0, 62, 63, 64, 65, 127, 128, 129) for dy, dx in steps if 0 <= x + dx < 130}
    assert sorted(got) == sorted(want)


def test_floors_are_sent_to_the_spots(spark):
    assert "hashpartitioning" not in planned(entry.queries()["floor_spots"](spark, SF))


def test_otsu_takes_the_lower_of_equal_splits(spark):
    values = {
        1: [42090, 60357, 44227, 62580, 11143, 32531, 31763, 60871],
        2: [25293, 32588, 52759, 37888, 56425, 54665, 32811, 56270, 38559, 23121, 5257, 43190],
        3: [5582, 28138, 4448, 43110, 29408, 29824, 21307, 34536, 44520, 64013],
    }
    pixels = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k int, v double")
    got = dict(otsu(pixels, "v", ["k"]).collect())
    assert got == {1: 32541.595703125, 2: 32739.8125, 3: 21316.994140625}


def test_windowed_max_keeps_short_stacks(spark):
    rows = spark.createDataFrame([(1, 0, 0, 0, [1.0, 5.0]), (2, 0, 0, 0, [1.0, 2.0]), (2, 0, 1, 0, [7.0, 1.0])], "image long, channel int, z int, y long, vals array<double>")
    scores = spark.createDataFrame([(1, 0, 0, 1.0, 1.0), (2, 0, 0, 1.0, 1.0), (2, 0, 1, 3.0, 1.0)], "image long, channel int, z int, score double, mean double")
    got = {(r["image"], r["x"]): r["v"] for r in windowed_max(rows, scores).collect()}
    assert {k[0] for k in got} == {1, 2} and got[1, 1] == 5.0


def test_pooled_range_reads_its_pixels_once(spark):
    # what is left after the stored counts must not go back to the pixels
    assert "Scan parquet" not in planned(entry.queries()["pooled_range"](spark, SF))


def test_gaussian_smooths_batches_of_rows(spark):
    query = planned(entry.queries()["gaussian_smooth"](spark, SF))
    assert "MapInArrow" in query and query.count("explode(") == query.count("posexplode(") + 1
    planes = {(1, y): [float((7 * y + 3 * x) % 11) for x in range(5)] for y in range(3)} | {(2, y): [float(y * y + x) for x in range(70)] for y in range(40)}
    planes[2, 20][30] = None
    rows = spark.createDataFrame([(i, y, v) for (i, y), v in planes.items()], "image long, y long, vals array<double>").repartition(4)
    got = {(r["image"], r["y"]): r["vals"] for r in gaussian_rows(rows, 1.5).collect()}
    weights = gaussian_weights(1.5)
    mirror = lambda i, n: min(i % (2 * n), 2 * n - 1 - i % (2 * n))
    for (i, y), v in planes.items():
        h, w = (3, 5) if i == 1 else (40, 70)
        for x in range(w):
            square = [(planes[i, mirror(y + dy - 6, h)][mirror(x + dx - 6, w)], a * b) for dy, a in enumerate(weights) for dx, b in enumerate(weights)]
            if any(p is None for p, _ in square):
                assert got[i, y][x] is None
            else:
                assert abs(got[i, y][x] - sum(p * c for p, c in square)) < 1e-9


def test_components_reach_over_bands_and_words(spark):
    import random

    rng = random.Random(6)
    snake = [(1, y, 60 + y % 7) for y in range(600)] + [(1, 300, x) for x in range(20, 200)] + [(1, 599, x) for x in range(66, 140)]
    noise = [(2, rng.randrange(500, 530), rng.randrange(-70, 140)) for _ in range(2500)]
    pixels = snake + noise + noise[:50] + [(2, None, 3)]
    mask = spark.createDataFrame(pixels, "image long, y long, x long").repartition(5)
    for connectivity, steps in ((4, ((0, 1), (1, 0))), (8, ((0, 1), (1, 0), (1, 1), (1, -1)))):
        ids = {p: (p[1] << 31) + p[2] for p in pixels if p[1] is not None}
        links = [(p, q) for p in ids for dy, dx in steps if (q := (p[0], p[1] + dy, p[2] + dx)) in ids]
        moved = True
        while moved:
            moved = False
            for p, q in links + links[::-1]:
                if ids[p] != ids[q]:
                    ids[p] = ids[q] = min(ids[p], ids[q])
                    moved = True
        got = components(mask, connectivity).collect()
        assert len(got) == len(ids) and {(r["image"], r["y"], r["x"]): r["component"] for r in got} == ids
