import math
import random

import pytest

from shelfwise.operators import places


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_reference_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    refs = [("dense", 32 + rng.random() / 50, 34.8 + rng.random() / 50) for _ in range(300)]
    refs += [("two", 29.5, 34.9), ("two", 33.2, 35.6), ("edge", 31.0, 35.0), ("far", -40.0, -170.0), ("", 32.0, 34.8), ("none", None, None)]
    refs += [("spread", 29.4 + 4 * rng.random(), 34.2 + 1.6 * rng.random()) for _ in range(60)]
    points = [(f"p{k}", rng.choice(["dense", "two", "edge", "far", "spread", "unknown", ""]), 29.4 + 4 * rng.random(), 34.2 + 1.6 * rng.random()) for k in range(150)]
    points += [("same", "edge", 31.0, 35.0), ("twice", "dense", 32.01, 34.81), ("again", "dense", 32.01, 34.81), ("null", "dense", None, None)]
    found = places.nearest_reference_km(spark.createDataFrame(points, "branch_uid string, city string, lat double, lon double"),
                                        spark.createDataFrame(refs, "city string, lat double, lon double"))
    got = {r.branch_uid: r.km for r in found.collect()}
    assert len(got) == len(points)
    for uid, city, lat, lon in points:
        own = [km((lat, lon), r[1:]) for r in refs if lat is not None and r[0] == city != "" and r[1] is not None]
        assert (got[uid] is None and not own) or got[uid] == pytest.approx(min(own), abs=1e-6)


def test_no_join_is_on_the_city_alone(spark, capsys):
    frame = spark.createDataFrame([("p", "c", 32.0, 34.8)], "branch_uid string, city string, lat double, lon double")
    places.nearest_reference_km(frame, frame.select("city", "lat", "lon")).explain()
    joins = [line for line in capsys.readouterr().out.splitlines() if "Join" in line]
    assert joins and not any("[city#" in j and "_y" not in j and "_py" not in j and "lat" not in j for j in joins)
