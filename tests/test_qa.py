"""All checks together against each check by itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plinth.operators import qa
from plinth.plans.cloud_queries import numbered
from plinth.plans.standins import view

from .conftest import DATA


def cloud(spark):
    """A dense tile with all kinds of defects, one with a class missing, one point alone, and a tile on a line."""
    rng = np.random.default_rng(5)

    def tile(name, n, width, kinds):
        x, y = rng.uniform(0, width, n), rng.uniform(0, width, n)
        return pd.DataFrame({"tile_id": name, "x": x, "y": y, "z": rng.normal(0, 0.3, n) + rng.choice([0.0, 3.0], n), "classification": rng.choice(kinds, n), "intensity": rng.integers(0, 250, n)})

    parts = [tile(1, 5400, 20.0, [2, 3, 4, 5, 6, 7]), tile(2, 900, 6.0, [1, 2, 6]), tile(3, 1, 1.0, [2]), tile(4, 60, 4.0, [7])]
    blob = tile(1, 90, 0.4, [6]).assign(intensity=rng.integers(300, 9000, 90))
    line = tile(5, 40, 3.0, [2]).assign(y=1.0)
    rows = pd.concat([*parts, blob, line], ignore_index=True)
    rows["pid"] = [f"p{i}" for i in range(len(rows))]
    rows["gps_time"] = np.arange(len(rows)) * 0.5 + (np.arange(len(rows)) > 700) * 100
    rows["scan_angle"] = rng.uniform(-30, 30, len(rows))
    return spark.createDataFrame(rows).withColumns({"classification": F.col("classification").cast("int"), "intensity": F.col("intensity").cast("int")})


def issues_of(df):
    return sorted((r["tile_id"], r["issue_type"], r["severity"], round(r["value"], 9) + 0.0) for r in df.collect())


@pytest.mark.parametrize("which", ["cloud", "tables"])
def test_all_checks_find_what_each_finds(spark, which):
    p = cloud(spark) if which == "cloud" else numbered(view(spark, f"{DATA}/sf0.001", "points")).where("tile_id <= 3")
    together = qa.run_checks(p, "tile_id", list(qa.RULES)).toPandas()  # the others have no rules and are run as they are
    for name in qa.RULES:
        own = issues_of(qa.CHECKS[name](p, "tile_id"))
        found = [tuple(r) for r in together[together["check"] == name][["tile_id", "issue_type", "severity", "value"]].itertuples(index=False)]
        assert sorted((t, i, s, round(v, 9) + 0.0) for t, i, s, v in found) == own, name
    if which == "cloud":
        assert {"density", "outliers", "blooming", "class_noise", "edge_class", "noise_points", "completeness", "misclassification", "alignment"} <= set(together["check"])


def test_few_checks_and_no_points(spark):
    p = cloud(spark)
    assert {r["check"] for r in qa.run_checks(p, "tile_id", ["completeness"]).collect()} == {"completeness"}
    assert qa.run_checks(p.limit(0), "tile_id", ["density", "completeness", "class_noise"]).count() == 0


def striped(spark):
    """cloud() with stripes, gaps in time over which heights change, points of one time, unknown heights and classes, and one place alone."""
    p = cloud(spark).unionByName(cloud(spark).where("tile_id = 2").withColumn("tile_id", F.lit(6)))
    stripes = cloud(spark).where("tile_id = 1").withColumns({"tile_id": F.lit(7), "z": F.sin(F.col("x")) * 3.0 + F.col("z") * 0.01, "gps_time": F.floor(F.col("gps_time") / 4.0) * 4.0 + F.when(F.col("gps_time") > 900, 500.0).otherwise(0.0)})
    jumps = cloud(spark).where("tile_id = 2").withColumns({"tile_id": F.lit(8), "z": F.when(F.col("gps_time") % 97 < 45, F.col("z") + 4).otherwise(F.col("z")), "gps_time": F.col("gps_time") + F.floor(F.col("gps_time") / 45) * 300})
    place = cloud(spark).where("tile_id = 4").withColumns({"tile_id": F.lit(9), "x": F.lit(1.5), "y": F.lit(2.5)})
    odd = {"z": F.when((F.col("tile_id") == 6) & (F.col("pid") == "p5500"), F.lit(None)).otherwise(F.col("z")), "classification": F.when((F.col("tile_id") == 9) & (F.col("scan_angle") > 20), F.lit(None)).otherwise(F.col("classification"))}
    return p.unionByName(stripes).unionByName(jumps).unionByName(place).withColumns(odd)


def test_whole_tiles_are_told_as_by_joins(spark, monkeypatch):
    """all columns of a tile, and all issues with those of stripes and gaps; tiles with unknown numbers take the joins."""
    from plinth.operators import groups

    monkeypatch.setattr(groups, "SMALL", 1 << 13)
    p = striped(spark).persist()
    names = ["density", "striping", "alignment", "edge_artifacts", "blind_spots", "completeness", "misclassification"]
    whole = qa.whole_tiles(p, "tile_id").toPandas().set_index("tile_id").sort_index()
    assert list(whole.index[whole["odd"]]) == [6, 9]
    own, joined = whole[~whole["odd"]], qa.tile_statistics(p, "tile_id").toPandas().set_index("tile_id").sort_index()
    joined = joined.loc[own.index]
    assert set(joined.columns) == set(own.columns) - {"striping", "jumps", "odd"}
    for c in joined.columns:
        np.testing.assert_allclose(own[c].astype(float), joined[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
    found = lambda: sorted((r["check"], r["tile_id"], r["issue_type"], r["severity"], round(r["value"], 7) + 0.0) for r in qa.run_checks(p, "tile_id", names).collect())
    got = found()
    assert {"striping", "alignment"} <= {g[0] for g in got if g[3] == "error"} and {6, 9} <= {g[1] for g in got}
    monkeypatch.setattr(groups, "SMALL", 0)
    assert found() == got
    p.unpersist()
