import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import resample


def weights(key, replicates, seed):
    """Poisson(1) by counting how many cumulative probabilities a draw passes."""
    cumulative = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(25)])
    digests = [hashlib.md5(f"{key}:{seed}:{c}".encode()).hexdigest() for c in range(-(-replicates // 4))]
    draws = [int(d[i : i + 8], 16) for d in digests for i in range(0, 32, 8)]
    return [int((u / 2**32 >= cumulative).sum()) for u in draws][:replicates]


def test_weights_are_poisson(spark):
    keys = [f"k{i}" for i in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = dict(df.select("k", resample.poisson_weights(F.col("k"), 30, 7)).collect())
    assert all(got[k] == weights(k, 30, 7) for k in keys)
    drawn = np.array(list(got.values()))
    assert abs(drawn.mean() - 1) < 0.04 and abs(drawn.var() - 1) < 0.08
    cuts = resample.poisson_cuts()
    assert cuts == sorted(set(cuts)) and 2**32 - cuts[-1] <= 2


def test_interval_against_brute_force(make):
    rng = np.random.default_rng(4)
    rows = [(g, f"{g}{i}", float(x)) for g, n in (("a", 60), ("b", 5)) for i, x in enumerate(rng.normal(size=n))]
    rows += [("a", "null value", None), ("a", "nan", float("nan")), (None, "no group", 1.0), ("c", "alone", 2.5), ("d", "x", None), ("b", None, 3.0)]
    df = make(rows, "g string, id string, x double")
    got = {r["g"]: r for r in resample.bootstrap_mean(df.repartition(7), "x", ["g"], "id", 50, seed=3).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    for g in "abc":
        known = [(i or "", x) for h, i, x in rows if h == g and x is not None and not math.isnan(x)]
        w = np.array([weights(i, 50, 3) for i, _ in known])
        x = np.array([x for _, x in known])
        held = w.sum(0) > 0
        means = (w * x[:, None]).sum(0)[held] / w.sum(0)[held]
        assert got[g]["n"] == len(known) and got[g]["mean"] == pytest.approx(x.mean())
        assert (got[g]["ci_low"], got[g]["ci_high"]) == pytest.approx(tuple(np.percentile(means, [2.5, 97.5])))
    assert tuple(got["d"])[1:] == (0, None, None, None)
    assert resample.bootstrap_mean(df.where("false"), "x", ["g"], "id", 8).count() == 0


def test_interval_holds_the_mean_as_often_as_it_says(make):
    rng = np.random.default_rng(11)
    df = make([(g, f"{g}-{i}", float(rng.exponential())) for g in range(200) for i in range(80)], "g int, id string, x double")
    held = resample.bootstrap_mean(df, "x", ["g"], "id", 120).where("1 between ci_low and ci_high").count()
    assert 0.86 * 200 <= held <= 0.99 * 200


def test_rows_are_folded_before_the_shuffle(make):
    df = make([("a", f"k{i}", float(i)) for i in range(50)], "g string, id string, x double")
    plan = resample.bootstrap_mean(df, "x", ["g"], "id", 12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Generate" not in plan and "Python" not in plan
