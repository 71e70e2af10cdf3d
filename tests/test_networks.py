"""Networks from a table of their units."""

import numpy as np
import pytest

from gridjobs.operators import score

SCHEMA = "member int, layer int, unit int, weights array<double>, bias double, mean double, variance double, gain double, shift double"


def units(width=3, hidden=(4, 2), members=2):
    r = np.random.default_rng(1)
    sizes = (width, *hidden, 1)
    return [(m, i, j, r.standard_normal(sizes[i]).tolist(), *r.random(5).tolist()) for m in range(members) for i in range(3) for j in range(sizes[i + 1])]


def saved(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/w")
    return f"{tmp_path}/w"


def by_hand(rows, m, x):
    for i in range(3):
        own = sorted(r[2:] for r in rows if r[:2] == (m, i))
        y = [float(np.dot(x, w)) + bias for _, w, bias, *_ in own]
        x = y if i == 2 else [max(0.0, (a - mean) / (var + 1e-5) ** 0.5 * gain + shift) for a, (_, _, _, mean, var, gain, shift) in zip(y, own, strict=True)]
    return x[0]


def test_stored_networks_score_rows(spark, tmp_path):
    rows = units()
    members = score.load_members(spark, saved(spark, rows, tmp_path))
    df = spark.createDataFrame([(1, [0.5, -1.0, 2.0]), (2, None), (3, [1.0, 2.0]), (4, [1.0, None, 1.0])], "k int, f array<double>")
    got = {(r.k, r.member): r.prediction for r in score.predict(df, ["k"], "f", members).collect()}
    for m in range(2):
        assert got[1, m] == pytest.approx(by_hand(rows, m, [0.5, -1.0, 2.0]))
        assert got[2, m] is got[3, m] is got[4, m] is None


@pytest.mark.parametrize(("spoil", "said"), [
    (lambda r: r[1:], "numbered from 0"), (lambda r: [x for x in r if x[1] != 1], "has the layers"), (lambda r: [(*r[0][:3], [1.0], *r[0][4:]), *r[1:]], "not all units"),
    (lambda r: [*r[:-1], (*r[-1][:4], None, *r[-1][5:])], "null or non-finite"), (lambda r: [(*r[0][:6], -1.0, *r[0][7:]), *r[1:]], "negative variance"),
    (lambda r: [*r, *[(2, *x[1:]) for x in units(5, members=1)]], "unlike numbers"), (lambda r: r[:0], "no network"), (lambda r: [*r, (1, 2, 1, [1.0, 2.0], *[0.0] * 5)], "2 outputs"),
])
def test_faulty_networks_are_refused(spark, tmp_path, spoil, said):
    with pytest.raises(ValueError, match=said):
        score.load_members(spark, saved(spark, spoil(units()), tmp_path))


def test_networks_are_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(score, "MOST_NUMBERS", 20)
    with pytest.raises(ValueError, match="more than 20"):
        score.load_members(spark, saved(spark, units(), tmp_path))
