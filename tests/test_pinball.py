"""Boosted quantiles: each pass against brute force, and held-out loss against a forest's and against constants."""

import numpy as np

from voltfleet.operators import models, pinball

Q = (0.1, 0.5, 0.9)


def made(n, seed):
    """Labels whose spread and level depend on two of three features."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 1, (n, 3))
    y = 2 * x[:, 0] + (0.2 + 2 * x[:, 1]) * rng.normal(size=n)
    return [(i, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(x, y, strict=True))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(3)


def test_counts_cuts_and_leaves_equal_brute_force(spark):
    rows = made(700, 1)
    df = frame(spark, rows)
    model = pinball.fit(df, ["a", "b", "c"], "y", Q, trees=2, depth=2, rate=0.5, bins=8, least=30)
    x, y = np.array([r[1:4] for r in rows]), np.array([r[4] for r in rows])
    bins = model.bins(x)
    for m, q in enumerate(Q):
        now = np.full(len(y), np.quantile(y, q, method="inverted_cdf"))
        for tree in range(2):
            gradient = np.where(y > now, q, q - 1)
            part = np.zeros(len(y), dtype=int)
            for level in range(2):
                nxt = part.copy()
                for node in range(1 << level):
                    inside = part == node
                    g = gradient[inside]
                    gains = {}
                    for f in range(3):
                        for cut in range(10):
                            left = bins[inside, f] <= cut
                            if min(left.sum(), (~left).sum()) >= 30:
                                gains[f, cut] = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / len(g)
                    place = (1 << level) - 1 + node
                    chosen = model.feature[m, tree, place], model.cut[m, tree, place]
                    assert abs(gains[chosen] - max(gains.values())) < 1e-6
                    nxt[inside] = 2 * node + (bins[inside, chosen[0]] > chosen[1])
                part = nxt
            for leaf in range(4):
                inside = part == leaf
                value = 0.5 * np.quantile((y - now)[inside], q, method="inverted_cdf")
                assert abs(model.value[m, tree, leaf] - value) < 1e-9
            now = now + model.value[m, tree][part]
        assert np.allclose(model.predict(bins, m), now)


def test_held_out_loss_is_under_the_forests_and_the_constants(spark):
    train, asked = frame(spark, made(4000, 2)), frame(spark, made(4000, 3)).cache()
    features = ["a", "b", "c"]
    got = pinball.predict(pinball.fit(train, features, "y", Q), asked, "id").join(asked, "id")
    ours = pinball.loss(got, "y", Q).first()
    forest = pinball.loss(models.quantile_forest(train, asked, features, "y", Q), "y", Q).first()
    flat = np.quantile([r[4] for r in made(4000, 2)], Q)
    y = np.array([r[4] for r in made(4000, 3)])
    constants = [np.maximum(q * (y - c), (q - 1) * (y - c)).mean() for q, c in zip(Q, flat, strict=True)]
    assert ours["n"] == forest["n"] == 4000
    assert all(a < 0.9 * c for a, c in zip(ours["loss"], constants, strict=True))
    assert sum(ours["loss"]) < sum(forest["loss"])
    assert all(abs(u - q) < 0.04 for u, q in zip(ours["under"], Q, strict=True))
    assert all(r["q"] == sorted(r["q"]) for r in got.select("q").collect())


def test_the_order_of_rows_changes_nothing(spark):
    rows = made(300, 4)
    a, b = (pinball.fit(frame(spark, r).repartition(k), ["a", "b"], "y", Q, trees=2, depth=2) for r, k in ((rows, 2), (rows[::-1], 5)))
    assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in ("start", "feature", "cut", "value"))


def test_odd_tables(spark):
    nan = float("nan")
    rows = [(i, 1.0 if i % 2 else None, nan if i % 3 else 2.0, None, float(i % 2)) for i in range(200)] + [(900, 1.0, 1.0, 1.0, None), (901, 1.0, 1.0, 1.0, nan)]
    df = frame(spark, rows)
    model = pinball.fit(df, ["a", "b", "c"], "y", (0.5,), trees=8, depth=2, rate=0.9)
    out = {r["id"]: r["q"][0] for r in pinball.predict(model, df, "id").collect()}
    assert len(out) == 202 and abs(out[1] - 1) < 0.01 and abs(out[2]) < 0.01  # a null is a bin of its own
    none = pinball.fit(df.where("false"), ["a", "b", "c"], "y", Q)
    assert all(x != x for x in pinball.predict(none, df.limit(1), "id").first()["q"])
    assert pinball.predict(model, df.where("false"), "id").count() == 0
    same = pinball.fit(df.selectExpr("id", "a", "b", "c", "5.0D as y"), ["a", "b", "c"], "y", Q, trees=2)
    assert pinball.predict(same, df, "id").selectExpr("q").distinct().collect()[0]["q"] == [5.0, 5.0, 5.0]


def test_fit_computes_its_rows_twice_only(spark):
    """Once for the bins' edges and once to store the bins, each feature a column of its own, whatever the number of passes."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = frame(spark, made(300, 5)).mapInArrow(counted, "id long, a double, b double, c double, y double")
    pinball.fit(df, ["a", "b", "c"], "y", Q, trees=2, depth=2)
    assert read.value == 600


def test_a_node_is_one_compare_for_each_cut(spark):
    """Columns of the packed bins are contiguous, and nodes equal a walk of each row."""
    model = pinball.fit(frame(spark, made(700, 6)), ["a", "b", "c"], "y", Q, trees=2, depth=3)
    bins = model.bins(np.array([r[1:4] for r in made(200, 7)]))
    for m in range(3):
        walked = []
        for row in bins:
            at = 0
            for level in range(3):
                place = (1 << level) - 1 + at
                at = 2 * at + int(row[model.feature[m, 1, place]] > model.cut[m, 1, place])
            walked.append(at)
        assert model.node(bins, m, 1, 3).tolist() == walked
    batch = pinball.pa.RecordBatch.from_pydict({"y": [1.0, 2.0], "bin0": [3, 4], "bin1": [5, 6]})
    y, columns = pinball._unpacked(batch)
    assert columns.tolist() == [[3, 5], [4, 6]] and columns[:, 1].flags.c_contiguous
