"""The classifiers against plain NumPy versions of their definitions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import bayes, classify, neural, newton, svm, trees

KIND = "k long, label double, x array<double>"


def frame(spark, x, y, parts=3):
    rows = [(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, KIND).repartition(parts)


def predictions(df):
    return np.array([r.prediction for r in sorted(df.collect(), key=lambda r: r.k)])


def counts(seed=0, n=160, d=7):
    """Scaled counts with many zeros and ties, labels that depend on them."""
    rng = np.random.default_rng(seed)
    x = np.minimum(rng.poisson(0.7, (n, d)), 4) / 4
    x[:, 3] = 0.0
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.25, n) > 0.3).astype(int)
    return x, y


# ------------------------------------------------------------ logistic, SVM
def test_logistic_reaches_the_minimum(spark):
    x, y = counts()
    w = newton.newton(frame(spark, x, y), 7, newton.logistic_loss)
    z = np.hstack([x, np.ones((len(x), 1))])
    p = 1 / (1 + np.exp(-z @ w))
    assert np.linalg.norm(z.T @ (p - y) + np.append(w[:-1], 0)) < 1e-8
    got = predictions(newton.logistic(frame(spark, x, y), frame(spark, x, y, 1), 7, "k"))
    assert (got == (z @ w > 0)).all()


def exact_dual(x, y, gamma, c=1.0, rounds=4000):
    """Dual of the kernel machine by two-variable steps of largest violation."""
    s = 2.0 * y - 1
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    a, g = np.zeros(len(x)), -np.ones(len(x))
    for _ in range(rounds):
        up = np.where(((s > 0) & (a < c)) | ((s < 0) & (a > 0)), -s * g, -np.inf)
        low = np.where(((s < 0) & (a < c)) | ((s > 0) & (a > 0)), -s * g, np.inf)
        i, j = int(up.argmax()), int(low.argmin())
        if up[i] - low[j] < 1e-6:
            break
        t = (up[i] - low[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        t = min(t, c - a[i] if s[i] > 0 else a[i], a[j] if s[j] > 0 else c - a[j])
        a[i] += s[i] * t
        a[j] -= s[j] * t
        g += t * s * (k[:, i] - k[:, j])
    free = (a > 1e-8) & (a < c - 1e-8)
    b = np.mean((-s * g)[free]) if free.any() else (up[i] + low[j]) / 2
    return lambda z: np.exp(-gamma * ((z[:, None] - x[None]) ** 2).sum(-1)) @ (a * s) + b


def rings(seed, n):
    rng = np.random.default_rng(seed)
    r, t = rng.random(n), rng.random(n) * 2 * np.pi
    y = (rng.random(n) < 0.5).astype(int)
    radius = np.where(y, 1 + 0.6 * r, 0.75 * r) + rng.normal(0, 0.1, n)
    return np.stack([radius * np.cos(t), radius * np.sin(t)], 1), y


def test_kernel_machine_agrees_with_the_exact_dual(spark):
    x, y = rings(1, 220)
    z, truth = rings(2, 400)
    gamma = newton.gamma_scale(frame(spark, x, y), 2)
    assert gamma == pytest.approx(1 / (2 * x.var()))
    want = exact_dual(x, y, gamma)(z) > 0
    got = predictions(newton.rbf_svm(frame(spark, x, y), frame(spark, z, truth), 2, "k"))
    few = predictions(newton.rbf_svm(frame(spark, x, y), frame(spark, z, truth), 2, "k", landmarks=40))
    assert (got == want).mean() >= 0.98 and (few == want).mean() >= 0.95
    line = predictions(newton.logistic(frame(spark, x, y), frame(spark, z, truth), 2, "k"))
    assert (line == want).mean() < 0.8          # no line can do it
    assert (want == truth).mean() > 0.9


def test_kernel_machine_uses_every_training_row(spark):
    """600 rows, each alone in telling its own place: 256 of them could not."""
    rng = np.random.default_rng(5)
    x = np.stack([np.arange(600) % 30, np.arange(600) // 30], 1) + rng.normal(0, 0.05, (600, 2))
    y = rng.integers(0, 2, 600)
    want = exact_dual(x, y, 8.0, rounds=20000)(x) > 0
    got = predictions(newton.rbf_svm(frame(spark, x, y), frame(spark, x, y), 2, "k", gamma=8.0))
    few = predictions(newton.rbf_svm(frame(spark, x, y), frame(spark, x, y), 2, "k", gamma=8.0, landmarks=256))
    assert (got == want).mean() >= 0.995 and (got == y).mean() > 0.95
    assert (few == want).mean() < 0.9


@pytest.mark.parametrize("working", [12, 4096])
def test_working_sets_of_any_size_reach_the_optimum(spark, working):
    x, y = rings(1, 90)
    c, corner, gamma = 0.7, 0.01, 0.9
    rows = svm.numbered(frame(spark, x, y).select("label", "x"), "t")
    numbers, weight, b = svm.fit(rows, c, gamma, corner, 1e-5, working)
    kept = rows.orderBy("i").collect()
    at = {r.i: k for k, r in enumerate(kept)}
    beta = np.zeros(len(kept))
    beta[[at[i] for i in numbers]] = weight
    z, s = np.array([r.x for r in kept]), np.array([2 * r.label - 1 for r in kept])
    m = s * (svm.kernel(z, z, gamma) @ beta + b)
    assert abs(beta.sum()) < 1e-9
    assert np.abs(s * beta - c * np.clip((1 - m) / corner, 0, 1)).max() < 1e-5 / corner * 2
    score = svm.weighed(rows, np.array(sorted(at)), svm.fetched(rows, numbers[::-1]), weight[::-1], gamma)
    assert np.allclose(score, svm.kernel(z, z, gamma) @ beta)


def test_kernel_machine_of_one_class_and_of_none(spark):
    x, y = rings(1, 20)
    for label in (0, 1):
        got = predictions(newton.rbf_svm(frame(spark, x, y * 0 + label), frame(spark, x, y), 2, "k"))
        assert (got == label).all()
    assert not predictions(newton.rbf_svm(frame(spark, x, y).where("false"), frame(spark, x, y), 2, "k")).any()
    assert newton.rbf_svm(frame(spark, x, y), frame(spark, x, y).where("false"), 2, "k").count() == 0


# -------------------------------------------------------------------- network
def plain_network(x, y, part, width, hidden, epochs, parts):
    theta = neural.initial(width, hidden, 0)
    cut = width * hidden
    m, s, t = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        for p in range(parts):
            a, b = x[part == p], y[part == p]
            w1, b1, w2, b2 = theta[:cut].reshape(width, hidden), theta[cut:cut + hidden], theta[cut + hidden:-1], theta[-1]
            h = np.maximum(a @ w1 + b1, 0)
            e = 1 / (1 + np.exp(-(h @ w2 + b2))) - b
            back = np.outer(e, w2) * (h > 0)
            g = np.concatenate([(a.T @ back + 1e-4 * w1).ravel(), back.sum(0), h.T @ e + 1e-4 * w2, [e.sum()]]) / len(a)
            t += 1
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            theta = theta - 0.01 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8 / np.sqrt(1 - 0.999 ** t))
    return theta


@pytest.mark.parametrize("parts", [1, 5])
def test_network_equals_a_plain_run_whatever_the_partitioning(spark, parts):
    x, y = counts(3)
    part = np.array([int(hashlib.md5(f"0|{i}".encode()).hexdigest()[:8], 16) % 2 for i in range(len(x))])
    want = plain_network(x, y, part, 7, 12, 6, 2)
    got = neural.train_network(frame(spark, x, y, parts), 7, "k", 12, max_epochs=6)
    assert np.abs(got - want).max() < 1e-6


def test_network_learns_what_a_line_cannot(spark):
    x, y = rings(4, 300)
    got = predictions(neural.network(frame(spark, x, y), frame(spark, x, y), 2, "k", 30, max_epochs=60, rate=0.05))
    assert (got == y).mean() > 0.85


# ---------------------------------------------------------------------- trees
def plain_tree(x, y, w, tree, depth, draw, min_split, min_leaf, seed=0, node=1):
    """Nested (feature, cut, left, right) or the share of label 1."""
    total, yes = w.sum(), (w * y).sum()
    if depth == 0 or not 0 < yes < total or (w > 0).sum() < min_split:
        return yes / total
    order = trees._order(tree, node, x.shape[1], seed)
    moving = [r for r, f in enumerate(order) if len(np.unique(x[w > 0, f])) > 1]
    cuts = []
    for r in moving:
        if r >= draw and r != moving[0]:
            continue
        values = np.unique(x[w > 0, order[r]])
        for a, b in zip(values, values[1:]):
            left = x[:, order[r]] <= a
            if min(((w > 0) & left).sum(), ((w > 0) & ~left).sum()) >= min_leaf:
                gain = sum((p * p + (n - p) ** 2) / n for n, p in
                           ((w[s].sum(), (w * y)[s].sum()) for s in (left, ~left)))
                cuts.append((-round(gain, 9), r, (a + b) / 2, order[r]))
    if not cuts:
        return yes / total
    _, _, cut, f = min(cuts)
    right = x[:, f] > cut
    sides = [plain_tree(x[s], y[s], w[s], tree, depth - 1, draw, min_split, min_leaf, seed, 2 * node + k)
             for k, s in enumerate((~right, right))]
    return f, cut, *sides


def walk(t, row):
    while isinstance(t, tuple):
        t = t[3] if row[t[0]] > t[1] else t[2]
    return t


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_tree_equals_brute_force(spark, seed):
    x, y = counts(seed)
    z, _ = counts(seed + 10)
    want = plain_tree(x, y, np.ones(len(x), int), 0, 2, 2, 5, 5)
    got = predictions(trees.tree(frame(spark, x, y), frame(spark, z, z[:, 0] > 0), 7, "k"))
    assert (got == [walk(want, r) > 0.5 for r in z]).all()


def test_forest_equals_brute_force(spark):
    x, y = counts(5)
    z, _ = counts(6)
    n = 19
    table = np.array(trees.POISSON)

    def taken(t, i):
        digits = hashlib.md5(f"0|{t // trees.DRAWS}|{i}".encode()).hexdigest()
        return int((table <= int(digits[t % trees.DRAWS * 4:][:4], 16)).sum())

    weight = np.array([[taken(t, i) for t in range(n)] for i in range(len(x))])
    assert 0.8 < weight.mean() < 1.2
    grown = [plain_tree(x, y, weight[:, t], t, 3, 2, 2, 1) for t in range(n)]
    share = np.array([np.mean([walk(g, r) for g in grown]) for r in z])
    got = predictions(trees.forest(frame(spark, x, y), frame(spark, z, z[:, 0] > 0), 7, "k", trees=n))
    assert (got == (np.round(share, 9) > 0.5)).all()


def test_jobs_do_not_grow_with_the_trees(spark):
    x, y = counts(5, 60)
    used = []
    tracker = spark.sparkContext.statusTracker()
    for n in (2, 30):
        spark.sparkContext.setJobGroup(f"trees-{n}", "")
        rows = frame(spark, x, y).withColumn("draws", trees.weights("k", n, 0))
        trees.grow(rows, 7, n, 2, 7)
        used.append(len(tracker.getJobIdsForGroup(f"trees-{n}")))
    assert used[0] == used[1]


# ---------------------------------------------------------------- naive Bayes
def test_naive_bayes_equals_the_dense_formula(spark):
    x, y = counts(7)
    x[:, 5] -= 0.25                              # negative cells as well
    z, _ = counts(8)
    floor = 1e-9 * x.var(0).max()
    score = []
    for c in (0, 1):
        mean, var = x[y == c].mean(0), x[y == c].var(0) + floor
        score.append(np.log((y == c).mean()) - 0.5 * (np.log(var) + (z - mean) ** 2 / var).sum(1))
    got = predictions(bayes.gaussian_nb(frame(spark, x, y), frame(spark, z, z[:, 0] > 0), 7, "k"))
    assert (got == (score[1] > score[0])).all()


# --------------------------------------------------------------------- report
def test_compared_kernel_machine_is_bounded_by_no_sample(spark, monkeypatch):
    monkeypatch.setattr(newton, "nystroem", None)
    x, y = rings(3, 40)
    got = predictions(classify.MODELS["SVC"](frame(spark, x, y), frame(spark, x, y), 2, "k"))
    assert (got == (exact_dual(x, y, 1 / (2 * x.var()))(x) > 0)).mean() > 0.95


def test_compare_on_words(spark):
    good, bad = "fine lovely great movie film", "awful boring bad movie film"
    rows = [(i, f"{(good if i % 2 else bad)} {'tail ' * (i % 3)}w{i % 5}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, clean string, liked int")
    got = classify.compare_classifiers(df.where("doc_id < 40"), df.where("doc_id >= 40")).collect()
    assert {r["name"] for r in got} == set(classify.MODELS) and sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert all(r.tn + r.fp + r.fn + r.tp == 20 for r in got)
    assert all(r.accuracy >= 0.9 for r in got if r["name"] != "DecisionTreeClassifier")


def test_report_by_hand(spark):
    rows = [("a", 1, 1), ("a", 0, 0), ("a", 0, 1), ("a", 1, 1), ("b", 1, 0), ("b", 0, 0), ("c", 0, 0), ("c", 0, 1)]
    got = {r["name"]: r for r in classify.report(spark.createDataFrame(rows, "name string, label int, prediction int")).collect()}
    assert got["a"].accuracy == 0.75 and got["a"].pr_auc == pytest.approx((2 / 3 + 1) / 2)
    assert got["b"].pr_auc == 0.75 and got["c"].pr_auc is None and got["a"]["rank"] == 1
    assert got["b"]["rank"] == 2 and got["c"]["rank"] == 3


def test_driver_gets_one_long_vector(spark, monkeypatch):
    """Long partial sums are cut and summed by piece: their number does not grow with the partitions."""
    import numpy as np
    from quarry.operators import dense
    rows = spark.range(0, 40, numPartitions=20).selectExpr("array(double(id)) AS x")
    got, frame, collect = [], type(rows), type(rows).collect
    monkeypatch.setattr(frame, "collect", lambda self: got.append(collect(self)) or got[-1])
    size = 50_000
    want = np.arange(size) * 780.0
    out = dense.total(rows, lambda b: np.arange(size) * dense.matrix(b).sum(), size)
    assert np.allclose(out, want)
    assert sum(len(r["s"]) for r in got[-1]) == 8 * size
    assert dense.total(rows, lambda b: np.array([dense.matrix(b).sum()]), 1).tolist() == [780.0]
