"""Mini-batch training against a plain loop over the same batches."""

import numpy as np
import pytest

from themata.checks.queries import QUERIES
from themata.operators import network
from themata.plans import experiments


def numeric_gradient(shape, flat, x, y, step=1e-6):
    out = np.empty_like(flat)
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += step
        down[i] -= step
        out[i] = (shape.gradient(up, x, y)[0] - shape.gradient(down, x, y)[0]) / (2 * step)
    return out


@pytest.mark.parametrize("name", sorted(network.ACTIVATIONS))
def test_gradient_equals_differences(name):
    rng = np.random.default_rng(2)
    shape = network.Shape([3, 5, 4, 2], [name, name])
    flat = shape.initial(1) + rng.normal(size=shape.size) * 0.1
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 2, 7)
    loss, gradient = shape.gradient(flat, x, y)
    probability = np.exp(shape.outputs(flat, x)[-1])
    assert np.allclose(probability.sum(1), 1)
    assert np.isclose(loss, -np.log(probability[np.arange(7), y]).sum())
    assert np.allclose(gradient, numeric_gradient(shape, flat, x, y), atol=1e-5)


def plain_adam(shape, batches, orders, rate, seed):
    """The same training in one loop, written out."""
    p = shape.initial(seed)
    m, v, t = np.zeros_like(p), np.zeros_like(p), 0
    for order in orders:
        for b in order:
            x, y = batches[b]
            t += 1
            g = shape.gradient(p, x, y)[1] / len(y)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7 / np.sqrt(1 - 0.999**t))
    return p


def test_training_equals_a_plain_loop(spark, clusters, monkeypatch):
    monkeypatch.setattr(network, "STORED_ROWS", 100)
    layers, size, epochs, seed = ((8, "relu"), (4, "tanh")), 50, 3, 9
    models = network.fit_networks(clusters, [0.01, 0.05], layers, epochs, size, seed)
    labels = models[0].labels
    dealt = network.deal_batches(clusters.repartition(3), labels, size, seed)  # how rows arrive does not matter
    assert dealt.count == 5 and dealt.rows == 240
    batches = []
    for b in range(dealt.count):
        rows = dealt.read(b).collect()
        batches.append((np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])))
    assert [len(y) for _, y in batches] == [50, 50, 50, 50, 40]
    assert sorted(map(tuple, np.concatenate([x for x, _ in batches]).tolist())) == sorted(tuple(r["features"]) for r in clusters.collect())
    for model, rate in zip(models, (0.01, 0.05)):
        want = plain_adam(model.shape, batches, network.epoch_orders(5, epochs, seed), rate, seed)
        assert np.allclose(model.parameters, want, atol=1e-9)
        assert len(model.history) == epochs and model.history[-1] < model.history[0]


def test_steps_of_small_batches_plan_nothing(spark, clusters, monkeypatch):
    """A step of a small batch reads no table, and equals the step that does."""
    shape, labels = network.Shape([6, 5, 4], ["relu"]), ["a", "b", "c", "d"]
    flats = [shape.initial(0), shape.initial(1)]
    monkeypatch.setattr(network, "STORED_ROWS", 100)
    dealt = network.deal_batches(clusters, labels, 50)
    kept = dealt.kept(6)
    assert kept.getNumPartitions() == 3 and sorted(kept.keys().collect()) == [0, 1, 2, 3, 4]
    for number in range(5):
        one, two = network.batch_gradients(dealt.read(number), shape, flats), network.small_batch_gradients(kept, number, dealt.together, shape, flats)
        assert np.allclose(one[0], two[0]) and np.allclose(one[1], two[1])
    monkeypatch.setattr(network.Batches, "read", None)
    assert len(network.fit_networks(clusters, [0.01], ((4, "relu"),), 1, 50)[0].history) == 1


def test_sums_in_two_levels(spark, clusters):
    shape = network.Shape([6, 5, 4], ["relu"])
    flats = [shape.initial(0), shape.initial(1)]
    batch = clusters.selectExpr("cast(id % 4 as int) as y", "features as x").repartition(7)
    one, two = (network.batch_gradients(batch, shape, flats, many) for many in (False, True))
    assert np.allclose(one[0], two[0]) and np.allclose(one[1], two[1])
    rows = batch.collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    assert np.allclose(one[1][1], shape.gradient(flats[1], x, y)[1] / 240)


def test_network_learns_and_leaves_out_null_labels(spark, clusters):
    unnamed = clusters.limit(10).selectExpr("id + 1000 as id", "cast(null as string) as label", "features")
    model = network.fit_network(clusters.unionAll(unnamed), 0.02, layers=((16, "relu"),), epochs=15, batch_size=60)
    assert experiments.evaluate_model(model, clusters) > 0.95 and model.labels == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        network.fit_network(clusters, layers=((4, "cube"),))
    with pytest.raises(ValueError):
        network.fit_network(clusters.limit(0))


def test_swept_sets():
    swept = experiments.grids()["ANN"]
    assert len(swept) == 20 and sorted({p["learning_rate"] for p in swept}) == [0.001, 0.201, 0.401, 0.601, 0.801]


def test_a_task_takes_all_steps_of_a_run(spark, clusters, monkeypatch):
    """Runs of two steps: a job each instead of a job a step, with the same result as one loop."""
    monkeypatch.setattr(network, "RUN_BYTES", 2 * 8 * 6 * 50)
    calls, real = [], network.run_of_steps
    monkeypatch.setattr(network, "run_of_steps", lambda runs, number, *rest: calls.append(number) or real(runs, number, *rest))
    monkeypatch.setattr(network, "small_batch_gradients", None)
    models = network.fit_networks(clusters, [0.01, 0.05], ((8, "relu"), (4, "tanh")), 2, 50, 9)
    assert calls == [0, 1, 2, 0, 1, 2]
    batches = [(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])) for rows in (network.deal_batches(clusters, models[0].labels, 50, 9).read(b).collect() for b in range(5))]
    for model, rate in zip(models, (0.01, 0.05)):
        assert np.allclose(model.parameters, plain_adam(model.shape, batches, network.epoch_orders(5, 2, 9), rate, 9), atol=1e-9)


def test_moments_of_dead_units_end_at_zero():
    state = network.Adam(np.ones(3), 0.1)
    state.step(np.array([1.0, 1e-200, 0.0]))
    for _ in range(7000):
        state.step(np.zeros(3))
    assert state.first.tolist() == [0.0, 0.0, 0.0] and state.second[0] > 0 and state.second[1] == 0


def test_the_sweep_has_all_its_sets(spark, tmp_path):
    """Every batch size of the sweep with every learning rate, over rows of our own."""
    words = ["ball goal team", "bank rate loan", "vote law court"]
    rows = [(i, f"{words[i % 3]} {words[i % 3]} word{i % 7}", "abc"[i % 3]) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [r["params"] for r in QUERIES["sweep_ann"](spark, str(tmp_path)).collect()]
    assert len(found) == len(set(found)) == 20
    assert {p for row in found for p in row.split(",") if p.startswith("batch")} == {f"batch_size={n}" for n in (10, 20, 50, 80)}
