"""The numeric kernel: gradients against finite differences, masks, restarts."""

import numpy as np
import pytest

from cyclemill.functions.lstm import Adam, Network, Weights, forward, gradient


@pytest.mark.parametrize("peepholes", [False, True])
@pytest.mark.parametrize("many_to_one", [True, False])
@pytest.mark.parametrize("outputs", [1, 3])
def test_gradient_is_the_derivative_of_the_loss(many_to_one, outputs, peepholes):
    net = Network(
        3, outputs, (4, 3), dropout=0.0, many_to_one=many_to_one, seed=3, precision="float64", peepholes=peepholes)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 6, 3))
    mask = np.ones((5, 6))
    if not many_to_one:
        mask[0, :3] = 0
        mask[3, :5] = 0
    y = rng.integers(0, max(outputs, 2), size=5 if many_to_one else (5, 6)).astype(float)
    values = net.initial() + rng.normal(size=net.size()) * (0.5 if peepholes else 0.1)

    def mean_loss(v):
        loss, n, _, _ = gradient(net, v, x, y, mask)
        return loss / n

    _, _, grad, _ = gradient(net, values, x, y, mask)
    for i in range(net.size()) if peepholes else rng.choice(net.size(), 60, replace=False):
        step = np.zeros_like(values)
        step[i] = 1e-6
        numeric = (mean_loss(values + step) - mean_loss(values - step)) / 2e-6
        assert abs(numeric - grad[i]) < 1e-7 + 1e-4 * abs(numeric)


def test_padding_in_front_changes_nothing():
    net = Network(features=2, outputs=3, units=(4, 5), dropout=0.0, many_to_one=False)
    x = np.random.default_rng(1).normal(size=(1, 4, 2))
    padded = np.concatenate([np.zeros((1, 3, 2)), x], axis=1)
    mask = np.array([[0, 0, 0, 1, 1, 1, 1.0]])
    values = net.initial()
    assert np.allclose(forward(net, values, padded, mask)[0][:, 3:], forward(net, values, x)[0])


@pytest.mark.parametrize("peepholes", [False, True])
def test_state_carries_over_chunks(peepholes):
    net = Network(features=2, outputs=3, units=(4, 5), dropout=0.0, many_to_one=False, peepholes=peepholes)
    x = np.random.default_rng(1).normal(size=(2, 9, 2))
    values = net.initial() + 0.3
    first, state, _ = forward(net, values, x[:, :4])
    second, _, _ = forward(net, values, x[:, 4:], state=state)
    assert np.allclose(np.concatenate([first, second], 1), forward(net, values, x)[0])


def test_single_precision_follows_double():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(6, 9, 3)), rng.integers(0, 3, size=6).astype(float)
    results = []
    for precision in ("float32", "float64"):
        net = Network(features=3, outputs=3, units=(8, 5), dropout=0.0, precision=precision)
        prob, _, _ = forward(net, net.initial(), x)
        assert prob.dtype == precision
        loss, _, grad, _ = gradient(net, net.initial(), x, y)
        assert grad.dtype == np.float64
        results.append((loss, grad))
    assert abs(results[0][0] - results[1][0]) < 1e-5
    assert np.allclose(results[0][1], results[1][1], atol=1e-6)


def test_dropout_only_with_a_generator():
    net = Network(features=2, outputs=1, units=(8,), dropout=0.5)
    x = np.random.default_rng(1).normal(size=(2, 5, 2))
    values = net.initial()
    plain = forward(net, values, x)[0]
    assert np.array_equal(plain, forward(net, values, x)[0])
    assert not np.array_equal(plain, forward(net, values, x, rng=np.random.default_rng(0))[0])


def scalar_cell(net, values, x):
    """Last output of one layer with peepholes, unit by unit and step by step, for one series."""
    wx, wh, b, peep = net.layer_blocks(net.blocks(values), 0)
    u = net.units[0]
    h, c = np.zeros(u), np.zeros(u)
    for step in x:
        new_h, new_c = np.zeros(u), np.zeros(u)
        for j in range(u):
            z = [sum(step * wx[:, k * u + j]) + sum(h * wh[:, k * u + j]) + b[k * u + j] for k in range(4)]
            i, f = (1 / (1 + np.exp(-z[k] - c[j] * peep[k, j])) for k in (0, 1))
            new_c[j] = f * c[j] + i * np.tanh(z[3])
            new_h[j] = np.tanh(new_c[j]) / (1 + np.exp(-z[2] - new_c[j] * peep[2, j]))
        h, c = new_h, new_c
    return h


@pytest.mark.parametrize("keep", [True, False])
def test_peepholes_by_their_formula(keep):
    net = Network(features=3, outputs=2, units=(4,), dropout=0.0, precision="float64", peepholes=True)
    rng = np.random.default_rng(7)
    values, x = net.initial() + rng.normal(size=net.size()), rng.normal(size=(2, 6, 3))
    _, state, _ = forward(net, values, x, keep=keep)
    for row in range(2):
        assert np.allclose(state[0][0][row], scalar_cell(net, values, x[row]))


def test_peepholes_start_as_the_plain_cell():
    plain = Network(features=3, outputs=2, units=(4, 3))
    peep = Network(features=3, outputs=2, units=(4, 3), peepholes=True)
    x = np.random.default_rng(2).normal(size=(2, 6, 3))
    assert np.allclose(forward(plain, plain.initial(), x)[0], forward(peep, peep.initial(), x)[0])
    assert peep.size() - plain.size() == 3 * (4 + 3)
    assert Network.from_json(peep.to_json()) == peep
    old = plain.to_json().replace(', "peepholes": false', "")  # of a model saved before there was a choice
    assert "peepholes" not in old and Network.from_json(old) == plain


def test_parameter_counts_of_the_full_network():
    sizes = {}
    for layer, _, shape in Network(features=25, outputs=1).layout():
        sizes[layer] = sizes.get(layer, 0) + int(np.prod(shape))
    assert sizes == {"lstm1": 124_640, "lstm2": 100_224, "lstm3": 27_840, "output": 49}


def test_network_json_round_trip():
    net = Network(features=25, outputs=3, units=(7, 2), many_to_one=False)
    assert Network.from_json(net.to_json()) == net


def test_adam_clips_and_packs():
    w = Weights(np.zeros(3))
    w.update(np.array([10.0, -10.0, 0.0]), Adam(rate=0.1))
    assert np.allclose(w.values, [-0.1, 0.1, 0.0])
    assert np.allclose(w.mean, [0.05, -0.05, 0.0])  # clipped to one half first
    back = Weights.unpack(w.pack())
    assert back.steps == 1 and np.array_equal(back.pack(), w.pack())
