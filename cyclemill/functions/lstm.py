"""NumPy kernel of a stacked LSTM classifier: the arithmetic of one minibatch.

Spark decides which minibatch runs where; this module only maps
(parameters, one batch) to outputs or to a gradient.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np


@dataclass(frozen=True)
class Network:
    """LSTM layers with dropout behind each, then a dense softmax (or sigmoid) layer.

    ``many_to_one`` classifies a window by its last state, otherwise every step gets
    a class. One output means a sigmoid. ``precision`` is that of a minibatch's
    arithmetic; weights are kept and averaged as doubles. With ``peepholes`` the input and
    forget gates also see the cell before the step and the output gate the cell after it,
    each unit its own; these weights start at zero, as the plain cell.
    """

    features: int
    outputs: int
    # fixed values: the layer widths of the published configuration
    units: tuple[int, ...] = (164, 96, 48)
    dropout: float = 0.2
    many_to_one: bool = True
    seed: int = 42
    precision: str = "float32"
    peepholes: bool = False

    def layout(self) -> list[tuple[str, str, tuple[int, ...]]]:
        """(layer, name, shape) of every parameter block, in the order of the flat vector."""
        blocks, width = [], self.features
        for i, u in enumerate(self.units):
            layer = f"lstm{i + 1}"
            blocks += [
                (layer, "kernel", (width, 4 * u)),
                (layer, "recurrent", (u, 4 * u)),
                (layer, "bias", (4 * u,)),
            ]
            if self.peepholes:
                blocks.append((layer, "peephole", (3, u)))
            width = u
        return [*blocks, ("output", "kernel", (width, self.outputs)), ("output", "bias", (self.outputs,))]

    def size(self) -> int:
        return sum(int(np.prod(shape)) for _, _, shape in self.layout())

    def layer_blocks(self, blocks: list[np.ndarray], k: int) -> list[np.ndarray]:
        """Kernel, recurrent kernel, bias and peepholes (or None) of LSTM layer ``k``."""
        n = 4 if self.peepholes else 3
        own = blocks[n * k : n * (k + 1)]
        return own if self.peepholes else [*own, None]

    def blocks(self, flat: np.ndarray) -> list[np.ndarray]:
        views, at = [], 0
        for _, _, shape in self.layout():
            n = int(np.prod(shape))
            views.append(flat[at : at + n].reshape(shape))
            at += n
        return views

    def initial(self) -> np.ndarray:
        """Glorot-uniform matrices, zero biases and peepholes, forget-gate bias one."""
        rng = np.random.default_rng(self.seed)
        flat = np.zeros(self.size())
        for (layer, name, shape), block in zip(self.layout(), self.blocks(flat)):
            if name == "peephole":
                continue
            if len(shape) == 2:
                limit = np.sqrt(6.0 / sum(shape))
                block[...] = rng.uniform(-limit, limit, shape)
            elif layer != "output":
                u = shape[0] // 4
                block[u : 2 * u] = 1.0
        return flat

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Network:
        raw = json.loads(text)
        return Network(**{**raw, "units": tuple(raw["units"])})


@dataclass(frozen=True)
class Adam:
    rate: float = 1e-3
    clip: float = 0.5
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8


@dataclass
class Weights:
    """Parameters with their Adam moments and step count."""

    values: np.ndarray
    mean: np.ndarray = field(default=None)
    square: np.ndarray = field(default=None)
    steps: float = 0.0

    def __post_init__(self):
        if self.mean is None:
            self.mean = np.zeros_like(self.values)
            self.square = np.zeros_like(self.values)

    def pack(self) -> np.ndarray:
        return np.concatenate([self.values, self.mean, self.square, [self.steps]])

    @staticmethod
    def unpack(flat: np.ndarray) -> Weights:
        n = (len(flat) - 1) // 3
        return Weights(flat[:n].copy(), flat[n : 2 * n].copy(), flat[2 * n : 3 * n].copy(), float(flat[-1]))

    def update(self, gradient: np.ndarray, adam: Adam) -> None:
        g = np.clip(gradient, -adam.clip, adam.clip)
        self.steps += 1
        self.mean = adam.beta1 * self.mean + (1 - adam.beta1) * g
        self.square = adam.beta2 * self.square + (1 - adam.beta2) * g * g
        mean = self.mean / (1 - adam.beta1**self.steps)
        square = self.square / (1 - adam.beta2**self.steps)
        self.values = self.values - adam.rate * mean / (np.sqrt(square) + adam.epsilon)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _step(z, c, real, peep, gate):
    """Fill ``gate`` (input, forget, output, candidate) from the driven sums; the cell and the output after the step."""
    u = c.shape[1]
    if peep is None:
        gate[:, : 3 * u] = _sigmoid(z[:, : 3 * u])
    else:
        gate[:, :u] = _sigmoid(z[:, :u] + c * peep[0])
        gate[:, u : 2 * u] = _sigmoid(z[:, u : 2 * u] + c * peep[1])
    gate[:, 3 * u :] = np.tanh(z[:, 3 * u :])
    after = real * (gate[:, u : 2 * u] * c + gate[:, :u] * gate[:, 3 * u :])
    if peep is not None:
        gate[:, 2 * u : 3 * u] = _sigmoid(z[:, 2 * u : 3 * u] + after * peep[2])
    return after, real * gate[:, 2 * u : 3 * u] * np.tanh(after)


def _lstm_forward(x, wx, wh, b, peep, state, mask, keep=True):
    if not keep:
        return _lstm_states(x, wx, wh, b, peep, state, mask)
    batch, steps, _ = x.shape
    u = wh.shape[0]
    h, c = state
    driven = x @ wx + b
    gates = np.empty((steps, batch, 4 * u), driven.dtype)
    cells = np.empty((steps + 1, batch, u), driven.dtype)
    hidden = np.empty((steps + 1, batch, u), driven.dtype)
    cells[0], hidden[0] = c, h
    for t in range(steps):
        z = driven[:, t] + hidden[t] @ wh
        cells[t + 1], hidden[t + 1] = _step(z, cells[t], mask[:, t, None], peep, gates[t])
    return hidden[1:].transpose(1, 0, 2), (gates, cells, hidden)


def _lstm_states(x, wx, wh, b, peep, state, mask):
    """The forward pass alone: what only the gradient needs is not kept."""
    u = wh.shape[0]
    h, c = state
    out, gate = np.empty((x.shape[1], x.shape[0], u), x.dtype), np.empty((x.shape[0], 4 * u), x.dtype)
    for t in range(x.shape[1]):
        c, h = _step(x[:, t] @ wx + b + h @ wh, c, mask[:, t, None], peep, gate)
        out[t] = h
    return out.transpose(1, 0, 2), (None, c[None], h[None])


def _lstm_backward(dout, x, wx, wh, peep, tape, mask):
    gates, cells, hidden = tape
    steps, batch, _ = gates.shape
    u = wh.shape[0]
    dz = np.empty_like(gates)
    dh_next = np.zeros((batch, u), gates.dtype)
    dc_next = np.zeros((batch, u), gates.dtype)
    for t in reversed(range(steps)):
        i, f, o, g = (gates[t][:, k * u : (k + 1) * u] for k in range(4))
        real = mask[:, t, None]
        squashed = np.tanh(cells[t + 1])
        dh = (dout[:, t] + dh_next) * real
        dz[t, :, 2 * u : 3 * u] = dh * squashed * o * (1 - o)
        dc = dh * o * (1 - squashed**2) + dc_next * real
        if peep is not None:
            dc += dz[t, :, 2 * u : 3 * u] * peep[2]
        dz[t, :, :u] = dc * g * i * (1 - i)
        dz[t, :, u : 2 * u] = dc * cells[t] * f * (1 - f)
        dz[t, :, 3 * u :] = dc * i * (1 - g**2)
        dh_next = dz[t] @ wh.T
        dc_next = dc * f
        if peep is not None:
            dc_next += dz[t, :, :u] * peep[0] + dz[t, :, u : 2 * u] * peep[1]
    by_step = x.transpose(1, 0, 2)
    dwx = np.tensordot(by_step, dz, axes=([0, 1], [0, 1]))
    dwh = np.tensordot(hidden[:-1], dz, axes=([0, 1], [0, 1]))
    grads = [dwx, dwh, dz.sum((0, 1))]
    if peep is not None:
        seen = (cells[:-1], cells[:-1], cells[1:])
        grads.append(np.stack([(dz[:, :, k * u : (k + 1) * u] * c).sum((0, 1)) for k, c in enumerate(seen)]))
    return (dz @ wx.T).transpose(1, 0, 2), grads


def zero_state(net: Network, batch: int):
    return [(np.zeros((batch, u), net.precision), np.zeros((batch, u), net.precision)) for u in net.units]


def forward(net: Network, values, x, mask=None, state=None, rng=None, keep=True):
    """Class probabilities ``(batch, [steps,] outputs)``, the last state and what ``gradient`` needs.

    ``rng`` switches dropout on; without ``keep`` there is nothing for the gradient.
    """
    batch, steps, _ = x.shape
    kind = net.precision
    x = x.astype(kind)
    mask = np.ones((batch, steps), kind) if mask is None else mask.astype(kind)
    state = state or zero_state(net, batch)
    blocks = net.blocks(values.astype(kind))
    tape, last, a = [], [], x
    for k, u in enumerate(net.units):
        wx, wh, b, peep = net.layer_blocks(blocks, k)
        out, inner = _lstm_forward(a, wx, wh, b, peep, state[k], mask, keep)
        last.append((inner[2][-1], inner[1][-1]))
        kept = None
        if rng is not None and net.dropout > 0:
            kept = (rng.random((batch, steps, u)) >= net.dropout) / np.array(1 - net.dropout, kind)
        if keep:
            tape.append((a, inner, kept))
        a = out if kept is None else out * kept
    top = a[:, -1] if net.many_to_one else a
    scores = top @ blocks[-2] + blocks[-1]
    if net.outputs == 1:
        prob = _sigmoid(scores)
    else:
        e = np.exp(scores - scores.max(-1, keepdims=True))
        prob = e / e.sum(-1, keepdims=True)
    return prob, last, (tape, top, mask, blocks)


def log_loss(net: Network, prob, label):
    """Negative log-probability of the true class, per sample or step."""
    if net.outputs == 1:
        p = np.where(label == 1, prob[..., 0], 1 - prob[..., 0])
    else:
        p = np.take_along_axis(prob, label[..., None].astype(int), -1)[..., 0]
    return -np.log(np.clip(p, 1e-7, 1.0))


def gradient(net: Network, values, x, label, mask=None, state=None, rng=None):
    """Summed loss, number of terms, gradient of the mean loss, and the last state."""
    prob, last, (tape, top, mask, blocks) = forward(net, values, x, mask, state, rng)
    weight = np.ones(label.shape, prob.dtype) if net.many_to_one else mask
    count = float(weight.sum())
    loss = float((log_loss(net, prob, label) * weight).sum(dtype=float))
    target = label[..., None] if net.outputs == 1 else np.eye(net.outputs)[label.astype(int)]
    dscores = (prob - target.astype(prob.dtype)) * weight[..., None] / np.array(max(count, 1.0), prob.dtype)

    flat = np.zeros_like(values)
    grads = net.blocks(flat)
    axes = tuple(range(dscores.ndim - 1))
    grads[-2][...] = np.tensordot(top, dscores, axes=(axes, axes))
    grads[-1][...] = dscores.sum(axes)
    dtop = dscores @ blocks[-2].T
    if net.many_to_one and net.units:
        da = np.zeros((*x.shape[:2], net.units[-1]), prob.dtype)
        da[:, -1] = dtop
    else:
        da = dtop
    for k in reversed(range(len(net.units))):
        a, inner, kept = tape[k]
        dout = da if kept is None else da * kept
        wx, wh, _, peep = net.layer_blocks(blocks, k)
        da, made = _lstm_backward(dout, a, wx, wh, peep, inner, mask)
        for target, own in zip(net.layer_blocks(grads, k), made):
            target[...] = own
    return loss, count, flat, last
