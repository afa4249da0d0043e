"""A bidirectional gated recurrent network with attention pooling, in numpy.

Every word enters as a word vector next to the mean of its character-trigram vectors. Two gated recurrent layers read a
window in both directions; attention weighs their states, and a logistic unit scores the weighted mean.
"""

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Shape:
    words: int
    trigrams: int = 1 << 13
    word_size: int = 8
    char_size: int = 8
    hidden: int = 8
    attention: int = 8


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(shape: Shape, seed: int = 7) -> dict[str, np.ndarray]:
    random = np.random.RandomState(seed)
    size, h = shape.word_size + shape.char_size, shape.hidden

    def normal(*dims, scale):
        return (random.standard_normal(dims) * scale).astype(np.float32)

    weights = {"word": normal(shape.words, shape.word_size, scale=0.1), "char": normal(shape.trigrams, shape.char_size, scale=0.1),
               "attend": normal(2 * h, shape.attention, scale=0.4), "query": normal(shape.attention, scale=0.4),
               "out": normal(2 * h, scale=0.4), "bias": np.zeros(1, np.float32)}
    for side in ("forth", "back"):
        weights[f"{side}_in"] = normal(size, 3 * h, scale=size ** -0.5)
        weights[f"{side}_b"] = np.zeros(3 * h, np.float32)
        weights[f"{side}_state"] = normal(h, 3 * h, scale=h ** -0.5)
    return weights


def word_inputs(weights: dict, numbers: np.ndarray, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Input vectors of words: word vector and mean trigram vector. ``codes``: trigrams of all words one after the other,
    ``first``: the place of each word's first one; every word has some."""
    sums = np.add.reduceat(weights["char"][codes], first, axis=0)
    counts = np.diff(np.append(first, len(codes)))[:, None]
    return np.concatenate([weights["word"][numbers], (sums / counts).astype(np.float32)], axis=1)


def gates(weights: dict, inputs: np.ndarray) -> np.ndarray:
    """What the inputs add to the gates of both directions."""
    return np.stack([inputs @ weights[f"{side}_in"] + weights[f"{side}_b"] for side in ("forth", "back")], axis=1)


def run(weights: dict, side: str, entering: np.ndarray, mask: np.ndarray, keep: bool = False):
    """States (steps, windows, hidden) of one direction; ``entering``: (steps, windows, 3 hidden)."""
    state_weights = weights[f"{side}_state"]
    h = state_weights.shape[0]
    steps, windows, _ = entering.shape
    state = np.zeros((windows, h), np.float32)
    out = np.empty((steps, windows, h), np.float32)
    memory = []
    for t in range(steps) if side == "forth" else range(steps - 1, -1, -1):
        zr = sigmoid(entering[t, :, :2 * h] + state @ state_weights[:, :2 * h])
        z, r = zr[:, :h], zr[:, h:]
        c = np.tanh(entering[t, :, 2 * h:] + (r * state) @ state_weights[:, 2 * h:])
        new = state + (z * mask[t]) * (c - state)
        if keep:
            memory.append((t, state, z, r, c))
        out[t] = state = new
    return (out, memory) if keep else out


def pooled(weights: dict, states: np.ndarray, mask: np.ndarray):
    hidden = np.tanh(states @ weights["attend"])
    energy = np.where(mask[:, :, 0] > 0, hidden @ weights["query"], -30.0)
    share = np.exp(energy - energy.max(axis=0))
    share /= share.sum(axis=0)
    return hidden, share, (share[:, :, None] * states).sum(axis=0)


def score(weights: dict, entering: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Log-odds of windows; ``entering``: (steps, windows, 2, 3 hidden), mask: (steps, windows, 1)."""
    states = np.concatenate([run(weights, side, entering[:, :, i], mask) for i, side in enumerate(("forth", "back"))], axis=2)
    return pooled(weights, states, mask)[2] @ weights["out"] + weights["bias"]


def gradients(weights: dict, inputs: np.ndarray, mask: np.ndarray, goal: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """(slopes of the weights, slope of the inputs, log-odds) of the mean cross-entropy; inputs: (steps, windows, size)."""
    slopes = {}
    h = weights["forth_state"].shape[0]
    parts = {}
    for side in ("forth", "back"):
        parts[side] = run(weights, side, inputs @ weights[f"{side}_in"] + weights[f"{side}_b"], mask, keep=True)
    states = np.concatenate([parts["forth"][0], parts["back"][0]], axis=2)
    hidden, share, pool = pooled(weights, states, mask)
    odds = pool @ weights["out"] + weights["bias"]
    d_odds = ((sigmoid(odds) - goal) / len(goal)).astype(np.float32)
    slopes["out"], slopes["bias"] = pool.T @ d_odds, d_odds.sum(keepdims=True)
    d_pool = d_odds[:, None] * weights["out"]
    d_states = share[:, :, None] * d_pool
    d_share = (states * d_pool).sum(axis=2)
    d_energy = share * (d_share - (share * d_share).sum(axis=0)) * (mask[:, :, 0] > 0)
    slopes["query"] = np.einsum("tn,tna->a", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * weights["query"] * (1 - hidden ** 2)
    slopes["attend"] = np.einsum("tns,tna->sa", states, d_hidden)
    d_states += d_hidden @ weights["attend"].T
    d_inputs = np.zeros_like(inputs)
    for i, side in enumerate(("forth", "back")):
        u = weights[f"{side}_state"]
        d_u, d_in = np.zeros_like(u), np.zeros((*inputs.shape[:2], 3 * h), np.float32)
        carry = np.zeros((inputs.shape[1], h), np.float32)
        for t, state, z, r, c in reversed(parts[side][1]):
            d = d_states[t, :, i * h:(i + 1) * h] + carry
            m = mask[t]
            d_c = d * z * m * (1 - c ** 2)
            d_z = d * m * (c - state) * z * (1 - z)
            d_rh = d_c @ u[:, 2 * h:].T
            d_r = d_rh * state * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=1)
            d_in[t, :, :2 * h], d_in[t, :, 2 * h:] = d_zr, d_c
            d_u[:, :2 * h] += state.T @ d_zr
            d_u[:, 2 * h:] += (r * state).T @ d_c
            carry = d * (1 - z * m) + d_rh * r + d_zr @ u[:, :2 * h].T
        slopes[f"{side}_state"] = d_u
        slopes[f"{side}_in"] = np.einsum("tns,tng->sg", inputs, d_in)
        slopes[f"{side}_b"] = d_in.sum(axis=(0, 1))
        d_inputs += d_in @ weights[f"{side}_in"].T
    return slopes, d_inputs, odds


@dataclass
class Adam:
    rate: float = 0.01
    first: dict = field(default_factory=dict)
    second: dict = field(default_factory=dict)
    steps: int = 0

    def step(self, weights: dict, slopes: dict) -> None:
        self.steps += 1
        for name, slope in slopes.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * slope
            v = self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * slope ** 2
            weights[name] -= (self.rate * (m / (1 - 0.9 ** self.steps))
                              / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-8)).astype(np.float32)
