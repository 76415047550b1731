"""A bidirectional LSTM that labels every element of a sequence, in numpy: fitting and batched prediction."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def init(inputs: int, hidden: int, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {}
    for d in "fb":
        net[f"x{d}"] = rng.normal(0, 0.1, (inputs, 4 * hidden)).astype(np.float32)
        net[f"h{d}"] = rng.normal(0, 0.1, (hidden, 4 * hidden)).astype(np.float32)
        net[f"c{d}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)]).astype(np.float32)  # forget gates start open
    net["out"] = rng.normal(0, 0.1, 2 * hidden).astype(np.float32)
    net["skip"] = np.zeros(inputs, np.float32)
    net["bias"] = np.zeros(1, np.float32)
    return net


def _run(net, d, projected, mask, keep=False):
    """States of one direction; ``projected``: time, lane, gates. Masked steps leave the state as it was."""
    steps, lanes, gates = projected.shape
    hidden = gates // 4
    h, c = np.zeros((lanes, hidden), np.float32), np.zeros((lanes, hidden), np.float32)
    out, memory = np.zeros((steps, lanes, hidden), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = projected[t] + h @ net[f"h{d}"]
        gate = _sigmoid(z[:, :3 * hidden])
        f, i, o = gate[:, :hidden], gate[:, hidden:2 * hidden], gate[:, 2 * hidden:]
        g = np.tanh(z[:, 3 * hidden:])
        new = f * c + i * g
        tanh = np.tanh(new)
        m = mask[t][:, None]
        if keep:
            memory.append((t, h, c, f, i, o, g, tanh, m))
        h, c = np.where(m, o * tanh, h), np.where(m, new, c)
        out[t] = h
    return out, memory


def _padded(sequences):
    sizes = np.array([len(s) for s in sequences])
    x = np.zeros((sizes.max(), len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros(x.shape[:2], bool)
    for k, s in enumerate(sequences):
        x[:len(s), k], mask[:len(s), k] = s, True
    return x, mask


def probabilities(net: dict, sequences: list[np.ndarray], cells: int = 1 << 20) -> list[np.ndarray]:
    """One array of probabilities per sequence. Sequences of like length run side by side, bounded by ``cells`` inputs."""
    out: list = [np.zeros(0, np.float32)] * len(sequences)
    order = sorted((k for k, s in enumerate(sequences) if len(s)), key=lambda k: -len(sequences[k]))
    while order:
        wide = max(1, cells // (len(sequences[order[0]]) * sequences[order[0]].shape[1]))
        lanes, order = order[:wide], order[wide:]
        x, mask = _padded([sequences[k] for k in lanes])
        score = x @ net["skip"] + net["bias"]
        half = len(net["out"]) // 2
        for d, w in (("f", net["out"][:half]), ("b", net["out"][half:])):
            score = score + _run(net, d, x @ net[f"x{d}"] + net[f"c{d}"], mask)[0] @ w
        p = _sigmoid(score)
        for lane, k in enumerate(lanes):
            out[k] = p[:len(sequences[k]), lane]
    return out


def fit(sequences: list[np.ndarray], labels: list[np.ndarray], hidden: int = 16, rounds: int = 30, rate: float = 0.02,
        lanes: int = 64, seed: int = 3) -> dict[str, np.ndarray]:
    """Adam on the logistic loss; labels are 1, 0, or -1 for an element without one."""
    net = init(sequences[0].shape[1], hidden, seed)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
    groups = [order[k:k + lanes] for k in range(0, len(order), lanes)]
    groups = [(*_padded([sequences[k] for k in g]), _padded([labels[k][:, None] for k in g])[0][:, :, 0]) for g in groups]
    rng, step = np.random.default_rng(seed), 0
    for _ in range(rounds):
        for n in rng.permutation(len(groups)):
            x, mask, y = groups[n]
            taught = mask & (y >= 0)
            if not taught.any():
                continue
            grad = {k: np.zeros_like(v) for k, v in net.items()}
            runs = {d: _run(net, d, x @ net[f"x{d}"] + net[f"c{d}"], mask, keep=True) for d in "fb"}
            score = x @ net["skip"] + net["bias"] + np.concatenate([runs["f"][0], runs["b"][0]], axis=2) @ net["out"]
            error = np.where(taught, _sigmoid(score) - y, 0).astype(np.float32) / taught.sum()
            grad["bias"][0] = error.sum()
            grad["skip"] = np.einsum("tl,tli->i", error, x)
            for at, d in enumerate("fb"):
                states, memory = runs[d]
                w = net["out"][at * hidden:(at + 1) * hidden]
                grad["out"][at * hidden:(at + 1) * hidden] = np.einsum("tl,tlh->h", error, states)
                dh, dc = np.zeros_like(states[0]), np.zeros_like(states[0])
                dz_all = np.zeros(states.shape[:2] + (4 * hidden,), np.float32)
                for t, h, c, f, i, o, g, tanh, m in reversed(memory):
                    dh = dh + error[t][:, None] * w
                    dnew = np.where(m, dc + dh * o * (1 - tanh**2), 0)
                    do = np.where(m, dh * tanh, 0)
                    dz = np.concatenate([dnew * c * f * (1 - f), dnew * g * i * (1 - i), do * o * (1 - o), dnew * i * (1 - g**2)], axis=1)
                    dz_all[t] = dz
                    grad[f"h{d}"] += h.T @ dz
                    dh = np.where(m, 0, dh) + dz @ net[f"h{d}"].T
                    dc = np.where(m, dnew * f, dc)
                grad[f"x{d}"] = np.tensordot(x, dz_all, ([0, 1], [0, 1]))
                grad[f"c{d}"] = dz_all.sum(axis=(0, 1))
            step += 1
            for k, v in net.items():
                first[k] += 0.1 * (grad[k] - first[k])
                second[k] += 0.01 * (grad[k] ** 2 - second[k])
                v -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net
