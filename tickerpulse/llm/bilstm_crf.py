"""A character-level bidirectional LSTM with CRF transitions, in numpy.

``fit`` trains by back-propagation through time on windows of character ids
and tags; ``decode`` gives the best tag path of each window and the marginal
probability of each of its tags. Both directions run in one loop over time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

F4 = np.float32


@dataclass(frozen=True)
class Tagger:
    """Parameters: embedding, input and recurrent weights of both directions, output layer, transitions."""

    params: dict[str, np.ndarray]
    hidden: int


def _init(chars: int, tags: int, embed: int, hidden: int, rng) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(F4)
    b = np.zeros((2, 4 * hidden), F4)
    b[:, hidden:2 * hidden] = 1.0  # forget gates start open
    return {"emb": normal(chars, embed, scale=0.3), "wx": normal(2, embed, 4 * hidden, scale=embed ** -0.5),
            "wh": normal(2, hidden, 4 * hidden, scale=hidden ** -0.5), "b": b,
            "wo": normal(2 * hidden, tags, scale=(2 * hidden) ** -0.5), "bo": np.zeros(tags, F4),
            "trans": np.zeros((tags, tags), F4)}


def _lstm(p, x, keep: bool):
    """x (T, B) of ids -> states (T, 2, B, H) in each direction's own time, and what the way back needs."""
    steps, batch = x.shape
    n = p["wh"].shape[1]
    scale = np.concatenate([np.full(3 * n, 0.5, F4), np.ones(n, F4)])
    ids = np.stack([x, x[::-1]], axis=1)  # (T, 2, B)
    table = (np.einsum("ce,deg->dcg", p["emb"], p["wx"]) + p["b"][:, None, :])
    h = np.zeros((2, batch, n), F4)
    c = np.zeros((2, batch, n), F4)
    hs = np.empty((steps, 2, batch, n), F4)
    gates = np.empty((steps, 2, batch, 4 * n), F4) if keep else None
    cs = np.empty((steps, 2, batch, n), F4) if keep else None
    for t in range(steps):
        g = np.matmul(h, p["wh"])
        g[0] += table[0][ids[t, 0]]
        g[1] += table[1][ids[t, 1]]
        g *= scale
        np.tanh(g, out=g)
        s = g[..., :3 * n]
        s *= 0.5
        s += 0.5
        c = g[..., n:2 * n] * c + g[..., :n] * g[..., 3 * n:]
        h = g[..., 2 * n:3 * n] * np.tanh(c)
        hs[t] = h
        if keep:
            gates[t], cs[t] = g, c
    return hs, (ids, gates, cs)


def _scores(p, hs):
    both = np.concatenate([hs[:, 0], hs[::-1, 1]], axis=-1)
    return both @ p["wo"] + p["bo"], both


def _marginals(scores, trans):
    """Tag marginals (T, B, K), expected transition counts (K, K) and log partition values (B)."""
    steps = len(scores)
    top = scores.max(axis=2, keepdims=True)
    e, a = np.exp(scores - top), np.exp(trans)
    alpha, beta, log_z = np.empty_like(e), np.empty_like(e), top.sum(axis=(0, 2))
    for t in range(steps):
        v = e[t] if t == 0 else (alpha[t - 1] @ a) * e[t]
        z = v.sum(axis=1, keepdims=True)
        alpha[t] = v / z
        log_z = log_z + np.log(z[:, 0])
    beta[-1] = 1.0
    for t in range(steps - 2, -1, -1):
        v = (e[t + 1] * beta[t + 1]) @ a.T
        beta[t] = v / v.sum(axis=1, keepdims=True)
    m = alpha * beta
    m /= m.sum(axis=2, keepdims=True)
    nxt = e[1:] * beta[1:]
    norm = ((alpha[:-1] @ a) * nxt).sum(axis=2, keepdims=True)
    pair = a * np.einsum("tbi,tbj->ij", alpha[:-1], nxt / norm)
    return m, pair, log_z


def _loss_and_grads(p, x, y):
    steps, batch = x.shape
    tags, n = p["trans"].shape[0], p["wh"].shape[1]
    hs, (ids, gates, cs) = _lstm(p, x, True)
    scores, both = _scores(p, hs)
    m, pair, log_z = _marginals(scores, p["trans"])
    t_ix, b_ix = np.arange(steps)[:, None], np.arange(batch)[None, :]
    gold = scores[t_ix, b_ix, y].sum(axis=0) + p["trans"][y[:-1], y[1:]].sum(axis=0)
    d = m.copy()
    d[t_ix, b_ix, y] -= 1.0
    d /= batch
    counts = np.zeros((tags, tags), F4)
    np.add.at(counts, (y[:-1].ravel(), y[1:].ravel()), 1.0)
    grads = {"trans": (pair - counts) / batch, "bo": d.sum(axis=(0, 1)),
             "wo": np.einsum("tbi,tbk->ik", both, d), "wh": np.zeros_like(p["wh"])}
    back = d @ p["wo"].T
    dh_all = np.stack([back[..., :n], back[::-1, :, n:]], axis=1)
    table_grad = np.zeros((2, p["emb"].shape[0], 4 * n), F4)
    dh, dc = np.zeros((2, batch, n), F4), np.zeros((2, batch, n), F4)
    one_hot, whT = np.eye(len(p["emb"]), dtype=F4), p["wh"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        g, c = gates[t], cs[t]
        i, f, o, u = (g[..., k * n:(k + 1) * n] for k in range(4))
        tc = np.tanh(c)
        h_t = dh_all[t] + dh
        dc = dc + h_t * o * (1 - tc * tc)
        before = cs[t - 1] if t else np.zeros_like(c)
        dz = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), h_t * tc * o * (1 - o), dc * i * (1 - u * u)], axis=-1)
        if t:
            grads["wh"] += np.matmul(hs[t - 1].transpose(0, 2, 1), dz)
        table_grad += np.matmul(one_hot[ids[t]].transpose(0, 2, 1), dz)
        dh = np.matmul(dz, whT)
        dc = dc * f
    grads["b"] = table_grad.sum(axis=1)
    grads["wx"] = np.einsum("ce,dcg->deg", p["emb"], table_grad)
    grads["emb"] = np.einsum("dcg,deg->ce", table_grad, p["wx"])
    return float((log_z - gold).mean()), grads


def fit(x: np.ndarray, y: np.ndarray, chars: int, tags: int, *, embed: int = 12, hidden: int = 16, steps: int = 250,
        batch: int = 48, rate: float = 0.01, seed: int = 0) -> Tagger:
    """Train on windows ``x`` (N, T) of character ids and ``y`` (N, T) of tags; Adam, fixed seed."""
    rng = np.random.default_rng(seed)
    p = _init(chars, tags, embed, hidden, rng)
    m1, m2, k = {n: np.zeros_like(v) for n, v in p.items()}, {n: np.zeros_like(v) for n, v in p.items()}, 0
    order = np.concatenate([rng.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
    while k < steps:
        pick = order[k * batch:(k + 1) * batch]
        _, grads = _loss_and_grads(p, x[pick].T, y[pick].T)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        k += 1
        step = rate * (1 - 0.9 * k / steps)
        for name, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m1[name] = 0.9 * m1[name] + 0.1 * g
            m2[name] = 0.99 * m2[name] + 0.01 * g * g
            p[name] = (p[name] - step * (m1[name] / (1 - 0.9 ** k)) / (np.sqrt(m2[name] / (1 - 0.99 ** k)) + 1e-8)).astype(F4)
    return Tagger(p, hidden)


def decode(model: Tagger, x: np.ndarray, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Best paths (N, T) of the windows ``x`` (N, T), and the marginal probability of each tag on them."""
    paths, sure = np.empty(x.shape, np.int8), np.empty(x.shape, F4)
    trans = model.params["trans"]
    for at in range(0, len(x), batch):
        xb = x[at:at + batch].T
        hs, _ = _lstm(model.params, xb, False)
        scores, _ = _scores(model.params, hs)
        m, _, _ = _marginals(scores, trans)
        steps, n = xb.shape
        best, back = scores[0], np.empty((steps, n, trans.shape[0]), np.int8)
        for t in range(1, steps):
            cand = best[:, :, None] + trans[None]
            back[t] = cand.argmax(axis=1)
            best = cand.max(axis=1) + scores[t]
        path = np.empty((steps, n), np.int64)
        path[-1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t][np.arange(n), path[t]]
        paths[at:at + batch] = path.T
        sure[at:at + batch] = m[np.arange(steps)[:, None], np.arange(n)[None, :], path].T
    return paths, sure
