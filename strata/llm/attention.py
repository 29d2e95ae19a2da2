"""A small causal self-attention language model over subword ids, in numpy.

The next id's probability is that of its class given the context, times that
of the id within its class.  Class probabilities come from one attention layer
and a dense layer; ids' classes, shares within them, and code vectors come
from corpus statistics (``fit_tables``), the layers' weights from gradient
descent (``step``).

Texts are scored in overlapping windows of ``KEYS`` positions that advance by
``QUERIES``: the positions before a window's last ``QUERIES`` are context only,
so each id is scored once, with 16 to 31 ids before it.  Windows are handled
as a batch, under one causal mask.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KEYS, QUERIES = 32, 16
CODE, HIDDEN, CLASSES, SINGLES = 16, 32, 64, 28
BUCKETS = 96  # contexts of an id in the statistics: a hash of the id before it, apart where that closes a word
CONTEXTS = 2 * BUCKETS
BACK_OFF = 4.0
HIDE = np.float32(-1e9)
_AGE = np.arange(QUERIES)[:, None] + QUERIES - np.arange(KEYS)[None, :]  # how far back each key lies
_PAST, _AGE_AT = _AGE >= 0, _AGE.clip(0).ravel()


@dataclass
class Tables:
    code: np.ndarray      # (ids + 1, CODE); the last row stands for no id
    kind: np.ndarray      # class of each id
    inside: np.ndarray    # (ids, CONTEXTS): log probability of each id within its class, given its context


def contexts(before: np.ndarray, word_end: np.ndarray) -> np.ndarray:
    """Context number of the id that follows each id."""
    mixed = (before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(BUCKETS)).astype(np.int64) + BUCKETS * word_end[before]


def fit_tables(counts: np.ndarray, seed: int = 1) -> Tables:
    """From the counts (ids x CONTEXTS) of all training texts.

    Ids of like contexts get like codes (square roots of their context shares,
    reduced to CODE - 1 main directions, and their frequency); the most
    frequent ids are classes of their own, and the others are clustered.
    """
    n = len(counts)
    total = counts.sum(1)
    share = np.sqrt((counts + 0.05) / (total + 0.05 * CONTEXTS)[:, None])
    seen = total > 0
    weight = np.sqrt(total[seen]) if seen.any() else np.ones(0)
    centre = (share[seen] * weight[:, None]).sum(0) / weight.sum() if seen.any() else np.zeros(CONTEXTS)
    x = share - centre
    _, directions = np.linalg.eigh((x[seen] * weight[:, None]).T @ x[seen]) if seen.any() else (0, np.eye(CONTEXTS))
    code = np.zeros((n + 1, CODE), np.float32)
    code[:n, :CODE - 1] = x @ directions[:, ::-1][:, :CODE - 1]
    code[:n, CODE - 1] = np.log1p(total)
    code[:n][~seen] = 0
    if seen.any():
        code[:n] /= np.sqrt((code[:n][seen] ** 2).mean(0)) + 1e-6
    kind = np.full(n, CLASSES - 1, np.int64)
    order = np.argsort(-total, kind="stable")
    single = order[:SINGLES][total[order[:SINGLES]] > 0]
    kind[single] = np.arange(len(single))
    rest = order[SINGLES:][total[order[SINGLES:]] > 0]
    groups = CLASSES - SINGLES - 1
    if len(rest):
        rng = np.random.default_rng(seed)
        mean = code[rest[np.linspace(0, min(len(rest), 20 * groups) - 1, groups).astype(int)], :CODE - 1].copy()
        z, w = code[rest, :CODE - 1], total[rest].astype(np.float64)
        for _ in range(15):
            near = ((z ** 2).sum(1)[:, None] - 2 * z @ mean.T + (mean ** 2).sum(1)).argmin(1)
            for g in range(groups):
                mine = near == g
                mean[g] = np.average(z[mine], axis=0, weights=w[mine]) if mine.any() else z[rng.integers(len(z))]
        kind[rest] = SINGLES + near
    smooth = total + 0.1
    plain = smooth / np.bincount(kind, smooth, CLASSES)[kind]
    inside = np.empty((n, CONTEXTS), np.float32)
    for c in range(CONTEXTS):  # counts in this context, backed off to those in any
        inside[:, c] = np.log((counts[:, c] + BACK_OFF * plain) / (np.bincount(kind, counts[:, c], CLASSES)[kind] + BACK_OFF))
    return Tables(code, kind, inside)


def start_weights(seed: int = 2) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"q": (CODE, CODE), "k": (CODE, CODE), "v": (CODE, CODE), "h": (2 * CODE, HIDDEN), "o": (HIDDEN, CLASSES)}
    w = {k: rng.normal(0, s[0] ** -0.5, s).astype(np.float32) for k, s in shapes.items()}
    return w | {"age": np.zeros(KEYS, np.float32), "hb": np.zeros(HIDDEN, np.float32), "ob": np.zeros(CLASSES, np.float32)}


def mask(age: np.ndarray) -> np.ndarray:
    """(2, QUERIES, KEYS): causal scores added to every window, and to a text's first (no ids before it)."""
    rest = np.where(_PAST, age[_AGE_AT].reshape(_AGE.shape), HIDE)
    first = rest.copy()
    first[:, :QUERIES] = HIDE
    return np.stack([rest, first]).astype(np.float32)


def windows(ids: np.ndarray, sizes: np.ndarray, end: int, none: int, pick=slice(None)) -> tuple[np.ndarray, ...]:
    """Windows over all texts, or those at ``pick``: (keys (n, KEYS), targets (n, QUERIES), is a text's first, text).

    ``ids`` holds the texts one after the other, each closed by ``end``; the
    id before a text's first is ``end``, too.  Targets past a text are -1.
    """
    blocks = -(-sizes // QUERIES)
    text = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    text, nth = text[pick], nth[pick]
    begin = np.cumsum(sizes) - sizes
    place = nth[:, None] * QUERIES + np.arange(QUERIES)
    inside = place < sizes[text][:, None]
    target = np.where(inside, ids[np.minimum(begin[text][:, None] + place, len(ids) - 1)], -1)
    back = (nth[:, None] - 1) * QUERIES + np.arange(KEYS)  # inputs: position p holds the id before target p
    ok = (back >= 0) & (back < sizes[text][:, None])
    source = np.where(back == 0, end, ids[np.clip(begin[text][:, None] + back - 1, 0, len(ids) - 1)])
    return np.where(ok, source, none).astype(np.int64), target, nth == 0, text


def add_mask(a: np.ndarray, masks: np.ndarray, first: np.ndarray) -> None:
    """Add to each window's scores (n, QUERIES, KEYS) its mask."""
    opening = a[first] + masks[1]
    a += masks[0]
    a[first] = opening


def peaks(a: np.ndarray) -> np.ndarray:
    """``a.max(-1, keepdims=True)``, along long rows of a copy: short ones are slow."""
    return np.ascontiguousarray(a.reshape(-1, a.shape[-1]).T).max(0).reshape(*a.shape[:-1], 1)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(-1, keepdims=True)
    return z - np.log(np.exp(z).sum(-1, keepdims=True))


class Scorer:
    """Natural-log probabilities of texts under fixed weights (projections are tabled per id)."""

    def __init__(self, tables: Tables, w: dict[str, np.ndarray], word_end: np.ndarray):
        self.t, self.w = tables, w
        self.context = np.append(contexts(np.arange(len(word_end)), word_end), 0)
        self.q = tables.code @ w["q"] * np.float32(CODE ** -0.5)
        self.k, self.v = tables.code @ w["k"], tables.code @ w["v"]
        self.own = tables.code @ w["h"][:CODE] + w["hb"]
        self.mask = mask(w["age"])
        # a class without ids takes no probability
        self.bias = np.where(np.bincount(tables.kind, minlength=CLASSES) > 0, w["ob"], HIDE).astype(np.float32)[:, None]
        self.o = np.ascontiguousarray(w["o"].T)

    def log_probs(self, ids: np.ndarray, sizes: np.ndarray, end: int, step: int = 128) -> np.ndarray:
        """Natural-log probability of each id; ``ids`` and ``sizes`` as for ``windows``."""
        out, done = np.empty(len(ids)), 0
        h2 = self.w["h"][CODE:].T
        many = int((-(-sizes // QUERIES)).sum())
        some = max(16 * step, -(-many // 64))  # windows built at a time
        for j in range(0, many, some):
            keys, target, first, _ = windows(ids, sizes, end, len(self.t.code) - 1, slice(j, j + some))
            for i in range(0, len(keys), step):
                x, y = keys[i:i + step], target[i:i + step].ravel()
                now = x[:, QUERIES:]
                a = self.q.take(now, 0) @ self.k.take(x, 0).transpose(0, 2, 1)
                add_mask(a, self.mask, first[i:i + step])
                a -= peaks(a)
                np.exp(a, out=a)
                mixed = (a @ self.v.take(x, 0)) / a.sum(-1, keepdims=True)
                now = now.ravel()
                # positions are columns, so that sums over classes run along rows
                z = h2 @ mixed.reshape(-1, CODE).T
                z += self.own.take(now, 0).T
                np.maximum(z, 0, out=z)
                z = self.o @ z
                z += self.bias
                z -= z.max(0)
                real = np.flatnonzero(y >= 0)
                y = y[real]
                logp = z[self.t.kind[y], real] + self.t.inside[y, self.context[now[real]]]
                np.exp(z, out=z)
                out[done:done + len(y)] = logp - np.log(z.sum(0)[real])
                done += len(y)
        return out


def step(tables: Tables, w: dict[str, np.ndarray], keys: np.ndarray, target: np.ndarray,
         first: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss per id (of the class) and gradients of a batch of windows."""
    e = tables.code.take(keys, 0)
    now = np.ascontiguousarray(e[:, QUERIES:]).reshape(-1, CODE)
    flat, n = e.reshape(-1, CODE), len(keys)
    scale = np.float32(CODE ** -0.5)
    q = (now @ (w["q"] * scale)).reshape(n, QUERIES, CODE)
    k, v = (flat @ w["k"]).reshape(e.shape), (flat @ w["v"]).reshape(e.shape)
    a = q @ k.transpose(0, 2, 1)
    add_mask(a, mask(w["age"]), first)
    a -= peaks(a)
    np.exp(a, out=a)
    a /= a.sum(-1, keepdims=True)
    mixed = (a @ v).reshape(-1, CODE)
    # from here on positions are columns, so that sums over classes run along rows
    h = w["h"][:CODE].T @ now.T
    h += w["h"][CODE:].T @ mixed.T
    h += w["hb"][:, None]
    np.maximum(h, 0, out=h)
    dz = w["o"].T @ h
    dz += w["ob"][:, None]
    dz -= dz.max(0)
    target = target.ravel()
    real = np.flatnonzero(target >= 0)
    kind = tables.kind[target[real]]
    hit = dz[kind, real]
    np.exp(dz, out=dz)
    total = dz.sum(0)
    count = max(len(real), 1)
    loss = -float((hit - np.log(total[real])).sum()) / count
    dz *= (target >= 0) / (total * np.float32(count))
    dz[kind, real] -= np.float32(1 / count)
    g = {"o": h @ dz.T, "ob": dz.sum(1)}
    dpre = w["o"] @ dz
    dpre *= h > 0
    g["h"], g["hb"] = np.concatenate([now.T @ dpre.T, mixed.T @ dpre.T]), dpre.sum(1)
    dmixed = (dpre.T @ w["h"][CODE:].T).reshape(q.shape)
    ds = dmixed @ v.transpose(0, 2, 1)
    ds -= (ds * a).sum(-1, keepdims=True)
    ds *= a
    dv, dq, dk = a.transpose(0, 2, 1) @ dmixed, ds @ k, ds.transpose(0, 2, 1) @ q
    g["v"], g["k"] = flat.T @ dv.reshape(-1, CODE), flat.T @ dk.reshape(-1, CODE)
    g["q"] = now.T @ dq.reshape(-1, CODE) * scale
    g["age"] = np.bincount(_AGE_AT, (ds.sum(0) * _PAST).ravel(), KEYS).astype(np.float32)
    return loss, g


class Learner:
    """Adam steps over batches of windows, from weights ``w``."""

    def __init__(self, tables: Tables, w: dict[str, np.ndarray], rate: float):
        self.tables, self.rate, self.steps = tables, rate, 0
        # one flat vector that the weights are views of
        self.names = list(w)
        self.flat = np.concatenate([w[k].ravel() for k in self.names])
        cuts = np.cumsum([w[k].size for k in self.names])[:-1]
        self.w = {k: x.reshape(w[k].shape) for k, x in zip(self.names, np.split(self.flat, cuts))}
        self.m1, self.m2 = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def gradients(self, keys: np.ndarray, target: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        return step(self.tables, self.w, keys, target, first)[1]

    def learn(self, keys: np.ndarray, target: np.ndarray, first: np.ndarray, batch: int = 64) -> None:
        for i in range(0, len(keys), batch):
            self.steps += 1
            t = self.steps
            g = self.gradients(keys[i:i + batch], target[i:i + batch], first[i:i + batch])
            g = np.concatenate([g[k].ravel() for k in self.names])
            self.m1 *= 0.9
            self.m1 += 0.1 * g
            self.m2 *= 0.99
            self.m2 += 0.01 * g ** 2
            self.flat -= (self.rate * min(1.0, t / 20) * (self.m1 / (1 - 0.9 ** t))
                          / (np.sqrt(self.m2 / (1 - 0.99 ** t)) + 1e-8))
