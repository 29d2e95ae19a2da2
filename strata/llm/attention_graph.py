"""The attention model's products (attention.py) as two onnxruntime graphs, for scoring and for learning.

The same sums as ``attention.Scorer`` and ``attention.step``, in an order that
saves products: queries and keys meet through one matrix (that of the queries
times that of the keys), and codes are mixed before they become values, so that
keys are never multiplied.  Equal to numpy's but for rounding.
"""

from __future__ import annotations

import functools
import importlib.util

import numpy as np

from . import attention as A
from .attention import CLASSES, CODE, CONTEXTS, HIDDEN, KEYS, QUERIES
from .onnx_graph import Graph

READY = importlib.util.find_spec("onnxruntime") is not None  # loaded by the tasks only
SCALE = float(CODE ** -0.5)
SHAPES = {k: x.shape for k, x in A.start_weights().items() if k != "age"}


def _forward() -> Graph:
    """From codes and windows to the classes' scores ``z`` (a row for each target)."""
    g = Graph()
    g.input("code", np.float32, "ids", CODE)
    g.input("keys", np.int64, "n", KEYS)
    g.input("first", np.int64, "n")
    g.input("kind", np.int64, "m")
    g.input("masks", np.float32, 2, QUERIES, KEYS)
    for k, shape in SHAPES.items():
        g.input(f"w_{k}", np.float32, *shape)
    for name, x in {"at0": [0], "at1": [1], "at2": [2], "own": [QUERIES], "all": [KEYS], "halves": [CODE, CODE],
                    "rows": [-1, CODE], "wins": [-1, QUERIES, CODE], "column": [-1, 1]}.items():
        g.constant(name, np.array(x, np.int64))
    g.add("Gemm", "w_q w_k", "look", transB=1, alpha=SCALE)
    g.add("Split", "w_h halves", "h_own h_mixed", axis=0)
    g.add("MatMul", "w_v h_mixed", "vh")
    g.add("Concat", "h_own vh", "dense", axis=0)
    g.add("Gather", "code keys", "e", axis=0)
    g.add("Slice", "e own all at1", "now3")
    g.add("Reshape", "now3 rows", "now")
    g.add("MatMul", "now look", "q")
    g.add("Reshape", "q wins", "q3")
    g.add("Transpose", "e", "et", perm=[0, 2, 1])
    g.add("MatMul", "q3 et", "met")
    g.add("Gather", "masks first", "mask", axis=0)
    g.add("Add", "met mask", "s")
    g.add("Softmax", "s", "p", axis=-1)
    g.add("MatMul", "p e", "mixed3")
    g.add("Reshape", "mixed3 rows", "mixed")
    g.add("Concat", "now mixed", "x", axis=1)
    g.add("Gemm", "x dense w_hb", "pre")
    g.add("Relu", "pre", "relu")
    return g


@functools.cache
def scoring():
    """Log probabilities of classes; one per Python worker."""
    g = _forward()
    g.add("Gemm", "relu w_o w_ob", "z")
    g.add("LogSoftmax", "z", "logp", axis=-1)
    g.add("Reshape", "kind column", "kinds")
    g.add("GatherElements", "logp kinds", "hit", axis=1)
    g.output("hit", "m", 1)
    return g.session()


@functools.cache
def learning():
    """Gradients, summed over a batch's targets; ``kind`` is CLASSES where there is none.  One per Python worker."""
    g = _forward()
    g.constant("hot", np.eye(CLASSES + 1, CLASSES, dtype=np.float32))
    g.constant("is_real", (np.arange(CLASSES + 1) < CLASSES).astype(np.float32)[:, None])
    g.constant("zero", np.zeros(1, np.float32))
    # rows without target give nothing: their outputs are 0, and so is the way back through them
    g.add("Gather", "is_real kind", "real", axis=0)
    g.add("Mul", "relu real", "h")
    g.add("Gemm", "h w_o w_ob", "z")
    g.add("Softmax", "z", "share", axis=-1)
    g.add("Gather", "hot kind", "hits", axis=0)
    g.add("Sub", "share hits", "dz")
    g.add("Gemm", "h dz", "g_o", transA=1)
    g.add("Gemm", "real dz", "g_ob", transA=1)
    g.add("Gemm", "dz w_o", "dh", transB=1)
    g.add("Greater", "h zero", "on")
    g.add("Where", "on dh zero", "dpre")
    g.add("Gemm", "x dpre", "g_dense", transA=1)
    g.add("Gemm", "real dpre", "g_hb", transA=1)
    g.add("Split", "g_dense halves", "g_own g_vh", axis=0)
    g.add("Gemm", "g_vh h_mixed", "g_v", transB=1)
    g.add("Gemm", "w_v g_vh", "g_mixed", transA=1)
    g.add("Concat", "g_own g_mixed", "g_h", axis=0)
    g.add("Gemm", "dpre vh", "dmixed", transB=1)
    g.add("Mul", "dmixed mixed", "both")
    g.add("Reshape", "both wins", "both3")
    g.add("ReduceSum", "both3 at2", "even", keepdims=1)
    g.add("Reshape", "dmixed wins", "dmixed3")
    g.add("MatMul", "dmixed3 et", "dp")
    g.add("Sub", "dp even", "rest")
    g.add("Mul", "p rest", "ds")
    g.add("MatMul", "ds e", "dq3")
    g.add("Reshape", "dq3 rows", "dq")
    g.add("Gemm", "now dq", "g_look", transA=1)
    g.add("Gemm", "g_look w_k", "g_q", alpha=SCALE)
    g.add("Gemm", "g_look w_q", "g_k", transA=1, alpha=SCALE)
    g.add("ReduceSum", "ds at0", "by_age", keepdims=0)
    for k, shape in SHAPES.items():
        g.output(f"g_{k}", *(shape if len(shape) > 1 else (1, *shape)))
    g.output("by_age", QUERIES, KEYS)
    return g.session()


def _given(code: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {"code": code, "masks": A.mask(w["age"]), **{f"w_{k}": w[k] for k in SHAPES}}


class Scorer:
    """As ``attention.Scorer``."""

    def __init__(self, tables: A.Tables, w: dict[str, np.ndarray], word_end: np.ndarray):
        self.t = tables
        self.context = np.append(A.contexts(np.arange(len(word_end)), word_end), 0)
        # a class without ids takes no probability
        bias = np.where(np.bincount(tables.kind, minlength=CLASSES) > 0, w["ob"], A.HIDE).astype(np.float32)
        self.given = _given(tables.code, w | {"ob": bias})

    def log_probs(self, ids: np.ndarray, sizes: np.ndarray, end: int, step: int = 128) -> np.ndarray:
        """Natural-log probability of each id; ``ids`` and ``sizes`` as for ``attention.windows``."""
        out, done = np.empty(len(ids)), 0
        inside, kinds, run = self.t.inside.ravel(), np.append(self.t.kind, 0), scoring().run
        many = int((-(-sizes // QUERIES)).sum())
        some = max(16 * step, -(-many // 64))  # windows built at a time
        for j in range(0, many, some):
            keys, target, first, _ = A.windows(ids, sizes, end, len(self.t.code) - 1, slice(j, j + some))
            first, kind, hits = first.astype(np.int64), kinds.take(target.ravel()), []
            for i in range(0, len(keys), step):
                hits.append(run(None, self.given | {"keys": keys[i:i + step], "first": first[i:i + step],
                                                    "kind": kind[i * QUERIES:(i + step) * QUERIES]})[0])
            real = np.flatnonzero(target.ravel() >= 0)
            y, now = target.ravel()[real], keys[:, QUERIES:].ravel()[real]
            out[done:done + len(y)] = np.concatenate(hits).ravel()[real] + inside.take(y * CONTEXTS + self.context[now])
            done += len(y)
        return out


class Learner(A.Learner):
    """As ``attention.Learner``."""

    def __init__(self, tables: A.Tables, w: dict[str, np.ndarray], rate: float):
        super().__init__(tables, w, rate)
        self.kinds = np.append(tables.kind, CLASSES)  # -1: no target

    def gradients(self, keys: np.ndarray, target: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        kind = self.kinds.take(target.ravel())
        got = learning().run(None, _given(self.tables.code, self.w) | {"keys": keys, "first": first.astype(np.int64), "kind": kind})
        share = np.float32(1 / max(np.count_nonzero(kind < CLASSES), 1))
        g = {k: x * share for k, x in zip(SHAPES, got)}
        g["age"] = np.bincount(A._AGE_AT, (got[-1] * A._PAST).ravel() * share, KEYS).astype(np.float32)
        return g
