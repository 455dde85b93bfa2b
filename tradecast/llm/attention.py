"""A small causal self-attention language model in numpy.

Subwords are the character trigrams of a token (over UTF-8 bytes, with a blank
on either side), hashed to ids; a token's vector is the mean of its subwords'.
One attention layer reads the tokens so far and gives a distribution over
classes; every token has a distribution over classes of its own, from its
vector.  With q the token's, p the context's and z the mean of q over all
training tokens, the layer says how much likelier than on average the token is
here: sum over classes of p * q / z.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from tradecast.llm.shingles import word_hashes

SUBWORDS = 1 << 14
START, END = SUBWORDS, SUBWORDS + 1   # ids of the start and of the end of a text
WIDTH = 16
CLASSES = 32
WINDOW = 32       # tokens that a window reads
STRIDE = 24       # by which windows advance; those after the first score so many tokens
END_HASH = np.uint64(0)
BATCH = 512       # windows scored at a time
SHORT = 24        # subwords of a token that are added one by one, for all tokens at once


@dataclass
class Tokens:
    """The tokens of some texts, one end each, in a row."""
    hash: np.ndarray      # of every distinct token, ascending
    ids: np.ndarray       # subwords of the distinct tokens, one after another
    first: np.ndarray     # where a distinct token's begin, and the end of all
    at: np.ndarray        # distinct token of every token
    length: np.ndarray    # tokens of every text


def tokenize(texts: list[bytes]) -> Tokens:
    """Lower-cases A-Z; words and one end per text."""
    h, doc, buf, start, end = word_hashes(texts, spans=True)
    wide = np.concatenate(([32], buf, [32, 32])).astype(np.uint32)
    tri = ((wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D)))
    tri = ((tri * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 14)).astype(np.int32)
    order = np.argsort(h)  # any word of a hash will do; np.unique would take longer to find the first
    new = np.diff(h[order], prepend=~h[order[:1]]) != 0
    where = order[new]
    hashes, at = h[where], np.empty(len(h), np.int64)
    at[order] = np.cumsum(new) - 1
    size = end[where] - start[where]  # a word of n bytes has n trigrams
    first = np.concatenate(([0, 1], 1 + np.cumsum(size)))
    ids = np.empty(first[-1], np.int32)
    ids[0] = END
    if len(hashes):
        ids[1:] = tri[np.arange(first[-1] - 1) - np.repeat(first[1:-1] - 1, size) + np.repeat(start[where], size)]
    words = np.bincount(doc, minlength=len(texts))
    length = words + 1
    every = np.zeros(int(length.sum()), np.int64)  # the end is distinct token 0
    every[np.arange(len(h)) + doc] = at + 1
    return Tokens(np.concatenate(([END_HASH], hashes)), ids, first, every, length)


@dataclass
class Windows:
    """Rows of ``WINDOW`` steps over the tokens of some texts."""
    step: np.ndarray    # windows x WINDOW, index of the token that a step predicts
    opens: np.ndarray   # windows x WINDOW, whether that is the first of its text
    scored: np.ndarray  # windows x WINDOW, whether this window scores it


def windows(length: np.ndarray) -> Windows:
    count = 1 + np.maximum(0, -(-(length - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.concatenate(([0], np.cumsum(length)))
    offset = nth[:, None] * STRIDE + np.arange(WINDOW)
    inside = offset < length[text][:, None]
    fresh = (nth[:, None] == 0) | (np.arange(WINDOW) >= WINDOW - STRIDE)
    step = begin[text][:, None] + np.minimum(offset, length[text][:, None] - 1)
    return Windows(step, offset == 0, inside & fresh)


def softmax(x: np.ndarray) -> np.ndarray:
    """Over the last axis; uses up ``x``.  One shift serves all rows, unless a row lies far below it."""
    one = np.ones(x.shape[-1], x.dtype)
    x -= x.max()
    e = np.exp(x)
    total = e @ one  # sums of short rows are faster so
    if not total.min() > 1e-25:
        x -= x.max(-1, keepdims=True)
        np.exp(x, out=e)
        total = e @ one
    e /= total[..., None]
    return e


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, as a column."""
    return np.einsum("ij,ij->i", a, b)[:, None]


_LATER = np.triu(np.ones((WINDOW, WINDOW), bool), 1)
_DISTANCE = np.clip(np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None], 0, WINDOW - 1)


def new_parameters(seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)

    return {"subword": normal(SUBWORDS + 2, WIDTH, scale=0.5), "query": normal(WIDTH, WIDTH, scale=0.2),
            "key": normal(WIDTH, WIDTH, scale=0.2), "value": normal(WIDTH, WIDTH, scale=0.3),
            "near": np.zeros(WINDOW, np.float32), "out": normal(WIDTH, CLASSES, scale=0.3),
            "last": normal(WIDTH, CLASSES, scale=0.1), "bias": np.zeros(CLASSES, np.float32),
            "class": normal(WIDTH, CLASSES, scale=0.5), "share": np.zeros(CLASSES, np.float32)}


def vectors(p: dict[str, np.ndarray], ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean subword vector of every distinct token."""
    sizes = np.diff(first)
    order = np.argsort(-np.minimum(sizes, SHORT + 1).astype(np.int8), kind="stable")  # the longest first
    begin, size = first[:-1][order], sizes[order]
    long = int((size > SHORT).sum())
    sums = np.empty((len(size), WIDTH), p["subword"].dtype)
    if long:
        many = size[:long]
        ends = np.cumsum(many)
        at = np.arange(ends[-1]) + np.repeat(begin[:long] - (ends - many), many)
        sums[:long] = np.add.reduceat(p["subword"][ids[at]], ends - many, axis=0)
    begin, rest = begin[long:], sums[long:]
    rest[:] = p["subword"][ids[begin]]
    left = np.cumsum(np.bincount(size[long:], minlength=SHORT + 1)[::-1])[::-1]  # words of so many subwords or more
    for j in range(1, SHORT):
        n = left[j + 1]
        if not n:
            break
        rest[:n] += p["subword"][ids[begin[:n] + j]]
    sums /= size[:, None].astype(np.float32)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def classes(p: dict[str, np.ndarray], v: np.ndarray) -> np.ndarray:
    """Distribution over classes of every token vector."""
    return softmax(v @ p["class"] + p["share"])


def _attend(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masked attention over windows of vectors; all that the gradient needs.
    The distributions and what is read have a row for each step."""
    rows = x.reshape(-1, WIDTH)
    q, k, v = (m.reshape(x.shape) for m in (rows @ p["query"], rows @ p["key"], rows @ p["value"]))
    bias = p["near"][_DISTANCE]
    bias[_LATER] = -1e9
    s = (q * np.float32(WIDTH ** -0.5)) @ k.transpose(0, 2, 1)
    s += bias
    a = softmax(s)
    h = (a @ v).reshape(-1, WIDTH)
    c = h @ p["out"]
    c += rows @ p["last"]
    c += p["bias"]
    return softmax(c), q, k, v, a, h


def _inputs(p: dict[str, np.ndarray], v: np.ndarray, at: np.ndarray, w: Windows, rows: slice | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors read (of the token before, or of the start), and their tokens."""
    before = at[np.maximum(w.step[rows] - 1, 0)]
    x = v[before]
    x[w.opens[rows]] = p["subword"][START]
    return x, before


def lifts(p: dict[str, np.ndarray], mean: np.ndarray, t: Tokens) -> np.ndarray:
    """How much likelier than on average every token is, given those before it.
    Each is scored once, in the window that has most before it."""
    v = vectors(p, t.ids, t.first)
    q = classes(p, v) / np.maximum(mean, 1e-9).astype(np.float32)
    w = windows(t.length)
    out = np.ones(len(t.at), np.float32)
    for i in range(0, len(w.step), BATCH):
        rows = slice(i, i + BATCH)
        x, _ = _inputs(p, v, t.at, w, rows)
        c = _attend(p, x)[0]
        step, scored = w.step[rows], w.scored[rows]
        step = step[scored]
        out[step] = np.einsum("ij,ij->i", c[scored.ravel()], q[t.at[step]])
    return out


def gradient(p: dict[str, np.ndarray], t: Tokens, w: Windows, rows: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean of -log(lift) over the tokens that the windows score, with the
    classes' means taken over the same tokens, and its gradient."""
    step, scored = w.step[rows], w.scored[rows]
    target, before = t.at[step], t.at[np.maximum(step - 1, 0)]
    used, where = np.unique(np.concatenate((target.ravel(), before.ravel())), return_inverse=True)
    sizes = np.diff(t.first)[used]
    first = np.concatenate(([0], np.cumsum(sizes)))
    ids = t.ids[np.arange(first[-1]) - np.repeat(first[:-1], sizes) + np.repeat(t.first[used], sizes)]
    v = vectors(p, ids, first)
    target, before = where[:target.size].reshape(target.shape), where[target.size:].reshape(before.shape)
    x = v[before]
    opens = w.opens[rows]
    x[opens] = p["subword"][START]
    c, q, k, val, a, h = _attend(p, x)
    rows_x, vt = x.reshape(-1, WIDTH), v[target.ravel()]
    own = classes(p, vt)
    n = max(1, int(scored.sum()))
    weight = (scored.ravel() / n).astype(np.float32)[:, None]
    mean = np.maximum((weight.T @ own)[0], 1e-6)
    ratio = own / mean
    lift = _dot(c, ratio)
    loss = float(-(np.log(lift) * weight).sum())
    g: dict[str, np.ndarray] = {}
    each = weight / lift
    down = c * (-1 / mean)
    down *= each
    down -= np.einsum("ij,ij->j", down, own) / mean * weight
    do = down - _dot(down, own)
    do *= own
    ratio *= each
    dg = weight - ratio  # the mean of the gradient of c under c itself is -weight
    dg *= c
    g["class"], g["share"] = vt.T @ do, do.sum(0)
    dv_target = do @ p["class"].T
    g["out"], g["last"], g["bias"] = h.T @ dg, rows_x.T @ dg, dg.sum(0)
    dh = dg @ p["out"].T
    dx = dg @ p["last"].T
    own_part = _dot(dh, h).reshape(*x.shape[:2], 1)  # sum of da * a over what a step reads
    dh = dh.reshape(x.shape)
    ds, dval = dh @ val.transpose(0, 2, 1), a.transpose(0, 2, 1) @ dh
    ds -= own_part
    ds *= a
    g["near"] = np.bincount(_DISTANCE.ravel(), (ds.sum(0) * ~_LATER).ravel(), WINDOW).astype(np.float32)
    ds *= np.float32(WIDTH ** -0.5)
    dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
    for name, d in (("query", dq), ("key", dk), ("value", dval)):
        d = d.reshape(-1, WIDTH)
        g[name] = rows_x.T @ d
        dx += d @ p[name].T
    dx = dx.reshape(x.shape)
    start = dx[opens].sum(0)
    dx[opens] = 0
    every, grads = np.concatenate((target.ravel(), before.ravel())), np.concatenate((dv_target, dx.reshape(-1, WIDTH)))
    dv = _summed(every, grads, len(used)) / sizes[:, None]
    g["subword"] = _summed(ids, np.repeat(dv, sizes, axis=0), SUBWORDS + 2).astype(np.float32)
    g["subword"][START] += start
    return loss, g


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that go to each of 0..n-1."""
    cell = at[:, None] * WIDTH + np.arange(WIDTH)
    return np.bincount(cell.ravel(), rows.ravel(), n * WIDTH).reshape(n, WIDTH)


def train(p: dict[str, np.ndarray], texts: list[bytes], seed: int, rate: float, epochs: int = 1, batch: int = 96) -> tuple[dict[str, np.ndarray], list[float]]:
    """Adam over the windows of the texts in a seeded order."""
    p = {k: v.copy() for k, v in p.items()}
    t = tokenize(texts)
    w = windows(t.length)
    rng = np.random.default_rng(seed)
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    losses, i = [], 0
    for _ in range(epochs):
        order = rng.permutation(len(w.step))
        for a in range(0, len(order), batch):
            loss, g = gradient(p, t, w, order[a:a + batch])
            losses.append(loss)
            i += 1
            for k, d in g.items():
                d = d.astype(np.float32, copy=False)
                m[k] *= np.float32(0.9)
                s[k] *= np.float32(0.99)
                m[k] += np.float32(0.1) * d
                d = d * d
                d *= np.float32(0.01)
                s[k] += d
                np.sqrt(s[k], out=d)
                d += np.float32(1e-6 * math.sqrt(1 - 0.99 ** i))
                np.divide(m[k], d, out=d)
                d *= np.float32(rate * math.sqrt(1 - 0.99 ** i) / (1 - 0.9 ** i))
                p[k] -= d
    return p, losses
