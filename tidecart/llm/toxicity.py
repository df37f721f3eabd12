"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Each word enters as a learned word vector, its log-odds among the training labels, and the mean of learned vectors of its
character trigrams. Two GRUs read overlapping windows of a text in both directions; attention pools their states to a
logit per window; the highest window gives the text's score. All windows of all texts are scored.

Training sees a bounded, hashed sample of labelled rows: in rounds, the windows of each text that score highest (at first those
with the highest log-odds) and a random one are learned from by back-propagation through time.

Null and empty texts are one window of padding. Rows that repeat a doc_id are scored one by one. Without labels of both kinds
every score is the share of toxic labels (0 if there are none). Extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import crc, sample_by_hash, small, stored, text_bytes

#: Bound of the training sample, rows of each label.
SAMPLE_ROWS = 1500
WINDOW, STRIDE = 32, 24
VOCABULARY, LEAST_TEXTS, TRIGRAMS = 20_000, 4, 2048
WORD_DIM, CHAR_DIM, HIDDEN = 7, 8, 8
INPUT = WORD_DIM + 1 + CHAR_DIM
ROUNDS, EPOCHS, BATCH, RATE = 3, 3, 96, 0.015
TOXIC_FROM = 0.7
#: Words a task remembers, windows in one pass.
CACHE, PASS = 200_000, 2048

# ASCII letters are lower-cased, all other ASCII characters part words; bytes beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _trigrams(distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of words with an edge mark at both ends, laid end to end, and how many each word has (its bytes)."""
    flat = np.frombuffer(b"<" + b"><".join(distinct) + b">", np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    at = np.arange(int(sizes.sum())) + np.repeat(2 * np.arange(len(distinct)), sizes)
    return (flat[at] * 961 + flat[at + 1] * 31 + flat[at + 2] * 7919) % TRIGRAMS, sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(p: dict, side: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (time, rows, hidden) of one direction over projected inputs (time, rows, 3 * hidden)."""
    u, h = p[f"u{side}"], np.zeros((x.shape[1], HIDDEN), x.dtype)
    states, trace = np.empty((*x.shape[:2], HIDDEN), x.dtype), []
    for t in range(x.shape[0]):
        m = h @ u
        zr = _sigmoid(x[t, :, : 2 * HIDDEN] + m[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN :] + r * m[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if keep:
            trace.append((h, z, r, n, m[:, 2 * HIDDEN :]))
        h = states[t] = new
    return states, trace


def _gru_back(p: dict, g: dict, side: str, trace: list, out: np.ndarray) -> np.ndarray:
    """Gradient of the projected inputs from that of the states; adds to the gradient of the recurrent weights."""
    u, dh = p[f"u{side}"], np.zeros_like(out[0])
    dx = np.empty((*out.shape[:2], 3 * HIDDEN), out.dtype)
    for t in range(len(trace) - 1, -1, -1):
        h, z, r, n, mn = trace[t]
        d = out[t] + dh
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * mn * r * (1 - r)
        dm = np.concatenate([dz, dr, dn * r], 1)
        dx[t] = np.concatenate([dz, dr, dn], 1)
        g[f"u{side}"] += h.T @ dm
        dh = d * z + dm @ u.T
    return dx


def window_logits(p: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Logits of windows; ``x`` (time, rows, input) and ``mask`` (time, rows)."""
    ahead, ta = _gru(p, "f", x @ p["wf"] + p["bf"], keep)
    back, tb = _gru(p, "b", (x @ p["wb"] + p["bb"])[::-1], keep)
    states = np.concatenate([ahead, back[::-1]], 2)
    weight = np.where(mask, states @ p["a"], -30.0)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = np.einsum("tr,trh->rh", weight, states)
    return pooled @ p["o"] + p["c"][0], (states, weight, pooled, ta, tb)


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """Mean log loss, gradients of the weights and of the inputs."""
    logit, (states, weight, pooled, ta, tb) = window_logits(p, x, mask, keep=True)
    prob = _sigmoid(logit)
    loss = float(-np.mean(np.where(y > 0, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))))
    d = (prob - y) / len(y)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["o"], g["c"][0] = pooled.T @ d, d.sum()
    dp = d[:, None] * p["o"]
    ds = weight[:, :, None] * dp
    dw = np.einsum("trh,rh->tr", states, dp)
    dw = weight * (dw - (weight * dw).sum(0)) * mask
    g["a"] = np.einsum("tr,trh->h", dw, states)
    ds += dw[:, :, None] * p["a"]
    dxf = _gru_back(p, g, "f", ta, ds[:, :, :HIDDEN])
    dxb = _gru_back(p, g, "b", tb, ds[::-1, :, HIDDEN:])[::-1]
    for side, dx in (("f", dxf), ("b", dxb)):
        g[f"w{side}"] = np.einsum("tri,trj->ij", x, dx)
        g[f"b{side}"] = dx.sum((0, 1))
    return loss, g, dxf @ p["wf"].T + dxb @ p["wb"].T


def _inputs(model: dict, distinct: list[bytes]) -> np.ndarray:
    """Input vectors of words; a last row of zeros is the padding."""
    out = np.zeros((len(distinct) + 1, INPUT), np.float32)
    at = np.fromiter((model["words"].get(w, 0) for w in distinct), np.int64, len(distinct))
    out[:-1, :WORD_DIM] = model["we"][at]
    out[:-1, WORD_DIM] = model["odds"][at]
    if distinct:
        flat, sizes = _trigrams(distinct)
        out[:-1, WORD_DIM + 1 :] = np.add.reduceat(model["ce"][flat], np.cumsum(sizes) - sizes) / sizes[:, None]
    return out


def _spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts laid end to end: text, first place, length. An empty text has one window without words."""
    count = np.maximum(-(-(sizes - (WINDOW - STRIDE)) // STRIDE), 1)
    text = np.repeat(np.arange(len(sizes)), count)
    order = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = order * STRIDE
    return text, (np.cumsum(sizes) - sizes)[text] + first, np.minimum(sizes[text] - first, WINDOW)


def _laid(ids: np.ndarray, first: np.ndarray, length: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids (time, windows) and their mask."""
    step = np.arange(WINDOW)[:, None]
    mask = step < length
    at = np.where(mask, first + step, 0)
    return np.where(mask, ids[at] if len(ids) else pad, pad), mask


def _all_logits(p: dict, x: np.ndarray, ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    pad = len(x) - 1
    out = np.empty(len(first), np.float32)
    # What words feed to the gates is computed once per distinct word, not once per window.
    feed = {s: (x @ p[f"w{s}"] + p[f"b{s}"]).astype(np.float32) for s in "fb"}
    for a in range(0, len(first), PASS):
        grid, mask = _laid(ids, first[a : a + PASS], length[a : a + PASS], pad)
        ahead, _ = _gru(p, "f", feed["f"][grid], False)
        back, _ = _gru(p, "b", feed["b"][grid[::-1]], False)
        wa, wb = p["a"][:HIDDEN], p["a"][HIDDEN:]
        weight = np.where(mask, ahead @ wa + (back @ wb)[::-1], -30.0)
        weight = np.exp(weight - weight.max(0))
        value = ahead @ p["o"][:HIDDEN] + (back @ p["o"][HIDDEN:])[::-1]
        out[a : a + PASS] = (weight * value).sum(0) / weight.sum(0) + p["c"][0]
    return out


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 11) -> dict:
    """The model: ``words`` (id of known words; 0 is unknown), their vectors and log-odds, trigram vectors, network weights."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return {"share": share}
    rng = np.random.default_rng(seed)
    cut = [words(t) for t in texts]
    seen, bad = Counter(), Counter()
    for line, label in zip(cut, toxic):
        seen.update(set(line))
        if label:
            bad.update(set(line))
    known = [w for w, n in seen.most_common(VOCABULARY) if n >= LEAST_TEXTS]
    n_bad, n_all = toxic.sum(), len(toxic)
    odds = [np.log((bad[w] + 0.5) / (n_bad + 1)) - np.log((seen[w] - bad[w] + 0.5) / (n_all - n_bad + 1)) for w in known]
    shrink = [seen[w] / (seen[w] + 20.0) for w in known]
    model = {
        "words": {w: k + 1 for k, w in enumerate(known)},
        "odds": np.r_[0.0, np.array(odds) * np.array(shrink) / 2].astype(np.float32),
        "we": rng.normal(0, 0.1, (len(known) + 1, WORD_DIM)).astype(np.float32),
        "ce": rng.normal(0, 0.3, (TRIGRAMS, CHAR_DIM)).astype(np.float32),
    }
    p = {"a": rng.normal(0, 0.3, 2 * HIDDEN), "o": rng.normal(0, 0.3, 2 * HIDDEN), "c": np.array([-1.0])}
    for side in "fb":
        p |= {f"w{side}": rng.normal(0, 0.35, (INPUT, 3 * HIDDEN)), f"u{side}": rng.normal(0, 0.35, (HIDDEN, 3 * HIDDEN)), f"b{side}": np.zeros(3 * HIDDEN)}
    p = model["net"] = {k: v.astype(np.float32) for k, v in p.items()}

    distinct = list({w: None for line in cut for w in line})
    place = {w: k for k, w in enumerate(distinct)}
    ids = np.array([place[w] for line in cut for w in line], np.int64)
    text, first, length = _spans(np.array([len(line) for line in cut], np.int64))
    row = np.array([model["words"].get(w, 0) for w in distinct] + [0], np.int64)
    padded = np.r_[model["odds"][row[:-1]], 0.0]
    begins = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in [*p.items(), ("we", model["we"]), ("ce", model["ce"])]}
    steps = 0

    def adam(name: str, value: np.ndarray, grad: np.ndarray) -> None:
        m, v = state[name]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        value -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-7)

    for turn in range(ROUNDS):
        if turn == 0:
            grid, mask = _laid(ids, first, length, len(distinct))
            value = np.where(mask, padded[grid], -9.0).max(0)
        else:
            value = _all_logits(p, _inputs(model, distinct), ids, first, length)
        best = np.lexsort((value, text))[np.r_[begins[1:], len(text)] - 1]
        drawn = begins + (rng.random(len(begins)) * np.diff(np.r_[begins, len(text)])).astype(np.int64)
        chosen = np.r_[best, drawn[toxic == 0]]
        label = np.r_[toxic, np.zeros(int((toxic == 0).sum()))].astype(np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(chosen))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                grid, mask = _laid(ids, first[chosen[pick]], length[chosen[pick]], len(distinct))
                used, inverse = np.unique(grid, return_inverse=True)
                inverse = inverse.reshape(grid.shape)
                real = used[used < len(distinct)]
                x = _inputs(model, [distinct[k] for k in real])
                inverse = np.where(grid == len(distinct), len(real), inverse)
                _, g, dx = gradients(p, x[inverse], mask, label[pick])
                per_word = np.zeros_like(x)
                np.add.at(per_word, inverse, dx)
                steps += 1
                for k, value_ in p.items():
                    adam(k, value_, g[k])
                gw, gc = np.zeros_like(model["we"]), np.zeros_like(model["ce"])
                np.add.at(gw, row[real], per_word[:-1, :WORD_DIM])
                if len(real):
                    flat, sizes = _trigrams([distinct[k] for k in real])
                    np.add.at(gc, flat, np.repeat(per_word[:-1, WORD_DIM + 1 :] / sizes[:, None], sizes, axis=0))
                adam("we", model["we"], gw)
                adam("ce", model["ce"], gc)
    return model


def score_texts(model: dict, cache: dict, texts: list[bytes]) -> np.ndarray:
    """Scores of whole texts; ``cache`` holds input vectors between calls."""
    if "net" not in model:
        return np.full(len(texts), model["share"])
    if len(cache.setdefault("place", {})) > CACHE:
        cache["place"], cache["x"] = {}, None
    place = cache["place"]
    cut = [words(t) for t in texts]
    held = len(place)
    fresh = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in place]
    place.update(zip(fresh, range(held, held + len(fresh))))
    made = _inputs(model, fresh)
    cache["x"] = made if cache.get("x") is None else np.concatenate([cache["x"][:-1], made])
    sizes = np.array([len(line) for line in cut], np.int64)
    ids = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
    used, ids = np.unique(ids, return_inverse=True)
    x = np.concatenate([cache["x"][used], np.zeros((1, INPUT), np.float32)])
    text, first, length = _spans(sizes)
    logits = _all_logits(model["net"], x, ids, first, length)
    begins = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    return _sigmoid(np.maximum.reduceat(logits, begins).astype(np.float64)) if len(texts) else np.empty(0)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted for every row. One pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, a = [], 0
            while a < len(texts):  # so many texts at once as hold about half a million characters
                b, size = a, 0
                while b < len(texts) and (b == a or size < 500_000):
                    size += len(texts[b])
                    b += 1
                scores.append(score_texts(held.value, cache, texts[a:b]))
                a = b
            value = np.concatenate(scores) if scores else np.empty(0)
            arrays = [batch.column(0), pa.array(value, pa.float64()), pa.array((value >= TOXIC_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes().alias("t")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Train on at most ``rows`` documents of each label."""
    marked = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = stored(sample_by_hash(docs.select("doc_id").join(marked, "doc_id"), "doc_id", rows, per="toxic"))
    sample = docs.join(small(chosen, 32), "doc_id").select("doc_id", text_bytes().alias("t"), "toxic").toPandas()
    sample = sample.sort_values(["doc_id", "t"], kind="stable")
    return train([bytes(t) for t in sample["t"]], sample["toxic"].to_numpy(np.float32))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn labels of rows whose crc32(doc_id) mod 3 is not 1 and score all rows."""
    fold = crc("doc_id") % 3 == 1
    model = learn(docs.where(~fold).select("doc_id", "text"), labels.where(~fold).select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", fold.alias("held_out"), "score", "predicted")
