"""A gated recurrent language model in numpy with a class-factored softmax.

The model reads one token at a time and predicts the next one's class, then the token within the
class. Frequent words ("head") stand in classes of equal size with a softmax each. All other words
stand in tail classes by their ending and are weighed within them by their counts, one share of
each class being kept for words never seen; so every word has a probability and they add up to 1.

Training is truncated back-propagation through time over lanes of documents; scoring carries the
state across windows, so a document's log-probability is that of the whole text.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np

HEAD_CLASSES, CLASS_WORDS, TAIL_CLASSES = 64, 64, 64
HEAD = HEAD_CLASSES * CLASS_WORDS
CLASSES = HEAD_CLASSES + TAIL_CLASSES
TOKENS = HEAD + TAIL_CLASSES  # ids the model reads: head words, then one per tail class
HIDDEN = 32
WINDOW = 32
LANES = 512
BLOCK = 2048
TRAIN_LANES, TRAIN_WINDOW, STEP, MOST_GRADIENT = 64, 20, 0.05, 0.5


def tail_class(word: bytes) -> int:
    """The tail class of a word, by its last two characters."""
    return zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % TAIL_CLASSES


def class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < HEAD, ids // CLASS_WORDS, ids - HEAD + HEAD_CLASSES)


def start_model(head_counts: np.ndarray, tail_counts: np.ndarray) -> dict[str, np.ndarray]:
    """Parameters before training: no memory, and biases that give the words their frequencies."""
    rng = np.random.default_rng(1)
    words = np.log(np.pad(head_counts, (0, HEAD - len(head_counts))) + 0.5).reshape(HEAD_CLASSES, CLASS_WORDS)
    mass = np.concatenate((np.exp(words).sum(axis=1), tail_counts + 0.5))
    small = lambda *shape: rng.normal(0, 0.08, shape).astype(np.float32)
    return {
        "read": small(TOKENS, 3 * HIDDEN), "keep": small(HIDDEN, 3 * HIDDEN),
        "class_w": small(HIDDEN, CLASSES) * 0.1, "class_b": np.log(mass / mass.sum()).astype(np.float32),
        "word_w": small(HEAD_CLASSES, HIDDEN, CLASS_WORDS) * 0.1, "word_b": words.astype(np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(model: dict, h: np.ndarray, gates: np.ndarray):
    """One update of the state; also what back-propagation needs."""
    past = h @ model["keep"]
    both = _sigmoid(gates[:, : 2 * HIDDEN] + past[:, : 2 * HIDDEN])
    z, r = both[:, :HIDDEN], both[:, HIDDEN:]
    n = np.tanh(gates[:, 2 * HIDDEN :] + r * past[:, 2 * HIDDEN :])
    return n + z * (h - n), (z, r, n, past[:, 2 * HIDDEN :])


def _softmax_loss(logits: np.ndarray, target: np.ndarray, gradient: bool):
    """Log-probability of the targets, and the probabilities less the targets if asked for; the
    logits are overwritten."""
    logits -= logits.max(axis=1, keepdims=True)
    at = np.arange(len(target))
    log_p = logits[at, target]
    e = np.exp(logits, out=logits)
    total = e.sum(axis=1)
    log_p -= np.log(total)
    if not gradient:
        return log_p, None
    e /= total[:, None]
    e[at, target] -= 1
    return log_p, e


def _predict(model: dict, states: np.ndarray, ids: np.ndarray, grads: dict | None = None):
    """Natural log-probability of each id after its state (class, and word for the head); with
    ``grads`` also adds the loss gradients of the output layers and returns that of the states.

    Rows are taken by class in blocks that stay in the cache; each class has a product of its own,
    the softmax is one for all.
    """
    classes = class_of(ids)
    order = np.argsort(classes, kind="stable")
    log_p = np.empty(len(ids), states.dtype)
    back = None if grads is None else np.empty_like(states)
    for start in range(0, len(order), BLOCK):
        rows = order[start : start + BLOCK]
        own, kind = states[rows], classes[rows]
        logits = own @ model["class_w"]
        logits += model["class_b"]
        p, d = _softmax_loss(logits, kind, grads is not None)
        if grads is not None:
            grads["class_w"] += own.T @ d
            grads["class_b"] += d.sum(axis=0)
            behind = d @ model["class_w"].T
        bounds = np.searchsorted(kind, np.arange(HEAD_CLASSES + 1))
        live, head = np.flatnonzero(np.diff(bounds)).tolist(), int(bounds[-1])
        if head:
            logits = model["word_b"][kind[:head]]
            for c in live:
                lo, hi = bounds[c], bounds[c + 1]
                logits[lo:hi] += own[lo:hi] @ model["word_w"][c]
            word, d = _softmax_loss(logits, ids[rows[:head]] % CLASS_WORDS, grads is not None)
            p[:head] += word
            if grads is not None:
                grads["word_b"][live] += np.add.reduceat(d, bounds[live], axis=0)
                for c in live:
                    lo, hi = bounds[c], bounds[c + 1]
                    grads["word_w"][c] += own[lo:hi].T @ d[lo:hi]
                    behind[lo:hi] += d[lo:hi] @ model["word_w"][c].T
        log_p[rows] = p
        if grads is not None:
            back[rows] = behind
    return log_p, back


def lanes(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Documents dealt to at most ``count`` lanes, longest first to the shortest lane."""
    heap = [(0, i) for i in range(min(count, len(lengths)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        load, i = heapq.heappop(heap)
        dealt[i].append(doc)
        heapq.heappush(heap, (load + int(lengths[doc]), i))
    return dealt


def score(model: dict, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document (a non-empty array of ids), over all its tokens."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    lengths = np.array([len(d) for d in docs])
    dealt = lanes(lengths, LANES)
    load = np.array([lengths[own].sum() for own in dealt])
    h = np.zeros((len(dealt), HIDDEN), np.float32)
    place = [0] * len(dealt)  # of each lane: document, and token in it
    inside = [0] * len(dealt)
    for at in range(0, int(load.max()), WINDOW):
        live = np.flatnonzero(load > at)
        steps = int(min(WINDOW, load.max() - at))
        ids = np.full((steps, len(dealt)), -1, np.int64)
        first = np.zeros((steps, len(dealt)), bool)
        owner = np.zeros((steps, len(dealt)), np.int64)
        for lane in live.tolist():
            t = 0
            while t < steps and place[lane] < len(dealt[lane]):
                doc, begin = dealt[lane][place[lane]], inside[lane]
                part = docs[doc][begin : begin + steps - t]
                ids[t : t + len(part), lane], owner[t : t + len(part), lane] = part, doc
                first[t, lane] = begin == 0
                t += len(part)
                inside[lane] += len(part)
                if inside[lane] == lengths[doc]:
                    place[lane], inside[lane] = place[lane] + 1, 0
        before = np.empty((steps, len(live), HIDDEN), np.float32)
        state = h[live]
        gates = model["read"][np.maximum(ids[:, live], 0)]
        for t in range(steps):
            state = np.where(first[t, live][:, None], np.float32(0), state)
            before[t] = state
            state = _step(model, state, gates[t])[0]
        h[live] = state
        real = ids[:, live] >= 0
        log_p, _ = _predict(model, before[real], ids[:, live][real])
        total += np.bincount(owner[:, live][real], log_p, len(docs))
    return total


def train(model: dict, speed: dict, docs: Iterator[np.ndarray]) -> int:
    """Adagrad over the documents, in place; returns the tokens seen.

    Lanes take the next document when theirs ends, the state starts anew with each document and is
    carried across windows, gradients stop at a window's start.
    """
    source = iter(docs)
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * TRAIN_LANES
    inside = [0] * TRAIN_LANES
    h = np.zeros((TRAIN_LANES, HIDDEN), np.float32)
    seen, more = 0, True
    while more:
        ids = np.full((TRAIN_WINDOW, TRAIN_LANES), -1, np.int64)
        first = np.zeros((TRAIN_WINDOW, TRAIN_LANES), bool)
        for lane in range(TRAIN_LANES):
            t = 0
            while t < TRAIN_WINDOW:
                if inside[lane] == len(held[lane]):
                    following = next(source, None)
                    if following is None:
                        break
                    held[lane], inside[lane] = following, 0
                begin = inside[lane]
                part = held[lane][begin : begin + TRAIN_WINDOW - t]
                ids[t : t + len(part), lane] = part
                first[t, lane] = begin == 0
                t += len(part)
                inside[lane] += len(part)
        real = ids >= 0
        tokens = int(real.sum())
        more = tokens > 0
        if more:
            h = _window(model, speed, ids, first, real, h)
            seen += tokens
    return seen


def _window(model, speed, ids, first, real, h):
    safe = np.maximum(ids, 0)
    before = np.empty((*ids.shape, HIDDEN), h.dtype)
    gates = model["read"][safe]
    kind, anew = gates.dtype, first.any(axis=1)
    z, r, n, past_n = (np.empty(before.shape, kind) for _ in range(4))
    for t in range(len(ids)):
        if anew[t]:
            h = np.where(first[t][:, None], np.float32(0), h)
        before[t] = h
        h, (z[t], r[t], n[t], past_n[t]) = _step(model, h, gates[t])
    names = ("keep", "class_w", "class_b", "word_w", "word_b")
    grads = {name: np.zeros_like(model[name]) for name in names}
    _, back = _predict(model, before[real], ids[real], grads)
    from_output = np.zeros(before.shape, kind)
    from_output[real] = back
    by_n = (1 - z) * (1 - n * n)
    by_z = (before - n) * z * (1 - z)
    by_r = past_n * r * (1 - r)
    d_gates, d_past = np.empty_like(gates), np.empty_like(gates)
    dh = np.zeros_like(h)
    keep = np.ascontiguousarray(model["keep"].T)
    for t in range(len(ids) - 1, -1, -1):
        dn = dh * by_n[t]
        own, past = d_gates[t], d_past[t]
        np.multiply(dh, by_z[t], out=own[:, :HIDDEN])
        np.multiply(dn, by_r[t], out=own[:, HIDDEN : 2 * HIDDEN])
        own[:, 2 * HIDDEN :] = dn
        past[:, : 2 * HIDDEN] = own[:, : 2 * HIDDEN]
        np.multiply(dn, r[t], out=past[:, 2 * HIDDEN :])
        dh = dh * z[t]
        dh += past @ keep
        dh += from_output[t]
        if anew[t]:
            dh = np.where(first[t][:, None], np.float32(0), dh)
    grads["keep"] += before.reshape(-1, HIDDEN).T @ d_past.reshape(-1, 3 * HIDDEN)
    used = safe[real]
    order = np.argsort(used, kind="stable")
    rows, begin = np.unique(used[order], return_index=True)
    d_rows = np.add.reduceat(d_gates[real][order], begin, axis=0)
    scale = 1 / real.sum()
    size = scale * np.sqrt(sum(float(np.vdot(g, g)) for g in (*grads.values(), d_rows)))
    scale = np.float32(scale * min(1.0, MOST_GRADIENT / max(size, 1e-12)))
    for name, g in grads.items():
        _adagrad(model[name], speed[name], g, scale)
    own, fast = model["read"][rows], speed["read"][rows]
    _adagrad(own, fast, d_rows, scale)
    model["read"][rows], speed["read"][rows] = own, fast
    return h


def _adagrad(value: np.ndarray, fast: np.ndarray, g: np.ndarray, scale: np.float32) -> None:
    """One step in place along ``g`` times ``scale``; ``g`` is overwritten."""
    g *= scale
    root = g * g
    fast += root
    np.sqrt(np.add(fast, np.float32(1e-8), out=root), out=root)
    g *= np.float32(STEP)
    g /= root
    value -= g


def fresh_speed(model: dict) -> dict[str, np.ndarray]:
    return {name: np.full_like(value, 1e-6) for name, value in model.items()}
