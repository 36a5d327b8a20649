"""A small gated recurrent language model over word classes, in numpy.

At each step the state has read all earlier classes; a softmax over classes gives the probability of
the next one. Sequences run side by side, longest first, so those still running are a prefix of the
batch. Windows of ``span`` steps bound the memory: scoring carries the state over from one window to
the next, so a sequence's probability is the one of the whole sequence, and training cuts the
gradient, not the state, at the window's beginning. There are at most 256 classes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Parameters = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of ``x``."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def initial(classes: int, hidden: int, log_share: np.ndarray, seed: int = 7) -> Parameters:
    """Random weights; the output bias starts at the classes' log shares of the corpus."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
    return {
        "embed": draw(classes, 3 * hidden),
        "state": draw(hidden, 3 * hidden),
        "bias": np.zeros(3 * hidden, np.float32),
        "out": draw(hidden, classes) * np.float32(0.1),
        "out_bias": log_share.astype(np.float32),
    }


def flat(params: Parameters) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)]).astype(np.float64)


def unflat(values: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = np.asarray(values[at : at + size], np.float32).reshape(like[k].shape)
        at += size
    return out


def _batches(sequences: Sequence[np.ndarray], batch: int):
    """Index lists of similar length, longest first."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    for a in range(0, len(order), batch):
        yield order[a : a + batch]


def _windows(sequences: list[np.ndarray], span: int):
    """``inputs, targets, active`` (steps x batch, and sequences running at each step).

    The first class of a sequence is only read; each later one is a target.
    """
    lengths = np.array([len(s) - 1 for s in sequences])
    for begin in range(0, int(lengths[0]) if len(lengths) else 0, span):
        steps = min(span, int(lengths[0]) - begin)
        running = int((lengths > begin).sum())
        read = np.zeros((running, steps + 1), np.uint8)
        for row, sequence in zip(read, sequences):
            part = sequence[begin : begin + steps + 1]
            row[: len(part)] = part
        active = (lengths[:running, None] > begin + np.arange(steps)).sum(axis=0).tolist()
        # A step's classes lie side by side.
        steps_first = np.ascontiguousarray(read.T).astype(np.intp)
        yield steps_first[:-1], steps_first[1:], active


def _by_gate(matrix: np.ndarray) -> np.ndarray:
    """The three parts of the columns one after the other, so that each lies in one piece of memory."""
    return np.ascontiguousarray(matrix.reshape(len(matrix), 3, -1).transpose(1, 0, 2))


def _tables(params: Parameters) -> tuple[np.ndarray, np.ndarray]:
    """By gate: what each class adds, and the matrix of the state."""
    return _by_gate(params["embed"] + params["bias"]), _by_gate(params["state"])


def _step(tables: tuple[np.ndarray, np.ndarray], read: np.ndarray, before: np.ndarray):
    """The next state from the classes read and the state before, and the gates on the way."""
    mixed, from_state = tables[0].take(read, axis=1), before @ tables[1]
    gates = mixed[:2]
    gates += from_state[:2]
    z, r = _sigmoid(gates)
    inner, new = from_state[2], mixed[2]
    new += r * inner
    np.tanh(new, out=new)
    after = before - new
    after *= z
    after += new
    return after, z, r, inner, new


def _exp_logits(params: Parameters, states: np.ndarray, least: bool) -> tuple[np.ndarray, np.ndarray]:
    """Logits, and their exponentials; shifted to a maximum of 0 unless all are known to be small."""
    logits = states @ params["out"]
    logits += params["out_bias"]
    if not least:
        logits -= logits.max(axis=1, keepdims=True)
    return logits, np.exp(logits)


def _small_logits(params: Parameters) -> bool:
    """Whether no state, whose entries lie between -1 and 1, can give a logit beyond 60."""
    return bool((np.abs(params["out"]).sum(axis=0) + np.abs(params["out_bias"])).max() < 60)


def log10_probability(
    params: Parameters, sequences: Sequence[np.ndarray], start: int, span: int = 64, batch: int = 512
) -> np.ndarray:
    """log10 of each whole sequence's probability; a sequence is read after the class ``start``.

    The softmax is taken over runs of steps with about ``batch`` states: few enough for the
    processor's cache, and not one by one where a long sequence runs alone.
    """
    out = np.zeros(len(sequences))
    hidden = params["state"].shape[0]
    tables, small = _tables(params), _small_logits(params)
    for rows in _batches(sequences, batch):
        chosen = [np.append(start, sequences[i]) for i in rows]
        h = np.zeros((len(rows), hidden), tables[1].dtype)
        total = np.zeros(len(rows))
        for inputs, targets, active in _windows(chosen, span):
            states, wanted = [], []
            for t, n in enumerate(active):
                h = _step(tables, inputs[t, :n], h[:n])[0]
                states.append(h)
                wanted.append(targets[t, :n])
                if len(states) * n >= batch or t == len(active) - 1:
                    logits, shares = _exp_logits(params, np.concatenate(states), small)
                    found = logits[np.arange(len(logits)), np.concatenate(wanted)]
                    found = found - np.log(shares.sum(axis=1))
                    at = 0
                    for part in states:
                        total[: len(part)] += found[at : at + len(part)]
                        at += len(part)
                    states, wanted = [], []
        out[rows] = total / np.log(10)
    return out


class Trainer:
    """Truncated backpropagation with adaptive steps; moments and step size carry over from call to call.

    Every class of a sequence is a target once. A sequence longer than ``segment`` is read as several
    side by side, each after the class before it; so a few long ones do not run alone.
    """

    def __init__(
        self,
        params: Parameters,
        start: int,
        span: int = 32,
        batch: int = 256,
        rate: float = 0.015,
        segment: int = 1024,
    ):
        self.params = {k: v.copy() for k, v in params.items()}
        self.moment = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}
        self.start, self.span, self.batch, self.rate, self.segment = start, span, batch, rate, segment
        self.updates = self.tokens = 0
        self._order = np.random.default_rng(11)

    def read(self, sequences: Sequence[np.ndarray]) -> None:
        """One pass over ``sequences``, the state carried from window to window of a segment."""
        # A segment begins with the class it is read after.
        parts = [
            np.append(s[at - 1] if at else self.start, s[at : at + self.segment])
            for s in sequences
            for at in range(0, len(s), self.segment)
        ]
        batches = list(_batches(parts, self.batch))
        for at in self._order.permutation(len(batches)):
            chosen = [parts[i] for i in batches[at]]
            h = np.zeros((len(chosen), self.params["state"].shape[0]), np.float32)
            for inputs, targets, active in _windows(chosen, self.span):
                self._update(self._gradients(inputs, targets, active, h))
                self.tokens += sum(active)

    def _gradients(self, inputs, targets, active: list[int], h: np.ndarray) -> Parameters:
        """Of the mean loss of one window; ``h`` is the state before it, and then after it."""
        params, hidden, count = self.params, h.shape[1], np.float32(sum(active))
        tables, small = _tables(params), _small_logits(params)
        places = np.arange(inputs.shape[1])
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        kept, to_state = [], []
        after = h.copy()
        for t, n in enumerate(active):
            before = after[:n]
            after, *gates = _step(tables, inputs[t, :n], before)
            kept.append((before, *gates))
            _, slope = _exp_logits(params, after, small)
            slope /= slope.sum(axis=1, keepdims=True)
            slope[places[:n], targets[t, :n]] -= 1
            slope /= count
            grads["out"] += after.T @ slope
            grads["out_bias"] += slope.sum(axis=0)
            to_state.append(slope @ params["out"].T)
        h[: len(after)] = after  # sequences that ended before are not read again
        back = np.zeros((inputs.shape[1], hidden), np.float32)
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            before, z, r, inner, new = kept[t]
            dh = back[:n]
            dh += to_state[t]
            # Factors stay in one piece; only the results go to the columns of their gate.
            d_gates = np.empty((n, 3 * hidden), np.float32)
            rest = 1 - z
            d_z = before - new
            d_z *= dh
            d_z *= z
            np.multiply(d_z, rest, out=d_gates[:, :hidden])
            d_new = rest
            d_new *= dh
            d_new *= 1 - new * new
            d_r = d_new * inner
            d_r *= r
            np.multiply(d_r, 1 - r, out=d_gates[:, hidden : 2 * hidden])
            d_gates[:, 2 * hidden :] = d_new
            order = np.argsort(inputs[t, :n].astype(np.uint8), kind="stable")
            read = inputs[t].take(order)
            begins = np.ones(n, bool)
            np.not_equal(read[1:], read[:-1], out=begins[1:])
            first = np.flatnonzero(begins)
            grads["embed"][read[first]] += np.add.reduceat(d_gates.take(order, axis=0), first, axis=0)
            np.multiply(d_new, r, out=d_gates[:, 2 * hidden :])
            grads["state"] += before.T @ d_gates
            dh *= z
            dh += d_gates @ params["state"].T
        grads["bias"] = grads["embed"].sum(axis=0)
        return grads

    def _update(self, grads: Parameters) -> None:
        self.updates += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        step = np.float32(self.rate / (1 + self.updates / 400))
        for k, g in grads.items():
            g = g * shrink
            self.moment[k] += np.float32(0.1) * (g - self.moment[k])
            self.square[k] += np.float32(0.01) * (g * g - self.square[k])
            self.params[k] -= step * (self.moment[k] / np.float32(1 - 0.9**self.updates)) / (
                np.sqrt(self.square[k] / np.float32(1 - 0.99**self.updates)) + np.float32(1e-6)
            )
