"""A gated recurrent language model in numpy with a class-factored output softmax.

Words of the shortlist have a class each and are predicted as class, then word;
all other words only as one of the tail classes, whose members share a word
distribution that the caller knows. The input row of a word is its share of
all three gates, so no product is needed for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
CLASS_SIZE = 64
WINDOW = 32
#: Steps of a window whose factors are computed together.
STEPS = 8


@dataclass
class Model:
    """Weights. Inputs: shortlist words, then tail classes. Classes: those of the shortlist, then the tail's."""

    gates: np.ndarray  # (inputs, 3 * hidden): update, reset, candidate
    state: np.ndarray  # (hidden, 3 * hidden)
    classes: np.ndarray  # (hidden, classes)
    class_bias: np.ndarray
    words: np.ndarray  # (shortlist classes, hidden, CLASS_SIZE)
    word_bias: np.ndarray  # (shortlist classes, CLASS_SIZE)

    def parts(self) -> list[np.ndarray]:
        return [self.gates, self.state, self.classes, self.class_bias, self.words, self.word_bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parts()]).astype(np.float32)

    def views(self, flat: np.ndarray) -> list[np.ndarray]:
        """What belongs to each of the parts in an array of all."""
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at : at + p.size].reshape(p.shape))
            at += p.size
        return out

    def unpacked(self, flat: np.ndarray) -> Model:
        return Model(*(p.astype(np.float32) for p in self.views(flat)))


def initial(word_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 1) -> Model:
    """A model that predicts smoothed frequencies whatever came before; training starts there.

    ``word_counts`` are those of the shortlist, a multiple of ``CLASS_SIZE``
    long; words that only fill up a class have count 0 and get no probability.
    """
    rng = np.random.default_rng(seed)
    by_class = word_counts.reshape(-1, CLASS_SIZE).astype(np.float64)
    totals = np.concatenate([by_class.sum(1), tail_counts]) + 0.5
    with np.errstate(divide="ignore"):
        words = np.maximum(np.log(by_class), -60)
    words[by_class.sum(1) == 0] = 0
    inputs, classes = len(word_counts) + len(tail_counts), len(totals)
    return Model(
        rng.normal(0, 0.3, (inputs, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        np.zeros((HIDDEN, classes), np.float32),
        np.log(totals / totals.sum()).astype(np.float32),
        np.zeros((len(by_class), HIDDEN, CLASS_SIZE), np.float32),
        words.astype(np.float32),
    )


def forward(m: Model, x: np.ndarray, fresh: np.ndarray, h: np.ndarray):
    """States after each of the steps x (time, lane), the last ones, and what gradients need of the way there.

    Where ``fresh``, a lane starts from zero. No state is beyond the larger of 1 and the largest of ``h``.
    """
    steps, lanes = x.shape
    # Update, reset and candidate of a step one after the other, (time, 3, lane, hidden).
    zrn = m.gates.reshape(-1, HIDDEN).take(x[:, None].astype(np.intp) * 3 + np.arange(3)[:, None], axis=0)
    by_gate = m.state.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2)
    to_gates, to_new = -by_gate[:2], np.ascontiguousarray(by_gate[2])  # gates are negated for the logistic function
    before, states, un = (np.empty((steps, lanes, HIDDEN), np.float32) for _ in range(3))
    both, one = np.empty((2, lanes, HIDDEN), np.float32), np.empty((lanes, HIDDEN), np.float32)
    starts = fresh.any(1).tolist()
    with np.errstate(over="ignore"):  # a gate of 1 / inf is 0
        for t in range(steps):
            now, new, out = before[t], zrn[t, 2], states[t]
            now[:] = h
            if starts[t]:
                now[fresh[t]] = 0
            gates = zrn[t, :2]
            np.matmul(now, to_gates, out=both)
            np.subtract(both, gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.matmul(now, to_new, out=un[t])
            np.multiply(gates[1], un[t], out=one)
            new += one
            np.tanh(new, out=new)
            np.subtract(now, new, out=out)
            out *= gates[0]
            out += new
            h = out
    return states, h, (before, zrn, un)


def _shift(weights: np.ndarray, bias: np.ndarray, reach: float) -> np.ndarray | None:
    """What may be taken from all logits instead of each row's largest, for states up to ``reach``.

    None if that could overflow or leave a row nothing but zeros.
    """
    spread = reach * np.abs(weights).sum(-2)
    high, low = (bias + spread).max(-1), (bias - spread).max(-1)  # the largest logit of any row is between
    return (high + low) / 2 if (high - low).max(initial=0) < 150 else None


def _with_bias(weights: np.ndarray, bias: np.ndarray, shift: np.ndarray | None) -> np.ndarray:
    """Weights of states with a last column of ones."""
    if shift is not None:
        bias = bias - shift[..., None]
    return np.concatenate([weights, bias[..., None, :]], -2)


class Heads:
    """Weights of both softmax layers, their biases below, for states up to ``reach``."""

    def __init__(self, m: Model, reach: float):
        shift = _shift(m.classes, m.class_bias, reach)
        self.safe_top, self.top = shift is not None, _with_bias(m.classes, m.class_bias, shift)
        shift = _shift(m.words, m.word_bias, reach)
        self.safe_words, self.words = shift is not None, _with_bias(m.words, m.word_bias, shift)


class _Output:
    """Both softmax layers on states in the order of their classes."""

    #: Rows at a time, so that their logits stay near the processor.
    ROWS = 512

    def __init__(self, heads: Heads, h: np.ndarray, cls: np.ndarray, word: np.ndarray, rows: np.ndarray | None = None):
        """``rows``: those that count, all by default."""
        self._heads = heads
        narrow = (cls if rows is None else cls[rows]).astype(np.uint16)
        order = np.argsort(narrow, kind="stable")
        self.cls, self.order = narrow[order], order if rows is None else rows[order]
        self.states = np.ones((len(self.order), HIDDEN + 1), np.float32)
        self.states[:, :HIDDEN] = h.take(self.order, axis=0)
        ends = np.searchsorted(self.cls, np.arange(len(heads.words) + 1, dtype=np.uint16)).tolist()
        #: Shortlist class and its rows, for each that occurs.
        self.groups = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
        self.short = ends[-1]
        # Where the chosen columns are in logits laid flat.
        classes = heads.top.shape[1]
        self._class_at = np.arange(len(self.cls)) % self.ROWS * classes + self.cls
        self._word_at = np.arange(self.short) * CLASS_SIZE + word[self.order[: self.short]]

    def class_logits(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Rows, their logits, and where the chosen ones are in these laid flat."""
        top = self._heads.top
        logits = np.empty((min(self.ROWS, len(self.cls)), top.shape[1]), np.float32)
        for at in range(0, len(self.cls), self.ROWS):
            rows = slice(at, min(at + self.ROWS, len(self.cls)))
            found = np.matmul(self.states[rows], top, out=logits[: rows.stop - at])
            yield rows, _below(found, self._heads.safe_top), self._class_at[rows]

    def word_logits(self) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the rows with a shortlist class, and where the chosen ones are in these laid flat."""
        logits = np.empty((self.short, CLASS_SIZE), np.float32)
        for k, rows in self.groups:
            np.matmul(self.states[rows], self._heads.words[k], out=logits[rows])
        return _below(logits, self._heads.safe_words), self._word_at


def _below(logits: np.ndarray, safe: bool) -> np.ndarray:
    """Logits that the exponential function takes."""
    if not safe:
        logits -= logits.max(1, keepdims=True)
    return logits


def _sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], np.float32)


def _log_at(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at its chosen column."""
    out = logits.reshape(-1)[chosen].astype(np.float64)
    return out - np.log(_sums(np.exp(logits, out=logits)))


def _exp_less(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Turn logits into a multiple of the softmax less 1 at the chosen columns: the loss by the logits.

    Returned is what each row is still to be multiplied by; what comes of the
    products with it is narrower than the logits.
    """
    sums = _sums(np.exp(logits, out=logits))
    logits.reshape(-1)[chosen] -= sums
    return np.reciprocal(sums, out=sums)[:, None]


def log_probs(m: Model, h: np.ndarray, cls: np.ndarray, word: np.ndarray, heads: Heads | None = None) -> np.ndarray:
    """Natural log-probability of the class, and of the word in it for shortlist classes, given states.

    ``heads``: those of the model for such states, if they are at hand.
    """
    top = _Output(heads or Heads(m, float(np.abs(h).max(initial=0))), h, cls, word)
    found = np.empty(len(cls))
    for rows, logits, chosen in top.class_logits():
        found[rows] = _log_at(logits, chosen)
    found[: top.short] += _log_at(*top.word_logits())
    out = np.empty(len(cls))
    out[top.order] = found
    return out


def gradients(m: Model, x, fresh, h, cls, word, used, out: list[np.ndarray] | None = None):
    """Gradients of the mean negative log-probability over one window, and the last states.

    ``out``: zeros in the shapes of the model's parts, to be filled.
    """
    heads = Heads(m, max(1.0, float(np.abs(h).max(initial=0))))
    states, last, (before, zrn, un) = forward(m, x, fresh, h)
    g = [np.zeros_like(p) for p in m.parts()] if out is None else out
    rows = np.flatnonzero(used)
    weight = np.float32(1 / max(1, len(rows)))
    top = _Output(heads, states.reshape(-1, HIDDEN), cls.reshape(-1), word.reshape(-1), rows)
    dh, back = np.empty((len(rows), HIDDEN), np.float32), np.ascontiguousarray(m.classes.T)
    for at, logits, chosen in top.class_logits():
        share = _exp_less(logits, chosen)
        both = (top.states[at] * share).T @ logits
        g[2] += both[:HIDDEN]
        g[3] += both[HIDDEN]
        part = np.matmul(logits, back, out=dh[at])
        part *= share
    logits, chosen = top.word_logits()
    share = _exp_less(logits, chosen)
    scaled, part = top.states[: top.short] * share, np.empty((top.short, HIDDEN), np.float32)
    back = np.ascontiguousarray(m.words.transpose(0, 2, 1))
    for k, at in top.groups:
        d = logits[at]
        both = scaled[at].T @ d
        g[4][k], g[5][k] = both[:HIDDEN], both[HIDDEN]
        np.matmul(d, back[k], out=part[at])
    part *= share
    dh[: top.short] += part
    dh *= weight
    for k in (2, 3, 4, 5):
        g[k] *= weight
    by_state = np.zeros((states.size // HIDDEN, HIDDEN), np.float32)
    by_state[top.order] = dh
    by_state = by_state.reshape(states.shape)
    du, back, starts = np.empty((*x.shape, 3, HIDDEN), np.float32), np.ascontiguousarray(m.state.T), fresh.any(1).tolist()
    carried, kept = np.zeros_like(last), np.empty_like(last)
    for begin in range((len(x) - 1) // STEPS * STEPS, -1, -STEPS):
        now = slice(begin, begin + STEPS)
        z, r, new = zrn[now, 0], zrn[now, 1], zrn[now, 2]
        # What a change of a state is multiplied by for each of the three gates; only the sums go step by step.
        by_new = new * new
        np.subtract(1, by_new, out=by_new)
        keep = 1 - z
        by_new *= keep
        keep *= z
        new -= before[now]
        keep *= new
        reset = by_new * r
        factor = du[now]
        np.negative(keep, out=factor[:, :, 0])
        factor[:, :, 2] = reset
        reset *= un[now]
        np.subtract(1, r, out=r)
        np.multiply(reset, r, out=factor[:, :, 1])
        for t in range(min(begin + STEPS, len(x)) - 1, begin - 1, -1):
            dh = by_state[t]
            dh += carried
            du[t] *= dh[:, None]
            np.matmul(du[t].reshape(-1, 3 * HIDDEN), back, out=carried)
            carried += np.multiply(dh, zrn[t, 0], out=kept)
            if starts[t]:
                carried[fresh[t]] = 0
        g[1] += before[now].reshape(-1, HIDDEN).T @ factor.reshape(-1, 3 * HIDDEN)
        np.multiply(by_state[now], by_new, out=factor[:, :, 2])
    ids = x.reshape(-1)
    if len(m.gates) <= 1 << 16:
        ids = ids.astype(np.uint16)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    _add_runs(g[0], ids[first], du.reshape(-1, 3 * HIDDEN), order, first)
    return g, last


def _add_runs(
    out: np.ndarray, ids: np.ndarray, rows: np.ndarray, order: np.ndarray, first: np.ndarray, short: int = 8
) -> None:
    """Add to ``out`` at each id the sum of its rows, a run in ``order`` that begins at one of ``first``.

    Many short runs and a few long ones: the former are added place by place, each of the latter at once.
    """
    sizes = np.diff(np.append(first, len(order)))
    longest_first = np.argsort(-sizes, kind="stable")
    ids, first, sizes = ids[longest_first], first[longest_first], sizes[longest_first]
    rows = rows.take(order, axis=0)
    sums = rows.take(first, axis=0)
    long = int(np.count_nonzero(sizes > short))
    ones = np.ones(sizes.max(initial=0), np.float32)
    for k, (at, n) in enumerate(zip(first[:long].tolist(), sizes[:long].tolist(), strict=True)):
        np.matmul(ones[:n], rows[at : at + n], out=sums[k])
    for k in range(1, short):
        some = int(np.count_nonzero(sizes > k))
        sums[long:some] += rows.take(first[long:some] + k, axis=0)
    out[ids] += sums


class Trainer:
    """Adam over windows. A step on fewer than ``full`` words is shorter, by the root of their share."""

    #: Weights at a time, so that all that belongs to them stays near the processor.
    PART = 1 << 14

    def __init__(self, model: Model, full: int, rate: float = 0.01):
        self.full, self.rate, self.updates = full, rate, 0
        #: Words learned from.
        self.learned = 0
        # All weights one after the other, which the model's parts are views of.
        self._flat = model.packed()
        self.model = Model(*model.views(self._flat))
        # Both running sums are kept without the factors 1 - b1 and 1 - b2.
        self._sum, self._m, self._v = (np.zeros_like(self._flat) for _ in range(3))
        self._grads = model.views(self._sum)
        cuts = (slice(at, at + self.PART) for at in range(0, len(self._flat), self.PART))
        self._parts = [tuple(a[cut] for a in (self._flat, self._sum, self._m, self._v)) for cut in cuts]

    def _step(self, share: float) -> None:
        self.updates += 1
        size = float(np.sqrt(np.dot(self._sum, self._sum)))
        scale = np.float32(min(1.0, 1.0 / (size + 1e-12)))
        b1, b2 = 0.9, 0.99
        rate = self.rate * min(1.0, share) ** 0.5 * (1 - b2**self.updates) ** 0.5 / (1 - b1**self.updates)
        rate, least = np.float32(rate * (1 - b1) / (1 - b2) ** 0.5), np.float32(1e-8 / (1 - b2) ** 0.5)
        b1, b2 = np.float32(b1), np.float32(b2)
        for p, g, m, v in self._parts:
            if scale < 1:
                g *= scale
            m *= b1
            m += g
            g *= g
            v *= b2
            v += g
            np.sqrt(v, out=g)
            g += least
            np.divide(m, g, out=g)
            g *= rate
            p -= g

    def learn(self, x, fresh, cls, word, used, h) -> np.ndarray:
        """Windows of (time, lane) arrays from the states h on, gradients cut between them; the last states."""
        for at in range(0, len(x), WINDOW):
            cut = slice(at, at + WINDOW)
            n = int(used[cut].sum())
            if not n:
                break
            self._sum.fill(0)
            _, h = gradients(self.model, x[cut], fresh[cut], h, cls[cut], word[cut], used[cut], self._grads)
            self._step(n / self.full)
            self.learned += n
        return h
