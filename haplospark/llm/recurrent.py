"""A gated recurrent language model in numpy, with an output softmax factored by class.

Word k < classes * WIDTH belongs to class k // WIDTH; every id above is a class by itself.
The probability of a token is that of its class, times, for a word, its probability within
the class: two small softmaxes instead of one over the vocabulary. Every text starts with a
state of zeros and the end token as input, and its state is carried on to its last token.

The state is that of a gated recurrent unit whose gates and candidates squash by
x / (1 + |x|), which costs a fraction of the hyperbolic tangent and has the same shape.

Training is by truncated backpropagation: texts are laid out one after the other in lanes,
gradients go back to the start of a window, states go on into the next one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN = 16
EMBEDDED = 12
WIDTH = 32
#: Lanes and steps of a training window; lanes and steps of a scoring window, and steps laid
#: out at a time.
TRAIN_LANES, TRAIN_STEPS = 512, 12
SCORE_LANES, SCORE_STEPS, SCORE_BLOCK = 512, 16, 256
RATE, DECAY = 0.02, (0.9, 0.99)
#: Bound of output weights; states stay within one, so powers of logits cannot overflow.
MOST_WEIGHT = 3.0


class Model:
    """Parameters in one flat vector, seen as arrays."""

    def __init__(self, classes: int, alone: int, vector: np.ndarray | None = None, hidden: int = HIDDEN):
        self.classes, self.alone, self.hidden = classes, alone, hidden
        self.words = classes * WIDTH
        h, outputs = hidden, classes + alone
        self.shapes = {
            "embedding": (self.words + alone, EMBEDDED),
            "inputs": (EMBEDDED, 3 * h),
            "input_bias": (3 * h,),
            "recurrent": (h, 3 * h),
            "candidate": (h,),
            "class_weight": (h, outputs),
            "class_bias": (outputs,),
            "word_weight": (classes, h, WIDTH),
            "word_bias": (classes, WIDTH),
        }
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        self.vector = np.zeros(size, np.float32) if vector is None else vector
        at = 0
        for name, shape in self.shapes.items():
            count = int(np.prod(shape))
            setattr(self, name, self.vector[at : at + count].reshape(shape))
            at += count

    @classmethod
    def start(cls, counts: np.ndarray, classes: int, seed: int = 7) -> Model:
        """Small random weights, and biases that give the tokens' shares in ``counts``."""
        model = cls(classes, len(counts) - classes * WIDTH)
        draw = np.random.default_rng(seed)
        for name in ("embedding", "inputs", "recurrent", "class_weight", "word_weight"):
            array = getattr(model, name)
            array[...] = draw.normal(0, 0.3, array.shape)
        counts = counts.astype(np.float64)
        words = counts[: model.words].reshape(classes, WIDTH) + 1e-6
        totals = np.concatenate([words.sum(1), counts[model.words :] + 1e-3])
        model.class_bias[...] = np.log(totals / totals.sum())
        model.word_bias[...] = np.log(words / words.sum(1, keepdims=True))
        return model

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // WIDTH, ids - self.words + self.classes)

    def driven(self) -> np.ndarray:
        """What each id as input adds to gates and candidate."""
        return self.embedding @ self.inputs + self.input_bias

    def step(self, state: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, and what backpropagation needs of this one; x: rows of ``driven``."""
        h, a = self.hidden, state @ self.recurrent
        gates = _squash(x[:, : 2 * h] + a[:, : 2 * h])
        gates += 1
        gates *= 0.5
        reset, keep = gates[:, :h], gates[:, h:]
        inner = a[:, 2 * h :] + self.candidate
        fresh = _squash(x[:, 2 * h :] + reset * inner)
        return fresh + keep * (state - fresh), reset, keep, inner, fresh

    def by_class(self, classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each class of several words, with the positions of its tokens."""
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(self.classes + 1))
        for c in range(self.classes):
            if edges[c] < edges[c + 1]:
                yield c, order[edges[c] : edges[c + 1]]

    def log_probabilities(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each id after each state."""
        classes, rows = self.class_of(ids), np.arange(len(ids))
        powers = _powers(states, self.class_weight, self.class_bias)
        shares = powers[rows, classes] / _row_sums(powers)
        for c, at in self.by_class(classes):
            powers = _powers(states.take(at, axis=0), self.word_weight[c], self.word_bias[c])
            shares[at] *= powers[rows[: len(at)], ids[at] % WIDTH] / _row_sums(powers)
        return np.log(shares)


def _squash(x: np.ndarray) -> np.ndarray:
    below = np.abs(x)
    below += 1
    np.divide(x, below, out=x)
    return x


def _powers(states: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    logits = states @ weight
    logits += bias
    return np.exp(logits, out=logits)


def _row_sums(powers: np.ndarray) -> np.ndarray:
    return powers @ np.ones(powers.shape[1], powers.dtype)


def _softmax(states: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    powers = _powers(states, weight, bias)
    powers /= _row_sums(powers)[:, None]
    return powers


def window_gradient(
    model: Model, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray, fresh_start: np.ndarray
) -> tuple[np.ndarray, Model]:
    """The state after a window (steps x lanes), and the gradient of its mean loss.

    Where ``fresh_start`` is set, a text begins: the state is zero and nothing flows back.
    """
    steps, lanes, h = *inputs.shape, model.hidden
    kept, befores, afters, driven = [], [], [], model.driven()
    for t in range(steps):
        state = state * ~fresh_start[t][:, None]
        befores.append(state)
        state, *rest = model.step(state, driven.take(inputs[t], axis=0))
        afters.append(state)
        kept.append(rest)
    gradient = Model(model.classes, model.alone, np.zeros_like(model.vector), h)
    states, ids = np.concatenate(afters), targets.reshape(-1)
    classes, rows = model.class_of(ids), np.arange(len(ids))
    scale = np.float32(1 / len(ids))
    error = _softmax(states, model.class_weight, model.class_bias)
    error[rows, classes] -= 1
    error *= scale
    gradient.class_weight[...] = states.T @ error
    gradient.class_bias[...] = error.sum(0)
    back = error @ model.class_weight.T
    for c, at in model.by_class(classes):
        some = states.take(at, axis=0)
        error = _softmax(some, model.word_weight[c], model.word_bias[c])
        error[rows[: len(at)], ids[at] % WIDTH] -= 1
        error *= scale
        gradient.word_weight[c] = some.T @ error
        gradient.word_bias[c] = error.sum(0)
        back[at] += error @ model.word_weight[c].T
    back = back.reshape(steps, lanes, h)
    to_inputs = np.empty((steps, lanes, 3 * h), back.dtype)
    to_recurrent = np.empty((steps, lanes, 3 * h), back.dtype)
    flowing = np.zeros((lanes, h), back.dtype)
    for t in range(steps - 1, -1, -1):
        reset, keep, inner, fresh = kept[t]
        error = back[t] + flowing
        candidate = error * (1 - keep)
        slope = 1 - np.abs(fresh)
        candidate *= slope
        candidate *= slope
        gates = to_inputs[t, :, : 2 * h]
        np.multiply(candidate, inner, out=gates[:, :h])
        np.multiply(error, befores[t] - fresh, out=gates[:, h:])
        # a gate g = (s + 1) / 2 has the slope (1 - |s|)^2 / 2
        for part, gate in ((gates[:, :h], reset), (gates[:, h:], keep)):
            slope = 1 - np.abs(2 * gate - 1)
            part *= slope
            part *= slope
            part *= 0.5
        to_inputs[t, :, 2 * h :] = candidate
        to_recurrent[t, :, : 2 * h] = gates
        np.multiply(candidate, reset, out=to_recurrent[t, :, 2 * h :])
        flowing = error * keep + to_recurrent[t] @ model.recurrent.T
        flowing *= ~fresh_start[t][:, None]
    flat = to_recurrent.reshape(-1, 3 * h)
    gradient.recurrent[...] = np.concatenate(befores).T @ flat
    gradient.candidate[...] = flat[:, 2 * h :].sum(0)
    ids, flat = inputs.reshape(-1), to_inputs.reshape(-1, 3 * h)
    order = np.argsort(ids.astype(np.int32), kind="stable")
    starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
    used = ids[order][starts]
    gradient.inputs[...] = model.embedding.take(ids, axis=0).T @ flat
    gradient.input_bias[...] = flat.sum(0)
    embedded = (flat @ model.inputs.T).take(order, axis=0)
    gradient.embedding[used] = np.add.reduceat(embedded, starts)
    return state, gradient


class Trainer:
    """Takes texts as they come, and trains on every full set of lanes."""

    def __init__(self, model: Model, end: int, lanes: int = TRAIN_LANES, steps: int = TRAIN_STEPS):
        self.model, self.end, self.lanes, self.steps = model, end, lanes, steps
        self.first = np.zeros_like(model.vector)
        self.second = np.zeros_like(model.vector)
        self.updates = self.tokens = 0
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: np.ndarray) -> None:
        """One text, its end token included."""
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.lanes * self.steps * 16:
            self.flush()

    def flush(self) -> None:
        """Train on what is held, in up to ``lanes`` lanes of equal length."""
        if not self.size:
            return
        stream = np.concatenate(self.held).astype(np.int64)
        lengths = np.array([len(t) for t in self.held])
        begins = np.zeros(len(stream), bool)
        begins[np.cumsum(lengths)[:-1]] = True
        begins[0] = True
        before = np.concatenate([[self.end], stream[:-1]])
        before[begins] = self.end
        lanes = max(1, min(self.lanes, len(stream) // self.steps))
        long = -(-len(stream) // lanes)
        pad = lanes * long - len(stream)
        if pad:  # the last lane goes on with the stream's own beginning
            again = np.arange(pad) % len(stream)
            stream, before, begins = (np.concatenate([x, x[again]]) for x in (stream, before, begins))
        targets, inputs, fresh = (x.reshape(lanes, long).T for x in (stream, before, begins))
        fresh = fresh.copy()
        fresh[0] = True
        state = np.zeros((lanes, self.model.hidden), np.float32)
        for at in range(0, long, self.steps):
            window = slice(at, at + self.steps)
            state, gradient = window_gradient(self.model, state, inputs[window], targets[window], fresh[window])
            self.update(gradient.vector)
        self.tokens += int(lengths.sum())
        self.held, self.size = [], 0

    def update(self, gradient: np.ndarray) -> None:
        """A step of Adam."""
        self.updates += 1
        norm = float(np.sqrt(gradient @ gradient))
        if norm > 1:
            gradient = gradient / np.float32(norm)
        a, b = DECAY
        self.first += (1 - a) * (gradient - self.first)
        self.second += (1 - b) * (gradient * gradient - self.second)
        size = RATE * np.sqrt(1 - b**self.updates) / (1 - a**self.updates)
        self.model.vector -= np.float32(size) * self.first / (np.sqrt(self.second) + np.float32(1e-6))
        for weights in (self.model.class_weight, self.model.word_weight):
            np.clip(weights, -MOST_WEIGHT, MOST_WEIGHT, out=weights)


def score_texts(
    model: Model, texts: list[np.ndarray], end: int, lanes: int = SCORE_LANES, steps: int = SCORE_STEPS
) -> np.ndarray:
    """Natural log probability of each text (its end token included), from first to last.

    Whole texts are dealt to lanes, the longest first, each to the lane that is least full.
    Lanes are ordered by length, so those still running are the first ones.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    totals = np.zeros(len(texts))
    if not len(texts):
        return totals
    lanes = min(lanes, len(texts))
    heap, dealt = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    for text in np.argsort(-sizes, kind="stable").tolist():
        full, k = heap[0]
        dealt[k].append(text)
        heapq.heapreplace(heap, (full + int(sizes[text]), k))
    dealt.sort(key=lambda some: -sum(int(sizes[t]) for t in some))
    lengths = np.array([sum(int(sizes[t]) for t in some) for some in dealt])
    longest = int(lengths[0])
    streams = [np.concatenate([texts[t] for t in some]).astype(np.int32) for some in dealt]
    owners = [np.repeat(np.array(some, np.int32), sizes[some]) for some in dealt]
    driven, carried = model.driven(), np.zeros((lanes, model.hidden), np.float32)
    for block in range(0, longest, SCORE_BLOCK):
        running = int(np.searchsorted(-lengths, -block, "left"))
        width = min(SCORE_BLOCK, longest - block)
        # one step more in front: the token before, and whose it is
        ids = np.full((width + 1, running), end, np.int32)
        owner = np.full((width + 1, running), -1, np.int32)
        for k in range(running):
            begin, stop = max(block - 1, 0), min(block + width, int(lengths[k]))
            at = begin - block + 1
            ids[at : at + stop - begin, k] = streams[k][begin:stop]
            owner[at : at + stop - begin, k] = owners[k][begin:stop]
        first = owner[1:] != owner[:-1]
        before = np.where(first, end, ids[:-1])
        stay = (~first).astype(np.float32)[:, :, None]
        real = owner[1:] >= 0
        for at in range(0, width, steps):
            stop = min(at + steps, width)
            active = int(np.searchsorted(-lengths, -(block + at), "left"))
            state, states = carried[:active], []
            for t in range(at, stop):
                state = model.step(state * stay[t, :active], driven.take(before[t, :active], axis=0))[0]
                states.append(state)
            carried[:active] = state
            some = real[at:stop, :active].reshape(-1)
            whose = owner[at + 1 : stop + 1, :active].reshape(-1)[some]
            said = ids[at + 1 : stop + 1, :active].reshape(-1)[some]
            found = model.log_probabilities(np.concatenate(states)[some], said)
            totals += np.bincount(whose, found, minlength=len(texts))
    return totals
