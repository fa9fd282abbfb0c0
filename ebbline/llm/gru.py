"""A gated recurrent language model in numpy, with a class-factored output softmax.

Symbols are numbers; their classes are runs of ``members`` numbers, so a symbol's probability is that
of its class times its own among the members. Sequences run in lanes side by side. Training cuts one
long stream into lanes and backpropagates through windows of a few steps; scoring gives every document
a lane to itself from start to end, and the state goes on from window to window, so the whole
document is scored however long it is.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class GruOptions:
    hidden: int = 16
    members: int = 32
    # Steps that are backpropagated through, and steps scored at once; the latter changes no result.
    window: int = 16
    scored_window: int = 64
    # Lanes trained in, of which fewer make more updates, and lanes scored in; the latter changes no result.
    lanes: int = 512
    scored_lanes: int = 1024
    rate: float = 0.2
    seed: int = 7
    # Gradients are scaled down to this norm.
    clip: float = 5.0


def initial(counts: np.ndarray, options: GruOptions) -> Weights:
    """Weights that give every symbol its share of ``counts`` until they are trained."""
    symbols, hidden, members = len(counts), options.hidden, options.members
    classes = -(-symbols // members)
    rng = np.random.default_rng(options.seed)
    shares = np.full(classes * members, 1e-30)
    shares[:symbols] = (counts + 1.0) / (counts + 1.0).sum()
    shares = shares.reshape(classes, members)
    of_class = shares.sum(1)
    scale = 1 / np.sqrt(hidden)
    weights = {
        "input": rng.normal(0, scale, (symbols, 3 * hidden)),
        "recurrent": rng.normal(0, scale, (hidden, 3 * hidden)),
        "class": np.zeros((hidden, classes)),
        "class_bias": np.log(of_class),
        "member": np.zeros((classes, hidden, members)),
        "member_bias": np.log(shares / of_class[:, None]),
    }
    return {name: value.astype(np.float32) for name, value in weights.items()}


def pack(weights: Weights) -> bytes:
    return b"".join(weights[name].astype(np.float32).tobytes() for name in sorted(weights))


def unpack(data: bytes, like: Weights) -> Weights:
    flat, at, out = np.frombuffer(data, np.float32), 0, {}
    for name in sorted(like):
        out[name] = flat[at : at + like[name].size].reshape(like[name].shape).copy()
        at += like[name].size
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of ``x``. Exponentials that overflow give 0, which is right."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place of ``x``; by the exponential, which numpy has in vector instructions."""
    x *= 2
    _sigmoid(x)
    x *= 2
    x -= 1
    return x


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of ``x``, in its place, and their sums by row.

    Sums are products with ones, which is several times faster than a reduction over short rows.
    """
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype)


def _logits(states: np.ndarray, to: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits in a range that exponentials bear; rows are shifted only if they have to be."""
    x = states @ to
    x += bias
    # States are within 1, so that logits are within the sums of the weights.
    if (np.abs(to).sum(0) + np.abs(bias)).max() > 59 and x.size and (x.max() > 60 or x.min() < -85):
        x -= x.max(-1, keepdims=True)
    return x


def steps(
    weights: Weights, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray, traced: bool = True
) -> tuple[np.ndarray, list]:
    """States after each step of (time, lane) inputs; ``keep`` is 0 where a document starts.

    ``traced`` also returns what backpropagation needs of each step. Within a step lanes are the last axis, so that
    each gate is contiguous.
    """
    hidden, trace = state.shape[1], []
    recurrent = np.ascontiguousarray(weights["recurrent"].T)
    states = np.empty((*inputs.shape, hidden), np.float32)
    state = np.ascontiguousarray(state.T)
    for t, symbols in enumerate(inputs):
        state = state * keep[t]
        given, own = np.ascontiguousarray(weights["input"].take(symbols, axis=0).T), recurrent @ state
        with np.errstate(over="ignore"):
            given[: 2 * hidden] += own[: 2 * hidden]
            gates = _sigmoid(given[: 2 * hidden])
            update, reset = gates[:hidden], gates[hidden:]
            fresh = reset * own[2 * hidden :]
            fresh += given[2 * hidden :]
            _tanh(fresh)
        if traced:
            trace.append((state, own[2 * hidden :], update, reset, fresh))
        state = state - fresh
        state *= update
        state += fresh
        states[t] = state.T
    return states, trace


def _by_class(targets: np.ndarray, members: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order in which targets of a class are neighbours, and where each class is in it."""
    order, found, starts = _sorted_runs(targets // members)
    ends = [*starts[1:].tolist(), len(targets)]
    return order, [(group, slice(start, end)) for group, start, end in zip(found.tolist(), starts.tolist(), ends)]


def _sorted_runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order of small numbers, the distinct ones and where each starts in it."""
    if numbers.size and numbers.max() < 1 << 15:
        numbers = numbers.astype(np.int16)  # numpy sorts these by radix, in linear time
    order = np.argsort(numbers, kind="stable")
    found, starts = np.unique(numbers[order], return_index=True)
    return order, found, starts


def _log_shares(x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row of logits at its wanted place; ``x`` is used up."""
    chosen = x[np.arange(len(x)), wanted]
    return chosen - np.log(_exponentials(x)[1])


def log_likelihoods(weights: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target after its state; both flat over time and lanes."""
    members = weights["member_bias"].shape[1]
    order, groups = _by_class(targets, members)
    states, targets = states.take(order, axis=0), targets.take(order)
    found = _log_shares(_logits(states, weights["class"], weights["class_bias"]), targets // members)
    for group, rows in groups:
        own = _logits(states[rows], weights["member"][group], weights["member_bias"][group])
        found[rows] += _log_shares(own, targets[rows] % members)
    result = np.empty_like(found)
    result[order] = found
    return result


def _softmax_part(
    states: np.ndarray, to: np.ndarray, bias: np.ndarray, wanted: np.ndarray, weight: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Loss of one softmax, and its gradients by matrix, bias and states."""
    x, index = _logits(states, to, bias), np.arange(len(wanted))
    chosen = x[index, wanted]
    error, sums = _exponentials(x)
    loss = float(((np.log(sums) - chosen) * weight).sum())
    error *= (weight / sums)[:, None]
    error[index, wanted] -= weight
    return loss, states.T @ error, np.ones(len(error), error.dtype) @ error, error @ to.T


def gradients(
    weights: Weights, inputs: np.ndarray, targets: np.ndarray, keep: np.ndarray, used: np.ndarray, state: np.ndarray
) -> tuple[float, Weights, np.ndarray]:
    """Loss summed over the used targets, its gradients, and the state after the window."""
    time, lanes = inputs.shape
    hidden, members = state.shape[1], weights["member_bias"].shape[1]
    states, trace = steps(weights, inputs, keep, state)
    grads = {name: np.zeros_like(value) for name, value in weights.items()}
    # The softmaxes work on rows in order of the targets' classes, so that a class is one slice.
    order, groups = _by_class(targets.reshape(-1), members)
    flat, wanted = states.reshape(-1, hidden).take(order, axis=0), targets.reshape(-1)[order]
    weight = used.reshape(-1)[order]
    loss, grads["class"], grads["class_bias"], back = _softmax_part(
        flat, weights["class"], weights["class_bias"], wanted // members, weight
    )
    for group, rows in groups:
        to, bias = weights["member"][group], weights["member_bias"][group]
        more, grads["member"][group], grads["member_bias"][group], own = _softmax_part(
            flat[rows], to, bias, wanted[rows] % members, weight[rows]
        )
        loss += more
        back[rows] += own
    in_time = np.empty_like(back)
    in_time[order] = back
    in_time = np.ascontiguousarray(in_time.reshape(time, lanes, hidden).transpose(0, 2, 1))
    carried = np.zeros((hidden, lanes), back.dtype)
    # Gradients by the sums that enter the gates: update, reset, fresh. Lanes are the last axis, as in the trace.
    to_input, parts = np.empty((time, lanes, 3 * hidden), back.dtype), np.empty((3 * hidden, lanes), back.dtype)
    d_update, d_reset, d_fresh = (parts[k * hidden : (k + 1) * hidden] for k in range(3))
    for t in range(time - 1, -1, -1):
        before, own, update, reset, fresh = trace[t]
        down = in_time[t] + carried
        np.multiply(down * (1 - update), 1 - fresh * fresh, out=d_fresh)
        np.multiply(down * (before - fresh), update * (1 - update), out=d_update)
        np.multiply(d_fresh * own, reset * (1 - reset), out=d_reset)
        to_input[t] = parts.T
        d_fresh *= reset
        grads["recurrent"] += before @ parts.T
        carried = (down * update + weights["recurrent"] @ parts) * keep[t]
    # Rows of equal symbols are added up after sorting.
    order, found, starts = _sorted_runs(inputs.reshape(-1))
    grads["input"][found] = np.add.reduceat(to_input.reshape(-1, 3 * hidden).take(order, axis=0), starts, axis=0)
    return loss, grads, states[-1]


class Trainer:
    """Adagrad over windows of one stream of documents after another."""

    def __init__(self, weights: Weights, start: int, options: GruOptions):
        self.weights = {name: value.copy() for name, value in weights.items()}
        self.squares = {name: np.full_like(value, 1e-3) for name, value in weights.items()}
        self.start, self.options, self.tokens, self.loss = start, options, 0, 0.0

    def learn(self, documents: list[np.ndarray]) -> None:
        """Documents as symbols, the last one the end. ``start`` is what precedes the first symbol."""
        if not documents:
            return
        targets = np.concatenate(documents)
        inputs = np.concatenate([[self.start], targets[:-1]])
        keep = np.ones(len(targets), np.float32)
        firsts = np.cumsum([0] + [len(d) for d in documents[:-1]])
        inputs[firsts], keep[firsts] = self.start, 0
        window = self.options.window
        lanes = max(1, min(self.options.lanes, max(16, len(targets) // (64 * window)), len(targets)))
        length = -(-len(targets) // lanes)
        used = np.ones(len(targets), np.float32)
        laid = [np.pad(a, (0, lanes * length - len(a))).reshape(lanes, length).T for a in (inputs, targets, keep, used)]
        laid[2][0] = 0
        state = np.zeros((lanes, self.options.hidden), np.float32)
        for at in range(0, length, window):
            x, y, k, u = (a[at : at + window] for a in laid)
            loss, grads, state = gradients(self.weights, x, y, k, u, state)
            self.update(grads, max(1.0, float(u.sum())))
            self.loss += loss
        self.tokens += len(targets)

    def update(self, grads: Weights, tokens: float) -> None:
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / tokens
        scale = min(1.0, self.options.clip / max(norm, 1e-12)) / tokens
        for name, grad in grads.items():
            grad *= scale
            self.squares[name] += grad * grad
            self.weights[name] -= self.options.rate * grad / np.sqrt(self.squares[name])


def score(weights: Weights, documents: list[np.ndarray], start: int, options: GruOptions) -> np.ndarray:
    """Natural log likelihood of each whole document."""
    sums = np.zeros(len(documents))
    if not documents:
        return sums
    lanes = min(options.scored_lanes, len(documents))
    loads = [(0, lane) for lane in range(lanes)]
    queues: list[list[int]] = [[] for _ in range(lanes)]
    for number in sorted(range(len(documents)), key=lambda n: -len(documents[n])):
        load, lane = heapq.heappop(loads)
        queues[lane].append(number)
        heapq.heappush(loads, (load + len(documents[number]), lane))
    queues.sort(key=lambda q: -sum(len(documents[n]) for n in q))
    # The lanes end to end, so that a long document does not make the others' lanes longer.
    order = [number for queue in queues for number in queue]
    sizes = np.array([len(documents[number]) for number in order])
    symbols = np.concatenate([documents[number] for number in order])
    owner = np.repeat(np.array(order), sizes)
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(sizes) - sizes] = True
    before = np.where(first, start, np.roll(symbols, 1))
    lengths = np.array([sum(len(documents[n]) for n in queue) for queue in queues])
    begins = np.cumsum(lengths) - lengths
    state = np.zeros((lanes, options.hidden), np.float32)
    for at in range(0, int(lengths[0]), options.scored_window):
        # Lanes are sorted by length: those that are done are at the end.
        active = int(np.searchsorted(-lengths, -at, side="left"))
        step = at + np.arange(min(options.scored_window, int(lengths[0]) - at))[:, None]
        inside = step < lengths[:active]
        place = np.where(inside, begins[:active] + step, begins[:active])
        keep = 1 - first[place].astype(np.float32)
        states, _ = steps(weights, before[place], keep, state[:active], traced=False)
        state = states[-1]
        if not inside.all():
            place, states = place[inside], states[inside]
        found = log_likelihoods(weights, states.reshape(-1, options.hidden), symbols[place].reshape(-1))
        sums += np.bincount(owner[place].reshape(-1), found, len(documents))
    return sums
