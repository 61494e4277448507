"""A small causal self-attention model over subword ids, in numpy: scoring and training steps.

One layer of masked attention and one of rectified units change the scores that the corpus' own counts of neighbours
give: the logits of the next class are the log of P(class | previous id), from all training text, plus what the
layers add from up to WINDOW - 1 ids before. At first the layers add nothing.

The probability of a class is that of its group of 16 by that of the class in the group, and the layers add to both.

Ids are divided into classes for the output: frequent ones are classes of their own, the rest share classes, in which
the corpus' counts tell them apart: those of the id behind the class before it, or of the id alone where it is not one of
the TAIL most frequent. Inputs are the more frequent ids and one place for all others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Ids of a window, and how many of them, from the window before, are only looked at.
WINDOW, OVERLAP = 32, 8
WIDTH, HIDDEN = 16, 32
GROUPS, MEMBERS = 16, 16
INPUTS, CLASSES, SINGLE, TAIL = 1024, GROUPS * MEMBERS, 224, 4096
# Windows of a batch when scoring.
BATCH = 256

F32 = np.float32


@dataclass
class Vocabulary:
    """What the corpus says without its order: the class, input place and log share in its class of each id, and its place
    among the ids that share classes, or -1."""

    of_class: np.ndarray
    of_input: np.ndarray
    log_share: np.ndarray
    of_tail: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Vocabulary:
        """Every id has half a count more, so none is impossible."""
        n = len(counts)
        order = np.argsort(-counts, kind="stable")
        of_class, of_input = np.empty(n, np.int32), np.full(n, INPUTS - 1, np.int32)
        of_class[order[:SINGLE]] = np.arange(len(order[:SINGLE]))
        tail = order[SINGLE:]
        mass = np.cumsum(counts[tail] + 0.5)
        if len(tail):
            part = np.minimum((mass / mass[-1] * (CLASSES - SINGLE)).astype(int), CLASSES - SINGLE - 1)
            of_class[tail] = SINGLE + part
        of_input[order[: INPUTS - 1]] = np.arange(len(order[: INPUTS - 1]))
        weight = counts + 0.5
        total = np.bincount(of_class, weight, CLASSES)
        of_tail = np.full(n, -1, np.int32)
        of_tail[tail[:TAIL]] = np.arange(len(tail[:TAIL]))
        return cls(of_class, of_input, np.log(weight / total[of_class]).astype(F32), of_tail)

    def tail_cells(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids of some texts, which begin at `begins`, are in the tail, and for these (class before, place in the
        tail) as one number."""
        before = np.empty(len(ids), np.int64)
        before[1:] = self.of_class[ids[:-1]]
        before[begins] = CLASSES
        place = self.of_tail[ids]
        there = np.flatnonzero(place >= 0)
        return there, before[there] * TAIL + place[there]

    def tail_logs(self, counts: np.ndarray) -> np.ndarray:
        """log P(id | its class, class before) of all tail cells, from their counts; rare ones lean on the log share."""
        ids = np.flatnonzero(self.of_tail >= 0)
        ids = ids[np.argsort(self.of_tail[ids])]
        counts = counts.reshape(CLASSES + 1, TAIL)[:, : len(ids)].astype(float)
        share, of_class = np.exp(self.log_share[ids].astype(float)), self.of_class[ids]
        out = np.zeros((CLASSES + 1, TAIL), F32)
        for before in range(CLASSES + 1):
            total = np.bincount(of_class, counts[before], CLASSES)[of_class]
            strength = 1 + 0.75 * np.bincount(of_class, counts[before] > 0, CLASSES)[of_class]
            out[before, : len(ids)] = np.log((counts[before] + strength * share) / (total + strength))
        return out.reshape(-1)


def neighbour_shares(pairs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """P(group | input place before), and for each group P(class | its group, input place before), from counts of pairs;
    rare places lean on the classes' own counts.

    (INPUTS + 1, 1 + GROUPS, MEMBERS): the first row of a place is that of the groups. The last place, INPUTS, is for the
    beginning of a text.
    """
    alone = (classes + 0.5) / (classes + 0.5).sum()
    strength = 2.0 + (pairs > 0).sum(axis=1, keepdims=True) * 0.75
    shared = (pairs + strength * alone) / (pairs.sum(axis=1, keepdims=True) + strength)
    shared = shared.reshape(len(pairs), GROUPS, MEMBERS)
    groups = shared.sum(axis=2)
    return np.concatenate([groups[:, None, :], shared / groups[:, :, None]], axis=1).astype(F32)


Params = dict[str, np.ndarray]


def first_params(seed: int = 1) -> Params:
    chance = np.random.default_rng(seed)

    def some(*shape: int) -> np.ndarray:
        return (chance.standard_normal(shape) / np.sqrt(shape[0])).astype(F32)

    d, h = WIDTH, HIDDEN
    return {
        "ids": (chance.standard_normal((INPUTS + 1, d)) * 0.3).astype(F32), "places": (chance.standard_normal((WINDOW, d)) * 0.1).astype(F32),
        "q": some(d, d), "kv": some(d, 2 * d), "o": some(d, d), "up": some(d, h), "up_bias": np.zeros(h, F32), "down": some(h, d),
        "groups": np.zeros((d, GROUPS), F32), "groups_bias": np.zeros(GROUPS, F32),
        "members": np.zeros((GROUPS, d, MEMBERS), F32), "members_bias": np.zeros((GROUPS, MEMBERS), F32),
    }


_SEEN = np.tril(np.ones((WINDOW, WINDOW), F32))
_SCALE = F32(1 / np.sqrt(WIDTH))
# Exponents lie between this and its negative.
_MOST = F32(40)
# Places of a product: larger products of such short rows cost up to twice as much a row.
_ROWS = 256
# Sums over the places a place looks back to, one for each column of what it looks at.
_ALL = np.ones((WINDOW, WIDTH), F32)
# Which half of a row of outputs is that of the groups, and which that of the members.
_HALVES = np.repeat(np.eye(2, dtype=F32), MEMBERS, axis=0)
_SPREAD = np.ascontiguousarray(_HALVES.T)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for many rows, some at a time: much cheaper than in one for results this small."""
    n = len(a) // _ROWS
    full = n * _ROWS
    out = (a[:full].reshape(n, _ROWS, -1).transpose(0, 2, 1) @ b[:full].reshape(n, _ROWS, -1)).sum(axis=0) if n else 0
    return out + a[full:].T @ b[full:] if full < len(a) else out


def _times(a: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """a @ weights for many rows, some at a time for the same reason."""
    if len(a) % _ROWS:
        return a @ weights
    return (a.reshape(-1, _ROWS, a.shape[1]) @ weights).reshape(len(a), -1)


def _turned(some: np.ndarray) -> np.ndarray:
    """The rows of each window as columns, copied: products with them are cheaper then."""
    return np.ascontiguousarray(some.transpose(0, 2, 1))


def _heads(p: Params) -> np.ndarray:
    """The weights of queries, scaled, keys and values side by side."""
    return np.concatenate([p["q"] * _SCALE, p["kv"]], axis=1)


def layers(p: Params, heads: np.ndarray, x: np.ndarray, start: int = 0):
    """What the layers make of places from `start` on in windows of input places; all steps, for the way back.

    Steps before and behind attention are one row a place, so that all windows are one product. Attention is divided by
    its sums behind the product with the values, where rows are shorter.
    """
    n, d = len(x), WIDTH
    e = p["ids"].take(x, axis=0, mode="clip")
    e += p["places"]
    both = _times(e.reshape(-1, d), heads).reshape(n, -1, 3 * d)
    q, k, v = both[:, start:, :d], both[:, :, d : 2 * d], both[:, :, 2 * d :]
    a = q @ _turned(k)
    a.clip(-_MOST, _MOST, out=a)
    np.exp(a, out=a)
    a *= _SEEN[start:]
    total = (a @ _ALL).reshape(-1, d)
    c = (a @ v).reshape(-1, d)
    c /= total
    r = c @ p["o"]
    r += e[:, start:].reshape(-1, d)
    u = _times(r, p["up"])
    u += p["up_bias"]
    positive = (u > 0).astype(u.dtype)
    u *= positive
    h = _times(u, p["down"])
    h += r
    return e, q, k, v, a, total, c, r, positive, u, h


def output_table(base: np.ndarray) -> np.ndarray:
    """For each group and each input place before, in one row: the shares of the groups and of that group's members."""
    out = np.empty((GROUPS, len(base), GROUPS + MEMBERS), base.dtype)
    out[:, :, :GROUPS], out[:, :, GROUPS:] = base[:, 0], base[:, 1:].transpose(1, 0, 2)
    return out.reshape(-1, GROUPS + MEMBERS)


def output_weights(p: Params) -> np.ndarray:
    """For each group the weights of the groups and of its members side by side, the biases as a last row."""
    out = np.empty((GROUPS, WIDTH + 1, GROUPS + MEMBERS), p["groups"].dtype)
    out[:, :-1, :GROUPS], out[:, -1, :GROUPS] = p["groups"], p["groups_bias"]
    out[:, :-1, GROUPS:], out[:, -1, GROUPS:] = p["members"], p["members_bias"]
    return out


def _outputs(weights: np.ndarray, table: np.ndarray, h: np.ndarray, before: np.ndarray, goal: np.ndarray):
    """Unscaled probabilities of the groups and of the members of each place's group, with the places in the order of the groups.

    What the layers add to the logits is a factor on what the counts say. (order, where each group's places are, h, the
    probabilities, their two sums a place, the wanted two of all places in the flat probabilities).
    """
    each = INPUTS + 1
    row = goal // MEMBERS * each
    row += before
    # Row numbers of the table: in their order its rows lie near each other.
    row = row.astype(np.uint16)
    order = np.argsort(row, kind="stable")
    row = row.take(order)
    end = np.searchsorted(row, np.arange(1, GROUPS + 1) * each).tolist()
    at = [slice(a, b) for a, b in zip([0, *end], end, strict=False)]
    some = np.ones((len(h), WIDTH + 1), h.dtype)
    some[:, :WIDTH] = h.take(order, axis=0)
    found = np.empty((len(h), GROUPS + MEMBERS), h.dtype)
    for part, w in zip(at, weights, strict=True):
        np.matmul(some[part], w, out=found[part])
    found.clip(-_MOST, _MOST, out=found)
    np.exp(found, out=found)
    found *= table.take(row, axis=0, mode="clip")
    goal, place = goal.take(order), np.arange(0, found.size, GROUPS + MEMBERS)
    wanted = place + goal // MEMBERS, place + (goal % MEMBERS + GROUPS)
    return order, at, some, found, found @ _HALVES, wanted


def log_probs(p: Params, weights: np.ndarray, table: np.ndarray, x: np.ndarray, target: np.ndarray, start: int) -> np.ndarray:
    """Log probability of each target class from place `start` of each window on; `weights` and `table` are those of the outputs."""
    h = layers(p, _heads(p), x, start)[-1]
    before, goal = x[:, start:].reshape(-1), target[:, start:].reshape(-1)
    order, _, _, found, total, (group, member) = _outputs(weights, table, h, before, goal)
    found = found.reshape(-1)
    share = found.take(group) / total[:, 0]
    share *= found.take(member) / total[:, 1]
    out = np.empty_like(share)
    out[order] = np.log(share + F32(1e-37))
    return out.reshape(len(x), -1)


def gradient(p: Params, table: np.ndarray, x: np.ndarray, target: np.ndarray, wanted: np.ndarray) -> Params:
    """The gradient of the mean loss over the wanted places of a batch of windows."""
    heads, weights = _heads(p), output_weights(p)
    steps = layers(p, heads, x)
    before, d = x.reshape(-1), WIDTH
    order, at, some, g, total, cells = _outputs(weights, table, steps[-1], before, target.reshape(-1))
    weight = wanted.reshape(-1).take(order).astype(g.dtype)
    weight /= g.dtype.type(max(1, int(wanted.sum())))
    g *= (weight[:, None] / total) @ _SPREAD
    flat = g.reshape(-1)
    for k in cells:
        flat[k] -= weight
    found, back = np.empty_like(weights), np.empty((len(g), d), g.dtype)
    # The weights without their bias, turned.
    turned = np.ascontiguousarray(weights[:, :-1].transpose(0, 2, 1))
    for part, w, out in zip(at, turned, found, strict=True):
        mine = g[part]
        np.matmul(some[part].T, mine, out=out)
        np.matmul(mine, w, out=back[part])
    groups = (np.ones(GROUPS, g.dtype) @ found.reshape(GROUPS, -1)).reshape(d + 1, -1)[:, :GROUPS]
    grad = {"groups": groups[:-1], "groups_bias": groups[-1], "members": found[:, :-1, GROUPS:], "members_bias": found[:, -1, GROUPS:]}
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    gh = back.take(place, axis=0)

    # Products with turned weights are dear, those with a turned copy of them are not.
    back = {k: np.ascontiguousarray(p[k].T) for k in ("o", "up", "down")} | {"heads": np.ascontiguousarray(heads.T)}
    found, ge = _layers_gradient(back, steps, gh)
    grad |= found
    grad["q"], grad["kv"] = grad["heads"][:, :d] * _SCALE, grad.pop("heads")[:, d:]
    number, grad["ids"] = before.astype(np.int64), np.empty_like(p["ids"])
    for k, column in enumerate(ge.T.astype(np.float64, order="C")):
        grad["ids"][:, k] = np.bincount(number, column, len(p["ids"]))
    return grad


def _layers_gradient(turned: Params, steps, gh: np.ndarray) -> tuple[Params, np.ndarray]:
    """The gradient of the layers' weights, and of the rows of input places, from the one behind the layers."""
    e, q, k, v, a, total, c, r, positive, u, _ = steps
    n, d = len(e), WIDTH
    grad = {"down": _product(u, gh)}
    gu = _times(gh, turned["down"])
    gu *= positive
    grad["up"], grad["up_bias"] = _product(r, gu), np.ones(len(gu), gu.dtype) @ gu
    gr = _times(gu, turned["up"])
    gr += gh
    grad["o"] = _product(c, gr)
    # With the means as a last column and a row of -1 behind the values, one product takes the means away.
    less = np.empty((len(gr), d + 1), gr.dtype)
    gc = less[:, :d]
    np.divide(gr @ turned["o"], total, out=gc)
    np.einsum("ij,ij->i", gc, c, out=less[:, d])
    values = np.empty((n, d + 1, WINDOW), gr.dtype)
    values[:, :d], values[:, d] = v.transpose(0, 2, 1), -1
    gs = less.reshape(n, -1, d + 1) @ values
    gs *= a
    back = np.empty((n, WINDOW, 3 * d), gr.dtype)
    np.matmul(gs, k, out=back[:, :, :d])
    np.matmul(gs.transpose(0, 2, 1), q, out=back[:, :, d : 2 * d])
    np.matmul(a.transpose(0, 2, 1), gc.reshape(n, -1, d), out=back[:, :, 2 * d :])
    back = back.reshape(-1, 3 * d)
    grad["heads"] = _product(e.reshape(-1, d), back)
    ge = _times(back, turned["heads"])
    ge += gr
    grad["places"] = (np.ones(n, ge.dtype) @ ge.reshape(n, -1)).reshape(-1, d)
    return grad, ge


def step(p: Params, base: np.ndarray, x: np.ndarray, target: np.ndarray, wanted: np.ndarray) -> tuple[float, Params]:
    """Mean loss over the wanted places of a batch of windows, and its gradient."""
    table = output_table(base)
    logs = log_probs(p, output_weights(p), table, x, target, 0)
    return -float((logs * wanted).sum() / max(1, int(wanted.sum()))), gradient(p, table, x, target, wanted)


def train(p: Params, base: np.ndarray, x: np.ndarray, target: np.ndarray, wanted: np.ndarray, steps: int, rate: float, seed: int, batch: int = 64) -> Params:
    """Adam over batches of the windows, again and again in a fixed shuffled order."""
    # All weights lie in one row, so that a step changes them together.
    flat = np.concatenate([v.reshape(-1) for v in p.values()])
    ends = np.cumsum([v.size for v in p.values()]).tolist()
    p = {k: flat[end - v.size : end].reshape(v.shape) for (k, v), end in zip(p.items(), ends, strict=True)}
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    table = output_table(base)
    chance = np.random.default_rng(seed)
    order, at = chance.permutation(len(x)), 0
    for t in range(1, steps + 1):
        if at >= len(order):
            order, at = chance.permutation(len(x)), 0
        some = order[at : at + batch]
        at += batch
        grad = gradient(p, table, x.take(some, axis=0), target.take(some, axis=0), wanted.take(some, axis=0))
        g = np.concatenate([grad[k].reshape(-1) for k in p])
        now = rate * min(1.0, t / 20)
        first += F32(0.1) * (g - first)
        g *= g
        g -= second
        g *= F32(0.01)
        second += g
        np.divide(second, F32(1 - 0.99**t), out=g)
        np.sqrt(g, out=g)
        g += F32(1e-8)
        flat -= F32(now) * (first / F32(1 - 0.9**t)) / g
    return p


def windows_of(ids: list[np.ndarray], vocabulary: Vocabulary):
    """All windows of some texts, each id wanted in one of them.

    (x, target, start, text): input places before each id, the ids themselves, the first wanted place of each window, and
    the number of the text a window belongs to. Behind the text a window holds empty places, whose target is -1.
    """
    size = np.array([len(y) for y in ids], np.int64)
    end = np.cumsum(size)
    y = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
    x = np.empty(len(y), np.int32)
    x[1:] = vocabulary.of_input[y[:-1]]
    x[(end - size)[size > 0]] = INPUTS
    hop = WINDOW - OVERLAP
    count = np.where(size > 0, -(-np.maximum(1, size - OVERLAP) // hop), 0)
    text = np.repeat(np.arange(len(ids)), count)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * hop
    place = ((end - size)[text] + begin)[:, None] + np.arange(WINDOW)
    inside = place < end[text][:, None]
    place = np.minimum(place, len(y) - 1)
    return x[place], np.where(inside, y[place], -1), np.where(begin > 0, OVERLAP, 0), text


def score(
    p: Params, base: np.ndarray, vocabulary: Vocabulary, tail: np.ndarray, ids: list[np.ndarray], table: np.ndarray | None = None
) -> np.ndarray:
    """log10 probability of each list of ids, in windows that overlap, each id scored once; `table` is `output_table(base)`."""
    size = np.array([len(y) for y in ids], np.int64)
    y = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
    inside = vocabulary.log_share[y].astype(np.float64)
    there, cells = vocabulary.tail_cells(y, (np.cumsum(size) - size)[size > 0])
    inside[there] = tail[cells]
    total = np.bincount(np.repeat(np.arange(len(ids)), size), inside, len(ids))
    x, y, start, text = windows_of(ids, vocabulary)
    goal, wanted = vocabulary.of_class[np.maximum(y, 0)], y >= 0
    weights, table = output_weights(p), output_table(base) if table is None else table
    for late in (0, OVERLAP):
        windows = np.flatnonzero(start == late)
        for at in range(0, len(windows), BATCH):
            some = windows[at : at + BATCH]
            found = log_probs(p, weights, table, x[some], goal[some], late) * wanted[some, late:]
            total += np.bincount(text[some], found.sum(axis=1, dtype=np.float64), len(ids))
    return total / np.log(10)
