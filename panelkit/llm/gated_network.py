"""A small gated recurrent language model in numpy.

The output is factored: first the class of a token, then the token within it. Frequent words have
slots in the first classes. All other words fall by their last two bytes into one of the last
classes, within which they have fixed shares, so the network has a bounded size whatever the
vocabulary. A token is predicted from the state before it; the end of a document resets the state.
"""

from __future__ import annotations

import numpy as np

HIDDEN, EMBED = 16, 16
FREQUENT, SLOTS, RARE = 32, 32, 32  # classes of frequent words, words in each, classes of all others
KNOWN = FREQUENT * SLOTS
CLASSES = FREQUENT + RARE
SHAPES = {
    "embed": (KNOWN + RARE, EMBED), "wx": (EMBED, 3 * HIDDEN), "wh": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
    "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "ww": (FREQUENT, HIDDEN, SLOTS), "bw": (FREQUENT, SLOTS),
}
ENDS_AT = np.cumsum([np.prod(s) for s in SHAPES.values()]).tolist()
WEIGHTS = ENDS_AT[-1]
END = 0  # its slot
PIECE = 4096  # tokens whose slots are worked out at once
TILE = 1024  # tokens whose classes are worked out at once, in a core's cache


def begin(counts: np.ndarray, rare: np.ndarray) -> dict[str, np.ndarray]:
    """Weights whose predictions are the shares of the tokens. counts: of the slots; rare: of the last classes."""
    rng = np.random.default_rng(8)
    out = {k: (rng.standard_normal(s) * (0.5 if k == "embed" else 0.15)).astype(np.float32) for k, s in SHAPES.items()}
    slots = counts.reshape(FREQUENT, SLOTS).astype(float)
    classes = np.concatenate([slots.sum(1), rare]) + 1.0
    out["bc"] = np.log(classes / classes.sum()).astype(np.float32)
    out["bw"] = np.log((slots + 0.01) / (slots + 0.01).sum(1, keepdims=True)).astype(np.float32)
    out["b"] = np.zeros(3 * HIDDEN, np.float32)
    for k in ("wc", "ww"):
        out[k] *= np.float32(0.1)
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def unflat(x: np.ndarray) -> dict[str, np.ndarray]:
    x = x.astype(np.float32, copy=False)
    return {k: x[a:b].reshape(s) for (k, s), a, b in zip(SHAPES.items(), [0, *ENDS_AT], ENDS_AT)}


def exps(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the rows of ``x``, and their sums; a row whose sum would be too large or small is moved."""
    with np.errstate(over="ignore"):
        e = np.exp(x)
        total = e @ np.ones(x.shape[1], x.dtype)
    far = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
    if len(far):
        x[far] -= x[far].max(axis=1, keepdims=True)
        e[far] = np.exp(x[far])
        total[far] = e[far].sum(axis=1)
    return e, total


def class_of(tokens: np.ndarray) -> np.ndarray:
    return np.where(tokens < KNOWN, tokens // SLOTS, tokens - KNOWN + FREQUENT)


def in_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in order, which is that of their classes, and their places."""
    order = np.argsort(tokens.astype(np.uint16), kind="stable")
    return tokens[order], order


def with_one(states: np.ndarray) -> np.ndarray:
    out = np.ones((len(states), HIDDEN + 1), states.dtype)
    out[:, :HIDDEN] = states
    return out


def of_classes(tokens: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, from, to) of tokens in order; all without a slot are one class behind the others."""
    cuts = [*np.searchsorted(tokens, np.arange(FREQUENT + 1) * SLOTS).tolist(), len(tokens)]
    return [(c, a, b) for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


def tiles(count: int) -> list[slice]:
    return [slice(low, min(low + TILE, count)) for low in range(0, count, TILE)]


def of_class(w: dict[str, np.ndarray], states: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The logarithm of the probability of each token's class, which is at ``at`` in the matrix of all; and ``exps`` over all."""
    x = states @ w["wc"]
    x += w["bc"]
    e, total = exps(x)
    return x.ravel().take(at) - np.log(total), e, total


def of_slot(w: dict[str, np.ndarray], states: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of each token's slot, and over the slots of its class. Tokens in order, states ``with_one``."""
    inner = np.concatenate([w["ww"], w["bw"][:, None]], axis=1)
    x = np.empty((len(tokens), SLOTS), states.dtype)
    for c, a, b in of_classes(tokens):
        np.dot(states[a:b], inner[c], out=x[a:b])
    e, total = exps(x)
    return x.ravel().take(at) - np.log(total), e, total


def cells(columns: np.ndarray, width: int) -> np.ndarray:
    """Where one column of each row of a matrix lies in its memory."""
    return np.arange(0, len(columns) * width, width) + columns


def log_probability(w: dict[str, np.ndarray], states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural logarithm of each token's probability; of the class only where a token has no slot."""
    out, kind = np.empty(len(tokens), states.dtype), class_of(tokens)
    for part in tiles(len(tokens)):
        out[part] = of_class(w, states[part], cells(kind[part], CLASSES))[0]
    for low in range(0, len(tokens), PIECE):
        known, order = in_order(tokens[low:low + PIECE])
        known = known[:np.searchsorted(known, KNOWN)]
        order = low + order[:len(known)]
        out[order] += of_slot(w, with_one(states.take(order, axis=0)), known, cells(known % SLOTS, SLOTS))[0]
    return out


def by_gate(x: np.ndarray) -> np.ndarray:
    """(rows, 3 * HIDDEN) as (3, rows, HIDDEN)."""
    return np.ascontiguousarray(x.reshape(len(x), 3, HIDDEN).transpose(1, 0, 2))


def ends_of(tokens: np.ndarray) -> list[np.ndarray]:
    """For each step the lanes whose document ends there."""
    step, lane = np.nonzero(tokens == END)
    cuts = np.searchsorted(step, np.arange(len(tokens) + 1)).tolist()
    return [lane[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def signed(x: np.ndarray) -> np.ndarray:
    """``by_gate``, both gates negated: their exponentials are of -x."""
    out = by_gate(x)
    np.negative(out[:2], out=out[:2])
    return out


def advance(wh: np.ndarray, gx: np.ndarray, h: np.ndarray, gh: np.ndarray, zr: np.ndarray, n: np.ndarray, out: np.ndarray) -> None:
    """One step: writes what the state adds to gates and proposal, both gates, the proposal and the next state.

    ``wh`` and ``gx`` are ``signed``.
    """
    np.matmul(h, wh, out=gh)
    np.add(gx[:2], gh[:2], out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    np.multiply(zr[1], gh[2], out=n)
    n += gx[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=out)
    out *= zr[0]
    out += n


def step(w: dict[str, np.ndarray], gx: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next state of lanes, which are rows; both gates and the proposal."""
    gh, out, n = np.empty((3, *h.shape), np.float32), np.empty_like(h), np.empty_like(h)
    zr = np.empty((2, *h.shape), np.float32)
    with np.errstate(over="ignore"):
        advance(signed(w["wh"]), signed(gx), h, gh, zr, n, out)
    return out, zr, n


def score_documents(w: dict[str, np.ndarray], tokens: np.ndarray, first: np.ndarray, lanes: int = 512, window: int = 64) -> np.ndarray:
    """``log_probability`` of every token. Document d is tokens[first[d]:first[d + 1]], its end included.

    Whole documents go one after the other down parallel lanes; states are carried from window to
    window, so each token is scored from its complete document before it.
    """
    size = np.diff(first)
    out = np.zeros(len(tokens), np.float32)
    if not len(tokens):
        return out
    lanes = min(lanes, len(size))
    # Longest first, each to the shortest lane so far, in rounds of one document per lane.
    load, lane_of = np.zeros(lanes, np.int64), np.empty(len(size), np.int64)
    order = np.argsort(-size, kind="stable")
    for low in range(0, len(order), lanes):
        part = order[low:low + lanes]
        to = np.argsort(load, kind="stable")[:len(part)]
        lane_of[part] = to
        load[to] += size[part]
    rank = np.empty(lanes, np.int64)
    rank[np.argsort(-load, kind="stable")] = np.arange(lanes)  # long lanes first, so that the active ones are a prefix
    lane_of, load = rank[lane_of], np.sort(load)[::-1]
    by_lane = np.argsort(lane_of, kind="stable")
    offset = np.cumsum(size[by_lane]) - size[by_lane]
    source = np.arange(len(tokens)) + np.repeat(first[:-1][by_lane] - offset, size[by_lane])
    begin_lane = np.cumsum(load) - load
    stream = np.append(tokens[source], END)
    gates, wh = signed(w["embed"] @ w["wx"] + w["b"]), signed(w["wh"])  # fewer kinds of tokens than tokens
    h = np.zeros((lanes, HIDDEN), np.float32)
    for low in range(0, int(load[0]), window):
        active = int(np.searchsorted(-load, -low, "left"))  # lanes with load > low
        steps = min(window, int(load[0]) - low)
        turn = np.arange(low, low + steps)[:, None]
        there = turn < load[:active]
        places = np.where(there, begin_lane[:active] + turn, len(tokens))
        now = stream[places]
        ends = ends_of(now)
        states = np.empty((steps + 1, active, HIDDEN), np.float32)
        states[0] = h[:active]
        gh, zr, n = (np.empty((k, active, HIDDEN), np.float32) for k in (3, 2, 1))
        with np.errstate(over="ignore"):
            for t in range(steps):
                advance(wh, gates.take(now[t], axis=1), states[t], gh, zr, n[0], states[t + 1])
                if len(ends[t]):
                    states[t + 1, ends[t]] = 0
        h, states = states[-1], states[:-1].reshape(-1, HIDDEN)
        there, places = there.ravel(), places.ravel()
        if not there.all():
            places, states = places[there], states[there]
        out[source[places]] = log_probability(w, states, stream[places])
    return out


def gradient(w: dict[str, np.ndarray], tokens: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
    """Of the mean loss over a window (steps, lanes) that begins in state ``h``; the state after it; the loss.

    The gradient stops at the window's beginning.
    """
    steps, lanes = tokens.shape
    count, wide = steps * lanes, (steps, lanes, HIDDEN)
    total = np.empty(WEIGHTS, np.float32)
    g = unflat(total)
    gates, wh = signed(w["embed"] @ w["wx"] + w["b"]), signed(w["wh"])  # fewer kinds of tokens than tokens
    ends = ends_of(tokens)
    states, n, dhs, back = (np.empty((steps + k, *wide[1:]), np.float32) for k in (1, 0, 0, 0))
    gh, zr = np.empty((steps, 3, *wide[1:]), np.float32), np.empty((steps, 2, *wide[1:]), np.float32)
    states[0] = h
    with np.errstate(over="ignore"):
        for t in range(steps):
            advance(wh, gates.take(tokens[t], axis=1), states[t], gh[t], zr[t], n[t], states[t + 1])
            if len(ends[t]):
                states[t + 1, ends[t]] = 0
    all_states, states, z, r = states, states[:-1], zr[:, 0], zr[:, 1]
    # Exponentials are not made shares: the rows they are multiplied with are divided by the sums.
    s, d_states, flat_tokens, loss = states.reshape(count, HIDDEN), back.reshape(count, HIDDEN), tokens.ravel(), 0.0
    g["wc"][:], g["bc"][:] = 0, 0
    kind, out_of_class = class_of(flat_tokens), np.ascontiguousarray(w["wc"].T)
    for part in tiles(count):
        at = cells(kind[part], CLASSES)
        logs, d, sums = of_class(w, s[part], at)
        loss -= float(logs.sum())
        d.ravel()[at] -= sums
        share = 1 / sums
        g["wc"] += (s[part] * share[:, None]).T @ d
        g["bc"] += share @ d
        np.matmul(d, out_of_class, out=d_states[part])
        d_states[part] *= share[:, None]
    sorted_tokens, order = in_order(flat_tokens)
    known, slot = int(np.searchsorted(sorted_tokens, KNOWN)), cells(sorted_tokens % SLOTS, SLOTS)
    s_known = with_one(s.take(order[:known], axis=0))
    logs, d, sums = of_slot(w, s_known, sorted_tokens[:known], slot[:known])
    loss -= float(logs.sum())
    d.ravel()[slot[:known]] -= sums
    share = 1 / sums[:, None]
    s_known *= share
    both, d_known = np.full((FREQUENT, HIDDEN + 1, SLOTS), 0, np.float32), np.full((count, HIDDEN), 0, np.float32)
    for c, a, b in of_classes(sorted_tokens[:known]):
        np.dot(s_known[a:b].T, d[a:b], out=both[c])
        np.dot(d[a:b], w["ww"][c].T, out=d_known[a:b])
    g["ww"][:], g["bw"][:] = both[:, :-1], both[:, -1]
    d_known[:known] *= share
    place = np.empty_like(order)
    place[order] = np.arange(count)
    d_states += d_known.take(place, axis=0)
    # What a state's gradient is multiplied by on its way to the two gates and the proposal.
    not_z = 1 - z
    to_n = n * n
    np.subtract(1, to_n, out=to_n)
    to_n *= not_z
    factors = np.empty_like(gh)
    x = all_states[1:] - n  # the state before by z; where a document ends no gradient comes back
    np.multiply(x, not_z, out=factors[:, 0])
    np.multiply(to_n, r, out=factors[:, 2])
    np.subtract(1, r, out=x)
    x *= gh[:, 2]
    np.multiply(factors[:, 2], x, out=factors[:, 1])
    dgh, parts = factors, np.empty((3, *wide[1:]), np.float32)
    back_wh = np.ascontiguousarray(by_gate(w["wh"]).transpose(0, 2, 1))
    dhs[-1] = 0
    for t in range(steps - 1, -1, -1):
        dh = dhs[t]
        if len(ends[t]):
            dh[ends[t]] = 0
        dgh[t] *= dh
        if t:
            np.matmul(dgh[t], back_wh, out=parts)
            before = np.multiply(dh, z[t], out=dhs[t - 1])
            before += parts[0]
            before += parts[1]
            before += parts[2]
            before += back[t]
    g["wh"][:] = (states.transpose(0, 2, 1)[:, None] @ dgh).sum(axis=0).transpose(1, 0, 2).reshape(HIDDEN, -1)
    np.multiply(dhs, to_n, out=dgh[:, 2])  # the state enters the proposal by way of r, the token does not
    rows = (order + order // lanes * (2 * lanes))[:, None] + np.arange(0, 3 * lanes, lanes)
    per_kind = sums_by(dgh.reshape(-1, HIDDEN).take(rows, axis=0).reshape(count, -1), sorted_tokens, slot)
    g["b"][:] = per_kind.sum(0)
    np.matmul(w["embed"].T, per_kind, out=g["wx"])
    np.matmul(per_kind, w["wx"].T, out=g["embed"])
    total /= count
    return g, all_states[-1], loss / count


def sums_by(rows: np.ndarray, tokens: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The sum of the rows of each kind of token. Tokens are in order; ``slot``: the ``cells`` of their slots."""
    ones = np.full((len(tokens), SLOTS), 0, rows.dtype)
    ones.ravel()[slot] = 1
    out = np.full((KNOWN + SLOTS, rows.shape[1]), 0, rows.dtype)  # RARE is no larger than SLOTS
    for c, a, b in of_classes(tokens):
        np.dot(ones[a:b].T, rows[a:b], out=out[c * SLOTS:c * SLOTS + SLOTS])
    return out[:KNOWN + RARE]


class Trainer:
    """Adam over windows of parallel lanes; within a call of ``train`` the state is carried on.

    The few tokens that do not fill the lanes wait for the next call, the last ones for ``finish``.
    """

    def __init__(self, weights: dict[str, np.ndarray], lanes: int = 128, window: int = 32, steps: int = 40, rate: float = 0.01):
        self.weights, self.lanes, self.window, self.steps, self.rate = weights, lanes, window, steps, rate
        self.x = flat(weights)
        self.m, self.v, self.turn = np.zeros_like(self.x), np.zeros_like(self.x), 0
        self.rest = np.zeros(0, np.int64)

    def train(self, tokens: np.ndarray) -> None:
        tokens = np.concatenate([self.rest, tokens])
        # As many lanes as leave each about ``steps`` windows.
        lanes = int(np.clip(len(tokens) // (self.window * self.steps), 1, self.lanes))
        length = len(tokens) // lanes
        grid, self.rest = tokens[:lanes * length].reshape(lanes, length).T, tokens[lanes * length:]
        self.descend(grid)

    def finish(self) -> None:
        self.descend(self.rest[:, None])

    def descend(self, grid: np.ndarray) -> None:
        length, lanes = grid.shape
        h = np.zeros((lanes, HIDDEN), np.float32)
        for low in range(0, length, self.window):
            g, h, _ = gradient(self.weights, grid[low:low + self.window], h)
            g = flat(g)
            norm = float(np.linalg.norm(g))
            if norm > 1:
                g *= np.float32(1 / norm)
            self.turn += 1
            # Sums, not means: Adam's 0.1 and 0.01 are in the two factors below.
            self.m *= np.float32(0.9)
            self.m += g
            g *= g
            self.v *= np.float32(0.99)
            self.v += g
            size = np.sqrt(self.v, out=g)
            size *= np.float32((0.01 / (1 - 0.99**self.turn)) ** 0.5)
            size += np.float32(1e-6)
            np.divide(self.m, size, out=size)
            size *= np.float32(0.1 * self.rate / (1 - 0.9**self.turn))
            self.x = self.x - size
            self.weights = unflat(self.x)
