"""Small non-negative fits, one per (sample, gene), for grouped maps."""

from __future__ import annotations

from collections.abc import Callable, Generator
from heapq import heapify, heappop, heappush

import numpy as np


#: Programmes whose pivots are made together.
AT_ONCE = 64


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """argmin ||a x - b||, x >= 0, by active sets."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gram, right = a.T @ a, a.T @ b
    w = a.T @ (b - a @ x)
    for _ in range(10 * n + 10):
        if passive.all() or not (w[~passive] > 1e-10).any():
            break
        passive[(~passive).nonzero()[0][w[~passive].argmax()]] = True
        while True:
            s = np.zeros(n)
            s[passive] = _normal(gram[passive][:, passive], right[passive], a[:, passive], b)
            bad = passive & (s <= 1e-12)
            if not bad.any():
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            passive &= x > 1e-12
            x[~passive] = 0
        x = s
        w = a.T @ (b - a @ x)
    return x


def _normal(gram: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """argmin ||a x - b|| by the normal equations; by singular values where columns depend on each other, and if these do not
    converge by equations that a small ridge makes regular."""
    try:
        x = np.linalg.solve(gram, right)
        if np.abs(x).sum() * 1e-6 <= np.abs(b).sum() and np.abs(gram @ x - right).max(initial=0) <= 1e-9 * (1 + np.abs(right).max(initial=0)):
            return x
    except np.linalg.LinAlgError:
        pass
    try:
        return np.linalg.lstsq(a, b, rcond=None)[0]
    except np.linalg.LinAlgError:
        return np.linalg.solve(gram + 1e-9 * (1 + np.trace(gram)) * np.eye(len(gram)), right)


def least_weighted(a: np.ndarray, b: np.ndarray, weight: np.ndarray, equal: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(x, y, z, value): x >= 0 that minimises sum weight |a x - b| with equal x = 0, for b >= 0, and a dual solution.

    y has a price for each row of a and z for each row of equal: |y| <= weight, a'y + equal'z <= 0 and b'y = value, which proves x
    optimal.  The simplex method on a tableau: what is missing and what is too much of each row are variables of their own,
    the former the first basis; the rows of equal are pivoted in at 0 before, those that depend on others left out.
    """
    k, m = a.shape
    n = k + (0 if equal is None else len(equal))
    t = np.zeros((n + 1, m + 2 * k + 1))  # the last row is the cost
    t[:k, :m], t[:k, -1] = a, b
    at = np.arange(k)
    t[at, m + at], t[at, m + k + at] = 1.0, -1.0
    if n > k:
        t[k:n, :m] = equal
    cost = t[-1]
    cost[m : m + k], cost[m + k : -1] = weight, weight
    cost -= weight @ t[:k]
    basis = np.full(n, -1)
    basis[:k] = at + m

    def pivot(r: int, c: int) -> None:
        row = t[r] / t[r, c]
        column = t[:, c]
        if n > 60:  # many rows have nothing there
            rows = column.nonzero()[0]
            t[rows] -= np.multiply.outer(column[rows], row)
        else:
            np.subtract(t, np.multiply.outer(column, row), out=t)
        t[r] = row
        basis[r] = c

    for r in range(k, n):
        c = int(np.abs(t[r, :m]).argmax()) if m else 0
        if m and abs(t[r, c]) > 1e-9:
            pivot(r, c)
    if n > k and (basis < 0).any():
        keep = (basis >= 0).nonzero()[0]
        t, basis = t[np.append(keep, n)], basis[keep]
        n, cost = len(keep), t[-1]
    least, idle, value = -1e-9 * (1 + weight.max(initial=0)), 0, np.inf
    costs, rhs = cost[:-1], t[:n, -1]
    while len(costs):
        c = int(costs.argmin())
        if costs[c] >= least:
            break
        now = -cost[-1]
        idle, value = (idle + 1, value) if now >= value - 1e-12 else (0, now)
        if idle > 20:
            c = int((costs < least).argmax())  # the first of all, if nothing has gained for long: no cycling
        column = t[:n, c]
        up = (column > 1e-9).nonzero()[0]
        reach = rhs[up] / column[up]
        ties = up[reach <= reach.min() + 1e-12]
        pivot(int(ties[0] if len(ties) == 1 else ties[basis[ties].argmin()]), c)
    x = np.zeros(m + 2 * k)
    x[basis] = rhs.clip(0)
    y = weight - cost[m : m + k]
    z = np.linalg.lstsq(equal.T, -a.T @ y - cost[:m], rcond=None)[0] if equal is not None and len(equal) and m else np.zeros(0 if equal is None else len(equal))
    return x[:m], y, z, float(weight @ np.abs(a @ x[:m] - b))


class _Weighted:
    """least_weighted() without equations, to whose columns more can be added: what is solved so far is where the next begins.

    The basis' inverse is kept; y are the rows' prices.  Columns are numbered as they come, what is missing of the rows from
    MISSING, what is too much from TOO_MUCH.  explained() solves many at once.
    """

    MISSING, TOO_MUCH = 1_000_000, 2_000_000

    def __init__(self, b: np.ndarray, weight: np.ndarray, columns: list[np.ndarray]):
        self.b, self.weight = b, weight
        self.a = np.array(columns).reshape(len(columns), len(b))
        self.inverse, self.at, self.y = np.eye(len(b)), b.astype(float), weight.astype(float)
        self.basis = np.arange(len(b)) + self.MISSING

    def add(self, column: np.ndarray) -> None:
        self.a = np.concatenate([self.a, column[None]])


def explained(programmes: list[_Weighted]) -> list[tuple[np.ndarray, float]]:
    """(x, sum weight |a x - b|) of each programme: pivots of all that are not done yet are made at once, and none waits for the others'
    numbers, so a result does not depend on what is solved beside it."""
    n, m, k = len(programmes), max(len(p.a) for p in programmes), max(len(p.b) for p in programmes)
    a, inverse = np.zeros((n, m, k)), np.zeros((n, k, k))
    at, y, b, weight = (np.zeros((n, k)) for _ in range(4))
    basis, least = np.full((n, k), _Weighted.MISSING), np.empty(n)
    for i, p in enumerate(programmes):
        r = len(p.b)
        a[i, : len(p.a), :r], inverse[i, :r, :r], basis[i, :r] = p.a, p.inverse, p.basis
        at[i, :r], y[i, :r], b[i, :r], weight[i, :r] = p.at, p.y, p.b, p.weight
        least[i] = -1e-9 * (1 + p.weight.max(initial=0))
    idle, value, open_ = np.zeros(n, int), np.full(n, np.inf), np.arange(n)
    units = np.concatenate([np.eye(k), -np.eye(k)])
    numbers = np.concatenate([np.arange(m), np.arange(k) + _Weighted.MISSING, np.arange(k) + _Weighted.TOO_MUCH])
    out: list = [None] * n

    def told(i: int, inverse: np.ndarray, at: np.ndarray, y: np.ndarray, basis: np.ndarray) -> None:
        p = programmes[i]
        r, x = len(p.b), np.zeros(len(p.a))
        p.inverse, p.at, p.y, p.basis = inverse[:r, :r].copy(), at[:r].copy(), y[:r].copy(), basis[:r].copy()
        paths = p.basis < _Weighted.MISSING
        x[p.basis[paths]] = p.at[paths]
        out[i] = x, float(p.weight @ np.abs(x @ p.a - p.b))

    while len(open_):
        cost = np.concatenate([-(a @ y[:, :, None])[:, :, 0], weight - y, weight + y], axis=1)
        c = cost.argmin(axis=1) if m + k else np.zeros(n, int)
        more = cost[np.arange(len(c)), c] < least if m and k else np.zeros(n, bool)
        if not more.all():
            for j in (~more).nonzero()[0]:
                told(int(open_[j]), inverse[j], at[j], y[j], basis[j])
            a, inverse, at, y, b, weight, basis, least, idle, value, open_, cost, c = (x[more] for x in (a, inverse, at, y, b, weight, basis, least, idle, value, open_, cost, c))
            if not len(open_):
                break
        now = (b * y).sum(axis=1)
        waits = now >= value - 1e-12
        idle, value = np.where(waits, idle + 1, 0), np.where(waits, value, now)
        if (idle > 20).any():  # as in least_weighted(): no cycling
            c = np.where(idle > 20, (cost < least[:, None]).argmax(axis=1), c)
        each = np.arange(len(open_))
        enters = np.where((c < m)[:, None], a[each, np.minimum(c, m - 1)], units[np.maximum(c - m, 0)])
        column = (inverse @ enters[:, :, None])[:, :, 0]
        up = column > 1e-9
        reach = np.where(up, at / np.where(up, column, 1), np.inf)
        r = np.where(reach <= reach.min(axis=1)[:, None] + 1e-12, basis, np.iinfo(np.int64).max).argmin(axis=1)
        pivot = column[each, r]
        step, one = at[each, r] / pivot, inverse[each, r] / pivot[:, None]
        at = np.maximum(at - step[:, None] * column, 0)
        at[each, r] = step
        inverse -= column[:, :, None] * one[:, None, :]
        inverse[each, r] = one
        y += cost[each, c][:, None] * one
        basis[each, r] = numbers[c]
    return out


def least_absolute(a: np.ndarray, b: np.ndarray, upper: float = np.inf) -> np.ndarray:
    """argmin sum |a x - b|, 0 <= x <= upper; no path of a 0/1 matrix needs more than its largest row, so bounds above that do not bind."""
    return np.minimum(least_weighted(a, b, np.ones(len(b)))[0], upper)


def objective(a: np.ndarray, b: np.ndarray, x: np.ndarray, kind: int) -> float:
    """Mean over nodes with abundance of 1: |r|, 2: |r|/a, 3: |r|/sqrt(a), 4: r^2, 5: r^2/max(1e-5, a); 6: that of 1 times
    the number of paths, used ones counted twice; 7: the sum of r^2 and, for each used path, the log of the number of nodes."""
    use = b != 0
    r, v = (a @ x - b)[use], b[use]
    if kind == 6:
        return float(np.abs(r).mean() * (len(x) + (x > 0).sum())) if len(r) else 0.0
    if kind == 7:
        return float((r * r).sum() + np.log(max(1, len(r))) * (x > 0).sum())
    e = {1: np.abs(r), 2: np.abs(r) / v, 3: np.abs(r) / np.sqrt(v), 4: r * r, 5: r * r / np.maximum(1e-5, v)}[kind]
    return float(e.mean()) if len(e) else 0.0


def fit(a: np.ndarray, b: np.ndarray, kind: int, least: float = 0.0) -> np.ndarray:
    """Abundances of paths (columns of the 0/1 matrix a) for node abundances b, in two phases: paths of at most `least` are
    fixed to 0 before the second."""
    if kind > 5:
        return penalised(a, b, kind, least)
    upper = 1.05 * b.max() if len(b) else 0.0
    use = b != 0
    scale = {1: np.ones_like(b), 2: 1 / np.where(use, b, 1), 3: 1 / np.sqrt(np.where(use, b, 1)), 4: np.ones_like(b), 5: 1 / np.sqrt(np.maximum(1e-5, b))}[kind][use]

    def once(cols: np.ndarray) -> np.ndarray:
        x = np.zeros(a.shape[1])
        m = a[use][:, cols] * scale[:, None]
        x[cols] = least_absolute(m, b[use] * scale, upper) if kind <= 3 else np.minimum(nnls(m, b[use] * scale), upper)
        return x

    x = once(np.arange(a.shape[1]))
    keep = np.flatnonzero(x > least)
    return once(keep) if 0 < len(keep) < a.shape[1] else x


def penalised(a: np.ndarray, b: np.ndarray, kind: int, least: float = 0.0) -> np.ndarray:
    """fit() for the objectives that count paths: the best set of paths, whatever its size.

    Sets are searched in order; a branch is left when all the paths it could still take, at the price of one, do not beat the
    best set so far.
    """
    base, n, nodes = {6: 1, 7: 4}[kind], a.shape[1], max(1, int((b != 0).sum()))

    def value(x: np.ndarray, used: int) -> float:
        e = objective(a, b, x, base)
        return e * (n + used) if kind == 6 else e * nodes + np.log(nodes) * used

    known: dict[tuple[int, ...], np.ndarray] = {}  # a set is asked for as what a branch could take, and again in its first branch

    def solved(cols: list[int]) -> np.ndarray:
        if (x := known.get(tuple(cols))) is None:
            if len(known) > 5000:
                known.clear()
            x = known[tuple(cols)] = np.zeros(n)
            if cols:
                x[cols] = fit(a[:, cols], b, base)
        return x

    best, least_value = np.zeros(n), value(np.zeros(n), 0)

    def search(cols: list[int]) -> None:
        nonlocal best, least_value
        for j in range(cols[-1] + 1 if cols else 0, n):
            if value(solved([*cols, *range(j, n)]), len(cols) + 1) >= least_value - 1e-9:
                return
            x = solved([*cols, j])
            if (v := value(x, int((x > 0).sum()))) < least_value - 1e-9:
                best, least_value = x, v
            search([*cols, j])

    search([])
    keep = np.flatnonzero(best > least)
    return solved(keep.tolist()) if 0 < len(keep) < (best > 0).sum() else best


def choose(a: np.ndarray, b: np.ndarray, most: int, kind: int = 5, start: np.ndarray | None = None) -> np.ndarray:
    """Abundances of at most `most` paths that minimise the objective; `start` if none are better, then fewer paths, then earlier ones.

    Subsets are searched whole, by size and in order; a branch is left when even all paths it could still take do not beat
    the best so far.  Of least squares, one path and two need no search: their fits are told in closed form, all at once.
    """
    n = a.shape[1]
    best, value = np.zeros(n), objective(a, b, np.zeros(n), kind)
    if start is not None and (start > 0).sum() <= most:
        best, value = start, objective(a, b, start, kind)
    use = b != 0
    scale = {1: np.ones_like(b), 2: 1 / np.where(use, b, 1), 3: 1 / np.sqrt(np.where(use, b, 1)), 4: np.ones_like(b), 5: 1 / np.sqrt(np.maximum(1e-5, b))}[kind][use]
    rows, rhs = a[use] * scale[:, None], b[use] * scale

    known: dict[tuple[int, ...], float] = {}  # a set is asked for as what a branch could take, and whole; fits are as good as their bounds

    def bound(cols: list[int]) -> float:
        if (v := known.get(tuple(cols))) is None:
            if kind <= 3:
                v = (_one_weighted(rows[:, cols[0]], rhs) if len(cols) == 1 else least_weighted(rows[:, cols], rhs, np.ones(len(rhs)))[3]) / max(1, len(rhs))
            else:
                r = rows[:, cols] @ nnls(rows[:, cols], rhs) - rhs
                v = float(r @ r) / max(1, len(rhs))
            if len(known) > 5000:
                known.clear()
            known[tuple(cols)] = v
        return v

    taken: list[int] = []

    def search(cols: list[int], size: int) -> None:
        nonlocal taken, value
        if len(cols) == size:
            if bound(cols) < value - 1e-9:
                taken, value = cols, bound(cols)
            return
        first = cols[-1] + 1 if cols else 0
        if len(cols) + 1 < n - first + len(cols) and bound([*cols, *range(first, n)]) >= value - 1e-9:
            return
        for j in range(first, n - (size - len(cols)) + 1):
            search([*cols, j], size)

    told = 0
    if kind > 3 and min(most, n) > 0 and use.any():
        told = min(most, 2)
        values, sets = _few(rows, rhs, told, lambda cols: objective(a[:, cols], b, fit(a[:, cols], b, kind), kind))
        at = 0
        while len(better := (values[at:] < value - 1e-9).nonzero()[0]):
            at += int(better[0])
            taken, value = sorted({int(j) for j in sets[:, at]}), float(values[at])
            at += 1
    for size in range(told + 1, min(most, n) + 1):
        search([], size)
    if taken:
        best = np.zeros(n)
        best[taken] = fit(a[:, taken], b, kind)
    return best


def _one_weighted(column: np.ndarray, b: np.ndarray) -> float:
    """The least sum |column x - b| of one x >= 0, for b >= 0: at one of the ratios, by weight in the middle."""
    on = column > 0
    ratio = b[on] / column[on]
    order = np.argsort(ratio)
    upto = np.cumsum(column[on][order])
    x = ratio[order[np.searchsorted(upto, upto[-1] / 2)]] if len(order) else 0.0
    return float(np.abs(column * x - b).sum())


def _few(rows: np.ndarray, rhs: np.ndarray, most: int, fitted: Callable[[list[int]], float]) -> tuple[np.ndarray, np.ndarray]:
    """(mean square of what is left, paths) of the least squares fits x >= 0 of each path, then of each two if `most` is 2, in order;
    a single path stands twice.  Two that depend on each other nearly are fitted() one by one."""
    gram, right, n = rows.T @ rows, rows.T @ rhs, rows.shape[1]
    own = gram.diagonal()
    gain = np.where(own > 0, right.clip(0) ** 2 / np.where(own > 0, own, 1), 0)  # how much each path alone takes off the squares
    if most < 2 or n < 2:
        return (rhs @ rhs - gain) / len(rhs), np.stack([np.arange(n)] * 2)
    i, j = np.triu_indices(n, 1)
    p, q, both, x, y = own[i], own[j], gram[i, j], right[i], right[j]
    det = p * q - both * both
    clear = det > 1e-6 * p * q
    d = np.where(clear, det, 1)
    u, v = (q * x - both * y) / d, (p * y - both * x) / d
    pair = np.where(clear & (u > 0) & (v > 0), u * x + v * y, np.maximum(gain[i], gain[j]))
    values = (rhs @ rhs - np.concatenate([gain, pair])) / len(rhs)
    for k in (~clear & (p > 0) & (q > 0)).nonzero()[0]:
        values[n + k] = fitted([int(i[k]), int(j[k])])
    return values, np.stack([np.concatenate([np.arange(n), i]), np.concatenate([np.arange(n), j])])


def _topological(edges) -> list:
    """The nodes of acyclic edges (u, v), sources first, smaller ones first where both may come."""
    into, out = {}, {}
    for u, v in edges:
        into[v] = into.get(v, 0) + 1
        out.setdefault(u, []).append(v)
    free = [u for u in {*out, *into} if u not in into]
    heapify(free)
    order = []
    while free:
        order.append(u := heappop(free))
        for v in out.get(u, ()):
            into[v] -= 1
            if not into[v]:
                heappush(free, v)
    if len(order) < len({*out, *into}):
        raise ValueError("the flow graph has a cycle")
    return order


def greedy_paths(edges: list[tuple[int, int, float]], least: float, mode: str = "most", loose: set[tuple[int, int]] = frozenset()) -> list[tuple[tuple[int, ...], float]]:
    """Paths of a flow on an acyclic graph from its sources to its sinks, each with its bottleneck, subtracted before the next is sought.

    mode: `most` flow in sum, `least`, or fewest `hops`; on ties the smaller nodes.  Sources and sinks are those of the graph as
    given, and paths end when none joins them any more over edges with max(1, least) left.  The flow on loose edges (overlaps)
    says little: but for `hops` they begin with the largest flow of all.
    """
    flow = {(u, v): f for u, v, f in edges}
    order = _topological(flow)
    if mode != "hops" and loose:
        flow |= dict.fromkeys(loose & flow.keys(), max(flow.values()))
    into: dict[int, list[int]] = {}
    for u, v in sorted(flow):
        into.setdefault(v, []).append(u)
    sources, sinks = {u for u, _ in flow} - into.keys(), sorted(into.keys() - {u for u, _ in flow})
    cost = {"most": lambda f: -f, "least": lambda f: f, "hops": lambda f: 1.0}[mode]
    out = []
    while True:
        best: dict[int, tuple[float, tuple[int, ...]]] = {v: (0.0, (v,)) for v in sources}
        for v in order:
            ways = [(best[u][0] + cost(flow[u, v]), (*best[u][1], v)) for u in into.get(v, ()) if u in best and (u, v) in flow]
            if ways:
                best[v] = min(ways)
        reached = [best[v] for v in sinks if v in best]
        if not reached:
            return out
        path = min(reached)[1]
        steps = list(zip(path, path[1:], strict=False))
        bottleneck = min(flow[e] for e in steps)
        for e in steps:
            flow[e] -= bottleneck
            if flow[e] < max(1.0, least):
                del flow[e]
        if bottleneck >= least:
            out.append((path, bottleneck))


def flow_fit(nodes: list[tuple[float, list[tuple[int, float]]]], edges: list[tuple[int, int]], source: int = 0, sink: int = 1) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """Edge flows x >= 0 that minimise sum |a_v - sum w x_e| over nodes (a_v, [(edge, w)]), what comes into a vertex going out, but at
    source and sink; with the prices of the nodes and of the inner vertices that prove them optimal."""
    m = len(edges)
    a = np.zeros((len(nodes), m))
    b = np.array([v for v, _ in nodes])
    for i, (_, terms) in enumerate(nodes):
        for e, w in terms:
            a[i, e] += w
    inner = sorted({n for e in edges for n in e} - {source, sink})
    c = np.array([[(v == n) - (u == n) for u, v in edges] for n in inner], float).reshape(-1, m)
    x, y, z, _ = least_weighted(a, b, np.ones(len(b)), c)
    return x, y, dict(zip(inner, z.tolist(), strict=True))


def strains(nodes: dict[int, float], edges: list[tuple[int, int]], most: int, kind: int = 2) -> list[tuple[tuple[int, ...], float]]:
    """strains_together() of one graph."""
    return strains_together([(nodes, edges)], most, kind)[0]


def strains_together(graphs: list[tuple[dict[int, float], list[tuple[int, int]]]], most: int, kind: int = 2) -> list[list[tuple[tuple[int, ...], float]]]:
    """_strains() of each graph, all searches side by side: what each of them asks for is solved in one go."""
    out: list[list] = [[] for _ in graphs]
    steps = [_strains(nodes, edges, most, kind) for nodes, edges in graphs]
    answer: dict[int, tuple | None] = dict.fromkeys(range(len(graphs)))
    while answer:
        asked = {}
        for i, x in answer.items():
            try:
                asked[i] = steps[i].send(x)
            except StopIteration as end:
                out[i] = end.value
        answer, all_ = {}, sorted(asked.items(), key=lambda x: (len(x[1].b), len(x[1].a)))
        for lo in range(0, len(all_), AT_ONCE):
            number, programmes = zip(*all_[lo : lo + AT_ONCE], strict=True)
            answer |= zip(number, explained(list(programmes)), strict=True)
    return out


def _strains(nodes: dict[int, float], edges: list[tuple[int, int]], most: int, kind: int) -> Generator[_Weighted, tuple[np.ndarray, float], list[tuple[tuple[int, ...], float]]]:
    """The at most `most` source-to-sink paths of an acyclic graph, each with its abundance, that explain the nodes' abundances best:
    least sum |r| (kind 1), |r| / a (2) or |r| / sqrt(a) (3) over nodes that have any.  Nodes without an edge are paths of their own.

    Paths are not listed before: a linear programme over those found so far is priced by its dual, and the best path of the
    graph at these prices, found along the topological order, comes in until none pays (column generation).  With
    more paths than allowed in use, the search branches on the most abundant one: it is among the strains, or it is banned.  The
    programme without a limit on paths bounds a branch from below.  Programmes to be solved are yielded.
    """
    given = [(u, v) for u, v in edges if u in nodes and v in nodes]
    order = _topological(given)
    order += sorted(nodes.keys() - set(order))
    into: dict[int, list[int]] = {}
    for u, v in sorted(set(given)):
        into.setdefault(v, []).append(u)
    sinks = sorted(nodes.keys() - {u for u, _ in given})
    told = [v for v in order if nodes[v] > 0]
    row = {v: i for i, v in enumerate(told)}
    b = np.array([nodes[v] for v in told])
    weight = {1: np.ones(len(b)), 2: 1 / b, 3: 1 / np.sqrt(b)}[kind]
    pool: dict[tuple[int, ...], np.ndarray] = {}

    known: dict[tuple, tuple[np.ndarray, float]] = {}  # a branch asks again for what the one above it solved
    without: dict[frozenset, tuple[dict[tuple[int, ...], float], float]] = {}  # what relaxed() found

    def fitted(paths: list[tuple[int, ...]]):
        if (found := known.get(tuple(paths))) is None:
            if len(known) > 5000:
                known.clear()
            found = known[tuple(paths)] = yield _Weighted(b, weight, [pool[p] for p in paths])
        return found

    def best_path(price: np.ndarray, banned: frozenset) -> tuple[float, tuple[int, ...]] | None:
        """The path of the highest price that is not banned: of every node's prefixes as many are kept as could all be banned, and one."""
        upto: dict[int, list[tuple[float, tuple[int, ...]]]] = {}
        for v in order:
            own = float(price[row[v]]) if v in row else 0.0
            if not banned:
                ways = [(s - own, (*p, v)) for u in into[v] for s, p in upto[u]] if v in into else [(-own, (v,))]
                upto[v] = [min(ways)]
                continue
            ways = [(-s + own, (*p, v)) for u in into[v] for s, p in upto[u]] if v in into else [(own, (v,))]
            upto[v] = sorted((-s, p) for s, p in ways)[: len(banned) + 1]
        return min(((s, p) for v in sinks for s, p in upto[v] if p not in banned), default=None)

    def relaxed(banned: frozenset):
        if banned in without:
            return without[banned]
        paths = [p for p in pool if p not in banned]
        programme = _Weighted(b, weight, [pool[p] for p in paths])
        while True:
            x, value = yield programme
            found = best_path(programme.y, banned)
            if found is None or -found[0] <= 1e-9 or found[1] in pool:
                without[banned] = {p: f for p, f in zip(paths, x.tolist(), strict=True) if f > 1e-9}, value
                return without[banned]
            pool[found[1]] = np.array([float(v in found[1]) for v in told])
            paths.append(found[1])
            programme.add(pool[found[1]])

    best, least_value = [], float(weight @ b)

    def keep(paths: list[tuple[int, ...]]):
        nonlocal best, least_value
        x, value = yield from fitted(paths)
        if value < least_value - 1e-9:
            best, least_value = [(p, f) for p, f in zip(paths, x.tolist(), strict=True) if f > 1e-9], value

    def search(fixed: tuple, banned: frozenset):
        if len(fixed) == most:
            yield from keep(list(fixed))
            return
        x, value = yield from relaxed(banned)
        if value >= least_value - 1e-9:
            return
        free = sorted((p for p in x if p not in fixed), key=lambda p: (-x[p], p))
        yield from keep([*fixed, *free[: most - len(fixed)]])
        if len(free) > most - len(fixed):
            yield from search((*fixed, free[0]), banned)
            yield from search(fixed, banned | {free[0]})

    if most > 0:
        yield from search((), frozenset())
    return sorted(best)
