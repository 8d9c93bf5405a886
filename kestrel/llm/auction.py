"""Cheapest edits of a conversation by the auction algorithm for shortest paths.

The lattice has a node for each number of rows consumed and each state of what
stands so far: 0 nothing, 1 after a system row, 2 after a user row, 3 after an
assistant row.  Edits are arcs of integer cost: D(elete) a row 3, K(eep) it 0, R(erole)
it to user or assistant 2, I(nsert) a user or assistant row 2; a truncated row that
stays costs 1 more.  The state fixes which role may follow, so the letters of a path
name it.

The auction keeps a price for each node and a path from the source.  At the path's
end ``i`` with arcs ``(i, j)``: if the price of ``i`` is below the least of cost plus the price of
``j``, it is raised to it and the path contracts by a node; else the path is extended to the
best ``j``.  Every arc into a node off the target's reach is left out, so it ends; then
the prices on the path are distances.  Prices stay valid for other sources, and every
shortest path runs over arcs that are tight (price of tail = cost + price of
head): they are traced in the order of their letters, after the auction has raised the
head's price to its distance.

A row is a letter: s, u, a its role's initial (o: any other), in upper case when truncated,
x when it must go.  Long conversations are cut into segments of ``SEGMENT`` rows; the auction
gives each segment's cheapest path between any two states, and segments are joined by
cost, then by the order of their letters.  Paths of one segment end with
the letter of its last row, so none is the start of another and the order of the
whole is that of the parts.
"""

from __future__ import annotations

from functools import lru_cache

STATES = 4
SEGMENT = 16
DIRECT = 64                        # rows that are solved as one lattice
UNREACHED = 1 << 60
_STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})     # state: role initial -> state
_ENDS = (0, 3)                     # states that a conversation may end in

Arc = tuple[str, int, int]


def lattice(letters: str, goal: bool) -> list[list[Arc]]:
    """The arcs (letter, cost, head) of each node, in the order of their letters.
    With ``goal`` rows may be inserted after the last one, and a last node is reached
    from the states that may end."""
    n = len(letters)
    arcs: list[list[Arc]] = []
    for i in range(n + 1):
        letter = letters[i] if i < n else ""
        extra = int(letter.isupper())
        for q, step in enumerate(_STEP):
            node, out = STATES * i + q, []
            roles = [step[r] for r in "ua" if r in step]
            if i == n and goal and q in _ENDS:
                out.append(("", 0, STATES * (n + 1)))
            if i < n:
                out.append(("D", 3, node + STATES))
            if i < n or goal:
                out += [("I", 2, STATES * i + to) for to in roles]
            if letter not in ("", "x"):
                if letter.lower() in step:
                    out.append(("K", extra, STATES * (i + 1) + step[letter.lower()]))
                out += [("R", 2 + extra, STATES * (i + 1) + to) for to in roles]
            arcs.append(out)
    return arcs + [[]] if goal else arcs


class Auction:
    """Prices of the nodes for one target."""

    def __init__(self, arcs: list[list[Arc]], target: int):
        back: list[list[int]] = [[] for _ in arcs]
        for i, out in enumerate(arcs):
            for _, _, j in out:
                back[j].append(i)
        self.reach, todo = {target}, [target]
        while todo:
            for i in back[todo.pop()]:
                if i not in self.reach:
                    self.reach.add(i)
                    todo.append(i)
        self.target = target
        self.arcs = [[a for a in out if a[2] in self.reach] for out in arcs]
        self.price = [0] * len(arcs)
        self.settled = {target}          # nodes whose price is their distance

    def distance(self, source: int) -> int:
        """Extend and contract a path from ``source`` until it reaches a settled node."""
        if source not in self.reach:
            return UNREACHED
        price, arcs, settled, path = self.price, self.arcs, self.settled, [source]
        while (i := path[-1]) not in settled:
            best = UNREACHED
            for _, cost, j in arcs[i]:
                if cost + price[j] < best:
                    best, to = cost + price[j], j
            if price[i] < best:
                price[i] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        settled.update(path)
        return price[source]

    def trace(self, source: int) -> str:
        """The least letters of the shortest paths from ``source``."""
        self.distance(source)
        out, i = [], source
        while i != self.target:
            for letter, cost, j in self.arcs[i]:
                # a price is at most the distance: an arc that is not tight now never is
                if cost + self.price[j] == self.price[i] and cost + self.distance(j) == self.price[i]:
                    out.append(letter)
                    i = j
                    break
        return "".join(out)


@lru_cache(maxsize=1 << 16)
def direct(letters: str) -> str:
    """The cheapest edits of a whole conversation, the least among equals."""
    return Auction(lattice(letters, True), STATES * (len(letters) + 1)).trace(0)


@lru_cache(maxsize=STATES)
def ending(state: int) -> tuple[int, str]:
    """The cost and letters of what must be inserted after the last row."""
    auction = Auction(lattice("", True), STATES)
    return auction.distance(state), auction.trace(state)


#: the cost from each state to each, and the order of the letters by state of origin
Element = tuple[list[list[int]], list[list[int]]]


@lru_cache(maxsize=1 << 12)
def segment(letters: str) -> tuple[Element, list[list[str]]]:
    """The element of a few rows, and the letters of its paths."""
    arcs, n = lattice(letters, False), len(letters)
    ends = [Auction(arcs, STATES * n + e) for e in range(STATES)]
    cost = [[a.distance(q) for a in ends] for q in range(STATES)]
    path = [[a.trace(q) if cost[q][e] < UNREACHED else "" for e, a in enumerate(ends)] for q in range(STATES)]
    return (cost, [_order(cost[q], path[q]) for q in range(STATES)]), path


def _order(cost: list[int], names: list) -> list[int]:
    """The place of each reached end in the order of the names; others come last."""
    order = sorted(range(STATES), key=lambda e: (cost[e] >= UNREACHED, names[e] if cost[e] < UNREACHED else names[0]))
    return [order.index(e) for e in range(STATES)]


def forward(elements: list[Element], entry: int) -> tuple[list[int], list[int], list[list[int]]]:
    """From ``entry`` through the elements: the cost of each end, the place of each end in the
    order of letters, and after each element the state that each end was reached from."""
    cost = [0 if q == entry else UNREACHED for q in range(STATES)]
    order, back = list(range(STATES)), []
    for costs, orders in elements:
        came, total, names = [], [], []
        for e in range(STATES):
            m = min(range(STATES), key=lambda m: (min(cost[m] + costs[m][e], UNREACHED), order[m]))
            came.append(m)
            total.append(min(cost[m] + costs[m][e], UNREACHED))
            names.append((order[m], orders[m][e]))
        cost, order = total, _order(total, names)
        back.append(came)
    return cost, order, back


def joined(elements: list[Element]) -> Element:
    """The element of several, one after another."""
    ways = [forward(elements, q) for q in range(STATES)]
    return [w[0] for w in ways], [w[1] for w in ways]


def states(elements: list[Element], entry: int, last: int | None = None) -> list[int]:
    """The states before each element and after the last one, on the best path from
    ``entry`` to ``last``; without ``last`` to the end of the conversation."""
    cost, order, back = forward(elements, entry)
    if last is None:
        last = min(range(STATES), key=lambda e: (cost[e] + ending(e)[0], order[e]))
    out = [last]
    for came in reversed(back):
        out.append(came[out[-1]])
    return out[::-1]


def segments(letters: str) -> list[str]:
    return [letters[i:i + SEGMENT] for i in range(0, len(letters), SEGMENT)]


def element(letters: str) -> Element:
    return joined([segment(s)[0] for s in segments(letters)])


def edits(letters: str, entry: int = 0, last: int | None = None, ends: bool = True) -> str:
    """The cheapest edits of rows from state ``entry`` to ``last``, or of the rest of a
    conversation; with ``ends`` its closing insertions follow."""
    if entry == 0 and last is None and len(letters) <= DIRECT:
        return direct(letters)
    parts = segments(letters)
    way = states([segment(s)[0] for s in parts], entry, last)
    found = [segment(s)[1][q][e] for s, q, e in zip(parts, way, way[1:])]
    return "".join(found) + (ending(way[-1])[1] if ends else "")


def walk(letters: str, audit: str, entry: int = 0) -> list[tuple[str, int | None, str | None]]:
    """For each edit its letter, the number of its row (None: inserted) and the new role
    (None: as it was)."""
    out, row, state = [], 0, entry
    for edit in audit:
        role = None
        if edit == "K":
            state = _STEP[state][letters[row].lower()]
        elif edit != "D":
            role = "assistant" if state == 2 else "user"
            state = 3 if state == 2 else 2
        out.append((edit, None if edit == "I" else row, role))
        row += edit != "I"
    return out


def cost_of(letters: str, audit: str) -> int:
    """What the edits cost."""
    total, row = 0, 0
    for edit in audit:
        total += {"K": 0, "R": 2, "I": 2, "D": 3}[edit]
        if edit in "KR":
            total += letters[row].isupper()
        row += edit != "I"
    return total
