"""The cheapest repair of a sequence of turns, by the auction algorithm for shortest paths.

Turns must spell ``(s?(ua)+)?`` by the initials of their roles. A node of the lattice is (rows done,
state): nothing yet, after s, after u, after a. An edit is an arc with a whole-number cost. Every node
has a price that never exceeds an arc's cost plus the price at its end. The path from an origin is
extended along arcs without slack; where there is none the end's price rises to its cheapest arc and
the path is shortened by it. A path that meets a node of known distance gives the distances of all its
nodes, so origins are taken from the last row to the first and the prices they leave are used again.
In the end every price is a distance, arcs without slack are the cheapest repairs, and following the
least letter at each node spells the least repair.
"""

from __future__ import annotations

import math

STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
FINE, MUST_GO, TRUNCATED = range(3)
FAULTS = 3
INITIALS = "sua"  # by number; 3 is any other
FORCED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
ACCEPTED = (0, None, None, 0)  # what leaving the last row costs, by state; None: not allowed
LEGAL_PAIRS = frozenset({(0, 1), (1, 2), (2, 1)})
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5

Arc = tuple[str, int, int]  # letter, cost, distance to the node at its end


def symbol(initial: int, fault: int) -> int:
    return initial * FAULTS + fault


def after_keep(state: int, initial: int) -> int | None:
    """The state after a turn with this initial, if it may stand there."""
    if initial == 0:
        return SYSTEM if state == START else None
    following = {1: USER, 2: ASSISTANT}.get(initial)
    return following if following == FORCED[state] else None


def _arcs(initial: int, fault: int, state: int) -> list[Arc]:
    """The edits at a row, in the order of their letters."""
    on = STATES - state
    arcs = [("D", DELETE, on + state), ("I", INSERT, FORCED[state] - state)]
    if fault != MUST_GO:
        more = UNFINISHED if fault == TRUNCATED else 0
        kept = after_keep(state, initial)
        if kept is not None:
            arcs.append(("K", more, on + kept))
        arcs.append(("R", REROLE + more, on + FORCED[state]))
    return arcs


ARCS = [
    [_arcs(code // FAULTS, code % FAULTS, state) for state in range(STATES)]
    for code in range(4 * FAULTS)
]


class Lattice:
    """Nodes are numbered STATES * rows done + state; ``exits`` is what leaving the last row costs by
    state (whole numbers from 0, None: not allowed). Only in the last block of a sequence turns may
    still be inserted behind the last row (``last``); elsewhere the next block does that."""

    def __init__(self, rows: bytes, exits=ACCEPTED, last: bool = True):
        self.rows, self.exits, self.last = rows, exits, last
        self.price: list[float] = [0] * (STATES * (len(rows) + 1))
        self._settle()

    def _ends(self, state: int) -> list[Arc]:
        """Arcs behind the last row."""
        return [("I", INSERT, FORCED[state] - state)] if self.last and self._closes(state) else []

    def _closes(self, state: int) -> bool:
        return any(self.exits[s] is not None for s in (USER, ASSISTANT))

    def _settle(self) -> None:
        price, rows, n = self.price, self.rows, len(self.rows)
        settled = bytearray(len(price))
        # Where neither user nor assistant may end, nothing that inserts them can; then those states
        # lead nowhere and are left out, so that no cycle of insertions is without an end.
        dead = () if self._closes(USER) else (USER, ASSISTANT)
        for node in range(len(price)) if dead else ():
            if node % STATES in dead:
                price[node], settled[node] = math.inf, 1
        for origin in range(len(price) - 1, -1, -1):
            if origin % STATES == STATES - 1 and origin < STATES * n:
                # Every way goes on over the next row's nodes: their least distance bounds these.
                below = DELETE if rows[origin // STATES] % FAULTS else 0
                below += min(price[origin + 1 : origin + 1 + STATES])
                for node in range(origin + 1 - STATES, origin + 1):
                    price[node] = max(price[node], below)
            path = [origin]
            while not settled[path[-1]]:
                node = path[-1]
                row, state = divmod(node, STATES)
                if row < n:
                    least, to = math.inf, -1
                    arcs = ARCS[rows[row]][state]
                else:
                    out = self.exits[state]
                    least, to = (math.inf, -1) if out is None else (out, -2)
                    arcs = self._ends(state)
                for _, cost, step in arcs:
                    if cost + price[node + step] < least:
                        least, to = cost + price[node + step], node + step
                if price[node] < least:  # raise the price, shorten the path
                    price[node] = least
                    if least == math.inf:
                        settled[node] = 1
                    if node != origin:
                        path.pop()
                elif to == -2:  # the sink
                    break
                else:
                    path.append(to)
            for node in path:
                settled[node] = 1

    def distance(self, state: int) -> int | None:
        """The least cost from before the first row, None where there is no way."""
        return None if self.price[state] == math.inf else int(self.price[state])

    def repair(self, state: int) -> tuple[str, int]:
        """The least letters among the cheapest edits, and the state they end in."""
        letters: list[str] = []
        price, rows, n, node = self.price, self.rows, len(self.rows), state
        while True:
            row, state = divmod(node, STATES)
            if row == n and self.exits[state] == price[node]:
                return "".join(letters), state
            for letter, cost, step in ARCS[rows[row]][state] if row < n else self._ends(state):
                if price[node] == cost + price[node + step]:
                    letters.append(letter)
                    node += step
                    break


def crossing(rows: bytes) -> list[list[int | None]]:
    """Least cost from each state before a block to each state behind it."""
    out: list[list[int | None]] = [[None] * STATES for _ in range(STATES)]
    for leave in range(STATES):
        exits = [0 if s == leave else None for s in range(STATES)]
        lattice = Lattice(rows, exits, last=False)
        for enter in range(STATES):
            out[enter][leave] = lattice.distance(enter)
    return out
