"""Combined deterministic automata: regexes to transition arrays.

A rule's regex (bytes, no anchors, no back-references, greedy repeats) becomes a
Thompson automaton; subset construction over classes of bytes that no rule tells
apart makes it deterministic; partition refinement makes it minimal.
"""

from __future__ import annotations

import re._parser as syntax
from dataclasses import dataclass

import numpy as np


class _Nfa:
    def __init__(self) -> None:
        self.eps: list[list[int]] = []
        self.move: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.move.append(None)
        return len(self.eps) - 1


def _members(items, ignore_case: bool) -> frozenset[int]:
    out: set[int] = set()
    negate = False
    for op, arg in items:
        if op is syntax.NEGATE:
            negate = True
        elif op is syntax.LITERAL:
            out.add(arg)
        elif op is syntax.RANGE:
            out.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"not supported in a rule: {op}")
    if ignore_case:
        out |= {c ^ 32 for c in out if 65 <= (c & ~32) <= 90}
    return frozenset(set(range(256)) - out if negate else out)


def _add(nfa: _Nfa, tree, start: int, ignore_case: bool) -> int:
    """Adds ``tree`` from state ``start``; returns the state after it."""
    at = start
    for op, arg in tree:
        if op is syntax.LITERAL or op is syntax.IN:
            to = nfa.state()
            here = nfa.state()
            nfa.eps[at].append(here)
            nfa.move[here] = (_members([(op, arg)] if op is syntax.LITERAL else arg, ignore_case), to)
            at = to
        elif op is syntax.SUBPATTERN:
            _, on, off, inner = arg
            at = _add(nfa, inner, at, (ignore_case or bool(on & syntax.SRE_FLAG_IGNORECASE)) and not off & syntax.SRE_FLAG_IGNORECASE)
        elif op is syntax.BRANCH:
            end = nfa.state()
            for option in arg[1]:
                begin = nfa.state()
                nfa.eps[at].append(begin)
                nfa.eps[_add(nfa, option, begin, ignore_case)].append(end)
            at = end
        elif op is syntax.MAX_REPEAT:
            least, most, inner = arg
            for _ in range(least):
                at = _add(nfa, inner, at, ignore_case)
            if most is syntax.MAXREPEAT:
                loop, end = nfa.state(), nfa.state()
                nfa.eps[at] += [loop, end]
                nfa.eps[_add(nfa, inner, loop, ignore_case)] += [loop, end]
                at = end
            else:
                end = nfa.state()
                for _ in range(most - least):
                    nfa.eps[at].append(end)
                    at = _add(nfa, inner, at, ignore_case)
                nfa.eps[at].append(end)
                at = end
        else:
            raise ValueError(f"not supported in a rule: {op}")
    return at


@dataclass
class Dfa:
    """``table[state * n_classes + class]``; states from ``first_accept`` on accept, ``masks`` says which rules."""

    table: np.ndarray
    classes: np.ndarray
    n_classes: int
    masks: np.ndarray
    first_accept: int
    start: int
    dead: int


def plain(dfa: Dfa) -> tuple:
    """The fields alone, for a broadcast that is read where this class may not be."""
    return dfa.table, dfa.classes, dfa.n_classes, dfa.masks, dfa.first_accept, dfa.start, dfa.dead


def compile_rules(regexes: list[bytes], anchored: bool) -> Dfa:
    """Automaton of all rules; unanchored, it tells at each byte which rules have a match that ends there."""
    nfa = _Nfa()
    root = nfa.state()
    accept: dict[int, int] = {}
    for k, rx in enumerate(regexes):
        begin = nfa.state()
        nfa.eps[root].append(begin)
        accept[_add(nfa, syntax.parse(rx), begin, False)] = 1 << k

    sets = {m[0] for m in nfa.move if m}
    kinds: dict[tuple, int] = {}
    classes = np.zeros(256, np.uint8)
    for b in range(256):
        classes[b] = kinds.setdefault(tuple(b in s for s in sets), len(kinds))
    of_class = {c: b for b, c in reversed(list(enumerate(classes.tolist())))}
    n = len(kinds)

    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, todo = {state}, [state]
            while todo:
                for t in nfa.eps[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            closures[state] = frozenset(x for x in seen if nfa.move[x] or x in accept)
        return closures[state]

    begin = closure(root)
    number, order, rows = {begin: 0}, [begin], []
    for s in order:  # grows while it is walked
        row = []
        for c in range(n):
            to: set[int] = set() if anchored else set(begin)
            for x in s:
                m = nfa.move[x]
                if m and of_class[c] in m[0]:
                    to |= closure(m[1])
            key = frozenset(to)
            if key not in number:
                number[key] = len(order)
                order.append(key)
            row.append(number[key])
        rows.append(row)
    trans = np.array(rows)
    masks = np.array([sum({accept[x] for x in s if x in accept}) for s in order], np.int64)

    # partition refinement: equal masks, then equal blocks after every class
    block = np.unique(masks, return_inverse=True)[1]
    while True:
        sig = np.column_stack([block, block[trans]])
        new = np.unique(sig, axis=0, return_inverse=True)[1].reshape(-1)
        if new.max() == block.max():
            break
        block = new
    count = block.max() + 1
    pick = np.zeros(count, np.int64)
    pick[block[::-1]] = np.arange(len(block))[::-1]
    rank = np.argsort(masks[pick] > 0, kind="stable")  # those that accept come last
    new_of = np.empty(count, np.int64)
    new_of[rank] = np.arange(count)
    masks = masks[pick][rank]
    table = new_of[block[trans[pick[rank]]]]
    dead = next((i for i in range(count) if masks[i] == 0 and (table[i] == i).all()), -1)
    return Dfa(table.astype(np.int32).reshape(-1), classes, n, masks, int((masks == 0).sum()), int(new_of[block[0]]), dead)


def scan_ends(dfa: Dfa, data: np.ndarray, lane: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions after which the automaton accepts, their masks, bytes that no rule uses) of ``data``.

    One pass over the bytes, in lanes that advance together. Lanes are cut after
    bytes that bring every state back to the start, so cutting changes nothing.
    """
    cls = dfa.classes[data]
    table = dfa.table.reshape(-1, dfa.n_classes)
    resets = np.flatnonzero((table == dfa.start).all(axis=0))
    free = np.flatnonzero(np.isin(cls, resets))
    want = np.arange(lane, len(data), lane)
    at = np.searchsorted(free, want)
    cuts = np.unique(free[at[at < len(free)]]) + 1
    starts = np.concatenate([[0], cuts[cuts < len(data)]])
    sizes = np.diff(np.concatenate([starts, [len(data)]]))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    state = np.full(len(starts), dfa.start, np.int32)
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right") if len(sizes) and len(data) else []
    ends, masks = [], []
    for i, k in enumerate(alive):
        pos = starts[:k] + i
        s = dfa.table[state[:k] * dfa.n_classes + cls[pos]]
        state[:k] = s
        hit = s >= dfa.first_accept
        if hit.any():
            ends.append(pos[hit])
            masks.append(dfa.masks[s[hit]])
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.int64), free
    return np.concatenate(ends), np.concatenate(masks), free


def longest_matches(dfa: Dfa, piece: bytes) -> list[tuple[int, int]]:
    """Leftmost-longest matches of an anchored automaton that don't overlap."""
    out, pos, n = [], 0, len(piece)
    cls, table, k = dfa.classes, dfa.table, dfa.n_classes
    codes = cls[np.frombuffer(piece, np.uint8)].tolist()
    rows = table.reshape(-1, k).tolist()
    while pos < n:
        s, last, j = dfa.start, -1, pos
        while j < n:
            s = rows[s][codes[j]]
            if s == dfa.dead:
                break
            j += 1
            if s >= dfa.first_accept:
                last = j
        if last > pos:
            out.append((pos, last))
            pos = last
        else:
            pos += 1
    return out
