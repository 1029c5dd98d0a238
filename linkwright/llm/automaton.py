"""Suffix automaton over sequences of integers, grown one sequence at a time."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Accepts every run of every added sequence (Blumer et al., 1985; generalised form)."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def _clone(self, p: int, q: int, c: int) -> int:
        """A copy of q for the strings of length size[p] + 1, put between q and its link."""
        made = len(self.size)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.size.append(self.size[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = made
            p = self.link[p]
        self.link[q] = made
        return made

    def add(self, items: Sequence[int]) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for c in items:
            q = nxt[last].get(c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._clone(last, q, c)
                continue
            cur = len(size)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if size[q] == size[p] + 1 else self._clone(p, q, c)
            last = cur

    def matching_statistics(self, items: Sequence[int]) -> list[int]:
        """For each item, the length of the longest known run that ends with it."""
        nxt, link, size = self.next, self.link, self.size
        state, length, out = 0, 0, []
        for c in items:
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = nxt[state].get(c)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            out.append(length)
        return out
