"""Levenshtein automata intersected with a lexicon trie."""

from __future__ import annotations

from dataclasses import dataclass

#: Members of all states that are kept, about; a state itself counts as STATE members. Some 100 MB.
STATE_BOUND, STATE = 1 << 20, 4


@dataclass(frozen=True)
class Term:
    """A lexicon entry with the edits it may be met with; a stem, edits included, matches every word that begins with it."""

    text: str
    stem: bool = False
    max_edits: int = 0


class LexiconAutomaton:
    """Reads a word character by character and says which term it matches with how few edits.

    A state is the set of (trie node, edits so far, edits allowed) that the characters
    read so far can reach: the product of the trie with the Levenshtein automata of all
    its terms. States are built when first met and kept, so that a word costs one table
    lookup a character, and most words end in the empty state after a few. Beyond
    ``STATE_BOUND`` all are forgotten and built anew, so that memory does not grow with
    what is read. An allowance of the term's length is part of the state: terms of one
    allowance share a trie.
    """

    def __init__(self, terms: list[Term]) -> None:
        self.children: list[dict[str, int]] = []
        self.ends: list[tuple[int, bool] | None] = []  # (index of the term, whether a stem)
        self.terms = terms
        roots: dict[int, int] = {}
        for k, term in enumerate(terms):
            node = roots.setdefault(term.max_edits, len(self.children))
            if node == len(self.children):
                self._node()
            for c in term.text:
                node = self.children[node].get(c) or self._child(node, c)
            if self.ends[node] is None or term.stem:
                self.ends[node] = (k, term.stem)
        self.alphabet = {c for term in terms for c in term.text}
        self.first = self._closed({(root, 0, allowed) for allowed, root in roots.items()})
        self._forget()

    def _forget(self) -> None:
        """No states but the first."""
        self.state_of: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepted: list[tuple[int, int] | None] = []  # (term, edits) for a word that ends here
        self.stem_found: list[tuple[int, int] | None] = []
        self.size = 0
        self.start = self._state(self.first)

    def _node(self) -> int:
        self.children.append({})
        self.ends.append(None)
        return len(self.children) - 1

    def _child(self, node: int, c: str) -> int:
        self.children[node][c] = child = self._node()
        return child

    def _closed(self, found: set) -> frozenset:
        """With the characters of terms that a word may leave out, keeping the fewest edits of each node."""
        best: dict[tuple[int, int], int] = {}
        todo = sorted(found, key=lambda s: s[1], reverse=True)
        while todo:
            node, edits, allowed = todo.pop()
            if best.get((node, allowed), edits + 1) <= edits:
                continue
            best[node, allowed] = edits
            if edits < allowed:
                todo += [(child, edits + 1, allowed) for child in self.children[node].values()]
        return frozenset((node, edits, allowed) for (node, allowed), edits in best.items())

    def _state(self, members: frozenset) -> int:
        if members not in self.state_of:
            self.state_of[members] = len(self.members)
            self.members.append(members)
            self.size += len(members) + STATE
            self.moves.append({})
            ends = [(edits, *self.ends[node]) for node, edits, _ in members if self.ends[node] is not None]
            best = min(((e, k) for e, k, _ in ends), default=None)
            self.accepted.append(best and (best[1], best[0]))
            # A stem ends here with so many edits, and any ending may follow.
            stems = min(((e, k) for e, k, stem in ends if stem), default=None)
            self.stem_found.append(stems and (stems[1], stems[0]))
        return self.state_of[members]

    def _move(self, state: int, c: str) -> int:
        reached = set()
        for node, edits, allowed in self.members[state]:
            if c in self.children[node]:
                reached.add((self.children[node][c], edits, allowed))
            if edits < allowed:
                reached.add((node, edits + 1, allowed))
                reached.update((child, edits + 1, allowed) for child in self.children[node].values())
        return self._state(self._closed(reached))

    def match(self, word: str) -> tuple[int, int] | None:
        """(index of the term, edits) of the best match, or None. Of as many edits a stem beats a whole word."""
        if self.size > STATE_BOUND:
            self._forget()
        state, stem, alphabet = self.start, None, self.alphabet
        for c in word:
            if c not in alphabet:
                c = ""
            after = self.moves[state].get(c, -1)
            if after < 0:
                after = self.moves[state][c] = self._move(state, c)
            state = after
            if not self.members[state]:
                return stem
            found = self.stem_found[state]
            if found is not None and (stem is None or found[1] < stem[1]):
                stem = found
        whole = self.accepted[state]
        if whole is None or (stem is not None and stem[1] <= whole[1]):
            return stem
        return whole
