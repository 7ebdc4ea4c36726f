"""A weighted backoff automaton over numbered words: states, arcs, failure arcs and the walk.

A state is a context that was seen: none (the root, state 0), one word, or two. ``arcs`` are
sorted by (state, word); each has a weight and the state it leads to, the longest seen context
that ends in its word. A state other than the root has a failure arc to the state of its
context without the first word. The root has an arc for every word.
"""

from __future__ import annotations

import numpy as np

#: Tokens that one cursor of a walk reads; a longer text is read by several, each of which
#: starts in the state that the two words before it lead to.
SPAN = 512
ROOT = 0


class Automaton:
    def __init__(self, words: int, arcs: np.ndarray, weights: np.ndarray, targets: np.ndarray, fail: np.ndarray, fail_weights: np.ndarray):
        """``arcs``: state * words + word, each once, in any order."""
        order = np.argsort(arcs)
        self.words, self.arcs = words, arcs[order]
        self.weights, self.targets = weights[order], targets[order].astype(np.int32)
        self.fail, self.fail_weights = fail.astype(np.int32), fail_weights

    def read(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One word read in each state: the weights of the arcs followed, failure arcs included,
        and the states reached."""
        states, total = states.copy(), np.zeros(len(states))
        reached = np.empty(len(states), np.int32)
        left = np.arange(len(states))
        while len(left):
            asked = states[left].astype(np.int64) * self.words + words[left]
            place = np.minimum(np.searchsorted(self.arcs, asked), len(self.arcs) - 1)
            has = self.arcs[place] == asked
            total[left[has]] += self.weights[place[has]]
            reached[left[has]] = self.targets[place[has]]
            left = left[~has]
            total[left] += self.fail_weights[states[left]]
            states[left] = self.fail[states[left]]
        return total, reached

    def walk(self, tokens: np.ndarray, at: np.ndarray, sizes: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Reads ``sizes`` tokens from each place in ``at``, from left to right, all cursors a token at
        a time, starting in ``states``. Returns the sum of the weights on each cursor's path."""
        order = np.argsort(-sizes)
        at, state, total = at[order], states[order].astype(np.int32), np.zeros(len(at))
        open_at = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")  # cursors with more than t tokens
        for t, n in enumerate(open_at):
            weight, state[:n] = self.read(state[:n], tokens[at[:n] + t])
            total[:n] += weight
        out = np.empty(len(at))
        out[order] = total
        return out


def spans(sizes: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts texts that lie end to end into spans: the text, the place and the tokens of each."""
    pieces = -(-sizes // span)
    text = np.repeat(np.arange(len(sizes)), pieces)
    inside = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * span
    return text, (np.cumsum(sizes) - sizes)[text] + inside, np.minimum(span, sizes[text] - inside)
