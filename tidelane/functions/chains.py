"""Forward-backward probabilities of a hidden Markov chain, for many sequences at once."""

from __future__ import annotations

import numpy as np

#: Readings whose messages are held at a time; bounds a worker's memory.
CELLS = 1 << 18


def forward_backward(emission: np.ndarray, lengths: np.ndarray, initial: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Posterior state probabilities of every reading.

    Args: ``emission`` (readings x states) holds the likelihood of each reading under each state,
    sequence after sequence; ``lengths`` the length of each sequence; ``transition[i, j]`` the
    probability of state j after state i.

    All sequences advance together one step at a time, so the Python loop runs over the longest
    sequence and not over readings.  Messages are normalised at each step, which keeps them exact.
    """
    posterior = np.empty_like(emission)
    starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        longest = int(lengths[order[at]])
        own = order[at : at + max(1, CELLS // longest)]
        at += len(own)
        _solve(emission, posterior, starts[own], lengths[own], initial, transition)
    return posterior


def _solve(emission: np.ndarray, posterior: np.ndarray, starts: np.ndarray, lengths: np.ndarray, initial: np.ndarray, transition: np.ndarray) -> None:
    longest, n, states = int(lengths[0]), len(starts), emission.shape[1]
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than each step
    ahead = np.empty((longest, n, states))
    here = emission[starts] * initial
    ahead[0] = here / here.sum(1, keepdims=True)
    for t in range(1, longest):
        k = active[t]
        here = (ahead[t - 1, :k] @ transition) * emission[starts[:k] + t]
        ahead[t, :k] = here / here.sum(1, keepdims=True)
    behind = np.ones((n, states))
    for t in range(longest - 1, -1, -1):
        k = active[t]
        if t + 1 < longest:
            m = active[t + 1]
            here = (emission[starts[:m] + t + 1] * behind[:m]) @ transition.T
            behind[:m] = here / here.sum(1, keepdims=True)
        both = ahead[t, :k] * behind[:k]
        posterior[starts[:k] + t] = both / both.sum(1, keepdims=True)
