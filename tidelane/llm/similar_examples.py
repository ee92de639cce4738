"""Exact TF-IDF cosine search over a bounded set of labelled passages, by a block-max inverted index."""

from __future__ import annotations

import numpy as np

from tidelane.llm.passages import grams

#: Most blocks of entries, and most pairs of term and block: upper bounds and pointers take 8 bytes a pair, so 128 MB.
MOST_BLOCKS = 2048
MOST_PAIRS = 1 << 24
#: Length of the vectors by which entries are put in order.
SKETCH = 64
#: Blocks that a query reads first; those that can still matter then are read together.
FIRST = 32
#: Queries searched together, and places of the lists looked up at a time.
TOGETHER = 256
LOOKUPS = 1 << 15
#: Entries whose cosine is below this share of the best are no neighbours.
SHARE = 0.5


def vocabulary(entries: list[str]) -> np.ndarray:
    """Sorted distinct n-grams of the entries."""
    return np.unique(grams(entries)[0]) if entries else np.zeros(0, np.uint64)


def known_terms(texts: list[str], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term number, count) of the n-grams of each text that are in ``terms``, and the number of all others per text as (text) rows."""
    gram, owner = grams(texts)
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), owner
    at = np.minimum(np.searchsorted(terms, gram), len(terms) - 1)
    hit = terms[at] == gram
    pair, count = np.unique(owner[hit] * len(terms) + at[hit], return_counts=True)
    other = np.unique(np.c_[owner[~hit].astype(np.uint64), gram[~hit]], axis=0) if (~hit).any() else np.zeros((0, 2), np.uint64)
    return pair // len(terms), pair % len(terms), count.astype(float), other[:, 0].astype(np.int64)


def similar_order(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, width: int) -> np.ndarray:
    """The entries in an order in which each ``width`` successive ones are alike.

    Entries become short vectors (signed sums of their weights by the hash of the term), and a set of them is halved along
    the line between the means of its two sides, again and again.
    """
    mixed = (np.arange(int(term.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    vector = np.empty((n, SKETCH), np.float32)
    for d in range(SKETCH):
        vector[:, d] = np.bincount(row, np.where((mixed >> np.uint64(d)) & np.uint64(1), 1.0, -1.0)[term] * weight, minlength=n)
    out, todo = [], [np.arange(n)]
    while todo:
        part = todo.pop()
        if len(part) <= width:
            out.append(part)
            continue
        own = vector[part]
        far = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
        line = own[((own - far) ** 2).sum(1).argmax()] - far
        for _ in range(3):
            side = own @ line
            high = side > (side.max() + side.min()) / 2
            if not high.any() or high.all():
                break
            line = own[high].mean(0) - own[~high].mean(0)
        order = np.argsort(own @ line, kind="stable")
        half = -(-len(part) // (2 * width)) * width
        todo += [part[order[half:]], part[order[:half]]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class BlockMaxIndex:
    """Inverted lists of the entries' TF-IDF weights, with the largest weight of each term in each block.

    Entries are put in an order in which similar ones share blocks, so bounds are tight.  A query reads blocks in the order
    of their bound and leaves out those that can reach neither its k-th best nor ``SHARE`` of its best: the result is exact.

    Memory: 12 bytes for each n-gram of each entry, and 8 for each pair of term and block.  Whoever fits the index
    bounds the n-grams of the entries; the pairs are at most ``MOST_PAIRS``, or the terms if they are more.
    """

    def __init__(self, entries: list[str], terms: np.ndarray, seen: np.ndarray, total: int) -> None:
        """``seen`` is how many of ``total`` corpus passages hold each term."""
        self.entries, self.terms = entries, terms
        self.idf = np.log((total + 1) / (seen + 1)) + 1 if len(terms) else np.zeros(0)
        self.unseen = float(np.log(total + 1) + 1)
        row, term, count, _ = known_terms(entries, terms)
        weight = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(entries)))
        weight = weight / np.maximum(norm[row], 1e-12)
        self.width = max(1, -(-len(entries) // max(1, min(MOST_BLOCKS, MOST_PAIRS // max(1, len(terms))))))
        self.blocks = max(1, -(-len(entries) // self.width))
        # Which entry stands at each place of the lists.
        self.entry = similar_order(row, term, weight, len(entries), self.width)
        place = np.empty(len(entries), np.int64)
        place[self.entry] = np.arange(len(entries))
        row = place[row]
        block = row // self.width
        order = np.lexsort((row, term))
        self.row, self.weight = row[order].astype(np.int32), weight[order].astype(np.float32)
        self.cell = (term[order] * self.blocks + block[order]).astype(np.int32)
        self._bounds()

    def _bounds(self) -> None:
        """Start of each pair of term and block in the lists, and the largest weight there."""
        pairs = len(self.terms) * self.blocks
        self.pointer = np.concatenate(([0], np.cumsum(np.bincount(self.cell, minlength=pairs)))).astype(np.int32)
        self.most = np.zeros(pairs, np.float32)
        np.maximum.at(self.most, self.cell, self.weight)
        self.most = self.most.reshape(len(self.terms), self.blocks)

    def __getstate__(self) -> dict:
        """The lists alone travel; bounds are made again where they arrive."""
        return {k: v for k, v in self.__dict__.items() if k not in ("pointer", "most")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._bounds()

    def nearest(self, texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest entries of each text and their cosines (-1 and 0 where there are fewer)."""
        found, score = np.full((len(texts), k), -1, np.int64), np.zeros((len(texts), k))
        if not texts or not len(self.terms):
            return found, score
        row, term, count, other = known_terms(texts, self.terms)
        weight = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(texts)) + np.bincount(other, minlength=len(texts)) * self.unseen**2)
        weight = (weight / norm[row]).astype(np.float32)
        start = np.searchsorted(row, np.arange(len(texts) + 1))
        some = np.flatnonzero(np.diff(start))
        for i in range(0, len(some), TOGETHER):
            query = some[i : i + TOGETHER]
            q, entry, cosine = self._search(start[query], np.diff(start)[query], term, weight, k)
            place = np.arange(len(q)) - np.searchsorted(q, q)
            found[query[q], place], score[query[q], place] = entry, cosine
        return found, score

    def _search(self, start: np.ndarray, size: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, cosine) of the neighbours of some queries, best first; a query's terms are ``size`` ones from ``start``."""
        bound = np.empty((len(start), self.blocks), np.float32)
        for q, (a, n) in enumerate(zip(start, size, strict=True)):
            np.matmul(weight[a : a + n], self.most[term[a : a + n]], out=bound[q])
        first = np.argpartition(-bound, FIRST, axis=1)[:, :FIRST] if self.blocks > FIRST else np.tile(np.arange(self.blocks), (len(start), 1))
        q, block = np.repeat(np.arange(len(start)), first.shape[1]), first.ravel()
        possible = bound[q, block] > 0
        near = self._best(*self._score(q[possible], block[possible], start, size, term, weight), k)
        # What a block must reach to matter; a bound is a float32 sum, the margin keeps rounding from hiding an entry.
        least = np.full(len(start), 1e-5)
        best, count = np.unique(near[0], return_index=True)[1], np.bincount(near[0], minlength=len(start))
        least[near[0][best]] = near[2][best] * SHARE
        full = count[near[0][best]] >= k
        least[near[0][best[full]]] = np.maximum(least[near[0][best[full]]], near[2][best[full] + k - 1])
        np.put_along_axis(bound, first, 0, axis=1)
        q, block = np.nonzero((bound > 0) & (bound + 1e-5 >= least[:, None]))
        if not len(q):
            return near
        more = self._score(q, block, start, size, term, weight)
        return self._best(*(np.concatenate(x) for x in zip(near, more, strict=True)), k)

    def _score(self, q: np.ndarray, block: np.ndarray, start: np.ndarray, size: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, cosine) of all entries of the given blocks that share a term with the query."""
        out = []
        upto = np.cumsum(size[q])
        at = 0
        while at < len(q):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LOOKUPS, side="right")))
            qs, blocks, n = q[at:end], block[at:end], size[q[at:end]]
            pair = np.repeat(np.arange(len(qs)), n)
            place = np.arange(len(pair)) + np.repeat(start[qs] - np.cumsum(n) + n, n)
            cell = term[place] * self.blocks + blocks[pair]
            low = self.pointer[cell]
            held = self.pointer[cell + 1] - low
            hit = np.flatnonzero(held)
            low, held, pair = low[hit], held[hit], pair[hit]
            posting = np.arange(held.sum()) + np.repeat(low - np.cumsum(held) + held, held)
            slot = np.repeat((pair - blocks[pair]) * self.width, held) + self.row[posting]
            sums = np.bincount(slot, np.repeat(weight[place[hit]], held) * self.weight[posting], minlength=len(qs) * self.width)
            some = np.flatnonzero(sums)
            out.append((qs[some // self.width], self.entry[blocks[some // self.width] * self.width + some % self.width], sums[some]))
            at = end
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    @staticmethod
    def _best(q: np.ndarray, entry: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each query that have ``SHARE`` of its best, by query and cosine; ties go to the earlier entry."""
        if not len(q):
            return q, entry, cosine
        top = np.zeros(int(q.max()) + 1)
        np.maximum.at(top, q, cosine)
        near = np.flatnonzero(cosine >= top[q] * SHARE)
        order = near[np.lexsort((entry[near], -cosine[near], q[near]))]
        q, entry, cosine = q[order], entry[order], cosine[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[keep], entry[keep], cosine[keep]
