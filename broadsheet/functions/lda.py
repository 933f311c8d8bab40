"""Variational inference of topic shares (LDA) over batches of word counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CELLS = 1 << 15  # words of the articles that are worked on together
TOLERANCE = 1e-3  # mean change of an article's parameters in a step that ends its inference
FAST_STEPS = 500  # steps that may be extrapolated
# articles are grouped by numbers of words up to a ratio; those slow to settle are grouped again, more widely, until all have
ROUNDS = ((1.3, 8), (1.5, 24), (2, 48), (4, 96), (8, np.inf))


def digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    i = 1 / (y * y)
    low = sum(1 / (x + j) for j in range(6))
    return np.log(y) - 0.5 / y - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i / 240))) - low


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    i = 1 / (y * y)
    low = sum(1 / (x + j) ** 2 for j in range(6))
    return 1 / y + i / 2 + i / y * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30))) + low


def expected_log(x: np.ndarray, axis: int) -> np.ndarray:
    """Mean logarithm of the shares that Dirichlet parameters along an axis stand for."""
    return digamma(x) - digamma(x.sum(axis, keepdims=True))


def term_weights(model: np.ndarray) -> np.ndarray:
    """Weights by term and topic that a model, parameters by topic and term, stands for."""
    out = np.empty(model.shape[::-1])
    total = digamma(model.sum(1)) if len(out) else 0
    for lo in range(0, len(out), CELLS):  # the model may be large, what is worked out on the way need not be
        out[lo : lo + CELLS] = np.exp(digamma(model[:, lo : lo + CELLS].T) - total)
    return out


def new_prior(prior: np.ndarray, mean_log: np.ndarray, articles: float) -> np.ndarray:
    """One Newton step of the articles' prior towards the mean logarithm of their shares."""
    gradient = articles * (mean_log - expected_log(prior, 0))
    c, q = articles * trigamma(prior.sum()), -articles * trigamma(prior)
    step = (gradient - (gradient / q).sum() / (1 / c + (1 / q).sum())) / q
    return prior - step if (prior - step > 0).all() else prior


def _alike(rows: np.ndarray, sizes: np.ndarray, ratio: float) -> Iterator[np.ndarray]:
    """The rows in groups of similar numbers of words."""
    rows = rows[np.argsort(sizes[rows], kind="stable")]
    ranked, lo = sizes[rows], 0
    while lo < len(rows):
        hi = np.searchsorted(ranked, ratio * ranked[lo] + 2, "right")
        hi = min(hi, lo + max(1, CELLS // ranked[hi - 1]))
        yield rows[lo:hi]
        lo = hi


def _settle(weights: np.ndarray, counts: np.ndarray, prior: np.ndarray, now: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Dirichlet parameters (topic, article) at which the inference of each article stands still, and where it does.

    ``weights`` are by topic, word and article, ``counts`` by word and article. Every other step is extrapolated
    from the two before it; an article is done when a plain step changes it by no more than the tolerance. After
    ``most`` extrapolations the articles not done yet are given back as they are.
    """
    prior = prior[:, None]
    at = np.arange(counts.shape[1])
    out, ended = np.empty((len(prior), len(at))), np.zeros(len(at), bool)

    def step(now: np.ndarray) -> np.ndarray:
        shares = np.exp(digamma(now))
        total, part = weights[0] * shares[0], np.empty_like(counts)
        for t in range(1, len(shares)):
            total += np.multiply(weights[t], shares[t], out=part)
        total += 1e-100
        np.divide(counts, total, out=total)
        for t in range(len(shares)):
            shares[t] *= np.multiply(weights[t], total, out=part).sum(0)
        return prior + shares

    steps = 0
    while True:
        then = step(now)
        moved = then - now
        done = ended[at] | (np.abs(moved).mean(0) < TOLERANCE)
        fresh = np.flatnonzero(done > ended[at])
        # the first time counts, so that an article's result does not depend on those beside it
        out[:, at[fresh]], ended[at[fresh]] = then[:, fresh], True
        rest = np.flatnonzero(~done)
        if len(rest) == 0 or steps >= most:
            out[:, at[rest]] = then[:, rest]
            return out, ended
        if 5 * len(rest) <= 4 * len(at):
            at, now, then, moved = at[rest], now[:, rest], then[:, rest], moved[:, rest]
            weights, counts = weights[:, :, rest], counts[:, rest]
        steps += 1
        if steps > FAST_STEPS:
            now = then
            continue
        further = step(then)
        bent = further - then - moved
        length = np.sqrt((moved**2).sum(0) / np.maximum((bent**2).sum(0), 1e-300)).clip(1, 1e3)
        now = now + 2 * length * moved + length**2 * bent
        now = np.where((now > prior / 2).all(0), now, further)


def infer(
    words: np.ndarray, counts: np.ndarray, sizes: np.ndarray, weights: np.ndarray, prior: np.ndarray,
    sums: np.ndarray | None = None,
) -> np.ndarray:
    """Dirichlet parameters of the shares (article, topic); articles without words have zeros.

    ``words`` and their ``counts`` hold the articles one after the other, ``sizes`` how many of them each has.
    ``weights`` are by word and topic. The words' counts by topic are added to ``sums``, by topic and word.
    """
    starts = np.cumsum(sizes) - sizes
    worded = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), len(prior)))
    out[worded] = prior + np.add.reduceat(counts, starts[worded])[:, None] / len(prior) if len(worded) else 0

    def block(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = np.arange(sizes[rows[-1]])[:, None]
        held = place < sizes[rows]
        cell = np.where(held, starts[rows] + place, 0)
        terms = words.take(cell)
        heavy = np.ascontiguousarray(weights.take(terms.ravel(), axis=0).T).reshape(-1, *terms.shape)
        return terms, np.where(held, counts.take(cell), 0.0), heavy

    left = worded
    for ratio, most in ROUNDS:
        slow = []
        for rows in _alike(left, sizes, ratio):
            _, n, heavy = block(rows)
            found, ended = _settle(heavy, n, prior, out[rows].T, most)
            out[rows] = found.T
            slow.append(rows[~ended])
        left = np.concatenate(slow) if slow else left
    if sums is not None:
        for rows in _alike(worded, sizes, ROUNDS[0][0]):
            terms, n, heavy = block(rows)
            heavy *= np.exp(digamma(out[rows].T))[:, None]
            heavy *= n / (heavy.sum(0) + 1e-100)
            for t in range(len(prior)):
                np.add.at(sums[t], terms.ravel(), heavy[t].ravel())
    return out
