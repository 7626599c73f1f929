"""Gradients and NDCG of whole sessions inside a task, on arrays.

For sessions that were not split: every session's rows are in one block of ``blocks``. The
values are those of the DataFrame form in ``ranker``, which serves sessions of any size.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

#: Whole numbers per unit of a pair's pull and hessian, and of a row's: sums do not depend on their order.
PAIR_UNIT = float(1 << 40)
ROW_UNIT = float(1 << 26)
#: Sessions of at most so many rows are sorted together; pairs are met so many at a time, or those of one positive.
_MATRIX, _PAIRS = 256, 1 << 16
#: A pair has at most one PAIR_UNIT, so doubles, exact up to 2**53, hold the sum of fewer pairs than these.
_EXACT_PAIRS = 1 << 13


def _sessions(qid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and length of each run of equal ids."""
    first = np.flatnonzero(np.diff(qid, prepend=qid[:1] - 1))
    return first, np.diff(np.append(first, len(qid)))


def _spread(per_session: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.repeat(per_session, length)


def ndcg_by_cut(first: np.ndarray, length: np.ndarray, score: np.ndarray, label: np.ndarray, hits: np.ndarray, cuts: tuple[int, ...]) -> list[np.ndarray]:
    """Tie-averaged NDCG@k of sorted sessions in whole PAIR_UNITs, for every cut; -1 where a session does not count.

    Only levels with a positive that begin within the cuts gain anything, so no others are looked at.
    """
    new = np.empty(len(score), bool)
    new[1:] = score[1:] != score[:-1]
    new[first] = True
    level = np.flatnonzero(new)
    labelled = np.flatnonzero(label)
    at = np.searchsorted(level, labelled, side="right") - 1
    begins = np.flatnonzero(np.diff(at, prepend=-1))
    at, positives = at[begins], np.add.reduceat(label[labelled], begins) if len(begins) else np.zeros(0, np.int64)
    n = np.append(level, len(score))[at + 1] - level[at]
    of = np.searchsorted(first, level[at], side="right") - 1
    before = level[at] - first[of]
    some = np.flatnonzero((positives > 0) & (before < max(cuts)))
    of, before, n, mean = of[some], before[some], n[some], positives[some] / n[some]
    counts, found = (hits > 0) & (length > 1), []
    for k in cuts:
        upto_k = np.concatenate([[0.0], np.cumsum(1.0 / np.log2(1.0 + np.arange(1, k + 1)))])
        gain = mean * (upto_k[np.minimum(before + n, k)] - upto_k[np.minimum(before, k)])
        dcg = np.bincount(of, gain, minlength=len(first))
        value = dcg / np.where(counts, upto_k[np.minimum(hits, k)], 1.0)
        found.append(np.where(counts, np.rint(value * PAIR_UNIT), -1).astype(np.int64))
    return found


def _of_sessions(sessions: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The rows of some sessions, in their order."""
    n = length[sessions]
    return np.arange(n.sum()) + _spread(first[sessions] - (np.cumsum(n) - n), n)


def pulls(
    first: np.ndarray, length: np.ndarray, score: np.ndarray, label: np.ndarray, hits: np.ndarray, k: int, rank: np.ndarray | None = None
) -> tuple:
    """Pull and hessian of sorted rows, in whole PAIR_UNITs: each against the k leaders of its session.

    A leader also gets what rows below the cut have with it. Sessions without a positive get 0.
    ``rank`` is the place of a row in its session, or k below the cut; rows may share one.
    """
    discount = np.concatenate([1.0 / np.log2(1.0 + np.arange(1, k + 1)), [0.0]])
    ideal = np.concatenate([[1.0], np.cumsum(discount[:k])])[np.minimum(hits, k)]
    if rank is None:
        rank = np.minimum(np.arange(len(score)) - _spread(first, length), k)
    session = _spread(np.arange(len(first)), length)
    positives = np.flatnonzero(label == 1)
    back_pull, back_hessian = (np.zeros((len(first), k), np.int64) for _ in range(2))
    pull, hessian = np.zeros(len(score), np.int64), np.zeros(len(score), np.int64)
    for j in range(k):
        has = (hits > 0) & (length > j)
        if not has.any():
            break
        leader = np.where(has, first + j, 0)
        led = label[leader] == 1
        # The rows of the other label: few positives, or the negatives of the few sessions a positive leads here.
        up = positives[(has & ~led)[session[positives]]]
        down = _of_sessions(np.flatnonzero(has & led), first, length)
        down = down[label[down] != 1]
        own = np.concatenate([up, down])
        wants = np.repeat([1.0, -1.0], [len(up), len(down)])
        of, place = session[own], rank[own]
        wrong = 1.0 / (1.0 + np.exp(wants * (score[own] - score[leader][of])))
        weight = np.abs(discount[j] - discount[place]) / ideal[of]
        g = np.rint(wants * wrong * weight * PAIR_UNIT).astype(np.int64)
        h = np.rint(wrong * (1.0 - wrong) * weight * PAIR_UNIT).astype(np.int64)
        pull[own] += g
        hessian[own] += h
        below = place == k
        np.subtract.at(back_pull[:, j], of[below], g[below])
        np.add.at(back_hessian[:, j], of[below], h[below])
    led = np.flatnonzero(rank < k)
    pull[led] += back_pull[session[led], rank[led]]
    hessian[led] += back_hessian[session[led], rank[led]]
    return pull, hessian


def row_lambdas(qid: np.ndarray, product: np.ndarray, user: np.ndarray, label: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """(order, pull, hessian): the rows of sessions with a positive by session and rank, and what they get.

    Rows of one session with equal product and user share the first one's rank.
    """
    order = np.lexsort([user, product, -score, qid])
    qid, label = qid[order], label[order].astype(np.int64)
    first, length = _sessions(qid)
    rank = np.arange(len(qid)) - _spread(first, length)
    by_key = np.lexsort([rank, user[order], product[order], qid])
    same = np.ones(len(qid) - 1, bool)
    for values in (qid, product[order], user[order]):
        same &= values[by_key[1:]] == values[by_key[:-1]]
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    rank[by_key] = np.repeat(rank[by_key[begins]], np.diff(np.append(begins, len(qid))))
    hits = np.add.reduceat(label, first)
    found = pulls(first, length, score[order], label, hits, k, np.minimum(rank, k))
    kept = _spread(hits > 0, length)
    return order[kept], *(values[kept] / PAIR_UNIT for values in found)


def by_score(first: np.ndarray, length: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The rows of sessions that lie in order, each session's best score first; equal scores stay in place.

    Sessions of one length are sorted together, as the rows of a matrix.
    """
    order = np.empty(len(score), np.int64)
    for n in np.unique(length):
        own = first[length == n]
        if n <= _MATRIX:
            at = own[:, None] + np.arange(n)
            order[at] = own[:, None] + np.argsort(-score[at], axis=1, kind="stable")
        else:
            for begin in own:
                order[begin : begin + n] = begin + np.argsort(-score[begin : begin + n], kind="stable")
    return order


def pair_pulls(first: np.ndarray, length: np.ndarray, score: np.ndarray, label: np.ndarray, hits: np.ndarray, k: int) -> tuple:
    """What ``pulls`` finds where no rows share a rank, from the pairs of a positive and another row.

    A positive among the first k meets all rows of its session, one below them the first k, so
    there are at most 2k pairs a row. Both rows of a pair get the same, with opposite signs.
    """
    discount = np.concatenate([1.0 / np.log2(1.0 + np.arange(1, k + 1)), [0.0]])
    ideal = np.concatenate([[1.0], np.cumsum(discount[:k])])
    pull, hessian = np.zeros(len(score), np.int64), np.zeros(len(score), np.int64)
    positives = np.flatnonzero(label == 1)
    session = np.searchsorted(first, positives, side="right") - 1
    wanted = hits[session] > 0
    positives, session = positives[wanted], session[wanted]
    if not len(positives):
        return pull, hessian
    begin, rank = first[session], np.minimum(positives - first[session], k)
    n = np.where(rank < k, length[session], np.minimum(length[session], k))
    most = int(np.bincount(session).max())
    other = (label != 1).astype(np.float64)
    place = np.zeros(len(score))  # the discount of a row's own rank
    for j in range(k):
        has = length > j
        place[first[has] + j] = discount[j]
    ends = np.cumsum(n)
    cut = 0
    while cut < len(n):
        upto = max(cut + 1, int(np.searchsorted(ends, ends[cut] - n[cut] + _PAIRS, side="right")))
        own, count = slice(cut, upto), n[cut:upto]
        starts = np.cumsum(count) - count
        row = np.arange(starts[-1] + count[-1]) + np.repeat(begin[own] - starts, count)
        wrong = 1.0 / (1.0 + np.exp(np.repeat(score[positives[own]], count) - score.take(row)))
        weight = np.abs(place.take(row) - np.repeat(discount[rank[own]], count)) / np.repeat(ideal[np.minimum(hits[session[own]], k)], count)
        weight *= other.take(row)
        g = np.rint(wrong * weight * PAIR_UNIT)
        h = np.rint(wrong * (1.0 - wrong) * weight * PAIR_UNIT)
        for sums, values, sign in ((pull, g, -1), (hessian, h, 1)):
            whole = values.astype(np.int64)
            sums[positives[own]] += np.add.reduceat(whole, starts)
            if most < _EXACT_PAIRS:  # doubles hold the sum of so many pairs exactly
                low = int(row[0])
                # Rows of a cut lie close: sessions are in order.
                some = np.bincount(row - low, values).astype(np.int64)
                sums[low : low + len(some)] += sign * some
            else:
                np.add.at(sums, row, sign * whole)
        cut = upto
    return pull, hessian


def values_of_sessions(length: np.ndarray, train: np.ndarray, label: np.ndarray, score: np.ndarray, cuts: tuple[int, ...]) -> dict[str, np.ndarray]:
    """As ``session_values``, for sessions given by their lengths, and whether each is for training."""
    first = np.cumsum(length) - length
    order = by_score(first, length, score)
    score, label = score[order], label[order].astype(np.int64)
    hits = np.add.reduceat(label, first)
    ndcgs = np.zeros((2, len(cuts), 2), np.int64)
    for i, found in enumerate(ndcg_by_cut(first, length, score, label, hits, cuts)):
        for flag in (False, True):
            own = found[(train == flag) & (found >= 0)]
            ndcgs[int(flag), i] = own.sum(), len(own)
    values = {"ndcg": ndcgs}
    wanted = np.where(train, hits, 0)  # only training sessions pull
    for name, sorted_values in zip(("pull", "hessian"), pair_pulls(first, length, score, label, wanted, max(cuts)), strict=True):
        values[name] = np.empty(len(score), np.int64)
        values[name][order] = np.rint(sorted_values / PAIR_UNIT * ROW_UNIT).astype(np.int64)
    return values


def session_values(block: dict[str, np.ndarray], cuts: tuple[int, ...]) -> dict[str, np.ndarray]:
    """``pull`` and ``hessian`` of a block's rows, and ``ndcg``: sums of NDCG@k and sessions that count.

    The block's rows lie by session, product and user. ``ndcg`` has a row for validation and
    one for training sessions, and in it a sum and a count for every cut.
    """
    first, length = _sessions(block["qid"])
    return values_of_sessions(length, block["is_train"][first], block["target_label"], block["score"], cuts)


# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
