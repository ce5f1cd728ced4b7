"""The sweep by its definition: a score x threshold mask and set membership."""

import numpy as np


def sweep_table(cands, gold, grid, method):
    """Rows (reported threshold, predicted, precision, recall, f1) for ``(src, tgt, score)`` candidates."""
    truth = dict(gold).items()  # a later line of a source replaces an earlier one
    score = np.array([c[2] for c in cands], dtype=float)
    right = np.array([(c[0], c[1]) in truth for c in cands], dtype=bool)
    raw = np.array([g[1] for g in grid])
    cuts = score.mean() + raw * score.std() if method == "dynamic" else raw
    kept = score[None, :] > cuts[:, None]
    predicted, hits = kept.sum(axis=1), (kept & right).sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        p = np.nan_to_num(hits / predicted)
        r = np.nan_to_num(hits / np.float64(len(truth)))
        f = np.nan_to_num(2 * p * r / (p + r))
    return [(g[2], int(n), *map(float, x)) for g, n, *x in zip(grid, predicted, p, r, f)]
