"""Eigenvectors of a symmetric matrix by spectral divide and conquer on polar decompositions.

The polar factor of H - s I is the matrix sign of it, so (sign + I) / 2 projects on the eigenvectors above s. A basis of
what it keeps and one of the rest make H block diagonal, and both blocks are split again.
"""

import numpy as np

EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley iterations (QDWH).

    The weights follow a lower bound of the smallest singular value: iterations by QR while that is small, by Cholesky
    factors once the matrix is well conditioned.
    """
    d = len(a)
    one = np.eye(d)
    x = a / np.linalg.norm(a)
    try:
        low = min(1.0, max(1 / np.linalg.norm(np.linalg.inv(x)), EPS))
    except np.linalg.LinAlgError:
        low = EPS
    for _ in range(30):
        square = low * low
        root = np.cbrt(4 * (1 - square) / square**2)
        side = np.sqrt(1 + root)
        wa = side + np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - square) / (square * side))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:d] @ q[d:].T
        else:
            factor = np.linalg.cholesky(one + wc * x.T @ x)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(5 * EPS) and 1 - low <= 10 * EPS:
            return x
    return x


def _halves(h: np.ndarray, shift: float, rng) -> tuple[float, np.ndarray, np.ndarray] | None:
    """Bases of the eigenvectors above the shift and of the rest, with what couples them; None if a side is empty."""
    d = len(h)
    projector = (polar(h - shift * np.eye(d)) + np.eye(d)) / 2
    k = round(np.trace(projector))
    if not 0 < k < d:
        return None
    above = np.linalg.qr(projector @ rng.standard_normal((d, k)))[0]
    basis = np.linalg.qr(projector @ above, mode="complete")[0]
    above, rest = basis[:, :k], basis[:, k:]
    return np.linalg.norm(rest.T @ h @ above), above, rest


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, and unit eigenvectors as columns.

    A block is left whole if it is a multiple of the identity up to rounding: any basis of it is right.
    """
    rng = np.random.default_rng(0)
    size = np.linalg.norm(matrix)
    done, todo = [], [((matrix + matrix.T) / 2, np.eye(len(matrix)))]
    while todo:
        h, basis = todo.pop()
        d = len(h)
        diagonal = np.diag(h).copy()
        mean = diagonal.mean() if d else 0.0
        if d <= 1 or np.linalg.norm(h - mean * np.eye(d)) <= 4 * EPS * size:
            done.append((diagonal, basis))
            continue
        best = None
        # The mean always has eigenvalues on both sides; it and its neighbours serve where the median splits badly.
        spread = np.linalg.norm(h - mean * np.eye(d)) / d
        for shift in (float(np.median(diagonal)), mean, mean + 0.1 * spread, mean - 0.1 * spread):
            found = _halves(h, shift, rng)
            if found and (best is None or found[0] < best[0]):
                best = found
            if best and best[0] <= 10 * np.sqrt(d) * EPS * size:
                break
        if best is None:
            done.append((diagonal, basis))
            continue
        for part in best[1:]:
            block = part.T @ h @ part
            todo.append(((block + block.T) / 2, basis @ part))
    values = np.concatenate([v for v, _ in done]) if done else np.zeros(0)
    vectors = np.hstack([b for _, b in done]) if done else np.zeros((0, 0))
    vectors /= np.linalg.norm(vectors, axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
