"""Leading eigenpairs of a symmetric matrix that is only known by its products.

A block Jacobi-Davidson method: Rayleigh-Ritz in a growing subspace, corrections from projected
equations solved by MINRES, converged pairs locked. All vectors of a step are multiplied in
one call of `product`, as each call is a pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
#: Steps of MINRES in one correction at most, and outer steps before the method gives up.
INNER_STEPS, OUTER_STEPS = 4, 300
#: A correction is solved to this share of its residual.
INNER_ACCURACY = 0.1
EPS = float(np.finfo(float).eps)


@dataclass
class Eigenpairs:
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to another one.

    Directions of which only rounding errors are left add nothing.
    """
    if against.shape[1] >= len(against):
        return block[:, :0]
    for _ in range(2):
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        block = block - against @ (against.T @ block)
        if block.shape[1]:
            u, s, _ = np.linalg.svd(block, full_matrices=False)
            block = u[:, s > 1e-8]
    return block


def minres(product: Product, shifts: np.ndarray, out: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solves (I - QQ')(A - shift)(I - QQ') t = r for all columns r at once, Q = `out`.

    Each column is a MINRES of its own (Lanczos and Givens rotations); they only share the
    products. A column that is accurate enough, or whose Lanczos ends, no longer changes.
    """
    project = lambda block: block - out @ (out.T @ block)
    v = project(right)
    start = np.linalg.norm(v, axis=0)
    live = start > 0
    beta, eta = start.copy(), start.copy()
    t, before = np.zeros_like(v), np.zeros_like(v)
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    c, c_before, s, s_before = np.ones(len(start)), np.ones(len(start)), np.zeros(len(start)), np.zeros(len(start))
    v = v / np.where(live, start, 1)
    for _ in range(INNER_STEPS):
        if not live.any():
            break
        image = np.zeros_like(v)
        image[:, live] = product(v[:, live])
        image = project(image - v * shifts)
        alpha = (v * image).sum(axis=0)
        following = image - alpha * v - np.where(_first(before), 0, beta) * before
        following = project(following)
        norm = np.linalg.norm(following, axis=0)
        # The new column of the tridiagonal matrix under the last two rotations.
        link = np.where(_first(before), 0, beta)
        delta, rho3 = c * alpha - c_before * s * link, s_before * link
        rho2 = s * alpha + c_before * c * link
        rho1 = np.hypot(delta, norm)
        safe = np.where(rho1 > 0, rho1, 1)
        c_before, s_before = c, s
        c, s = np.where(rho1 > 0, delta / safe, 1), np.where(rho1 > 0, norm / safe, 0)
        direction = (v - rho3 * w_before - rho2 * w) / safe
        t = t + np.where(live & (rho1 > 0), c * eta, 0) * direction
        eta = -s * eta
        w_before, w, before = w, direction, v
        live = live & (norm > EPS * np.abs(alpha)) & (np.abs(eta) > INNER_ACCURACY * start)
        v = following / np.where(norm > 0, norm, 1)
        beta = norm
    return project(t)


def _first(before: np.ndarray) -> bool:
    return not before.any()


def leading(product: Product, size: int, wanted: int, seed: int = 11) -> Eigenpairs:
    """The `wanted` largest eigenvalues with unit eigenvectors, by falling value.

    Ends when every residual is at double precision: within `size` roundings of the largest
    eigenvalue, or no longer shrinking within 1e-11 of it, which is what sums over very many rows leave.
    """
    wanted = min(wanted, size)
    width = min(wanted + 2, size)
    widest = min(size, max(8 * width, 20))
    calls = 0

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return product(block)

    locked, images, values, residuals = np.zeros((size, 0)), np.zeros((size, 0)), np.zeros(0), np.zeros(0)
    basis = orthonormal(np.random.default_rng(seed).standard_normal((size, width)), locked)
    image = counted(basis)
    last = np.full(wanted, np.inf)
    for _ in range(OUTER_STEPS):
        left = wanted - locked.shape[1]
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        rest = image[:, :left] - basis[:, :left] * theta[:left]
        rest -= locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        largest = max(np.abs(theta).max(initial=0), np.abs(values).max(initial=0))
        done = (norms <= size * EPS * largest) | ((norms <= 1e-11 * largest) & (norms > 0.5 * last[:left]))
        # Only from the top on, so that locked values fall.
        n_done = int(np.argmin(np.append(done, False)))
        if n_done:
            locked, images = np.hstack([locked, basis[:, :n_done]]), np.hstack([images, image[:, :n_done]])
            values, residuals = np.append(values, theta[:n_done]), np.append(residuals, norms[:n_done])
            basis, image, theta, rest, norms = basis[:, n_done:], image[:, n_done:], theta[n_done:], rest[:, n_done:], norms[n_done:]
        if locked.shape[1] == wanted:
            order = np.argsort(-values, kind="stable")
            return Eigenpairs(values[order], locked[:, order], residuals[order], calls)
        last = norms
        if basis.shape[1] > widest - width:
            keep = min(basis.shape[1], left - n_done + width)
            basis, image = basis[:, :keep], image[:, :keep]
        n_left = rest.shape[1]
        active = norms > size * EPS * largest
        fixed = np.hstack([locked, basis[:, :n_left]])
        fix = minres(counted, theta[:n_left][active], fixed, -rest[:, active])
        # Without a usable correction the residual itself is the next direction.
        added = orthonormal(fix, np.hstack([locked, basis]))
        if not added.shape[1]:
            noise = np.random.default_rng(seed + calls).standard_normal((size, width))
            added = orthonormal(np.hstack([rest, noise]), np.hstack([locked, basis]))[:, :width]
        if added.shape[1]:
            basis, image = np.hstack([basis, added]), np.hstack([image, counted(added)])
    raise ArithmeticError(f"residuals {last} after {OUTER_STEPS} steps")
