"""Singular values and right singular vectors of a small triangular matrix: Householder, dqds, twisted factorisations.

The matrices are d x d, d being the length of an embedding: their size does not grow with the number of rows.
"""

import numpy as np

EPS = np.finfo(float).eps
# Steps of dqds per singular value, far above the usual three or four.
STEPS = 60
# Singular values closer than this, relative to their size, have their vectors made orthogonal to each other.
CLOSE = 1e-3


def _reflector(x):
    """(v, beta) with (I - beta v v') x = +-|x| e1."""
    v = x.copy()
    norm = np.linalg.norm(x)
    if not norm:
        return v, 0.0
    v[0] += norm if x[0] >= 0 else -norm
    return v, 2.0 / (v @ v)


def bidiagonalise(r):
    """(a, b, right): diagonal, upper diagonal and the right transformation, so that r = left * B(a, b) * right'."""
    m = np.array(r, float)
    d = m.shape[1]
    right = np.eye(d)
    for k in range(d):
        v, beta = _reflector(m[k:, k])
        m[k:, k:] -= np.outer(beta * v, v @ m[k:, k:])
        if k < d - 2:
            v, beta = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= np.outer(m[k:, k + 1 :] @ v, beta * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, beta * v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def _sweep(q, e, shift):
    """One dqds transform; None if the shift is above the smallest value."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    if d < 0:
        return None
    for i in range(n - 1):
        new_q[i] = d + e[i]
        t = q[i + 1] / new_q[i] if new_q[i] > 0 else 1.0
        new_e[i] = e[i] * t
        d = d * t - shift
        if d < 0:
            return None
    new_q[n - 1] = d
    return new_q, new_e


def squared_singular_values(a, b):
    """Squares of the singular values of the upper bidiagonal (a, b), ascending, by dqds with shifts.

    Deflation takes off one value at the end or splits where an upper entry is negligible. A zero on the diagonal is
    lifted to 1e-19 of the largest square, so that no quotient is undefined.
    """
    top = max(np.max(np.square(a), initial=0.0), np.max(np.square(b), initial=0.0))
    if not top:
        return np.zeros(len(a))
    floor = top * EPS * EPS
    found = []
    open_parts = [(np.maximum(np.square(a), floor), np.square(b), 0.0)]
    while open_parts:
        q, e, moved = open_parts.pop()
        stalled = 0
        while len(q):
            if len(q) == 1:
                found.append(moved + q[0])
                break
            if e[-1] <= EPS * EPS * (moved + q[-1]):
                found.append(moved + q[-1])
                q, e, stalled = q[:-1], e[:-1], 0
                continue
            cut = np.flatnonzero(e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:])))
            if len(cut):
                at = int(cut[-1]) + 1
                open_parts.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            # The smaller eigenvalue of the last two by two block guides the shift; a failed one is cut down.
            x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (x - y) / 2
            guess = y - z / (half + np.copysign(np.hypot(half, np.sqrt(z)), half)) if z else y
            shift = max(0.0, min(guess, q[-1])) * (1 - 1e-10) if stalled < STEPS else 0.0
            while (step := _sweep(q, e, shift)) is None:
                shift = shift * 0.5 if shift > floor and stalled < STEPS else 0.0
                stalled += 1
                if not shift and stalled > 40 * STEPS:
                    raise ArithmeticError("dqds does not converge")
            q, e = step
            moved += shift
            stalled += 1
    return np.sort(np.array(found))


def _twisted(a, b, value):
    """(gamma, upper, lower): twist quantities of B'B - value, and multipliers towards both ends."""
    d, link = np.square(a), b / a[:-1]
    n, tiny = len(a), EPS * EPS * max(value, np.finfo(float).tiny)
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        pivot = d[i] + s[i]
        pivot = pivot if pivot else tiny
        lower[i] = d[i] * link[i] / pivot
        s[i + 1] = lower[i] * link[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * link[i] * link[i] + p[i + 1]
        t = d[i] / (pivot if pivot else tiny)
        upper[i] = link[i] * t
        # Without a link and with nothing below, the entry stands alone.
        p[i] = (p[i + 1] * t if pivot or p[i + 1] else d[i]) - value
    return s + p + value, lower, upper


def _vector(lower, upper, twist):
    z = np.zeros(len(lower) + 1)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, len(lower)):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(a, b, values):
    """Unit right singular vectors of (a, b) for its squared singular values in falling order, as columns.

    Each comes from a twisted factorisation of B'B minus the value, twisted where that is nearest to singular, after one
    Rayleigh correction of the value. Vectors of close values are made orthogonal; there the twist that leaves most is used.
    """
    lift = np.sqrt(np.max(np.square(a)) if len(a) else 0.0) * EPS
    a = np.where(np.abs(a) > lift, a, lift if lift else 1.0)
    out, cluster, before = [], [], None
    for value in values:
        cluster = cluster if before is not None and before - value <= CLOSE * before else []
        before = value
        if len(a) == 1:
            out.append(np.ones(1))
            continue
        gamma, lower, upper = _twisted(a, b, value)
        z = _vector(lower, upper, int(np.argmin(np.abs(gamma))))
        if not cluster:
            twist = int(np.argmin(np.abs(gamma)))
            better = value + gamma[twist] * z[twist] ** 2
            if better > 0 and abs(better - value) < CLOSE * value:
                gamma, lower, upper = _twisted(a, b, better)
                z = _vector(lower, upper, int(np.argmin(np.abs(gamma))))
        best, best_left = z, -1.0
        for twist in np.argsort(np.abs(gamma), kind="stable")[: 1 if not cluster else len(a)]:
            z = _vector(lower, upper, int(twist))
            for _ in range(2):
                for other in cluster:
                    z = z - (other @ z) * other
            left = np.linalg.norm(z)
            if left > best_left:
                best, best_left = z / left if left else z, left
            if left > 0.5:
                break
        cluster.append(best)
        out.append(best)
    return np.array(out).T.reshape(len(a), len(out))


def principal(r, count):
    """(squares, vectors): the `count` largest squared singular values of `r`, falling, and right singular vectors as columns.

    Values that rounding can't tell from zero are left out.
    """
    r = np.asarray(r, float)
    scale = float(np.max(np.abs(r), initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    a, b, right = bidiagonalise(r / scale)
    values = squared_singular_values(a, b)[::-1]
    values = values[values > values[0] * (64 * len(a) * EPS) ** 2][:count]
    return values * scale**2, right @ right_vectors(a, b, values)
