"""Rotations, cameras and vectors as Column expressions; 3x3 matrices are arrays of nine doubles, row after row."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTITY = (1, 0, 0, 0, 1, 0, 0, 0, 1)


def total(terms) -> Column:
    return reduce(add, terms)


def vector(*parts) -> Column:
    return F.array(*[p if isinstance(p, Column) else F.lit(float(p)) for p in parts])


def dot(a: Column, b: Column, n: int = 3) -> Column:
    return total(a[i] * b[i] for i in range(n))


def norm(a: Column, n: int = 3) -> Column:
    return F.sqrt(dot(a, a, n))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(total((a[i] - b[i]) * (a[i] - b[i]) for i in range(3)))


def finite(a: Column, n: int) -> Column:
    """No element is null, NaN or infinite."""
    return F.coalesce(reduce(lambda x, y: x & y, [~F.isnan(a[i]) & (F.abs(a[i]) < F.lit(float("inf"))) for i in range(n)]), F.lit(False))


def clean(a: Column, n: int) -> Column:
    """Zeros where not finite, so that arithmetic on rows that are left out stays quiet."""
    return F.array(*[F.when(F.isnan(a[i]) | (F.abs(a[i]) == F.lit(float("inf"))), 0.0).otherwise(F.coalesce(a[i], F.lit(0.0))) for i in range(n)])


def rotation_6d(df, six: str, out: str, valid: str):
    """Adds ``out`` (matrix from the first two rows by Gram-Schmidt) and ``valid``; an invalid one becomes the identity.

    Valid: finite, neither row shorter than 1e-8, and no element changed by more than 1e-3.
    """
    raw, names = F.col(six), [f"__{x}" for x in ("c", "n1", "x", "s", "n2", "y")]
    c, n1, x, s, n2, y = (F.col(n) for n in names)
    step = df.withColumn("__c", clean(raw, 6))
    step = step.withColumn("__n1", F.sqrt(total(c[i] * c[i] for i in range(3))))
    step = step.withColumn("__x", F.array(*[c[i] / F.greatest(n1, F.lit(1e-12)) for i in range(3)]))
    step = step.withColumn("__s", F.array(*[c[3 + i] - total(x[j] * c[3 + j] for j in range(3)) * x[i] for i in range(3)]))
    step = step.withColumn("__n2", norm(s)).withColumn("__y", F.array(*[s[i] / F.greatest(n2, F.lit(1e-12)) for i in range(3)]))
    error = F.greatest(*[F.abs(x[i] - c[i]) for i in range(3)], *[F.abs(y[i] - c[3 + i]) for i in range(3)])
    step = step.withColumn(valid, finite(raw, 6) & (n1 > 1e-8) & (n2 > 1e-8) & (error <= 1e-3))
    cross = [x[1] * y[2] - x[2] * y[1], x[2] * y[0] - x[0] * y[2], x[0] * y[1] - x[1] * y[0]]
    whole = F.array(*[x[i] for i in range(3)], *[y[i] for i in range(3)], *cross)
    return step.withColumn(out, F.when(F.col(valid), whole).otherwise(vector(*IDENTITY))).drop(*names)


def rotations(six: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``rotation_6d`` of rows of six numbers: matrices as rows of nine, and which are valid, in the same terms and order."""
    finite = np.isfinite(six).all(axis=1)
    c = np.where(np.isfinite(six), six, 0.0)
    a, b = c[:, :3], c[:, 3:]
    n1 = np.sqrt(a[:, 0] * a[:, 0] + a[:, 1] * a[:, 1] + a[:, 2] * a[:, 2])
    x = a / np.maximum(n1, 1e-12)[:, None]
    s = b - (x[:, 0] * b[:, 0] + x[:, 1] * b[:, 1] + x[:, 2] * b[:, 2])[:, None] * x
    n2 = np.sqrt(s[:, 0] * s[:, 0] + s[:, 1] * s[:, 1] + s[:, 2] * s[:, 2])
    y = s / np.maximum(n2, 1e-12)[:, None]
    valid = finite & (n1 > 1e-8) & (n2 > 1e-8) & (np.maximum(np.abs(x - a), np.abs(y - b)).max(axis=1, initial=0) <= 1e-3)
    cross = np.column_stack([x[:, i] * y[:, j] - x[:, j] * y[:, i] for i, j in ((1, 2), (2, 0), (0, 1))])
    return np.where(valid[:, None], np.column_stack([x, y, cross]), np.array(IDENTITY, float)), valid


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, in one expression: rows whose branch does not ask for it skip it all."""
    return F.transform(F.array(value), use)[0]


def relative(a: Column, b: Column, i: int, j: int) -> Column:
    """Element (i, j) of the transpose of ``a`` times ``b``."""
    return total(a[3 * k + i] * b[3 * k + j] for k in range(3))


def with_relative(df, a: str, b: str, out: str):
    """Adds ``out``: the transpose of matrix column ``a`` times ``b``."""
    return df.withColumn(out, F.array(*[relative(F.col(a), F.col(b), i, j) for i in range(3) for j in range(3)]))


def with_angle(df, a: str, b: str, out: str):
    """Adds ``out``: degrees between two rotations, by the one form that is stable at 0 and 180; null where either is.

    The relative rotation is a column of its own, so that generated code computes it once.
    """
    rel = F.col("__rel")
    half = F.sqrt(F.pow(rel[7] - rel[5], 2) + F.pow(rel[2] - rel[6], 2) + F.pow(rel[3] - rel[1], 2)) / 2
    return with_relative(df, a, b, "__rel").withColumn(out, F.degrees(F.atan2(half, (rel[0] + rel[4] + rel[8] - 1) / 2))).drop("__rel")


def apart_by(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``distance`` of rows of three numbers."""
    d = others - points
    return np.sqrt(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2])


def turned_by(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Degrees between rows of nine numbers, in the terms and the order of ``with_angle``."""
    a, b = a.reshape(-1, 3, 3), b.reshape(-1, 3, 3)
    rel = a[:, 0, :, None] * b[:, 0, None, :] + a[:, 1, :, None] * b[:, 1, None, :] + a[:, 2, :, None] * b[:, 2, None, :]
    half = np.sqrt((rel[:, 2, 1] - rel[:, 1, 2]) ** 2 + (rel[:, 0, 2] - rel[:, 2, 0]) ** 2 + (rel[:, 1, 0] - rel[:, 0, 1]) ** 2) / 2
    return np.degrees(np.arctan2(half, (rel[:, 0, 0] + rel[:, 1, 1] + rel[:, 2, 2] - 1) / 2))


def with_quaternion(df, m: str, out: str):
    """Adds ``out``: the unit quaternion [x, y, z, w] of a rotation, by the largest of its four squares, so that no root is of a small number."""
    a = F.col(m)
    trace = a[0] + a[4] + a[8]
    largest = F.greatest(a[0], a[4], a[8], trace)

    def branch(i: int) -> Column:
        j, k = (i + 1) % 3, (i + 2) % 3
        parts = {i: 1 - trace + 2 * a[4 * i], j: a[3 * j + i] + a[3 * i + j], k: a[3 * k + i] + a[3 * i + k]}
        return F.array(*[parts[n] for n in range(3)], a[3 * k + j] - a[3 * j + k])

    whole = F.array(a[7] - a[5], a[2] - a[6], a[3] - a[1], 1 + trace)
    raw = F.when(trace == largest, whole).when(a[0] == largest, branch(0)).when(a[4] == largest, branch(1)).otherwise(branch(2))
    step = df.withColumn("__raw", raw).withColumn("__size", norm(F.col("__raw"), 4))
    return step.withColumn(out, F.transform("__raw", lambda x: x / F.col("__size"))).drop("__raw", "__size")


def with_quaternion_angle(df, a: str, b: str, out: str):
    """Adds ``out``: degrees between two rotations, twice the arc cosine of their quaternions' product."""
    step = with_quaternion(with_quaternion(df, a, "__qa"), b, "__qb")
    return step.withColumn(out, F.degrees(2 * F.acos(F.least(F.lit(1.0), F.abs(dot(F.col("__qa"), F.col("__qb"), 4)))))).drop("__qa", "__qb")


def slerp(df, a: str, b: str, alpha: str, out: str):
    """Adds ``out``: the rotation ``alpha`` of the way from column ``a`` to ``b``, a times the scaled relative rotation.

    One expression, as rows without ``alpha``, which get null, are the most by far. Half a turn leaves no skew part; the
    axis is then the longest column of the relative rotation plus one.
    """
    m, share = F.col(a), F.col(alpha)

    def along(rel: Column) -> Column:
        skew = F.array(rel[7] - rel[5], rel[2] - rel[6], rel[3] - rel[1])
        longest = F.greatest(*[rel[4 * i] for i in range(3)])
        columns = [F.array(*[rel[3 * k + i] + (1.0 if k == i else 0.0) for k in range(3)]) for i in range(3)]
        column = F.when(rel[0] == longest, columns[0]).when(rel[4] == longest, columns[1]).otherwise(columns[2])
        whole = F.atan2(norm(skew) / 2, (rel[0] + rel[4] + rel[8] - 1) / 2)
        axis = F.when(norm(skew) > 1e-9, skew).when(whole > 1, column).otherwise(vector(0, 0, 0))
        return let(axis, lambda v: let(F.array(*[F.coalesce(F.try_divide(v[i], norm(v)), F.lit(0.0)) for i in range(3)], norm(v), share * whole), turn))

    def turn(x: Column) -> Column:
        sin, rest = F.sin(x[4]), F.when(x[3] > 0, 1 - F.cos(x[4])).otherwise(0.0)
        cross = [[F.lit(0.0), -x[2], x[1]], [x[2], F.lit(0.0), -x[0]], [-x[1], x[0], F.lit(0.0)]]
        turned = F.array(*[float(i == j) + sin * cross[i][j] + rest * (x[i] * x[j] - float(i == j)) for i in range(3) for j in range(3)])
        return let(turned, lambda r: F.array(*[total(m[3 * i + k] * r[3 * k + j] for k in range(3)) for i in range(3) for j in range(3)]))

    rel = F.array(*[relative(m, F.col(b), i, j) for i in range(3) for j in range(3)])
    return df.withColumn(out, F.when(share.isNotNull(), let(rel, along)))


def in_camera(rotation: Column, centre: Column, point: Column) -> Column:
    """World to camera coordinates."""
    return F.array(*[total(rotation[3 * k + i] * (point[k] - centre[k]) for k in range(3)) for i in range(3)])


#: How many coefficients a lens may have: k1, k2, p1, p2, then k3, then k4 to k6, then s1 to s4, then two tilts in radians.
LENS_SIZES = (4, 5, 8, 12, 14)


def bent(lens: Column) -> Column:
    """Whether a lens distorts at all; a number of coefficients that no model has raises then."""
    wrong = F.raise_error(F.concat(F.lit("no lens model has "), F.size(lens).cast("string"), F.lit(" coefficients")))
    return F.when(~F.exists(lens, lambda c: c != 0), False).when(F.size(lens).isin(*LENS_SIZES), True).otherwise(wrong.cast("boolean"))


def _tilted(c, seen: Column) -> Column:
    """``seen`` moved onto a sensor that is tilted about both axes, where the lens has such coefficients."""
    a, b = c(12), c(13)
    rot = [[F.cos(b), F.sin(b) * F.sin(a), -F.sin(b) * F.cos(a)], [F.lit(0.0), F.cos(a), F.sin(a)], [F.sin(b), -F.cos(b) * F.sin(a), F.cos(b) * F.cos(a)]]
    moved = let(F.array(*[r[0] * seen[0] + r[1] * seen[1] + r[2] for r in rot]), lambda v: F.array(*[(rot[2][2] * v[i] - rot[i][2] * v[2]) / v[2] for i in range(2)]))
    return F.when((a != 0) | (b != 0), moved).otherwise(seen)


def with_projection(df, point: str, k: str, lens: str, out: str):
    """Adds ``out``: pixel coordinates [u, v] of a point in camera coordinates; NaN when it is not in front (z over 1e-6).

    ``k``: the nine intrinsics, all of which hold where the lens does not distort; a distorting one is followed by focal
    lengths and centre alone. ``lens``: rational, thin-prism and tilted-sensor models by the number of coefficients. One
    expression, of which rows without distortion compute the plain part alone.
    """
    p, m, coefficients = F.col(point), F.col(k), F.col(lens)
    c = lambda i: F.coalesce(F.get(coefficients, F.lit(i)), F.lit(0.0))

    def distorted(at: Column) -> Column:
        x, y, r = at[0], at[1], at[2]
        radial = (1 + r * (c(0) + r * (c(1) + r * c(4)))) / (1 + r * (c(5) + r * (c(6) + r * c(7))))
        lx = x * radial + 2 * c(2) * x * y + c(3) * (r + 2 * x * x) + r * (c(8) + r * c(9))
        ly = y * radial + c(2) * (r + 2 * y * y) + 2 * c(3) * x * y + r * (c(10) + r * c(11))
        return let(F.array(lx, ly), lambda v: let(_tilted(c, v), lambda w: F.array(*[m[4 * i] * w[i] + m[3 * i + 2] for i in range(2)])))

    front, x, y = F.coalesce(p[2] > 1e-6, F.lit(False)), p[0] / p[2], p[1] / p[2]
    plain = F.array(*[(m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2]) / (m[6] * x + m[7] * y + m[8]) for i in range(2)])
    return df.withColumn(out, F.when(bent(coefficients) & front, let(F.array(x, y, x * x + y * y), distorted)).when(front, plain).otherwise(vector(float("nan"), float("nan"))))


def image_region(uv: Column, front: Column, width: Column, height: Column, margin: float) -> tuple[Column, Column]:
    """(inside the image, inside its safe box); borders belong to the lower side."""
    def box(m: float) -> Column:
        return (uv[0] >= m * width) & (uv[0] < (1 - m) * width) & (uv[1] >= m * height) & (uv[1] < (1 - m) * height)

    inside = front & ~F.isnan(uv[0]) & ~F.isnan(uv[1]) & box(0.0)
    return inside, inside & box(margin)


def rigid_error(m: Column) -> tuple[Column, Column]:
    """(largest element of transpose times matrix minus one, determinant)."""
    error = F.greatest(*[F.abs(relative(m, m, i, j) - (1.0 if i == j else 0.0)) for i in range(3) for j in range(3)])
    det = total(m[i] * (m[3 + (i + 1) % 3] * m[6 + (i + 2) % 3] - m[3 + (i + 2) % 3] * m[6 + (i + 1) % 3]) for i in range(3))
    return error, det


def isclose(a: Column, b: Column, atol: float) -> Column:
    """Within ``atol``, and NaN equal to NaN."""
    both = F.isnan(a) & F.isnan(b)
    either = F.isnan(a) | F.isnan(b)
    return F.coalesce(both | (~either & (F.abs(a - b) <= atol)), F.lit(False))


def seconds(frame: Column, fps: int = 30) -> Column:
    return F.format_string("%.6f", frame / F.lit(float(fps)))
