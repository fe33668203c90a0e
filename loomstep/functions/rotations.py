"""Rotations as column expressions. Conventions are named: quaternions real-first or real-last, 6D as the first two rows of
the matrix or its first two columns. Every conversion goes through the matrix, an array of 9 in row order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("matrix", "quaternion", "axis_angle", "rotation_6d", "euler_angles_xyz", "euler_angles_xzy", "euler_angles_yxz", "euler_angles_yzx", "euler_angles_zxy", "euler_angles_zyx")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once: a column used many times would otherwise be written out each time, and
    compositions would grow without bound."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _at(v: Column, *places: int) -> list[Column]:
    return [F.get(v, F.lit(p)) for p in places]


def from_quaternion(value: Column) -> Column:
    """Real part first; not necessarily of unit length."""
    return _let(value, _from_quaternion)


def _from_quaternion(q: Column) -> Column:
    r, i, j, k = _at(q, 0, 1, 2, 3)
    s = 2.0 / (r * r + i * i + j * j + k * k)
    return F.array(
        1 - s * (j * j + k * k), s * (i * j - k * r), s * (i * k + j * r),
        s * (i * j + k * r), 1 - s * (i * i + k * k), s * (j * k - i * r),
        s * (i * k - j * r), s * (j * k + i * r), 1 - s * (i * i + j * j),
    )


def to_quaternion(value: Column) -> Column:
    """Real part first and not negative; by the largest of the four squares, so no division by a small number."""
    return _let(value, _to_quaternion)


def _to_quaternion(m: Column) -> Column:
    m00, m01, m02, m10, m11, m12, m20, m21, m22 = _at(m, *range(9))
    w, x, y, z = (F.greatest(F.lit(0.0), 1 + a * m00 + b * m11 + c * m22) for a, b, c in ((1, 1, 1), (1, -1, -1), (-1, 1, -1), (-1, -1, 1)))
    rows = [
        (w, w, m21 - m12, m02 - m20, m10 - m01),
        (x, m21 - m12, x, m10 + m01, m02 + m20),
        (y, m02 - m20, m10 + m01, y, m12 + m21),
        (z, m10 - m01, m20 + m02, m21 + m12, z),
    ]
    best, out = F.greatest(w, x, y, z), None
    for square, *parts in rows:
        sign = F.when(parts[0] < 0, -1.0).otherwise(1.0)
        value = F.array(*[p * sign / (2 * F.sqrt(square)) for p in parts])
        out = F.when(square == best, value) if out is None else out.when(square == best, value)
    return out


def quaternion_from_axis_angle(value: Column) -> Column:
    return _let(value, _quaternion_from_axis_angle)


def _quaternion_from_axis_angle(v: Column) -> Column:
    x, y, z = _at(v, 0, 1, 2)
    angle = F.sqrt(x * x + y * y + z * z)
    s = F.when(angle < 1e-6, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / F.nullif(angle, F.lit(0.0)))
    return F.array(F.cos(angle / 2), x * s, y * s, z * s)


def axis_angle_from_quaternion(value: Column) -> Column:
    """Real part first."""
    return _let(value, _axis_angle_from_quaternion)


def _axis_angle_from_quaternion(q: Column) -> Column:
    r, i, j, k = _at(q, 0, 1, 2, 3)
    n = F.sqrt(i * i + j * j + k * k)
    angle = 2 * F.atan2(n, r)
    s = F.when(F.abs(angle) < 1e-6, 0.5 - angle * angle / 48).otherwise(F.sin(angle / 2) / F.nullif(angle, F.lit(0.0)))
    return F.array(i / s, j / s, k / s)


def axis_angle_from_quaternion_xyzw(value: Column) -> Column:
    """Real part last, clipped to [-1, 1]; next to no turn gives zeros."""
    return _let(value, _axis_angle_from_quaternion_xyzw)


def _axis_angle_from_quaternion_xyzw(q: Column) -> Column:
    x, y, z, w = _at(q, 0, 1, 2, 3)
    w = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), w))
    den = F.sqrt(1 - w * w)
    return F.when(den == 0, F.array(*[F.lit(0.0)] * 3)).otherwise(F.array(*[p * 2 * F.acos(w) / F.nullif(den, F.lit(0.0)) for p in (x, y, z)]))


def _unit(*v: Column) -> list[Column]:
    n = F.greatest(F.sqrt(sum((p * p for p in v[1:]), v[0] * v[0])), F.lit(1e-12))
    return [p / n for p in v]


def from_6d(value: Column, as_columns: bool = False) -> Column:
    """Gram-Schmidt. The two vectors of three become the first two rows of the matrix, or its columns."""
    first = lambda v: _let(F.array(*_unit(*_at(v, 0, 1, 2))), lambda u: second(u, _at(v, 3, 4, 5)))

    def second(u: Column, b: list[Column]) -> Column:
        b1 = _at(u, 0, 1, 2)
        rest = _let(b1[0] * b[0] + b1[1] * b[1] + b1[2] * b[2], lambda along: F.array(*[y - along * x for x, y in zip(b1, b)]))
        return _let(_let(rest, lambda r: F.array(*_unit(*_at(r, 0, 1, 2)))), lambda w: _third(u, w, as_columns))

    return _let(value, first)


def _third(u: Column, w: Column, as_columns: bool) -> Column:
    b1, b2 = _at(u, 0, 1, 2), _at(w, 0, 1, 2)
    b3 = [b1[1] * b2[2] - b1[2] * b2[1], b1[2] * b2[0] - b1[0] * b2[2], b1[0] * b2[1] - b1[1] * b2[0]]
    if as_columns:
        return F.array(*[x for row in zip(b1, b2, b3) for x in row])
    return F.array(*b1, *b2, *b3)


def to_6d(m: Column) -> Column:
    return F.slice(m, 1, 6)


def _axis(axis: str, angle: Column) -> list[list[Column]]:
    c, s, one, zero = F.cos(angle), F.sin(angle), F.lit(1.0), F.lit(0.0)
    if axis == "x":
        return [[one, zero, zero], [zero, c, -s], [zero, s, c]]
    if axis == "y":
        return [[c, zero, s], [zero, one, zero], [-s, zero, c]]
    return [[c, -s, zero], [s, c, zero], [zero, zero, one]]


def _times(a: list[list[Column]], b: list[list[Column]]) -> list[list[Column]]:
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] + a[i][2] * b[2][j] for j in range(3)] for i in range(3)]


def from_euler(v: Column, order: str) -> Column:
    """R(first) R(second) R(third) for the axes in ``order``."""

    def product(angles: Column) -> Column:
        p, q, r = (_axis(a, x) for a, x in zip(order, _at(angles, 0, 1, 2)))
        return F.array(*[x for row in _times(_times(p, q), r) for x in row])

    return _let(v, product)


def to_euler(m: Column, order: str) -> Column:
    """Angles of three different axes; the middle one is within half a turn."""
    i, j, k = ("xyz".index(a) for a in order)
    sign = 1.0 if (j - i) % 3 == 1 else -1.0

    def angles(own: Column) -> Column:
        at = lambda r, c: F.get(own, F.lit(3 * r + c))
        middle = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sign * at(i, k))))
        return F.array(F.atan2(-sign * at(j, k), at(k, k)), middle, F.atan2(-sign * at(i, j), at(i, i)))

    return _let(m, angles)


def to_matrix(v: Column, kind: str) -> Column:
    if kind == "matrix":
        return v
    if kind == "quaternion":
        return from_quaternion(v)
    if kind == "axis_angle":
        return from_quaternion(quaternion_from_axis_angle(v))
    if kind == "rotation_6d":
        return from_6d(v)
    return from_euler(v, kind.rpartition("_")[2])


def from_matrix(m: Column, kind: str) -> Column:
    if kind == "matrix":
        return m
    if kind == "quaternion":
        return to_quaternion(m)
    if kind == "axis_angle":
        return axis_angle_from_quaternion(to_quaternion(m))
    if kind == "rotation_6d":
        return to_6d(m)
    return to_euler(m, kind.rpartition("_")[2])


def convert(v: Column, source: str, target: str) -> Column:
    for kind in (source, target):
        if kind not in KINDS:
            raise ValueError(f"unknown rotation: {kind}")
    return from_matrix(to_matrix(v, source), target)
