"""Small recordings in canonical columns: a camera that moves along x and turns about y, hands fixed before it."""

import math

SCHEMA = (
    "ep long, f long, n long, ts double, dataset_index long, cam array<array<float>>, l_p array<float>, r_p array<float>, l_r6 array<float>, r_r6 array<float>, "
    "l_ap array<float>, r_ap array<float>, l_ar6 array<float>, r_ar6 array<float>, l_grip array<float>, raw_hand_feature array<float>, k array<double>, lens array<double>, width int, height int"
)
NAN = float("nan")


def yaw6(degrees):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [c, 0.0, s, 0.0, 1.0, 0.0]


def episode(ep, n, step=0.0, angle=0.0, invalid=(), external_bad=False, move=lambda f: (0.0, 0.0), turn=lambda f: 0.0, at=0):
    """move: metres added to the x of the left and right hand; turn: yaw of the left hand's rotation; invalid: frames without left position."""
    left, right, rots, cams = [], [], [], []
    for f in range(n):
        c, s = math.cos(math.radians(angle * f)), math.sin(math.radians(angle * f))
        x = step * f
        cams.append([[c, 0.0, s, x], [0.0, 1.0, 0.0, 0.0], [-s, 0.0, c, 0.0], [0.0, 0.0, 0.0, 1.0]])
        dl, dr = move(f)
        left.append([NAN if f in invalid else x - 0.1 * c + 2 * s + dl, 0.0, 0.1 * s + 2 * c])
        right.append([x + 0.1 * c + 2 * s + dr, 0.0, -0.1 * s + 2 * c])
        rots.append(yaw6(turn(f)))
    rows = []
    for f in range(n):
        g = min(f + 1, n - 1)
        target = [NAN, 0.0, 2.0] if external_bad and f == n - 1 else left[g]
        rows.append((ep, f, n, f / 30, at + f, cams[f], left[f], right[f], rots[f], yaw6(0), target, right[g], rots[g], yaw6(0), [0.5], [NAN, 1.0], [50.0, 0.0, 50.0, 0.0, 50.0, 50.0, 0.0, 0.0, 1.0], [0.0] * 5, 100, 100))
    return rows


def frames(spark, *episodes):
    return spark.createDataFrame([r for e in episodes for r in e], SCHEMA)
