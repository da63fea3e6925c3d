"""Registered queries over the given tables, with their SQL: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import BITS, REASONS, Settings
from .functions import geometry as G
from .functions import pixels
from .operators import intervals as I
from .operators import outliers, repair, rules
from .plans import cutplan, oracle, reports, store, timeline
from .sources import checks, frames, videos

S = Settings()
sql = oracle.sql
QUERIES: dict = {}
SQL: dict = {}


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = text
        return f

    return add


def r6(c):
    """Rounded for comparing across engines; NaN as null, and no negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), F.round(c, 6) + F.lit(0.0))


def q6(x: str) -> str:
    return f"CASE WHEN NOT isnan({x}) THEN round({x}, 6) + 0.0 END"


def long(c: str):
    return F.col(c).cast("long").alias(c)


# Frames and their validation


@query(sql(f"SELECT ep, f, n, {q6('cx')} AS cam_x, {q6('c')} AS r00, {q6('s')} AS r02, {q6('lx')} AS left_x, {q6('lz')} AS left_z, {q6('rx')} AS right_x, {q6('rz')} AS right_z FROM pose"))
def frames_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cam = F.col("cam")
    return frames.from_lineitem(spark, sf_dir).select("ep", "f", "n", r6(cam[0][3]).alias("cam_x"), r6(cam[0][0]).alias("r00"), r6(cam[0][2]).alias("r02"), r6(F.col("l_p")[0]).alias("left_x"), r6(F.col("l_p")[2]).alias("left_z"), r6(F.col("r_p")[0]).alias("right_x"), r6(F.col("r_p")[2]).alias("right_z"))


#: Failures that ``frame_validation`` plants: a frame fails a check where its number leaves a remainder.
_PLANTED = {"timestamp": (97, 13), "vector_width": (113, 1), "camera_finite": (109, 3), "camera_bottom_row": (101, 5), "camera_rigid": (103, 9), "camera_reflection": (107, 11)}


def _planted(check: str) -> str:
    every, at = _PLANTED[check]
    return f"f % {every} = {at}"


@query(sql("""SELECT 'frame_index' AS "check", count(*) FILTER (WHERE ep % 4 = 1 AND f > 50) AS failures FROM k UNION ALL SELECT 'length', count(*) FILTER (WHERE ep % 4 = 1) FROM k """ + " ".join(f"UNION ALL SELECT '{c}', count(*) FILTER (WHERE {_planted(c)}) FROM k" for c in _PLANTED)).replace("\nSELECT 'frame_index'", ",\nk AS (SELECT * FROM base WHERE NOT (ep % 4 = 1 AND f = 50))\nSELECT 'frame_index'"))
def frame_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted failures of every check: episodes that lack a frame, and frames with a wrong time, width or camera."""
    rows = frames.from_lineitem(spark, sf_dir).filter("NOT (ep % 4 = 1 AND f = 50)")
    cells = "CASE WHEN {finite} AND i = 0 AND j = 3 THEN double('nan') WHEN {bottom} AND i = 3 AND j = 3 THEN 2D WHEN i < 3 AND j < 3 THEN x * CASE WHEN {rigid} THEN 1.1D ELSE 1D END * CASE WHEN {reflection} AND j = 2 THEN -1D ELSE 1D END ELSE x END"
    cells = cells.format(finite=_planted("camera_finite"), bottom=_planted("camera_bottom_row"), rigid=_planted("camera_rigid"), reflection=_planted("camera_reflection"))
    rows = rows.withColumn("cam", F.expr(f"transform(cam, (row, i) -> transform(row, (x, j) -> {cells}))"))
    rows = rows.withColumn("ts", F.expr(f"ts + CASE WHEN {_planted('timestamp')} THEN 0.01D ELSE 0D END")).withColumn("l_p", F.expr(f"CASE WHEN {_planted('vector_width')} THEN slice(l_p, 1, 2) ELSE l_p END"))
    return checks.frame_failures(rows).select("check", "failures")


@query(sql("SELECT ep, sum(CASE WHEN f = n - 1 AND ep % 3 = 0 AND NOT isnan(lx) THEN 1 ELSE 0 END)::BIGINT AS l_mismatches, count(*) FILTER (WHERE f % 50 = 7) AS r_mismatches FROM pose GROUP BY ep"))
def delay_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions that are not the next state: bad last targets of the left hand, and moved ones of the right hand every 50 frames."""
    rows = frames.from_lineitem(spark, sf_dir).withColumn("r_ap", F.expr("transform(r_ap, x -> x + CASE WHEN f % 50 = 7 THEN 0.01D ELSE 0D END)"))
    tagged = outliers.delay_rows(frames.wide(rows))
    return tagged.groupBy("ep").agg(*[F.count_if(~F.col(f"{h}_matches")).alias(f"{h}_mismatches") for h in "lr"])


_SIX = "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS d FROM embeddings), n AS (SELECT vec_id, d, sqrt(d[4]*d[4]+d[5]*d[5]+d[6]*d[6]) AS n1 FROM e), x AS (SELECT *, d[4]/n1 AS x0, d[5]/n1 AS x1, d[6]/n1 AS x2 FROM n), s AS (SELECT *, x0*d[7]+x1*d[8]+x2*d[9] AS p FROM x), y AS (SELECT *, d[7]-p*x0 AS s0, d[8]-p*x1 AS s1, d[9]-p*x2 AS s2 FROM s), z AS (SELECT *, sqrt(s0*s0+s1*s1+s2*s2) AS n2 FROM y)"


def _unit_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, embedding, six (its dimensions 3 to 8) and unit: the same made orthonormal."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("six", F.slice("embedding", 4, 6))
    e, x = F.col("six"), F.col("x")
    n1 = F.sqrt(G.total(e[i] * e[i] for i in range(3)))
    rows = rows.withColumn("x", F.array(*[e[i] / n1 for i in range(3)]))
    rows = rows.withColumn("s", F.array(*[e[3 + i] - G.total(x[j] * e[3 + j] for j in range(3)) * x[i] for i in range(3)]))
    return rows.withColumn("unit", F.concat("x", F.transform("s", lambda v: v / G.norm(F.col("s"))))).drop("x", "s")


@query(_SIX + f"""SELECT vec_id, greatest(abs(x0-d[4]),abs(x1-d[5]),abs(x2-d[6]),abs(s0/n2-d[7]),abs(s1/n2-d[8]),abs(s2/n2-d[9])) <= 1e-3 AS raw_valid, vec_id % 5 <> 0 AS unit_valid,
  CASE WHEN vec_id % 5 = 0 THEN 1 ELSE {q6('x0')} END AS r00, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE {q6('s0/n2')} END AS r10, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE {q6('x1*s2/n2 - x2*s1/n2')} END AS r20 FROM z""")
def rot6d_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions 3 to 8 as a rotation: as they are, and made orthonormal first; every fifth of those is scaled, and so invalid."""
    first = G.rotation_6d(_unit_six(spark, sf_dir), "six", "raw", "raw_valid")
    first = first.withColumn("unit", F.expr("transform(unit, x -> x * CASE WHEN vec_id % 5 = 0 THEN 1.01D ELSE 1D END)"))
    out = G.rotation_6d(first, "unit", "m", "unit_valid")
    return out.select("vec_id", "raw_valid", "unit_valid", *[r6(F.col("m")[3 * i]).alias(f"r{i}0") for i in range(3)])


# Rotations about any axis, and lenses


def _rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.rotation_6d(_unit_six(spark, sf_dir), "unit", "m", "valid")


_NINE = "[x0, x1, x2, s0/n2, s1/n2, s2/n2, (x1*s2-x2*s1)/n2, (x2*s0-x0*s2)/n2, (x0*s1-x1*s0)/n2]"
_TURNS = _SIX + f", m AS (SELECT vec_id, d, {_NINE} AS a FROM z), t AS (SELECT *, lead(a) OVER (ORDER BY vec_id) AS b FROM m), q AS (SELECT *, [{', '.join('+'.join(f'a[{3 * k + i + 1}]*b[{3 * k + j + 1}]' for k in range(3)) for i in range(3) for j in range(3))}] AS q FROM t WHERE b IS NOT NULL), th AS (SELECT *, acos(greatest(-1, least(1, (q[1]+q[5]+q[9]-1)/2))) AS th FROM q)"


def _next_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rotations(spark, sf_dir)
    # Vectors are paired with their successors by number, a join of the table with itself; numbers have no gaps.
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("m").alias("to"))
    return rows.select("vec_id", "m").join(after, "vec_id")


@query(_TURNS + " SELECT vec_id, round(degrees(th), 4) + 0.0 AS angle FROM th")
def turn_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees from each vector's rotation to the next one's; SQL takes them from the trace."""
    rows = G.with_angle(_next_rotation(spark, sf_dir), "m", "to", "angle")
    return rows.select("vec_id", (F.round("angle", 4) + F.lit(0.0)).alias("angle"))


def _part(i: int, j: int) -> str:
    """Element of the turn by 0.3 of the angle, from the symmetric and skew parts of the whole turn."""
    p, r, same = 3 * i + j + 1, 3 * j + i + 1, int(i == j)
    return f"({same} + sin(0.3*th) * (q[{p}]-q[{r}]) / (2*sin(th)) + (1-cos(0.3*th)) * ((q[{p}]+q[{r}])/2 - {same}) / (1-cos(th)))"


def _q4(x: str) -> str:
    return f"round({x}, 4) + 0.0"


@query(_TURNS + ", p AS (SELECT *, [" + ", ".join(_part(i, j) for i in range(3) for j in range(3)) + "] AS p FROM th) SELECT vec_id, " + ", ".join(f"{_q4('+'.join(f'a[{3 * i + k + 1}]*p[{3 * k + j + 1}]' for k in range(3)))} AS r{i}{j}" for i in range(2) for j in range(3)) + " FROM p WHERE th BETWEEN 0.01 AND 3.13")
def turns_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tenths of the way from each vector's rotation to the next one's: first two rows, as repair keeps them."""
    rows = G.with_angle(_next_rotation(spark, sf_dir), "m", "to", "angle").filter("radians(angle) BETWEEN 0.01 AND 3.13")
    rows = G.slerp(rows.withColumn("share", F.lit(0.3)), "m", "to", "share", "between")
    return rows.select("vec_id", *[(F.round(F.col("between")[3 * i + j], 4) + F.lit(0.0)).alias(f"r{i}{j}") for i in range(2) for j in range(3)])


_LENS, _PINHOLE = (0.1, -0.05, 0.01, -0.02, 0.003), (120.0, 3.0, 60.0, 0.0, 110.0, 45.0, 0.0, 0.0, 1.0)
_IN_CAM = ", ".join("+".join(f"a[{3 * k + i + 1}]*(4*d[{k + 11}]-d[{k + 14}])" for k in range(3)) + f" AS c{i}" for i in range(3))


@query(_SIX + f""", m AS (SELECT vec_id, d, {_NINE} AS a FROM z), c AS (SELECT vec_id, {_IN_CAM} FROM m), h AS (SELECT vec_id, c0/c2 AS x, c1/c2 AS y FROM c WHERE c2 > 1e-3), r AS (SELECT *, x*x + y*y AS r FROM h),
  g AS (SELECT *, 1 + ({_LENS[0]})*r + ({_LENS[1]})*r*r + ({_LENS[4]})*r*r*r AS g FROM r), l AS (SELECT vec_id, x*g + 2*({_LENS[2]})*x*y + ({_LENS[3]})*(r+2*x*x) AS x, y*g + ({_LENS[2]})*(r+2*y*y) + 2*({_LENS[3]})*x*y AS y FROM g WHERE r < 4),
  w AS (SELECT vec_id, {_PINHOLE[0]}*x + {_PINHOLE[2]} AS u, {_PINHOLE[4]}*y + {_PINHOLE[5]} AS v FROM l)
  SELECT vec_id, {_q4('u')} AS u, {_q4('v')} AS v, u >= 0 AND u < 128 AND v >= 0 AND v < 96 AS inside, u >= 6.4 AND u < 121.6 AND v >= 4.8 AND v < 91.2 AS safe FROM w""")
def lens_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points before cameras at any attitude, through a lens with five coefficients, and an image that is not square; skew does not follow a lens."""
    rows = _seen_points(spark, sf_dir).withColumn("k", G.vector(*_PINHOLE)).withColumn("lens", G.vector(*_LENS))
    rows = G.with_projection(rows, "cam", "k", "lens", "uv")
    inside, safe = G.image_region(F.col("uv"), F.lit(True), F.lit(128), F.lit(96), S.edge_fraction)
    return rows.select("vec_id", *[(F.round(F.col("uv")[i], 4) + F.lit(0.0)).alias(n) for i, n in enumerate("uv")], inside.alias("inside"), safe.alias("safe"))


def _seen_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rotations(spark, sf_dir).withColumn("point", F.transform(F.slice("embedding", 11, 3), lambda x: 4 * x)).withColumn("centre", F.slice("embedding", 14, 3))
    # Written before it is filtered: a filter pushed down would write out every step of the rotation anew for each use.
    rows = store.written(rows.withColumn("cam", G.in_camera(F.col("m"), F.col("centre"), F.col("point"))).select("vec_id", "cam"), "seen")
    return rows.filter("cam[2] > 1e-3 AND pow(cam[0] / cam[2], 2) + pow(cam[1] / cam[2], 2) < 4")


#: Lenses of every model, and none.
_MODELS = (
    (0.0, 0.0, 0.0, 0.0), (0.1, -0.05, 0.01, -0.02), _LENS, (*_LENS, 0.2, 0.05, 0.01), (*_LENS, 0.2, 0.05, 0.01, 0.02, -0.01, 0.015, 0.03),
    (*_LENS, 0.2, 0.05, 0.01, 0.02, -0.01, 0.015, 0.03, 0.1, -0.15), (0.0,) * 12 + (0.1, -0.15),
)


def _models_sql() -> str:
    """Every model with all fourteen coefficients; the tilt as the plane through which a ray meets the turned sensor."""
    rows = ", ".join(f"({i}, {len(m)}, [{', '.join(map(str, (*m, *[0.0] * (14 - len(m)))))}]::DOUBLE[])" for i, m in enumerate(_MODELS))
    radial = "(1 + c[1]*r + c[2]*r*r + c[5]*r*r*r) / (1 + c[6]*r + c[7]*r*r + c[8]*r*r*r)"
    return _SIX + f""", m AS (SELECT vec_id, d, {_NINE} AS a FROM z), q AS (SELECT vec_id, {_IN_CAM} FROM m), h AS (SELECT vec_id, c0/c2 AS x, c1/c2 AS y FROM q WHERE c2 > 1e-3),
  o AS (SELECT *, x*x + y*y AS r FROM h, (VALUES {rows}) AS v(model, size, c)),
  l AS (SELECT vec_id, model, size, c, x*{radial} + 2*c[3]*x*y + c[4]*(r+2*x*x) + c[9]*r + c[10]*r*r AS x, y*{radial} + c[3]*(r+2*y*y) + 2*c[4]*x*y + c[11]*r + c[12]*r*r AS y FROM o WHERE r < 4),
  t AS (SELECT *, sin(c[13]) AS sa, cos(c[13]) AS ca, sin(c[14]) AS sb, cos(c[14]) AS cb FROM l),
  f AS (SELECT *, cb*x + sb*sa*y - sb*ca AS ex, ca*y + sa AS ey, sb*x - cb*sa*y + cb*ca AS ez FROM t),
  p AS (SELECT vec_id, model, size, (cb*ca*ex + sb*ca*ez) / ez AS x, (cb*ca*ey - sa*ez) / ez AS y FROM f)
  SELECT vec_id, model, size AS coefficients, {_q4(f"{_PINHOLE[0]}*x + CASE WHEN model = 0 THEN {_PINHOLE[1]}*y ELSE 0 END + {_PINHOLE[2]}")} AS u, {_q4(f"{_PINHOLE[4]}*y + {_PINHOLE[5]}")} AS v FROM p"""


@query(_models_sql())
def lens_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points through lenses of 4, 5, 8, 12 and 14 coefficients, one that is only tilted, and none."""
    lens = F.create_map(*[x for i, m in enumerate(_MODELS) for x in (F.lit(i), G.vector(*m))])
    rows = _seen_points(spark, sf_dir).withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(len(_MODELS) - 1))))
    rows = G.with_projection(rows.withColumn("k", G.vector(*_PINHOLE)).withColumn("lens", lens[F.col("model")]), "cam", "k", "lens", "uv")
    return rows.select("vec_id", "model", F.size("lens").alias("coefficients"), *[(F.round(F.col("uv")[i], 4) + F.lit(0.0)).alias(n) for i, n in enumerate("uv")])


@query("SELECT vec_id, round((vec_id * 37 % 18001) / 100.0::DOUBLE, 3) AS angle FROM embeddings UNION ALL SELECT -1 - vec_id, CASE vec_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 0.002 WHEN 2 THEN 179.998 ELSE 180 END::DOUBLE FROM embeddings")
def quaternion_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's rotation, and the same turned by a known angle about its own third axis: from 0 to 180 degrees, and close to both ends."""
    rows = _rotations(spark, sf_dir).select("vec_id", "m")
    some = rows.withColumn("degrees", F.expr("(vec_id * 37 % 18001) / 100D"))
    ends = rows.select((-1 - F.col("vec_id")).alias("vec_id"), "m", F.expr("CASE vec_id % 4 WHEN 0 THEN 0D WHEN 1 THEN 0.002D WHEN 2 THEN 179.998D ELSE 180D END").alias("degrees"))
    rows = some.unionByName(ends).withColumn("c", F.cos(F.radians("degrees"))).withColumn("s", F.sin(F.radians("degrees")))
    m, c, s = F.col("m"), F.col("c"), F.col("s")
    turned = F.array(*[x for i in range(3) for x in (m[3 * i] * c + m[3 * i + 1] * s, m[3 * i + 1] * c - m[3 * i] * s, m[3 * i + 2])])
    return G.with_quaternion_angle(rows.withColumn("to", turned), "m", "to", "angle").select("vec_id", (F.round("angle", 3) + F.lit(0.0)).alias("angle"))


_SAMPLES = ("(x + 1) * 100", "(x + 1) * 100 + (i + vec_id) % 7 - 3")


@query(f"""WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({_SAMPLES[0]}) AS INTEGER)) AS a, list_transform(embedding, lambda x, i: CASE WHEN vec_id % 9 = 0 THEN CAST(floor({_SAMPLES[0]}) AS INTEGER) ELSE CAST(floor({_SAMPLES[1].replace('i +', '(i - 1) +')}) AS INTEGER) END) AS b FROM embeddings),
  e AS (SELECT vec_id, list_sum(list_transform(range(1, len(a) + 1), lambda i: (a[i] - b[i]) * (a[i] - b[i]))) / len(a)::DOUBLE AS mse FROM p)
  SELECT vec_id, round(mse, 6) AS mse, CASE WHEN mse > 0 THEN round(10 * log10(65025 / mse), 6) END AS psnr, mse = 0 OR 10 * log10(65025 / mse) >= 24 AS passes FROM e""")
def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as images of 8-bit samples, and the same with some noise; every ninth without any."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    # In the components' own precision, as SQL has it: with whole numbers Spark would widen floats to doubles, whose floors differ next to a whole number.
    plain, noise = "(x + 1F) * 100F", "cast((i + vec_id) % 7 AS float) - 3F"
    a = F.expr(f"transform(embedding, x -> cast(floor({plain}) AS int))")
    b = F.expr(f"transform(embedding, (x, i) -> cast(floor(CASE WHEN vec_id % 9 = 0 THEN {plain} ELSE {plain} + {noise} END) AS int))")
    rows = rows.withColumn("mse", pixels.mse(a, b)).withColumn("db", pixels.psnr(F.col("mse")))
    return rows.select("vec_id", F.round("mse", 6).alias("mse"), F.when(F.col("mse") > 0, F.round("db", 6)).alias("psnr"), (F.col("db") >= pixels.LEAST_PSNR).alias("passes"))


# S1: detection


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.points(spark, sf_dir)


@query(sql(f"SELECT ep, hand, pt, {q6('pos')} AS position_step, {q6('rot')} AS rotation_step FROM jm WHERE valid AND pt2 IS NOT NULL"))
def pose_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outliers.steps(outliers.posed(outliers.points(frames.wide(frames.from_lineitem(spark, sf_dir)))), "valid")
    return rows.filter("valid AND next_q IS NOT NULL").select("ep", "hand", "pt", r6("pos").alias("position_step"), r6("rot_step").alias("rotation_step"))


@query(sql("SELECT ep, hand, pt, block::BIGINT AS block FROM bl WHERE block > 0"))
def jump_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).filter("block > 0").select("ep", "hand", "pt", long("block"))


@query(sql(f"SELECT ep, hand, {q6('max(tp)')} AS position_threshold, {q6('max(tr)')} AS rotation_threshold FROM hd WHERE calm GROUP BY ep, hand"))
def hampel_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).filter("calm").groupBy("ep", "hand").agg(r6(F.max("pos_threshold")).alias("position_threshold"), r6(F.max("rot_threshold")).alias("rotation_threshold"))


@query(sql("SELECT ep, hand, pt, spike::BIGINT AS spike FROM sp WHERE spike > 0"))
def hampel_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).filter("spike > 0").select("ep", "hand", "pt", long("spike"))


@query(sql("SELECT ep, hand, f, code::BIGINT AS state_code, acode::BIGINT AS action_code FROM act WHERE code <> 0 OR acode <> 0"))
def s1_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.action_codes(_points(spark, sf_dir)).filter("state_code <> 0 OR action_code <> 0").select("ep", "hand", "f", long("state_code"), long("action_code"))


@query(sql(f"""SELECT ep, hand, min(pt)::BIGINT AS "start", (max(pt) + 1)::BIGINT AS "end", bit_or(code)::BIGINT AS code,
  {q6('max(greatest(pin, pout))')} AS peak_position_step FROM (SELECT *, pt - row_number() OVER (PARTITION BY ep, hand ORDER BY pt) AS run FROM
  (SELECT *, lead(pin) OVER (PARTITION BY ep, hand ORDER BY pt) AS pout FROM (SELECT *, CASE WHEN valid AND lag(valid) OVER w THEN sqrt((x - lag(x) OVER w) ** 2 + (z - lag(z) OVER w) ** 2) END AS pin FROM cd WINDOW w AS (PARTITION BY ep, hand ORDER BY pt))) WHERE code <> 0) GROUP BY ep, hand, run"""))
def anomaly_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.anomaly_intervals(_points(spark, sf_dir)).select("ep", "hand", long("start"), long("end"), long("code"), r6("peak_position_step").alias("peak_position_step"))


_BITS = ", ".join(f"({b}, '{n}')" for b, n in BITS.items())


@query(sql(f"SELECT name AS reason, count(*) FILTER (WHERE code & bit <> 0) AS state_hand_frames, count(*) FILTER (WHERE acode & bit <> 0) AS action_hand_rows FROM act, (VALUES {_BITS}) AS b(bit, name) GROUP BY name"))
def anomaly_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = outliers.action_codes(_points(spark, sf_dir))
    sums = codes.agg(*[F.count_if(F.col(c).bitwiseAND(b) != 0).alias(f"{c}{b}") for c in ("state_code", "action_code") for b in BITS])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("reason"), F.col(f"state_code{b}").alias("state_hand_frames"), F.col(f"action_code{b}").alias("action_hand_rows")) for b, n in BITS.items()])))


# S1: repair


@query(sql('SELECT ep, hand, g0::BIGINT AS "start", g1::BIGINT AS "end", bit_or(code)::BIGINT AS code, bool_and(repaired) AS repaired FROM rp WHERE code <> 0 GROUP BY ep, hand, g0, g1'))
def s1_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.gaps(_points(spark, sf_dir)).select("ep", "hand", long("start"), long("end"), long("code"), "repaired")


@query(sql(f"SELECT ep, hand, pt, {q6('fx')} AS x, {q6('fz')} AS z FROM fx WHERE repaired"))
def s1_lerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).filter("repaired").select("ep", "hand", "pt", r6(F.col("p2")[0]).alias("x"), r6(F.col("p2")[2]).alias("z"))


@query(sql(f"SELECT ep, hand, pt, {q6('cos(radians(fphi))')} AS r00, {q6('sin(radians(fphi))')} AS r02 FROM fx WHERE repaired"))
def s1_slerp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).filter("repaired").select("ep", "hand", "pt", r6(F.col("r62")[0]).alias("r00"), r6(F.col("r62")[2]).alias("r02"))


@query(sql("SELECT ep, f FROM fr WHERE s1"))
def s1_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s1").select("ep", "f")


@query(sql("SELECT ep, count(*) FILTER (WHERE repaired) AS repaired_hand_frames, count(*) FILTER (WHERE NOT ok) AS unresolved_hand_frames, count(*) FILTER (WHERE arepaired) AS repaired_action_hand_rows, count(*) FILTER (WHERE NOT aok) AS unresolved_action_hand_rows FROM act GROUP BY ep"))
def s1_repair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_counts(store.frames(spark, sf_dir), _points(spark, sf_dir)).select("ep", *[long(c) for c in ("repaired_hand_frames", "unresolved_hand_frames", "repaired_action_hand_rows", "unresolved_action_hand_rows")])


# S2


@query(sql(f"SELECT ep, f, {q6('lu')} AS left_u, {q6('ru')} AS right_u FROM uv"))
def project_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).select("ep", "f", r6(F.col("l_uv")[0]).alias("left_u"), r6(F.col("r_uv")[0]).alias("right_u"))


@query(sql("SELECT ep, f, lin AS l_inside, lsafe AS l_safe, rin AS r_inside, rsafe AS r_safe FROM rg"))
def s2_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).select("ep", "f", "l_inside", "l_safe", "r_inside", "r_safe")


@query(sql('SELECT ep, min(f)::BIGINT AS "start", (max(f) + 1)::BIGINT AS "end" FROM e2 WHERE s2 GROUP BY ep, run'))
def s2_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.runs(store.frames(spark, sf_dir).filter("s2"), ["ep"]).select("ep", long("start"), long("end"))


@query(sql(f"""SELECT ep, min(f)::BIGINT AS "start", count(*) FILTER (WHERE lin AND NOT lsafe) AS l_edge, count(*) FILTER (WHERE NOT lin) AS l_out, {q6('min(lu / 100)')} AS l_u_min, {q6('max(ru / 100)')} AS r_u_max FROM e2 WHERE s2 GROUP BY ep, run"""))
def edge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.edge_segments(store.frames(spark, sf_dir)).select("ep", long("start"), long("l_edge"), long("l_out"), r6("l_u_min").alias("l_u_min"), r6("r_u_max").alias("r_u_max"))


@query(sql('SELECT ep, min(f)::BIGINT AS "start", (max(f) + 1)::BIGINT AS "end" FROM sg WHERE keep GROUP BY ep, seg'))
def retained_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("keep").groupBy("ep", "seg").agg(F.min("f").alias("start"), (F.max("f") + 1).alias("end")).select("ep", "start", "end")


# S3


@query(sql(f"SELECT ep, f, {q6('d3')} AS distance, {q6('a3')} AS angle, t3 AS translation, r3 AS rotation FROM h3 WHERE t3 OR r3"))
def s3_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s3_t OR s3_r").select("ep", "f", r6("s3_distance").alias("distance"), r6("s3_angle").alias("angle"), F.col("s3_t").alias("translation"), F.col("s3_r").alias("rotation"))


@query(sql("SELECT ep, f, s3::BIGINT AS s3 FROM m3 WHERE s3 > 0"))
def s3_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s3 > 0").select("ep", "f", long("s3"))


_NEAR = "(SELECT ep, f, d3, a3, sum(new) OVER (PARTITION BY ep ORDER BY f) AS g FROM (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY ep ORDER BY f) <= 6 THEN 0 ELSE 1 END AS new FROM h3 WHERE {0}))"


@query(sql(" UNION ALL ".join(f"""SELECT ep, '{kind}' AS kind, g::BIGINT AS segment, min(f)::BIGINT AS "start", (max(f) + 6)::BIGINT AS "end", count(*) AS hits, {q6('max(d3)')} AS max_distance, {q6('max(a3)')} AS max_angle FROM {_NEAR.format(flag)} GROUP BY ep, g""" for kind, flag in (("translation", "t3"), ("rotation", "r3")))))
def s3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits at most a window apart, as segments of each kind, with their extremes."""
    return reports.camera_segments(store.frames(spark, sf_dir)).select("ep", "kind", long("segment"), "start", "end", "hits", r6("max_distance").alias("max_distance"), r6("max_angle").alias("max_angle"))


def _coverage(name: str) -> str:
    return f"max({name}::INT) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"


@query(sql(f"""SELECT ep, count(*) FILTER (WHERE t3) AS translation_hits, count(*) FILTER (WHERE r3) AS rotation_hits, count(*) FILTER (WHERE t3 AND r3) AS both_hits,
  sum(ct)::BIGINT AS translation_covered, sum(cr)::BIGINT AS rotation_covered, sum(ct * cr)::BIGINT AS overlap_covered, sum(greatest(ct, cr))::BIGINT AS union_covered
  FROM (SELECT *, {_coverage('t3')} AS ct, {_coverage('r3')} AS cr FROM h3) GROUP BY ep"""))
def camera_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals between frames (the last evidence frame left out) that hits cover, by kind, in common and together."""
    return reports.camera_coverage(store.frames(spark, sf_dir))


@query(sql(f"""SELECT ep, translation_hits, rotation_hits, {q6('max_distance')} AS max_distance, {q6('max_angle')} AS max_angle, {q6('u / 30.0::DOUBLE')} AS union_seconds FROM (
  SELECT ep, count(*) FILTER (WHERE t3) AS translation_hits, count(*) FILTER (WHERE r3) AS rotation_hits, max(d3) AS max_distance, max(a3) AS max_angle, sum(greatest(ct, cr)) AS u
  FROM (SELECT *, {_coverage('t3')} AS ct, {_coverage('r3')} AS cr FROM h3) GROUP BY ep) WHERE translation_hits + rotation_hits > 0"""))
def camera_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.camera_videos(store.frames(spark, sf_dir)).select("ep", "translation_hits", "rotation_hits", r6("max_distance").alias("max_distance"), r6("max_angle").alias("max_angle"), r6("union_seconds").alias("union_seconds"))


@query(sql(f"""SELECT ep, count(DISTINCT run) FILTER (WHERE s2) AS bad_segments, count(*) FILTER (WHERE s2) AS bad_frames, {q6('round(count(*) FILTER (WHERE s2) / count(*)::DOUBLE, 6)')} AS bad_share FROM e2 GROUP BY ep HAVING bool_or(s2)"""))
def edge_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.edge_videos(store.frames(spark, sf_dir)).select("ep", "bad_segments", "bad_frames", r6("bad_share").alias("bad_share"))


_BOTH = ", ".join(f"any_value({c}::BIGINT) FILTER (WHERE hand = '{h}') AS {h}_{k}_code" for h in "lr" for k, c in (("state", "code"), ("action", "acode")))


@query(sql(f"SELECT ep, f, {_BOTH} FROM act GROUP BY ep, f HAVING sum(code + acode) > 0"))
def sparse_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sparse_labels(_points(spark, sf_dir)).select("ep", "f", *[long(f"{h}_{k}_code") for h in "lr" for k in ("state", "action")])


@query(sql("""SELECT ep, sum(s)::BIGINT AS state_suspect_frames, sum(a)::BIGINT AS action_suspect_rows FROM (SELECT ep, f, max((code > 0)::INT) AS s, max((acode > 0)::INT) AS a FROM act GROUP BY ep, f) GROUP BY ep HAVING sum(s) + sum(a) > 0"""))
def affected_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.affected_episodes(_points(spark, sf_dir)).select("ep", "state_suspect_frames", "action_suspect_rows")


# S4


@query(sql(f"SELECT ep, f, {q6('a3')} AS angle_6, {q6('a4')} AS angle_30 FROM h4 WHERE keep"))
def rotation_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("keep").select("ep", "f", r6("s3_angle").alias("angle_6"), r6("s4_angle").alias("angle_30"))


@query(sql(f"SELECT ep, f, {q6('lsp')} AS left_spread, {q6('rsp')} AS right_spread FROM w4 WHERE lsp IS NOT NULL"))
def cosine_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s4_window").select("ep", "f", r6("l_spread").alias("left_spread"), r6("r_spread").alias("right_spread"))


@query(sql("SELECT ep, f, t4 AS translation, r4 AS rotation FROM h4 WHERE t4 OR r4"))
def s4_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s4_t OR s4_r").select("ep", "f", F.col("s4_t").alias("translation"), F.col("s4_r").alias("rotation"))


@query(sql("""SELECT ep, 'translation' AS kind, min(f)::BIGINT AS "start", (max(f) + 31)::BIGINT AS "end", count(*) AS starts FROM q4 WHERE tq GROUP BY ep, seg, ut UNION ALL SELECT ep, 'rotation', min(f)::BIGINT, (max(f) + 31)::BIGINT, count(*) FROM q4 WHERE rq GROUP BY ep, seg, ur"""))
def s4_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualified runs of window starts, with the frames their windows cover."""
    rows, out = store.frames(spark, sf_dir), None
    for kind, flag in (("translation", "s4_tq"), ("rotation", "s4_rq")):
        one = I.runs(rows.filter(flag), ["ep", "seg"], "f", F.count(F.lit(1)).alias("starts")).select("ep", F.lit(kind).alias("kind"), "start", (F.col("end") + S.s4_gap).alias("end"), "starts")
        out = one if out is None else out.unionByName(one)
    return out


@query(sql("SELECT ep, f, s4::BIGINT AS s4 FROM m4 WHERE s4 > 0"))
def s4_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).filter("s4 > 0").select("ep", "f", long("s4"))


@query(sql("SELECT ep, count(*) FILTER (WHERE lsp IS NOT NULL) AS windows, count(*) FILTER (WHERE t4 OR r4) AS raw_hits, count(*) FILTER (WHERE tq OR rq) AS qualified_hits FROM q4 GROUP BY ep"))
def s4_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).groupBy("ep").agg(F.count_if("s4_window").alias("windows"), F.count_if(F.expr("s4_t OR s4_r")).alias("raw_hits"), F.count_if(F.expr("s4_tq OR s4_rq")).alias("qualified_hits"))


# Attribution, timeline, accounts


@query(sql("SELECT ep, f, code::BIGINT AS code, reason::BIGINT AS reason FROM jd"))
def attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.frames(spark, sf_dir).select("ep", "f", long("code"), long("reason"))


def _pieces(spark: SparkSession, sf_dir: str, s: Settings = S) -> DataFrame:
    return timeline.timeline(store.frames(spark, sf_dir, s))


_TIMELINE = 'SELECT ep, "start"::BIGINT AS "start", "end"::BIGINT AS "end", code::BIGINT AS code, reason::BIGINT AS reason FROM tl'


def _columns(pieces: DataFrame) -> DataFrame:
    return pieces.select("ep", long("start"), long("end"), long("code"), long("reason"))


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(_pieces(spark, sf_dir))


_timeline.__name__ = "timeline"
query(sql(_TIMELINE))(_timeline)


@query(sql("""SELECT ep, "start"::BIGINT AS "start", "end"::BIGINT AS "end", array_to_string(matches, ';') AS matches FROM ms"""))
def rule_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).select("ep", long("start"), long("end"), F.concat_ws(";", F.transform("matches", lambda x: x.cast("string"))).alias("matches"))


_NAMES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in REASONS.items())


@query(sql(f"""SELECT ep, "start"::BIGINT AS "start", "end"::BIGINT AS "end", printf('%.6f', "start" / 30.0::DOUBLE) AS start_seconds, printf('%.6f', "end" / 30.0::DOUBLE) AS end_seconds, 'S' || code AS stage, CASE reason {_NAMES} END AS reason FROM tl WHERE code > 0"""))
def rejected_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pieces(spark, sf_dir).filter("code > 0")
    return rows.select("ep", long("start"), long("end"), G.seconds(F.col("start")).alias("start_seconds"), G.seconds(F.col("end")).alias("end_seconds"), F.concat(F.lit("S"), F.col("code").cast("string")).alias("stage"), timeline.reason_name(F.col("reason")).alias("reason"))


_STAGE = """SELECT ep, '{0}' AS stage, count(*) FILTER (WHERE {1}) AS input_frames, count(*) FILTER (WHERE {2}) AS matched_frames, count(*) FILTER (WHERE code = {3}) AS removed_frames, count(*) FILTER (WHERE {2} AND code <> {3}) AS overlap_frames, count(*) FILTER (WHERE {1} AND code <> {3}) AS kept_frames FROM jd GROUP BY ep"""


@query(sql(" UNION ALL ".join(_STAGE.format(*x) for x in (("S1", "true", "s1", 1), ("S2", "NOT s1", "s2", 2), ("S4", "keep", "s4 > 0", 4), ("S3", "keep AND s4 = 0", "s3 > 0", 3)))))
def stage_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.stage_accounts(store.frames(spark, sf_dir)).drop("matched_intervals", "removed_intervals")


_ACCOUNTS = " UNION ALL ".join(_STAGE.format(*x) for x in (("S1", "true", "s1", 1), ("S2", "NOT s1", "s2", 2), ("S4", "keep", "s4 > 0", 4), ("S3", "keep AND s4 = 0", "s3 > 0", 3)))


@query(sql("""SELECT coalesce(a.ep, l.ep) AS ep, stage, CASE WHEN n IS NULL THEN 'no episode' WHEN stage IS NULL THEN 'no account' WHEN r + k <> i THEN 'input' WHEN r + o <> m THEN 'matches' ELSE 'order' END AS problem
  FROM a FULL JOIN (SELECT * FROM lengths WHERE ep % 11 <> 4) l ON a.ep = l.ep WHERE n IS NULL OR stage IS NULL OR r + k <> i OR r + o <> m OR i <> coalesce(before, n)""").replace("\nSELECT coalesce(a.ep", f""",
a0 AS ({_ACCOUNTS}),
a AS (SELECT ep, stage, input_frames - CASE WHEN ep % 11 = 1 AND stage = 'S2' THEN 1 ELSE 0 END AS i, matched_frames + CASE WHEN ep % 11 = 2 AND stage = 'S4' THEN 1 ELSE 0 END AS m, removed_frames AS r, overlap_frames AS o,
  kept_frames AS k, lag(kept_frames) OVER (PARTITION BY ep ORDER BY CASE stage WHEN 'S1' THEN 1 WHEN 'S2' THEN 2 WHEN 'S4' THEN 3 ELSE 4 END) AS before FROM a0 WHERE ep % 11 <> 3 AND NOT (ep % 11 = 5 AND stage = 'S2' AND removed_frames > 0))
SELECT coalesce(a.ep"""))
def unbalanced_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with planted losses: a frame less, a match more, no accounts, no episode, and a stage that is missing."""
    rows = store.frames(spark, sf_dir)
    lost = timeline.stage_accounts(rows).filter("ep % 11 <> 3 AND NOT (ep % 11 = 5 AND stage = 'S2' AND removed_frames > 0)")
    lost = lost.withColumn("input_frames", F.expr("input_frames - CASE WHEN ep % 11 = 1 AND stage = 'S2' THEN 1 ELSE 0 END")).withColumn("matched_frames", F.expr("matched_frames + CASE WHEN ep % 11 = 2 AND stage = 'S4' THEN 1 ELSE 0 END"))
    return timeline.unbalanced(lost, rows.groupBy("ep").agg(F.max("n").alias("n")).filter("ep % 11 <> 4"))


@query(sql(f"""SELECT reason::BIGINT AS reason, CASE reason {_NAMES} END AS name, sum(e)::BIGINT AS exclusive_frames, sum(m)::BIGINT AS matched_frames FROM (SELECT reason, "end" - "start" AS e, 0 AS m FROM tl WHERE code > 0 UNION ALL SELECT unnest(matches), 0, "end" - "start" FROM ms) GROUP BY reason"""))
def reason_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.reason_accounts(_pieces(spark, sf_dir)).select(long("reason"), "name", "exclusive_frames", "matched_frames")


@query(sql(f"SELECT ep, count(*) AS source_frames, count(*) FILTER (WHERE code > 0) AS rejected_frames, count(*) FILTER (WHERE code = 0) AS accepted_frames, {q6('count(*) / 30.0::DOUBLE')} AS duration_seconds, {q6('count(*) FILTER (WHERE code > 0) / count(*)::DOUBLE')} AS removed_share FROM jd GROUP BY ep"))
def episode_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.episode_summary(store.frames(spark, sf_dir)).select("ep", "source_frames", "rejected_frames", "accepted_frames", r6("duration_seconds").alias("duration_seconds"), r6("removed_share").alias("removed_share"))


_LOST = 'ep % 3 = 0 AND ("start" + "end") % 2 = 0'


@query(sql("""SELECT coalesce(c.ep, l.ep) AS ep, "start"::BIGINT AS "start", n::BIGINT AS n FROM c FULL JOIN lengths l ON c.ep = l.ep
  WHERE "start" <> before OR "end" <= "start" OR ("after" IS NULL AND "end" <> n) OR n IS NULL OR "start" IS NULL""").replace("\nSELECT coalesce", f""",
c AS (SELECT *, coalesce(lag("end") OVER w, 0) AS before, lead("start") OVER w AS "after" FROM tl WHERE NOT ({_LOST}) WINDOW w AS (PARTITION BY ep ORDER BY "start"))
SELECT coalesce"""))
def conservation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where timelines that have lost some pieces are no partitions of their episodes."""
    rows = store.frames(spark, sf_dir)
    pieces = timeline.timeline(rows).filter("NOT (ep % 3 = 0 AND (start + end) % 2 = 0)")
    return timeline.conservation_errors(pieces, rows.groupBy("ep").agg(F.max("n").alias("n"))).select("ep", long("start"), long("n"))


@query(sql(_TIMELINE, on3=0))
def skip_s3_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(_pieces(spark, sf_dir, Settings(skip_s3=True)))


@query(sql(_TIMELINE, t3=0.05, r3=5.0))
def s3_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(_pieces(spark, sf_dir, Settings(s3_translation=0.05, s3_rotation=5.0)))


# Checks of metadata, indices, labels and timelines, with planted failures


def _episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ep from 0, n, first and last index, own files and videos, as the metadata of recordings have them."""
    rows = frames.from_lineitem(spark, sf_dir).groupBy("ep").agg(F.max("n").alias("n"))
    before = F.sum("n").over(I.over([F.floor(F.col("ep") / 1_000_000)], "ep")) - F.col("n")
    rows = rows.withColumn("from_index", before).withColumn("to_index", F.col("from_index") + F.col("n")).withColumn("data_path", F.concat_ws("/", F.lit("d"), "ep"))
    for v in frames.VIEWS:
        rows = rows.withColumn(f"{v}_path", F.concat_ws("/", F.lit(v), "ep")).withColumn(f"{v}_from", F.lit(0.0)).withColumn(f"{v}_to", F.col("n") / 30.0)
    return rows.withColumn("k", G.vector(*_PINHOLE)).withColumn("lens", G.vector(*_LENS)).withColumn("width", F.lit(128)).withColumn("height", F.lit(96))


_EPISODES = "SELECT ep, max(n) AS n FROM base GROUP BY ep"


@query(sql(f"""SELECT ep, f, CAST(total - n + f + CASE WHEN f % 61 = 5 AND ep % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS dataset_index FROM (SELECT b.ep, b.f, b.n, total FROM base b JOIN (SELECT ep, sum(n) OVER (ORDER BY ep) AS total FROM ({_EPISODES})) t ON t.ep = b.ep)
  WHERE (f % 61 = 5 AND ep % 3 = 0) OR (f = n - 1 AND ep % 7 = 2)"""))
def index_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with an index that is one too high, and episodes that end elsewhere than their metadata say."""
    episodes = _episodes(spark, sf_dir)
    rows = frames.from_lineitem(spark, sf_dir).select("ep", "f", "n").join(episodes.select("ep", "from_index"), "ep")
    rows = rows.withColumn("dataset_index", (F.col("from_index") + F.col("f") + F.when((F.col("f") % 61 == 5) & (F.col("ep") % 3 == 0), 1).otherwise(0)).cast("long")).drop("from_index")
    moved = episodes.withColumn("to_index", F.col("to_index") - F.when(F.col("ep") % 7 == 2, 1).otherwise(0))
    return checks.index_failures(rows, moved).select("ep", "f", "dataset_index")


_BAD_CAMERAS = {"intrinsics_shape": (11, 1), "intrinsics_finite": (13, 2), "focal_length": (17, 3), "lens_finite": (19, 4), "lens_model": (23, 5), "image_size": (29, 6)}


def _bad_camera(check: str) -> str:
    every, at = _BAD_CAMERAS[check]
    return f"ep % {every} = {at}" + (" OR ep % 11 = 1" if check == "focal_length" else "")  # a matrix of another shape has none in its place


@query(sql(" UNION ALL ".join(f"""SELECT '{c}' AS "check", count(*) FILTER (WHERE {_bad_camera(c)}) AS failures, min(ep) FILTER (WHERE {_bad_camera(c)}) AS first_ep FROM ({_EPISODES})""" for c in _BAD_CAMERAS)))
def camera_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with intrinsics of another shape, not finite, or without a focal length, lenses that no model has, and images without a size."""
    bad = {c: F.col("ep") % m == r for c, (m, r) in _BAD_CAMERAS.items()}
    k = F.expr("transform(k, (x, i) -> CASE WHEN ep % 13 = 2 AND i = 1 THEN double('nan') WHEN ep % 17 = 3 AND i = 4 THEN -x ELSE x END)")
    rows = _episodes(spark, sf_dir).withColumn("k", F.when(bad["intrinsics_shape"], G.vector(*_PINHOLE[:4], *_PINHOLE[3:5], 1.0)).otherwise(k))
    rows = rows.withColumn("k", F.when(bad["intrinsics_shape"] & bad["intrinsics_finite"], F.concat(F.slice("k", 1, 6), G.vector(float("nan")))).otherwise(F.col("k")))
    rows = rows.withColumn("lens", F.when(bad["lens_model"], G.vector(*[0.1] * 6)).otherwise(F.col("lens"))).withColumn("lens", F.when(bad["lens_finite"], F.concat(G.vector(float("inf")), F.slice("lens", 2, 20))).otherwise(F.col("lens")))
    return checks.camera_failures(rows.withColumn("height", F.when(bad["image_size"], 0).otherwise(F.col("height"))))


@query(sql(f"""SELECT c.name AS "check", CASE c.name WHEN 'fps' THEN 1 WHEN 'episode_count' THEN (SELECT (count(*) FILTER (WHERE ep % 10 = 9) > 0)::BIGINT FROM e) WHEN 'episode_index' THEN 1 WHEN 'frame_total' THEN 1 WHEN 'data_files' THEN 1 WHEN 'video_files' THEN 0
  WHEN 'video_duration' THEN (SELECT count(*) FILTER (WHERE ep % 10 <> 9 AND ep % 6 = 1) FROM e) ELSE (SELECT count(*) FILTER (WHERE ep % 10 <> 9 AND ep % 8 = 3) FROM e) END::BIGINT AS failures
  FROM (VALUES ('fps'), ('episode_count'), ('episode_index'), ('frame_total'), ('data_files'), ('video_files'), ('video_duration'), ('empty_episode')) AS c(name)""").replace('\nSELECT c.name', f",\ne AS ({_EPISODES})\nSELECT c.name"))
def metadata_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata that lack every tenth episode, name one file twice, have videos that are too short and episodes without frames, under another frame rate."""
    episodes = _episodes(spark, sf_dir)
    info = episodes.agg(F.lit(25).alias("fps"), F.count(F.lit(1)).alias("total_episodes"), F.sum("n").alias("total_frames"))
    rows = episodes.filter("ep % 10 <> 9").withColumn("data_path", F.when(F.col("ep") < 2, F.lit("d/0")).otherwise(F.col("data_path")))
    rows = rows.withColumn("n", F.when(F.col("ep") % 8 == 3, 0).otherwise(F.col("n"))).withColumns({f"{v}_to": F.when(F.col("ep") % 8 == 3, 0.0).otherwise(F.col(f"{v}_to")) for v in frames.VIEWS})
    rows = rows.withColumn("camera_aux_0_to", F.col("camera_aux_0_to") - F.when(F.col("ep") % 6 == 1, 0.5).otherwise(0.0))
    return checks.episode_failures(rows, info)


@query(sql("SELECT ep, CASE WHEN ep % 9 = 1 THEN 0 ELSE 1 END::BIGINT AS in_left, CASE WHEN ep % 9 = 2 THEN 2 WHEN ep % 9 = 3 THEN 0 ELSE 1 END::BIGINT AS in_right FROM (SELECT DISTINCT ep FROM base) WHERE ep % 9 IN (1, 2, 3)"))
def partner_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that one of two tables lacks, or has twice, where each must have each once."""
    rows = frames.from_lineitem(spark, sf_dir).groupBy("ep").agg(F.max("n").alias("n"))
    right = rows.filter("ep % 9 <> 3").unionByName(rows.filter("ep % 9 = 2"))
    return checks.missing_partners(rows.filter("ep % 9 <> 1"), right, ["ep"])


@query(sql("SELECT ep, f FROM base WHERE (f % 53 = 7 AND ep % 2 = 0) OR (f % 59 = 8 AND ep % 2 = 1) OR (ep % 6 = 5 AND f = 12)"))
def label_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a changed position, a rotation that has become NaN, and a row that is lost."""
    rows = frames.from_lineitem(spark, sf_dir).select("ep", "f", "ts", "r_p", "l_r6")
    made = rows.withColumn("r_p", F.expr("CASE WHEN f % 53 = 7 AND ep % 2 = 0 THEN transform(r_p, x -> x + 1e-9D) ELSE r_p END"))
    made = made.withColumn("l_r6", F.expr("CASE WHEN f % 59 = 8 AND ep % 2 = 1 THEN transform(l_r6, x -> double('nan')) ELSE l_r6 END")).filter("NOT (ep % 6 = 5 AND f = 12)")
    return checks.changed_rows(rows, made, ["ep", "f"])


@query(sql("SELECT j.ep, j.f FROM jd j JOIN lengths l ON l.ep = j.ep WHERE s1 AND f % 5 = 0 AND f < l.n - 1"))
def invalid_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose state is invalid and that S1 has come to keep, as every fifth one here; the last frame, which a target beyond the end may reject too, is left out."""
    rows = store.frames(spark, sf_dir).withColumn("s1", F.col("s1") & (F.col("f") % 5 != 0))
    return checks.unrejected_invalid(rows.filter("f < n - 1"))


@query(sql("""SELECT DISTINCT ep, problem FROM (
  SELECT t.ep, 'status' AS problem FROM tl t WHERE t.ep % 8 = 1 AND "start" = 0 AND code = 0 UNION ALL SELECT ep, 'gap or overlap' FROM tl WHERE ep % 8 = 2 AND "start" > 0 AND code = 0
  UNION ALL SELECT ep, 'missing' FROM lengths WHERE ep % 8 = 3 UNION ALL SELECT ep, 'length' FROM lengths WHERE ep % 8 = 4 UNION ALL SELECT ep, 'rejected total' FROM lengths WHERE ep % 8 = 5 UNION ALL SELECT ep, 'frame total' FROM lengths WHERE ep % 8 = 6)"""))
def timeline_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timelines read back with an unknown status, a piece that begins early, no pieces, and totals that differ."""
    rows = store.frames(spark, sf_dir)
    pieces = _pieces(spark, sf_dir).select("ep", "start", "end", F.when(F.col("code") > 0, "reject").otherwise("keep").alias("status")).filter("ep % 8 <> 3")
    pieces = pieces.withColumn("status", F.expr("CASE WHEN ep % 8 = 1 AND start = 0 AND status = 'keep' THEN 'other' ELSE status END"))
    first = F.min(F.when((F.col("start") > 0) & (F.col("status") == "keep"), F.col("start"))).over(Window.partitionBy("ep"))
    late = (F.col("ep") % 8 == 2) & (F.col("start") == first)
    pieces = pieces.withColumn("start", F.col("start") - F.when(late, 1).otherwise(0))
    episodes = timeline.episode_summary(rows).select("ep", F.col("source_frames").alias("n"), "rejected_frames", "accepted_frames")
    kind = F.col("ep") % 8
    episodes = episodes.withColumn("n", F.col("n") + F.when(kind == 4, 1).otherwise(0)).withColumn("rejected_frames", F.col("rejected_frames") + F.when(kind == 5, 1).otherwise(0)).withColumn("accepted_frames", F.col("accepted_frames") - F.when(kind == 6, 1).otherwise(0))
    return cutplan.checked_timeline(pieces, episodes)


# Interval algebra over events: a span for each event, by user


_SPANS = "e AS (SELECT user_id, event_type, (event_id * 7) % 2000 AS \"start\", (event_id * 7) % 2000 + CAST(floor(value) AS BIGINT) % 40 AS \"end\" FROM events)"
_MARKS = "b AS (SELECT user_id, p, sum(k) OVER w AS held, sum(g) OVER w AS gone, lead(p) OVER (PARTITION BY user_id ORDER BY p) AS until FROM (SELECT user_id, p, sum(k) AS k, sum(g) AS g FROM (SELECT user_id, \"start\" AS p, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS k, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS g FROM e WHERE \"end\" > \"start\" UNION ALL SELECT user_id, \"end\", CASE WHEN event_type = 'click' THEN 0 ELSE -1 END, CASE WHEN event_type = 'click' THEN -1 ELSE 0 END FROM e WHERE \"end\" > \"start\") GROUP BY user_id, p) WINDOW w AS (PARTITION BY user_id ORDER BY p)), s AS (SELECT *, CASE WHEN lag(until) OVER w = p THEN 0 ELSE 1 END AS new FROM b WHERE {0} AND until IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY p))"
_GROUPED = 'SELECT user_id, min(p)::BIGINT AS "start", max(until)::BIGINT AS "end" FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY p) AS grp FROM s) GROUP BY user_id, grp'


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    start = (F.col("event_id") * 7) % 2000
    return rows.select("user_id", "event_type", start.alias("start"), (start + F.floor("value") % 40).alias("end"))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _spans(spark, sf_dir)
    return rows.filter("event_type <> 'click'"), rows.filter("event_type = 'click'")


@query(f"WITH {_SPANS}, {_MARKS.format('held + gone > 0')} {_GROUPED}")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.merged(_spans(spark, sf_dir), ["user_id"])


@query(f"WITH {_SPANS}, {_MARKS.format('held > 0 AND gone = 0')} {_GROUPED}")
def interval_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.subtracted(*_sides(spark, sf_dir), ["user_id"])


@query(f"WITH {_SPANS}, {_MARKS.format('held > 0 AND gone > 0')} {_GROUPED}")
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.intersected(*_sides(spark, sf_dir), ["user_id"])


@query(f"WITH m AS (SELECT *, median(value) OVER (PARTITION BY user_id) AS md FROM events) SELECT user_id, {q6('max(md)')} AS middle, {q6('median(abs(value - md))')} AS mad FROM m GROUP BY user_id")
def user_value_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians over values with their counts, so that a busy user's rows are added up before they meet."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id", "value").agg(F.count(F.lit(1)).alias("n"))
    middle = rows.groupBy("user_id").agg(F.percentile("value", F.lit(0.5), F.col("n")).alias("md"))
    spread = F.percentile(F.abs(F.col("value") - F.col("md")), F.lit(0.5), F.col("n"))
    return rows.join(middle, "user_id").groupBy("user_id").agg(r6(F.max("md")).alias("middle"), r6(spread).alias("mad"))


@query("SELECT event_id, CASE WHEN (event_id * 256) % 512 = 0 THEN event_id * 256 // 512 ELSE -1 END AS frame FROM events")
def packet_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event numbers as packet times of half a frame: whole frames have an index, the others -1."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select("event_id", F.coalesce(cutplan.packet_frame(F.col("event_id") * 256, 1, 15360), F.lit(-1).cast("long")).alias("frame"))


#: A frame lasts so many units of a video's time.
_TICKS, _SCALE = 512, 15360


@query(sql("""SELECT ep, view, CASE WHEN ep % 13 = 1 THEN 'no video' WHEN ep % 13 = 2 THEN 'streams' WHEN ep % 13 = 3 THEN 'codec' WHEN ep % 13 = 4 THEN 'rate' WHEN ep % 13 = 5 THEN 'timestamp' WHEN ep % 13 = 6 THEN 'duplicate'
  WHEN ep % 13 = 7 OR base + n > have THEN 'missing' ELSE 'keyframe' END AS problem FROM (SELECT ep, n, n + 20 AS have, v AS view, CASE v WHEN 'a' THEN 0 ELSE 7 + (ep % 13 = 9)::INT * 14 END AS base FROM (SELECT ep, max(n) AS n FROM base GROUP BY ep), (VALUES ('a'), ('b')) AS w(v))
  WHERE ep % 13 BETWEEN 1 AND 7 OR (ep % 13 = 8 AND base < 10) OR base + n > have"""))
def packet_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos of two views with a packet for each frame and twenty more, decoded out of order, with a planted fault for each check; most have none."""
    rows = frames.from_lineitem(spark, sf_dir).groupBy("ep").agg(F.max("n").alias("n"))
    kind = F.col("ep") % 13
    wanted = rows.select("ep", "n", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("view"))
    base = F.when(F.col("view") == "a", 0).otherwise(7 + F.when(kind == 9, 14).otherwise(0)).cast("long")
    wanted = wanted.withColumn("base", base).withColumn("path", F.concat_ws("/", "view", "ep"))
    # Dealt before packets are made of them: few rows of bytes would be one task, and hundreds of millions of packets.
    packets = 2 * frames.frame_count(spark, sf_dir)
    made = I.dealt(wanted.filter(kind != 1), "path", rows=packets).withColumn("f", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") + 19)))
    made = made.filter(~((kind == 7) & (F.col("f") == F.col("base") + 5)))
    shown = F.when((kind == 6) & (F.col("f") == 31), 30).otherwise(F.col("f")) * _TICKS + F.when((kind == 5) & (F.col("f") == 40), 100).otherwise(0)
    made = made.select(
        "path", F.col("f").alias("sample"), shown.alias("pts"), F.when(kind == 4, _TICKS + 1).otherwise(_TICKS).cast("long").alias("duration"), F.lit(_SCALE).cast("long").alias("timescale"),
        ((F.col("f") % 30 == F.when(kind == 8, 10).otherwise(0))).alias("key"), F.when(kind == 3, "hev1").otherwise("avc1").alias("codec"), F.when(kind == 2, 2).otherwise(1).alias("streams"),
    )
    return videos.packet_failures(made, wanted, packets=packets)


@query(sql("""SELECT ep, f AS position, CASE WHEN ep % 5 = 1 THEN 'truncated' WHEN ep % 5 = 2 THEN 'extra' WHEN ep % 5 = 4 AND f = 6 THEN 'twice' WHEN ep % 5 = 4 THEN 'truncated' ELSE 'bytes' END AS problem
  FROM (SELECT ep, f, n FROM base UNION ALL SELECT ep, max(n), max(n) FROM base GROUP BY ep) WHERE (ep % 5 = 1 AND f BETWEEN n - 3 AND n - 1) OR (ep % 5 = 2 AND f = n) OR (ep % 5 = 3 AND f IN (20, 21)) OR (ep % 5 = 0 AND f = 33 AND f < n) OR (ep % 5 = 4 AND f IN (6, 7))"""))
def stream_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams against copies that lack their end, go on too long, have two samples exchanged, a byte changed, or one written over the next one's place."""
    rows = frames.from_lineitem(spark, sf_dir).select("ep", "n", F.col("f").alias("position"), F.sha2(F.concat_ws(":", "ep", "f", "ts"), 256).alias("digest"))
    kind, at = F.col("ep") % 5, F.col("position")
    more = rows.filter((kind == 2) & (at == F.col("n") - 1)).withColumn("position", F.col("n"))
    made = rows.filter(~((kind == 1) & (at >= F.col("n") - 3))).unionByName(more)
    moved = F.when((kind == 3) & at.isin(20, 21), 41 - at).when((kind == 4) & (at == 7), 6).otherwise(at)
    made = made.withColumn("digest", F.when((kind == 0) & (at == 33), F.reverse("digest")).otherwise(F.col("digest"))).withColumn("position", moved)
    return videos.stream_differences(rows, made, ["ep"]).select("ep", "position", "problem")


# Clip plans


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.frames(spark, sf_dir)
    return cutplan.cut_plan(timeline.timeline(rows), rows.groupBy("ep").agg(F.max("n").alias("n")))


@query(sql("""SELECT c.ep, clip, "start"::BIGINT AS "start", "end"::BIGINT AS "end", ("end" - "start")::BIGINT AS frames, ("end" - "start" - 1)::BIGINT AS trainable_rows, "start" = 0 AND "end" = n AS whole FROM clips c JOIN lengths USING (ep)"""))
def cut_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clips(spark, sf_dir).select("ep", F.col("clip").cast("long").alias("clip"), long("start"), long("end"), long("frames"), long("trainable_rows"), "whole")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with two views: keyframes every 30 frames, and every 48."""
    clips = _clips(spark, sf_dir).withColumn("view", F.explode(F.array(F.lit(30), F.lit(48))))
    marks = store.frames(spark, sf_dir).select("ep", F.explode(F.array(F.lit(30), F.lit(48))).alias("view"), F.col("f").alias("kf")).filter("kf % view = 0")
    return cutplan.gop_split(clips, marks)


_GOP = """k AS (SELECT c.ep, clip, "start", "end", g AS view, "start" = 0 AND "end" = n AS whole, (CASE WHEN ceil("start" / g::DOUBLE) * g < n THEN ceil("start" / g::DOUBLE) * g ELSE "end" END)::BIGINT AS a,
  least("end", floor(least("end", n - 1) / g::DOUBLE) * g)::BIGINT AS z FROM clips c JOIN lengths USING (ep), (VALUES (30), (48)) AS v(g)),
m AS (SELECT *, CASE WHEN a < z THEN a - "start" ELSE "end" - "start" END AS head, CASE WHEN a < z THEN "end" - z ELSE 0 END AS tail FROM k),
o AS (SELECT *, CASE WHEN whole THEN 'original_reference' WHEN a >= z THEN 'full_reencode_fallback' WHEN head = 0 AND tail = 0 THEN 'gop_copy' ELSE 'gop_copy_boundary_encode' END AS method FROM m)"""


@query(sql('SELECT ep, view::BIGINT AS view, clip, a AS middle_start, z AS middle_end, head::BIGINT AS head, tail::BIGINT AS tail, method FROM o').replace("\nSELECT ep, view", f",\n{_GOP}\nSELECT ep, view"))
def gop_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("ep", long("view"), long("clip"), long("middle_start"), long("middle_end"), long("head"), long("tail"), "method")


@query(sql('SELECT method, count(*) AS clips, count(*) FILTER (WHERE NOT whole) AS new_files, sum("end" - "start")::BIGINT AS kept_frames, sum("end" - "start" - 1)::BIGINT AS trainable_rows, sum(CASE WHEN whole THEN 0 ELSE head + tail END)::BIGINT AS encoded_frames FROM o GROUP BY method').replace("\nSELECT method", f",\n{_GOP}\nSELECT method"))
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutplan.plan_summary(_split(spark, sf_dir)).select("method", *[long(c) for c in ("clips", "new_files", "kept_frames", "trainable_rows", "encoded_frames")])
