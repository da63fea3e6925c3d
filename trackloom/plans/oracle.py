"""The rules once more as SQL over ``lineitem``, for comparing; a chain of common table expressions with scalars only.

The stand-in recordings turn about one axis, so angles are differences of yaw here where the library multiplies matrices.
"""

from __future__ import annotations

W = "OVER (PARTITION BY ep ORDER BY f)"
WV = "OVER (PARTITION BY ep, hand, valid ORDER BY pt)"
BACK = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

CHAIN = {
    "base": "SELECT l_suppkey AS ep, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS f, count(*) OVER (PARTITION BY l_suppkey) AS n, CAST(round(l_discount * 100) AS INT) AS dc, CAST(round(l_tax * 100) AS INT) AS tx, CAST(l_quantity AS INT) AS qty FROM lineitem",
    "phased": "SELECT *, (f // 150 + ep) % 4 AS phase FROM base",
    "path": f"""SELECT *, sum(CASE phase WHEN 1 THEN 16 WHEN 3 THEN 9 ELSE 0 END) {W} AS mm,
      sum(CASE WHEN phase IN (1, 3) AND ep % 2 = 1 THEN 140 ELSE 0 END) {W} AS cdeg FROM phased""",
    "turned": "SELECT *, mm / 1000.0::DOUBLE AS cx, cos(radians(cdeg / 100.0::DOUBLE)) AS c, sin(radians(cdeg / 100.0::DOUBLE)) AS s, CASE WHEN phase = 2 THEN 3.0 ELSE 0.1 END::DOUBLE AS off FROM path",
    "pose": """SELECT *, CASE WHEN (qty = 50 AND dc = 0) OR (ep % 5 = 0 AND f BETWEEN 200 AND 239) OR (ep % 7 = 0 AND f < 3) THEN 'nan'::DOUBLE
        ELSE cx - c * off + s * 2 + CASE WHEN dc = 10 AND tx = 8 THEN 0.5 WHEN dc = 8 AND tx = 2 THEN 0.12 ELSE 0 END::DOUBLE END AS lx,
      s * off + c * 2 AS lz, cx + c * off + s * 2 AS rx, -s * off + c * 2 AS rz,
      CASE WHEN dc = 9 AND tx = 7 THEN 60 WHEN dc = 3 AND tx = 6 THEN 35 ELSE 0 END::DOUBLE AS lphi, NOT (qty = 49 AND dc = 1) AS rgood FROM turned""",
    "pts": """SELECT ep, n, 'l' AS hand, f AS pt, lx AS x, lz AS z, lphi AS phi, NOT isnan(lx) AS fin, NOT isnan(lx) AS valid, false AS ext, cx, c, s, mm, cdeg FROM pose
      UNION ALL SELECT ep, n, 'r', f, rx, rz, 0, true, rgood, false, cx, c, s, mm, cdeg FROM pose
      UNION ALL SELECT ep, n, 'l', n, 'nan'::DOUBLE, lz, lphi, false, false, true, cx, c, s, mm, cdeg FROM pose WHERE f = n - 1 AND ep % 3 = 0 AND NOT isnan(lx)""",
    "st": f"""SELECT *, row_number() {WV} - 1 AS v, count(*) OVER (PARTITION BY ep, hand, valid) AS m,
      lead(x) {WV} AS x2, lead(z) {WV} AS z2, lead(phi) {WV} AS phi2, lead(pt) {WV} AS pt2 FROM pts""",
    "jm": """SELECT *, sqrt((x2 - x) * (x2 - x) + (z2 - z) * (z2 - z)) / (pt2 - pt) AS pos, abs(phi2 - phi) / (pt2 - pt) AS rot,
      coalesce(valid AND m >= 4 AND (sqrt((x2 - x) * (x2 - x) + (z2 - z) * (z2 - z)) / (pt2 - pt) > 0.15 OR abs(phi2 - phi) / (pt2 - pt) > 45), false) AS jump FROM st""",
    "ef": f"""SELECT *, last_value(CASE WHEN jump THEN {{'v': v, 'p': pos > 0.15, 'r': rot > 45, 'x': x, 'z': z}} END IGNORE NULLS) OVER (PARTITION BY ep, hand, valid ORDER BY pt {BACK}) AS e,
      first_value(CASE WHEN jump THEN {{'v': v, 'p': pos > 0.15, 'r': rot > 45, 'x': x2, 'z': z2}} END IGNORE NULLS) OVER (PARTITION BY ep, hand, valid ORDER BY pt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS g FROM jm""",
    "bl": """SELECT ep, n, hand, pt, x, z, phi, fin, valid, ext, cx, c, s, mm, cdeg, CASE WHEN valid AND g.v - e.v <= 15 AND sqrt((g.x - e.x) * (g.x - e.x) + (g.z - e.z) * (g.z - e.z)) < 0.15
      THEN CASE WHEN e.p OR g.p THEN 1 ELSE 0 END + CASE WHEN e.r OR g.r THEN 2 ELSE 0 END ELSE 0 END AS block FROM ef""",
    "cm": """SELECT *, valid AND block = 0 AS calm FROM bl""",
    "hs": """SELECT *, count(*) OVER (PARTITION BY ep, hand, calm) AS m, row_number() OVER w - 1 AS v,
      sqrt((lead(x) OVER w - x) * (lead(x) OVER w - x) + (lead(z) OVER w - z) * (lead(z) OVER w - z)) / (lead(pt) OVER w - pt) AS pos,
      abs(lead(phi) OVER w - phi) / (lead(pt) OVER w - pt) AS rot FROM cm WINDOW w AS (PARTITION BY ep, hand, calm ORDER BY pt)""",
    "hm": """SELECT *, median(pos) OVER (PARTITION BY ep, hand, calm) AS mp, median(rot) OVER (PARTITION BY ep, hand, calm) AS mr FROM hs""",
    "hd": """SELECT *, greatest(0.10, mp + 3.0 * 1.4826 * median(abs(pos - mp)) OVER (PARTITION BY ep, hand, calm)) AS tp,
      greatest(30.0, mr + 3.0 * 1.4826 * median(abs(rot - mr)) OVER (PARTITION BY ep, hand, calm)) AS tr FROM hm""",
    "hb": """SELECT *, calm AND m >= 5 AND coalesce(pos > tp, false) AS bp, calm AND m >= 5 AND coalesce(rot > tr, false) AS br FROM hd""",
    "sp": """SELECT *, CASE WHEN NOT calm OR m < 5 THEN 0 ELSE
      CASE WHEN CASE WHEN v = 0 THEN bp AND NOT coalesce(lead(bp) OVER w, false) WHEN v = m - 1 THEN lag(bp) OVER w AND NOT coalesce(lag(bp, 2) OVER w, false) ELSE bp AND lag(bp) OVER w END THEN 4 ELSE 0 END
      + CASE WHEN CASE WHEN v = 0 THEN br AND NOT coalesce(lead(br) OVER w, false) WHEN v = m - 1 THEN lag(br) OVER w AND NOT coalesce(lag(br, 2) OVER w, false) ELSE br AND lag(br) OVER w END THEN 8 ELSE 0 END END AS spike
      FROM hb WINDOW w AS (PARTITION BY ep, hand, calm ORDER BY pt)""",
    "cd": "SELECT *, block | spike | CASE WHEN NOT fin THEN 16 WHEN NOT valid THEN 32 ELSE 0 END AS code FROM sp",
    "lh": f"""SELECT *, last_value(CASE WHEN code = 0 THEN {{'pt': pt, 'x': x, 'z': z, 'phi': phi}} END IGNORE NULLS) OVER (PARTITION BY ep, hand ORDER BY pt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo,
      first_value(CASE WHEN code = 0 THEN {{'pt': pt, 'x': x, 'z': z, 'phi': phi}} END IGNORE NULLS) OVER (PARTITION BY ep, hand ORDER BY pt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi, count(*) OVER (PARTITION BY ep, hand) AS np FROM cd""",
    "gp": "SELECT *, CASE WHEN code <> 0 THEN coalesce(lo.pt + 1, 0) END AS g0, CASE WHEN code <> 0 THEN coalesce(hi.pt, np) END AS g1 FROM lh",
    "rp": """SELECT *, code <> 0 AND lo IS NOT NULL AND hi IS NOT NULL AND coalesce(g1 - g0 <= 30, false) AS repaired, (pt - lo.pt) / (hi.pt - lo.pt)::DOUBLE AS a FROM gp""",
    "fx": """SELECT *, CASE WHEN repaired THEN (1 - a) * lo.x + a * hi.x ELSE x END AS fx, CASE WHEN repaired THEN (1 - a) * lo.z + a * hi.z ELSE z END AS fz,
      CASE WHEN repaired THEN lo.phi + a * (hi.phi - lo.phi) ELSE phi END AS fphi, lead(code) OVER w AS ncode, lead(ok) OVER w AS nok, lead(repaired) OVER w AS nrepaired, lead(ext) OVER w AS next_ext FROM
      (SELECT *, code = 0 OR repaired AS ok FROM rp) WINDOW w AS (PARTITION BY ep, hand ORDER BY pt)""",
    "act": "SELECT ep, n, hand, pt AS f, cx, c, s, mm, cdeg, code, ok, repaired, fx, fz, coalesce(ncode, code) AS acode, coalesce(nok, ok) AS aok, coalesce(nrepaired, repaired) AS arepaired, coalesce(next_ext AND NOT nok, false) AS beyond FROM fx WHERE NOT ext",
    # One row for each hand and frame, so grouping stands for the two joins that would pair them.
    "fr": """SELECT ep, f, any_value(n) AS n, any_value(fx) FILTER (WHERE hand = 'l') AS lx, any_value(fz) FILTER (WHERE hand = 'l') AS lz, any_value(fx) FILTER (WHERE hand = 'r') AS rx, any_value(fz) FILTER (WHERE hand = 'r') AS rz,
      bool_or(NOT ok OR beyond) AS s1, any_value(cx) AS cx, any_value(c) AS c, any_value(s) AS s, any_value(mm) AS mm, any_value(cdeg) AS cdeg FROM act GROUP BY ep, f""",
    "cq": "SELECT *, c * (lx - cx) - s * lz AS lqx, s * (lx - cx) + c * lz AS lqz, c * (rx - cx) - s * rz AS rqx, s * (rx - cx) + c * rz AS rqz FROM fr",
    "uv": "SELECT *, CASE WHEN lqz > 1e-6 AND NOT isnan(lqz) THEN 50 * lqx / lqz + 50 END AS lu, CASE WHEN rqz > 1e-6 AND NOT isnan(rqz) THEN 50 * rqx / rqz + 50 END AS ru FROM cq",
    "rg": """SELECT *, coalesce(NOT isnan(lu) AND lu >= 0 AND lu < 100, false) AS lin, coalesce(NOT isnan(lu) AND lu >= 5 AND lu < 95, false) AS lsafe,
      coalesce(NOT isnan(ru) AND ru >= 0 AND ru < 100, false) AS rin, coalesce(NOT isnan(ru) AND ru >= 5 AND ru < 95, false) AS rsafe FROM uv""",
    "bd": "SELECT *, NOT s1 AND NOT lsafe AND NOT rsafe AS bad FROM rg",
    "br_": "SELECT *, f - row_number() OVER (PARTITION BY ep, bad ORDER BY f) AS run FROM bd",
    "e2": "SELECT *, bad AND count(*) OVER (PARTITION BY ep, bad, run) >= 60 AS s2 FROM br_",
    "kp": "SELECT *, NOT s1 AND NOT s2 AS keep FROM e2",
    "sg": "SELECT *, CASE WHEN keep THEN f - row_number() OVER (PARTITION BY ep, keep ORDER BY f) END AS seg FROM kp",
    "mv": """SELECT *, CASE WHEN keep THEN (lead(mm, 6) OVER w - mm) / 1000.0::DOUBLE END AS d3, CASE WHEN keep THEN abs(lead(cdeg, 6) OVER w - cdeg) / 100.0::DOUBLE END AS a3,
      CASE WHEN keep THEN (lead(mm, 30) OVER w - mm) / 1000.0::DOUBLE END AS d4, CASE WHEN keep THEN abs(lead(cdeg, 30) OVER w - cdeg) / 100.0::DOUBLE END AS a4,
      CASE WHEN s1 THEN 0 ELSE lqz / sqrt(lqx * lqx + lqz * lqz) END AS lcos, CASE WHEN s1 THEN 0 ELSE rqz / sqrt(rqx * rqx + rqz * rqz) END AS rcos
      FROM sg WINDOW w AS (PARTITION BY ep, keep, seg ORDER BY f)""",
    "h3": "SELECT *, coalesce(d3 > {t3}, false) AS t3, coalesce(a3 > {r3}, false) AS r3 FROM mv",
    "m3": """SELECT *, CASE WHEN keep THEN CASE WHEN max(t3::INT) OVER w > 0 THEN 1 ELSE 0 END + CASE WHEN max(r3::INT) OVER w > 0 THEN 2 ELSE 0 END ELSE 0 END * {on3} AS s3
      FROM h3 WINDOW w AS (PARTITION BY ep, keep, seg ORDER BY f ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "w4": """SELECT *, CASE WHEN keep AND count(*) OVER w = 31 THEN quantile_cont(lcos, 0.95) OVER w - quantile_cont(lcos, 0.05) OVER w END AS lsp,
      CASE WHEN keep AND count(*) OVER w = 31 THEN quantile_cont(rcos, 0.95) OVER w - quantile_cont(rcos, 0.05) OVER w END AS rsp
      FROM m3 WINDOW w AS (PARTITION BY ep, keep, seg ORDER BY f ROWS BETWEEN CURRENT ROW AND 30 FOLLOWING)""",
    "h4": "SELECT *, coalesce(lsp <= 0.03 AND rsp <= 0.03, false) AS stable, coalesce(lsp <= 0.03 AND rsp <= 0.03 AND d4 > 0.20, false) AS t4, coalesce(lsp <= 0.03 AND rsp <= 0.03 AND a4 > 20 + 1e-5, false) AS r4 FROM w4",
    "u4": "SELECT *, f - row_number() OVER (PARTITION BY ep, keep, seg, t4 ORDER BY f) AS ut, f - row_number() OVER (PARTITION BY ep, keep, seg, r4 ORDER BY f) AS ur FROM h4",
    "q4": "SELECT *, t4 AND count(*) OVER (PARTITION BY ep, keep, seg, t4, ut) >= 30 AS tq, r4 AND count(*) OVER (PARTITION BY ep, keep, seg, r4, ur) >= 30 AS rq FROM u4",
    "m4": """SELECT *, CASE WHEN keep THEN CASE WHEN max(tq::INT) OVER w > 0 THEN 1 ELSE 0 END + CASE WHEN max(rq::INT) OVER w > 0 THEN 2 ELSE 0 END ELSE 0 END AS s4
      FROM q4 WINDOW w AS (PARTITION BY ep, keep, seg ORDER BY f ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)""",
    "jd": "SELECT *, CASE WHEN s1 THEN 1 WHEN s2 THEN 2 WHEN s4 > 0 THEN 4 WHEN s3 > 0 THEN 3 ELSE 0 END AS code, CASE WHEN s1 THEN 1 WHEN s2 THEN 2 WHEN s4 > 0 THEN 40 + s4 WHEN s3 > 0 THEN 30 + s3 ELSE 0 END AS reason FROM m4",
    "ch": f"SELECT *, CASE WHEN lag(reason) {W} IS DISTINCT FROM reason OR lag(s3) {W} <> s3 OR lag(s4) {W} <> s4 THEN 1 ELSE 0 END AS new FROM jd",
    "pc": f"SELECT *, sum(new) {W} AS piece FROM ch",
    "tl": """SELECT ep, min(f) AS "start", max(f) + 1 AS "end", any_value(code) AS code, any_value(reason) AS reason, any_value(s3) AS s3, any_value(s4) AS s4 FROM pc GROUP BY ep, piece""",
    "ms": "SELECT *, CASE WHEN code IN (1, 2) THEN [code] ELSE list_filter([CASE WHEN s4 > 0 THEN 40 + s4 END, CASE WHEN s3 > 0 THEN 30 + s3 END], lambda x: x IS NOT NULL) END AS matches FROM tl",
    "kc": """SELECT *, CASE WHEN lag("end") OVER (PARTITION BY ep ORDER BY "start") = "start" THEN 0 ELSE 1 END AS fresh FROM tl WHERE code = 0""",
    "kg": """SELECT *, sum(fresh) OVER (PARTITION BY ep ORDER BY "start") AS grp FROM kc""",
    "clips": """SELECT ep, row_number() OVER (PARTITION BY ep ORDER BY min("start")) - 1 AS clip, min("start") AS "start", max("end") AS "end" FROM kg GROUP BY ep, grp""",
    "lengths": "SELECT ep, any_value(n) AS n FROM base GROUP BY ep",
}


def sql(select: str, t3: float = 0.075, r3: float = 7.5, on3: int = 1) -> str:
    """The chain up to what the final select needs; the thresholds of S3 and whether it runs are parameters."""
    ctes = ",\n".join(f"{name} AS ({body.replace('{t3}', str(t3)).replace('{r3}', str(r3)).replace('{on3}', str(on3))})" for name, body in CHAIN.items())
    return f"WITH {ctes}\n{select}"
