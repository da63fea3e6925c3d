"""Secret scans with multipart credential linking.

Base spans are leftmost non-overlapping matches for each kind. Beyond them, parts that are weak alone are gathered:
``weak`` (a run of 32 or more key characters with a letter and a digit, outside base spans and endpoints), ``endpoint``
(a URL or an IPv4 address) and the access identifiers and assigned secrets of the base. A weak part is reported only when
the parts that complete it stand within its scope: a key with an access identifier (span kind ``linked_key``), an endpoint
with an access identifier, secret or key (``linked_endpoint``, reported for the endpoint; a secret inside a URL completes it).

Two parts are in scope when at most SCOPE code points lie between the end of one and the start of the other. The interval
join is a sweep over each document's parts in order of their starts: the greatest end so far of what completes a part and
the least start after it decide, so a row comes out for each part, never for each pair of parts.

Each text is matched once by each pattern; gaps and lengths of the matches come out as rows, and their running sums are the
positions. A document's parts meet in one task, which holds no more than the document itself.

Defined results: null text counts as empty; a document without findings has counts 0, ``spans`` empty and the SHA-256 of
the empty string; an empty table gives no rows; other columns are ignored; rows that repeat a doc_id, or have none, are each
scanned. Only DataFrame expressions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, whole_text, written

SCOPE = 200
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
WEAK = r"[A-Za-z0-9+/_=-]{32,}"
ENDPOINT = r"https?://[A-Za-z0-9._~:/?#@%&=+-]+|[0-9][0-9.]*[0-9]"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|http.*)$"
#: Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "linked_key", "linked_endpoint")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: For each kind of part: its pattern, a condition that texts with such a part meet, and one that a passing MATCH meets.
PARTS = {
    "assign": (ASSIGN, None, f"length(regexp_extract(MATCH, {_quoted(ASSIGN)}, 2)) >= 6"),
    "access": (ACCESS, None, "length(MATCH) >= 20"),
    "hex": (HEX, None, "true"),
    "weak": (WEAK, None, "MATCH RLIKE '[A-Za-z]' AND MATCH RLIKE '[0-9]'"),
    "endpoint": (ENDPOINT, r"://|[0-9]\.[0-9]{1,3}\.[0-9]", f"MATCH RLIKE {_quoted(ADDRESS)}"),
}


def matches(kind: str) -> str:
    """array<struct<kind, i, gap, len, ok>> of all matches in ``text``: code points since the match before, and the match's own.

    Matches are set between zero characters, of which the text has none left, and the text is cut there: odd pieces are matches.
    """
    pattern, hint, passes = PARTS[kind]
    cut = f"split(regexp_replace(text, {_quoted(pattern)}, '\\u0000$0\\u0000'), '\\u0000')"
    passes = passes.replace("MATCH", "p[2 * k + 1]")
    each = f"struct('{kind}' AS kind, k AS i, length(p[2 * k]) AS gap, length(p[2 * k + 1]) AS len, {passes} AS ok)"
    some = f"element_at(transform(array({cut}), p -> transform(sequence(0, size(p) div 2 - 1), k -> {each})), 1)"
    hint = f"text RLIKE {_quoted(hint)} AND " if hint else ""
    return f"CASE WHEN {hint}text RLIKE {_quoted(pattern)} THEN {some} ELSE array() END"


def parts(docs: DataFrame) -> DataFrame:
    """row, doc_id, found: all matches of each document, failing ones too; no text."""
    rows = whole_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.expr("translate(text, '\\u0000', '\\u0001')").alias("text"))
    return rows.select("row", "doc_id", F.expr(f"concat({', '.join(matches(k) for k in PARTS)})").alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """row, kind, s, e of each passing part: code points, end exclusive."""
    each = found.select("row", F.expr("inline(found)"))
    ordered = Window.partitionBy("row", "kind").orderBy("i")
    placed = each.withColumn("e", F.sum(F.col("gap") + F.col("len")).over(ordered))
    return placed.filter("ok").select("row", "kind", (F.col("e") - F.col("len")).alias("s"), "e")


def linked(placed: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, kind, s, e: base spans, and the weak parts that are complete within their scope.

    Of the parts that start no later, only the greatest end matters; of those that start no earlier, only the least start.
    """
    # Both are running values: towards the end of the text, and back from it.
    before, after = (Window.partitionBy("row").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow) for order in ("s", F.desc("s")))

    def near(these: str, within: int):
        some = F.expr(these)
        return (F.col("s") - F.max(F.when(some, F.col("e"))).over(before) <= within) | (F.min(F.when(some, F.col("s"))).over(after) - F.col("e") <= within)

    alone = placed.withColumn("inside", F.coalesce(near("kind <> 'weak'", -1), F.lit(False)))  # overlapping a base span or an endpoint
    alone = alone.filter("NOT (kind = 'weak' AND inside)")
    whole = alone.withColumn("key", near("kind = 'access'", scope)).withColumn("reach", near("kind <> 'endpoint'", scope))
    kind = F.expr("CASE WHEN kind IN ('assign', 'access', 'hex') THEN kind WHEN kind = 'weak' AND key THEN 'linked_key' WHEN kind = 'endpoint' AND reach THEN 'linked_endpoint' END")
    return whole.select("row", kind.alias("kind"), "s", "e").dropna(subset=["kind"])


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans."""
    found = written(parts(docs), "secret-parts")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    # Bounded by one document's parts.
    listed = linked(spans(found), scope).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", order.alias("o"), "e", "kind"))).alias("every"))
    rows = found.select("row", "doc_id").join(listed, "row", "left").withColumn("every", F.coalesce("every", F.expr("cast(array() AS array<struct<s: bigint, o: bigint, e: bigint, kind: string>>)")))
    joined = "array_join(transform({0}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"
    count = "cast(size(filter(every, x -> x.o {0})) AS long)"
    counts = [F.expr(count.format(f"= {i + 1}")).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    base = F.sha2(F.expr(joined.format("filter(every, x -> x.o <= 3)")), 256)
    return rows.select("doc_id", *counts, F.expr(count.format("> 3")).alias("n_linked"), base.alias("base_sha256"), F.expr(joined.format("every")).alias("spans"))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def matched(kind: str, pattern: str, passes: str) -> str:
        p = "'" + pattern.replace("'", "''") + "'"
        pairs = f"SELECT r, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(g[1:len(m)]) AS g FROM (SELECT r, regexp_extract_all(text, {p}) AS m, string_split_regex(text, {p}) AS g FROM t)"
        ends = f"SELECT r, m, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM ({pairs})"
        return f"SELECT r, '{kind}' AS kind, e - length(m) AS s, e FROM ({ends}) WHERE {passes}"

    p = "'" + ASSIGN.replace("'", "''") + "'"
    each = [
        matched("assign", ASSIGN, f"length(regexp_extract(m, {p}, 2)) >= 6"), matched("access", ACCESS, "length(m) >= 20"), matched("hex", HEX, "true"),
        matched("weak", WEAK, "regexp_matches(m, '[A-Za-z]') AND regexp_matches(m, '[0-9]')"), matched("endpoint", ENDPOINT, f"regexp_matches(m, '{ADDRESS}')"),
    ]
    near = "EXISTS (SELECT 1 FROM {0} y WHERE y.r = x.r AND {1} AND greatest(x.s - y.e, y.s - x.e) <= {2})"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
a AS ({' UNION ALL '.join(each)}),
b AS (SELECT * FROM a x WHERE kind <> 'weak' OR NOT {near.format('a', "y.kind <> 'weak'", -1)}),
c AS (SELECT r, s, e, CASE WHEN kind IN ('assign', 'access', 'hex') THEN kind WHEN kind = 'weak' AND {near.format('b', "y.kind = 'access'", SCOPE)} THEN 'linked_key'
  WHEN kind = 'endpoint' AND {near.format('b', "y.kind <> 'endpoint'", SCOPE)} THEN 'linked_endpoint' END AS kind FROM b x),
d AS (SELECT r, kind, s, e, list_position({list(KINDS)}, kind) AS o, kind || ':' || s || ':' || e AS said FROM c WHERE kind IS NOT NULL),
f AS (SELECT r, count(*) FILTER (WHERE o = 1) AS n1, count(*) FILTER (WHERE o = 2) AS n2, count(*) FILTER (WHERE o = 3) AS n3, count(*) FILTER (WHERE o > 3) AS n4,
  string_agg(said, ',' ORDER BY s, o, e) FILTER (WHERE o <= 3) AS base, string_agg(said, ',' ORDER BY s, o, e) AS every FROM d GROUP BY r)
SELECT doc_id, coalesce(n1, 0) AS n_assign, coalesce(n2, 0) AS n_access, coalesce(n3, 0) AS n_hex, coalesce(n4, 0) AS n_linked, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM t LEFT JOIN f USING (r)
"""


OP4_SQL = _sql()
