"""One thin query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import caps, mixing, pieces, pii, prefixes, quality, repair, secrets, simhash, topk, toxicity, urls, warc
from .common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op3_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "lower(lpad(hex(fps[0]), 16, '0')) as fingerprint", "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")), F.col("dropped"))


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1_secrets finds by the base patterns alone, which SQL can say."""
    return op1_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def base_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2_pii finds by the base patterns alone, which SQL can say."""
    return op2_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of op6_mixing, which SQL can say."""
    return op6_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_pii": op2_pii,
    "op3_caps": op3_caps,
    "op4_topk": op4_topk,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_mixing": op6_mixing,
    "op7_urls": op7_urls,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_warc": op12_warc,
    "op13_repair": op13_repair,
    "base_secrets": base_secrets,
    "base_pii": base_pii,
    "mix_targets": mix_targets,
}


def _list(terms: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


def _fits(then: int) -> str:
    """The rules as CASE branches, the longest first; `then`: 0 for the verdict, 1 for the rule."""
    return " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{r[then]}'"
        for r in sorted(urls.RULES, key=lambda r: -len(r[1]))
        for h, p in [r[1].split("/", 1)]
    )


def _patterns(kinds: tuple[tuple[str, str, str], ...], by: tuple[str, str]) -> str:
    """Counts and digest of the spans of (kind, pattern, condition on the match `x.m`), ordered by the struct fields `by`.

    A match starts after all pieces of the text and all matches before it.
    """
    q = lambda p: "'" + p.replace("'", "''") + "'"
    cut = ", ".join(
        f"regexp_extract_all(t, {q(p)}) AS {k}_m, list_transform(string_split_regex(t, {q(p)}), lambda x: length(x)) AS {k}_p" for k, p, _ in kinds
    )
    at = "list_sum({k}_p[1:i]) + coalesce(list_sum(list_transform({k}_m[1:i - 1], lambda y: length(y))), 0)"
    spans = ", ".join(
        f"list_filter(list_transform(range(1, len({k}_m) + 1), lambda i: {{'k': '{k}', 'o': {o}, 's': CAST({at.format(k=k)} AS BIGINT), 'm': {k}_m[i]}}), lambda x: {valid}) AS {k}_s"
        for o, (k, _, valid) in enumerate(kinds)
    )
    every = "flatten([" + ", ".join(f"{k}_s" for k, _, _ in kinds) + "])"
    ordered = f"list_sort(list_transform({every}, lambda x: {{'a': x.{by[0]}, 'b': x.{by[1]}, 'v': x.k || ':' || x.s || ':' || (x.s + length(x.m))}}))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS (SELECT doc_id, {cut} FROM d), s AS (SELECT doc_id, {spans} FROM m)
SELECT doc_id, {", ".join(f"len({k}_s) AS n_{k}" for k, _, _ in kinds)}, sha256(coalesce(array_to_string(list_transform({ordered}, lambda x: x.v), ','), '')) AS base_sha256 FROM s"""


# The contracts' patterns.
_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_DIGITS = "regexp_replace(x.m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST({_DIGITS}[-i] AS INTEGER)
  WHEN CAST({_DIGITS}[-i] AS INTEGER) > 4 THEN 2 * CAST({_DIGITS}[-i] AS INTEGER) - 9 ELSE 2 * CAST({_DIGITS}[-i] AS INTEGER) END)) % 10 = 0"""
SECRETS = (
    ("assign", _ASSIGN, "length(regexp_extract(x.m, '" + _ASSIGN.replace("'", "''") + "', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(x.m) >= 20"),
    ("hex", "[0-9a-f]{24,}", "true"),  # a run is matched whole, so that its length can stand in the pattern
)
PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(x.m, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT) <= 255, false))) = 4"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
)

def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {bits}), 4294967295)"


TRIE = f"""
WITH o AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM o),
w AS (SELECT h.conv_id, list_concat(coalesce(b.s, [])[1:h], h.s[h + 1:]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM w),
n AS (SELECT s[1:d] AS p, d, min(conv_id) AS c, count(*) AS n, sha256(coalesce(string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS e FROM m GROUP BY 1, 2),
k AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM n WHERE d > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(k.k, 0) AS k, CASE WHEN d > 0 THEN (n - 1) * length(n.p[d].t) ELSE 0 END AS own FROM n LEFT JOIN k ON n.p = k.p),
z AS (SELECT p, k, own, unnest(range(d + 1)) AS j FROM x),
y AS (SELECT p[1:j] AS p, count(*) FILTER (k = 0) AS leaves, sum(own) AS saved FROM z GROUP BY 1)
SELECT x.c AS conv_id, x.d AS depth, q.c AS parent_conv_id, x.n AS n_convs, x.k AS n_children, y.leaves AS n_leaves, CAST(y.saved AS BIGINT) AS saved_tokens, x.e AS ends_sha256
FROM x JOIN y ON x.p = y.p LEFT JOIN x q ON x.d > 0 AND q.d = x.d - 1 AND q.p = x.p[1:x.d - 1]"""

WARC = """
WITH d AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS n, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS f, row_number() OVER (PARTITION BY t ORDER BY page_id) AS k FROM d)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN f END AS refers_to FROM s"""


def _repair() -> str:
    """The same states as the operator's, but with whole lists of edits and rows, in a recursive query of one step a row."""

    def edit(of: str, cost: str, letter: str, row: str | None, when: str = "true") -> str:
        kept = f"list_append({of}.t, {row})" if row else f"{of}.t"
        return f"CASE WHEN {of} IS NOT NULL AND {when} THEN {{'c': CAST({of}.c + {cost} AS BIGINT), 'a': {of}.a || '{letter}', 't': {kept}}} END"

    best = lambda *x: "list_sort(list_filter([" + ", ".join(x) + "], lambda x: x IS NOT NULL))[1]"
    insert = lambda of, role: edit(of, "2", "I", f"'{role}:'")
    delete = lambda of: edit(of, "3", "D", None)
    keep = lambda of, initial: edit(of, "cut", "K", "role || ':' || t", f"NOT gone AND left(role, 1) = '{initial}'")
    turn = lambda of, role: edit(of, "2 + cut", "R", f"'{role}:' || t", "NOT gone")
    filled = "regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')"
    state = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"
    before_user = ("s0", "s1", "s3")
    inserted = f"(SELECT *, {best('s3', insert('s2', 'assistant'))} AS a3 FROM (SELECT * REPLACE ({best('s2', *(insert(s, 'user') for s in before_user))} AS s2) FROM r))"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS t, {_crc32(key)} % 20 AS how FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t, unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS twice FROM d),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t, twice) AS i, row_number() OVER (PARTITION BY conv_id, role, t ORDER BY turn NULLS FIRST, twice) AS k, {filled} AS body FROM e),
g AS (SELECT *, body = '' OR k > 1 AS gone, body <> '' AND k = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS ends_open, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM f),
n AS MATERIALIZED (SELECT conv_id, i, role, t, gone, CAST(ends_open AS BIGINT) AS cut FROM g),
c AS (SELECT d.conv_id, coalesce(max(x.most), 0) AS most FROM d LEFT JOIN (SELECT conv_id, max(i) AS most FROM n GROUP BY 1) x ON x.conv_id IS NOT DISTINCT FROM d.conv_id GROUP BY 1),
r AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, most, CAST({{'c': 0, 'a': '', 't': []}} AS {state}) AS s0, CAST(NULL AS {state}) AS s1, CAST(NULL AS {state}) AS s2, CAST(NULL AS {state}) AS s3 FROM c
  UNION ALL
  SELECT q.conv_id, q.i + 1, q.most, {delete('s0')}, {best(delete('s1'), keep('s0', 's'))},
    {best(delete('s2'), *(f(s, x) for s in ('s0', 's1', 'a3') for f, x in ((keep, 'u'), (turn, 'user'))))}, {best(delete('a3'), keep('s2', 'a'), turn('s2', 'assistant'))}
  FROM {inserted} q JOIN n ON n.conv_id IS NOT DISTINCT FROM q.conv_id AND n.i = q.i + 1),
z AS (SELECT conv_id, {best('s0', 'a3')} AS b FROM {inserted} q WHERE i = most),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (body = '') AS blank, count(*) FILTER (body <> '' AND k > 1) AS duplicate, count(*) FILTER (ends_open) AS truncated,
  count(*) FILTER (was || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY 1)
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit,
  sha256(array_to_string(b.t, chr(10))) AS repaired_sha256 FROM z LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM z.conv_id"""


ORACLE: dict[str, str] = {
    "op11_prefix_trie": TRIE,
    "op12_warc": WARC,
    "op13_repair": _repair(),
    "base_secrets": _patterns(SECRETS, ("s", "o")),
    "base_pii": _patterns(PERSONAL, ("o", "s")),
    "mix_targets": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
-- sources in the order in which they reach three times their size as the common level rises; the rest share what is left
o AS (SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS j FROM s),
l AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / CAST(sum(w) OVER (ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM o),
c AS (SELECT arg_min(level, j) FILTER (level * w <= 3 * source_size) AS level FROM l)
SELECT doc_id, size, source_size, round(least(c.level * w, 3 * source_size), 6) AS target FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source, c""",
    "op3_caps": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
r(a, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT p.a, r.c FROM r JOIN p ON p.b = r.a),
least AS (SELECT a, min(c) AS c FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least.c AS component_id, vec_id = least.c AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op4_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, e, row_number() OVER (PARTITION BY vec_id ORDER BY e) AS query_place FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 20 = 0)),
s AS (SELECT q.vec_id AS query_id, query_place, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM q JOIN v c ON q.vec_id <> c.vec_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, query_place ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score, query_place FROM k WHERE rank <= 20""",
    "op7_urls": f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  string_split_regex(lower(coalesce(TRY(url_decode(url)), url)), '[^\\p{{L}}\\p{{N}}]+') AS words FROM s),
c AS (SELECT *, len(list_filter(words, lambda w: list_contains({_list(urls.STRICT)}, w))) AS n_strict, len(list_distinct(list_filter(words, lambda w: list_contains({_list(urls.SOFT)}, w)))) AS n_soft FROM h)
SELECT page_id, host, path, CASE {_fits(1)} END AS rule,
  CASE {_fits(0)} WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft FROM c""",
}
