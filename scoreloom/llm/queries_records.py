"""Personal data (11), Merkle manifest (12) and conversation repair (13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import conversation_repair, merkle, pii
from scoreloom.llm.common import table

_JOINED = "array_join(transform({0}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs))
    counts = [f"bigint(size(filter(base, x -> x.kind = '{k}'))) AS n_{k}" for k in pii.KINDS]
    return found.selectExpr("doc_id", *counts, f"sha2({_JOINED.format('base')}, 256) AS base_sha256", f"{_JOINED.format('spans')} AS spans")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.TAMPERED)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def sql_crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    step = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END"
    byte = f"lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)::UBIGINT[]), {step})"
    return f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)), {byte}))"


def _sql_leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _sql_levels(node: str, path: str, first: int, last: int) -> str:
    """Levels of the trees `node`_k (sid, pos, d), and of the paths `path`_k (rid, sid, pos, f, proof) along them."""
    out = []
    for k in range(first, last):
        n, p, many = f"{node}{k}", f"{path}{k}", f"{node}m{k}"
        run = f"FROM {p} p JOIN {n} n ON n.sid = p.sid AND n.pos // 16 = p.pos // 16"
        side = "coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos {0} p.pos), '')"
        out.append(f"""
  {many} AS MATERIALIZED (SELECT sid FROM {n} GROUP BY sid HAVING count(*) > 1),
  {node}{k + 1} AS MATERIALIZED (SELECT sid, pos // 16 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d FROM {n} WHERE sid IN (FROM {many}) GROUP BY ALL),
  {path}{k + 1} AS MATERIALIZED (SELECT p.rid, p.sid, p.pos // 16 AS pos, sha256({side.format('<')} || p.f || {side.format('>')}) AS f, p.proof || {side.format('<>')} AS proof
    {run} WHERE p.sid IN (FROM {many}) GROUP BY p.rid, p.sid, p.pos, p.f, p.proof
    UNION ALL SELECT rid, sid, pos, f, proof FROM {p} WHERE sid NOT IN (FROM {many}))""")
    return ",".join(out)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_OP12 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, {_sql_leaf('text')} AS leaf,
    {_sql_leaf(f"CASE WHEN {sql_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_LOWER} ELSE text END")} AS altered FROM documents),
  l AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
  n0 AS MATERIALIZED (SELECT sid, pos, leaf AS d FROM l),
  p0 AS MATERIALIZED (SELECT rid, sid, pos, altered AS f, '' AS proof FROM l),{_sql_levels('n', 'p', 0, 6)},
  sub AS MATERIALIZED ({" UNION ALL ".join(f"SELECT sid, d FROM n{k} WHERE sid NOT IN (FROM nm{k})" for k in range(6))} UNION ALL SELECT sid, d FROM n6),
  t0 AS MATERIALIZED (SELECT 0 AS sid, sid AS pos, d FROM sub),
  q0 AS MATERIALIZED (SELECT rid, 0 AS sid, sid AS pos, f, proof FROM p6),{_sql_levels('t', 'q', 0, 5)},
  root AS MATERIALIZED (SELECT d FROM ({" UNION ALL ".join(f"SELECT {k} AS k, d FROM t{k}" for k in range(6))}) ORDER BY k DESC LIMIT 1)
SELECT l.doc_id, l.leaf, sub.d AS subroot, root.d AS root, sha256(q5.proof) AS proof_sha256, q5.f AS folded_root, q5.f = root.d AS verified
FROM l JOIN sub ON sub.sid = l.sid JOIN q5 ON q5.rid = l.rid, root
"""


def _sql_step(state: str, cost: str, initial: str, line: str | None) -> str:
    said = f"list_append({state}.l, {line})" if line else f"{state}.l"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 'l': {said}}} END"


def _sql_least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}], 'ASC', 'NULLS LAST')[1]"


def _sql_inserts(rel: str) -> str:
    """States of a layer with the inserts that may precede its row: s0, s1 and the completed u2, u3."""
    put = {q: f"{r}:" for q, r in ((2, "user"), (3, "assistant"))}
    one = {q: _sql_step(f"s{q}", "5", "I", f"'{put[t]}'") for q, t in ((0, 2), (1, 2), (2, 3), (3, 2))}
    w2 = _sql_least("s2", one[0], one[1], one[3])
    return f"SELECT *, {_sql_least('s3', _sql_step('u2', '5', 'I', repr(put[3])))} AS u3 FROM (SELECT *, {w2} AS u2 FROM {rel})"


def _sql_repair() -> str:
    """One row of every conversation at a time: the cheapest, then least, (cost, audit, lines) of each state."""

    def drop(s):
        return _sql_step(s, "2", "D", None)

    def keep(s, initial):
        return f"CASE WHEN NOT gone AND r1 = '{initial}' THEN {_sql_step(s, 'extra', 'K', "role || ':' || text")} END"

    def recast(s, role):
        return f"CASE WHEN NOT gone THEN {_sql_step(s, '1 + extra', 'R', f"'{role}:' || text")} END"

    new = {
        "s0": drop("s0"), "s1": _sql_least(drop("s1"), keep("s0", "s")),
        "s2": _sql_least(drop("u2"), *[f(s, x) for s in ("s0", "s1", "u3") for f, x in ((keep, "u"), (recast, "user"))]),
        "s3": _sql_least(drop("u3"), keep("u2", "a"), recast("u2", "assistant")),
    }
    return ", ".join(f"{sql} AS {name}" for name, sql in new.items())


_BLANKS = r"[\x20\x09-\x0D]"
ORACLE_OP13 = rf"""
WITH RECURSIVE h AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {sql_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations),
  hurt AS MATERIALIZED (SELECT g, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
  o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) - 1 AS i FROM hurt),
  f AS MATERIALIZED (SELECT *, role[1] AS r1, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?]{_BLANKS}*\z') THEN 'truncated' ELSE '' END AS fault, lead(role[1]) OVER (PARTITION BY g ORDER BY i) AS next1 FROM o),
  e AS MATERIALIZED (SELECT g, i, r1, role, text, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM f),
  n AS MATERIALIZED (SELECT g, count(*) AS n FROM e GROUP BY g),
  nothing AS (SELECT {{'c': 0, 'a': '', 'l': CAST([] AS VARCHAR[])}} AS s),
  dp AS (SELECT g, CAST(0 AS BIGINT) AS i, s AS s0, if(false, s, NULL) AS s1, if(false, s, NULL) AS s2, if(false, s, NULL) AS s3 FROM n, nothing
    UNION ALL SELECT g, i + 1, s0, s1, s2, s3 FROM (SELECT g, i, {_sql_repair()} FROM (SELECT x.*, e.r1, e.role, e.text, e.gone, e.extra FROM ({_sql_inserts('dp')}) x JOIN e ON e.g = x.g AND e.i = x.i))),
  best AS MATERIALIZED (SELECT g, {_sql_least('s0', 'u3')} AS b FROM ({_sql_inserts('(SELECT dp.* FROM dp JOIN n ON dp.g = n.g AND dp.i = n.n)')})),
  facts AS MATERIALIZED (SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (next1 IS NOT NULL AND r1 || next1 NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(array_to_string(b.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM h) LEFT JOIN facts USING (g) LEFT JOIN best USING (g)
"""


QUERIES = {"op11_pii": op11_pii, "op12_merkle_manifest": op12_merkle_manifest, "op13_conversation_repair": op13_conversation_repair}
ORACLES = {"op12_merkle_manifest": ORACLE_OP12, "op13_conversation_repair": ORACLE_OP13}
