"""Queries over tokens and turns: token counts under edits (1) and chat formatting (10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import chat_format, packing, token_counts
from scoreloom.llm.common import held_out, table

#: A character that makes a line more than blank, as the parser takes it.
SAID = r"[^\\s\\x1C-\\x1F\\x85\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
TURNS = 256  # turns of a conversation that make a transcript
ROWS = 4096  # rows of a transcript where many share a turn number


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after masking mail addresses and numbers."""
    ranks = packing.vocabulary()[1]
    trees = token_counts.build_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks)
    out = token_counts.recount(trees, ranks, token_counts.redactions)
    return out.selectExpr("doc_id", "n_tokens", "n_edits", "n_tokens_after", "bigint(coalesce(length(text), 0)) AS n_chars_after", "n_encoded")


#: Speaker markers as transcripts have them: user, assistant, system. A transcript keeps to one style.
STYLES = [
    ("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "System: "), ("Q: ", "A: ", "Context: "), ("**User:** ", "**Assistant:** ", "**System:** "),
    ("### Instruction: ", "### Response: ", "### System: "), ("<|user|> ", "<|assistant|> ", "<|system|> "), ("[USER] ", "[BOT] ", "[SYSTEM] "), ("Anna: ", "Bot: ", "Context: "),
]


def transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, text, roles: raw transcripts of conversations, each turn's first line with a speaker marker.

    One turn in ten lacks its marker, by a hash of its place and text. All lines of a turn are there, blank ones too; `roles`
    has an entry for each that is not blank. Rows that repeat all of conv_id, turn, role and text count once; NULL and blank
    texts and rows with an unknown role are left out. A transcript holds `TURNS` turns at most, and about `ROWS` rows where
    a turn number repeats, so long conversations are several parts.
    """
    rows = turns.selectExpr("conv_id", "turn", "role", "text").where(f"text RLIKE '{SAID}' AND role IN ('user', 'assistant', 'system')").distinct()
    rows = rows.selectExpr("*", f"coalesce(turn, 0) DIV {TURNS} AS _block")
    # only conversations with very many rows are dealt out; they are few, so no conversation is gathered to be counted
    large = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("_block").alias("_of")).agg(F.count("*").alias("_n")).where(f"_n >= {ROWS}")
    rows = rows.join(large, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_block") == F.col("_of")), "left")
    rows = rows.selectExpr("conv_id", "turn", "role", "text", f"concat(_block, '.', pmod(xxhash64(turn, text), 1 + coalesce(_n, 0) DIV {ROWS})) AS part")
    style = "array(" + ", ".join(f"struct('{u}' AS user, '{a}' AS assistant, '{s}' AS system)" for u, a, s in STYLES) + ")"
    lines = "split(text, '\\n', -1)"
    first = f"array_position(transform(_l, x -> x RLIKE '{SAID}'), true) - 1"
    mark = "CASE WHEN pmod(xxhash64(conv_id, turn, text), 10) = 0 THEN '' WHEN role = 'user' THEN _s.user WHEN role = 'assistant' THEN _s.assistant ELSE _s.system END"
    rows = rows.selectExpr("*", f"element_at({style}, int(1 + pmod(xxhash64(conv_id), {len(STYLES)}))) AS _s", f"{lines} AS _l")
    rows = rows.selectExpr("conv_id", "part", "turn", "role", "_l", f"{first} AS _f", f"{mark} AS _m")
    rows = rows.selectExpr(
        "conv_id", "part", "turn", "array_join(transform(_l, (x, i) -> IF(i = _f, concat(_m, x), x)), '\\n') AS said",
        f"filter(transform(_l, (x, i) -> IF(x RLIKE '{SAID}', IF(i = _f, concat('+', role), role), NULL)), x -> x IS NOT NULL) AS roles",
    )
    packed = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "said", "roles"))).alias("t"))
    return packed.selectExpr("conv_id", "part", "bigint(size(t)) AS n_turns", "array_join(transform(t, x -> x.said), '\\n') AS text", "flatten(transform(t, x -> x.roles)) AS roles")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles recovered from raw transcripts of all conversations, against those the table has."""
    raw = transcripts(table(spark, sf_dir, "conversations"))
    model = chat_format.fit(raw.where(~held_out(F.col("conv_id"))))
    parsed = chat_format.parse(raw, model)
    right = "bigint(aggregate(zip_with(roles, line_roles, (x, y) -> IF(ltrim('+', x) = ltrim('+', y), 1, 0)), 0, (a, b) -> a + b)) AS n_right"
    return parsed.select("conv_id", "part", held_out(F.col("conv_id")).alias("held_out"), "n_turns", "roles", "line_roles", "messages", "rendered").selectExpr(
        "conv_id", "part", "held_out", "n_turns", "bigint(size(roles)) AS n_lines", right, "bigint(size(messages)) AS n_messages", "sha2(rendered, 256) AS rendered_sha256"
    )


QUERIES = {"op1_token_counts": op1_token_counts, "op10_chat_format": op10_chat_format}
ORACLES: dict[str, str] = {}
