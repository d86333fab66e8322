"""One query per operator over the bundled tables, with its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import (
    chain_dedup, chat, decontaminate, exact_dedup, importance, jaccard_join, lexicon_bpe, merkle, packing, projection_dedup, repair, token_counts, toxicity,
)
from kerbline.llm.textscan import small_batches
from kerbline.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents an importance resample towards labelled good text keeps."""
    return importance.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents whose sets of 3-word shingles are at least 0.9 alike."""
    return jaccard_join.jaccard_components(table(spark, folder, "documents"), jaccard_join.Rule(3, 9, 10))


@query()
def op3_projection_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors near others by cosine, their links and components."""
    return projection_dedup.near_vectors(table(spark, folder, "embeddings"))


@query()
def op4_chain_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds too, word for word or nearly."""
    return chain_dedup.repeated_passages(table(spark, folder, "documents"))


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents found again in flat token files of all texts, in file order."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_counts.write_token_files(table(spark, folder, "documents"), path, Path(tokenizer_path("piece_bpe_32k.model")).read_bytes())
    found = token_counts.scan_token_files(spark, path)
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("file_no")
    return found.select(number, "doc_no", "start", "n_tokens", "closed")


@query()
def op6_lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and round trip of every text with the byte-level vocabulary."""
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    encoded = lexicon_bpe.encode(table(spark, folder, "documents"), tokenizer)
    return lexicon_bpe.decode(encoded, tokenizer).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
""")
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents stay when equal texts are reduced to one."""
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document; every fifth id takes no part in the learning."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = table(spark, folder, "labels").where(~held_out)
    scored = toxicity.score_toxicity(table(spark, folder, "documents"), labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


PROBE = "</s>[INST] ok [/INST]"
_ESCAPED = r"replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b')"
_ESCAPED_ROLE = r"replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b')"


@query(rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), s AS (
  SELECT *, {_ESCAPED} AS esc, {_ESCAPED_ROLE} AS esc_role,
         lag(role) OVER w AS before, row_number() OVER w AS n
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), m AS (
  SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 20 + length(esc_role) END AS marks,
         CASE WHEN n = 1 THEN role IN ('system', 'user') WHEN before = 'user' THEN role = 'assistant'
              WHEN before IN ('system', 'assistant') THEN role = 'user' ELSE false END AS ok
  FROM s
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(esc) + marks) AS BIGINT) AS formatted_chars, bool_and(ok) AS valid
FROM m GROUP BY conv_id
""")
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and what is read back from the format and its loss mask."""
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    whole = chat.assemble(chat.format_turns(rows))
    turns = chat.read_turns(F.col("formatted"))
    masked = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), "")
    loss = chat.unescape(masked)
    spelled = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


@query()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


#: CRC-32 of a SQL text of ASCII characters, bit by bit (fixed value: the reflected polynomial).
def _crc32(text: str) -> str:
    steps = "list_reduce([{c}, 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b >> 1, 3988292384 * (b & 1)))"
    octets = f"list_transform(string_split({text}, ''), lambda k: ascii(k)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, o: {steps.format(c='xor(c, o)')}), 4294967295)"


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _tree_sql(name: str, levels: int = 6) -> str:
    """CTEs from ``{name}_0`` (grp, pos, node) up to one node per group in ``{name}_{levels}``,
    enough for 16 ** levels nodes, and ``{name}_p``: the siblings left and right of each place, level by level."""
    ctes, joins, steps = [], "", []
    for k in range(levels):
        ctes.append(f"""{name}_r{k} AS (SELECT grp, pos // 16 AS pos, list(node ORDER BY pos) AS run, sum(count(*)) OVER (PARTITION BY grp) AS n
  FROM {name}_{k} GROUP BY grp, pos // 16)""")
        ctes.append(f"{name}_{k + 1} AS (SELECT grp, pos, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM {name}_r{k})")
        joins += f"\n  JOIN {name}_r{k} r{k} ON r{k}.grp = l.grp AND r{k}.pos = l.pos // {16 ** (k + 1)}"
        slot = f"(l.pos // {16 ** k} % 16)"
        steps.append(f"CASE WHEN r{k}.n > 1 THEN {{'l': array_to_string(r{k}.run[:{slot}], ''), 'r': array_to_string(r{k}.run[{slot} + 2:], '')}} END")
    ctes.append(f"{name}_p AS (SELECT l.grp, l.pos, list_filter([{', '.join(steps)}], lambda s: s IS NOT NULL) AS steps FROM {name}_0 l{joins})")
    return ",\n".join(ctes)


@query(rf"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents
), p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t_0 AS (SELECT grp, pos, leaf AS node FROM p),
{_tree_sql('t')},
g AS (SELECT grp, node, row_number() OVER (ORDER BY grp) - 1 AS pos FROM t_6),
u_0 AS (SELECT '' AS grp, pos, node FROM g),
{_tree_sql('u')},
w AS (
  SELECT p.doc_id, p.leaf, p.tampered, g.node AS subroot, u_6.node AS root, list_concat(t_p.steps, u_p.steps) AS steps
  FROM p JOIN t_p USING (grp, pos) JOIN g ON g.grp = p.grp JOIN u_p ON u_p.pos = g.pos, u_6
), f AS (
  SELECT *, list_reduce(list_prepend({{'l': coalesce(tampered, leaf), 'r': ''}}, steps), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root
  FROM w
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f
""")
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's leaf and proof in the manifest, and which of them still hold after a change of some texts."""
    docs = table(spark, folder, "documents")
    columns = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    changed = {**columns, "text": F.translate("text", decontaminate.UPPER, decontaminate.LOWER)}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.row_digest(changed))
    rows = merkle.manifest(docs, merkle.row_digest(columns), carry={"tampered": tampered})
    folded = rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("witness")).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("witness")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(rf"""
WITH b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
k AS (SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0),
d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
o AS (SELECT DISTINCT d.doc_id, i, k.n, k.item FROM d, (SELECT DISTINCT n FROM k) s, unnest(range(1, len(d.w) - s.n + 2)) AS r(i)
  JOIN k ON k.n = s.n AND k.win = array_to_string(d.w[i:i + s.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM o, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256 FROM o GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)
""")
def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold passages of benchmark items, how many of their words, and of which items."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _moves() -> str:
    """Ways from a state over one turn, as SQL rows: state, lines inserted before, their edits, the turn's edit,
    the turn's initial (null: any), its new role (null: its own), the state after."""
    after = {"start": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    rows = [f"('{q}', '', '', 'D', NULL, NULL, '{q}')" for q in after]
    for q in after:
        state, lines, edits = q, "", ""
        for _ in range(3):
            rows += [f"('{q}', '{lines}', '{edits}', 'K', '{x}', NULL, '{x}')" for x in after[state]]
            rows += [f"('{q}', '{lines}', '{edits}', 'R', NULL, '{names[x]}', '{x}')" for x in after[state] if x in names]
            state = "u" if "u" in after[state] else "a"
            lines, edits = f"{lines}|{names[state]}:", edits + "I"
    return ", ".join(rows)


_PART = "coalesce({}::VARCHAR, ' ')"


@query(rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(" + _PART.format("conv_id") + " || ':' || " + _PART.format("turn") + ")")} % 20 AS h FROM conversations
), dam AS (
  SELECT conv, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS r(c) WHERE h <> 0
), num AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n FROM dam
), cop AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY n) AS copy FROM num),
o AS (
  SELECT *, left(lag(role) OVER (PARTITION BY conv ORDER BY n), 1) || left(role, 1) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN copy > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault FROM cop
), moves(q, lines, ins, op, initial, name, q2) AS (VALUES {_moves()}),
seq AS (
  SELECT DISTINCT conv, 0::BIGINT AS n, 'start' AS q, 0::BIGINT AS cost, '' AS audit, '' AS lines FROM raw
  UNION ALL
  SELECT conv, n, q2, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv, q2 ORDER BY cost, audit) AS best FROM (
      SELECT s.conv, o.n, m.q2,
             s.cost + 2 * length(m.ins) + CASE m.op WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN m.op <> 'D' AND o.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
             s.audit || m.ins || m.op AS audit,
             s.lines || replace(m.lines, '|', chr(10)) || CASE WHEN m.op = 'D' THEN '' ELSE chr(10) || coalesce(m.name, o.role) || ':' || o.text END AS lines
      FROM seq s JOIN o ON o.conv = s.conv AND o.n = s.n + 1 JOIN moves m ON m.q = s.q
      WHERE (m.op = 'D' OR coalesce(o.fault, '') NOT IN ('blank', 'duplicate')) AND (m.initial IS NULL OR m.initial = left(o.role, 1))
    )
  ) WHERE best = 1
), ends(q, ins, lines) AS (VALUES ('start', '', ''), ('a', '', ''), ('u', 'I', '|assistant:'), ('s', 'II', '|user:|assistant:')),
won AS (
  SELECT * FROM (
    SELECT s.conv, s.cost + 2 * length(e.ins) AS cost, s.audit || e.ins AS audit, s.lines || replace(e.lines, '|', chr(10)) AS lines,
           row_number() OVER (PARTITION BY s.conv ORDER BY s.cost + 2 * length(e.ins), s.audit || e.ins) AS best
    FROM seq s JOIN (SELECT conv, max(n) AS n FROM seq GROUP BY conv) USING (conv, n) JOIN ends e ON e.q = s.q
  ) WHERE best = 1
), c AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, won.cost::BIGINT AS cost, audit, sha256(lines[2:]) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM raw) JOIN won USING (conv) LEFT JOIN c USING (conv)
""")
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations: their faults and the cheapest edits that make them legal again."""
    turns = table(spark, folder, "conversations")
    values = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    rows = turns.select("conv_id", "turn", (F.crc32(F.concat_ws(":", values["conv_id"], values["turn"])) % 20).alias("h"), values["role"].alias("role"), values["text"].alias("text"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = rows.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("h") != 0).alias("there"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return repair.summarise(damaged, F.col("there"))
