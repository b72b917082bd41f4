"""One query per operator over the given tables, with the SQL of the same rows if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    attention_lm,
    best_fit_packing,
    conversation_repair,
    importance_resampling,
    license_scan,
    ngram_join,
    piece_lattice,
    robust_outliers,
    site_templates,
    suffix_decontamination,
    token_archive,
    toxicity_grammar,
    warc_segments,
)
from feedlake.llm.frames import remainder, table, written
from feedlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of each document and whether the rules keep it."""
    docs = table(spark, sf_dir, "documents")
    judged = robust_outliers.judged(docs, keep=["doc_id"], reuse=True)
    return judged.select("doc_id", "verdict.*")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity_grammar.Model:
    """Learned from the labels of four fifths of the documents."""
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    return toxicity_grammar.fit(table(spark, sf_dir, "documents"), labels)


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = toxicity_grammar.scored(docs, toxicity_model(spark, sf_dir))
    return rated.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_token_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of the ids of each document, read back from the archive."""
    path = token_archive.write_archive(
        table(spark, sf_dir, "documents"),
        scratch_path(spark, "archive"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    back = token_archive.read_archive(spark, path)
    return back.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op4_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether decoding them gives its text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = piece_lattice.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    both = piece_lattice.encoded_and_checked(docs, pieces)
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of each document, learned from six sevenths of them."""
    rated = attention_lm.scores(
        table(spark, sf_dir, "documents"),
        remainder("doc_id", 7) != 2,
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    return rated.withColumn("held_out", remainder("doc_id", 7) == 2)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in each document."""
    return license_scan.found_notices(table(spark, sf_dir, "documents"), license_scan.notices(spark))


def op7_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    texts = site_templates.main_texts(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_templates")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard of 0.9 or more."""
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), shingle_words=3, percent=90)


def op9_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record type and payload of each page, read back from the WARC files written of all."""
    path = warc_segments.write_archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    rows = written(warc_segments.read_archive(spark, path).drop("payload"), "warc-rows")
    return warc_segments.with_referred(rows).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in 10-word windows of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = suffix_decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "verdict.n_words",
        suffix_decontamination.n_hit_words("verdict.hits").alias("n_hit"),
        F.size("verdict.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("verdict.items", ","), 256).alias("items_sha256"),
        (F.size("verdict.hits") > 0).alias("contaminated"),
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of each document's pieces, packed into as few sequences of 4096 as best fit needs."""
    pieces = best_fit_packing.encoded_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return best_fit_packing.placed(pieces.drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each document towards the benchmark's words, and its rank if it is drawn."""
    return importance_resampling.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of each conversation, after planted damage."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repaired(rows, copies="copies")


# SHA-1 in base32: 32 digits of 5 bits each, taken from the 40 hex digits.
OP9_SQL = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex
  FROM pages
),
digits AS (
  SELECT hex, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST(((('0x' || substr(hex || '00', 1 + (5 * i) // 4, 3))::INTEGER
        >> (7 - (5 * i) % 4)) & 31) AS INTEGER), 1), '' ORDER BY i) AS digest
  FROM (SELECT DISTINCT hex FROM payloads) CROSS JOIN range(32) AS r(i)
  GROUP BY hex
)
SELECT p.page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes,
  d.digest AS payload_digest,
  CASE WHEN p.page_id = max(p.page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id < max(p.page_id) OVER w THEN max(p.page_id) OVER w END AS refers_to
FROM payloads p JOIN digits d ON p.hex = d.hex
WINDOW w AS (PARTITION BY p.hex)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
_ALPHANUMERIC = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8_SQL = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_SPACED} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM texts)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y
),
links AS (
  SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c.n >= 90 * (p.n + q.n - c.n)
),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM texts
  UNION
  SELECT r.x, l.y FROM reached r
  JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON r.y = l.x
)
SELECT t.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.y) AS component_id
FROM texts t LEFT JOIN sizes s ON t.doc_id = s.doc_id JOIN reached r ON r.x = t.doc_id
GROUP BY t.doc_id
"""

OP10_SQL = f"""
WITH texts AS (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS k
  FROM (SELECT item_id, {_ALPHANUMERIC} AS w FROM benchmark) WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM items)
),
places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM texts, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
),
found AS (SELECT doc_id, i, k, item FROM places JOIN windows USING (k, words)),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit,
  coalesce(m.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  h.n IS NOT NULL AS contaminated
FROM texts t LEFT JOIN hits h ON t.doc_id = h.doc_id LEFT JOIN named m ON t.doc_id = m.doc_id
"""

# CRC-32 of a text's UTF-8 bytes: 256 steps by the rule of its polynomial, one per byte.
_CRC_STEPS = """
steps AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
)
"""


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of ``text``; the list ``t`` is that of the steps."""
    code = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({code}, 2 * k - 1, 2) AS BIGINT)"
    numbers = f"list_transform(range(1, 1 + length({code}) // 2), lambda k: {byte})"
    step = "xor(t[1 + (xor(c, b) & 255)], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295, {numbers}), lambda c, b: {step}), 4294967295)"


OP12_SQL = f"""
WITH {_CRC_STEPS.strip()},
texts AS (SELECT doc_id, {_ALPHANUMERIC} AS w FROM documents),
features AS (SELECT doc_id, unnest(w) AS word FROM texts),
wanted AS (SELECT unnest({_ALPHANUMERIC}) AS word FROM benchmark),
cells AS MATERIALIZED (
  SELECT word, {_crc32("word")} % 10000 AS cell
  FROM (SELECT word FROM features UNION SELECT word FROM wanted), steps
),
source AS (SELECT cell, count(*) AS s FROM features JOIN cells USING (word) GROUP BY cell),
target AS (SELECT cell, count(*) AS t FROM wanted JOIN cells USING (word) GROUP BY cell),
gains AS (
  SELECT b.cell, CAST(floor(1000 * ln(
    (coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM source) + 10000)::DOUBLE /
    ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM target) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT unnest(range(10000)) AS cell) b
  LEFT JOIN source USING (cell) LEFT JOIN target USING (cell)
),
weights AS (
  SELECT doc_id, sum(gain) AS weight FROM features JOIN cells USING (word) JOIN gains USING (cell) GROUP BY doc_id
),
scores AS (
  SELECT x.doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || x.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM texts x LEFT JOIN weights USING (doc_id)
),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place
  FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM ranks) THEN place END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)
"""

# One row after the other, the least cost and audit of each role that can come last; up to
# two rows are inserted before a row or at the end, more can never be cheapest.
OP13_SQL = f"""
WITH RECURSIVE {_CRC_STEPS.strip()},
plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations
),
kinds AS (SELECT *, {_crc32("name")} % 20 AS kind FROM plain, steps),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
  FROM kinds
),
placed AS (
  SELECT conv_id, turn, role, text, role[1] AS initial, row_number() OVER w AS i,
    lag(role[1]) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid
  FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
faults AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN solid[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
),
following(state, initial, role) AS (
  VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')
),
inserted(state, to_state, price, audit, lines) AS (
  SELECT state, state, 0, '', []::VARCHAR[] FROM following
  UNION ALL SELECT state, initial, 2, 'I', [role || ':'] FROM following
  UNION ALL SELECT p.state, q.initial, 4, 'II', [p.role || ':', q.role || ':']
  FROM following p JOIN following q ON p.initial = q.state
),
repairs AS (
  SELECT conv_id, 0::BIGINT AS i, '' AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) FROM (
    SELECT r.conv_id, f.i,
      CASE e.edit WHEN 'D' THEN n.to_state WHEN 'K' THEN f.initial ELSE t.initial END AS state,
      r.best.cost + n.price + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
        + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
      r.best.audit || n.audit || e.edit AS audit,
      r.best.lines || n.lines || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
        ELSE [t.role || ':' || f.text] END AS lines
    FROM repairs r
    JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
    JOIN inserted n ON n.state = r.state
    JOIN following t ON t.state = n.to_state
    JOIN (VALUES ('D'), ('K'), ('R')) AS e(edit) ON e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (
      e.edit = 'R' OR f.initial = t.initial OR f.initial = 's' AND n.to_state = '')
  ) GROUP BY conv_id, i, state
),
sizes AS (
  SELECT c.conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps,
    count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
    count_if(fault = 'truncated') AS truncated,
    count_if(f.before IS NOT NULL AND f.before || f.initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
),
ends AS (
  SELECT s.conv_id, min({{'cost': r.best.cost + n.price, 'audit': r.best.audit || n.audit, 'lines': r.best.lines || n.lines}}) AS best
  FROM sizes s JOIN repairs r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.n
  JOIN inserted n ON n.state = r.state WHERE n.to_state IN ('', 'a') GROUP BY s.conv_id
)
SELECT s.conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank,
  CAST(duplicate AS BIGINT) AS duplicate, CAST(truncated AS BIGINT) AS truncated,
  CAST(illegal AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
  sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM sizes s JOIN ends e ON e.conv_id IS NOT DISTINCT FROM s.conv_id
"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_robust_outliers": (op1_robust_outliers, None),
    "op2_toxicity_grammar": (op2_toxicity_grammar, None),
    "op3_token_archive": (op3_token_archive, None),
    "op4_piece_lattice": (op4_piece_lattice, None),
    "op5_attention_lm": (op5_attention_lm, None),
    "op6_license_scan": (op6_license_scan, None),
    "op7_site_templates": (op7_site_templates, None),
    "op8_ngram_join": (op8_ngram_join, OP8_SQL),
    "op9_warc_segments": (op9_warc_segments, OP9_SQL),
    "op10_suffix_decontamination": (op10_suffix_decontamination, OP10_SQL),
    "op11_best_fit_packing": (op11_best_fit_packing, None),
    "op12_importance_resampling": (op12_importance_resampling, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
}
