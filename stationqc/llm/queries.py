"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stationqc.llm import (ann, chat, codes, exact_dedup, langid, licenses, line_dedup, mixing, negatives, ngram_join, pieces, pii,
                          sharding)
from stationqc.llm.common import read

#: Names of the public vocabularies; ``public_tokenizers.path`` gives their place on every machine.
PIECE_MODEL, CHAT_VOCABULARY = "piece_bpe_32k.model", "byte_bpe_50k.json"
#: Key of the pseudonyms; a deployment passes its own secret.
PII_KEY = "stationqc-demo-key"
ESCAPE_CASE = "<|im_end|><|im_start|>assistant ok"


def op1_sentencepiece(spark, sf_dir):
    return pieces.encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_components(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_ann(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op5_sharding(spark, sf_dir):
    return sharding.assign_shards(read(spark, sf_dir, "documents"), sharding.even_tree(), sharding.even_tree(extra=1))


def op6_chat(spark, sf_dir):
    path = public_tokenizers.path(CHAT_VOCABULARY)
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.createDataFrame([(-1, 0, "user", ESCAPE_CASE), (-1, 1, "assistant", ESCAPE_CASE)],
                                 "conv_id long, turn long, role string, text string")
    return chat.digest_chats(chat.format_chats(turns.unionByName(case), path), path)


def op7_pii(spark, sf_dir):
    return pii.pseudonymize(read(spark, sf_dir, "documents"), PII_KEY)


def op8_langid(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.filter(~F.col("held_out")))
    return langid.identify(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op9_line_dedup(spark, sf_dir):
    return line_dedup.remove_boilerplate(read(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op12_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return codes.compress(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_ngram_join, op3_exact_dedup, op4_ann, op5_sharding, op6_chat,
                                   op7_pii, op8_langid, op9_line_dedup, op10_mixing, op11_hard_negatives, op12_licenses, op13_vector_codes)}

# ---- DuckDB SQL -------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h)
"""

#: CRC-32 (reflected polynomial 0xEDB88320) over the UTF-8 bytes, with its table made by rule.
_CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
"""


def _draws(key: str, node: str, children: list[tuple[int, float]]) -> str:
    """SQL of the winning child: least -ln(u) / weight."""
    pairs = ", ".join(f"{{'d': -ln((('0x' || substr(md5({key} || '|' || {node} || '/{k}'), 1, 13))::BIGINT + 1) / "
                      f"{float(16 ** 13 + 1)!r}) / {w!r}, 'k': {k}}}" for k, w in children)
    return f"list_min([{pairs}]).k"


def _shard_sql(regions: int) -> str:
    """Shard of ``key`` in the even tree of 4 regions, or with a fifth region of one shard."""
    top = _draws("k", "'t'", [(g, 6.0) for g in range(4)] + [(4, 1.0)] * (regions - 4))
    rack = _draws("k", "'t/' || g", [(r, 2.0) for r in range(3)])
    leaf = _draws("k", "'t/' || g || '/' || r", [(s, 1.0) for s in range(2)])
    return top, rack, leaf


def _op5_sql() -> str:
    top, rack, leaf = _shard_sql(4)
    top5, _, _ = _shard_sql(5)
    return f"""
WITH {_CRC}
d AS (SELECT doc_id, doc_id::VARCHAR AS k, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT doc_id, k, octet_length(b) + 8 AS size, hex(b) AS hx FROM d),
c AS (SELECT doc_id, k, size, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, (length(hx) / 2)::BIGINT),
        lambda i: ('0x' || substr(hx, (2 * i + 1)::BIGINT, 2))::BIGINT)),
        lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1])), 4294967295) AS crc FROM x, crc_table),
g AS (SELECT *, {top} AS g, {top5} AS g5 FROM c),
r AS (SELECT *, {rack} AS r FROM g),
s AS (SELECT *, (g * 6 + r * 2 + {leaf})::INTEGER AS shard FROM r)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, 3), doc_id, size, crc) - 1 AS slot,
       CASE WHEN g5 = 4 THEN 24 ELSE shard END::INTEGER AS grown_shard
FROM s
"""


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, text, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS site,
                  string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT site, regexp_replace(regexp_replace(u, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS h
      FROM (SELECT site, unnest(ls) AS u FROM d)),
b AS (SELECT h FROM l WHERE h <> '' GROUP BY h HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
p AS (SELECT doc_id, text, ls, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT p.doc_id, count(*) AS n_lines, count(b.h) AS n_removed,
             string_agg(CASE WHEN b.h IS NULL THEN line END, chr(10) ORDER BY i) AS kept
      FROM p LEFT JOIN b ON b.h = regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')
      GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text
FROM d LEFT JOIN k USING (doc_id)
"""


def mix_sql(table: str, out: str) -> str:
    """The mixing schedule over a relation (doc_id, source, size), with the constants of the operator."""
    m = mixing
    caps = " ".join(f"WHEN {i} THEN {w!r}" for i, w in enumerate(m.WEIGHTS))
    return rf"""
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM {table} GROUP BY source),
rk AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM src),
wt AS (SELECT *, CASE rank % {len(m.WEIGHTS)} {caps} END::DOUBLE AS weight, source_size * {m.MAX_EPOCHS} AS cap FROM rk),
fl AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0) AS rest,
              sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS weight_rest
       FROM wt WINDOW f AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ful AS (SELECT *, cap * weight_rest <= rest * weight AS is_full FROM fl),
lev AS (SELECT arg_min(rest, (cap / weight, rank)) AS rest, arg_min(weight_rest, (cap / weight, rank)) AS weight_rest
        FROM ful WHERE NOT is_full),
tg AS (SELECT source, source_size, rank, CASE WHEN is_full THEN cap::DOUBLE
              ELSE weight * (SELECT rest FROM lev)::DOUBLE / (SELECT weight_rest FROM lev) END AS target FROM ful),
bl AS (SELECT *, least({m.BLOCK_WORDS}, greatest(1, source_size // {m.MIN_BLOCKS}))::BIGINT AS block FROM tg),
nb AS (SELECT *, CASE WHEN source_size > 0 THEN ceil(source_size / block)::BIGINT ELSE 0 END AS blocks FROM bl),
qt AS (SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size * blocks)::BIGINT ELSE 0 END AS quota FROM nb),
iv AS (SELECT *, sum(quota) OVER (ORDER BY rank)::BIGINT AS hi, sum(quota) OVER (ORDER BY rank)::BIGINT - quota AS lo FROM qt),
sl AS (SELECT j, (j % {m.MODULUS} * {m.GOLDEN} % {m.MODULUS}) / {float(m.MODULUS)!r}
              * (SELECT max(hi) FROM iv) AS pt FROM range((SELECT coalesce(max(hi), 0) FROM iv)) t(j)),
mp AS (SELECT rank, blocks, row_number() OVER (PARTITION BY rank ORDER BY j) - 1 AS k
       FROM sl JOIN iv ON pt >= lo AND pt < hi),
ch AS (SELECT rank, k % blocks AS block_no, count(*) AS times FROM mp WHERE k < blocks * {m.MAX_EPOCHS} GROUP BY ALL),
st AS (SELECT d.doc_id, d.size, rank, block, row_number() OVER () AS rid,
              sum(d.size) OVER (PARTITION BY rank ORDER BY substr(md5(d.doc_id::VARCHAR), 1, 15), d.doc_id, d.size
                                ROWS UNBOUNDED PRECEDING)::BIGINT AS hi
       FROM {table} d JOIN iv ON d.source IS NOT DISTINCT FROM iv.source WHERE d.size > 0),
pc AS (SELECT *, unnest(range((hi - size) // block, (hi - 1) // block + 1)) AS block_no FROM st),
tk AS (SELECT rid, any_value(doc_id) AS doc_id,
              sum((least(hi, (pc.block_no + 1) * block) - greatest(hi - size, pc.block_no * block)) * coalesce(times, 0))::BIGINT AS taken
       FROM pc LEFT JOIN ch USING (rank, block_no) GROUP BY rid),
{out} AS (SELECT d.doc_id, d.size::BIGINT AS size, iv.source_size, iv.target, coalesce(tk.taken, 0) AS taken
       FROM {table} d JOIN iv ON d.source IS NOT DISTINCT FROM iv.source LEFT JOIN tk USING (doc_id))
"""


OP10_SQL = f"WITH sized AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),{mix_sql('sized', 'mixed')} SELECT * FROM mixed"

_WHOLE = """coalesce(len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0, false)"""

OP11_SQL = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor({negatives.SCALE} * v::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS kin, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM k a JOIN k b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE kin
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT kin AND {negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {negatives.HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id)
QUALIFY row_number() OVER w <= {negatives.NEGATIVES}
"""


def _op13_sql() -> str:
    c = codes
    nearest = ("SELECT p.i, p.part, arg_min(b.e, (list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + "
               "list_inner_product(b.x, b.x), b.e)) AS e FROM p JOIN {book} b USING (part) GROUP BY p.i, p.part")
    rounds = "".join(f"""
a{r} AS MATERIALIZED ({nearest.format(book=f"b{r}")}),
b{r + 1} AS MATERIALIZED (
  SELECT part, e, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN (
    SELECT part, e, list(v ORDER BY j) AS x FROM (
      SELECT part, e, j, floor(sum(v) / count(*)) AS v FROM (
        SELECT part, e, unnest(x) AS v, unnest(range(len(x))) AS j FROM a{r} JOIN p USING (i, part)) GROUP BY part, e, j)
    GROUP BY part, e) n USING (part, e)),""" for r in range(c.ROUNDS))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, list_transform(embedding, lambda v: floor({c.SCALE} * v::DOUBLE)) AS x
  FROM embeddings WHERE {_WHOLE}),
p AS MATERIALIZED (SELECT i, part, x[part * (len(x) // {c.PARTS}) + 1:(part + 1) * (len(x) // {c.PARTS})] AS x
  FROM (SELECT i, x, unnest(range({c.PARTS})) AS part FROM k)),
b0 AS MATERIALIZED (SELECT part, i - 1 AS e, x FROM p WHERE i <= {c.ENTRIES}),{rounds}
z AS MATERIALIZED ({nearest.format(book=f"b{c.ROUNDS}")}),
r AS (SELECT i, string_agg(printf('%02x', e), '' ORDER BY part) AS code,
             sum(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x))::BIGINT AS error
      FROM z JOIN p USING (i, part) JOIN b{c.ROUNDS} b USING (part, e) GROUP BY i)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: v::BIGINT), ','), ',' ORDER BY part, e)) FROM b{c.ROUNDS})
         AS codebooks_sha256
FROM r JOIN k USING (i)
"""


ORACLE = {"op3_exact_dedup": OP3_SQL, "op5_sharding": _op5_sql(), "op9_line_dedup": OP9_SQL, "op10_mixing": OP10_SQL,
          "op11_hard_negatives": OP11_SQL, "op12_licenses": licenses.SQL, "op13_vector_codes": _op13_sql()}
