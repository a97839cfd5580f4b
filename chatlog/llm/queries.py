"""The operators as queries over one scale directory, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chatlog.llm import (
    bpe, chatformat, collocation, decontam, hnsw, langid, linededup, ppm, probminhash, resample, secrets, sharding, toxicity,
)
from chatlog.llm.common import table

#: The public vocabulary that op8 and the pipeline encode with.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_benchmark_decontamination(spark, sf_dir):
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def _sql_words(text: str) -> str:
    return (f"list_filter(string_split_regex(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")


ORACLE_SQL["op1_benchmark_decontamination"] = f"""
WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words('text')} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS t FROM it WHERE len(w) > 0),
win AS (SELECT DISTINCT item, t, list_aggregate(w[i:i + t - 1], 'string_agg', ' ') AS win
        FROM (SELECT item, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM sized)),
lens AS (SELECT DISTINCT t FROM sized),
d AS (SELECT doc_id, row_number() OVER () AS rid, {_sql_words('text')} AS w FROM documents),
dw AS (SELECT rid, t, i, list_aggregate(w[i:i + t - 1], 'string_agg', ' ') AS win
       FROM (SELECT rid, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM d, lens WHERE len(w) >= t)),
met AS (SELECT rid, dw.t, i, item FROM dw JOIN win USING (t, win)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + t)) AS p FROM met) GROUP BY rid),
named AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM met GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)"""


@query
def op3_secret_scans(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def _sql_spans(kind: int, pattern: str, group: int, least: int, more: str = "") -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT rid, source, lang, {kind} AS kind, begun + coalesce(list_sum(list_transform(ms[1:i - 1], lambda s: length(s))), 0)::BIGINT AS start,
        begun + list_sum(list_transform(ms[1:i], lambda s: length(s)))::BIGINT AS stop, v AS value
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT rid, source, lang, text, string_split_regex(text, '{p}') AS ps, regexp_extract_all(text, '{p}') AS ms,
               regexp_extract_all(text, '{p}', {group}) AS vs FROM d WHERE regexp_matches(text, '{p}'))) z,
      LATERAL (SELECT coalesce(list_sum(list_transform(ps[1:i], lambda s: length(s))), 0)::BIGINT AS begun, vs[i] AS v) y
      WHERE length(v) >= {least} {more}"""


_ASSIGN = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_NAMED = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "][kind + 1] || ':' || start || ':' || stop"
ORACLE_SQL["op3_secret_scans"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, coalesce(text, '') AS text FROM documents),
base AS ({_sql_spans(0, _ASSIGN, 2, 12)} UNION ALL {_sql_spans(1, secrets.ACCESS, 0, 18)} UNION ALL {_sql_spans(2, secrets.HEX, 0, 16)}),
wide AS (SELECT * FROM ({_sql_spans(3, secrets.WIDE, 0, 20, "AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')")}) w
         WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.start < w.stop AND w.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM wide),
owned AS (SELECT value, count(DISTINCT coalesce(source, '')) <= 1 AND count(DISTINCT coalesce(source, '?') || '/' || coalesce(lang, '?')) <= 3 AS specific
          FROM every GROUP BY value),
kept AS (SELECT *, {_NAMED} AS named FROM every JOIN owned USING (value) WHERE kind < 3 OR specific),
per AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
               string_agg(named, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(named, ',' ORDER BY start, kind) AS spans,
               count(*) FILTER (specific) AS n_specific, count(*) FILTER (NOT specific) AS n_copied FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_specific, 0) AS n_specific, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (rid)"""


@query
def op10_chat_formatting(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return chatformat.read_back(chatformat.format_chats(chats.unionByName(awkward)))


ORACLE_SQL["op10_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (SELECT *, CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN '</s>' WHEN 'system' THEN '<</SYS>>' ELSE '[/ROLE]' END AS close,
  CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 3 WHEN 'system' THEN 7
       ELSE 7 + length(role) + length(regexp_replace(role, '[^\\\[\]<]', '', 'g')) END AS open_chars FROM c),
sized AS (SELECT *, open_chars + length(close) + length(text) + CASE
  WHEN strpos(text || close, close) <> length(text) + 1 OR regexp_matches(text, '\\[blar]')
  THEN length(regexp_replace(text, '[^\\\[\]<]', '', 'g')) ELSE 0 END AS chars FROM marked)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


@query
def op8_bpe_encoding_and_decoding(spark, sf_dir):
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), VOCABULARY))


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    able = ~toxicity.held_out()
    model = toxicity.fit(docs.filter(able), table(spark, sf_dir, "labels").filter(able))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs.filter(~langid.held_out())))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_lm_scoring(spark, sf_dir):
    out = ppm.score(table(spark, sf_dir, "documents"), ~ppm.held_out(), order=4)
    return out.select("doc_id", ppm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_approximate_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.search(hnsw.build_index(vectors, k=20), vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op2_line_dedup(spark, sf_dir):
    out = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op2_line_dedup"] = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM (SELECT rid, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
shared AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, s.k IS NOT NULL AND (doc_id IS NULL OR doc_id < last) AS gone FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid"""


@query
def op6_minhash_near_dedup(spark, sf_dir):
    return probminhash.classes(table(spark, sf_dir, "documents"))


@query
def op11_sharding(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents"))


def _sql_feistel(rows: str) -> str:
    """One pass of the network over `v` of the given rows, with `b` bits a half and mask `m`: `moved`."""
    sql = f"SELECT *, v >> b AS l, v & m AS r FROM {rows}"
    for key in sharding.round_keys(sharding.SEED):  # a level each, so that nothing is written out twice
        sql = f"SELECT *, (r * {sharding.FACTOR_1} + {key}) % {sharding.PRIME} AS x FROM ({sql})"
        sql = f"SELECT *, (xor(x, x >> 15) * {sharding.FACTOR_2} + {key}) % {sharding.PRIME} AS y FROM ({sql})"
        sql = f"SELECT row_at, n, b, m, r AS l, xor(l, xor(y, y >> 13) & m) AS r FROM ({sql})"
    return f"SELECT row_at, n, b, m, (l << b) | r AS moved FROM ({sql})"


def _nibbles() -> str:
    """CRC-32 steps of four bits."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return str(table)


def _sql_crc(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, four bits at a time."""
    digits = f"string_split(hex(encode({text})), '')"
    order = "lambda i: strpos('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1"
    return (f"(SELECT xor(list_reduce(list_transform(range(0, len(h) // 2 * 2), {order}), "
            f"lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1]), 4294967295), 4294967295) "
            f"FROM (SELECT CASE WHEN {text} = '' THEN [] ELSE {digits} END AS h, {_nibbles()}::BIGINT[] AS t))")


ORACLE_SQL["op11_sharding"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
sized AS (SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size, CAST({_sql_crc('text')} AS BIGINT) AS text_crc32 FROM d),
total AS (SELECT count(*) AS n, (SELECT min(k) FROM range(1, 25) x(k) WHERE (1::BIGINT << (2 * k)) >= (SELECT count(*) FROM d)) AS b FROM d),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_at FROM sized),
walk AS (SELECT row_at, row_at AS v, n, b, (1::BIGINT << b) - 1 AS m, false AS stays FROM numbered, total
         UNION ALL SELECT row_at, moved, n, b, m, moved < n FROM ({_sql_feistel('walk WHERE NOT stays')}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(v % {sharding.SHARDS} AS INTEGER) AS shard,
       CAST(v // {sharding.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (row_at) WHERE stays"""


@query
def op12_phrase_collocation_mining(spark, sf_dir):
    return collocation.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_phrase_collocation_mining"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM p),
pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
runs AS (SELECT lang, 1 AS k, w[i] AS phrase FROM pos
         UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM pos WHERE i + 1 <= len(w)
         UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM pos WHERE i + 2 <= len(w)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS cut FROM c),
parted AS (SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest FROM cut),
each AS (SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
         FROM parted c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = rest),
lowest AS (SELECT * FROM each QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
over AS (SELECT lang, phrase, max(a) AS a FROM (
           SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT x.* FROM lowest x LEFT JOIN over o ON o.lang = x.lang AND o.phrase = x.phrase WHERE o.a IS NULL OR 100 * o.a < 50 * x.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


@query
def op13_target_distribution_importance_resampling(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op13_target_distribution_importance_resampling"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT {_sql_words('text')} AS w FROM benchmark),
dw AS (SELECT rid, unnest(w) AS w FROM d),
bw AS (SELECT unnest(w) AS w FROM b),
hashed AS MATERIALIZED (SELECT w, CAST({_sql_crc('w')} AS BIGINT) % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
gain AS (SELECT x.k AS bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
           / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE))) AS BIGINT) AS gain
         FROM range(0, 10000) x(k) LEFT JOIN s ON s.bucket = x.k LEFT JOIN t ON t.bucket = x.k),
per AS (SELECT rid, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM d LEFT JOIN per USING (rid)),
drawn AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (rid)"""
