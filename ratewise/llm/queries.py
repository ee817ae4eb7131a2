"""The registered queries of the document operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import bpe, conversation_repair, exact_dedup, langid, line_dedup, lm_scoring, metric_join, mixing, near_dedup
from ratewise.llm import periodic_runs, quality, suffix_dedup, toxicity
from ratewise.llm.common import in_training_fold, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in the largest doc_id only."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op1_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line,
         lower_ascii AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS i) r,
       LATERAL (SELECT translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii) x),
g AS (SELECT k, count(DISTINCT doc_id) AS n, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k),
m AS (SELECT l.*, coalesce(g.n >= 3 AND g.last <> l.doc_id, false) AS gone FROM l LEFT JOIN g ON l.k = g.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document by the votes of its nearest labelled examples."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    done = docs.select("doc_id", toxicity.toxicity(docs, labels).alias("r"))
    return done.select("doc_id", (~in_training_fold("doc_id")).alias("held_out"), "r.score",
                       (F.col("r.score") >= 0.5).cast("int").alias("predicted"), "r.vote", "r.evidence")


VOCABULARY = "word_bpe_49k.json"


@_query
def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each text and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents")
    done = docs.select("doc_id", bpe.encoded(spark, "text", public_tokenizers.path(VOCABULARY)).alias("r"))
    return done.select("doc_id", F.size("r.ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("r.ids", " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"))


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics, base rules and the isolation forest's verdict of each document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    done = docs.select("doc_id", quality.quality(docs, labels).alias("r"))
    return done.select("doc_id", *(f"r.{c}" for c in quality.COUNTS[:5]), "r.base_failed", "r.kept", "r.anomaly")


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by shortest code length."""
    docs = table(spark, sf_dir, "documents")
    done = docs.select("doc_id", langid.detected(langid.train(docs), docs).alias("r"))
    return done.select("doc_id", (~in_training_fold("doc_id")).alias("held_out"), F.col("r.lang").alias("lang_pred"),
                       "r.score", "r.bits_per_byte")


@_query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes, with its source's target."""
    return mixing.mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        F.get("positions", F.lit(0)).alias("first_position"))


SQL["op6_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || doc_id) AS turn
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, [-0.5, 0.0, 0.5][place % 3 + 1]::DOUBLE AS slope,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
-- share by weight, cap, share the excess again until no source is above its cap
r AS (
  SELECT 0 AS round, source, place, weight, cap, total, least(cap, total * weight / sum(weight) OVER ()) AS got FROM w
  UNION ALL
  SELECT round + 1, source, place, weight, cap, total,
         CASE WHEN got >= cap THEN cap ELSE
           least(cap, (total - sum(CASE WHEN got >= cap THEN cap ELSE 0 END) OVER ()) * weight
                      / sum(CASE WHEN got >= cap THEN 0 ELSE weight END) OVER ()) END
  FROM r WHERE round < 40),
t AS (SELECT w.*, r.got AS target FROM w JOIN r ON r.place = w.place AND r.round = 40),
p AS (
  SELECT d.*, t.source_size, t.target, t.slope, floor(t.target)::BIGINT AS stop,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY turn, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(size, greatest(0, stop - c)) + least(size, greatest(0, stop - c - source_size)))::BIGINT AS taken,
       (CASE WHEN size > 0 AND c < stop THEN 1 ELSE 0 END
        + CASE WHEN size > 0 AND c + source_size < stop THEN 1 ELSE 0 END)::BIGINT AS copies,
       CASE WHEN size > 0 AND c < stop THEN
         CASE WHEN slope = 0 THEN c / target
              ELSE (sqrt(greatest(0.0, (1 - slope) * (1 - slope) + 4 * slope * (c / target))) - (1 - slope)) / (2 * slope) + 0.0 END
       END AS first_position
FROM p
"""


@_query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of each document: like the documents labelled good, or like all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    done = lm_scoring.scored(docs, labels)
    return done.select("doc_id", "r.n_tokens", "r.target_bits", "r.background_bits", "r.score")


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of equal texts of each document; the row with the largest doc_id stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest").select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL["op8_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY k) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY k) AS kept, sha256(k) AS text_sha256
FROM t
"""


@_query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document; its smallest doc_id stays."""
    done = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_shingles", "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL["op9_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END) AS h
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i) r WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node),
m AS (SELECT node, min(root) AS root FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.node = d.doc_id
"""


@_query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that belong to a 200-byte string met elsewhere are removed."""
    done = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def _replanted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text: a tenth of the documents (by a hash of the id) with their words repeated periodically from some
    word on, as op11's contract says; a null id's text is left as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    found = F.regexp_extract_all(F.col(text), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    split = docs.select(doc_id, text, F.when(h % 10 == 0, found).alias("ws"), F.floor(h / 10).alias("g"))
    n = F.greatest(F.size("ws"), F.lit(1))
    places = split.withColumn("a", F.pmod("g", n).cast("int")).withColumn(
        "p", (1 + F.floor((n - F.col("a")) / (3 + F.pmod("g", F.lit(8))))).cast("int"))
    rest = n - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("ws", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("ws", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return places.select(doc_id, F.when(F.size("ws") > 0, planted).otherwise(F.col(text)).alias(text))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of each document, the longest one, and the text with each run cut to one period."""
    docs = table(spark, sf_dir, "documents")
    found = _replanted(docs, "doc_id", "text").select("doc_id", periodic_runs.periodic_runs("text").alias("r"))
    best = F.array_min(F.transform("r.runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"),
                                                               r["period"].alias("period"))))
    lines = F.transform("r.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("r.runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    (-F.col("best.minus")).alias("length"), F.col("best.period").alias("period"),
                    F.floor(-1000 * F.col("best.minus") / F.col("best.period")).alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda t: F.concat(t, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2("r.collapsed", 256).alias("collapsed_sha256")))


def _damaged(turns: DataFrame) -> DataFrame:
    """conversations with the damage of op12's contract, by a hash of conversation and turn; ``copies`` is how often a
    turn stands there (0: dropped)."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
                        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and the repaired turns' hash of each damaged conversation."""
    turns = _damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(conversation_repair.as_rows(turns, copies="copies")).withColumnRenamed("conv", "conv_id")


SQL["op12_conversation_repair"] = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
-- crc32, bit by bit over the key's bytes
crc AS (
  SELECT DISTINCT k, 0 AS pos, 4294967295::BIGINT AS c FROM raw
  UNION ALL
  SELECT k, pos + 1, list_reduce([xor(c, ascii(k[pos + 1]))::BIGINT, 1, 1, 1, 1, 1, 1, 1, 1],
                                lambda v, b: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)
  FROM crc WHERE pos < length(k)),
h AS (SELECT k, xor(c, 4294967295::BIGINT) % 20 AS kind FROM crc WHERE pos = length(k)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM raw JOIN h USING (k), LATERAL (SELECT unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy) r),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS r,
         CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
-- grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; ways from one to another by insertions
ways AS (SELECT * FROM (VALUES (0,0,0),(1,1,0),(2,2,0),(3,3,0),(0,2,1),(1,2,1),(3,2,1),(2,3,1),(0,3,2),(1,3,2),(2,2,2),(3,3,2)) t(a, b, n)),
letters AS (
  SELECT * FROM (VALUES ('D',0,0,'',3),('D',1,1,'',3),('D',2,2,'',3),('D',3,3,'',3),
    ('K',0,1,'s',0),('K',0,2,'u',0),('K',1,2,'u',0),('K',3,2,'u',0),('K',2,3,'a',0),
    ('R',0,2,'u',2),('R',1,2,'u',2),('R',3,2,'u',2),('R',2,3,'a',2)) t(e, a, b, r, cost)),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM conversations
  UNION ALL
  (SELECT w.conv_id, w.i + 1, l.b, w.cost + 2 * y.n + l.cost + CASE WHEN l.e <> 'D' AND f.fault = 3 THEN 1 ELSE 0 END,
          w.audit || repeat('I', y.n) || l.e
   FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        JOIN ways y ON y.a = w.state JOIN letters l ON l.a = y.b
   WHERE l.e = 'D' OR f.fault IN (0, 3) AND CASE WHEN l.e = 'K' THEN f.r = l.r ELSE f.r <> l.r END
   QUALIFY row_number() OVER (PARTITION BY w.conv_id, l.b ORDER BY w.cost + 2 * y.n + l.cost
             + CASE WHEN l.e <> 'D' AND f.fault = 3 THEN 1 ELSE 0 END, w.audit || repeat('I', y.n) || l.e) = 1)),
counts AS (
  SELECT c.conv_id, count(f.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
best AS (
  SELECT w.conv_id, w.cost + 2 * y.n AS cost, w.audit || repeat('I', y.n) AS audit
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN ways y ON y.a = w.state AND y.b IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 2 * y.n, w.audit || repeat('I', y.n)) = 1),
steps AS (
  SELECT conv_id, pos, audit[pos] AS e, length(replace(audit[1:pos], 'I', '')) AS i, length(replace(audit[1:pos], 'D', '')) AS place
  FROM best, LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS pos) r),
named AS (
  SELECT s.conv_id, s.pos, s.place, s.e, f.role, f.text,
         max(CASE WHEN s.e = 'K' AND s.place = 1 AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS lead
  FROM steps s LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i AND s.e IN ('K', 'R') WHERE s.e <> 'D'),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role ELSE CASE WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END END
                             || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS body
  FROM named GROUP BY conv_id)
SELECT c.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, b.cost::BIGINT AS cost, b.audit,
       sha256(coalesce(l.body, '')) AS repaired_sha256
FROM counts c JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@_query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document over links of three-word shingle sets of similarity 0.9 or more."""
    return metric_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL["op13_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END) AS h
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i) r WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node),
m AS (SELECT node, min(root) AS root FROM c GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.root AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.node = d.doc_id
"""
