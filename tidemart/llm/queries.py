"""The registered queries of this package, and the SQL they agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    exact_dedup,
    hard_negatives,
    langid,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    piece_tokens,
    sharding,
    topk,
    toxicity,
    warc,
)
from tidemart.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= {n}
    THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), shingles AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), links AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.id
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN (SELECT id, min(root) AS c FROM reach GROUP BY id) ON id = doc_id
"""


def vocabulary(name: str) -> str:
    """The file of a public vocabulary, as its package tells it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model)


@query()
def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers, links and digests of the derivatives of every page."""
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return found.select(
        "page_id",
        "type",
        "record_id",
        "refers_to",
        "target_uri",
        "source_digest",
        F.octet_length("text").cast("bigint").alias("text_bytes"),
        F.sha2("text", 256).alias("text_sha256"),
        F.sha2("record", 256).alias("record_sha256"),
    )


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, langid.fit(docs))


@query()
def op4_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents")
    coded = piece_tokens.encode_documents(docs, vocabulary("piece_bpe_32k.model"))
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pieces of at most 2048 tokens, packed into sequences."""
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")
    )


@query()
def op6_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on 16 shards of equal counts."""
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


@query(
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scores
QUALIFY rank <= 5
"""
)
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every fiftieth vector."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


@query(
    """
WITH l AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), h AS (
  SELECT *, list_transform(lines, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS h FROM l
), s AS (
  SELECT *, list_filter(range(0, len(lines)), lambda i: i = 0 OR length(lines[i + 1]) >= 200 OR length(lines[i]) >= 200
    OR ((h[i + 1] % 1000003 * 257 + coalesce(h[i + 2], 0)) % 1000003) % 2 = 0) AS starts
  FROM h
), c AS (
  SELECT doc_id, lines, unnest(range(1, len(starts) + 1)) AS k, starts FROM s
), chunks AS (
  SELECT doc_id, k, starts[k] AS start, coalesce(starts[k + 1], len(lines)) - starts[k] AS length,
    lines[starts[k] + 1:coalesce(starts[k + 1], len(lines))] AS part
  FROM c
), judged AS (
  SELECT *, row_number() OVER same AS place, count(*) OVER (PARTITION BY wanted, bytes) AS n,
    first_value(doc_id) OVER same AS first_doc, first_value(k) OVER same AS first_k
  FROM (SELECT *, length > 1 OR length(part[1]) >= 200 AS counts, length > 1 OR length(part[1]) >= 40 AS wanted,
               array_to_string(part, chr(10)) AS bytes FROM chunks)
  WINDOW same AS (PARTITION BY wanted, bytes ORDER BY doc_id, start)
), beside AS (
  SELECT j.doc_id, j.k, coalesce(x.part, []) AS lines_before, coalesce(y.part, []) AS lines_after
  FROM judged j LEFT JOIN judged x ON x.doc_id = j.doc_id AND x.k = j.k - 1
  LEFT JOIN judged y ON y.doc_id = j.doc_id AND y.k = j.k + 1
), reach AS (
  SELECT j.doc_id, j.k, j.counts,
    list_min(list_filter(range(0, least(len(a.lines_after), len(b.lines_after)) + 1), lambda i:
      i = least(len(a.lines_after), len(b.lines_after)) OR a.lines_after[i + 1] <> b.lines_after[i + 1])) AS after,
    list_min(list_filter(range(0, least(len(a.lines_before), len(b.lines_before)) + 1), lambda i:
      i = least(len(a.lines_before), len(b.lines_before))
      OR a.lines_before[len(a.lines_before) - i] <> b.lines_before[len(b.lines_before) - i])) AS before
  FROM judged j JOIN beside a ON a.doc_id = j.doc_id AND a.k = j.k
  JOIN beside b ON b.doc_id = j.first_doc AND b.k = j.first_k
  WHERE j.wanted AND j.place > 1
), grown AS (SELECT * FROM reach WHERE counts OR before + after > 0),
ends AS (
  SELECT j.*, CASE WHEN own.k IS NOT NULL THEN length WHEN j.counts AND n > 1 THEN 0
      ELSE least(length, coalesce(x.after, 0)) END AS front,
    CASE WHEN own.k IS NOT NULL OR j.counts AND n > 1 THEN 0 ELSE coalesce(y.before, 0) END AS tail
  FROM judged j LEFT JOIN grown own ON own.doc_id = j.doc_id AND own.k = j.k
  LEFT JOIN grown x ON x.doc_id = j.doc_id AND x.k = j.k - 1
  LEFT JOIN grown y ON y.doc_id = j.doc_id AND y.k = j.k + 1
), left_over AS (
  SELECT doc_id, k, start, front, least(tail, length - front) AS back, length,
    part[front + 1:length - least(tail, length - front)] AS rest
  FROM ends
)
SELECT doc_id, CAST(any_value(n) AS INTEGER) AS n_lines, CAST(count(*) AS INTEGER) AS n_chunks,
       CAST(sum(front + back) AS BIGINT) AS removed_lines,
       sha256(coalesce(string_agg(array_to_string(rest, chr(10)), chr(10) ORDER BY start) FILTER (len(rest) > 0), '')) AS text_sha256
FROM left_over JOIN (SELECT doc_id, len(lines) AS n FROM l) USING (doc_id)
GROUP BY doc_id
"""
)
def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that came before."""
    found = line_dedup.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    lines = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, c: n + c["length"])
    return found.select(
        "doc_id",
        "n_lines",
        "n_chunks",
        lines.alias("removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query(NEAR_SQL.format(n=2))
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 2-word shingle sets of similarity 0.8 and more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@query(
    """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, sha256(bare) AS text_sha256, count(*) OVER (PARTITION BY bare) AS group_size,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id
  FROM (SELECT doc_id, length(coalesce(text, '')) AS points,
               regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS bare
        FROM documents))
"""
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts that are equal but for white space."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    """
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         list_reduce([4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda d: list_transform(range(8), lambda k: (ascii(d) >> k) & 1))),
           lambda c, b: xor(c >> 1, CASE WHEN (c & 1) <> b THEN 3988292384 ELSE 0 END)) AS crc
  FROM documents
), fields AS (
  SELECT *, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    replace(text, chr(10), '') AS bare
  FROM docs
), leaves AS (
  SELECT doc_id, tree, pos,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN octet_length(encode(bare)) || ':' || bare
                                 ELSE octet_length(encode(text)) || ':' || text END, '-')) AS seen
  FROM fields
), low AS (
  SELECT tree, 0 AS height, pos, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, any_value(height) + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY tree, pos // 3
), tops AS (SELECT tree, max(height) AS top FROM low GROUP BY tree),
high AS (
  SELECT 0 AS height, CAST(tree AS BIGINT) AS pos, hash FROM low JOIN tops USING (tree) WHERE height = top
  UNION ALL
  SELECT any_value(height) + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY pos // 3
), nodes AS (
  SELECT tree, height, pos, hash FROM low JOIN tops USING (tree) WHERE height < top
  UNION ALL
  SELECT l.tree, h.height + top, h.pos, h.hash
  FROM (SELECT DISTINCT tree FROM low) l JOIN tops USING (tree), high h
  WHERE h.height < (SELECT max(height) FROM high)
), steps AS (
  SELECT a.doc_id, m.height, min(m.pos) AS at, any_value(a.own) AS own,
    coalesce(string_agg(hash, '' ORDER BY m.pos) FILTER (m.pos < a.own), '') AS lefts,
    coalesce(string_agg(hash, '' ORDER BY m.pos) FILTER (m.pos > a.own), '') AS rights
  FROM (
    SELECT doc_id, l.tree, height,
      CASE WHEN height < top THEN l.pos // CAST(pow(3, height) AS BIGINT)
           ELSE l.tree // CAST(pow(3, height - top) AS BIGINT) END AS own
    FROM leaves l JOIN tops USING (tree), LATERAL (SELECT unnest(range(0, top + (SELECT max(height) FROM high))) AS height)
  ) a JOIN nodes m ON m.tree = a.tree AND m.height = a.height AND m.pos // 3 = a.own // 3
  GROUP BY a.doc_id, m.height
), fold AS (
  SELECT doc_id, 0 AS height, seen AS hash FROM leaves
  UNION ALL
  SELECT f.doc_id, f.height + 1, sha256(lefts || f.hash || rights)
  FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.height = f.height
)
SELECT doc_id, leaf, s.hash AS subroot, r.hash AS root,
  coalesce((SELECT sha256(string_agg(lefts || rights, '' ORDER BY height)) FROM steps p WHERE p.doc_id = l.doc_id), sha256('')) AS proof_sha256,
  f.hash AS folded_root, f.hash = r.hash AS verified
FROM leaves l
JOIN (SELECT tree, hash FROM low JOIN tops USING (tree) WHERE height = top) s USING (tree)
JOIN (SELECT doc_id, arg_max(hash, height) AS hash FROM fold GROUP BY doc_id) f USING (doc_id),
(SELECT hash FROM high ORDER BY height DESC LIMIT 1) r
"""
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a tampered one folds to."""
    docs = table(spark, sf_dir, "documents")
    bare = F.translate("text", "\n", "")
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    values = [bare if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.when(chosen, merkle.leaf(values))
    found = merkle.proofs(docs, tampered=tampered)
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = found.withColumn("folded_root", fold)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query(
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
), positives AS (
  SELECT * FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n USING (anchor_id)
WHERE NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved))


@query(
    """
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source
), weighed AS (SELECT *, 1 + place % 3 AS weight FROM sources),
total AS (SELECT CAST(sum(words) AS BIGINT) AS t FROM sources),
levels AS (
  SELECT CAST(0 AS BIGINT) AS round, CAST(0 AS DOUBLE) AS level
  UNION ALL
  SELECT round + 1, next FROM (
    SELECT round, level,
      CAST(any_value(t) - coalesce(sum(3 * words) FILTER (weight * level > 3 * words), 0) AS DOUBLE)
        / CAST(sum(weight) FILTER (weight * level <= 3 * words) AS DOUBLE) AS next
    FROM levels, weighed, total GROUP BY round, level)
  WHERE next IS NOT NULL AND (round = 0 OR next <> level)
), wanted AS (
  SELECT *, least(weight * level, CAST(3 * words AS DOUBLE)) AS target
  FROM weighed, (SELECT level FROM levels ORDER BY round DESC LIMIT 1)
), seats AS (
  SELECT place, unnest(range(1, CAST(ceil(target / 16) AS BIGINT) + 1 + (SELECT count(*) FROM sources))) AS seat, target
  FROM wanted WHERE target > 0
), won AS (
  SELECT place, count(*) AS n FROM (
    SELECT place FROM seats QUALIFY row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, place)
      <= (SELECT (t + 8) // 16 FROM total)
  ) GROUP BY place
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('1:' || doc_id), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sizes
)
SELECT doc_id, size, words AS source_size, target,
  CAST(CASE WHEN words = 0 THEN 0 ELSE held // words * size + greatest(0, least(start + size, held % words) - start) END AS BIGINT) AS taken
FROM placed p JOIN (
  SELECT w.*, least(coalesce(n, 0) * 16, 3 * words) AS held FROM wanted w LEFT JOIN won USING (place)
) w ON p.source IS NOT DISTINCT FROM w.source
"""
)
def op13_apportioned_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")
