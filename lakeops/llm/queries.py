"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    centroids,
    jaccard,
    langid,
    licenses,
    merkle,
    mixing,
    neardup,
    packing,
    pagetext,
    quality,
    sharding,
    toxicity,
    trie,
)
from lakeops.llm.common import documents

SHARDS = 40
SEQUENCE = 2048
MIX_SEED = 17


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neardup.links(vectors, 0.95).select("vec_id", "n_links", "component_id", "kept")


def op2_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text against its edited form and against the next document."""
    rows = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = merkle.with_next(rows, "doc_id", "text", "next_text")
    rows = rows.withColumn("edited_text", merkle.edited(F.col("text"), F.col("next_text")))
    for name in ("text", "edited_text", "next_text"):
        rows = merkle.with_tree(rows, name, f"{name}_tree")
        rows = rows.withColumn(f"{name}_pieces", merkle.pieces(F.col(f"{name}_tree")))

    def near(other: str):
        return merkle.likeness(
            F.col("text_tree.root"), F.col("text_pieces"), F.col(f"{other}_tree.root"), F.col(f"{other}_pieces")
        )

    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        merkle.as_text(F.col("text_tree")).alias("fingerprint"),
        merkle.as_text(F.col("edited_text_tree")).alias("edited_fingerprint"),
        near("edited_text").alias("near_edited"),
        near("next_text").alias("near_next"),
    )


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source to a share that follows the square root of its number of documents."""
    return mixing.mix(documents(spark, sf_dir), power=0.5, seed=MIX_SEED)


def op6_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op7_license_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(documents(spark, sf_dir), SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE)


def op10_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_tree_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_cross_polytope": op1_cross_polytope,
    "op2_quality_discriminant": op2_quality_discriminant,
    "op3_byte_language": op3_byte_language,
    "op4_merkle_fingerprints": op4_merkle_fingerprints,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_token_group_join": op6_token_group_join,
    "op7_license_bands": op7_license_bands,
    "op8_ring_shards": op8_ring_shards,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_weak_toxicity": op10_weak_toxicity,
    "op11_tree_marginals": op11_tree_marginals,
    "op12_burst_trie": op12_burst_trie,
    "op13_bisector_tournament": op13_bisector_tournament,
}

# Inverts the Poisson distribution at the same hashed number; 45 terms reach beyond 2**-52
# for the rates that the square-root rule gives on these tables.
OP5_SQL = f"""
WITH n AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source),
r AS (SELECT source, (SELECT sum(n) FROM n) * sqrt(n) / (SELECT sum(sqrt(n)) FROM n) / n AS rate FROM n),
k AS (SELECT CAST(range AS INTEGER) AS k FROM range(60)),
p AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
      FROM r, k),
u AS (SELECT d.*, CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
                  / CAST(4503599627370496 AS DOUBLE) AS point FROM documents d),
t AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars,
             (SELECT count(*) FROM p WHERE p.source IS NOT DISTINCT FROM u.source AND p.below <= u.point) AS times FROM u),
c AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(CAST(times AS BIGINT))) AS copy FROM t)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       CAST('0x' || substr(md5('{MIX_SEED + 1}:' || CAST(doc_id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)), 1, 13) AS BIGINT)
         AS shuffle_key
FROM c
"""

# Every window that holds a shingle of a template, without hashes or retrieval.
_NAMES = ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES.items())
_WORDS = r"list_filter(regexp_split_to_array(lower({text}), '[^\pL\pN]+'), lambda w: w <> '')"
OP7_SQL = f"""
WITH given AS (SELECT * FROM (VALUES {_NAMES}) AS v(license, text)),
tw AS (SELECT license, {_WORDS.format(text="text")} AS words FROM given),
t AS (SELECT license, len(words) AS m, greatest(1, len(words) // 4) AS stride, words FROM tw),
tb AS (SELECT DISTINCT license, m, stride, words[i] || ' ' || words[i + 1] AS pair
       FROM (SELECT *, unnest(range(1, m)) AS i FROM t)),
ts AS (SELECT license, count(*) AS held FROM tb GROUP BY license),
dw AS (SELECT doc_id, {_WORDS.format(text="text")} AS words FROM documents),
db AS (SELECT doc_id, i - 1 AS place, words[i] || ' ' || words[i + 1] AS pair
       FROM (SELECT *, unnest(range(1, len(words))) AS i FROM dw)),
hits AS (SELECT doc_id, license, m, stride, place, pair FROM db JOIN tb USING (pair)),
starts AS (SELECT *, unnest(range(CAST(greatest(0, ceil((place - m - stride + 3) / CAST(stride AS DOUBLE))) AS BIGINT),
                                  CAST(place // stride + 1 AS BIGINT))) * stride AS start FROM hits),
w AS (SELECT doc_id, license, start, count(DISTINCT pair) AS n FROM starts GROUP BY ALL),
s AS (SELECT doc_id, license, start, CAST(n AS DOUBLE) / held AS containment FROM w JOIN ts USING (license)
      WHERE CAST(n AS DOUBLE) / held >= {licenses.CONTAINMENT})
SELECT doc_id, license, max(containment) AS containment,
       CAST(min(start) FILTER (WHERE containment = top) AS INTEGER) AS first_word, CAST(count(*) AS INTEGER) AS windows
FROM (SELECT *, max(containment) OVER (PARTITION BY doc_id, license) AS top FROM s) GROUP BY doc_id, license
"""

# Every prefix of every rebuilt conversation as text, then plain grouping.
OP12_SQL = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS b, count(*) AS n FROM t GROUP BY c),
bits AS (SELECT c, CAST(c AS VARCHAR) AS s FROM h),
{{crc}}
taken AS (SELECT h.c, f.h, t.p AS d, t.r, t.x FROM h JOIN f ON h.c = f.c JOIN t ON t.c = h.b AND t.p <= f.h),
k AS (SELECT f.c, f.h, count(taken.c) AS k FROM f LEFT JOIN taken ON taken.c = f.c GROUP BY f.c, f.h),
whole AS (SELECT c, d, r, x FROM taken
          UNION ALL SELECT t.c, CAST(t.p - k.h + k.k AS BIGINT), t.r, t.x FROM t JOIN k ON t.c = k.c WHERE t.p > k.h),
steps AS (SELECT c, d, length(x) AS chars, md5(length(r)::VARCHAR || ':' || r || x) AS id FROM whole),
pre AS (SELECT c, d, chars, string_agg(id, '') OVER (PARTITION BY c ORDER BY d) AS path FROM steps
        UNION ALL SELECT c, 0, 0, '' FROM h),
size AS (SELECT c, max(d) AS n FROM pre GROUP BY c),
node AS (SELECT path, pre.d AS depth, min(pre.c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           coalesce(string_agg(CAST(pre.c AS VARCHAR), ',' ORDER BY pre.c) FILTER (WHERE pre.d = n), '') AS ends
         FROM pre JOIN size ON pre.c = size.c GROUP BY path, pre.d),
up AS (SELECT node.*, left(path, 32 * (depth - 1)) AS above FROM node),
kids AS (SELECT above AS path, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY above),
own AS (SELECT up.path, depth, conv_id, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved
        FROM up LEFT JOIN kids ON kids.path = up.path),
sub AS (SELECT left(path, 32 * d) AS path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM own) GROUP BY 1)
SELECT up.conv_id, CAST(up.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, up.n_convs, own.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(up.ends) AS ends_sha256
FROM up JOIN own ON own.path = up.path JOIN sub ON sub.path = up.path
LEFT JOIN up p ON up.depth > 0 AND p.path = up.above
"""
# The checksum a byte at a time, eight shifts for each.
_SHIFTS = "v"
for _ in range(8):
    _SHIFTS = f"list_transform({_SHIFTS}, lambda z: xor(z >> 1, (z & 1) * 3988292384))"
OP12_SQL = OP12_SQL.format(
    crc=f"""z AS (SELECT c, list_reduce(list_prepend(4294967295::UBIGINT,
  list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::UBIGINT)),
  lambda v0, b: {_SHIFTS.replace("(v,", "([xor(v0, b)],")}[1]) AS v FROM bits),
f AS (SELECT c, CAST(xor(v, 4294967295::UBIGINT) % 6 AS BIGINT) AS h FROM z),"""
)

_KEPT = """p0 AS (SELECT vec_id, row_number() OVER () AS r, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
p AS MATERIALIZED (SELECT vec_id, r, unnest(range(64)) AS i,
  CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v FROM p0),
c0 AS MATERIALIZED (SELECT k, i, v FROM p JOIN (SELECT r, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS k
  FROM p0 QUALIFY k < 16) USING (r))"""


def _assigned(number: int) -> str:
    """Nearest of the centroids ``c<number>``, all distances computed."""
    return f"""a{number} AS MATERIALIZED (SELECT r, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM
  (SELECT p.r, c.k, sum((p.v - c.v) * (p.v - c.v)) AS dist FROM p JOIN c{number} c USING (i) GROUP BY p.r, c.k) GROUP BY r)"""


def _moved(number: int) -> str:
    return f"""c{number + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(m.v, c.v) AS v FROM c{number} c LEFT JOIN
  (SELECT k, i, CAST((s - (s % n + n) % n) // n AS BIGINT) AS v
   FROM (SELECT k, i, sum(v) AS s, count(*) AS n FROM p JOIN a{number} USING (r) GROUP BY k, i)) m
  ON c.k = m.k AND c.i = m.i)"""


OP13_SQL = (
    "WITH "
    + ",\n".join([_KEPT, *[part for n in range(3) for part in (_assigned(n), _moved(n))], _assigned(3)])
    + """,
s AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS digest FROM c3 GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
  CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
  digest AS centroid_sha256
FROM a3 JOIN p0 USING (r) JOIN s USING (k)
"""
)

ORACLES = {
    "op5_poisson_mix": OP5_SQL,
    "op7_license_bands": OP7_SQL,
    "op12_burst_trie": OP12_SQL,
    "op13_bisector_tournament": OP13_SQL,
}
