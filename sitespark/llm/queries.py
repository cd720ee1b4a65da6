"""The queries of this package, with production parameters, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_trie, exact_dedup, jaccard_join, katz, langid, maxscore, mixing, secret_scan, substring_dedup, toxicity, vector_codes, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Path of the vocabulary and the pre-token pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(docs: DataFrame, known: int = 250_000) -> DataFrame:
    out = bpe.bpe_encode(docs, *tokenizer(), decode=True, known=known)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="max")


OP5_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256 FROM d JOIN g USING (norm)
"""


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs.filter(langid.learns("doc_id", 3, 1)))
    out = langid.identify_languages(docs, model)
    return out.select("doc_id", (~langid.learns("doc_id", 3, 1)).alias("held_out"), "lang_pred", "score")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('0:' || doc_id::VARCHAR) AS rank FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
o AS (SELECT *, row_number() OVER z AS k, coalesce(sum(2.0 * source_size) OVER before, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest, 1.5 * sum(source_size) OVER () AS total
      FROM w WINDOW z AS (ORDER BY 2.0 * source_size / weight, weight, source), before AS (ORDER BY 2.0 * source_size / weight, weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min_by((total - capped)::DOUBLE / rest, k) FILTER (2.0 * source_size > (total - capped)::DOUBLE / rest * weight) AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN level IS NULL OR 2.0 * source_size <= level * weight THEN 2.0 * source_size ELSE level * weight END::DOUBLE AS target FROM w, l),
q AS (SELECT *, round_even(target, 0)::BIGINT AS quota FROM t),
b AS (SELECT d.*, q.source_size, q.target, CASE WHEN q.source_size = 0 THEN 0 ELSE q.quota // q.source_size END AS whole, CASE WHEN q.source_size = 0 THEN 0 ELSE q.quota % q.source_size END AS rest,
             ('0x' || substr(rank, 1, 8))::BIGINT % 1024 AS bin FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY bin, rank, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY source ORDER BY bin RANGE UNBOUNDED PRECEDING) AS bin_upto, sum(size) OVER (PARTITION BY source, bin) AS bin_size FROM b),
e AS (SELECT *, min(bin) FILTER (bin_upto >= rest AND bin_upto - bin_size < rest) OVER (PARTITION BY source) AS edge FROM c)
SELECT doc_id, size, source_size, target,
       (size * least(2, whole + CASE WHEN edge IS NULL OR bin > edge THEN 0 WHEN bin < edge THEN 1 WHEN upto - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM e
"""

def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = katz.score_texts(table(spark, sf_dir, "documents"), langid.learns("doc_id", 7, 2))
    return out.withColumn("held_out", ~F.col("learned")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_novel")


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.exact_top_k(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH e AS (SELECT row_number() OVER () AS place, vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.place <> q.place),
r AS (SELECT query_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = langid.learns("doc_id", 5, 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(learn)
    model = toxicity.fit_toxicity(toxicity.labelled_rows(docs, labels), weight_col="weight")
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", (~learn).alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id").drop("label")


def lloyd_sql(rounds: int, entries: int = 64, parts: int = 16, scale: int = 256) -> str:
    """compress_vectors in SQL: one common table for each round's assignment and codebook."""
    assign = """a{i} AS (SELECT place, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
        FROM (SELECT p.place, p.part, c.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda k: (p.x[k] - c.x[k]) * (p.x[k] - c.x[k])))::BIGINT AS d FROM p JOIN c{i} c USING (part)) p GROUP BY place, p.part)"""
    update = """s{i} AS (SELECT part, entry, k, sum(v)::BIGINT AS s, count(*) AS n FROM (SELECT a.part, a.entry, unnest(range(1, len(p.x) + 1)) AS k, unnest(p.x) AS v FROM p JOIN a{i} a USING (place, part)) GROUP BY part, entry, k),
        m{i} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM s{i} GROUP BY part, entry),
        c{j} AS (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (part, entry))"""
    steps = [f(i) for i in range(rounds) for f in (lambda i: assign.format(i=i), lambda i: update.format(i=i, j=i + 1))] + [assign.format(i=rounds)]
    return f"""
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS place, vec_id, label, [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT place, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x FROM e, range({parts}) r(part)),
c0 AS (SELECT part, place AS entry, x FROM p WHERE place < {entries}),
{", ".join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}),
o AS (SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY place)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN o USING (place), h
"""


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("rank", "end_rank")


#: crc32(decimal conv_id) is worked out bit by bit, from the reflected polynomial 0xEDB88320.
OP12_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS lead, xor(list_reduce([x::BIGINT for x in list_prepend(4294967295::BIGINT, [ord(c)::BIGINT for c in string_split(conv_id::VARCHAR, '')])],
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(l.turns, [])[1:h.h], h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN o l ON l.conv_id = h.lead),
m AS (SELECT conv_id, len(turns) AS own, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
n AS (SELECT turns[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (own = depth), '')) AS ends_sha256 FROM m GROUP BY turns[1:depth], depth),
c AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY node[1:depth - 1], depth - 1),
f AS (SELECT n.*, coalesce(n_children, 0)::BIGINT AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.node[n.depth].text, '[^\x20\x09-\x0D]+')) END AS saving FROM n LEFT JOIN c ON c.depth = n.depth AND c.node = n.node),
u AS (SELECT node, depth, n_children, saving, unnest(range(0, depth + 1)) AS up FROM f),
s AS (SELECT node[1:up] AS node, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM u GROUP BY node[1:up], up)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s ON s.depth = f.depth AND s.node = f.node LEFT JOIN n p ON p.depth = f.depth - 1 AND p.node = f.node[1:f.depth - 1]
"""


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT place, doc_id, s, md5(array_to_string(words[s : s + 49], ' ')) AS h FROM (SELECT *, unnest(range(1, len(words) - 48)) AS s FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
g AS (SELECT DISTINCT place, unnest(range(s, s + 50)) AS k FROM w JOIN f USING (h) WHERE first < doc_id),
k AS (SELECT place, list(k ORDER BY k) AS gone FROM g GROUP BY place)
SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(CASE WHEN gone IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(list_where(words, list_transform(range(1, len(words) + 1), lambda x: NOT list_contains(gone, x))), ' ') END) AS kept_sha256
FROM d LEFT JOIN k USING (place)
"""


QUERIES = {f.__name__: f for f in (op1_bpe, op2_katz, op3_jaccard_join, op4_secret_scan, op5_exact_dedup, op6_maxscore, op7_warc, op8_language_id, op9_toxicity, op10_mix, op11_vector_codes, op12_conversation_trie, op13_substring_dedup)}
ORACLE_SQL = {"op5_exact_dedup": OP5_SQL, "op6_maxscore": OP6_SQL, "op7_warc": OP7_SQL, "op10_mix": OP10_SQL, "op11_vector_codes": lloyd_sql(2), "op12_conversation_trie": OP12_SQL, "op13_substring_dedup": OP13_SQL}
