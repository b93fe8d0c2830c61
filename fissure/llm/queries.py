"""One query per training-data operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fissure.llm import alignment, bpe, collocations, licenses, mixing, quality, secrets, sharding, simhash, subwords, suffixes, token_counts, topk
from fissure.llm._common import read


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_token_counts(read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(read(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read(spark, sf_dir, "documents"), with_ids=False)


def op11_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def tokens_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of every text, whose tokens add up to the document's."""
    rows = token_counts.section_token_counts(read(spark, sf_dir, "documents"))
    total = F.sum("n_tokens").over(Window.partitionBy("doc_id"))
    return rows.select("doc_id", "section", "start_char", "end_char", (F.abs(total - F.col("doc_tokens")) < 1e-6).alias("adds_up"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_quality(spark, sf_dir).select("doc_id", *quality.COUNTS, "base_failed", (F.col("kept") & F.col("base_failed")).alias("kept_though_failed"))


def licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def sharding_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, whether equal texts share a shard, and whether the slots of the row's shard are 0, 1, 2 and so on."""
    rows = sharding.shard(read(spark, sf_dir, "documents"))
    texts = rows.groupBy("sha").agg((F.min("shard") == F.max("shard")).alias("together"))
    shards = rows.groupBy("shard").agg(((F.count("*") == F.count_distinct("slot")) & (F.max("slot") == F.count("*") - 1) & (F.min("slot") == 0)).alias("gapless"))
    return rows.join(texts, "sha").join(shards, "shard").select("doc_id", "size", "together", (F.col("gapless") & F.col("shard").between(0, 15)).alias("gapless"))


def suffixes_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_suffixes(spark, sf_dir).select("doc_id", "dup_words", "spans")


def secrets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def mixing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets, whether a document stays within its limit, and whether its source comes within 3 % or 100 words of its target."""
    rows = op9_mixing(spark, sf_dir).join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    sums = rows.groupBy("source").agg(F.sum("taken").alias("words"), F.first("target").alias("aim")).select(F.col("source").alias("of"), (F.abs(F.col("words") - F.col("aim")) <= F.greatest(F.lit(100.0), F.col("aim") * 0.03)).alias("near"))
    return rows.join(sums, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), F.col("taken").between(0, 3 * F.col("size")).alias("within"), "near")


def subwords_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out fold, whether scores are between 0 and 1, and whether the cut is kept to."""
    return op11_subwords(spark, sf_dir).select("doc_id", "held_out", F.col("score").between(0, 1).alias("bounded"), (F.col("predicted") == F.when(F.col("score") >= 0.3, 1).otherwise(0)).alias("cut_kept"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_simhash, op3_topk, op4_quality, op5_licenses, op6_sharding, op7_suffixes, op8_secrets, op9_mixing, op10_bpe, op11_subwords, op12_collocations, op13_alignment, tokens_base, quality_base, licenses_base, sharding_base, suffixes_base, secrets_base, mixing_base, subwords_base)}

#: What the contracts fix beside the methods' own verdicts is compared with SQL by the queries that end in ``_base``.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
ORACLE_SQL = {
    "tokens_base": """
        WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
        s AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, len(p) AS n, p FROM l),
        e AS (SELECT doc_id, i, length(p[i]) + CASE WHEN i < n THEN 1 ELSE 0 END AS chars FROM s WHERE NOT (i = n AND n > 1 AND p[i] = ''))
        SELECT doc_id, CAST(i - 1 AS INTEGER) AS section, CAST(sum(chars) OVER w - chars AS BIGINT) AS start_char, CAST(sum(chars) OVER w AS BIGINT) AS end_char, true AS adds_up
        FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY i)
    """,
    "quality_base": rf"""
        WITH d AS (SELECT doc_id, text, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
        c AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM c, (SELECT unnest(range(5)) AS j) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(w) AS base_failed, false AS kept_though_failed
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "licenses_base": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p AS (SELECT doc_id, len(w) AS n, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS a, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS b,
            list_filter(range(1, len(w) + 1), lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS c FROM d)
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(a) + len(b) + len(c) AS BIGINT) AS n_base, CAST(list_min(list_concat(a, b, c)) - 1 AS BIGINT) AS first_word, CAST(list_max(list_concat(a, b, c)) - 1 AS BIGINT) AS last_word,
            concat_ws(',', CASE WHEN len(a) > 0 THEN 'cc-by' END, CASE WHEN len(b) > 0 THEN 'gpl' END, CASE WHEN len(c) > 0 THEN 'reserved' END) AS base_labels
        FROM p
    """,
    "sharding_base": "SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, true AS together, true AS gapless FROM documents",
    "suffixes_base": rf"""
        WITH d AS (SELECT DISTINCT doc_id, text, {WORDS} AS w FROM documents),
        g AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM d)),
        f AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(DISTINCT doc_id) > 1)),
        n AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + 50 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM (SELECT DISTINCT doc_id, i FROM f) WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        k AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM n),
        s AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, k)
        SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS dup_words, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM s GROUP BY doc_id
    """,
    "secrets_base": rf"""
        SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '{ASSIGN}', 2), lambda x: length(x) >= 12)) AS BIGINT) AS n_assign,
            CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS BIGINT) AS n_access, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) AS BIGINT) AS n_hex
        FROM documents
    """,
    "mixing_base": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
        s AS (SELECT source, sum(size)::DOUBLE AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
        f AS (
            SELECT 0 AS turn, CAST([] AS VARCHAR[]) AS full_, (SELECT sum(source_size) / sum(weight) FROM s) AS level
            UNION ALL
            SELECT turn + 1, over_, CASE WHEN w = 0 THEN level ELSE (SELECT sum(source_size) FROM s) / w - taken / w END FROM (
                SELECT f.turn, f.full_, f.level, list(coalesce(source, chr(0))) FILTER (level * weight > 3 * source_size) AS over_, coalesce(sum(weight) FILTER (NOT level * weight > 3 * source_size), 0) AS w,
                    coalesce(sum(3 * source_size) FILTER (level * weight > 3 * source_size), 0) AS taken
                FROM f, s GROUP BY f.turn, f.full_, f.level)
            WHERE len(over_) > len(full_)),
        x AS (SELECT level FROM f ORDER BY turn DESC LIMIT 1)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, round(least(3 * source_size, level * weight), 3) AS target, true AS within, true AS near
        FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source, x
    """,
    "subwords_base": """
        SELECT doc_id, xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
            lambda crc, x: list_reduce(list_prepend(xor(crc, x), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), CAST(4294967295 AS BIGINT))) % 5 = 0 AS held_out,
            true AS bounded, true AS cut_kept
        FROM documents
    """,
    "op12_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
        t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)),
        f AS (SELECT lang, k, w[i:i + k - 1] AS w, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
        o AS (SELECT lang, w, max(a) AS longer FROM (SELECT lang, w[1:2] AS w, a FROM f WHERE k = 3 UNION ALL SELECT lang, w[2:3], a FROM f WHERE k = 3) GROUP BY lang, w),
        c AS (SELECT f.lang, f.w, f.k, f.a FROM f LEFT JOIN o USING (lang, w) WHERE f.k > 1 AND (longer IS NULL OR 100 * longer < 50 * a)),
        s AS (
            SELECT c.lang, c.w, c.a, x.a AS l, y.a AS r, cut, CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
            FROM c JOIN (SELECT unnest([1, 2]) AS cut) ON cut < c.k JOIN f x ON x.lang = c.lang AND x.w = c.w[1:cut] JOIN f y ON y.lang = c.lang AND y.w = c.w[cut + 1:c.k]),
        b AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b JOIN t USING (lang) QUALIFY rank <= 2000
    """,
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
    """,
}
