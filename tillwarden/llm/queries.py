"""The corpus operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwarden.llm import block_search, byte_merges, cell_clusters, licence_rules, merge_dropout, near_duplicates, pseudonyms, quality_rules, repeated_passages, templates, token_alignment, token_records, toxicity
from tillwarden.llm.shared import table, tokenizer_file, word_pattern
from tillwarden.session import work_dir


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, written as records, indexed and read back."""
    folder = work_dir(spark, "token-records")
    token_records.write_records(
        table(spark, sf_dir, "documents"), f"{folder}/records", tokenizer_file("word_bpe_49k.json")
    )
    token_records.write_index(spark, f"{folder}/records", f"{folder}/index")
    return token_records.read_index(spark, f"{folder}/index").select("doc_id", "start", "n_tokens", "ids_crc32")


KEEP_FROM = 0.3  # least quality score of a text that is kept

# A fixed key keeps the results of a trial comparable; a real run passes its own secret.
TRIAL_KEY = "trial-key-of-the-registered-queries"


def op2_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut into pieces with merge-dropout of a tenth, and whether it decodes to itself."""
    model = tokenizer_file("piece_bpe_32k.model")
    return merge_dropout.encoded(table(spark, sf_dir, "documents"), model, dropout=0.1, seed=1)


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced, and the kinds of the values replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, TRIAL_KEY)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every text, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    learn = ~quality_rules.held_out(F.col("label_id"))
    words, toxic, weights = toxicity.sample_rows(docs, table(spark, sf_dir, "labels"), "toxic", learn)
    model = toxicity.fit_ordinal(words, toxicity.graded(words, toxic > 0), weights)
    return toxicity.scored(docs, model).withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))


def op5_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return block_search.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=10)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"), "quality")
    scored = quality_rules.scored(docs, model)
    predicted = (F.col("score") >= KEEP_FROM).cast("int")
    return scored.select(
        "doc_id", quality_rules.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted")
    )


def op7_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences of every text, and the licences they make up."""
    return licence_rules.licences(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, on shingles of four words."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without windows of 20 words that start earlier somewhere."""
    docs = table(spark, sf_dir, "documents")
    parsed = repeated_passages.repeated_passages(docs, window=20, keep_text=False)
    return parsed.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or re-parameterised."""
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_recursive_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by its ranks and decoded again."""
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return byte_merges.digests(byte_merges.encoded(table(spark, sf_dir, "documents"), ranks, word_pattern(), decode=True))


def op12_cell_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds."""
    return cell_clusters.clustered(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned over every text, and how common their links are."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment.aligned(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_merge_dropout": op2_merge_dropout,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_toxicity": op4_toxicity,
    "op5_block_search": op5_block_search,
    "op6_quality_rules": op6_quality_rules,
    "op7_licence_rules": op7_licence_rules,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_templates": op10_templates,
    "op11_recursive_merges": op11_recursive_merges,
    "op12_cell_clusters": op12_cell_clusters,
    "op13_token_alignment": op13_token_alignment,
}


def _cluster_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds one after the other, a pair of tables for each."""
    parts = [
        """
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS n, vec_id,
                   list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        )""",
        f"""
        c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS c, v
            FROM kept QUALIFY c < {k}
        )""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""
        a{r} AS MATERIALIZED (
            SELECT n, vec_id, kept.v AS v, c, list_sum(list_transform(
                list_zip(kept.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM kept CROSS JOIN c{r}
            QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1
        )""")
        if r < rounds:
            parts.append(f"""
        m{r} AS (
            SELECT c, list(CAST(floor(CAST(s AS DOUBLE) / m) AS BIGINT) ORDER BY i) AS v FROM (
                SELECT c, i, sum(x) AS s, count(*) AS m
                FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i
            ) GROUP BY c
        ),
        c{r + 1} AS MATERIALIZED (
            SELECT old.c, coalesce(new.v, old.v) AS v FROM c{r} old LEFT JOIN m{r} new ON new.c = old.c
        )""")
    return f"""
        WITH {",".join(parts)}
        SELECT a.vec_id, a.c AS cluster, CAST(a.d AS BIGINT) AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(z.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} z ON z.c = a.c
    """


ORACLES: dict[str, str] = {
    "op5_block_search": """
        WITH usable AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(
                list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b
            )) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
    """,
    "op8_near_duplicates": """
        WITH RECURSIVE read AS (
            SELECT doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'
            ), []) AS w FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 3), ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, least(len(w), 1)))) AS s FROM read)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 80 * (x.n + y.n - c)
        ),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
        ),
        least_one AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least_one c ON c.doc_id = d.doc_id
    """,
    "op9_repeated_passages": """
        WITH read AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
        ),
        windows AS (
            SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM read WHERE len(w) >= 20)
        ),
        repeats AS (
            SELECT doc_id, s FROM (
                SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS r FROM windows
            ) WHERE r > 1
        ),
        gone AS (SELECT DISTINCT doc_id, s + k AS p FROM repeats, generate_series(0, 19) t(k)),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM read),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT r.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM read r LEFT JOIN kept k ON k.doc_id = r.doc_id
    """,
    "op12_cell_clusters": _cluster_sql(),
}
