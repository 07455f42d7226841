"""One query per operator, with production parameters over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import decontam, divergence, infill, langid, lines, oracle, packing, placement, secretscan, simhash, suffixes, tokens, units, vectors

# The public vocabularies for packing and for counts, the shortest run of lines deleted,
# the number of shards.
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
MIN_LINES = 1
SHARDS = 16


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY))


def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.dedup_lines(docs, min_lines=MIN_LINES, found="r", copies=True)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "r.n_lines", "r.n_deleted", "r.n_runs", "r.longest_run", kept.alias("kept_sha256"))


def op3_token_counts(spark, sf_dir):
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), public_tokenizers.PATTERN)


def op4_simhash(spark, sf_dir):
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op5_repeated_bytes(spark, sf_dir):
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), depth=400, with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, out="r")
    return found.select(
        "doc_id",
        "r.n_words",
        "r.n_hit",
        F.size("r.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("r.items", ","), 256).alias("items_sha256"),
        (F.col("r.n_hit") > 0).alias("contaminated"),
    )


def op7_secret_scan(spark, sf_dir):
    found = secretscan.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secretscan.as_text(F.col("base")), 256).alias("base_sha256"),
        secretscan.as_text(F.col("spans")).alias("spans"),
    )


def op8_embedding_near_dedup(spark, sf_dir):
    return vectors.embedding_components(table(spark, sf_dir, "embeddings"), least=0.9)


def op9_substring_dedup(spark, sf_dir):
    found = units.dedup_units(table(spark, sf_dir, "documents"), whole_lines=True)
    return found.select("doc_id", "n_chars", "n_removed", "n_spans", "kept_sha256")


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~out))
    return docs.select("doc_id", out.alias("held_out"), langid.predict_column(model, F.col("text")).alias("r")).select(
        "doc_id", "held_out", F.col("r.lang").alias("lang_pred"), "r.score", "r.rejected"
    )


def op11_sharding(spark, sf_dir):
    tree = placement.even_tree(SHARDS, regions=4, racks=2)
    found = placement.place(table(spark, sf_dir, "documents"), tree, grown=tree.grown())
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op12_fill_in_middle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = infill.infill(docs, out="r").select("doc_id", "r.*")
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored_column(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_divergence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.audit(docs, least_docs=3, ranks=200)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_line_dedup,
        op3_token_counts,
        op4_simhash,
        op5_repeated_bytes,
        op6_decontamination,
        op7_secret_scan,
        op8_embedding_near_dedup,
        op9_substring_dedup,
        op10_language_id,
        op11_sharding,
        op12_fill_in_middle,
        op13_divergence,
    )
}

# Line dedup: a non-blank line that occurs at an earlier place goes; neighbours that go are one run
# if the pair of them occurs at an earlier place.
ORACLE_SQL = {
    "op2_line_dedup": """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM d),
li AS (SELECT doc_id, text, x, line, row_number() OVER (PARTITION BY doc_id, text ORDER BY line) AS seq FROM raw WHERE trim(x, ' ') <> ''),
w AS (SELECT *, lead(x) OVER (PARTITION BY doc_id, text ORDER BY seq) AS y FROM li),
rep AS (
  SELECT *, row_number() OVER (PARTITION BY x ORDER BY doc_id NULLS FIRST, seq) > 1 AS later,
    y IS NOT NULL AND row_number() OVER (PARTITION BY x, y ORDER BY doc_id NULLS FIRST, seq) > 1 AS pair_later
  FROM w),
link AS (SELECT *, coalesce(lag(pair_later) OVER (PARTITION BY doc_id, text ORDER BY seq), false) AS linked FROM rep),
gone AS (
  SELECT doc_id, text, line, seq, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, text ORDER BY seq) AS run
  FROM link WHERE later),
runs AS (SELECT doc_id, text, run, count(*) AS n FROM gone GROUP BY ALL),
per AS (SELECT doc_id, text, sum(n)::BIGINT AS n_deleted, count(*) AS n_runs, max(n) AS longest_run FROM runs GROUP BY ALL),
kept AS (
  SELECT raw.doc_id, raw.text, string_agg(raw.x, chr(10) ORDER BY raw.line) AS t
  FROM raw LEFT JOIN gone g ON raw.doc_id = g.doc_id AND raw.text = g.text AND raw.line = g.line WHERE g.line IS NULL GROUP BY ALL)
SELECT o.doc_id, coalesce(len(string_split(o.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(p.n_deleted, 0) AS n_deleted,
  coalesce(p.n_runs, 0) AS n_runs, coalesce(p.longest_run, 0) AS longest_run, sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents o LEFT JOIN per p ON o.doc_id = p.doc_id AND o.text = p.text LEFT JOIN kept k ON o.doc_id = k.doc_id AND o.text = k.text
""",
    **oracle.ORACLE_SQL,
}
