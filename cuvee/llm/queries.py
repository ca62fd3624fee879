"""One registered query per operator, over its whole table, with production parameters; and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from cuvee.llm import (
    chat,
    decontaminate,
    hard_negatives,
    license_scan,
    near_dups,
    packing,
    pseudo_likelihood,
    secret_scan,
    spelling,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """The fifth of the documents whose labels train nothing."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    return toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))


def tokenizer_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = license_scan.scan(docs, license_scan.train(spark, docs))
    return found.withColumnRenamed("key", "doc_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), near_dups.Settings(shingle_words=2))


def secret_findings(spark: SparkSession, docs: DataFrame) -> DataFrame:
    settings = secret_scan.Settings()
    words = secret_scan.dictionary(docs, settings.dictionary)
    return secret_scan.find(docs, secret_scan.train(spark, words, settings), words, settings)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of all documents; the value itself only as a digest."""
    found = secret_findings(spark, table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "nth", "start", "length", "probability", F.sha2("value", 256).alias("value_sha256")
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts: the table has a row per turn, conversation -7 comes as one record with a list of messages."""
    tricky = F.lit("\\### Assistant: </turn> ok")
    said = [F.struct(F.lit(role).alias("role"), tricky.alias("content")) for role in ("user", "assistant")]
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(*said).alias("messages"))
    turns = chat.turns_of_frame(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    formatted = chat.format_turns(turns.unionByName(chat.turns_of_frame(extra)))
    back = chat.read_back(formatted)
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is counted, then edited in three places that follow from its own row, and counted on."""
    n, source = F.length("text"), F.coalesce("source", F.lit(""))

    def edit(start: Column, deleted: int, inserted: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), F.lit(deleted).cast("long").alias("deleted"), inserted.alias("inserted"))

    edits = F.array(
        edit(F.floor(n / 2), 3, source),
        edit(F.lit(0), 0, F.concat(F.coalesce("lang", F.lit("")), F.lit(": "))),
        edit(F.floor(n / 3), 40, F.lit("")),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    return token_counts.count_with_edits(docs, tokenizer_file()).withColumnRenamed("key", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_model(spark, sf_dir, docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.train(docs)).withColumnRenamed("key", "doc_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is mislabelled before anchors, positives and negatives are told apart."""
    shifted = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label"))
    return hard_negatives.mine(rows, F.pmod("vec_id", F.lit(100)) == 0)


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), spelling.Settings(damage=199))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_best_fit_packing, op3_minhash_near_dedup, op4_secret_scan, op5_chat_formatting,
        op6_decontamination, op7_token_counts, op8_toxicity, op9_exact_top_k, op10_lm_scoring,
        op11_hard_negatives, op12_suffix_array_dedup, op13_spelling_variants,
    )
}

_SHINGLES = """
words AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)),
            lambda i: w[i] || ' ' || w[i + 1])) WHEN len(w) = 1 THEN w ELSE [] END AS s FROM words)"""

ORACLE: dict[str, str] = {
    "op3_minhash_near_dedup": f"""
WITH RECURSIVE {_SHINGLES},
sizes AS (SELECT doc_id, len(coalesce(s, [])) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
          GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * m >= 80 * (p.n + q.n - m)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b)
SELECT doc_id, n AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sizes JOIN reach ON a = doc_id GROUP BY doc_id, n""",
    "op6_decontamination": """
WITH doc AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents),
item AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM
              (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
places AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS x FROM
             (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, x)),
spans AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN spans USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op5_chat_formatting": """
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
lengths AS (SELECT *, len(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + len(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
                   + len('<|start|><|text|><|end|>') + 1 AS n FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM lengths GROUP BY conv_id""",
    "op9_exact_top_k": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r, q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score
           FROM v q JOIN v x ON q.r <> x.r AND len(q.e) = len(x.e) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_hard_negatives": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.r AS a, x.r AS x, a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
                  CAST(list_inner_product(a.e, x.e) AS BIGINT) AS score
           FROM v a JOIN v x ON a.r <> x.r AND len(a.e) = len(x.e) WHERE a.vec_id % 100 = 0),
positives AS (SELECT a, x AS p, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY a, p ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM scored JOIN positives USING (a) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY a, p ORDER BY score DESC, vec_id) <= 10""",
    "op12_suffix_array_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT r, doc_id, p, substr(x, 2 * p + 1, 100) AS w
            FROM (SELECT r, doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS p FROM d WHERE doc_id IS NOT NULL)),
first AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > 50, true) AS opens
         FROM windows JOIN first USING (w) WHERE least < doc_id),
islands AS (SELECT r, p, sum(CAST(opens AS INT)) OVER (PARTITION BY r ORDER BY p) AS island FROM hits),
spans AS (SELECT r, min(p) AS a, max(p) + 50 AS z FROM islands GROUP BY r, island),
pieces AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
told AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
                string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN told USING (r)""",
    "op13_spelling_variants": """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
told AS (SELECT doc_id, run, count(*) AS m, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS said FROM runs GROUP BY doc_id, run),
bits AS (SELECT run, m, list_transform(range(0, 4 * len(hex(encode(said)))), lambda i:
           (CAST(instr('0123456789ABCDEF', substr(hex(encode(said)), 1 + 2 * (i // 8) + (CASE WHEN i % 8 < 4 THEN 1 ELSE 0 END), 1)) AS BIGINT)
            - 1) >> (i % 4) & 1) AS b FROM told),
hashed AS (SELECT run, m, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x:
             xor(c >> 1, 3988292384 * (xor(c, x) & 1)))) AS h FROM bits),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word,
                 CAST(sum(m) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING len(word) >= 6 AND sum(m) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT *, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.d = b.word
         UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.d = b.word),
ranked AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS c,
                  row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS r FROM near),
formed AS (SELECT words.word, n, coalesce(c, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form,
                  CASE WHEN m >= 5 * n THEN m END AS form_n FROM words LEFT JOIN ranked ON ranked.word = words.word AND r = 1),
led AS (SELECT word, word AS root, form AS next FROM formed
        UNION ALL SELECT led.word, formed.word, formed.form FROM led JOIN formed ON formed.word = led.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM led WHERE next IS NULL) USING (word)""",
}
