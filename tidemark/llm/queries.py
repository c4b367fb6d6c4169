"""The queries of this package, with their DuckDB twins where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_stream,
    chat_format,
    decontaminate,
    hard_negatives,
    near_dup,
    packing,
    secret_scan,
    spelling,
    substring_dedup,
    token_counts,
    topk_blocks,
    toxicity,
    url_filter,
)
from tidemark.session import scratch_path, split_skewed_joins

QUERIES = {}
ORACLES = {}


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        split_skewed_joins(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pack_binary(spark, sf_dir):
    pieces = packing.pack_binary(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, max_tokens=4096
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: The rules of the filter (fixed values).
URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


@query
def op5_url_filter(spark, sf_dir):
    model = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query
def op6_decontaminate(spark, sf_dir):
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return hits.select(
        "doc_id",
        "n_words",
        F.size("covered").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("covered") > 0).alias("contaminated"),
    )


WORDS_6 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"  # noqa: E501
ORACLES["op6_decontaminate"] = rf"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS k
    FROM (SELECT item_id, {WORDS_6} AS w FROM benchmark) WHERE len(w) > 0
), gram AS (
    SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM item)
), doc AS (
    SELECT doc_id, {WORDS_6} AS w FROM documents
), size AS (SELECT DISTINCT k FROM gram),
probe AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, size)
), hit AS (
    SELECT doc_id, k, i, item FROM probe JOIN gram USING (k, gram)
), word AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), held AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN held USING (doc_id)
"""


@query
def op8_secret_scan(spark, sf_dir):
    scanned = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.ADDED)

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        scratch_path(spark, "token-counts"),
        limit=4096,
    )


#: Control strings as text of the conversation added to the table (fixed values).
CONTROL_CONVERSATION = [
    (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
    (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
]


@query
def op10_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(CONTROL_CONVERSATION, turns.schema))
    made = chat_format.format_conversations(turns)
    read = made.withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn(
        "trained", F.array_join(chat_format.read_loss(F.col("formatted"), F.col("loss")), "")
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op10_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
    SELECT *, role IS NOT DISTINCT FROM lag(role) OVER w AS goes_on, row_number() OVER w AS n,
           replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
           replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\/') AS name
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE WHEN n > 1 AND goes_on THEN length('<|im_next|>')
                ELSE length('<|im_start|>') + length(name) + 1 + length('<|im_end|>') + 1 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query
def op7_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=5, percent=85).drop("content")


@query
def op4_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), size=13, block=7)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op4_substring_dedup"] = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc)
), owner AS (
    SELECT win, min(doc_id) AS least FROM win GROUP BY win
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
    FROM win JOIN owner USING (win) WHERE least < doc_id
), word AS (
    SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
    FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


@query
def op3_topk_blocks(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_blocks.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op3_topk_blocks"] = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, table(spark, sf_dir, "labels"), threshold=0.7)
    return scored.select("doc_id", "held_out", "score", "predicted")


ORACLES["op7_near_duplicates"] = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM (SELECT doc_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
          FROM doc WHERE len(w) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
    WHERE 100 * k >= 85 * (p.n + q.n - k)
), near AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM doc UNION SELECT reach.a, near.y FROM reach JOIN near ON reach.b = near.x
), least_of AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN least_of USING (doc_id)
"""


@query
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100, label=label
    )


ORACLES["op11_hard_negatives"] = r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op12_bpe_stream(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = bpe_stream.decode(bpe_stream.encode(docs, path), path)
    return read.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(
        table(spark, sf_dir, "documents"), least_length=5, least_count=3, ratio=2, noise=97
    )


# The checksum byte by byte from its polynomial; words are near if a pattern with one place left open, or
# one deletion, makes them the same.
ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE remainders AS (
    SELECT list(r ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)),
            lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r
        FROM (SELECT unnest(range(256)) AS b))
), run AS (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL
), coded AS (
    SELECT r, n, hex(encode(doc_id || ':' || r)) AS h FROM run
), drawn AS (
    SELECT r, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
               lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
               lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS crc
    FROM coded, remainders
), word AS (
    SELECT CASE WHEN crc % 97 = 0 THEN substr(r, 1, crc % length(r)) || substr(r, crc % length(r) + 2) ELSE r END AS word,
           CAST(sum(n) AS BIGINT) AS n
    FROM drawn GROUP BY 1 HAVING sum(n) >= 3
), kept AS (
    SELECT word, n FROM word WHERE length(word) >= 5
), cut AS (
    SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM kept)
), pair AS (
    SELECT x.word AS u, y.word AS v FROM cut x JOIN cut y USING (i, a, b) WHERE x.word < y.word
    UNION SELECT d.word, c FROM (SELECT DISTINCT word, a || b AS c FROM cut) d JOIN kept k ON k.word = c
), link AS (
    SELECT u AS word, v AS near FROM pair UNION ALL SELECT v, u FROM pair
), best AS (
    SELECT l.word, count(*) AS n_near, arg_min(l.near, (-k.n, l.near)) AS form, max(k.n) AS top
    FROM link l JOIN kept k ON k.word = l.near GROUP BY l.word
), found AS (
    SELECT k.word, k.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * k.n THEN form END AS form,
           CASE WHEN top >= 2 * k.n THEN top END AS form_n
    FROM kept k LEFT JOIN best USING (word)
), walk(word, root) AS (
    SELECT word, word FROM found UNION ALL
    SELECT walk.word, f.form FROM walk JOIN found f ON f.word = walk.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM walk JOIN found USING (word)
WHERE root IN (SELECT word FROM found WHERE form IS NULL)
"""
