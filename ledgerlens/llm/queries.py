"""The registered queries of the training-data operators, with SQL answers where SQL can give them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    chat,
    hamming_index,
    hard_negatives,
    html_text,
    language_id,
    mixing,
    near_dup,
    phrases,
    pieces,
    repeated_spans,
    simhash,
    token_files,
    top_products,
)
from ledgerlens.llm.share import share_package

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer file; the package that holds them is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


#: Wanted shares of a training mix; only toxic documents may fall below their present tokens.
TARGETS = {"good": 0.83, "plain": 0.165, "toxic": 0.005}
FLOORS = ["good", "plain"]


def domains_of(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled table."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")
    return labels.select("doc_id", domain.alias("domain"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = domains_of(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), labels, TARGETS, FLOORS)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary_path("piece_bpe_32k.model")
    coded = pieces.decode_pieces(pieces.encode_pieces(table(spark, sf_dir, "documents"), model), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_files.token_store(docs, vocabulary_path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_checksums(spark, store)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language_id.held_out())
    model = language_id.train(docs.where(~F.col("held_out")), vocabulary_path("piece_bpe_32k.model"))
    return language_id.identify(docs, model, keep=["held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, t AS turn, r AS role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    done = chat.format_conversations(rows.unionByName(extra))
    read = done.select("conv_id", "valid", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_duplicates(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0, label)


QUERIES: dict[str, Query] = {
    "op1_html_text": op1_html_text,
    "op2_mixing": op2_mixing,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_files": op5_token_files,
    "op6_language": op6_language,
    "op7_top_products": op7_top_products,
    "op8_nearest": op8_nearest,
    "op9_repeated_spans": op9_repeated_spans,
    "op10_chat": op10_chat,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_hard_negatives": op13_hard_negatives,
}

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, p.n, q.n
    HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))
),
reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM documents
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id, d.doc_id = min(r.seen) AS kept
FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

REPEATED_SPANS_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
),
lows AS (SELECT s, min(doc_id) AS low FROM starts GROUP BY s),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM starts JOIN lows USING (s) WHERE low < doc_id
),
listed AS (
    SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
),
kept AS (
    SELECT l.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY l.i) AS t
    FROM listed l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE g.i IS NULL GROUP BY l.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
placed AS (
    SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before, lead(role) OVER w AS after
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
sized AS (
    SELECT *, len('<|im_start|>') + len(role) + 1 + len('<|im_end|>') + 1 + len(text)
        + len(text) - len(replace(text, '\', ''))
        + list_sum([(len(text) - len(replace(text, m, ''))) // len(m) FOR m IN
            ['<|im_start|>', '<|im_end|>', '<|endoftext|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>']]) AS size,
        CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before IN ('system', 'assistant') THEN role = 'user'
             WHEN before = 'user' THEN role = 'assistant' ELSE false END
        AND (after IS NOT NULL OR role = 'assistant') AS fits
    FROM placed
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, bool_and(fits) AS valid
FROM sized GROUP BY conv_id
"""

TOP_PRODUCTS_SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 10
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
    FROM documents
),
words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(p) AS piece FROM pieces)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)
),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY lang, size, phrase HAVING count(*) >= 30),
listed AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
inside AS (
    SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(f) AS most
    FROM (SELECT lang, w, f, part, unnest(range(1, size - part + 2)) AS i FROM listed, (SELECT unnest([2, 3]) AS part) WHERE part < size)
    GROUP BY ALL
),
cuts AS (
    SELECT c.lang, c.phrase, c.f, k, array_to_string(c.w[1:k], ' ') AS p, array_to_string(c.w[k + 1:], ' ') AS q
    FROM (SELECT *, unnest(range(1, size)) AS k FROM listed) c LEFT JOIN inside o ON o.lang = c.lang AND o.phrase = c.phrase
    WHERE coalesce(100 * o.most < 80 * c.f, true)
),
scores AS (
    SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.p JOIN counts y ON y.lang = c.lang AND y.phrase = c.q
),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN totals USING (lang) QUALIFY rank <= 2000
"""

HARD_NEGATIVES_SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
        (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
    "op7_top_products": TOP_PRODUCTS_SQL,
    "op10_chat": CHAT_SQL,
    "op9_repeated_spans": REPEATED_SPANS_SQL,
    "op4_near_duplicates": NEAR_DUPLICATES_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
