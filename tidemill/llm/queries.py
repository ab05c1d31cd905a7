"""The registered queries of this folder, thin over its operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, chat, langid, media, mixing, neardup, negatives, pages, secrets, spots, tokencount, toxicity, trie
from tidemill.llm.common import held_out, scratch, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public tokenizer file lies on this machine and, by the same installation, on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    texts = F.lit(r"\### Assistant: </turn> ok")
    kinds = {f.name: f.dataType for f in turns.schema.fields}
    extra = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), texts.alias("text")
    )
    formatted = chat.format_rows(turns.select("conv_id", "turn", "role", "text").unionByName(extra))
    read = formatted.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "media")
    index = media.media_index(table(spark, sf_dir, "documents"), root)
    rows = media.with_features(media.with_metadata(media.dealt(index), root), root)
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bits")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.round("rate", 6).alias("rate"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return spots.compare(documents, spots.parts_of(documents))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return pages.extract(rows, pages.learn(rows))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path(), ids=False, keep=True)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(documents.select("doc_id", "text"), langid.learn(documents))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"), trie.shared_heads)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *map(count, secrets.BASE), F.sha2(secrets.told(F.col("base")), 256).alias("base_sha256"), secrets.told(F.col("spans")).alias("spans"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_toxicity, op3_media_columns, op4_source_mix, op5_token_counts, op6_spot_signatures, op7_near_duplicates, op8_main_text, op9_bpe_codec, op10_language_id,
        op11_prefix_trie, op12_hard_negatives, op13_secret_scan,
    )
}


def _matches_sql(kind: str) -> str:
    """Places of one pattern's matches in DuckDB: what the pieces between them and they themselves come to."""
    pattern = secrets.PATTERNS[kind].replace("'", "''")
    kept = {
        "assign": f"length(regexp_extract(m, '{pattern}', 2)) >= 8",
        "access": "length(m) >= 16",
        "hex": "true",
        "key": "length(m) = 40 AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')",
        "login": f"length(regexp_extract(m, '{pattern}', 2)) >= 3",
        "endpoint": "true",
    }[kind]
    return f"""SELECT row, {secrets.KINDS.index(kind)} AS k, '{kind}' AS kind, stop - length(m) AS start, stop FROM (
        SELECT row, m, sum(length(g) + length(m)) OVER (PARTITION BY row ORDER BY i) AS stop FROM (
            SELECT row, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i
            FROM (SELECT row, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d))) WHERE {kept}"""

ORACLE_SQL = {
    "op1_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), g AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
                   sum(4 + length(replace(replace(replace(role, '\', '\b'), '#', '\h'), ':', '\c')) + 2
                       + length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '</turn>', '\l/turn>')) + 8) AS formatted_chars
            FROM t GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM g""",
    "op11_prefix_trie": r"""
        WITH t AS (SELECT conv_id AS c, coalesce(role, '') || chr(0) || coalesce(text, '') AS turn, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n FROM conversations WHERE conv_id IS NOT NULL),
        h AS (SELECT c, c - c % 5 AS src, count(*) AS n FROM t GROUP BY c),
        -- crc32 bit by bit, over the bytes of the decimal id
        bits AS (SELECT c, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
            lambda s, x: list_reduce(list_concat([xor(s, x)], range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) AS r FROM h),
        heads AS (SELECT h.*, xor(r, 4294967295::BIGINT) % 9 AS take FROM h JOIN bits USING (c)),
        built AS (SELECT heads.c, t.turn, t.size, t.n FROM heads JOIN t ON t.c = heads.src AND t.n <= take
                  UNION ALL SELECT heads.c, t.turn, t.size, 100 + t.n FROM heads JOIN t ON t.c = heads.c AND t.n > take),
        path AS (SELECT c, size, row_number() OVER w AS depth, string_agg(sha256(turn), '') OVER w AS p FROM built WINDOW w AS (PARTITION BY c ORDER BY n)),
        member AS (SELECT c, 0 AS size, 0 AS depth, '' AS p FROM h UNION ALL SELECT * FROM path),
        whole AS (SELECT c, max(depth) AS last FROM member GROUP BY c),
        node AS (SELECT p, depth, any_value(size) AS size, count(*) AS n_convs, min(c) AS conv_id, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE depth = last), '')) AS ends_sha256
                 FROM member JOIN whole USING (c) GROUP BY p, depth),
        kids AS (SELECT left(p, length(p) - 64) AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
        told AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (p))
        SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, any_value(up.conv_id) AS parent_conv_id, n.n_convs, n.n_children, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves,
               CAST(sum((m.n_convs - 1) * m.size) AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM told n JOIN told m ON starts_with(m.p, n.p) LEFT JOIN told up ON n.depth > 0 AND up.p = left(n.p, length(n.p) - 64)
        GROUP BY n.p, n.conv_id, n.depth, n.n_convs, n.n_children, n.ends_sha256""",
    "op12_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10""",
    "op13_secret_scan": f"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents), m AS ({" UNION ALL ".join(_matches_sql(k) for k in secrets.KINDS)}),
        near AS (SELECT w.row, w.k, w.start, w.stop, bool_or(p.k < 3 AND p.start < w.stop AND p.stop > w.start) AS clash,
                        bool_or(p.kind IN ('access', 'login') AND (p.stop <= w.start OR p.start >= w.stop)) AS who, bool_or(p.kind IN ('assign', 'hex', 'key') AND (p.stop <= w.start OR p.start >= w.stop)) AS what,
                        bool_or(p.kind = 'endpoint' AND (p.stop <= w.start OR p.start >= w.stop)) AS place
                 FROM m w JOIN m p ON w.row = p.row AND p.start < w.stop + {secrets.SCOPE} AND p.stop > w.start - {secrets.SCOPE} WHERE w.k >= 3 GROUP BY ALL),
        links AS (SELECT row, k, start, stop FROM near WHERE NOT clash AND CASE k WHEN 3 THEN who WHEN 4 THEN what AND place ELSE who AND what END),
        kept AS (SELECT m.* FROM m LEFT JOIN links USING (row, k, start, stop) WHERE m.k < 3 OR links.row IS NOT NULL)
        SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
               sha256(coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, k) FILTER (WHERE k < 3), '')) AS base_sha256,
               coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, k), '') AS spans
        FROM d LEFT JOIN kept USING (row) GROUP BY row, doc_id""",
}
