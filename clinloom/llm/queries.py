"""The registered queries of the corpus operators, with their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from clinloom.llm import chat, decontaminate, hard_negatives, language, lm_score, packing, pii, repeats, simhash, spelling, token_count, token_ids, topk
from clinloom.llm.common import work_folder
from clinloom.workload.registry import query


@query("op1_topk", """
    WITH v AS (
        SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS c
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
        FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
""")
def _top_k(t):
    vectors = t.embeddings
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op2_chat_formatting", r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), t AS (
        SELECT *, role = 'assistant' AS target,
            row_number() OVER o AS place, count(*) OVER (PARTITION BY conv_id) AS n,
            sum(14 + length(role) + length(text)
                + 2 * length(role) + 2 * length(text)
                - length(replace(replace(role, '\', ''), '<', '')) - length(replace(role, '>', ''))
                - length(replace(replace(text, '\', ''), '<', '')) - length(replace(text, '>', ''))
            ) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                    ROWS UNBOUNDED PRECEDING) AS chars
        FROM rows
        WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (target), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (target), '')) AS loss_sha256,
        CAST(sum(chars) FILTER (target OR place = n) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
""")
def _chat(t):
    control = r"\### Assistant: </turn> ok"
    probe = t.spark.createDataFrame(
        [(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    turns = t.conversations.select("conv_id", "turn", "role", "text").union(probe)
    return chat.read_back(chat.conversations(turns))


@query("op3_suffix_dedup")
def _suffix_dedup(t):
    return repeats.without_repeats(t.documents.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        F.col("kept").cast("string").alias("text"),
    )


@query("op4_decontamination")
def _decontamination(t):
    found = decontaminate.contamination(t.documents.select("doc_id", "text"), t.benchmark, ["doc_id"], "found")
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "found.n_words", hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query("op5_lm_score")
def _lm_score(t):
    documents = t.documents.select("doc_id", "text")
    wanted = t.labels.where("quality = 1 and toxic = 0").select("doc_id")
    return lm_score.scored(documents, documents.join(wanted, "doc_id", "left_semi"), documents, ["doc_id"], lm_score.words, order=3)


@query("op6_language_id")
def _language_id(t):
    documents = t.documents.select("doc_id", "text", "lang")
    model = language.learn(language.training_rows(documents))
    return language.identified(documents, model, ["doc_id"], "found").select(
        "doc_id",
        F.expr("coalesce(pmod(crc32(cast(doc_id as string)), 4) = 2, false)").alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        "found.score",
    )


@query("op7_simhash")
def _simhash(t):
    found = simhash.near_duplicates(t.documents)
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_pii")
def _pii(t):
    return pii.replaced(t.documents.select("doc_id", "text"), key="clinloom", count="n_entities")


@query("op9_packing")
def _packing(t):
    encoder = packing.byte_bpe(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return packing.pack(t.documents, encoder).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op10_token_count")
def _token_count(t):
    return token_count.token_counts(t.documents, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query("op11_spelling_variants")
def _spelling_variants(t):
    return spelling.variants(spelling.words(t.documents))


@query("op12_token_ids")
def _token_ids(t):
    folder = work_folder(t.spark)
    token_ids.write(t.documents, folder, token_ids.encoder(public_tokenizers.path("word_bpe_49k.json"), end=1))
    return token_ids.read(t.spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query("op13_hard_negatives", """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS c
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
            CAST(list_dot_product(a.c, v.c) AS BIGINT) AS score
        FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id
    ), p AS (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
    ), n AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
            s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS place
        FROM p JOIN s ON p.place <= 5 AND p.anchor_id = s.anchor_id AND NOT s.same
            AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
    )
    SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE place <= 10
""")
def _hard_negatives(t):
    rows = t.embeddings.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives.mined(rows, F.expr("vec_id % 100 = 0"), positives=5, negatives=10, window=(30, 90, 100))
