"""The registered queries of the operators, and DuckDB statements for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlens.llm import (
    conversation_repair,
    decontaminate,
    exact_dedup,
    language_id,
    masked_lm,
    mixing,
    packing,
    pii,
    secret_scan,
    sharding,
    simhash,
    spelling,
    warc,
)
from courierlens.llm.common import same, written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("print")).alias("fingerprint"), "component_id")


def op2_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size")), "mix-rows")
    mixed, names = mixing.plan(sized, size_col="size")
    return mixed.select(
        "doc_id",
        "size",
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col("size") * F.col(names["copies"])).alias("taken"),
    )


def span_columns(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[F.size(pii.of_kinds(spans, (k,))).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.joined(pii.of_kinds(spans, base)), 256).alias("base_sha256"),
        pii.joined(spans).alias("spans"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_columns(pii.find(table(spark, sf_dir, "documents")), pii.BASE)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_columns(secret_scan.find(table(spark, sf_dir, "documents")), secret_scan.BASE)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.array_join("item_ids", ","))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_best_fit_packing(
    spark: SparkSession, sf_dir: str, tokenizer: str | None = None
) -> DataFrame:
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), Path(path).read_text())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.report(conversation_repair.damaged(rows)).withColumnRenamed("conv_id", "found_id")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return rows.select("conv_id").distinct().join(found, same(F.col("conv_id"), F.col("found_id")), "left").select(
        "conv_id",
        *zero.values(),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.forms(spelling.vocabulary(table(spark, sf_dir, "documents"), each=199))


def queries() -> dict[str, Query]:
    found = (
        op1_simhash_near_dedup,
        op2_masked_lm,
        op3_exact_dedup,
        op4_source_mixing,
        op5_pii,
        op6_secret_scan,
        op7_language_id,
        op8_warc,
        op9_decontamination,
        op10_sharding,
        op11_best_fit_packing,
        op12_conversation_repair,
        op13_spelling_variants,
    )
    return {q.__name__: q for q in found}


ORACLE_SQL = {
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight
            FROM sized GROUP BY source
        ), steps AS (
            SELECT *,
                   (1.5::DOUBLE * sum(source_size) OVER ()
                    - coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE)
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM sources
            WINDOW before AS (ORDER BY 2e0 * source_size / weight, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), settled AS (
            SELECT level FROM steps WHERE 2 * source_size >= weight * level
            ORDER BY 2e0 * source_size / weight, source NULLS LAST LIMIT 1
        ), aims AS (
            SELECT source, source_size, least((2 * source_size)::DOUBLE, weight * (SELECT level FROM settled)) AS target
            FROM sources
        ), rates AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN least(target / source_size, 2e0) ELSE 0e0 END AS rate,
                   (('0x' || substr(md5('mix:' || doc_id), 1, 13))::UBIGINT)::DOUBLE / 4503599627370496e0 AS coin
            FROM sized JOIN aims ON sized.source IS NOT DISTINCT FROM aims.source
        )
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM rates
    """,
    # CRC-32 bit by bit, since DuckDB has no function for it
    "op7_language_id": r"""
        WITH numbered AS (
            SELECT row_number() OVER () AS row, doc_id, text, lang,
                   coalesce((4294967295 - list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(
                           string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), range(8)),
                           lambda x, bit: xor(x >> 1, (x & 1) * 3988292384)))) % 4 = 2, false) AS held_out
            FROM documents
        ), words AS (
            SELECT row, lang, held_out,
                   ' ' || unnest(regexp_extract_all(lower(text), '\p{L}+')) || ' ' AS word
            FROM numbered
        ), grams AS (
            SELECT row, lang, held_out, substr(word, i, n) AS gram
            FROM (
                SELECT row, lang, held_out, word, n, unnest(range(1, len(word) - n + 2)) AS i
                FROM words, (SELECT unnest([1, 2, 3]) AS n)
            )
        ), counts AS (
            SELECT row, lang, held_out, gram, count(*) AS n FROM grams WHERE gram <> ' ' GROUP BY ALL
        ), profiles AS (
            SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, gram) - 1 AS place
            FROM counts WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram
            QUALIFY place < 300
        ), tops AS (
            SELECT row, gram, row_number() OVER (PARTITION BY row ORDER BY n DESC, gram) - 1 AS place
            FROM counts QUALIFY place < 300
        ), away AS (
            SELECT t.row, l.lang, sum(abs(coalesce(p.place, 300) - t.place)) AS away, count(*) AS size
            FROM tops t CROSS JOIN (SELECT DISTINCT lang FROM profiles) l
            LEFT JOIN profiles p ON p.lang = l.lang AND p.gram = t.gram
            GROUP BY t.row, l.lang
        ), best AS (
            SELECT row, lang, 1 - away::DOUBLE / (size * 300) AS score
            FROM away QUALIFY row_number() OVER (PARTITION BY row ORDER BY away, lang) = 1
        )
        SELECT doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred, coalesce(score, 0) AS score
        FROM numbered LEFT JOIN best USING (row)
    """,
    "op8_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html FROM pages
        ), marked AS (
            SELECT page_id, strlen(html) AS size, sha1(html) AS digest,
                   max(page_id) OVER (PARTITION BY html) AS best
            FROM payloads
        )
        SELECT page_id,
               size::BIGINT AS payload_bytes,
               digest AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM marked
    """,
    "op9_decontamination": r"""
        WITH item_words AS (
            SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w
            FROM benchmark WHERE text IS NOT NULL
        ), items AS (
            SELECT w, min(item_id) AS item_id,
                   string_agg(item_id, ',' ORDER BY item_id) AS item_ids, least(len(w), 5) AS width
            FROM item_words WHERE len(w) > 0 GROUP BY w
        ), item_shingles AS (
            SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS shingle
            FROM (SELECT item_id, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM items)
        ), wanted AS (
            SELECT item_id, count(*) AS shingles FROM item_shingles GROUP BY item_id
        ), doc_words AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w
            FROM documents WHERE text IS NOT NULL
        ), doc_shingles AS (
            SELECT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS shingle
            FROM (
                SELECT doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS i
                FROM doc_words, (SELECT DISTINCT width FROM items) WHERE len(w) >= width
            )
        ), found AS (
            SELECT doc_id, item_id, count(DISTINCT shingle) AS shared
            FROM doc_shingles JOIN item_shingles USING (width, shingle) GROUP BY doc_id, item_id
        )
        SELECT doc_id, item_id, item_ids, shingles, shared, shared / shingles::DOUBLE AS containment
        FROM found JOIN wanted USING (item_id) JOIN items USING (item_id)
        WHERE 5 * shared >= 4 * shingles
    """,
    # states: 0 nothing yet, 1 after s, 2 after u, 3 after a; a row of the recursion is the
    # least (cost, audit) that brings a conversation's first rows to a state
    "op12_conversation_repair": r"""
        WITH RECURSIVE hashed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   (4294967295 - list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(
                           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                           lambda c: ascii(c)::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), range(8)),
                           lambda x, bit: xor(x >> 1, (x & 1) * 3988292384)))) % 20 AS damage
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn,
                   CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM hashed
        ), placed AS (
            SELECT conv_id, turn, role, text, left(role, 1) AS initial,
                   row_number() OVER whole AS place,
                   lag(left(role, 1)) OVER whole AS before
            FROM damaged
            WINDOW whole AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), marked AS (
            SELECT *,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
                        ELSE 'none' END AS fault
            FROM placed
        ), moves AS (
            SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) t(p, initial, q)
        ), inserts AS (
            SELECT * FROM (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'),
                (1, 2, 5, 'I'), (3, 2, 5, 'I'), (2, 3, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')) t(p, q, cost, edits)
        ), edits AS (
            SELECT conv_id, place, p, p AS q, 2 AS cost, 'D' AS edit FROM marked, range(4) s(p)
            UNION ALL
            SELECT conv_id, place, p, q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K'
            FROM marked JOIN moves USING (initial) WHERE fault IN ('none', 'truncated')
            UNION ALL
            SELECT conv_id, place, p, q, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R'
            FROM marked, moves WHERE fault IN ('none', 'truncated') AND moves.initial <> 's'
        ), steps AS (
            SELECT e.conv_id, e.place, i.p, e.q, i.cost + e.cost AS cost, i.edits || e.edit AS edits
            FROM edits e JOIN inserts i ON i.q = e.p
        ), reached AS (
            SELECT conv_id, 0::BIGINT AS place, 0 AS state, {'cost': 0, 'audit': ''} AS best
            FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT r.conv_id, s.place, s.q, min({'cost': r.best.cost + s.cost, 'audit': r.best.audit || s.edits})
            FROM reached r JOIN steps s
              ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.place = r.place + 1 AND s.p = r.state
            GROUP BY r.conv_id, s.place, s.q
        ), sizes AS (
            SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM marked GROUP BY conv_id
        ), chosen AS (
            SELECT r.conv_id, min({'cost': r.best.cost + i.cost, 'audit': r.best.audit || i.edits}) AS best
            FROM reached r LEFT JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM r.conv_id
            JOIN inserts i ON i.p = r.state AND i.q IN (0, 3)
            WHERE r.place = coalesce(sizes.n, 0)
            GROUP BY r.conv_id
        ), letters AS (
            SELECT conv_id, best.audit AS audit, unnest(range(1, len(best.audit) + 1)) AS i FROM chosen
        ), replayed AS (
            SELECT conv_id, i, audit[i] AS edit,
                   count(*) FILTER (audit[i] <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS place,
                   count(*) FILTER (audit[i] <> 'D') OVER (PARTITION BY conv_id ORDER BY i) AS turn
            FROM letters
        ), kept AS (
            SELECT r.conv_id, i, edit, r.turn, m.role, m.text,
                   count(*) FILTER (edit = 'K' AND m.initial = 's') OVER (PARTITION BY r.conv_id) AS system
            FROM replayed r JOIN marked m
              ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND (edit <> 'I' AND m.place = r.place)
            WHERE edit <> 'D'
            UNION ALL
            SELECT r.conv_id, i, edit, r.turn, NULL, '',
                   (SELECT count(*) FROM replayed x JOIN marked m
                      ON m.conv_id IS NOT DISTINCT FROM x.conv_id AND m.place = x.place
                     WHERE x.conv_id IS NOT DISTINCT FROM r.conv_id AND x.edit = 'K' AND m.initial = 's')
            FROM replayed r WHERE edit = 'I'
        ), hashes AS (
            SELECT conv_id, sha256(string_agg(
                       CASE WHEN edit = 'K' THEN role WHEN (turn - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                       || ':' || text, chr(10) ORDER BY i)) AS digest
            FROM kept GROUP BY conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, c.best.cost::BIGINT AS cost, c.best.audit AS audit,
               coalesce(digest, sha256('')) AS repaired_sha256
        FROM chosen c
        LEFT JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN hashes ON hashes.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    # CRC-32 by a table of its 256 bytes; near words share all but one code point of one of them
    "op13_spelling_variants": r"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(list_prepend(byte, range(8)), lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))
                        ORDER BY byte) AS of
            FROM range(256) t(byte)
        ), found AS (
            SELECT doc_id, unnest(list_transform(
                regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+'),
                lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS word
            FROM documents
        ), runs AS (
            SELECT doc_id, word, count(*) AS n FROM found WHERE len(word) >= 6 GROUP BY ALL
        ), hashed AS (
            SELECT doc_id, word, n, coalesce(4294967295 - list_reduce(
                       list_prepend(4294967295::BIGINT, flatten(list_transform(
                           string_split(doc_id || ':' || word, ''),
                           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                                          ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
                       lambda h, byte: xor(h >> 8, crc.of[1 + (xor(h, byte) & 255)])), 1) AS h
            FROM runs, crc
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(word, (h % len(word))::INT) || substr(word, (h % len(word))::INT + 2)
                        ELSE word END AS word,
                   sum(n)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING len(word) >= 6 AND sum(n) >= 5
        ), cuts AS (
            SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b USING (rest)
            WHERE a.i = b.i AND a.word <> b.word
            UNION
            SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.rest
            UNION
            SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.rest
        ), ranked AS (
            SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near FROM near
            QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
            FROM words w LEFT JOIN ranked USING (word)
        ), chain AS (
            SELECT word, word AS at FROM formed
            UNION ALL
            SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL
        ), roots AS (
            SELECT chain.word, chain.at AS root FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """,
}
