"""Queries over the corpus tables, one for each operator, and SQL to compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    conversation_repair,
    hard_negatives,
    mixing,
    near_dedup,
    ngram_trie,
    packing,
    phrase_index,
    quality,
    secret_scan,
    sharding,
    snapshots,
    url_filter,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_quality_ratio(spark, sf_dir):
    """Figures, base rules and verdict of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.drop("text")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
#: Hosts with one of these are the listed keys.
LISTED_WORDS = ["ads-", "bets", "casino", "pills"]


@query
def op7_url_cascade(spark, sf_dir):
    """Rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filter.listed_by_words(LISTED_WORDS)
    return url_filter.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_cascade"] = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(action, rule_host, rule_path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
    SELECT DISTINCT host, path,
           arg_max(rule_host || rule_path, length(rule_host || rule_path)) OVER (PARTITION BY host, path) AS rule,
           arg_max(action, length(rule_host || rule_path)) OVER (PARTITION BY host, path) AS action
    FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
      ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN regexp_matches(host, 'ads-|bets|casino|pills') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (host, path)
"""


@query
def op8_packed_windows(spark, sf_dir):
    """Every piece of every document with its place in a sequence."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False).drop("ids")


@query
def op10_secret_spans(spark, sf_dir):
    """Counts, digest and list of every document's secrets."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    counts = [secret_scan.count_kind(spans, kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS]
    digest = F.sha2(secret_scan.span_text(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.span_text(spans).alias("spans"))


@query
def op2_circulant_minhash(spark, sf_dir):
    """Component of every document by its 2-word shingles."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


ORACLE["op2_circulant_minhash"] = r"""
WITH RECURSIVE spread AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS shingle
    FROM spread, unnest(range(1, greatest(len(words) - 1, 1) + 1)) AS r(i) WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.size + y.size - shared)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN edges ON other = a
), least AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""


@query
def op1_kd_shards(spark, sf_dir):
    """Shard and slot of every document."""
    docs = table(spark, sf_dir, "documents")
    placed = sharding.shard(docs, ["n_chars", "source", "lang"], shards=24)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op3_phrase_index(spark, sf_dir):
    """Benchmark passages in every document."""
    found = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE["op3_phrase_index"] = r"""
WITH RECURSIVE spread AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i : i + 12], ' ') AS phrase
    FROM items, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS r(i) WHERE len(words) > 0
), sizes AS (
    SELECT DISTINCT size FROM windows
), found AS (
    SELECT doc_id, i, size, item_id
    FROM (SELECT doc_id, i, s.size AS size, array_to_string(words[i : i + s.size - 1], ' ') AS phrase
          FROM spread, sizes AS s, unnest(range(1, len(words) - s.size + 2)) AS r(i)) AS runs
    JOIN windows USING (size, phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM found, unnest(range(i, i + size)) AS r(place) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM spread LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op4_chat_snapshots(spark, sf_dir):
    """Every maximal conversation as chat text."""
    return snapshots.render(table(spark, sf_dir, "conversations"))


ORACLE["op4_chat_snapshots"] = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS said FROM turns GROUP BY conv_id
), kept AS (
    SELECT min(conv_id) AS conv_id, said FROM whole
    WHERE said::VARCHAR NOT IN (SELECT DISTINCT said[1:k]::VARCHAR FROM whole, unnest(range(1, len(said))) AS r(k))
    GROUP BY said
)
SELECT conv_id, len(said)::BIGINT AS n_turns,
       array_to_string(list_transform(said, lambda s: '<|im_start|>' || coalesce(s.role, '') || chr(10)
           || replace(coalesce(s.text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10)), '') AS text
FROM kept
"""


@query
def op6_warc_salvage(spark, sf_dir):
    """Pages as archives, and what reading these gives."""
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(warc.plan_records(pages), path, warc.average_record(pages))
    records, gaps = warc.read_archives(spark, path, blocks=False)
    if gap := gaps.first():
        raise ValueError(f"an archive that was just written is damaged: {gap}")
    kind = pages.schema["page_id"].dataType

    def id_of(uri: str) -> Column:
        return F.nullif(warc.page_of(F.col(uri)), F.lit("")).try_cast(kind)

    figures = warc.payload_figures(records)
    return figures.select(
        id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_of("refers_to").alias("refers_to")
    )


ORACLE["op6_warc_salvage"] = r"""
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS response FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""


@query
def op5_trie_scores(spark, sf_dir):
    """Scores of every document by the model of the training fold."""
    docs = table(spark, sf_dir, "documents")
    return ngram_trie.score(docs, ngram_trie.held_out(F.col("doc_id")))


@query
def op11_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    turns = table(spark, sf_dir, "conversations")
    found = conversation_repair.report(conversation_repair.damaged(turns)).withColumnRenamed("conv_id", "found_id")
    ids = turns.select("conv_id").distinct()
    every = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


ORACLE["op11_conversation_repair"] = r"""
WITH RECURSIVE checked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_concat([4294967295::UBIGINT],
                           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                          lambda c: ord(c)::UBIGINT)),
               lambda crc, byte: list_reduce(
                   list_concat([xor(crc, byte)], range(8)::UBIGINT[]),
                   lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))
           ), 4294967295::UBIGINT) % 20 AS fault
    FROM conversations
), harmed AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM checked WHERE fault <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM harmed
), faults AS (
    SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair,
           CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), inserts(q, count, at_q, lines) AS (
    VALUES (0, 0, 0, []::VARCHAR[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
           (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
           (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
           (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])
), edits(at_q, letter, only_initial, next_q, price, new_role) AS (
    VALUES (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL), (3, 'D', NULL, 3, 3, NULL),
           (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
           (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (3, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant')
), paths AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
    UNION ALL
    SELECT conv_id, i, q, cost, audit, lines FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS place FROM (
            SELECT p.conv_id, f.i, e.next_q AS q,
                   p.cost + 2 * n.count + e.price + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS cost,
                   p.audit || repeat('I', n.count) || letter AS audit,
                   list_concat(p.lines, n.lines,
                               CASE WHEN letter = 'D' THEN [] ELSE [coalesce(new_role, role) || ':' || text] END) AS lines
            FROM paths AS p JOIN faults AS f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1
            JOIN inserts AS n ON n.q = p.q JOIN edits AS e ON e.at_q = n.at_q
            WHERE (only_initial IS NULL OR only_initial = initial) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
        )
    ) WHERE place = 1
), figures AS (
    SELECT conv_id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count_if(fault = 'blank')::BIGINT AS blank, count_if(fault = 'duplicate')::BIGINT AS duplicate,
           count_if(fault = 'truncated')::BIGINT AS truncated, count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
    FROM faults GROUP BY conv_id
), ends AS (
    SELECT p.conv_id, p.cost + 2 * missing AS cost, audit || repeat('I', missing) AS audit, list_concat(lines, last_lines) AS lines
    FROM paths AS p LEFT JOIN figures AS g ON p.conv_id IS NOT DISTINCT FROM g.conv_id
    JOIN (VALUES (0, 0, []::VARCHAR[]), (1, 2, ['user:', 'assistant:']), (2, 1, ['assistant:']), (3, 0, [])) AS m(q, missing, last_lines) ON m.q = p.q
    WHERE p.i = coalesce(size, 0)
), cheapest AS (
    SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM cheapest AS c LEFT JOIN figures AS g ON c.conv_id IS NOT DISTINCT FROM g.conv_id
"""


@query
def op12_residue_negatives(spark, sf_dir):
    """Hard negatives of every anchor and positive."""
    rows = table(spark, sf_dir, "embeddings").filter(hard_negatives.is_usable("label", "embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select(F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.whole_numbers(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


ORACLE["op12_residue_negatives"] = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM vectors AS a JOIN vectors AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), banded AS (
    SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank
    FROM positives AS p JOIN scored AS n
      ON p.anchor_id = n.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM banded WHERE rank <= 5
"""


@query
def op13_entropy_mix(spark, sf_dir):
    """Words that the mix takes of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
