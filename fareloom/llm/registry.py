"""The operators of this package as queries over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.counts import token_counts
from fareloom.llm.forest import nearest
from fareloom.llm.packing import pack_documents
from fareloom.llm.phrases import contaminated
from fareloom.llm.prefix_trie import ordered_turns, prefix_trie, with_shared_heads
from fareloom.llm.pieces import decode_pieces, encode_pieces
from fareloom.llm.quality import score_quality
from fareloom.llm.repeats import mark_repeats
from fareloom.llm.simhash import near_duplicates
from fareloom.llm.spellings import spelling_variants, word_counts
from fareloom.llm.tables import table
from fareloom.llm.topk import largest_products
from fareloom.llm.urls import judge_urls, rule_table
from fareloom.llm.warc import mark_revisits, read_archives, write_archives
from fareloom.registry.entries import Entry
from fareloom.session import shared_folder, written

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
URL_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), rules(rule, host, path, verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
)
SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule,
       coalesce(arg_max(r.verdict, length(r.rule)), 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.page_id, p.host, p.path
"""
WARC_SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), groups AS (
    SELECT html, max(page_id) AS last FROM payloads WHERE payload_bytes >= 1000 GROUP BY html
)
SELECT p.page_id, p.payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.last <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM payloads p LEFT JOIN groups g ON p.html = g.html
"""


TOP_K_SQL = """
WITH scaled AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

LEAKS_SQL = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, n, list_slice(w, pos + 1, pos + n) AS k
    FROM (SELECT item_id, w, n, unnest(range(len(w) - n + 1)) AS pos
          FROM (SELECT *, least(10, len(w)) AS n FROM items WHERE len(w) > 0))
), places AS (
    SELECT row, n, pos, list_slice(w, pos + 1, pos + n) AS k
    FROM (SELECT d.row, d.w, s.n, unnest(range(len(d.w) - s.n + 1)) AS pos
          FROM docs d JOIN (SELECT DISTINCT n FROM windows) s ON len(d.w) >= s.n)
), found AS (
    SELECT p.row, p.pos, p.n, w.item_id FROM places p JOIN windows w ON w.n = p.n AND w.k = p.k
), hit AS (
    SELECT row, count(DISTINCT pos) AS n FROM (SELECT row, unnest(range(pos, pos + n)) AS pos FROM found) GROUP BY row
), named AS (
    SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
       coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON h.row = d.row LEFT JOIN named i ON i.row = d.row
"""


VARIANTS_SQL = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
), counted AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS told
    FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], [
            (instr('0123456789ABCDEF', told[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', told[2 * i + 2]) - 1
            for i in range(len(told) // 2)
        ]),
        lambda crc, d: list_reduce(
            list_concat([xor(crc, d)], [0::BIGINT for i in range(8)]),
            lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1))
        )
    )) AS h
    FROM counted
), slipped AS (
    SELECT n, CASE WHEN h % 199 = 0
        THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
    SELECT word, n, pos, left(word, pos - 1) || substr(word, pos + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.rest
    UNION
    SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.rest
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS n, arg_min(other, (-n, other)) AS other FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN b.n >= 5 * w.n THEN b.other END AS form, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), followed AS (
    SELECT word, word AS root, form AS onward FROM formed
    UNION ALL
    SELECT f.word, f.onward, x.form FROM followed f JOIN formed x ON x.word = f.onward
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN followed r ON r.word = f.word AND r.onward IS NULL
"""


TRIE_SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
           {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS t
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 5 AS b, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda crc, d: list_reduce(
            list_concat([xor(crc, d)], [0::BIGINT for i in range(8)]),
            lambda r, i: xor(r >> 1, 3988292384::BIGINT * (r & 1))
        )
    )) % 9 AS h
    FROM (SELECT DISTINCT c FROM turns)
), parts AS (
    SELECT v.c, 0 AS own, t.p, t.t FROM convs v JOIN turns t ON t.c = v.b AND t.p <= v.h
    UNION ALL
    SELECT v.c, 1, t.p, t.t FROM convs v JOIN turns t ON t.c = v.c AND t.p > v.h
), rebuilt AS (
    SELECT v.c, coalesce(r.s, []) AS s
    FROM convs v LEFT JOIN (SELECT c, list(t ORDER BY own, p) AS s FROM parts GROUP BY c) r ON r.c = v.c
), members AS (
    SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt
), nodes AS (
    SELECT list_slice(s, 1, d) AS k, d AS depth, min(c) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends,
           (count(*) - 1) * coalesce(strlen(any_value(s[d].x)), 0) AS saved
    FROM members GROUP BY ALL
), children AS (
    SELECT list_slice(k, 1, depth - 1) AS k, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), shaped AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children
    FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.k = n.k
), below AS (
    SELECT list_slice(k, 1, a) AS k, a AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS a FROM shaped) GROUP BY ALL
)
SELECT s.conv_id, s.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n::BIGINT AS n_convs,
       s.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, s.ends AS ends_sha256
FROM shaped s
JOIN below b ON b.depth = s.depth AND b.k = s.k
LEFT JOIN shaped p ON p.depth = s.depth - 1 AND p.k = list_slice(s.k, 1, s.depth - 1)
"""


def held_out_ids(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(held_out_ids(F.col("doc_id")), F.lit(False))
    scored = score_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"), learn_from=~held_out
    )
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), rule_table(spark, URL_RULES))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), PIECE_BPE)


def op4_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"), "url", F.col("html").cast("binary").alias("payload")
    )
    path = shared_folder(spark, "archives")
    write_archives(mark_revisits(pages), path)
    records = read_archives(spark, path).where("reason IS NULL")
    number = lambda name: F.regexp_extract(name, r"<urn:page:(-?\d+)>", 1)
    revisit = F.col("record_type") == "revisit"
    return records.select(
        F.expr("try_cast(regexp_extract(record_id, '<urn:page:(.*)>', 1) AS bigint)").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload").cast("bigint"))
        .alias("payload_bytes"),
        F.when(revisit, F.substring_index("digest", ":", -1)).otherwise(F.sha1("payload"))
        .alias("payload_digest"),
        "record_type",
        F.when(revisit, number("refers_to").cast("bigint")).alias("refers_to"),
    )


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), BYTE_BPE, most=2048)


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicates(table(spark, folder, "documents"), size=3, bits=2)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", shown.alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode_pieces(table(spark, folder, "documents"), PIECE_BPE)
    decoded = decode_pieces(encoded, PIECE_BPE)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = mark_repeats(table(spark, folder, "documents"), window=20)
    return marked.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return largest_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    counts = word_counts(
        table(spark, folder, "documents"), least_letters=6, least_count=5, slips=199
    )
    return spelling_variants(counts, times=5)


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = ordered_turns(table(spark, folder, "conversations"))
    turns = written(turns, "conversation-turns")
    return prefix_trie(with_shared_heads(turns), turns.select("conv").distinct())


ENTRIES = {
    "op1_quality_classifier": Entry(op1_quality_classifier),
    "op2_url_filters": Entry(op2_url_filters, URL_SQL),
    "op3_token_counts": Entry(op3_token_counts),
    "op4_warc_salvage": Entry(op4_warc_salvage, WARC_SQL),
    "op5_best_fit_packing": Entry(op5_best_fit_packing),
    "op6_nearest_neighbours": Entry(op6_nearest_neighbours),
    "op7_simhash_near_dedup": Entry(op7_simhash_near_dedup),
    "op8_sentencepiece": Entry(op8_sentencepiece),
    "op9_substring_dedup": Entry(op9_substring_dedup),
    "op10_exact_top_k": Entry(op10_exact_top_k, TOP_K_SQL),
    "op11_benchmark_decontamination": Entry(op11_benchmark_decontamination, LEAKS_SQL),
    "op12_spelling_variants": Entry(op12_spelling_variants, VARIANTS_SQL),
    "op13_conversation_trie": Entry(op13_conversation_trie, TRIE_SQL),
}
