"""The operators as queries over whole tables, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from zlib import crc32

from quayside.llm.collocations import collocations
from quayside.llm.common import table
from quayside.llm.encoding import round_trip
from quayside.llm.exact_dedup import exact_dedup
from quayside.llm.fertility import fertility_rules
from quayside.llm.language import identify
from quayside.llm.line_dedup import line_report
from quayside.llm.ngram_join import ngram_join
from quayside.llm.packing import pack
from quayside.llm.pii import find_pii
from quayside.llm.quality import classify
from quayside.llm.runs import find_runs, run_digest
from quayside.llm.toxicity import toxicity
from quayside.llm.warc import archive_round_trip


def op7_exact_dedup(spark, folder):
    return exact_dedup(table(spark, folder, "documents", "doc_id", "text"))


def op8_bpe_round_trip(spark, folder):
    return round_trip(table(spark, folder, "documents", "doc_id", "text"))


def op1_fertility(spark, folder):
    return fertility_rules(table(spark, folder, "documents", "doc_id", "text", "lang"))


def op2_ngram_join(spark, folder):
    return ngram_join(table(spark, folder, "documents", "doc_id", "text"))


def op3_line_dedup(spark, folder):
    return line_report(table(spark, folder, "documents", "doc_id", "text"))


def op4_language(spark, folder):
    return identify(table(spark, folder, "documents", "doc_id", "text", "lang"))


def op5_warc(spark, folder):
    return archive_round_trip(table(spark, folder, "pages", "page_id", "url", "html")).drop("target_uri", "intact")


def op6_quality(spark, folder):
    return classify(table(spark, folder, "documents", "doc_id", "text"),
                    table(spark, folder, "labels", "doc_id", "quality"))


def op9_packing(spark, folder):
    return pack(table(spark, folder, "documents", "doc_id", "text"))


def op10_pii(spark, folder):
    return find_pii(table(spark, folder, "documents", "doc_id", "text"))


def op11_collocations(spark, folder):
    return collocations(table(spark, folder, "documents", "text", "lang"))


def op12_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents", "doc_id", "text"),
                    table(spark, folder, "labels", "doc_id", "toxic"))


def with_period(doc_id: int, words: list[str]) -> list[str]:
    """The words, of one document in ten repeating with a period from some place on, both told by the id's hash."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + (i - start) % period] for i in range(start, n)]


def op13_periodic_runs(spark, folder):
    return run_digest(find_runs(table(spark, folder, "documents", "doc_id", "text"), change=with_period))


QUERIES = {
    "op1_fertility": op1_fertility,
    "op2_ngram_join": op2_ngram_join,
    "op3_line_dedup": op3_line_dedup,
    "op4_language": op4_language,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    # Base32 of the digest: five hexadecimal digits are four characters.
    "op5_warc": r"""
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads)
        SELECT page_id, octet_length(payload) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                   (CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM firsts""",
    "op7_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g') AS content
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size,
               row_number() OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) = 1 AS kept,
               sha256(content) AS text_sha256
        FROM rows""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        sequences AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM sequences GROUP BY lang),
        starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM sequences),
        occurrences AS (
            SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
            FROM starts, (SELECT unnest(range(1, 6)) AS size) WHERE i + size - 1 <= len(words)),
        phrases AS (
            SELECT lang, size, phrase, count(*) AS f FROM occurrences GROUP BY lang, size, phrase HAVING count(*) >= 100),
        kept AS (
            SELECT * FROM phrases AS short WHERE size > 1 AND NOT EXISTS (
                SELECT 1 FROM phrases AS long WHERE long.lang = short.lang AND long.size > short.size
                AND 100 * long.f >= 100 * short.f
                AND contains(' ' || long.phrase || ' ', ' ' || short.phrase || ' '))),
        cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM kept),
        scored AS (
            SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n,
                   CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts JOIN totals ON totals.lang = cuts.lang
            JOIN phrases AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(words[:k], ' ')
            JOIN phrases AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(words[k + 1:], ' ')),
        best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000""",
}
