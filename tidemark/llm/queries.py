"""One query for each operator of this package, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.ann import nearest
from tidemark.llm.bpe import encode
from tidemark.llm.common import table
from tidemark.llm.extract import extract
from tidemark.llm.language import identify
from tidemark.llm.leaks import contaminated
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.phrases import collocations
from tidemark.llm.secrets import scan
from tidemark.llm.simhash import simhash_components
from tidemark.llm.suffixes import cut_repeats
from tidemark.llm.turns import damaged, repaired
from tidemark.llm.warc import through_archives


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_archives(table(spark, sf_dir, "pages"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"), carry=True)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repaired(rows, damaged(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_nearest,
        op3_bpe,
        op4_simhash,
        op5_language,
        op6_secrets,
        op7_warc,
        op8_repeats,
        op9_packing,
        op10_near_vectors,
        op11_leaks,
        op12_phrases,
        op13_turns,
    )
}

#: What SQL can express exactly; the other operators are held against brute force in the tests.
ORACLE: dict[str, str] = {
    "op7_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        g AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN g.top <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN g.top <> p.page_id THEN g.top END AS refers_to
        FROM p LEFT JOIN g ON g.payload_digest = p.payload_digest AND p.payload_bytes >= 1000""",
    "op10_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
        pairs AS (
            SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(i, j) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.i, pairs.j FROM reach JOIN pairs ON reach.j = pairs.i),
        low AS (SELECT i, min(j) AS component_id FROM reach GROUP BY i),
        n AS (SELECT i, count(*) AS n_links FROM pairs GROUP BY i)
        SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
        FROM embeddings e JOIN low ON low.i = e.vec_id LEFT JOIN n ON n.i = e.vec_id""",
    "op11_leaks": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark WHERE text IS NOT NULL),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest(list_transform(
                range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS run
            FROM b WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM windows),
        starts AS (
            SELECT d.r, size, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN sizes ON len(w) >= size),
        met AS (
            SELECT s.r, s.i, s.size, windows.item_id
            FROM starts s JOIN d ON d.r = s.r
            JOIN windows ON windows.size = s.size AND windows.run = array_to_string(d.w[s.i:s.i + s.size - 1], ' ')),
        hit AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + size)) FROM met) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
               sha256(coalesce(items.ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN items ON items.r = d.r""",
    "op12_phrases": r"""
        WITH split AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split),
        f1 AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, unnest(w) AS p FROM pieces) GROUP BY ALL),
        f2 AS (
            SELECT lang, p, count(*) AS f
            FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM pieces)
            GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (
            SELECT lang, p, count(*) AS f
            FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1),
                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS p FROM pieces)
            GROUP BY ALL HAVING count(*) >= 10),
        total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
        parts AS (SELECT lang, p, f, 2 AS k, string_split(p, ' ') AS w FROM f2
                  UNION ALL SELECT lang, p, f, 3, string_split(p, ' ') FROM f3),
        f AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2),
        cuts AS (
            SELECT c.lang, c.p, c.f AS a, j, l.f AS l, r.f AS r,
                   (CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(l.f AS HUGEINT) * r.f) AS score
            FROM (SELECT *, unnest(range(1, k)) AS j FROM parts) c
            JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.w[1:j], ' ')
            JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.w[j + 1:], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
        inside AS (
            SELECT lang, w[1] || ' ' || w[2] AS p, f FROM parts WHERE k = 3
            UNION ALL SELECT lang, w[2] || ' ' || w[3], f FROM parts WHERE k = 3),
        over AS (SELECT lang, p, max(f) AS f FROM inside GROUP BY ALL),
        kept AS (
            SELECT b.lang, b.p AS phrase, b.a, b.l, b.r, CAST(b.score AS BIGINT) AS score
            FROM best b LEFT JOIN over o ON o.lang = b.lang AND o.p = b.p WHERE o.f IS NULL OR 100 * o.f < 50 * b.a)
        SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept k JOIN total t ON t.lang = k.lang
        QUALIFY rank <= 2000""",
}
