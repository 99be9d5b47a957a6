"""The named corpus queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import adaptive_rules, bottom_k, content_sort, filter_audit, fim_frames, id_files, line_spread, max_plus, pitman_yor, spaced_seeds, toxicity, unit_hashes, url_models
from millrace.llm.registry import query
from millrace.session import scratch
from millrace.sources.tables import table

MIN_SITES = 10
OVERLAP_TOKENS = 13
OVERLAP_PERCENT = 80
REPEATED_WORDS = 50


def fold(n: int):
    """The fold of an id: the checksum of its digits, modulo ``n``; null ids are in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n)), F.lit(0))


# Verdict, host and path.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


@query("op1_url_models")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict, by rule or by model."""
    return url_models.filtered(table(spark, sf_dir, "pages"), URL_RULES)


@query("op2_max_plus")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded, and the checksum of what its ids decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = max_plus.encoded(table(spark, sf_dir, "documents"), model)
    out = max_plus.decoded(ids, model)
    return out.select("doc_id", "n_pieces", "chunks", "score", F.crc32("text").alias("text_crc32"))


@query("op3_pitman_yor")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from nine in ten of them."""
    return pitman_yor.scored(table(spark, sf_dir, "documents"), fold(10) == 0)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the labels."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fitted(documents, table(spark, sf_dir, "labels"), fold(4) != 2)
    return toxicity.scored(documents, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "toxic")


BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op5_line_spread", f"""
    WITH raw AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM raw),
    k AS (SELECT *, trim(line, {BLANKS_SQL}) AS bare FROM l),
    b AS (SELECT bare FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
    m AS (SELECT k.*, b.bare IS NOT NULL AS known FROM k LEFT JOIN b USING (bare)),
    d AS (SELECT doc_id, count(*) FILTER (known) AS n,
                 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT known), '') AS left_text
          FROM m GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS removed_lines, CASE WHEN coalesce(n, 0) = 0 THEN md5(text) ELSE md5(left_text) END AS text_md5
    FROM raw LEFT JOIN d USING (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut from each document, and the checksum of the text left."""
    cleaned = line_spread.cleaned(table(spark, sf_dir, "documents"), MIN_SITES)
    return cleaned.select("doc_id", "removed_lines", F.md5("text").alias("text_md5"))


WORD_SQL = "'[^\\x20\\x09-\\x0D]+'"
QUALITY_SQL = f"""
    WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD_SQL}) AS ws FROM documents),
    g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w),
    r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 4], ' ')) AS c FROM g),
    rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) t(k) WHERE c > 1 GROUP BY doc_id),
    ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, {BLANKS_SQL}) <> '') AS ls FROM w),
    b AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
          FROM w JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
    f AS (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM b),
    m AS (SELECT *, CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_permille,
                 CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_permille,
                 CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_word_permille,
                 CASE WHEN n_words > 0 THEN word_chars * 10 // n_words ELSE 0 END AS mean_word_decichars FROM f),
    u AS (SELECT lang, source, unnest([
            {{'m': 's', 'p': 1, 'v': symbol_permille}}, {{'m': 'd', 'p': 1, 'v': dup_line_permille}},
            {{'m': 'r', 'p': 1, 'v': repeat_word_permille}}, {{'m': 'h', 'p': 1, 'v': mean_word_decichars}},
            {{'m': 'l', 'p': -1, 'v': mean_word_decichars}}]) AS x FROM m WHERE NOT base_failed),
    h AS (SELECT lang, source, x.m AS m, x.p AS p, greatest(length(bin(x.v)) - 6, 0) * 32 + (x.v >> greatest(length(bin(x.v)) - 6, 0)) AS bin FROM u),
    lev AS (SELECT 0 AS level, lang, source, m, p, bin FROM h UNION ALL SELECT 1, lang, NULL, m, p, bin FROM h UNION ALL SELECT 2, NULL, NULL, m, p, bin FROM h),
    c AS (SELECT level, lang, source, m, p, bin, count(*) AS c FROM lev GROUP BY ALL),
    k AS (SELECT *, sum(c) OVER (PARTITION BY level, lang, source, m ORDER BY bin) AS upto, sum(c) OVER (PARTITION BY level, lang, source, m) AS total FROM c),
    q AS (SELECT level, lang, source, m, p, total, unnest([50, 50 + 25 * p, 50 + 40 * p]) AS pct,
                 unnest([min(bin) FILTER (upto * 100 >= total * 50), min(bin) FILTER (upto * 100 >= total * (50 + 25 * p)),
                         min(bin) FILTER (upto * 100 >= total * (50 + 40 * p))]) AS bin FROM k GROUP BY level, lang, source, m, p, total),
    v AS (SELECT level, lang, source, m, p, total, pct, (bin - greatest(bin // 32 - 1, 0) * 32) << greatest(bin // 32 - 1, 0) AS value FROM q),
    e AS (SELECT level, lang, source, m, p, total, max(value) FILTER (pct = 50) AS mid,
                 abs(max(value) FILTER (abs(pct - 50) = 25) - max(value) FILTER (pct = 50)) AS near,
                 abs(max(value) FILTER (abs(pct - 50) = 40) - max(value) FILTER (pct = 50)) AS far FROM v GROUP BY ALL),
    o AS (SELECT level, lang, source, m, total, mid + p * {adaptive_rules.REACH} * CASE WHEN near > 0 THEN near WHEN far > 0 THEN far WHEN level = 2 THEN 1 END AS own FROM e),
    fen AS (SELECT level, lang, source, max(total) AS n, max(own) FILTER (m = 's') AS s, max(own) FILTER (m = 'd') AS d,
                 max(own) FILTER (m = 'r') AS r, max(own) FILTER (m = 'h') AS h, max(own) FILTER (m = 'l') AS l FROM o GROUP BY level, lang, source),
    big AS (SELECT level, lang, source, CASE WHEN n >= {adaptive_rules.LEAST} OR level = 2 THEN {{'s': s, 'd': d, 'r': r, 'h': h, 'l': l}} END AS x FROM fen),
    lan AS (SELECT z.lang, least(z.x.s, y.x.s) AS s, least(z.x.d, y.x.d) AS d, least(z.x.r, y.x.r) AS r, coalesce(z.x.h, y.x.h) AS h, coalesce(z.x.l, y.x.l) AS l
            FROM (SELECT * FROM big WHERE level = 1) z, (SELECT * FROM big WHERE level = 2) y),
    pick AS (SELECT a.lang, a.source, {{'s': least(a.x.s, z.s), 'd': least(a.x.d, z.d), 'r': least(a.x.r, z.r), 'h': coalesce(a.x.h, z.h), 'l': coalesce(a.x.l, z.l)}} AS x
             FROM (SELECT * FROM big WHERE level = 0) a JOIN lan z ON a.lang IS NOT DISTINCT FROM z.lang)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(greatest(n_symbols - 1, 0) * 1000 // word_chars <= x.s AND greatest(n_dup_lines - 1, 0) * 1000 // n_lines <= x.d
             AND greatest(n_repeat_words - 10, 0) * 1000 // n_words <= x.r AND mean_word_decichars <= x.h AND mean_word_decichars >= x.l, true) AS kept
    FROM m LEFT JOIN pick ON m.lang IS NOT DISTINCT FROM pick.lang AND m.source IS NOT DISTINCT FROM pick.source"""


@query("op6_adaptive_rules", QUALITY_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether it is kept."""
    return adaptive_rules.judged(table(spark, sf_dir, "documents"))


@query("op7_id_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place, length and checksum in the id files written and read back."""
    folder = scratch(spark, "ids")
    written = id_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    written.write.parquet(scratch(spark, "ids-written"))
    path = scratch(spark, "ids-read")
    id_files.summaries(spark, folder).write.parquet(path)
    return id_files.starts(spark.read.parquet(path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_spaced_seeds")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest overlap of each document with each benchmark item it overlaps with."""
    return spaced_seeds.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), OVERLAP_TOKENS, OVERLAP_PERCENT)


@query("op9_lines", f"""
    WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS unit FROM raw),
    p AS (SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD_SQL}) AS ws,
                 coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l),
    k AS (SELECT doc_id, unit, start, length(line) AS n_chars, array_to_string(ws, ' ') AS norm FROM p WHERE len(ws) >= {unit_hashes.MIN_WORDS}),
    f AS (SELECT *, first_value(doc_id) OVER win AS first_doc_id, first_value(unit) OVER win AS first_unit FROM k
          WINDOW win AS (PARTITION BY norm ORDER BY doc_id, unit))
    SELECT doc_id, CAST(unit AS INTEGER) AS unit, CAST(start AS BIGINT) AS start, CAST(n_chars AS BIGINT) AS n_chars, first_doc_id, CAST(first_unit AS INTEGER) AS first_unit
    FROM f WHERE doc_id <> first_doc_id OR unit <> first_unit""")
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that repeat an earlier one, with their places in the text as it was."""
    return unit_hashes.repeats(table(spark, sf_dir, "documents"), "line")


@query("op9_unit_hashes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of about 50 words or more that repeat an earlier one, inside lines or over several."""
    return unit_hashes.runs(table(spark, sf_dir, "documents"), REPEATED_WORDS)


@query("op10_bottom_k")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 85 % similarity of their five-word shingles."""
    return bottom_k.linked(table(spark, sf_dir, "documents"), 85, 5)


AUDIT_SQL = f"""
    WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD_SQL}) AS ws FROM documents),
    m AS (SELECT doc_id, part, [
            CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
            CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
            CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
            CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
            CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END] AS fails FROM w),
    f AS (SELECT part, array_to_string(fails, '') AS fails, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
                 doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS bad FROM m),
    c AS (SELECT part, fails, good, bad, count(*) AS n FROM f GROUP BY ALL),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
          WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
    s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier FROM o, range(1, 6) r(step)),
    j AS (SELECT part, filter_order, step, own, good, bad, n, fails = own AS only_own, contains(fails, own) AS failing,
                 length(translate(earlier, fails, '')) < length(earlier) AS gone FROM c, s),
    g AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
                 sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
                 sum(CASE WHEN only_own THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
                 sum(CASE WHEN failing AND NOT gone AND bad THEN n ELSE 0 END) AS toxic_lost
          FROM j GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g"""


@query("op11_filter_audit", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of each of their 120 orders, per language."""
    documents = filter_audit.stream(spark, f"{sf_dir}/documents.parquet")
    return filter_audit.report(filter_audit.counters(documents, table(spark, sf_dir, "labels")))


@query("op12_content_sort", r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
    g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                 row_number() OVER (PARTITION BY t ORDER BY doc_id) AS nth FROM n)
    SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM g""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts, and the one of the group that stays."""
    return content_sort.classes(table(spark, sf_dir, "documents"))


# Markers, forms and the digits drawn are fixed values.
@query("op13_fim_frames", r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                      sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
    h AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                 CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
                 coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's order of parts, and checksums of the output and of the text rebuilt from it."""
    store = scratch(spark, "fim-store")
    fim_frames.stored(table(spark, sf_dir, "documents")).write.parquet(store)
    return fim_frames.digests(fim_frames.transformed(spark.read.parquet(store)))
