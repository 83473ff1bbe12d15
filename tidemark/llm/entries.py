"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (jaccard_join, language_spans, length_buckets, posting_lists, quality_bands, quote_links, secret_scan, source_mix,
               spelling_forms, tag_paths, target_resample, warc_index, winnow_prints)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_ngram_jaccard_join", """
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    x AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ')
                                       ELSE array_to_string(list_slice(words, i, i + 3), ' ') END AS shingle
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
    i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b, inter, na.n AS na, nb.n AS nb FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * inter >= 85 * (na.n + nb.n - inter)),
    r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b),
    c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id),
    s AS (SELECT b AS doc_id, min(a) AS same FROM l WHERE inter = na AND inter = nb GROUP BY b)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, least(w.doc_id, coalesce(s.same, w.doc_id)) AS class_id
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.doc_id = w.doc_id LEFT JOIN s ON s.doc_id = w.doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


@query("op5_compression_bands")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_bands.score(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "ratio", "odd_chunks")


def _secret_sql() -> str:
    """The scan in SQL: offsets by window sums over matches and the text
    between them, entropies by recounting every window."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"

    def located(kind: int, pattern: str, group: int, keep: str) -> str:
        p = quote(pattern)
        return f"""SELECT doc_id, {kind} AS k, s, s + length(hit) AS e, hit FROM (
            SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) - length(hit) AS s FROM (
                SELECT doc_id, unnest(regexp_extract_all(t, {p})) AS hit, unnest(regexp_extract_all(t, {p}, {group})) AS part,
                       unnest(list_slice(string_split_regex(t, {p}), 1, -2)) AS gap,
                       unnest(range(len(regexp_extract_all(t, {p})))) AS i
                FROM d WHERE regexp_matches(t, {p}))) WHERE {keep}"""
    # the allow-list and the limits told a second time
    part = "([A-Za-z]?[a-z]{1,17}[0-9]{0,4}|[A-Z]{1,12}|[0-9]{1,4})"
    allowed = f"""regexp_matches(hit, '^[-_/=+]*{part}([-_/=+]+{part})*[-_/=+]*$') OR regexp_matches(hit, 'EXAMPLE(KEY)?$')
                  OR regexp_matches(hit, '^[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$') OR translate(hit, '-_=+/', '') = ''"""
    limit = """CASE WHEN regexp_full_match(hit, '[0-9]+') THEN 3.1 WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN 3.0
                    WHEN regexp_full_match(hit, '[a-z]+') THEN 3.6 WHEN regexp_full_match(hit, '[A-Za-z]+') THEN 3.8 ELSE 3.5 END"""
    w = secret_scan.WINDOW
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secret_scan.KINDS))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({located(0, secret_scan.ASSIGN, 2, 'length(part) >= 6')}
        UNION ALL {located(1, secret_scan.ACCESS, 0, 'true')} UNION ALL {located(2, secret_scan.HEX, 0, 'true')}),
    c AS ({located(3, secret_scan.CANDIDATE, 0, 'true')}),
    free AS (SELECT * FROM c WHERE NOT ({allowed} OR len(list_distinct(string_split(hit, ''))) = 1)),
    win AS (SELECT doc_id, s, hit, unnest(range(1, length(hit) - {w} + 2)) AS i FROM free),
    chars AS (SELECT doc_id, s, hit, i, unnest(string_split(substr(hit, CAST(i AS INTEGER), {w}), '')) AS ch FROM win),
    cnt AS (SELECT doc_id, s, hit, i, ch, count(*) AS n FROM chars GROUP BY ALL),
    bits AS (SELECT doc_id, s, hit, i, -sum(n / {w}.0 * log2(n / {w}.0)) AS h FROM cnt GROUP BY ALL),
    hot AS (SELECT doc_id, s, hit FROM bits GROUP BY ALL
            HAVING max(h) >= {limit} - 1e-9),
    spans AS (SELECT doc_id, k, s, e FROM base UNION ALL SELECT doc_id, 3, s, s + length(hit) FROM hot),
    named AS (SELECT *, CASE k {names} END || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS name FROM spans),
    g AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
                 count(*) FILTER (WHERE k = 2) AS n_hex, count(*) FILTER (WHERE k = 3) AS n_entropy,
                 string_agg(name, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS b, string_agg(name, ',' ORDER BY s, k) AS a
          FROM named GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
    FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


@query("op8_secret_scan", _secret_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")


@query("op7_source_mix", """
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
    k AS (SELECT *, pow((CAST('0x' || substr(md5(concat_ws(chr(1), '7', coalesce(CAST(doc_id AS VARCHAR), chr(2)), md5(t))), 1, 13) AS BIGINT) + 1)
                        / 4503599627370496.0,
                        1 / greatest(0.05, least(1.0, length(regexp_replace(t, '[^\\p{L}\\s]+', '', 'g')) / greatest(length(t), 1)))) AS key FROM d),
    s AS (SELECT source, sum(size) AS words, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
    w AS (SELECT source, words, CAST(2 * words AS DOUBLE) AS most, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
    c AS (SELECT *, sum(most) OVER o - most AS capped, sum(weight) OVER () - (sum(weight) OVER o - weight) AS open
          FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    l AS (SELECT max((1.5 * (SELECT sum(words) FROM w) - capped) / open) AS level FROM c),
    g AS (SELECT source, words, CAST(least(most, weight * (SELECT level FROM l)) AS DOUBLE) AS target FROM w),
    b AS (SELECT k.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key DESC, doc_id NULLS LAST, size
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k),
    e AS (SELECT b.doc_id, b.size, b.source, b.before, g.words AS source_size, g.target,
                 CASE WHEN g.words > 0 THEN CAST(floor(g.target / g.words) AS BIGINT) ELSE 0 END AS epochs
          FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source),
    p AS (SELECT *, greatest(0, least(size, CAST(round(target - epochs * source_size) AS BIGINT) - before)) AS part FROM e)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
           CAST(epochs * size + part AS BIGINT) AS taken, source, epochs, CAST(part AS BIGINT) AS part
    FROM p""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = source_mix.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "part")


@query("op2_length_buckets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


@query("op1_tag_path_ratios")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


@query("op3_warc_index", """
    WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, url, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS k,
                 first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS f FROM d)
    SELECT page_id, url, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND k > 1 THEN f END AS refers_to
    FROM r""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.round_trip(table(spark, sf_dir, "pages"))


@query("op6_quotation_linking")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_quotes(table(spark, sf_dir, "conversations"))


@query("op9_posting_lists")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_language_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_spans.split_and_identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


# crc32 in SQL: the table of the polynomial, then a byte at a time over hex
CRC_TABLE = """crc_table AS MATERIALIZED (
        SELECT list(c ORDER BY i) AS t
        FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c
              FROM range(256) r(i)))"""


def _crc_sql(hex_: str) -> str:
    return f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(range(1, length({hex_}), 2), lambda i: CAST('0x' || substr({hex_}, i, 2) AS BIGINT))),
            lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)))"""


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# near words by deletion: equal after dropping the same place of both (a
# replacement), or one equal to the other with a place dropped
@query("op11_spelling_tiles", f"""
    WITH RECURSIVE {CRC_TABLE},
    runs AS (SELECT id, run, count(*) AS m
             FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                          {LOWER_SQL.format("unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+'))")} AS run FROM documents) GROUP BY ALL),
    hashed AS (SELECT run, m, {_crc_sql('x')} AS h FROM (SELECT run, m, hex(encode(id || ':' || run)) AS x FROM runs), crc_table),
    edited AS (SELECT m, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
               FROM hashed),
    words AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM edited WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
    cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    pairs AS (SELECT a.word AS a, b.word AS b, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
              UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
              UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
    best AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS b, max(n) AS bn FROM pairs GROUP BY a),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * w.n THEN b END AS form,
                     CASE WHEN bn >= 2 * w.n THEN bn END AS form_n FROM words w LEFT JOIN best ON best.word = w.word),
    walk AS (SELECT word, word AS at FROM forms UNION SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL),
    roots AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NULL)
    SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM forms f JOIN roots r ON r.word = f.word""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms.variants(table(spark, sf_dir, "documents"))


@query("op12_target_resample", f"""
    WITH {CRC_TABLE},
    texts AS (SELECT doc_id AS id, text, 0 AS side FROM documents UNION ALL SELECT item_id, text, 1 FROM benchmark),
    rows AS (SELECT row_number() OVER () AS row, id, side, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")},
                                                                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
    feats AS (SELECT row, side, word, count(*) AS m FROM (SELECT row, side, unnest(words) AS word FROM rows) GROUP BY ALL),
    vocab AS (SELECT word, {_crc_sql('x')} % 10000 AS bucket
              FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM feats)), crc_table),
    counts AS (SELECT bucket, coalesce(sum(m) FILTER (WHERE side = 0), 0) AS s, coalesce(sum(m) FILTER (WHERE side = 1), 0) AS t
               FROM feats JOIN vocab ON vocab.word = feats.word GROUP BY bucket),
    gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM counts) + 10000) AS DOUBLE)
                                            / CAST((s + 1) * ((SELECT sum(t) FROM counts) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counts),
    weights AS (SELECT row, CAST(floor(sum(m * gain) / sum(m)) AS BIGINT) AS weight
                FROM feats JOIN vocab ON vocab.word = feats.word JOIN gains ON gains.bucket = vocab.bucket WHERE side = 0 GROUP BY row),
    scored AS (SELECT id AS doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8)
                                                                       AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
               FROM rows LEFT JOIN weights ON weights.row = rows.row WHERE side = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS r,
                      n_features >= 20 AS able, count(*) FILTER (WHERE n_features >= 20) OVER () * 10 // 100 AS drawn FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND r <= drawn THEN r END AS rank FROM ranked""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = target_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_winnowing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow_prints.compare_with_next(table(spark, sf_dir, "documents"))
