"""The registered queries of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import (
    crf, decontaminate, line_dedup, neighbours, packing, piecewise, quality_rules, resampling, sharding, simhash, spelling,
    suffix_dedup, warc,
)
from sessionlake.llm.registry import ORACLES, QUERIES, table
from sessionlake.workspace import materialize, scratch


#: crc32 of a list of bytes ``b``, from a table ``tab`` made by the rule of its polynomial.
_CRC_TABLE = """
    tab AS (
        SELECT list(c ORDER BY i) AS tab FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(256)) AS i)))"""
_CRC = """xor(list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295)"""
_BYTES = "[CAST(('0x' || h[2 * i + 1:2 * i + 2]) AS BIGINT) FOR i IN range(len(h) // 2)]"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_kd_shards")
def kd_shards(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return sharding.shard(table(spark, sf, "documents"), shards=8)


@query("op2_quality_rules")
def rated(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with their statistics and the verdict of the rules and the forest."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    forest = quality_rules.fit_on_labels(docs, table(spark, sf, "labels"))
    return quality_rules.rate(docs, forest, drop=("text",)).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "anomaly")


@query("op3_packing")
def packed(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as pieces of binary length."""
    import public_tokenizers

    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def _remainder(n: int) -> Column:
    """crc32 of doc_id as text, by ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op4_quality_neighbours")
def voted(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with the quality their labelled neighbours vote for; a third of the ids is held out."""
    docs, held_out = table(spark, sf, "documents").select("doc_id", "text"), F.coalesce(_remainder(3) == 1, F.lit(False))
    voters = neighbours.fit_on_labels(docs, table(spark, sf, "labels"), ~held_out)
    return neighbours.vote(docs, voters, drop=("text",)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(
    "op5_decontamination",
    r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    i AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, least(10, len(words)) AS size,
               unnest([array_to_string(words[k:k + least(10, len(words)) - 1], ' ')
                       FOR k IN range(1, len(words) - least(10, len(words)) + 2)]) AS win
        FROM i WHERE len(words) > 0),
    sizes AS (SELECT DISTINCT size FROM win),
    shown AS (
        SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS k,
               unnest([array_to_string(words[j:j + size - 1], ' ') FOR j IN range(1, len(words) - size + 2)]) AS win
        FROM w, sizes WHERE len(words) >= size),
    found AS (SELECT doc_id, shown.size, k, item_id FROM shown JOIN win USING (size, win)),
    hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY 1),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def decontaminated(spark: SparkSession, sf: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, table(spark, sf, "benchmark"), drop=("text",))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query(
    "op6_suffix_dedup",
    """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    w AS (
        SELECT doc_id, p, md5(b[p:p + 199]) AS h
        FROM (SELECT doc_id, b, unnest(range(1, n - 198)) AS p FROM d WHERE n >= 200)),
    s AS (SELECT doc_id, p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
    g AS (
        SELECT doc_id, p, sum(is_first) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS is_first FROM s)),
    r AS (SELECT doc_id, min(p) AS a, max(p) + 199 AS z FROM g GROUP BY doc_id, run),
    k AS (
        SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS f, a - 1 AS t FROM r
        UNION ALL
        SELECT doc_id, coalesce(max(z), 0) + 1, n FROM d LEFT JOIN r USING (doc_id) GROUP BY doc_id, n),
    cut AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(z - a + 1) AS BIGINT) AS n_removed FROM r GROUP BY 1),
    kept AS (SELECT doc_id, string_agg(hex(b[f:t]), '' ORDER BY f) AS x FROM k JOIN d USING (doc_id) WHERE t >= f GROUP BY 1)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(x, ''))) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
)
def without_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the bytes of strings that repeat."""
    cut = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op7_line_dedup",
    r"""
    WITH l AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i
        FROM documents),
    o AS (
        SELECT *, row_number() OVER (ORDER BY doc_id, i) AS ord, length(line) AS n
        FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    first AS (SELECT line, min(ord) AS ord, any_value(n) AS n FROM o GROUP BY 1),
    half AS (
        SELECT line, ord, n, h, 'first' AS side, substr(line, 1, h) AS part
        FROM (SELECT *, unnest([n // 2, (n - 1) // 2]) AS h FROM first WHERE n >= 20)
        UNION
        SELECT line, ord, n, h, 'last', substr(line, n - h + 1)
        FROM (SELECT *, unnest([(n + 1) // 2, n // 2]) AS h FROM first WHERE n >= 20)),
    pairs AS (
        SELECT DISTINCT x.line AS a, y.line AS b, x.n AS n, y.n AS m
        FROM half x JOIN half y USING (side, h, part) WHERE y.ord < x.ord AND abs(x.n - y.n) <= 1),
    near AS (
        SELECT DISTINCT a FROM pairs WHERE list_bool_or([
            substr(a, 1, p) = substr(b, 1, p) AND CASE
                WHEN n = m THEN substr(a, p + 2) = substr(b, p + 2)
                WHEN n > m THEN substr(a, p + 2) = substr(b, p + 1)
                ELSE substr(a, p + 1) = substr(b, p + 2) END
            FOR p IN range(0, greatest(n, m))])),
    kept AS (
        SELECT o.*, near.a IS NOT NULL AS is_near, o.ord <> first.ord AND near.a IS NULL AS is_copy
        FROM o JOIN first USING (line) LEFT JOIN near ON near.a = o.line),
    marked AS (
        SELECT l.doc_id, l.line, l.i, coalesce(is_near, false) AS is_near, coalesce(is_copy, false) AS is_copy
        FROM l LEFT JOIN kept USING (doc_id, i))
    SELECT d.doc_id, count(m.line) AS n_lines, count(*) FILTER (WHERE is_copy) AS n_copies,
           count(*) FILTER (WHERE is_near) AS n_near,
           sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.i) FILTER (WHERE NOT is_near AND NOT is_copy), '')) AS kept_sha256
    FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id
    """,
)
def without_lines(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without lines that repeat earlier ones, exactly or but for one edit."""
    left = line_dedup.remove_lines(table(spark, sf, "documents"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return left.select("doc_id", "n_lines", "n_copies", "n_near", F.sha2(text, 256).alias("kept_sha256"))


@query(
    "op8_warc",
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest
        FROM pages),
    f AS (
        SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
    """,
)
def warc_records(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written as archive files, and what is read back of them."""
    archives = warc.write_archives(warc.with_revisits(table(spark, sf, "pages")))
    folder = scratch(spark, "archives")
    materialize(warc.write_files(archives, folder), "written")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    records = warc.read_archives(files, "path", "content")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_simhash")
def near_groups(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with fingerprint and component."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@query("op10_language_id")
def identified(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with their language; a fifth of the ids is held out."""
    docs, held_out = table(spark, sf, "documents"), F.coalesce(_remainder(5) == 0, F.lit(False))
    model = crf.fit_on_documents(docs, ~held_out)
    named = crf.identify(docs.select("doc_id", "text"), model, drop=("text",))
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op11_piecewise")
def piecewise_hashed(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with their piecewise hash, against their edited text and the next document."""
    return piecewise.against_next(table(spark, sf, "documents"))


@query(
    "op12_spelling",
    rf"""
    WITH {_CRC_TABLE},
    runs AS (
        SELECT doc_id, run, count(*) AS c FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents WHERE text IS NOT NULL)
        WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (
        SELECT run, c, {_CRC.format(bytes=_BYTES)} AS h
        FROM (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs), tab),
    words AS (
        SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
            SELECT c, CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
        WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
    cut AS (
        SELECT DISTINCT word, n, size, unnest([word[1:i] || word[i + 2:] FOR i IN range(size)]) AS part, unnest(range(size)) AS i
        FROM (SELECT *, length(word) AS size FROM words)),
    pairs AS (
        SELECT DISTINCT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
        UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = cut.part
        UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = cut.part),
    near AS (
        SELECT x AS word, count(*) AS n_near, first(y ORDER BY w.n DESC, encode(y)) AS best, max(w.n) AS best_n
        FROM pairs JOIN words w ON w.word = y GROUP BY 1),
    forms AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
               CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
        FROM words LEFT JOIN near USING (word)),
    chain AS (
        WITH RECURSIVE c AS (
            SELECT word, form AS further, 1 AS depth FROM forms WHERE form IS NOT NULL
            UNION ALL SELECT c.word, f.form, depth + 1 FROM c JOIN forms f ON f.word = c.further WHERE f.form IS NOT NULL)
        SELECT word, arg_max(further, depth) AS root FROM c GROUP BY 1)
    SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN chain USING (word)
    """,
)
def spelled(spark: SparkSession, sf: str) -> DataFrame:
    """All words of the documents, some with a deletion, with their near words and frequent forms."""
    found = spelling.group_variants(table(spark, sf, "documents"), spelling.with_deletions(31))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query(
    "op13_resampling",
    rf"""
    WITH {_CRC_TABLE},
    own AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    s_words AS (SELECT r, unnest(words) AS w FROM own),
    t_words AS (
        SELECT unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
        FROM benchmark),
    bucket AS (
        SELECT w, {_CRC.format(bytes=_BYTES)} % 10000 AS b
        FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM s_words UNION SELECT w FROM t_words)), tab),
    s AS (SELECT b, count(*) AS s FROM s_words JOIN bucket USING (w) GROUP BY 1),
    t AS (SELECT b, count(*) AS t FROM t_words JOIN bucket USING (w) GROUP BY 1),
    al AS (SELECT (SELECT count(*) FROM s_words) AS big_s, (SELECT count(*) FROM t_words) AS big_t),
    gain AS (
        SELECT b, CAST(floor(1000 * ln(
            (CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(big_s + 10000 AS DOUBLE)) / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(big_t + 10000 AS DOUBLE)))) AS BIGINT) AS g
        FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN t USING (b), al),
    weighed AS (
        SELECT r, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight
        FROM s_words JOIN bucket USING (w) JOIN gain USING (b) GROUP BY 1),
    scored AS (
        SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
            (CAST(('0x' || sha256('2024:' || CAST(doc_id AS VARCHAR))[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM own LEFT JOIN weighed USING (r)),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
    """,
)
def resampled(spark: SparkSession, sf: str) -> DataFrame:
    """All documents weighed by their likeness to the benchmark's words, and the tenth that is drawn."""
    found = resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
