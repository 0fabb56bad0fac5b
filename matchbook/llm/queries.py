"""The operators bound to the given tables, with production parameters; each query next to its SQL, if any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.bindings.registry import Registry
from matchbook.llm import blockmax, language, linededup, mixing, negatives, ngrams, parsing, pieces, pii, revisits, simhash, spelling, toxicity
from matchbook.sources.tables import table

REGISTRY = Registry()
_add = REGISTRY.add


def sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


@_add(None)
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_add(None)
def op2_phrase_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.against_next(table(spark, folder, "documents"))


@_add(None)
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = toxicity.held_out()
    machine = toxicity.train(docs, table(spark, folder, "labels"), usable=~out)
    scored = toxicity.score(docs, machine)
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    )


def _listed(spans: F.Column) -> F.Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


@_add(None)
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin("email", "ip", "card", "phone"))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        sha256(_listed(base)).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@_add(
    r"""WITH p AS (SELECT page_id, page_id % 10 AS digit, 10 * page_id AS taken_at, sha256(html) AS payload_sha256,
            length(html)::BIGINT AS n, '"' || md5(html) || '"' AS tag, 'day ' || floor(page_id / 7)::BIGINT AS day,
            CASE WHEN page_id % 10 = 5 THEN 10 * page_id - 1 ELSE 10 * page_id + 5 + page_id * 7919 % 200003 END AS later,
            regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
        q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT
                regexp_matches(lower(x), '^(utm_[a-z]+|fbclid|gclid|sessionid|phpsessid)(=|$)'))) AS kept FROM p),
        s AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^(?:[^/?@]*@)?([^/?]*)', 1)), '^www[0-9]?\.', ''),
                ':(80|443)$', '') || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
                || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS site FROM q),
        f AS (SELECT site, taken_at, arg_max(s, page_id) AS hit FROM s GROUP BY site, taken_at),
        r AS (SELECT s.*, f.hit, CASE WHEN f.site IS NULL THEN 'missing' WHEN digit = 3 THEN 'unchecked'
                WHEN digit = 7 THEN CASE WHEN hit.day = s.day THEN 'resolved' ELSE 'mismatch' END
                WHEN hit.tag = s.tag THEN 'resolved' ELSE 'mismatch' END AS outcome
            FROM s ASOF LEFT JOIN f ON s.site = f.site AND s.later > f.taken_at)
    SELECT page_id AS record_id, site, taken_at AS captured_at, 'response' AS kind, 'full' AS outcome, page_id AS ref_id,
        payload_sha256, n AS payload_chars, 'cache-control=max-age=60;content-length=' || n
        || ';content-type=text/html;etag=' || tag || ';last-modified=' || day AS headers FROM s
    UNION ALL
    SELECT page_id, site, later, 'revisit', outcome, CASE WHEN outcome = 'resolved' THEN hit.page_id END,
        CASE WHEN outcome = 'resolved' THEN hit.payload_sha256 END, CASE WHEN outcome = 'resolved' THEN hit.n END,
        'cache-control=max-age=600;content-length=' || CASE WHEN outcome = 'resolved' THEN hit.n || ';content-type=text/html'
        ELSE '0' END || ';date=' || later
        || CASE WHEN outcome = 'resolved' AND digit = 7 THEN ';etag=' || hit.tag WHEN digit IN (3, 7) THEN '' ELSE ';etag=W/' || tag END
        || CASE WHEN digit = 3 THEN '' ELSE ';last-modified=' || day END FROM r"""
)
def op5_revisits(spark: SparkSession, folder: str) -> DataFrame:
    records = revisits.captures(table(spark, folder, "pages"))
    resolved = revisits.resolve(records, carry=("payload_sha256", "payload_chars"))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return resolved.withColumn("headers", F.array_join(fields, ";"))


@_add(None)
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", *token_digests())


@_add(None)
def op7_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return ngrams.score(docs, toxicity.held_out(5, 1))


@_add(None)
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "pages"), language.train(table(spark, folder, "documents")))


@_add(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
)
def op9_block_max_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return blockmax.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def token_digests() -> list[F.Column]:
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    ]


@_add(
    r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
            md5('42:' || coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(text, '')))) AS h FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
        w AS (SELECT source, n, ((r - 1) % 3 + 1)::BIGINT AS w FROM s),
        -- The clamped sources are those with the fewest words for their weight: try each number of them.
        c AS (SELECT *, sum(w) OVER all_rows - sum(w) OVER up_to AS free, sum(n) OVER all_rows - 3 * sum(n) OVER up_to AS rest,
                3 * n / w::DOUBLE AS full_at FROM w
            WINDOW all_rows AS (), up_to AS (ORDER BY 3 * n / w::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
        levels AS (SELECT sum(n)::DOUBLE / sum(w) AS level, -1.0::DOUBLE AS after FROM w
            UNION ALL SELECT rest::DOUBLE / free, full_at FROM c WHERE free > 0),
        best AS (SELECT max(level) AS level FROM levels WHERE level >= after),
        t AS (SELECT w.source, n, least(level * w, 3.0::DOUBLE * n) AS target FROM w, best),
        g AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS whole FROM t),
        m AS (SELECT d.doc_id, d.size, g.n AS source_size, g.target, g.whole, round(g.target)::BIGINT - g.whole * g.n AS rest,
            coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past
            FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, rest - past)))::BIGINT AS taken FROM m"""
)
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@_add(None)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.grouped(table(spark, folder, "documents"), modulus=199)


@_add(
    """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL
            AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
            FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, p.vec_id AS positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id,
        p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n USING (anchor_id) WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    WINDOW w AS (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 5"""
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", flipped), F.col("vec_id") % 100 == 0)


@_add(
    r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
        l AS (SELECT r, doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        m AS (SELECT k.*, f.first IS NOT NULL AND f.first <> k.doc_id AS dropped FROM k LEFT JOIN f ON k.key = f.key)
    SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM m GROUP BY r, doc_id"""
)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = sha256(linededup.kept_text()).alias("kept_sha256")
    return linededup.with_bitmaps(docs).select("doc_id", "n_lines", "n_dropped", kept)
