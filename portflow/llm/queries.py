"""The operators as named queries over whole tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from portflow.llm import fixity, language, periodic, secret_scan, toxicity
from portflow.llm.common import ROW, id_hash_mod, read_table, stored, text_or_empty, with_row
from portflow.llm.divergence import source_divergence
from portflow.llm.exact_dedup import exact_duplicates
from portflow.llm.line_dedup import without_boilerplate
from portflow.llm.mixing import mix, taken_words
from portflow.llm.near_dedup import near_classes
from portflow.llm.packing import pack
from portflow.llm.substring_dedup import without_repeats
from portflow.llm.topk import top_products

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(read_table(spark, folder, "documents"), digest_only=True).drop("kept")


def op2_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return top_products(vectors, F.col("vec_id") % 100 == 0).drop("q_row")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"), added_tokens=True)


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = id_hash_mod("doc_id", 3) == 1
    models = language.fit(language.training_rows(docs, ~held_out))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), models)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_row(read_table(spark, folder, "documents"))
    held_out = id_hash_mod("doc_id", 5) == 0
    training = docs.where(~held_out)
    model = toxicity.fit(training, toxicity.labelled_rows(training, read_table(spark, folder, "labels")))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = without_boilerplate(read_table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return taken_words(mix(read_table(spark, folder, "documents"))).drop(ROW)


def op8_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Audit a replica of the archive of all pages; its damage is planted by page_id (see the SQL)."""
    page, data = F.col("page_id"), fixity.record()
    half = data.substr(F.lit(1), F.floor(F.char_length(data) / 2).cast("int"))
    copy = (
        F.when(page % 97 == 11, None).when(page % 101 == 3, half).when(page % 53 == 7, F.concat(data, F.lit("!"))).otherwise(data)
    )
    records = read_table(spark, folder, "pages").select(
        "page_id",
        F.octet_length(data).cast("long").alias("length"),
        fixity.digest(data).alias("digest"),
        F.octet_length(copy).cast("long").alias("copy_length"),
        fixity.digest(copy).alias("copy_digest"),
    )
    archive = stored(fixity.laid_out(records, "page_id", "digest", "length"))
    replica = archive.where("copy_digest is not null").select(
        "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest")
    )
    found = fixity.audit(archive.select("offset", "length", "digest"), replica)
    return found.join(archive.select("page_id", "offset"), "offset").select("page_id", "offset", "length", "status")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(read_table(spark, folder, "documents")).drop(ROW)


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(read_table(spark, folder, "documents")).drop(ROW)


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(read_table(spark, folder, "documents"))


def op12_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.secret_spans(read_table(spark, folder, "documents"))

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda span: span["kind"].isin(*kinds))

    counts = [F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS]
    digest = F.sha2(secret_scan.span_text(of_kinds(*secret_scan.BASE_KINDS)).cast("binary"), 256)
    return found.select(
        "doc_id", *counts, digest.alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the checksum of its id, repeats p of its words from word a on."""
    # The checksum's modulus and shares, which state where words repeat.
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = docs.select("doc_id", text_or_empty().alias("text"), checksum.alias("h")).withColumn("words", words)
    g = F.floor(F.col("h") / 10)
    sized = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    tail = F.col("n") - F.col("a")
    placed = sized.withColumn("p", 1 + F.floor(tail / (3 + g % 8)))
    cycle = F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    repeated = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail.cast("int"))
    whole = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), repeated)
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(planted_periods(read_table(spark, folder, "documents")))
    longest = found.withColumn("longest", periodic.longest_run())
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n"))
    )
    exponent = F.floor(1000 * F.col("longest.length") / F.col("longest.period"))
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"longest.{name}").alias(name) for name in ("start", "length", "period")],
        exponent.alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_packing": op3_packing,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_warc_fixity": op8_warc_fixity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_secret_scans": op12_secret_scans,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_exact_topk": """
        WITH scaled AS (
          SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
          SELECT q.r, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
          FROM scaled q JOIN scaled x ON q.vec_id % 100 = 0 AND q.r <> x.r),
        ranked AS (
          SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
          FROM scores)
        SELECT * FROM ranked WHERE rank <= 10""",
    "op6_line_dedup": r"""
        WITH numbered AS (
          SELECT row_number() OVER () AS r, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines
          FROM documents),
        lines AS (
          SELECT r, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM numbered),
        keyed AS (
          SELECT r, source, pos, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS core FROM lines),
        sites AS (
          SELECT core FROM keyed WHERE length(core) >= 1 GROUP BY core
          HAVING count(DISTINCT coalesce('=' || source, '?')) >= 8),
        judged AS (
          SELECT r, pos, line, core IN (SELECT core FROM sites) AS boilerplate FROM keyed),
        grouped AS (
          SELECT r, count(*) AS n_lines, count(*) FILTER (boilerplate) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT boilerplate), '') AS kept
          FROM judged GROUP BY r)
        SELECT doc_id, n_lines, n_removed, sha256(kept) AS kept_sha256 FROM numbered JOIN grouped USING (r)""",
    "op8_warc_fixity": r"""
        WITH records AS (
          SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
            || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
            || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
            || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS data
          FROM pages),
        laid AS (
          SELECT page_id, strlen(data)::BIGINT AS length,
            (sum(strlen(data)) OVER (ORDER BY page_id NULLS LAST, sha256(data) ROWS UNBOUNDED PRECEDING))::BIGINT
              - strlen(data) AS "offset"
          FROM records)
        SELECT page_id, "offset", length, CASE WHEN page_id % 97 = 11 THEN 'missing' ELSE 'changed' END AS status
        FROM laid WHERE page_id % 97 = 11 OR page_id % 101 = 3 OR page_id % 53 = 7""",
    "op7_mixing": r"""
        WITH sized AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
          FROM documents),
        sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        placed AS (SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS place FROM sources),
        weighted AS (SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS cap
          FROM placed),
        ranked AS (
          SELECT *, (sum(source_size) OVER ())::HUGEINT AS total,
            coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS spent,
            (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS weights_left
          FROM weighted),
        capped AS (SELECT *, (total - spent) * weight >= cap * weights_left AS is_capped FROM ranked),
        rest AS (SELECT sum(CASE WHEN is_capped THEN cap ELSE 0 END)::BIGINT AS used,
            sum(CASE WHEN is_capped THEN 0 ELSE weight END)::BIGINT AS open_weights FROM capped),
        targets AS (
          SELECT source, source_size,
            CASE WHEN is_capped THEN cap::DOUBLE
              ELSE ((total - used) * weight)::DOUBLE / open_weights::DOUBLE END AS target
          FROM capped, rest),
        laid AS (
          SELECT doc_id, s.source, size, source_size, target, round(target)::BIGINT AS quota,
            sum(size) OVER (PARTITION BY s.source ORDER BY sha256('mix-1:' || coalesce(doc_id::VARCHAR, '')),
              doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
          FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
          CASE WHEN size = 0 THEN 0 ELSE (quota // source_size) * size
            + greatest(0, least(start + size, quota % source_size) - start) END::BIGINT AS taken
        FROM laid""",
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op11_source_divergence": r"""
        WITH texts AS (
          SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
          FROM documents),
        terms AS (
          SELECT r, lang, source,
            translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
          FROM texts),
        kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        sources AS (SELECT DISTINCT lang, source FROM texts),
        counted AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
        filled AS (
          SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
          FROM sources s JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
        overall AS (SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term),
        shares AS (
          SELECT lang, source, term, n,
            (1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER (PARTITION BY lang, source)) + 5 * v)::HUGEINT)::BIGINT AS p
          FROM filled JOIN sizes USING (lang)),
        whole AS (
          SELECT lang, term,
            (1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER (PARTITION BY lang)) + 5 * v)::HUGEINT)::BIGINT AS q
          FROM overall JOIN sizes USING (lang)),
        apart AS (
          SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM shares a JOIN shares b USING (lang, term) GROUP BY a.lang, a.source, b.source),
        pairs AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
          FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
        rises AS (
          SELECT lang, source, 'term' AS part, term AS item, p - q AS value
          FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part
            ORDER BY value DESC, item COLLATE "C")::INT AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM rises))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op12_secret_scans": r"""
        WITH patterns(kind, place, pattern) AS (VALUES
          ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
          ('access', 1, 'AKIA[A-Z0-9]+'),
          ('hex', 2, '[0-9a-f]+'),
          ('entropy_hex', 3, '[0-9A-Fa-f]{24,}'),
          ('entropy_upper', 4, '[0-9A-Z]{24,}'),
          ('entropy_base64', 5, '[0-9A-Za-z+/_-]{24,}'),
          ('allowed', 6, '[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}'),
          ('allowed', 7, 'https?://[0-9A-Za-z.:/_~%+@-]+'),
          ('allowed', 8, '(sha1|sha256|sha384|sha512|md5)[:-][0-9A-Za-z+/=]+'),
          ('allowed', 9, 'data:image/[a-z.+-]+;base64,[0-9A-Za-z+/=]+'),
          ('allowed', 10, '[0-9A-Za-z+/_-]*(EXAMPLE|example|PLACEHOLDER|placeholder)[0-9A-Za-z+/_-]*')),
        docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        split AS (
          SELECT r, kind, place, regexp_extract_all(t, pattern) AS hits, string_split_regex(t, pattern) AS gaps
          FROM docs, patterns),
        listed AS (
          SELECT r, kind, place, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, unnest(range(len(hits))) AS i FROM split),
        placed AS (
          SELECT r, kind, place, hit, (sum(length(gap) + length(hit)) OVER so_far)::BIGINT AS stop
          FROM listed WINDOW so_far AS (PARTITION BY r, place ORDER BY i ROWS UNBOUNDED PRECEDING)),
        base AS (
          SELECT r, kind, place, stop - length(hit) AS start, stop FROM placed
          WHERE kind = 'assign' AND length(regexp_extract(hit, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6
            OR kind = 'access' AND length(hit) >= 20 OR kind = 'hex' AND length(hit) >= 24),
        windows AS (
          SELECT r, kind, place, stop - length(hit) AS start, hit, unnest(range(length(hit) - 23)) AS w FROM placed
          WHERE kind IN ('entropy_hex', 'entropy_upper', 'entropy_base64')),
        chars AS (
          SELECT r, kind, place, start, w, substr(hit, (w + j + 1)::INT, 1) AS c, count(*) AS n
          FROM windows, range(24) AS steps(j) GROUP BY ALL),
        random AS (
          SELECT r, kind, place, start, w FROM chars GROUP BY ALL
          HAVING sum(round(n * log2(n) * 1048576)) <= floor(24 * (log2(24) - CASE kind WHEN 'entropy_hex' THEN 3.0
                WHEN 'entropy_upper' THEN 3.5 ELSE 4.0 END) * 1048576)
            AND bool_or(regexp_matches(c, '[0-9]')) AND bool_or(regexp_matches(c, '[A-Za-z]'))),
        marked AS (
          SELECT *, CASE WHEN w <= lag(w) OVER (PARTITION BY r, place, start ORDER BY w) + 24 THEN 0 ELSE 1 END AS opens
          FROM random),
        islands AS (SELECT *, sum(opens) OVER (PARTITION BY r, place, start ORDER BY w) AS island FROM marked),
        added AS (
          SELECT r, kind, place, start + min(w) AS start, start + max(w) + 24 AS stop
          FROM islands GROUP BY r, kind, place, islands.start, island),
        covers AS (
          SELECT r, start, stop FROM base
          UNION ALL SELECT r, stop - length(hit), stop FROM placed WHERE kind = 'allowed'),
        spans AS (
          SELECT r, kind, place, start, stop FROM base
          UNION ALL SELECT r, kind, place, start, stop FROM added a
          WHERE NOT EXISTS (SELECT 1 FROM covers c WHERE c.r = a.r AND c.start <= a.start AND a.stop <= c.stop)),
        joined AS (
          SELECT r, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
            count(*) FILTER (place = 2) AS n_hex,
            string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, place) FILTER (place < 3) AS base,
            string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, place) AS spans
          FROM spans GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
          sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN joined USING (r)""",
}
