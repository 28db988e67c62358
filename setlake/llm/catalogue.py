"""The registered queries of this subpackage: each applies an operator to its whole table.

The queries only derive digest columns; the operators keep their own interfaces and real outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlake.llm import arrow_files, bpe, collocations, exact_dedup, langid, line_dedup, media, mixing, packing, secrets, simhash, spelling, substring_dedup
from setlake.llm.common import materialise

#: Vocabulary files; any files of the same kinds can be given to the operators.
TOKENIZER_JSON, TOKENIZER_RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeated_lines(_documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(_documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), TOKENIZER_JSON)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir), TOKENIZER_RANKS, public_tokenizers.PATTERN)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_files.round_trip(_documents(spark, sf_dir), TOKENIZER_JSON)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    profiles = langid.learn(docs, ~langid.held_out())
    return langid.identify(docs, profiles).withColumn("held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def secret_base_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the secret scan that SQL can express: those of the base kinds."""
    return op9_secret_scan(spark, sf_dir).drop("spans")


def op10_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no images, so each vector is drawn as one, and a quarter of the images get an edited copy that is to be found."""
    images = materialise(media.with_edits(media.render_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))), "images")
    return media.copy_classes(images)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(_documents(spark, sf_dir))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(_documents(spark, sf_dir)).withColumn("taken", F.col("copies") * F.col("size"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir), thin=199)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_substring_dedup, op3_simhash, op4_best_fit_packing, op5_byte_bpe, op6_token_files, op7_language_id, op8_exact_dedup, op9_secret_scan, op10_media_copies, op11_collocations, op12_source_mix, op13_spelling_variants, secret_base_kinds)}


#: The base kinds of secrets in RE2's syntax, letters of credential words in either case.
_WORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = _WORD + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SPANS = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {i} AS ord, ms[i] AS m, list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d), unnest(range(1, len(ms) + 1)) AS r(i)"""
    for i, (kind, pattern) in enumerate((("assign", _ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]{16,}")))
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": r"""
            WITH s AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
            ln AS (SELECT doc_id, p AS line, ls[p] AS t FROM s, unnest(range(1, len(ls) + 1)) AS r(p)),
            k AS (SELECT doc_id, line, ws, len(ws) AS n, array_to_string(ws, ' ') AS f, {'d': doc_id, 'l': line} AS spot
                  FROM (SELECT doc_id, line, regexp_extract_all(t, '[^\x20\x09\x0B\x0C\x0D]+') AS ws FROM ln) WHERE len(ws) > 0),
            fulls AS (SELECT f, min(spot) AS earliest FROM k GROUP BY f),
            v AS (SELECT spot, n, p, array_to_string(list_concat(ws[:p - 1], ws[p + 1:]), ' ') AS rest FROM k, unnest(range(1, n + 1)) AS r(p) WHERE n >= 4),
            gaps AS (SELECT n, p, rest, min(spot) AS earliest FROM v GROUP BY n, p, rest),
            longer AS (SELECT rest, min(spot) AS earliest FROM v GROUP BY rest),
            late AS (SELECT spot FROM k JOIN fulls USING (f) WHERE spot > earliest
                     UNION SELECT v.spot FROM v JOIN gaps g USING (n, p, rest) WHERE n >= 5 AND v.spot > g.earliest
                     UNION SELECT v.spot FROM v JOIN fulls ON fulls.f = v.rest WHERE v.n >= 5 AND v.spot > fulls.earliest
                     UNION SELECT k.spot FROM k JOIN longer ON longer.rest = k.f WHERE k.n >= 5 AND k.spot > longer.earliest),
            gone AS (SELECT spot.d AS doc_id, list(spot.l) AS ps FROM late GROUP BY 1)
            SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE len(ls) END AS n_lines, coalesce(len(ps), 0) AS n_removed,
                   sha256(array_to_string(CASE WHEN ps IS NULL THEN ls ELSE list_filter(ls, lambda x, i: NOT list_contains(ps, i)) END, chr(10))) AS kept_sha256
            FROM s LEFT JOIN gone USING (doc_id)""",
        "op2_substring_dedup": r"""
            WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
            win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k FROM w, unnest(range(1, len(ws) - 18)) AS t(s)),
            late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
            gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM late, unnest(range(s, s + 20)) AS t(p) GROUP BY doc_id)
            SELECT doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
                   sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
            FROM w LEFT JOIN gone USING (doc_id)""",
        "op11_collocations": r"""
            WITH t AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
            pieces AS (SELECT d, lang, unnest(string_split_regex(x, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
            ws AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
            total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM ws GROUP BY lang),
            f AS (SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS f FROM ws, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS r(i) GROUP BY ALL HAVING count(*) >= 100),
            cand AS (SELECT * FROM f WHERE k >= 2),
            gone AS (SELECT DISTINCT c.lang, c.p FROM (SELECT lang, f, k, unnest([p[1:k - 1], p[2:k]]) AS p FROM cand) AS q JOIN cand AS c ON c.lang = q.lang AND c.p = q.p WHERE 100 * q.f >= 100 * c.f),
            cuts AS (SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, t.n, cut, CAST((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
                     FROM cand AS c ANTI JOIN gone USING (lang, p) JOIN total AS t USING (lang), unnest(range(1, c.k)) AS s(cut), f AS x, f AS y
                     WHERE x.lang = c.lang AND x.p = c.p[1:cut] AND y.lang = c.lang AND y.p = c.p[cut + 1:c.k]),
            low AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS o FROM cuts),
            ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM low WHERE o = 1)
            SELECT * FROM ranked WHERE rank <= 2000""",
        "secret_base_kinds": f"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({_SPANS}),
            kept AS (SELECT * FROM s WHERE kind = 'hex' OR (kind = 'access' AND length(m) >= 18) OR (kind = 'assign' AND length(regexp_extract(m, '^{_ASSIGN}$', 1)) >= 12)),
            c AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
                         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(m) AS BIGINT), ',' ORDER BY start, ord) AS spans FROM kept GROUP BY doc_id)
            SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256
            FROM d LEFT JOIN c USING (doc_id)""",
        "op8_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    }
