"""Registered queries of the package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyloom.llm import fingerprints, fixity, jaccard, langid, lexical, licenses, manifest, mixing, nearest, packing, pieces, secrets, token_counts
from replyloom.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_language_id(spark, sf):
    documents = table(spark, sf, "documents")
    models = langid.fit(documents.filter(langid.training_fold(F.col("doc_id"))).select("doc_id", "text", "lang"))
    held = (~langid.training_fold(F.col("doc_id"))).alias("held_out")
    return langid.predict(documents.select("doc_id", held, "text"), models).drop("text")


@query
def op2_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


@query
def op3_secret_scan(spark, sf):
    return secrets.digest(table(spark, sf, "documents"))


def _matches(number: int, rule: secrets.Rule) -> str:
    """Matches of one rule with the lengths around them, from the gaps between them and the matches themselves."""
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, text, {number} AS rule, '{rule.kind}' AS kind, generate_subscripts(hits, 1) AS i,
    length(unnest(gaps[:len(hits)])) AS gap, length(unnest(hits)) AS hit, length(unnest(tested)) >= {rule.least} AS kept
  FROM (SELECT doc_id, text, string_split_regex(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}) AS hits,
          regexp_extract_all(text, {pattern}, {rule.group}) AS tested FROM d)"""


ORACLES["op3_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
m AS ({" UNION ALL ".join(_matches(n, r) for n, r in enumerate(secrets.RULES))}),
s AS (
  SELECT *, sum(gap + hit) OVER (PARTITION BY doc_id, rule ORDER BY i) AS stop FROM m),
k AS (SELECT doc_id, rule, stop - hit AS start, kind || ':' || (stop - hit) || ':' || stop AS span FROM s WHERE kept)
SELECT d.doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
  count(*) FILTER (rule = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rule) FILTER (rule < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""


@query
def op4_ngram_jaccard(spark, sf):
    return jaccard.jaccard_components(table(spark, sf, "documents"))


ORACLES["op4_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(shingle) AS h1, md5(shingle) AS h2 FROM (
    SELECT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
    FROM w, range(1, greatest(len(words) - 3, 1) + 1) r(i) WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.h1 = b.h1 AND a.h2 = b.h2 AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) c USING (doc_id)
"""


@query
def op5_exact_top_k(spark, sf):
    return nearest.top_k(table(spark, sf, "embeddings"))


ORACLES["op5_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.n ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id NULLS LAST)::INT AS rank,
  c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
FROM v q JOIN v c ON q.n <> c.n AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20
"""


@query
def op6_token_counts(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.token_counts(documents, tokenizer_path("piece_bpe_32k.model"))


@query
def op7_document_fingerprints(spark, sf):
    return fingerprints.fingerprints(table(spark, sf, "documents"))


@query
def op8_source_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op8_source_mix"] = r"""
WITH m AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    length(regexp_replace(text, '[^\p{L}\x20\x09-\x0D]+', '', 'g')) / nullif(length(text), 0)::DOUBLE AS plain,
    (('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 1) / 4503599627370497.0::DOUBLE AS u
  FROM documents),
d AS (SELECT doc_id, source, size, -ln(u) / greatest(coalesce(plain * plain, 0), 0.05::DOUBLE) AS key FROM m),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source),
f AS (
  -- A source is full when all the sources as soon full as it, or sooner, leave the others this much by weight.
  SELECT *, sum(most) OVER (ORDER BY most / w) * w + most * (sum(w) OVER () - sum(w) OVER (ORDER BY most / w)) <= budget * w AS is_full
  FROM (SELECT *, 2.0::DOUBLE * source_size AS most, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s)),
t AS (
  SELECT source, source_size, least(w * (SELECT (max(budget) - coalesce(sum(most) FILTER (is_full), 0)) / sum(w) FILTER (NOT is_full)
                                         FROM f), most) AS target
  FROM f),
e AS (
  SELECT doc_id, size, key, d.source, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS running FROM e)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (epochs + CASE WHEN 2 * running - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""


@query
def op9_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op10_warc_fixity(spark, sf):
    """The second replica has single damaged characters, truncated records and records that are missing."""
    pages = table(spark, sf, "pages")
    html, page = F.col("html"), F.col("page_id")
    damaged = (
        F.when(page % 97 == 5, F.concat(F.lit("#"), F.substr(html, F.lit(2))))
        .when(page % 1013 == 11, F.substr(html, F.lit(1), F.floor(F.char_length(html) / 2).cast("int")))
        .otherwise(html)
    )
    digest, length = fixity.fixity(fixity.record(F.col("url"), html))
    replica_digest, replica_length = fixity.fixity(fixity.record(F.col("url"), damaged))
    records = pages.select(
        "page_id",
        digest.alias("digest"),
        length.alias("length"),
        F.when(F.coalesce(page % 1511 != 3, F.lit(True)), replica_digest).alias("replica_digest"),
        replica_length.alias("replica_length"),
    )
    placed = materialize(fixity.laid_out(materialize(records), ["page_id", "digest"]))
    return fixity.audited(placed).select("page_id", "file", "place", "start", "length", "digest", "status")


ORACLES["op10_warc_fixity"] = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    coalesce(CASE WHEN page_id % 97 = 5 THEN '#' || substr(html, 2)
                  WHEN page_id % 1013 = 11 THEN substr(html, 1, length(html) // 2) ELSE html END, '') AS other
  FROM pages),
r AS (
  SELECT page_id,
    E'WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: ' || url || E'\r\nContent-Length: ' || strlen(html)
      || E'\r\n\r\n' || html || E'\r\n\r\n' AS a,
    CASE WHEN coalesce(page_id % 1511, 0) <> 3 THEN
      E'WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: ' || url || E'\r\nContent-Length: ' || strlen(other)
        || E'\r\n\r\n' || other || E'\r\n\r\n' END AS b
  FROM p),
h AS (SELECT page_id, sha256(a) AS digest, strlen(a) AS length, sha256(b) AS replica, coalesce(strlen(b), 0) AS other FROM r),
n AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, digest) - 1 AS n FROM h),
o AS (
  SELECT *, n // 512 AS file, n % 512 AS place,
    sum(length) OVER (PARTITION BY n // 512 ORDER BY n) - length AS start,
    sum(other) OVER (PARTITION BY n // 512 ORDER BY n) - other AS other_start
  FROM n)
SELECT page_id, file::BIGINT AS file, place::BIGINT AS place, start::BIGINT AS start, length::BIGINT AS length, digest,
  CASE WHEN replica IS NULL THEN 'missing' WHEN replica <> digest THEN 'changed' WHEN start <> other_start THEN 'moved' ELSE 'ok' END AS status
FROM o
"""


@query
def op11_merkle_manifest(spark, sf):
    """Every second document, by CRC-32 of its id, is found again without its line breaks."""
    documents = table(spark, sf, "documents")
    text = F.col("text")
    broken = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(broken, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    own, found = (manifest.leaf("doc_id", "source", "lang", "n_chars", t) for t in (text, now))
    return manifest.manifest(documents, own, found)


def _merkle_levels(name: str, start: str, levels: int) -> str:
    """Nodes of a tree level by level (g, i, h, n); groups that are down to one node keep it."""
    out = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT g, i // 3 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h, (max(n) + 2) // 3 AS n
  FROM {name}{k} GROUP BY g, i // 3)""")
    return ",\n".join(out)


def _merkle_steps(name: str, levels: int) -> str:
    """(g, i, k, step): the slot of a leaf's ancestor in level k and the digests beside it."""
    return "\n  UNION ALL ".join(
        f"""SELECT a.g, a.i, {k} AS k, (a.i // {3**k} % 3) || coalesce(string_agg(b.h, '' ORDER BY b.i), '') AS step
    FROM {name}0 a JOIN {name}{k} c ON c.g = a.g AND c.i = a.i // {3**k} AND c.n > 1
      LEFT JOIN {name}{k} b ON b.g = c.g AND b.i // 3 = c.i // 3 AND b.i <> c.i GROUP BY a.g, a.i"""
        for k in range(levels)
    )


#: Levels that the SQL writes out: up to 3^10 documents a source, and as many sources.
_LEVELS = 10
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {0})"
ORACLES["op11_merkle_manifest"] = f"""
WITH d AS (
  SELECT *, row_number() OVER () AS r,
    list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT),
      lambda crc, c: list_reduce([xor(crc, c)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda x, z: xor(x >> 1, (x & 1::UBIGINT) * 3988292384))) AS crc
  FROM documents),
l AS (
  SELECT r, doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN {_LEAF.format(_FIELD.format("replace(text, chr(10), '')"))}
         ELSE {_LEAF.format(_FIELD.format("text"))} END AS found
  FROM d),
p AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
{_merkle_levels("a", "SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM p", _LEVELS)},
{_merkle_levels("b", f"SELECT 0 AS g, g AS i, h, count(*) OVER () AS n FROM a{_LEVELS}", _LEVELS)},
s AS MATERIALIZED (
  SELECT p.r, s.k, s.step FROM p JOIN ({_merkle_steps("a", _LEVELS)}) s ON s.g = p.g AND s.i = p.i
  UNION ALL
  SELECT p.r, 100 + s.k, s.step FROM p JOIN ({_merkle_steps("b", _LEVELS)}) s ON s.i = p.g),
t AS (SELECT r, list(step ORDER BY k) AS steps FROM s GROUP BY r),
f AS (
  SELECT p.*, coalesce(steps, []) AS steps,
    list_reduce([found] || coalesce(steps, []), lambda acc, x: sha256(substr(x, 2, 64 * substr(x, 1, 1)::INT) || acc
      || substr(x, 2 + 64 * substr(x, 1, 1)::INT))) AS folded_root
  FROM p LEFT JOIN t USING (r))
SELECT doc_id, leaf, a{_LEVELS}.h AS subroot, b{_LEVELS}.h AS root,
  sha256(coalesce(list_aggregate(list_transform(steps, lambda x: substr(x, 2)), 'string_agg', ''), '')) AS proof_sha256, folded_root,
  folded_root = b{_LEVELS}.h AS verified
FROM f JOIN a{_LEVELS} ON a{_LEVELS}.g = f.g CROSS JOIN b{_LEVELS}
"""


@query
def op12_sentencepiece(spark, sf):
    return pieces.coded_digests(table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op13_lexical_search(spark, sf):
    return lexical.ranked_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op13_lexical_search"] = r"""
WITH t AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS r FROM documents)),
f AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS MATERIALIZED (SELECT r, sum(tf)::BIGINT AS n FROM f GROUP BY r),
g AS MATERIALIZED (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM n),
w AS MATERIALIZED (
  SELECT term, floor(1000 * ln(((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY term, docs),
q AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)),
s AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // len))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (r), g GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM s QUALIFY rank <= 10
"""
