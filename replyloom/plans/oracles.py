"""DuckDB SQL for the registered queries, written over the same tables.

Each statement is a list of common table expressions and a final SELECT. RE2 has no look-around and its
``\\b`` is ASCII, which gives the same answers on these tables.
"""

from __future__ import annotations

from replyloom.functions.text import (
    AGENT_SIGNATURE,
    LINK,
    MENTION_LINK_OR_TOKEN,
    MENTION_NAME,
    MENTION_OR_LINK,
    SIGNATURE_CARET,
    SIGNATURE_SLASH,
)
from replyloom.plans.queries import (
    BATCHES,
    CLUSTERS,
    COUNTED,
    DIMENSIONS,
    EPOCHS,
    FACTOR_ROUNDS,
    MIN_BRAND_TWEETS,
    SAMPLE,
    SEED,
    START_ROUNDS,
    STARTS,
    STOPS,
    VECTOR_LABELS,
    VOCABULARY,
)
from replyloom.sources.messages import ANSWERS, BRAND, COMPLAINTS, EPOCH, OTHER_BRAND
from replyloom.vocabulary import (
    COURTESY_DOMAIN,
    DOMAIN_PATTERNS,
    FALLBACK,
    INTENT_PATTERNS,
    INTENT_RULES,
    INTENTS,
    NO_RULE,
    REPLY_SIGNALS,
    RESPONSE_TYPES,
    TAXONOMY,
)

# Unicode white space, written out for RE2.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^[{SPACE}]+|[{SPACE}]+$')}, '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(f'[{SPACE}]+')}, ' ', 'g'))"


def has(x: str, pattern: str, flags: str = "'i'") -> str:
    return f"regexp_matches(coalesce({x}, ''), {q(pattern)}, {flags})"


def parsed(x: str) -> str:
    return f"try_strptime({x}, '%a %b %d %H:%M:%S +0000 %Y')"


def pct(part: str, whole: str) -> str:
    return f"round({part} * 100.0::DOUBLE / {whole}, 2)"


MESSAGES = f"""
numbered AS (
  SELECT conv_id, turn, role, text, 0 AS copy, conv_id * 4294967296 + turn * 2 AS tweet_id FROM conversations
  UNION ALL
  SELECT conv_id, turn, role, text, 1, conv_id * 4294967296 + turn * 2 + 1 FROM conversations
  WHERE role = 'assistant' AND conv_id % 10 = 0),
tweets AS (
  SELECT tweet_id,
    CASE WHEN role = 'user' THEN CAST(conv_id + 100000 AS VARCHAR) WHEN role = 'system' THEN 'system'
         WHEN conv_id % 5 = 4 THEN {q(OTHER_BRAND)} ELSE {q(BRAND)} END AS author_id,
    role = 'user' AS inbound,
    CASE WHEN tweet_id % 97 = 0 THEN 'not a date' ELSE strftime(TIMESTAMP {q(EPOCH)} + to_seconds(
      (conv_id % 20000) * 25980 + turn * 3600 + (conv_id * 31 + turn * 17) % 3000 + copy * 120
      - CASE WHEN role = 'assistant' AND tweet_id % 29 = 0 THEN 9000 ELSE 0 END),
      '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
    CASE WHEN role = 'user' THEN
      CASE WHEN tweet_id % 53 = 0 THEN NULL
           WHEN tweet_id % 17 = 0 THEN '@' || (conv_id + 100000) || ' https://t.co/u' || conv_id
           WHEN tweet_id % 19 = 0 THEN '@1 ok'
           WHEN tweet_id % 23 = 0 THEN '@' || (conv_id + 100000) || ' thanks'
           ELSE '@' || (conv_id + 100000) || ' ' || CASE WHEN tweet_id % 7 = 0 THEN {q('@' + BRAND + ' ')} ELSE '' END
                || text || ' ' || {listed(COMPLAINTS)}[1 + (conv_id * 7 + turn) % {len(COMPLAINTS)}] END
    WHEN role = 'assistant' THEN
      CASE WHEN tweet_id % 59 = 0 THEN ''
           ELSE CASE WHEN copy = 1 THEN 'Following up. ' ELSE '' END || '@' || (conv_id + 100000) || ' ' || text || ' '
                || {listed(ANSWERS)}[1 + (conv_id + turn) % {len(ANSWERS)}]
                || CASE WHEN conv_id % 2 = 0 THEN ' https://t.co/x1' ELSE '' END
                || CASE WHEN turn % 3 = 0 THEN ' ^AB' WHEN turn % 5 = 0 THEN ' /LS' ELSE '' END END
    ELSE text END AS text,
    CASE WHEN copy = 1 OR (conv_id + turn) % 4 = 0 THEN NULL
         WHEN conv_id % 10 = 0 THEN (tweet_id + 2) || ', ' || (tweet_id + 3) || ',x'
         ELSE CAST(tweet_id + 2 AS VARCHAR) END AS response_tweet_id,
    CASE WHEN turn > 0 THEN conv_id * 4294967296 + (turn - 1) * 2 WHEN conv_id % 45 = 1 THEN conv_id * 4294967296 + 2
         WHEN conv_id % 60 BETWEEN 33 AND 47 THEN (conv_id - 1) * 4294967296 END AS in_response_to_tweet_id
  FROM numbered)"""

LINKS = """
children AS (
  SELECT tweet_id, CAST(trim(part) AS BIGINT) AS child_id
  FROM (SELECT tweet_id, unnest(string_split(response_tweet_id, ',')) AS part FROM tweets)
  WHERE regexp_full_match(trim(part), '[0-9]+')),
links AS (
  SELECT tweet_id AS src, child_id AS dst FROM children
  UNION
  SELECT tweet_id, in_response_to_tweet_id FROM tweets WHERE in_response_to_tweet_id IS NOT NULL)"""


def hops(seed: str) -> str:
    return f"""
hop0 AS (SELECT tweet_id FROM tweets WHERE {seed}),
hop1 AS (SELECT DISTINCT dst AS tweet_id FROM links WHERE src IN (SELECT tweet_id FROM hop0)),
hop2 AS (SELECT DISTINCT dst AS tweet_id FROM links WHERE src IN (SELECT tweet_id FROM hop1)),
hop3 AS (SELECT DISTINCT dst AS tweet_id FROM links WHERE src IN (SELECT tweet_id FROM hop2)),
reached AS (
  SELECT tweet_id, min(hop) AS hop FROM (
    SELECT tweet_id, 0::BIGINT AS hop FROM hop0 UNION ALL SELECT tweet_id, 1 FROM hop1
    UNION ALL SELECT tweet_id, 2 FROM hop2 UNION ALL SELECT tweet_id, 3 FROM hop3)
  GROUP BY tweet_id)"""


def rooted(source: str) -> str:
    return f"""
up AS (
  SELECT c.tweet_id, p.tweet_id AS parent FROM {source} c JOIN {source} p ON p.tweet_id = c.in_response_to_tweet_id),
walk AS (
  SELECT tweet_id, tweet_id AS node, [tweet_id] AS path, false AS met FROM {source}
  UNION ALL
  SELECT w.tweet_id, up.parent, list_append(path, up.parent), list_contains(path, up.parent)
  FROM walk w JOIN up ON up.tweet_id = w.node WHERE NOT met),
-- A walk ends at a tweet without a parent, or where it enters a cycle, whose tweets are their own roots.
roots AS (SELECT tweet_id, node AS conversation_id FROM walk WHERE met OR node NOT IN (SELECT tweet_id FROM up))"""


THREADS = (
    LINKS
    + ","
    + hops(f"author_id = {q(BRAND)} AND NOT inbound")
    + ", kept AS (SELECT * FROM tweets WHERE tweet_id IN (SELECT tweet_id FROM reached)),"
    + rooted("kept")
    + """,
threads AS (
  SELECT kept.*, conversation_id, count(*) OVER (PARTITION BY conversation_id) AS conversation_length
  FROM kept JOIN roots USING (tweet_id))"""
)


def paired(source: str) -> str:
    thread = source == "threads"
    flags = ",\n    ".join(f"{has('r.text', p)} AS {name}" for name, p in REPLY_SIGNALS.items())

    def normal(text: str) -> str:
        return f"regexp_replace({collapse(f"coalesce({text}, '')")}, '@[0-9]+\\b', '@user', 'g')"

    return f"""
pairs AS (
  SELECT r.tweet_id AS pair_id, {'r.conversation_id,' if thread else ''}
    c.tweet_id AS customer_tweet_id, r.tweet_id AS response_tweet_id, c.author_id AS customer_author_id,
    c.text AS customer_text, r.text AS response_text,
    {normal('c.text')} AS customer_text_normalized,
    {normal('r.text')} AS response_text_normalized,
    c.created_at AS customer_timestamp, r.created_at AS response_timestamp,
    date_diff('second', {parsed('c.created_at')}, {parsed('r.created_at')}) AS turn_delay_seconds,
    {flags}{', r.conversation_length' if thread else ''}
  FROM {source} r JOIN {source} c ON c.tweet_id = r.in_response_to_tweet_id
  WHERE r.author_id = {q(BRAND)} AND NOT r.inbound AND c.inbound)"""


def substantive(x: str) -> str:
    stripped = strip(f"regexp_replace(coalesce({x}, ''), {q(MENTION_OR_LINK)}, '', 'g')")
    return f"length({stripped})"


NORMAL = f"""
normal AS (
  SELECT *, regexp_replace(customer_text_normalized, {q(LINK)}, '[URL]', 'gi') AS customer_text_url_norm,
            regexp_replace(response_text_normalized, {q(LINK)}, '[URL]', 'gi') AS response_text_url_norm
  FROM (SELECT * REPLACE ({strip(f"regexp_replace(response_text_normalized, {q(AGENT_SIGNATURE)}, '')")}
        AS response_text_normalized) FROM pairs))"""

FLAGGED = (
    NORMAL
    + f""",
flagged AS (
  SELECT *, CASE WHEN quality_reason = 'valid' THEN 'clean' ELSE 'flagged' END AS quality_status FROM (
    SELECT *, CASE
      WHEN length({strip("coalesce(customer_text, '')")}) = 0 THEN 'empty_customer_text'
      WHEN {substantive('customer_text')} = 0 THEN 'url_or_mention_only_customer'
      WHEN {substantive('customer_text')} < 3 THEN 'ultra_short_customer_message'
      WHEN length({strip("coalesce(response_text, '')")}) = 0 THEN 'empty_response_text'
      WHEN turn_delay_seconds < 0 THEN 'impossible_chronology'
      WHEN pair_id > min(pair_id) OVER (PARTITION BY customer_tweet_id) THEN 'duplicate_customer_turn'
      ELSE 'valid' END AS quality_reason
    FROM normal)),
clean AS (SELECT * FROM flagged WHERE quality_status = 'clean')"""
)


def labelled(source: str) -> str:
    cases = "\n      ".join(
        f"WHEN regexp_matches(lower(customer_text_normalized), {q(p)}) THEN {q(label)}" for label, p in INTENT_PATTERNS.items()
    )
    return f"""
labelled AS (SELECT *, CASE {cases} ELSE {q(FALLBACK)} END AS intent FROM {source})"""


def predicted(source: str) -> str:
    def cases(pick):
        return "\n      ".join(
            f"WHEN regexp_matches(lower(coalesce(customer_text, '')), {q(r.pattern)}) THEN {pick(r)}" for r in INTENT_RULES
        )

    return f"""
predicted AS (
  SELECT *,
    CASE {cases(lambda r: q(r.label))} ELSE {q(NO_RULE.label)} END AS predicted_intent,
    CASE {cases(lambda r: f'{r.confidence}::DOUBLE')} ELSE {NO_RULE.confidence}::DOUBLE END AS confidence,
    CASE {cases(lambda r: q(r.name))} ELSE {q(NO_RULE.name)} END AS matched_rule
  FROM {source})"""


SPLIT = f"""
golden AS (SELECT * FROM pairs ORDER BY md5('{SEED}:' || pair_id), pair_id LIMIT {SAMPLE}),
convs AS (
  SELECT conversation_id, conversation_id IN (SELECT conversation_id FROM golden) AS is_golden
  FROM (SELECT DISTINCT conversation_id FROM clean)),
sizes AS (
  SELECT round_even(0.70::DOUBLE * count(*), 0) AS n_train, round_even(0.15::DOUBLE * count(*), 0) AS n_val FROM convs),
ranked AS (
  SELECT conversation_id, row_number() OVER (ORDER BY md5('{SEED}:' || conversation_id), conversation_id) AS rn
  FROM convs WHERE NOT is_golden),
split_of AS (
  SELECT conversation_id, CASE WHEN rn <= n_train THEN 'train' WHEN rn <= n_train + n_val THEN 'validation' ELSE 'test' END
    AS split FROM ranked, sizes
  UNION ALL SELECT conversation_id, 'test' FROM convs WHERE is_golden),
assigned AS (SELECT clean.*, split FROM clean JOIN split_of USING (conversation_id))"""


def measured(confusion: str, labels, prefix: str = "") -> str:
    """Per-class and overall metrics from a (true_label, predicted_label, n) relation."""
    return f"""
{prefix}classes AS (SELECT unnest({listed(labels)}) AS label),
{prefix}counted AS (
  SELECT label,
    coalesce((SELECT sum(n) FROM {confusion} WHERE true_label = label AND predicted_label = label), 0)::DOUBLE AS hits,
    coalesce((SELECT sum(n) FROM {confusion} WHERE true_label = label), 0)::BIGINT AS support,
    coalesce((SELECT sum(n) FROM {confusion} WHERE predicted_label = label), 0)::BIGINT AS predicted
  FROM {prefix}classes),
{prefix}scored AS (
  SELECT label, support,
    CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f1
  FROM {prefix}counted),
{prefix}overall AS (
  SELECT
    round((SELECT sum(n) FILTER (true_label = predicted_label)::DOUBLE / sum(n) FROM {confusion}), 4) AS accuracy,
    round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall, round(avg(f1), 4) AS macro_f1,
    round(sum(precision * support) / sum(support), 4) AS weighted_precision,
    round(sum(recall * support) / sum(support), 4) AS weighted_recall,
    round(sum(f1 * support) / sum(support), 4) AS weighted_f1
  FROM {prefix}scored)"""


CONFUSION = """
confusion AS (SELECT intent AS true_label, predicted_intent AS predicted_label, count(*) AS n FROM predicted GROUP BY ALL)"""

VECTORS = f"""
vectors AS (
  SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(embedding AS DOUBLE[]) AS v,
    md5('{SEED}:' || vec_id)[1] < 'c' AS is_train FROM embeddings),
sums AS (
  SELECT label, i, avg(v[i]) AS m, count(*) AS n FROM vectors, range(1, 65) r(i) WHERE is_train GROUP BY label, i),
norms AS (SELECT label, sqrt(sum(m * m)) AS norm FROM sums GROUP BY label),
centers AS (
  SELECT label, any_value(n) AS n, list(m / norm ORDER BY i) AS c FROM sums JOIN norms USING (label) GROUP BY label),
compared AS (
  SELECT vec_id, vectors.label AS intent, centers.label AS candidate, list_dot_product(v, c) AS score
  FROM vectors, centers WHERE NOT is_train),
nearest AS (
  SELECT vec_id, intent, candidate AS predicted_intent, score AS confidence FROM compared
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, candidate) = 1)"""


def modelling(x: str) -> str:
    return collapse(f"regexp_replace(lower(coalesce({x}, '')), {q(MENTION_LINK_OR_TOKEN)}, ' ', 'g')")


def stats_columns(column: str) -> str:
    return (
        f"round(avg({column}), 1) AS mean, quantile_cont({column}::DOUBLE, 0.5) AS median, "
        f"min({column}) AS min, max({column}) AS max"
    )


def statement(*parts: str) -> str:
    *tables, final = parts
    return "WITH RECURSIVE " + ",".join(tables) + "\n" + final


PAIRS = paired("tweets")
THREAD_PAIRS = paired("threads")
TO_CLEAN = (MESSAGES, PAIRS, FLAGGED)
TO_SPLIT = (MESSAGES, THREADS, THREAD_PAIRS, FLAGGED, SPLIT)
TO_CONFUSION = (*TO_CLEAN, labelled("clean"), predicted("labelled"), CONFUSION)


def _response_type() -> str:
    both, trouble, handover, article, other = map(q, RESPONSE_TYPES)
    return f"""CASE
      WHEN response_has_troubleshooting AND (response_requests_dm OR response_mentions_genius_bar) THEN {both}
      WHEN response_has_troubleshooting THEN {trouble}
      WHEN response_requests_dm OR response_mentions_genius_bar THEN {handover}
      WHEN response_has_url THEN {article} ELSE {other} END"""


def _ngram_words() -> str:
    return f"""
words AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
    lambda w: regexp_full_match(w, '[a-z]{{3,}}') AND NOT list_contains({listed(STOPS)}, w)) AS w FROM documents),
grams AS (
  SELECT 1 AS n, unnest(w) AS term FROM words
  UNION ALL SELECT 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
counted AS (SELECT n::BIGINT AS n, term, count(*) AS occurrences FROM grams GROUP BY ALL)"""


def _tfidf() -> str:
    return f"""
words AS (
  SELECT pair_id, split, list_filter(regexp_extract_all(lower(customer_text_normalized), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
    lambda w: NOT list_contains({listed(STOPS)}, w)) AS w FROM assigned WHERE split IN ('train', 'test')),
terms AS (
  SELECT pair_id, split, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
  FROM words),
tf AS (SELECT pair_id, split, term, count(*) AS tf FROM terms GROUP BY ALL),
fitted AS (SELECT count(*) AS rows FROM assigned WHERE split = 'train'),
vocabulary AS (
  SELECT term, ln((1 + any_value(rows)) / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM tf, fitted WHERE split = 'train' GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * any_value(rows)
  ORDER BY sum(tf) DESC, term LIMIT {VOCABULARY}),
raw AS (SELECT pair_id, term, tf * idf AS w FROM tf JOIN vocabulary USING (term) WHERE split = 'test'),
norm AS (SELECT pair_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY pair_id)"""


def _domains(kind: str) -> str:
    text = "coalesce(customer_text_normalized, '')"
    if kind == "hits":
        return " UNION ALL ".join(
            f"SELECT {q(name)} AS domain, count(*) FILTER ({has(f'lower({text})', p)}) AS hits, "
            f"{pct(f'count(*) FILTER ({has(f'lower({text})', p)})', 'count(*)')} AS pct FROM clean"
            for name, p in DOMAIN_PATTERNS.items()
        )
    return " OR ".join(has(f"lower({text})", p) for name, p in DOMAIN_PATTERNS.items() if name != COURTESY_DOMAIN)


def _column_profile() -> str:
    types = {
        "tweet_id": "bigint", "author_id": "string", "inbound": "boolean", "created_at": "string", "text": "string",
        "response_tweet_id": "string", "in_response_to_tweet_id": "bigint",
    }
    repeated = "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tweets))"
    return " UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, {q(t)} AS data_type, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"{pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct, count(*) AS total_rows, "
        f"{repeated} AS duplicate_rows FROM tweets"
        for c, t in types.items()
    )


def _brand_profile() -> str:
    dm, url = has("text", REPLY_SIGNALS["response_requests_dm"]), has("text", REPLY_SIGNALS["response_has_url"])
    return f"""
linked AS ({_brand_link()}),
members AS (
  SELECT tweets.*, author_id AS brand FROM tweets WHERE NOT inbound
  UNION ALL SELECT tweets.*, brand FROM tweets JOIN linked USING (tweet_id) WHERE brand IS NOT NULL),
profiled AS (
  SELECT brand, count(*) AS total_tweets, count(*) FILTER (NOT inbound) AS outbound_tweets,
    count(*) FILTER (inbound) AS inbound_tweets,
    count(*) FILTER (inbound AND in_response_to_tweet_id IS NULL) AS inbound_first_turn,
    count(DISTINCT author_id) FILTER (inbound) AS unique_customers,
    {pct(f'count(*) FILTER (NOT inbound AND {dm})', 'count(*) FILTER (NOT inbound)')} AS pct_outbound_dm,
    {pct(f'count(*) FILTER (NOT inbound AND {url})', 'count(*) FILTER (NOT inbound)')} AS pct_outbound_url,
    round(avg(length(coalesce(text, ''))) FILTER (NOT inbound), 2) AS avg_outbound_char_len,
    round(avg(length(coalesce(text, ''))) FILTER (inbound), 2) AS avg_inbound_char_len,
    {pct("count(*) FILTER (regexp_full_match(coalesce(text, ''), '[\\x00-\\x7F]*'))", 'count(*)')} AS pct_ascii,
    min({parsed('created_at')}) AS first_at, max({parsed('created_at')}) AS last_at
  FROM members GROUP BY brand)"""


def _brand_link() -> str:
    return f"""
  WITH repliers AS (
    SELECT in_response_to_tweet_id AS tweet_id, arg_min(author_id, tweet_id) AS replier
    FROM tweets WHERE NOT inbound AND in_response_to_tweet_id IS NOT NULL GROUP BY 1),
  mentions AS (
    SELECT tweet_id, unnest(names) AS name, generate_subscripts(names, 1) AS i
    FROM (SELECT tweet_id, regexp_extract_all(coalesce(text, ''), {q(MENTION_NAME)}, 1) AS names FROM tweets WHERE inbound)),
  mentioned AS (
    SELECT tweet_id, arg_min(name, i) AS mentioned FROM mentions
    WHERE name IN (SELECT author_id FROM tweets WHERE NOT inbound) GROUP BY 1)
  SELECT t.tweet_id, coalesce(replier, mentioned) AS brand,
    CASE WHEN replier IS NOT NULL THEN 'reply' WHEN mentioned IS NOT NULL THEN 'mention' ELSE 'unmatched' END AS link
  FROM tweets t LEFT JOIN repliers USING (tweet_id) LEFT JOIN mentioned USING (tweet_id) WHERE inbound"""


def _kmeans(rounds: int = 60) -> str:
    """Lloyd's rounds from two starts, written out; more rounds than the data need change nothing."""
    parts = ["v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)"]
    for start in range(STARTS):
        parts.append(f"""c{start}_0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY md5('{SEED + start}:' || vec_id), vec_id) - 1 AS k, x FROM v
          QUALIFY k < {CLUSTERS})""")
        for n in range(rounds):
            parts.append(f"""a{start}_{n} AS MATERIALIZED (
              SELECT vec_id, any_value(v.x) AS x, arg_max(k, [round(list_inner_product(v.x, c.x)
                - 0.5::DOUBLE * list_inner_product(c.x, c.x), 9), -k]) AS k
              FROM v, c{start}_{n} c GROUP BY vec_id)""")
            parts.append(f"""c{start}_{n + 1} AS MATERIALIZED (
              SELECT c.k, coalesce(m.x, c.x) AS x FROM c{start}_{n} c LEFT JOIN (
                SELECT k, list(mean ORDER BY i) AS x FROM (
                  SELECT k, i, round(avg(x[i]), 9) AS mean FROM a{start}_{n}, range(1, {DIMENSIONS + 1}) r(i) GROUP BY k, i)
                GROUP BY k) m USING (k))""")
        parts.append(f"""e{start} AS (
          SELECT round(sum(list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, c.x) + list_inner_product(c.x, c.x)), 6) AS e
          FROM a{start}_{rounds - 1} a JOIN c{start}_{rounds} c USING (k))""")
    better = "(SELECT e FROM e0) <= (SELECT e FROM e1)"
    last = rounds - 1
    chosen = f"SELECT vec_id, k FROM a0_{last} WHERE {better} UNION ALL SELECT vec_id, k FROM a1_{last} WHERE NOT {better}"
    return f"WITH {', '.join(parts)} SELECT vec_id, k AS cluster_id FROM ({chosen})"


def _minibatch() -> str:
    """Oversampling rounds, the choice among their candidates, and the mini-batch rounds, written out."""

    def digits(seed: int, start: int) -> str:
        return f"('0x' || substr(md5('{seed}:' || vec_id), {start}, 8))::BIGINT"

    score = "round(list_inner_product(v.x, c.x) - 0.5::DOUBLE * list_inner_product(c.x, c.x), 9)"
    far = f"greatest(any_value(list_inner_product(v.x, v.x)) - 2 * max({score}), 0)"
    between = "greatest(list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x), 0)"
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS x, {digits(SEED, 1)} % {BATCHES} AS batch FROM embeddings)",
        f"s0 AS MATERIALIZED (SELECT 0 AS k, x FROM v ORDER BY md5('{SEED}:' || vec_id), vec_id LIMIT 1)",
    ]
    for n in range(1, START_ROUNDS + 1):
        parts.append(f"d{n} AS MATERIALIZED (SELECT vec_id, any_value(v.x) AS x, {far} AS far FROM v, s{n - 1} c GROUP BY vec_id)")
        parts.append(f"""s{n} AS MATERIALIZED (
          SELECT * FROM s{n - 1} UNION ALL
          SELECT row_number() OVER (ORDER BY md5('{SEED + n}:' || vec_id), vec_id) - 1 + (SELECT count(*) FROM s{n - 1}), x FROM d{n}
          WHERE ({digits(SEED + n, 9)} + 0.5::DOUBLE) / 4294967296 < {2 * CLUSTERS} * far / (SELECT sum(far) FROM d{n}))""")
    last = f"s{START_ROUNDS}"
    parts.append(f"""n AS (
      SELECT vec_id, arg_max(k, [{score}, -k]) AS k FROM v, {last} c GROUP BY vec_id)""")
    parts.append(f"""w AS MATERIALIZED (
      SELECT k, x, coalesce(n, 0) AS n FROM {last} LEFT JOIN (SELECT k, count(*) AS n FROM n GROUP BY k) USING (k))""")
    parts.append("p0 AS MATERIALIZED (SELECT 0 AS place, x FROM w ORDER BY n DESC, k LIMIT 1)")
    for i in range(1, CLUSTERS):
        parts.append(f"""p{i} AS MATERIALIZED (
          SELECT * FROM p{i - 1} UNION ALL (
            SELECT {i}, any_value(a.x) FROM w a, p{i - 1} b GROUP BY k ORDER BY round(any_value(a.n) * min({between}), 9) DESC, k LIMIT 1))""")
    parts.append(f"""c0 AS MATERIALIZED (
      SELECT place AS k, list_transform(x, lambda e: round(e, 9)) AS x, 0 AS given FROM p{CLUSTERS - 1})""")
    for step in range(BATCHES * EPOCHS):
        parts.append(f"""a{step} AS MATERIALIZED (
          SELECT vec_id, any_value(v.x) AS x, arg_max(k, [{score}, -k]) AS k FROM v, c{step} c
          WHERE batch = {step % BATCHES} GROUP BY vec_id)""")
        parts.append(f"""c{step + 1} AS MATERIALIZED (
          SELECT c.k, coalesce(m.x, c.x) AS x, c.given + coalesce(m.n, 0) AS given FROM c{step} c LEFT JOIN (
            SELECT k, list(moved ORDER BY i) AS x, any_value(n) AS n FROM (
              SELECT a.k, i, count(*) AS n,
                round(any_value(c.x[i]) + (sum(a.x[i]) - count(*) * any_value(c.x[i])) / (any_value(c.given) + count(*)), 9) AS moved
              FROM a{step} a JOIN c{step} c ON a.k = c.k, range(1, {DIMENSIONS + 1}) r(i) GROUP BY a.k, i)
            GROUP BY k) m USING (k))""")
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, arg_max(k, [{score}, -k])::BIGINT AS cluster_id FROM v, c{BATCHES * EPOCHS} c GROUP BY vec_id"""


#: Gradient steps of the SQL, more than the tables need.
GRADIENT_STEPS = 400


def _logistic() -> str:
    """(label, w) of the same optimum as the fitted model's, by accelerated gradient steps from zero.

    A step assumes a curvature of a quarter of the rows and the penalty.
    """
    zero = f"list_transform(range({DIMENSIONS + 1}), lambda i: 0.0::DOUBLE)"
    return f"""
    r AS MATERIALIZED (
      SELECT vec_id, label, list_append(v, 1.0::DOUBLE) AS x,
        count(*) OVER () / ((SELECT count(DISTINCT label) FROM vectors WHERE is_train) * count(*) OVER (PARTITION BY label)::DOUBLE) AS weight
      FROM vectors WHERE is_train),
    rate AS MATERIALIZED (
      SELECT 1 / top AS step, (sqrt(top) - 1) / (sqrt(top) + 1) AS momentum FROM (SELECT 1 + sum(weight) / 4 AS top FROM r)),
    steps AS (
      SELECT 0 AS n, label, {zero} AS w, {zero} AS moved FROM (SELECT DISTINCT label FROM r)
      UNION ALL
      SELECT n + 1, label, list_transform(list_zip(next, moved), lambda z: z[1] + momentum * (z[1] - z[2])), next
      FROM (
        SELECT s.n, s.label, s.moved, momentum, list_transform(list_zip(s.w, g.g), lambda z: z[1] - step * z[2]) AS next
        FROM steps s, rate, (
          SELECT label, list(g ORDER BY i) AS g FROM (
            SELECT label, i, sum(weight * (p - hit) * x[i]) + CASE WHEN i <= {DIMENSIONS} THEN any_value(w[i]) ELSE 0 END AS g
            FROM (
              SELECT r.x, r.weight, s.label, s.w, (s.label = r.label)::INT AS hit,
                exp(list_inner_product(r.x, s.w)) / sum(exp(list_inner_product(r.x, s.w))) OVER (PARTITION BY r.vec_id) AS p
              FROM r, steps s), range(1, {DIMENSIONS + 2}) t(i) GROUP BY label, i)
          GROUP BY label) g
        WHERE g.label = s.label AND s.n < {GRADIENT_STEPS})),
    fitted AS MATERIALIZED (SELECT label, moved AS w FROM steps WHERE n = {GRADIENT_STEPS})"""


def _fit_two(b1: str, b2: str, g: str) -> str:
    """The two non-negative weights of least squared error, in closed form."""
    one = f"({b1} * {g}.g22 - {b2} * {g}.g12) / ({g}.g11 * {g}.g22 - {g}.g12 * {g}.g12)"
    two = f"({b2} * {g}.g11 - {b1} * {g}.g12) / ({g}.g11 * {g}.g22 - {g}.g12 * {g}.g12)"
    first = f"greatest({b1}, 0) * greatest({b1}, 0) / {g}.g11 >= greatest({b2}, 0) * greatest({b2}, 0) / {g}.g22"
    return f"""CASE WHEN {one} >= 0 AND {two} >= 0 THEN [{one}, {two}]
      WHEN {first} THEN [greatest({b1}, 0) / {g}.g11, 0] ELSE [0, greatest({b2}, 0) / {g}.g22] END"""


def _factors() -> str:
    """Alternating non-negative fits of two topics, written out: x has the counts, h the term weights, w the row weights."""
    start = lambda j: f"(('0x' || substr(md5('{SEED}:{j}:' || term), 1, 8))::BIGINT + 1) / 4294967296::DOUBLE"
    word = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}')"
    parts = [
        f"x AS MATERIALIZED (SELECT doc_id, term, count(*)::DOUBLE AS x FROM (SELECT doc_id, unnest({word}) AS term FROM documents)"
        f" WHERE term IN {listed(COUNTED)} GROUP BY ALL)",
        f"v AS (SELECT unnest([{', '.join(map(q, COUNTED))}]) AS term)",
        f"h0 AS MATERIALIZED (SELECT term, {start(1)} AS a, {start(2)} AS b FROM v)",
    ]
    inner = "sum(a * a) AS g11, sum(a * b) AS g12, sum(b * b) AS g22"
    for n in range(FACTOR_ROUNDS + 1):
        parts.append(f"g{n} AS MATERIALIZED (SELECT {inner} FROM h{n})")
        parts.append(f"p{n} AS MATERIALIZED (SELECT doc_id, sum(x * a) AS p1, sum(x * b) AS p2 FROM x JOIN h{n} USING (term) GROUP BY doc_id)")
        parts.append(f"""w{n} AS MATERIALIZED (
          SELECT doc_id, f[1]::DOUBLE AS a, f[2]::DOUBLE AS b FROM (SELECT doc_id, {_fit_two('p1', 'p2', f'g{n}')} AS f FROM p{n}, g{n}))""")
        parts.append(f"s{n} AS MATERIALIZED (SELECT {inner} FROM w{n})")
        parts.append(f"c{n} AS MATERIALIZED (SELECT term, sum(x * a) AS p1, sum(x * b) AS p2 FROM x JOIN w{n} USING (doc_id) GROUP BY term)")
        parts.append(f"""h{n + 1} AS MATERIALIZED (
          SELECT term, coalesce(f[1], 0)::DOUBLE AS a, coalesce(f[2], 0)::DOUBLE AS b
          FROM v LEFT JOIN (SELECT term, {_fit_two('p1', 'p2', f's{n}')} AS f FROM c{n}, s{n}) USING (term))""")
    return ", ".join(parts)


def _residuals() -> str:
    n = FACTOR_ROUNDS

    def worst(own: str, slope: str) -> str:
        return f"max(CASE WHEN {own} > 0 THEN abs({slope}) ELSE greatest(-({slope}), 0) END)"

    def part(factor: str, own: str, projected: str, g: str, on: str) -> str:
        first, second = "a * g11 + b * g12 - coalesce(p1, 0)", "a * g12 + b * g22 - coalesce(p2, 0)"
        largest = "max(greatest(abs(coalesce(p1, 0)), abs(coalesce(p2, 0))))"
        table = f"{own} LEFT JOIN {projected} USING ({on}), {g}"
        return f"""SELECT '{factor}' AS factor, 1::BIGINT AS topic_id, round({worst('a', first)} / {largest}, 5) AS residual FROM {table}
        UNION ALL SELECT '{factor}', 2, round({worst('b', second)} / {largest}, 5) FROM {table}"""

    return part("rows", f"w{n}", f"p{n}", f"g{n}", "doc_id") + " UNION ALL " + part("terms", f"h{n}", f"c{n}", f"s{n}", "term")


def oracle_sql() -> dict[str, str]:
    dm_seed = f"author_id = {q(BRAND)} AND NOT inbound AND {has('text', REPLY_SIGNALS['response_requests_dm'])}"
    conf_rows = ", ".join(f"({q(i)}, {q(c)})" for i, e in TAXONOMY.items() for c in e["confusable_intents"])
    pair_columns = """pair_id, conversation_id, customer_tweet_id, response_tweet_id, customer_author_id, customer_text,
      response_text, customer_text_normalized, response_text_normalized, customer_timestamp, response_timestamp,
      CAST(turn_delay_seconds AS VARCHAR) AS turn_delay_seconds, response_has_url, response_requests_dm, response_mentions_genius_bar,
      response_has_troubleshooting, conversation_length"""
    sql = {
        "conversation_docs": statement(
            MESSAGES, THREADS,
            f"""SELECT conversation_id, conversation_length, 0::BIGINT AS part,
              row_number() OVER (PARTITION BY conversation_id ORDER BY {parsed('created_at')} NULLS LAST, tweet_id) - 1 AS position,
              tweet_id, author_id, inbound, created_at, text,
              CAST(in_response_to_tweet_id AS VARCHAR) AS in_response_to_tweet_id, response_tweet_id FROM threads"""),
        "conversation_doc_audit": statement(
            MESSAGES, THREADS,
            """SELECT count(DISTINCT conversation_id) AS conversations, count(*) AS total_turns, 0::BIGINT AS missing_keys
            FROM threads"""),
        "record_problems": statement(
            MESSAGES, THREADS, "kinds AS (SELECT DISTINCT conversation_id % 7 AS kind, conversation_id FROM threads)",
            """wrong(field, problem, kinds) AS (VALUES (NULL, 'malformed', [1]), ('conversation_id', 'missing', []), ('conversation_id', 'null', []),
              ('conversation_id', 'wrong type', [4]), ('tweets', 'missing', [2]), ('tweets', 'null', [3]), ('tweets', 'wrong type', []),
              ('tweets[0].tweet_id', 'missing', [2, 3]), ('tweets[0].tweet_id', 'null', []), ('tweets[0].tweet_id', 'wrong type', []),
              ('tweets[0].text', 'missing', [2, 3]), ('tweets[0].text', 'null', []), ('tweets[0].text', 'wrong type', []))""",
            """SELECT field, problem, (SELECT count(*) FROM kinds WHERE list_contains(wrong.kinds::BIGINT[], kind)) AS lines FROM wrong"""),
        "csv_round_trip": statement(
            MESSAGES, """SELECT * REPLACE (replace(text, ' the ', chr(10) || '"the", ') AS text) FROM tweets"""),
        "split_files": statement(
            *TO_SPLIT,
            """SELECT split, count(*) AS pairs, sum(pair_id)::BIGINT AS pair_ids, sum(conversation_id)::BIGINT AS conversation_ids
            FROM assigned GROUP BY split"""),
        "taxonomy_confusable": statement(
            *TO_CONFUSION, f"listed(t, p) AS (VALUES {conf_rows})",
            """SELECT true_label, predicted_label, n, t IS NOT NULL AS listed FROM confusion
            LEFT JOIN listed ON t = true_label AND p = predicted_label WHERE true_label <> predicted_label"""),
        "brand_outbound": statement(
            MESSAGES, f"SELECT tweet_id, created_at, text FROM tweets WHERE author_id = {q(BRAND)} AND NOT inbound"),
        "direction_counts": statement(
            MESSAGES,
            f"""SELECT CASE WHEN inbound THEN 'customer' WHEN author_id = {q(BRAND)} THEN 'brand' ELSE 'other' END AS side,
            count(*) AS tweets FROM tweets GROUP BY ALL"""),
        "thread_starters": statement(
            MESSAGES, "SELECT tweet_id, author_id, text FROM tweets WHERE inbound AND in_response_to_tweet_id IS NULL"),
        "category_examples": statement(
            MESSAGES, PAIRS,
            f"""tagged AS (
              SELECT 'Pure Troubleshooting' AS category, * FROM pairs
                WHERE NOT response_requests_dm AND response_has_troubleshooting AND contains(lower(customer_text), 'battery')
              UNION ALL SELECT 'Immediate Escalation', * FROM pairs
                WHERE response_requests_dm AND NOT response_has_troubleshooting
                AND {has('customer_text', 'apple id|password|account')}
              UNION ALL SELECT 'Troubleshooting + Escalation', * FROM pairs
                WHERE response_requests_dm AND response_has_troubleshooting
              UNION ALL SELECT 'Documentation / Help Article URL', * FROM pairs
                WHERE response_has_url AND NOT response_requests_dm AND NOT response_has_troubleshooting
              UNION ALL SELECT 'General Inquiry / Clarification', * FROM pairs
                WHERE NOT response_has_url AND NOT response_requests_dm AND contains(response_text, '?'))""",
            """SELECT category, pair_id, customer_tweet_id, customer_text, response_tweet_id, response_text FROM tagged
            QUALIFY row_number() OVER (PARTITION BY category ORDER BY pair_id) = 1"""),
        "signal_flags": statement(MESSAGES, PAIRS, f"SELECT pair_id, {', '.join(REPLY_SIGNALS)} FROM pairs"),
        "response_type": statement(
            *TO_CLEAN,
            f"""SELECT {_response_type()} AS response_type, count(*) AS pairs, count(turn_delay_seconds) AS dated_pairs
            FROM clean GROUP BY 1"""),
        "quality_flags": statement(
            *TO_CLEAN, "SELECT pair_id, customer_tweet_id, quality_status, quality_reason FROM flagged"),
        "quality_summary": statement(
            *TO_CLEAN,
            f"""SELECT quality_reason, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM flagged)')} AS pct
            FROM flagged GROUP BY 1"""),
        "pair_quality_audit": statement(
            MESSAGES, PAIRS,
            f"""measured AS (
              SELECT *, {substantive('customer_text')} AS q_len, {substantive('response_text')} AS r_len,
                count(*) OVER (PARTITION BY customer_tweet_id) AS copies,
                row_number() OVER (PARTITION BY customer_tweet_id ORDER BY pair_id) AS nth,
                row_number() OVER (PARTITION BY customer_tweet_id, response_tweet_id ORDER BY pair_id) AS nth_pair
              FROM pairs)""",
            """SELECT count(*) AS total_pairs,
              count(*) FILTER (customer_tweet_id IS NULL OR response_tweet_id IS NULL) AS broken_references,
              count(*) FILTER (turn_delay_seconds < 0) AS negative_delays,
              count(*) FILTER (nth_pair > 1) AS duplicate_pairs, count(*) FILTER (nth > 1) AS repeated_customer_turns,
              count(*) FILTER (copies > 1) AS rows_of_repeated_turns, count(*) FILTER (q_len = 0) AS empty_customer,
              count(*) FILTER (q_len > 0 AND q_len < 3) AS ultra_short_customer, count(*) FILTER (r_len = 0) AS empty_response,
              count(*) FILTER (r_len > 0 AND r_len < 5) AS ultra_short_response FROM measured"""),
        "expectations": statement(
            *TO_CLEAN, labelled("clean"),
            """SELECT 'column:customer_text' AS check_name, 0::BIGINT AS violations
            UNION ALL SELECT 'column:intent', 0 UNION ALL SELECT 'column:manual_intent_label', 1
            UNION ALL SELECT 'not_null:customer_text', count(*) FILTER (customer_text IS NULL) FROM labelled
            UNION ALL SELECT 'not_null:intent', count(*) FILTER (intent IS NULL) FROM labelled
            UNION ALL SELECT 'not_null:turn_delay_seconds', count(*) FILTER (turn_delay_seconds IS NULL) FROM labelled
            UNION ALL SELECT 'domain:intent', count(*) FILTER (intent = 'software_update') FROM labelled
            UNION ALL SELECT 'row_count', abs(count(*) - 100) FROM labelled"""),
        "signature_rate": statement(
            MESSAGES, PAIRS,
            " UNION ALL ".join(
                f"SELECT '{name}' AS signature, count(*) FILTER ({has('response_text', p, q('c'))}) AS replies, "
                f"{pct(f'count(*) FILTER ({has('response_text', p, q('c'))})', 'count(*)')} AS pct FROM pairs"
                for name, p in (("caret", SIGNATURE_CARET), ("slash", SIGNATURE_SLASH)))),
        "support_pairs": statement(MESSAGES, THREADS, THREAD_PAIRS, f"SELECT {pair_columns} FROM pairs"),
        "golden_missing": statement(
            *TO_SPLIT,
            """SELECT DISTINCT 'conversation' AS level, conversation_id AS id FROM golden
            WHERE conversation_id NOT IN (SELECT conversation_id FROM convs)
            UNION ALL SELECT 'pair', pair_id FROM golden WHERE pair_id NOT IN (SELECT pair_id FROM clean)"""),
        "thread_neighbourhood": statement(MESSAGES, LINKS, hops(dm_seed), "SELECT tweet_id, hop FROM reached"),
        "thread_root": statement(MESSAGES, rooted("tweets"), "SELECT tweet_id, conversation_id FROM roots"),
        "thread_length": statement(
            MESSAGES, THREADS, "SELECT tweet_id, conversation_id, conversation_length FROM threads"),
        "split_tweet_counts": statement(
            *TO_SPLIT,
            """SELECT split, count(tweet_id) AS tweets FROM split_of LEFT JOIN threads USING (conversation_id) GROUP BY split"""),
        "stored_pairs": statement(MESSAGES, PAIRS, "SELECT pair_id, customer_tweet_id, customer_text, response_text FROM pairs"),
        "stored_split_counts": statement(
            *TO_SPLIT,
            """SELECT split, count(tweet_id) AS tweets, (SELECT count(*) FROM threads) AS all_tweets
            FROM split_of LEFT JOIN threads USING (conversation_id) GROUP BY split"""),
        "brand_link": statement(MESSAGES, f"linked AS ({_brand_link()})", "SELECT * FROM linked"),
        "text_preserved_audit": statement(
            *TO_CLEAN,
            """SELECT count(*) AS compared, count(*) FILTER (c.customer_text IS DISTINCT FROM p.customer_text
              OR c.response_text IS DISTINCT FROM p.response_text) AS changed FROM clean c JOIN pairs p USING (pair_id)"""),
        "pair_reference_audit": statement(
            MESSAGES, PAIRS,
            """sides AS (SELECT 'customer' AS side, customer_tweet_id AS tweet_id FROM pairs
              UNION ALL SELECT 'response', response_tweet_id FROM pairs)""",
            f"""SELECT side, count(*) AS "references", count(*) FILTER (inbound IS NULL) AS missing,
              count(*) FILTER (inbound = (side = 'response')) AS wrong_direction,
              count(*) FILTER (side = 'response' AND author_id <> {q(BRAND)}) AS wrong_author
            FROM sides LEFT JOIN tweets USING (tweet_id) GROUP BY side"""),
        "label_alignment": statement(
            """aligned AS (
              SELECT CASE WHEN doc_id IS NULL THEN NULL WHEN n_chars >= 200 THEN '1' ELSE '0' END AS guess,
                CAST(quality AS VARCHAR) AS truth
              FROM documents FULL JOIN labels USING (doc_id))""",
            """confusion AS (SELECT truth AS true_label, guess AS predicted_label, count(*) AS n FROM aligned
              WHERE truth IS NOT NULL AND guess IS NOT NULL GROUP BY ALL)""",
            measured("confusion", ["0", "1"]),
            """SELECT count(*) FILTER (truth IS NOT NULL AND guess IS NOT NULL) AS matched,
              count(*) FILTER (truth IS NULL) AS without_label, count(*) FILTER (guess IS NULL) AS without_prediction,
              any_value(accuracy) AS accuracy, any_value(macro_precision) AS macro_precision,
              any_value(macro_recall) AS macro_recall, any_value(macro_f1) AS macro_f1,
              any_value(weighted_precision) AS weighted_precision, any_value(weighted_recall) AS weighted_recall,
              any_value(weighted_f1) AS weighted_f1 FROM aligned, overall"""),
        "intent_distribution": statement(
            *TO_SPLIT, labelled("assigned"),
            """SELECT split, intent, count(*) AS n,
              round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 2) AS pct
            FROM labelled GROUP BY split, intent"""),
        "profile_core": statement(
            MESSAGES,
            f"""SELECT count(*) AS total_rows, count(DISTINCT tweet_id) AS unique_ids,
              count(*) - count(DISTINCT tweet_id) AS duplicate_ids,
              count(DISTINCT author_id) FILTER (inbound) AS customers,
              count(DISTINCT author_id) FILTER (NOT inbound) AS brands,
              count(*) FILTER (inbound) AS inbound_rows, count(*) FILTER (NOT inbound) AS outbound_rows,
              min({parsed('created_at')}) AS first_at, max({parsed('created_at')}) AS last_at FROM tweets"""),
        "column_profile": statement(MESSAGES, _column_profile()),
        "thread_length_stats": statement(
            MESSAGES, THREADS, "sized AS (SELECT conversation_id, count(*) AS turns FROM threads GROUP BY 1)",
            """SELECT count(*) AS conversations, round(avg(turns), 2) AS mean_turns,
              quantile_cont(turns::DOUBLE, 0.5) AS median_turns, round(stddev_samp(turns), 2) AS std_turns,
              min(turns) AS min_turns, max(turns) AS max_turns FROM sized"""),
        "thread_length_buckets": statement(
            MESSAGES, THREADS, "sized AS (SELECT conversation_id, count(*) AS turns FROM threads GROUP BY 1)",
            """SELECT bucket, count(turns) AS conversations FROM (VALUES (1, 1, '1 turn (unanswered/single)'),
              (2, 2, '2 turns (single Q&A pair)'), (3, 3, '3 turns'), (4, 4, '4 turns'),
              (5, 1000000, '5+ turns (extended dialogue)')) b(lo, hi, bucket)
            LEFT JOIN sized ON turns BETWEEN lo AND hi GROUP BY bucket"""),
        "signal_rates": statement(
            MESSAGES, PAIRS,
            " UNION ALL ".join(
                f"SELECT {q(s)} AS signal, count(*) FILTER ({s}) AS replies, "
                f"{pct(f'count(*) FILTER ({s})', 'count(*)')} AS pct FROM pairs" for s in REPLY_SIGNALS)),
        "delay_stats": statement(
            MESSAGES, PAIRS,
            """SELECT count(turn_delay_seconds) AS known_delays, round(avg(turn_delay_seconds) / 60, 1) AS mean_minutes,
              round(quantile_cont(turn_delay_seconds::DOUBLE, 0.5) / 60, 1) AS median_minutes FROM pairs"""),
        "year_counts": "SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1",
        "month_counts": "SELECT month(o_orderdate) AS month, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1",
        "time_cutoffs": statement(
            """ordered AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS n FROM events
              WHERE ts IS NOT NULL)""",
            """SELECT any_value(n) AS dated_rows, min(ts) AS earliest,
              max(ts) FILTER (i = floor(n * 0.70::DOUBLE)) AS cutoff_70,
              max(ts) FILTER (i = floor(n * 0.85::DOUBLE)) AS cutoff_85, max(ts) AS latest FROM ordered"""),
        "text_length_stats": statement(
            f"cleaned AS (SELECT {modelling('text')} AS t FROM documents)",
            """sized AS (SELECT CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END::BIGINT AS words,
              length(t)::BIGINT AS chars FROM cleaned)""",
            f"""SELECT 'words' AS unit, {stats_columns('words')} FROM sized
            UNION ALL SELECT 'chars', {stats_columns('chars')} FROM sized"""),
        "group_quartiles": statement(
            *TO_SPLIT,
            # The clean pairs of all tweets, which the split's pairs of the brand's threads equal.
            f"""measured AS (
              SELECT 'brand' AS kind, author_id AS name, length(text) AS value FROM tweets WHERE NOT inbound
              UNION ALL SELECT 'response_type', {_response_type()}, turn_delay_seconds FROM clean
              UNION ALL SELECT 'split', split, length(customer_text) FROM assigned)""",
            """SELECT kind, name, count(value) AS n, quantile_cont(value::DOUBLE, 0.25) AS p25, quantile_cont(value::DOUBLE, 0.5) AS median,
              quantile_cont(value::DOUBLE, 0.75) AS p75 FROM measured WHERE value IS NOT NULL GROUP BY kind, name"""),
        "order_quartiles": """SELECT l_orderkey, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
            round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75
            FROM lineitem GROUP BY l_orderkey""",
        "top_ngrams": statement(
            _ngram_words(),
            """SELECT n, term, occurrences FROM counted
            QUALIFY row_number() OVER (PARTITION BY n ORDER BY occurrences DESC, term) <= CASE n WHEN 3 THEN 15 ELSE 20 END"""),
        "brand_profile": statement(
            MESSAGES, _brand_profile(),
            f"""SELECT *, round(100 - abs(pct_outbound_dm - 35), 2) AS escalation_balance_score FROM profiled
            WHERE total_tweets >= {MIN_BRAND_TWEETS}"""),
        "domain_hits": statement(*TO_CLEAN, _domains("hits")),
        "domain_coverage": statement(
            *TO_CLEAN, f"hit AS (SELECT {_domains('any')} AS hit FROM clean)",
            f"""SELECT count(*) AS total, count(*) FILTER (hit) AS matched,
              {pct('count(*) FILTER (hit)', 'count(*)')} AS matched_pct, count(*) FILTER (NOT hit) AS unmatched,
              {pct('count(*) FILTER (NOT hit)', 'count(*)')} AS unmatched_pct FROM hit"""),
        "unmatched_examples": statement(
            *TO_CLEAN,
            f"SELECT pair_id, customer_text FROM clean WHERE NOT ({_domains('any')}) ORDER BY pair_id LIMIT 15"),
        "duplicate_turns": statement(
            MESSAGES, PAIRS,
            """SELECT pair_id, customer_tweet_id, pair_id > min(pair_id) OVER (PARTITION BY customer_tweet_id) AS is_later,
              count(*) OVER (PARTITION BY customer_tweet_id) > 1 AS is_repeated FROM pairs"""),
        "sketch_distincts": """SELECT coalesce(event_type, 'all') AS event_type, count(DISTINCT user_id) AS users, true AS hll_within,
            true AS theta_within FROM events GROUP BY GROUPING SETS ((event_type), ())""",
        "sketch_overlaps": """WITH u AS (SELECT DISTINCT event_type, user_id FROM events), k AS (SELECT DISTINCT event_type FROM events)
            SELECT a.event_type AS left_set, b.event_type AS right_set,
              (SELECT count(*) FROM u x JOIN u y USING (user_id) WHERE x.event_type = a.event_type AND y.event_type = b.event_type) AS users,
              true AS within FROM k a JOIN k b ON a.event_type < b.event_type""",
        "dedup_tweets": """SELECT doc_id, lang, md5(text) AS text_md5 FROM documents
            QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
        "pair_numbers": statement(
            MESSAGES, PAIRS,
            "SELECT row_number() OVER (ORDER BY response_tweet_id) AS pair_id, response_tweet_id FROM pairs"),
        "examples_per_intent": statement(
            *TO_CLEAN, labelled("clean"),
            """SELECT intent, pair_id, customer_text FROM labelled
            QUALIFY row_number() OVER (PARTITION BY intent ORDER BY pair_id) <= 3"""),
        "manual_sample": statement(
            MESSAGES, PAIRS,
            f"""SELECT pair_id, customer_text, response_text FROM pairs
            ORDER BY md5('{SEED}:' || pair_id), pair_id LIMIT 250"""),
        "error_sample": statement(
            *TO_CONFUSION,
            f"""SELECT pair_id, customer_text AS query, intent AS true_intent, predicted_intent FROM predicted
            WHERE intent <> predicted_intent ORDER BY md5('{SEED}:' || pair_id), pair_id LIMIT 20"""),
        "conversation_split": statement(*TO_SPLIT, "SELECT pair_id, conversation_id, split FROM assigned"),
        "split_summary": statement(
            *TO_SPLIT,
            "held AS (SELECT split, conversation_id, count(*) AS pairs FROM assigned GROUP BY ALL)",
            "tweet_counts AS (SELECT conversation_id, count(*) AS n FROM threads GROUP BY 1)",
            f"""SELECT split, count(*) AS conversations, sum(pairs)::BIGINT AS pairs, sum(coalesce(n, 0))::BIGINT AS tweets,
              {pct('count(*)', '(SELECT count(*) FROM held)')} AS conversations_pct,
              {pct('sum(pairs)', '(SELECT count(*) FROM assigned)')} AS pairs_pct
            FROM held LEFT JOIN tweet_counts USING (conversation_id) GROUP BY split"""),
        "retrieval_corpus": statement(
            *TO_SPLIT,
            """SELECT pair_id, conversation_id, customer_text_normalized, response_text_normalized FROM assigned
            WHERE split = 'train'"""),
        "leakage_audit": statement(
            *TO_SPLIT,
            """named AS (
              SELECT DISTINCT 1 AS i, 'golden' AS name, conversation_id FROM golden
              UNION ALL SELECT DISTINCT 2, 'retrieval', conversation_id FROM assigned WHERE split = 'train'
              UNION ALL SELECT DISTINCT 3, 'train', conversation_id FROM assigned WHERE split = 'train'
              UNION ALL SELECT DISTINCT 4, 'validation', conversation_id FROM assigned WHERE split = 'validation'
              UNION ALL SELECT DISTINCT 5, 'test', conversation_id FROM assigned WHERE split = 'test')""",
            "names(i, name) AS (VALUES (1, 'golden'), (2, 'retrieval'), (3, 'train'), (4, 'validation'), (5, 'test'))",
            """SELECT a.name AS left_set, b.name AS right_set, (
                SELECT count(*) FROM named x JOIN named y USING (conversation_id) WHERE x.i = a.i AND y.i = b.i) AS shared
            FROM names a JOIN names b ON a.i < b.i"""),
        "normalize_text": statement(
            *TO_CLEAN, "SELECT pair_id, customer_text_normalized, response_text_normalized FROM normal"),
        "url_norm": statement(*TO_CLEAN, "SELECT pair_id, customer_text_url_norm, response_text_url_norm FROM normal"),
        "child_edges": statement(MESSAGES, LINKS, "SELECT tweet_id, child_id FROM children"),
        "parse_created_at": statement(
            MESSAGES,
            f"""SELECT tweet_id, {parsed('created_at')} AS "at", CAST(year({parsed('created_at')}) AS VARCHAR) AS year,
            CAST(month({parsed('created_at')}) AS VARCHAR) AS month FROM tweets"""),
        "intent_label": statement(*TO_CLEAN, labelled("clean"), "SELECT pair_id, intent FROM labelled"),
        "rule_predict": statement(
            MESSAGES, PAIRS, predicted("pairs"), "SELECT pair_id, predicted_intent, confidence, matched_rule FROM predicted"),
        "sql_rule_predict": statement(
            MESSAGES, PAIRS, NORMAL, labelled("normal"), predicted("labelled"),
            f"""SELECT pair_id, predicted_intent, confidence, matched_rule, predicted_intent AS table_intent, matched_rule AS table_rule,
              intent AS label, {_response_type()} AS response_type, customer_text_normalized AS question,
              response_text_normalized AS reply FROM predicted"""),
        "majority_predict": statement(
            *TO_SPLIT, labelled("assigned"),
            """SELECT pair_id, intent, (SELECT intent FROM labelled WHERE split = 'train' GROUP BY intent
              ORDER BY count(*) DESC, intent LIMIT 1) AS predicted_intent FROM labelled WHERE split = 'test'"""),
        "classification_overall": statement(*TO_CONFUSION, measured("confusion", INTENTS), "SELECT * FROM overall"),
        "classification_per_class": statement(
            *TO_CONFUSION, measured("confusion", INTENTS),
            """SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support
            FROM scored"""),
        "confusion_matrix": statement(
            *TO_CONFUSION,
            f"truths AS (SELECT unnest({listed(INTENTS)}) AS true_label)",
            "SELECT true_label, "
            + ", ".join(f"coalesce(sum(n) FILTER (predicted_label = {q(p)}), 0)::BIGINT AS {p}" for p in INTENTS)
            + " FROM truths LEFT JOIN confusion USING (true_label) GROUP BY true_label"),
        "model_delta": statement(
            *TO_CONFUSION, measured("confusion", INTENTS, "r_"),
            f"constant AS (SELECT intent AS true_label, {q(FALLBACK)} AS predicted_label, count(*) AS n FROM predicted GROUP BY ALL)",
            measured("constant", INTENTS, "m_"),
            "r AS (UNPIVOT r_overall ON * INTO NAME metric VALUE value)",
            "m AS (UNPIVOT m_overall ON * INTO NAME metric VALUE baseline_value)",
            """SELECT metric, 'rules' AS model, value, baseline_value, round(value - baseline_value, 4) AS delta,
              value > baseline_value AS beats_baseline FROM r JOIN m USING (metric)"""),
        "class_centroids": statement(
            VECTORS,
            "SELECT label, n, i - 1 AS position, round(c[i], 6) AS value FROM centers, range(1, 65) r(i)"),
        "centroid_predict": statement(
            VECTORS, "SELECT vec_id, predicted_intent, round(confidence, 6) AS confidence FROM nearest"),
        "centroid_metrics": statement(
            VECTORS,
            "confusion AS (SELECT intent AS true_label, predicted_intent AS predicted_label, count(*) AS n FROM nearest GROUP BY ALL)",
            measured("confusion", VECTOR_LABELS), "SELECT * FROM overall"),
        "nmf_factors": statement(
            _factors(),
            f"""SELECT 1::BIGINT AS topic_id, term, round(a, 5) AS weight FROM h{FACTOR_ROUNDS}
            UNION ALL SELECT 2, term, round(b, 5) FROM h{FACTOR_ROUNDS}"""),
        "nmf_residuals": statement(_factors(), _residuals()),
        "newton_predict": statement(
            VECTORS, _logistic(),
            """SELECT vec_id, arg_max(label, score) AS predicted_intent, round(max(exp(score)) / sum(exp(score)), 4) AS confidence
            FROM (SELECT vec_id, label, list_inner_product(list_append(v, 1.0::DOUBLE), w) AS score
                  FROM (SELECT vec_id, v FROM vectors WHERE NOT is_train), fitted) GROUP BY vec_id"""),
        # The objective is convex and the SQL reaches its optimum: the fitted model's gradient must be as small there.
        "newton_certificate": statement(
            VECTORS, "SELECT DISTINCT label, true AS within FROM vectors WHERE is_train"),
        "confidence_stats": statement(
            VECTORS,
            """SELECT round(avg(confidence), 6) AS mean, round(quantile_cont(confidence, 0.5), 6) AS median,
              round(stddev_pop(confidence), 6) AS std, round(min(confidence), 6) AS min, round(max(confidence), 6) AS max,
              round(quantile_cont(confidence, 0.25), 6) AS p25, round(quantile_cont(confidence, 0.75), 6) AS p75 FROM nearest"""),
        "class_weights": statement(
            *TO_CLEAN, labelled("clean"),
            """SELECT intent, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)::DOUBLE), 6) AS weight
            FROM labelled GROUP BY intent"""),
        "tfidf_weights": statement(
            *TO_SPLIT, _tfidf(), "SELECT pair_id, term, round(w / norm, 6) AS weight FROM raw JOIN norm USING (pair_id)"),
    }
    # Files are compared with what was written to them.
    sql["kmeans_vectors"], sql["minibatch_vectors"] = _kmeans(), _minibatch()
    sql["confusion_file"], sql["metrics_file"] = sql["confusion_matrix"], sql["classification_overall"]
    return sql
