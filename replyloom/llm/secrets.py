"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every text is addressed by its SHA-256. The ledger holds one row per (blob, rule version)
with the findings, so a blob is scanned once however many paths or versions carry it, and a later run scans only
pairs the ledger does not hold. Findings are joined back to all paths. Everything runs as Spark expressions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyloom.llm.rows import whole_row
from replyloom.session import materialize


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; ``group`` must have ``least`` characters.

    ``hint``: a literal every match contains, tested first because it is cheap.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hint: str | None = None


ASSIGN = Rule(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    group=2,
    least=6,
)
#: Runs are maximal, so asking for their length in the pattern finds the same spans as dropping short ones.
ACCESS = Rule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA")
HEX = Rule("hex", r"[0-9a-f]{24,}")
PEM = Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", hint="PRIVATE KEY-----")
FORGE = Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}", hint="gh")
BASE = (ASSIGN, ACCESS, HEX)
RULES = (*BASE, PEM, FORGE)
#: A whole private key. It ends with its END line; where that is missing, or another key begins before it, with the base64
#: lines that follow. Repeated groups are possessive, which Java matches without a stack.
KEY = Rule(
    "pem",
    PEM.pattern
    + r"""(?:(?:[^-]++|-(?!----(?:BEGIN|END)\x20))*+-----END [A-Z ]{0,30}PRIVATE KEY-----"""
    + r"""|(?:(?:\s|\\[nr])*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:"""
    + r"""(?:(?:(?:[\s"'>|,;]|\\[nr])*+[A-Za-z0-9+/=]{16,}+)++(?:[\s"'>|,;]|\\[nr])*+|["'\x20\t]*+(?:[\r\n]|\\[nr])[\s"'>|]*+)"""
    + r"""[A-Za-z0-9+/]{1,15}+(?:={1,2}|(?=[\x20\t\r"',;]*(?:\n|\z|\\[nr])))|"""
    + r"""(?:(?:[\s"'>|,;]|\\[nr])*+[A-Za-z0-9+/=]{16,}+)*+))""",
    hint=PEM.hint,
)
#: What ``redact`` replaces: the findings of ``RULES``, private keys with their bodies.
REDACTED = (*BASE, KEY, FORGE)


def rules_version(rules: tuple[Rule, ...]) -> int:
    """A number that follows from what the rules look for and return, so that findings of other rules are never taken for theirs."""
    told = repr([(r.kind, r.pattern, r.group, r.least) for r in rules])
    return int(hashlib.sha256(told.encode()).hexdigest()[:15], 16)


SPAN = "ARRAY<STRUCT<start: BIGINT, rule: INT, end: BIGINT>>"


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Lengths around each match of one rule, as an array of structs; empty where nothing matches.

    The lengths of the gaps and of the matches before it give a match its place, in code points.
    """
    pattern = F.lit(rule.pattern)
    found = text.rlike(rule.pattern)
    if rule.hint:
        found = text.contains(rule.hint) & found
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), tested.alias("tested")),
        lambda m, i: F.struct(
            F.lit(number).alias("rule"),
            i.alias("at"),
            m["gap"].cast("bigint").alias("gap"),
            m["hit"].cast("bigint").alias("hit"),
            (m["tested"] >= rule.least).alias("kept"),
        ),
    )
    return F.when(found, rows)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(sha, spans) of the blobs (sha, text) in which something was found; spans by start, then rule."""
    found = F.concat(*[F.coalesce(_matches(F.col("text"), r, n), F.array()) for n, r in enumerate(rules)])
    order = Window.partitionBy("sha", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.col("gap") + F.col("hit")).over(order)
    return (
        blobs.select("sha", F.inline(found))
        .distinct()  # a row that is repeated with its path and text gives every match again
        .withColumn("end", ends)
        .filter("kept")
        .groupBy("sha")
        .agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("hit")).alias("start"), "rule", "end"))).alias("spans"))
    )


def addressed(documents: DataFrame, path: str = "doc_id", content: str = "text") -> DataFrame:
    """(path, sha, text) of every document; a null text is the empty blob."""
    text = F.coalesce(F.col(content), F.lit(""))
    return documents.select(F.col(path).alias("path"), F.sha2(text.cast("binary"), 256).alias("sha"), text.alias("text"))


def update_ledger(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """New ledger rows (sha, rule_version, spans) for the blobs of ``versions`` (path, sha, text) not yet scanned.

    One path per blob is chosen, and only its text is moved and scanned. Blobs without findings get an
    empty array, so that they are not scanned again.
    """
    version = rules_version(rules)
    unseen = versions.groupBy("sha").agg(F.min("path").alias("path"))
    if ledger is not None:
        known = ledger.filter(F.col("rule_version") == version).select("sha").distinct()
        unseen = unseen.join(known, "sha", "left_anti")
    unseen = materialize(unseen)
    v, u = versions.alias("v"), unseen.alias("u")
    same = (F.col("v.sha") == F.col("u.sha")) & F.col("v.path").eqNullSafe(F.col("u.path"))
    found = scan(v.join(u, same, "left_semi").select("sha", "text"), rules)
    return unseen.select("sha").join(found, "sha", "left").select(
        "sha", F.lit(version).alias("rule_version"), F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, spans) for every path of ``versions`` (path, sha): the ledger's findings joined back.

    Only blobs with findings take part in the join, which keeps the clean majority out of it.
    """
    found = ledger.filter((F.col("rule_version") == rules_version(rules)) & (F.size("spans") > 0)).select("sha", "spans")
    return (
        versions.select("path", "sha")
        .join(found, "sha", "left")
        .select("path", "sha", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))
    )


def scan_documents(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, sha, spans) of all documents, with a ledger that starts empty and is written."""
    ledger = materialize(update_ledger(addressed(documents), None, rules))
    return findings(addressed(documents), ledger, rules)


def span_list(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end``, comma-joined in the order of the spans."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(documents: DataFrame) -> DataFrame:
    """Counts, a hash of the base spans and all spans, one row per document."""
    base = F.filter("spans", lambda s: s["rule"] < len(BASE))
    kinds = F.transform("spans", lambda s: s["rule"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("bigint").alias(f"n_{r.kind}") for n, r in enumerate(BASE)
    ]
    return scan_documents(documents).select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def redact(
    documents: DataFrame, rules: tuple[Rule, ...] = REDACTED, ledger: DataFrame | None = None
) -> DataFrame:
    """The same rows and columns, every span replaced by ``[kind]``; ``n_chars`` follows a changed text.

    A private key goes as a whole, with its body and END line.
    Overlapping spans are replaced by the mark of the one that starts first. A null text stays null. Blobs that ``ledger``, rows of an earlier
    ``update_ledger`` with the same rules, holds already are not scanned again.
    """
    known = materialize(update_ledger(addressed(documents), ledger, rules))
    if ledger is not None:
        known = known.unionByName(ledger.filter(F.col("rule_version") == rules_version(rules)).dropDuplicates(["sha"]))
    found = known.filter(F.size("spans") > 0).select(F.col("sha").alias("_sha"), F.col("spans").alias("_spans"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = F.col("text")
    # Spans in order of their start; one that begins before the furthest end so far adds no mark.
    step = F.aggregate(
        "_spans",
        F.struct(F.lit(0).cast("bigint").alias("to"), F.lit("").alias("out")),
        lambda done, s: F.struct(
            F.greatest(done["to"], s["end"]).alias("to"),
            F.when(s["start"] < done["to"], done["out"])
            .otherwise(
                F.concat(
                    done["out"],
                    F.substring(text, (done["to"] + 1).cast("int"), (s["start"] - done["to"]).cast("int")),
                    F.lit("["),
                    F.get(kinds, s["rule"]),
                    F.lit("]"),
                )
            )
            .alias("out"),
        ),
        lambda done: F.concat(done["out"], F.substring(text, (done["to"] + 1).cast("int"), F.char_length(text))),
    )
    sha = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    rows = documents.select(whole_row(documents).alias("_row"), "text", sha.alias("_sha")).join(found, "_sha", "left")
    out = rows.withColumn("_marked", F.when(F.col("_spans").isNull(), text).otherwise(step))
    own = {c: F.col("_row").getField(c) for c in documents.columns} | {"text": F.col("_marked")}
    if "n_chars" in own:
        changed = F.char_length("_marked").cast(documents.schema["n_chars"].dataType)
        own["n_chars"] = F.when(F.col("_spans").isNull(), own["n_chars"]).otherwise(changed)
    return out.select(*[own[c].alias(c) for c in documents.columns])
