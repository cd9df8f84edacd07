"""Language identification by interpolated Kneser-Ney character language models.

One model per language is fitted on a bounded sample of labelled documents. All models share one sorted array of n-gram
hashes per order; a row holds the log probability of the n-gram under every language, back-off included, so scoring
a text is one binary search per character and, for n-grams no language has seen, one for the context and the shorter
n-gram. A text gets the language of the lowest cross-entropy per character. Its score is a probability with a
temperature fitted on held-back sample documents, and a text that is less likely than nearly all held-back texts of its
length, by a margin, is marked as rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom.llm.rows import whole_row
from replyloom.operators.ordering import first_rows
from replyloom.session import materialize

UNKNOWN = "und"
ORDER = 4
DISCOUNT = 0.75
#: Documents per language the models are fitted on, of which every fifth calibrates. A documented bound.
SAMPLE_DOCUMENTS = 400
SAMPLE_CHARS = 4_000_000
CHUNK_CHARS = 1 << 17
#: Least numbers of symbols of the length classes for rejection; the share of calibration texts below a class's bound before
#: its margin.
LENGTHS = (16, 64, 256, 1024)
ACCEPTED = 0.95
MARGIN = 1.6
MIX = np.uint64(0x9E3779B97F4A7C15)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and the symbol it is scored as.

    Letters are scored in lower case, everything else as a space.
    """
    if not _TABLES:
        letter = np.zeros(0x110000, dtype=bool)
        symbol = np.full(0x110000, 32, dtype=np.uint32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                lower = c.lower()
                letter[point], symbol[point] = True, ord(lower) if len(lower) == 1 else point
        _TABLES.update(letter=letter, symbol=symbol)
    return _TABLES["letter"], _TABLES["symbol"]


def symbols(points: np.ndarray) -> np.ndarray:
    """Scored symbols: runs of other than letters are one space."""
    letter, symbol = _tables()
    out = symbol[points]
    space = ~letter[points]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return out[keep]


def _hashes(s: np.ndarray, n: int) -> np.ndarray:
    """One hash per n-gram of ``s``; an n-gram's hash starts from that of its first symbol."""
    h = np.zeros(len(s) - n + 1, dtype=np.uint64)
    for i in range(n):
        h = (h ^ s[i : len(s) - n + 1 + i]) * MIX
        h ^= h >> np.uint64(29)
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted array, and which of them are there."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Models:
    """Sorted hashes per order with a matrix (n-gram, language) of log probabilities and of back-off weights."""

    languages: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    unseen: np.ndarray
    temperature: float
    worst: np.ndarray

    def log_probabilities(self, s: np.ndarray, first: int) -> np.ndarray:
        """Per position from ``first`` on, and language, the log probability of the symbol after what precedes it."""
        count = len(s) - first
        total = np.zeros((count, len(self.languages)), dtype=np.float32)
        # The longest n-gram that fits; only the first positions of a text have shorter ones.
        open_rows = np.arange(count)
        for n in range(ORDER, 0, -1):
            usable = open_rows[open_rows + first >= n - 1]
            waiting = open_rows[open_rows + first < n - 1]
            if not len(usable):
                continue
            at, seen = _find(self.grams[n - 1], _hashes(s, n)[usable + first - n + 1])
            total[usable[seen]] += self.logs[n - 1][at[seen]]
            missed = usable[~seen]
            if n == 1:
                total[missed] += self.unseen
                break
            if len(missed):
                where, known = _find(self.contexts[n - 1], _hashes(s, n - 1)[missed + first - n + 1])
                total[missed[known]] += self.backoffs[n - 1][where[known]]
            open_rows = np.union1d(missed, waiting) if len(waiting) else missed
        return total

    def totals(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """Summed log probabilities of a whole text per language, chunk by chunk, and the number of symbols."""
        total = np.zeros(len(self.languages))
        for start in range(0, len(s), CHUNK_CHARS):
            begin = max(0, start - ORDER + 1)
            part = s[begin : start + CHUNK_CHARS]
            total += self.log_probabilities(part, start - begin).sum(axis=0, dtype=np.float64)
        return total, len(s)

    def bound(self, language: int, count: int) -> float:
        """The highest cross-entropy of an accepted text of ``count`` symbols: that of the class at or below its length."""
        # Texts shorter than the least class scatter more, as the root of their length.
        widen = math.sqrt(max(1.0, LENGTHS[0] / count))
        return float(self.worst[np.searchsorted(LENGTHS[1:], count, side="right"), language]) * widen

    def decide(self, total: np.ndarray, count: int) -> tuple[str, float, float, bool]:
        """Language, score, cross-entropy per character, and whether the text is rejected."""
        entropy = -total / count
        best = int(np.lexsort((np.arange(len(entropy)), entropy))[0])
        margin = (total[best] - total) / self.temperature
        score = 1.0 / float(np.exp(-np.minimum(margin, 700)).sum())
        rejected = bool(entropy[best] > self.bound(best, count))
        return self.languages[best], score, float(entropy[best]), rejected


def _hashes_at(s: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that begin at the given places."""
    h = np.zeros(len(at), dtype=np.uint64)
    for i in range(n):
        h = (h ^ s[at + i]) * MIX
        h ^= h >> np.uint64(29)
    return h


def _counts(s: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of texts that lie one after the other in ``s``: hash, hash without the last symbol, without the first, count.

    ``ends`` are the ends of the texts. What lies before and after an n-gram is hashed for one of its places only.
    """
    starts = np.append(0, ends[:-1])
    at = np.concatenate([np.arange(a, max(a, b - n + 1)) for a, b in zip(starts, ends)]).astype(np.int64)
    keys, index, count = np.unique(_hashes_at(s, at, n), return_index=True, return_counts=True)
    return keys, _hashes_at(s, at[index], n - 1), _hashes_at(s, at[index] + 1, n - 1), count


def _lookup(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at, there = _find(keys, wanted)
    return np.where(there, values[at], missing)


def _fit_language(parts: list[np.ndarray]) -> list[tuple]:
    """Per order (n-gram hashes, probabilities, context hashes, back-off weights, right parts, left parts) of one language.

    The highest order uses counts, the lower ones the number of different symbols seen before the n-gram.
    """
    s, ends = np.concatenate(parts).astype(np.uint32), np.cumsum([len(p) for p in parts])
    tables = {n: _counts(s, ends, n) for n in range(2, ORDER + 1)}
    out: list[tuple] = []
    lower_keys, lower_p, unseen = None, None, 0.0
    for n in range(1, ORDER + 1):
        if n == ORDER:
            keys, left, right, count = tables[n]
            count = count.astype(float)
        else:
            # Distinct (n+1)-grams that end in this n-gram.
            keys, count = np.unique(tables[n + 1][2], return_counts=True)
            count = count.astype(float)
            if n > 1:
                base, left_of, right_of, _ = tables[n]
                at = np.searchsorted(base, keys)
                left, right = left_of[at], right_of[at]
        if n == 1:
            total = max(count.sum(), 1.0)
            spare = DISCOUNT * len(keys) / total
            # The probability of a symbol no sample has: the spare mass over a nominal alphabet.
            unseen = max(spare, 1e-3) / 1024
            lower_keys, lower_p = keys, np.maximum(count - DISCOUNT, 0) / total + unseen
            out.append((keys, lower_p, None, None, None, None))
            continue
        contexts, inverse = np.unique(left, return_inverse=True)
        totals = np.bincount(inverse, weights=count)
        kinds = np.bincount(inverse)
        weight = DISCOUNT * kinds / totals
        p = np.maximum(count - DISCOUNT, 0) / totals[inverse] + weight[inverse] * _lookup(lower_keys, right, lower_p, unseen)
        out.append((keys, p, contexts, weight, right, left))
        lower_keys, lower_p = keys, p
    out.append((unseen,))
    return out


def _merge(languages: list[str], fitted: list[list[tuple]]) -> Models:
    """One sorted array per order; a language that has not seen an n-gram backs off within its own model."""
    width = len(languages)
    unseen = np.array([f[ORDER][0] for f in fitted])
    grams, logs, contexts, backoffs = [], [], [], []
    lower = None
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([f[n - 1][0] for f in fitted]))
        p = np.empty((len(keys), width))
        if n > 1:
            left_of, right_of = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
            for f in fitted:
                at = np.searchsorted(keys, f[n - 1][0])
                left_of[at], right_of[at] = f[n - 1][5], f[n - 1][4]
            context = np.unique(np.concatenate([f[n - 1][2] for f in fitted]))
            weight = np.ones((len(context), width))
        for k, f in enumerate(fitted):
            own_keys, own_p = f[n - 1][0], f[n - 1][1]
            if n == 1:
                p[:, k] = _lookup(own_keys, keys, own_p, unseen[k])
                continue
            weight[:, k] = _lookup(f[n - 1][2], context, f[n - 1][3], 1.0)
            backed = weight[np.searchsorted(context, left_of), k] * _lookup(lower[0], right_of, lower[1][:, k], unseen[k])
            exact = _lookup(own_keys, keys, own_p, np.nan)
            p[:, k] = np.where(np.isnan(exact), backed, exact)
        grams.append(keys)
        logs.append(np.log(p).astype(np.float32))
        contexts.append(context if n > 1 else np.empty(0, np.uint64))
        backoffs.append(np.log(weight).astype(np.float32) if n > 1 else np.empty((0, width), np.float32))
        lower = (keys, p)
    return Models(languages, grams, logs, contexts, backoffs, np.log(unseen).astype(np.float32), 1.0, np.zeros((len(LENGTHS), width)))


def _calibrate(models: Models, texts: list[tuple[str, np.ndarray]]) -> None:
    """Temperature by the likelihood of the true languages, and each language's highest cross-entropy."""
    scored = [(models.languages.index(lang), *models.totals(s)) for lang, s in texts if len(s)]
    if not scored:
        models.worst = np.full((len(LENGTHS), len(models.languages)), np.inf)
        return
    best = None
    for temperature in [2.0**k for k in range(0, 13)]:
        loss = 0.0
        for lang, total, _ in scored:
            margin = (total - total.max()) / temperature
            loss += float(np.log(np.exp(margin).sum()) - margin[lang])
        loss += 1e-3 * abs(math.log(temperature))
        if best is None or loss < best[0]:
            best = (loss, temperature)
    models.temperature = best[1]
    # A text of any length gives its beginning to each class up to it, so that every class has its own quantile and one odd
    # document moves none. Classes without texts take the bound of the class below.
    models.worst = np.full((len(LENGTHS), len(models.languages)), np.inf)
    for c, length in enumerate(LENGTHS):
        entropies: list[list[float]] = [[] for _ in models.languages]
        for lang, s in texts:
            if len(s) >= length:
                k = models.languages.index(lang)
                total, count = models.totals(s[: 4 * length])
                entropies[k].append(-total[k] / count)
        overall = [e for own in entropies for e in own]
        for k, own in enumerate(entropies):
            if own or overall:
                models.worst[c, k] = MARGIN * float(np.quantile(own or overall, ACCEPTED))
            elif c:
                models.worst[c, k] = models.worst[c - 1, k]


def training_fold(doc_id: Column, folds: int = 4, held: int = 2) -> Column:
    """True for documents whose CRC-32 of the id as text leaves another remainder than ``held``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds != held


def _sample(documents: DataFrame, sample: int, chars: int) -> DataFrame:
    """(lang, _order, text): the first documents of every language by hash, the text in which ``chars`` is reached cut there.

    Counts per 2^16 hash prefixes tell up to which prefix a language's sample can reach, so that only these rows are ranked.
    """
    usable = documents.filter("lang IS NOT NULL AND text IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    # Rows of one id have one order; their texts break the tie, and rows equal in both are one document.
    order, tie = F.xxhash64(F.lit("language sample"), "doc_id"), F.xxhash64("text")
    ranked = usable.select("lang", order.alias("_order"), tie.alias("_tie"), F.char_length("text").alias("_chars"))
    ranked = ranked.withColumn("_prefix", F.shiftright("_order", 48))
    counts = materialize(ranked.groupBy("lang", "_prefix").agg(F.count(F.lit(1)).alias("n")))
    earlier = Window.partitionBy("lang").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    rows, drawn = sample, None
    while drawn is None:
        # A few rows per language, written so that Spark knows they are small and does not move the texts to join them.
        last, complete = F.max(F.when(F.col("before") < rows, F.col("_prefix"))), F.max(F.col("before") + F.col("n")) <= rows
        reached = materialize(placed.groupBy("lang").agg(last.alias("_last"), complete.alias("_complete")))
        near = ranked.join(reached, "lang").filter(F.col("_prefix") <= F.col("_last"))
        near = near.select("lang", "_complete", "_order", "_tie", "_chars").distinct()
        drawn = materialize(first_rows(near, ["lang"], ["_order", "_tie"], sample))
        # Only where rows repeat can a sample be short of documents that lie further on.
        short = drawn.groupBy("lang", "_complete").agg(F.count(F.lit(1)).alias("n")).filter(f"NOT _complete AND n < {sample}")
        if not short.isEmpty():
            rows, drawn = 8 * rows, None
    drawn = drawn.drop("_complete")
    before = Window.partitionBy("lang").orderBy("_order", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    limits = materialize(
        drawn.withColumn("_room", F.lit(chars) - F.coalesce(F.sum("_chars").over(before), F.lit(0))).filter("_room > 0")
    )
    rows = usable.select("lang", order.alias("_order"), tie.alias("_tie"), "text").join(limits, ["lang", "_order", "_tie"])
    cut = F.substring("text", F.lit(1), F.least(F.col("_room"), F.lit(chars)).cast("int"))
    return rows.select("lang", "_order", cut.alias("text")).distinct()


_ARRAYS = ["grams", "p", "contexts", "weights", "right", "left"]
_FITTED = "lang STRING, n INT, " + ", ".join(f"{name} BINARY" for name in _ARRAYS)


def _fit_task(table: pa.Table) -> pa.Table:
    """The tables of one language's sample as rows: its orders, then the unseen probability (0), then held-back texts (-1)."""
    rows = sorted(zip(table.column("_order").to_pylist(), table.column("text").to_pylist()))
    lang = table.column("lang")[0].as_py()
    train, held = [], []
    for i, (_, text) in enumerate(rows):
        (held if i % 5 == 4 else train).append(symbols(_code_points(text)))
    fitted = _fit_language(train)
    out = [(lang, n, *[None if a is None else a.tobytes() for a in t]) for n, t in enumerate(fitted[:ORDER], start=1)]
    out.append((lang, 0, None, np.array([fitted[ORDER][0]]).tobytes(), None, None, None, None))
    out += [(lang, -1, s.tobytes(), None, None, None, None, None) for s in held]
    types = [pa.string(), pa.int32(), *[pa.binary()] * len(_ARRAYS)]
    names = ["lang", "n", *_ARRAYS]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def fit(documents: DataFrame, sample: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> Models | None:
    """Models of the languages of ``documents`` (doc_id, text, lang), all of which may be learned from.

    Per language ``sample`` documents are drawn by hash of the id, up to ``chars`` code points in all, where the last text is
    cut; one task counts the n-grams of one language's sample, and the driver merges their tables. Null texts, labels and texts without
    letters are left out. Returns None when nothing is left.
    """
    fitted = _sample(documents, sample, chars).groupBy("lang").applyInArrow(_fit_task, _FITTED).toArrow()
    if not fitted.num_rows:
        return None
    kinds = [np.uint64, np.float64, np.uint64, np.float64, np.uint64, np.uint64]
    tables: dict[str, dict[int, tuple]] = {}
    held = []
    for row in range(fitted.num_rows):
        lang, n = fitted.column(0)[row].as_py(), fitted.column(1)[row].as_py()
        values = [fitted.column(2 + i)[row].as_buffer() for i in range(len(_ARRAYS))]
        if n < 0:
            held.append((lang, np.frombuffer(values[0], np.uint32).astype(np.uint64)))
        else:
            tables.setdefault(lang, {})[n] = tuple(None if v is None else np.frombuffer(v, k) for v, k in zip(values, kinds))
    languages = sorted(tables)
    models = _merge(languages, [[tables[lang][n] for n in range(1, ORDER + 1)] + [(float(tables[lang][0][1][0]),)] for lang in languages])
    _calibrate(models, sorted(held, key=lambda h: (h[0], len(h[1]), h[1].tobytes())))
    return models


PREDICTION = "lang_pred STRING, score DOUBLE, cross_entropy DOUBLE, rejected BOOLEAN"


def predict(documents: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected``; only ``text`` is looked at.

    A text that is null or has no letter is ``und`` with score 0, no cross-entropy, and rejected; so is every
    text when there are no models. The other columns pass through as they are, but those with an added name are replaced.
    """
    added = T.StructType.fromDDL(PREDICTION)
    judged = _judged(documents.select(whole_row(documents, tuple(added.names)).alias("row")), text, models)
    return judged.select("row.*", *added.names)


def known_languages(documents: DataFrame, models: Models | None) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    judged = _judged(documents.select(whole_row(documents).alias("row")), "text", models)
    return judged.filter("NOT rejected").select("row.*")


def _judged(rows: DataFrame, text: str, models: Models | None) -> DataFrame:
    """``rows`` (row: a struct that holds the text) with the prediction; a text goes through Arrow once."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        letter, _ = _tables()
        for batch in batches:
            found: list[tuple] = []
            for value in batch.column(0).field(text):
                points = _code_points(value.as_py() or "")
                if model is None or not letter[points].any():
                    found.append((UNKNOWN, 0.0, None, True))
                    continue
                found.append(model.decide(*model.totals(symbols(points).astype(np.uint64))))
            lang, score, entropy, rejected = zip(*found) if found else ([], [], [], [])
            added = [
                pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()),
                pa.array(rejected, pa.bool_()),
            ]
            names = ["row", "lang_pred", "score", "cross_entropy", "rejected"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *added], names=names)

    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL(PREDICTION).fields])
    return rows.mapInArrow(run, schema)
