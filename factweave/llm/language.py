"""Language identification by character language models.

One interpolated Kneser-Ney model per language, over the characters of a word between boundary marks.
The n-grams of all languages stand in arrays sorted by hash, with one column of log-probabilities a language.
A text gets the language of the lowest cross-entropy per character; the score is calibrated on training
words.  A caller may reject below a score, and texts whose cross-entropy is over what words kept from the fit show.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import give_back, runs, small_batches, spans_hash, text_blocks, text_or_empty

UND = "und"
#: Documents a language that a model is fitted on; of more than SAMPLE // DOCS_PER_LANG languages each has fewer: the documented bound of the fit.
DOCS_PER_LANG, SAMPLE = 300, 60_000
ORDER, DISCOUNT = 5, 0.75
#: Words whose scores a worker remembers before it starts anew.
MEMO = 400_000

#: What parts words, in training and scoring alike.
NO_LETTERS = r"[^\p{L}\p{M}]+"
#: The limit of rejection: this share of texts of so many words from the language pass it.
PASS, TEXT_WORDS = 0.99, 8


@dataclass
class Models:
    """``keys`` (sorted) hashes n-grams of all orders; ``logp`` and ``backoff`` have a column a language."""

    langs: list[str]
    keys: np.ndarray
    logp: np.ndarray
    backoff: np.ndarray
    floor: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    limit: np.ndarray | None = None  # cross-entropy a character by language, over which a text is of none


def limits(counts: dict[str, dict[str, int]]) -> np.ndarray:
    """The calibrated limits: models fitted on four fifths of the words judge texts drawn from the rest."""
    out = []
    for lang in sorted(counts):
        held = [w for w in sorted(counts[lang]) if gram_hash(w) % 5 == 0]
        rest = {w: c for w, c in counts[lang].items() if gram_hash(w) % 5}
        if not held or not rest:
            out.append(np.inf)
            continue
        s, n = word_scores(_arrays([lang], [fit_one(rest)]), held)
        drawn = np.random.default_rng(3).integers(0, len(held), (1000, TEXT_WORDS))
        out.append(float(np.quantile(-s[:, 0][drawn].sum(axis=1) / n[drawn].sum(axis=1), PASS)))
    return np.array(out)


def gram_hash(g: str) -> int:
    h = 0xCBF29CE484222325
    for c in g:
        h = ((h ^ ord(c)) * 0x100000001B3) & (2**64 - 1)
    return h


def fit_one(words: dict[str, int], order: int = ORDER, d: float = DISCOUNT) -> tuple[dict[str, float], dict[str, float], float]:
    """Interpolated Kneser-Ney: log-probabilities of the n-grams seen, backoff weights of contexts, the floor."""
    counts: list[Counter] = [Counter() for _ in range(order + 1)]
    for w, c in words.items():
        s = "^" + w + "$"
        for i in range(1, len(s)):
            counts[order][s[max(0, i - order + 1) : i + 1]] += c  # those at a word's start are shorter
    grams: list[Counter] = [Counter() for _ in range(order + 1)]
    for g, c in counts[order].items():
        grams[len(g)][g] += c
    for n in range(order, 1, -1):  # lower orders count the different characters that stand before
        for g in list(grams[n]):
            grams[n - 1][g[1:]] += 1
    vocab = {g[-1] for g in grams[1]}
    uniform = 1.0 / (len(vocab) + 200)
    prob: dict[str, float] = {}
    back: dict[str, float] = {}
    total = sum(grams[1].values()) or 1
    for g, c in grams[1].items():
        prob[g] = max(c - d, 0) / total + d * len(grams[1]) / total * uniform
    floor = max(d * len(grams[1]) / total, 1e-3) * uniform
    for n in range(2, order + 1):
        sums, kinds = defaultdict(float), Counter()
        for g, c in grams[n].items():
            sums[g[:-1]] += c
            kinds[g[:-1]] += 1
        for ctx, t in sums.items():
            back[ctx] = d * kinds[ctx] / t
        for g, c in grams[n].items():
            ctx = g[:-1]
            prob[g] = max(c - d, 0) / sums[ctx] + back[ctx] * prob.get(g[1:], floor)
    return {g: float(np.log(p)) for g, p in prob.items()}, {g: float(np.log(b)) for g, b in back.items()}, float(np.log(floor))


def _arrays(langs: list[str], parts: list) -> Models:
    """The models of all languages in arrays sorted by hash."""
    grams = sorted({g for p, b, _ in parts for g in (*p, *b)})
    keys = np.array([gram_hash(g) for g in grams], np.uint64)
    order = np.argsort(keys)
    logp = np.full((len(grams), len(langs)), np.nan, np.float32)
    backoff = np.zeros((len(grams), len(langs)), np.float32)
    at = {g: i for i, g in enumerate(grams)}
    for k, (p, b, _) in enumerate(parts):
        for g, v in p.items():
            logp[at[g], k] = v
        for g, v in b.items():
            backoff[at[g], k] = v
    return Models(langs, keys[order], logp[order], backoff[order], np.array([f for *_, f in parts], np.float32))


def fit(counts: dict[str, dict[str, int]]) -> Models:
    """Models from word counts by language, and the calibration of the score on the same words."""
    langs = sorted(counts)
    m = _arrays(langs, [fit_one(counts[x]) for x in langs])
    m.limit = limits(counts)
    if len(langs) > 1:  # the margin at which a word's best language is right half of the time sets the scale
        margins, right = [], []
        for k, x in enumerate(langs):
            some = sorted(counts[x], key=lambda w: (gram_hash(w), w))[:2000]
            s, n = word_scores(m, some)
            ce = s / n[:, None]
            two = np.sort(ce, axis=1)
            margins.append(two[:, -1] - two[:, -2])
            right.append(ce.argmax(axis=1) == k)
        x, y = np.concatenate(margins), np.concatenate(right).astype(float)
        a, b = 1.0, 0.0
        for _ in range(200):  # logistic regression on one variable
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([((y - p) * x).sum() - 0.01 * a, (y - p).sum()])
            w = p * (1 - p)
            h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a + step[0], b + step[1]
            if np.abs(step).max() < 1e-8:
                break
        m.slope, m.shift = float(max(a, 0.1)), float(b)
    return m


def lookup(m: Models, hashes: np.ndarray) -> np.ndarray:
    """Row of each hash in the sorted array, or -1."""
    if not len(m.keys):
        return np.full(len(hashes), -1)
    i = np.minimum(np.searchsorted(m.keys, hashes), len(m.keys) - 1)
    return np.where(m.keys[i] == hashes, i, -1)


def word_scores(m: Models, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-probabilities (words x languages) and the characters predicted, word end included."""
    text = [f"^{w}$" for w in words]
    n = np.array([len(t) - 1 for t in text])
    codes = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(n + 1)])
    pos = np.arange(len(codes)) - np.repeat(start[:-1], n + 1)
    out = np.zeros((len(codes), len(m.langs)), np.float64)
    done = np.zeros((len(codes), len(m.langs)), bool)
    bonus = np.zeros((len(codes), len(m.langs)), np.float64)
    for order in range(ORDER, 0, -1):
        ok = np.flatnonzero(pos >= max(order - 1, 1))
        h, ctx = np.full(len(ok), 0xCBF29CE484222325, np.uint64), None
        for j in range(order - 1, -1, -1):
            ctx = h if j == 0 else ctx
            h = (h ^ codes[ok - j]) * np.uint64(0x100000001B3)
        row = lookup(m, h)
        p = np.where(row[:, None] >= 0, m.logp[row], np.nan)
        new = ~np.isnan(p) & ~done[ok]
        out[ok] = np.where(new, p + bonus[ok], out[ok])
        done[ok] |= new
        if order > 1:
            row = lookup(m, ctx)
            bonus[ok] += np.where(~done[ok] & (row[:, None] >= 0), m.backoff[row], 0)
    out = np.where(done, out, m.floor + bonus)
    out[start[:-1]] = 0  # the mark of a word's start is given
    return np.add.reduceat(out, start[:-1], axis=0) if len(words) else np.zeros((0, len(m.langs))), n


def training_counts(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> dict[str, dict[str, int]]:
    """Word counts of at most ``per_lang`` documents (the smallest hashes of doc_id) of each language."""
    known = docs.where("lang is not null and text is not null")
    langs = known.agg(F.count_distinct("lang")).first()[0]
    per_lang = min(per_lang, max(1, SAMPLE // max(langs, 1)))
    order = W.partitionBy("lang").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id")
    ids = known.select("lang", "doc_id").withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_lang).select("doc_id").distinct()
    if langs <= SAMPLE:  # so there are SAMPLE ids at most
        ids = F.broadcast(ids)
    words = (
        known.join(ids, "doc_id", "left_semi")
        .select("lang", F.explode(F.split(F.lower("text"), NO_LETTERS)).alias("word"))
        .where("word != ''")
        .groupBy("lang", "word")
        .count()
    )
    out: dict[str, dict[str, int]] = defaultdict(dict)
    for r in words.select("lang", "word", "count").orderBy("lang", "word").collect():  # of a bounded sample
        out[r["lang"]][r["word"]] = r["count"]
    return dict(out)


class Judge:
    """Scores texts on a worker; a word's scores are computed once and kept by its hash."""

    def __init__(self, m: Models):
        self.m = m
        self.forget()

    def forget(self):
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, len(self.m.langs) + 1), np.float32)

    def rows_of(self, hashes: np.ndarray, first: np.ndarray, spell) -> np.ndarray:
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            s, n = word_scores(self.m, [spell(i) for i in first[new]])
            if len(self.keys) + len(new) > MEMO:
                held = self.rows[at[known]]
                self.keys, self.rows = hashes[known], held
            keys, rows = np.concatenate([self.keys, hashes[new]]), np.concatenate([self.rows, np.column_stack([s, n]).astype(np.float32)])
            order = np.argsort(keys)
            self.keys, self.rows = keys[order], rows[order]
            at = np.searchsorted(self.keys, hashes)
        return self.rows[at]

    def block(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text (words between spaces): index of the best language, score, cross-entropy, and the number of words."""
        starts, ends, first = runs(buf != 32, offs)
        words = np.diff(first)
        h = spans_hash(buf, starts, ends)
        keys, one, back = np.unique(h, return_index=True, return_inverse=True)
        spell = lambda i: bytes(buf[starts[i] : ends[i]]).decode("utf-8", "replace")
        got = self.rows_of(keys, one, spell).astype(np.float64)
        total = np.concatenate([np.zeros((1, got.shape[1])), np.cumsum(got[back], axis=0)])
        sums = total[first[1:]] - total[first[:-1]]
        ce = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        best = ce.argmax(axis=1)
        top = ce.max(axis=1)
        margin = top - np.partition(ce, -2, axis=1)[:, -2] if ce.shape[1] > 1 else np.ones(len(ce))
        score = 1 / (1 + np.exp(-np.clip(self.m.slope * margin * np.sqrt(words) + self.m.shift, -50, 50)))
        return best, score, -top, words


def identify(docs: DataFrame, train: DataFrame, reject_below: float = 0.0, reject_foreign: bool = False) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row of ``docs``; only its text is read.

    ``train`` has doc_id, text, lang.  ``und`` with score 0: null text, no letter, or no language learned;
    ``und`` also where the score is under ``reject_below``, and with ``reject_foreign`` where the best language's cross-entropy is over
    its calibrated limit.  Equal cross-entropies go to the language that sorts first.  Repeated rows are judged alike; whole texts of
    any length count; other columns, whatever their names, are ignored.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(fit(training_counts(train)))

    def judge(batches):
        me = Judge(held.value)
        langs = np.array([*held.value.langs, UND], dtype=object)
        for b in batches:
            n = b.num_rows
            lang, score = np.full(n, len(langs) - 1), np.zeros(n)
            if len(langs) > 1:
                letters = b.column(2).to_numpy(zero_copy_only=False)
                for row, buf, offs in text_blocks(b.column(1)):
                    k = slice(row, row + len(offs) - 1)
                    best, s, ce, words = me.block(buf, offs)
                    known = letters[k] & (words > 0)
                    lang[k], score[k] = np.where(known, best, len(langs) - 1), np.where(known, s, 0.0)
                    foreign = ce > held.value.limit[best] if reject_foreign else np.zeros(len(ce), bool)
                    lang[k] = np.where((s < reject_below) | foreign, len(langs) - 1, lang[k])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs[lang], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])
        give_back()

    # words are cut by the expression that cut the training texts
    words = F.regexp_replace(F.lower(text_or_empty()), NO_LETTERS, " ")
    letters = text_or_empty().rlike(r"\p{L}")
    return docs.select("doc_id", words.alias("words"), letters.alias("letters")).mapInArrow(judge, "doc_id long, lang_pred string, score double")
