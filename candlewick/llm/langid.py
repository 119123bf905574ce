"""Language of documents and of the stretches of mixed ones.

A sparse multinomial logistic regression on TF-IDF character n-grams is trained with follow-the-regularised-leader (per-coordinate
steps, elastic net), its scores are calibrated by a temperature on held-out cues. As its features are sums over words, a word's
score is worked out once a spelling; cues add up their words, and stretches their cues.
"""

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm import text as T
from candlewick.plans.lineage import shared_dir
from candlewick.sources.catalog import exists

LANGUAGES = ("en", "es", "fr", "pt", "de", "it", "ru", "nl", "ko")
# Other notations of the languages (ISO 639-2 codes and names), besides regional forms such as en-GB.
NOTATIONS = {
    "eng": "en", "english": "en", "spa": "es", "spanish": "es", "fre": "fr", "fra": "fr", "french": "fr", "por": "pt", "portuguese": "pt", "ger": "de", "deu": "de", "german": "de",
    "ita": "it", "italian": "it", "rus": "ru", "russian": "ru", "dut": "nl", "nld": "nl", "dutch": "nl", "kor": "ko", "korean": "ko",
}
#: The classifier is fitted on at most so many labelled documents of a language, each of at most so many characters, and as many cues in all.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_CUES = 150, 20_000, 15_000
LEAST_DOCS, EPOCHS = 6, 2
ORDERS = (1, 2, 3, 4, 5)
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 0.02, 0.01, 0.05
SHORTEST = 6  # cues of a stretch
SWITCH = 9.0  # what a change of language costs, in nats
FLOOR = -6.0  # least log probability that a cue gives a language
BOTH = 0.5  # share of cues of two lines or more that must show both languages of a bilingual text


def label(c: Column) -> Column:
    """One of ``LANGUAGES`` for any notation of it, else null."""
    s = F.lower(F.trim(c))
    base = F.regexp_extract(s, r"^([a-z]+)", 1)
    names = F.create_map(*(F.lit(x) for pair in [*NOTATIONS.items(), *((n, n) for n in LANGUAGES)] for x in pair))
    return F.try_element_at(names, base)


_LETTERS = re.compile(r"[\W\d_]+")


def plain(raw: str) -> str:
    return _LETTERS.sub("", unicodedata.normalize("NFC", raw.lower()))


def grams(word: str) -> list[str]:
    s = f"<{word}>"
    return [s[i : i + n] for n in ORDERS for i in range(len(s) - n + 1) if n > 1 or s[i] not in "<>"]


@dataclass
class Model:
    """Weights of n-grams, already times IDF and scale, over the temperature."""

    weights: dict[str, np.ndarray]
    temperature: float

    def word(self, word: str) -> np.ndarray:
        """Scores of one word: grams of two words are two words' grams, so scores add up."""
        out = np.zeros(len(LANGUAGES), np.float32)
        for g in grams(word):
            w = self.weights.get(g)
            if w is not None:
                out += w
        return out


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def _ftrl(examples: Iterable[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_features: int) -> np.ndarray:
    z, n = np.zeros((n_features, len(LANGUAGES))), np.zeros((n_features, len(LANGUAGES)))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for (ids, values), label in zip(examples, y.tolist(), strict=True):
        zs, ns = z[ids], n[ids]
        w = weights(zs, ns)
        p = np.exp(_log_softmax(values @ w))
        p[label] -= 1
        g = values[:, None] * p
        more = ns + g * g
        z[ids] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
        n[ids] = more
    return weights(z, n)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Trains twice: the second time without documents and cues that the first model holds to be mislabelled."""
    words = T.Words(lambda raw: 0 if plain(raw) else T.NOTHING)
    c = T.cues(texts, words, sounds=True)
    cut = np.flatnonzero(np.diff(c.cue)) + 1
    cues = [[plain(c.raw[i]) for i in part] for part in np.split(c.at, cut)] if len(c.at) else []
    docs = c.doc[np.r_[0, cut]] if len(c.at) else np.zeros(0, np.int64)
    rng = np.random.default_rng(7)
    order = rng.permutation(len(cues))[:SAMPLE_CUES]
    cues, docs = [cues[i] for i in order], docs[order]
    y = np.asarray(labels, np.int64)[docs] if len(cues) else np.zeros(0, np.int64)
    of_word = {w: Counter(grams(w)) for cue in cues for w in cue}
    with_word, with_gram = Counter(), Counter()
    for w, _ in {(w, d) for cue, d in zip(cues, docs.tolist(), strict=True) for w in cue}:
        with_word[w] += 1
        with_gram.update(of_word[w].keys())
    names = [g for g, k in with_gram.items() if k >= LEAST_DOCS]  # grams of few documents are parts of proper names
    number = {g: i for i, g in enumerate(names)}
    seen = Counter(g for cue in cues for g in {g for w in cue for g in of_word[w]})
    idf = np.array([np.log((1 + len(cues)) / (1 + seen[g])) + 1 for g in names]) * SCALE
    ids_of = {w: np.array([number[g] for g, k in c.items() if g in number for _ in range(k)], np.int64) for w, c in of_word.items()}
    rare = sorted(w for w, k in with_word.items() if k < LEAST_DOCS)

    def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, k = np.unique(np.concatenate([ids_of[w] for w in words]), return_counts=True)
        return ids, k * idf[ids]

    def thinned(cue: list[str]) -> list[str]:
        """Some of the cue's words, and rare words from anywhere: each word must count, and proper names must not."""
        kept = [w for w, r in zip(cue, rng.random(len(cue)).tolist(), strict=True) if r < 0.6] or cue
        return kept + [rare[i] for i in rng.integers(0, len(rare), 2).tolist()] if rare else kept

    whole = [features(cue) for cue in cues]
    held = np.arange(len(cues)) % 10 == 0
    use = ~held
    w, scores = np.zeros((len(names), len(LANGUAGES))), np.zeros((len(cues), len(LANGUAGES)))
    for _ in range(2):
        chosen = np.flatnonzero(np.tile(use, EPOCHS)) % max(len(cues), 1)
        w = _ftrl((features(thinned(cues[i])) for i in chosen.tolist()), y[chosen], len(names))
        for i, (ids, values) in enumerate(whole):
            scores[i] = values @ w[ids]
        by_doc = np.zeros((len(texts), len(LANGUAGES)))
        np.add.at(by_doc, docs, scores)
        right = by_doc.argmax(1)[docs] == y if len(cues) else use
        right &= scores.max(1) - scores[np.arange(len(y)), y] < 4 if len(cues) else True
        use = ~held & right
    check = held & right if len(cues) else held
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))
    loss = [-_log_softmax(scores[check] / t)[np.arange(check.sum()), y[check]].mean() if check.any() else 0.0 for t in grid]
    t = float(grid[int(np.argmin(loss))]) if check.any() else 1.0
    kept = np.flatnonzero(np.abs(w).sum(1))
    return Model({names[i]: (w[i] * idf[i] / t).astype(np.float32) for i in kept}, t)


def train(documents: DataFrame) -> Model:
    """Fits on a bounded sample of labelled documents, chosen by hash; the rest is scored only. Languages without labels can't be assigned.

    Of several documents of one id the one with the least hash of its text counts. The model is stored in the shared folder under a digest of the very
    texts, labels and settings it was fitted on; where there is one of that digest it is read instead of fitted anew.
    """
    short = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text", label(F.col("lang")).alias("y")).where("y is not null")
    nth = F.row_number().over(Window.partitionBy("y").orderBy("h", "doc_id", "t"))
    known = short.select("doc_id", "y", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    ids = [r.doc_id for r in known.withColumn("k", nth).where(F.col("k") <= SAMPLE_DOCS).select("doc_id").collect()]
    rows = short.where(F.col("doc_id").isin(ids)).collect() if ids else []
    one: dict[int, tuple[str, int]] = {}
    for r in rows:
        x = (r.text, LANGUAGES.index(r.y))
        key = lambda v: (hashlib.sha256(v[0].encode("utf-8", "surrogatepass")).digest(), v[1])
        one[r.doc_id] = min(one[r.doc_id], x, key=key) if r.doc_id in one else x
    sample = [one[i] for i in sorted(one)]
    settings = (LANGUAGES, SAMPLE_CUES, LEAST_DOCS, EPOCHS, ORDERS, ALPHA, BETA, L1, L2, SCALE)
    name = hashlib.sha256(repr((settings, sample)).encode("utf-8", "surrogatepass")).hexdigest()[:32]
    path = f"{shared_dir(documents.sparkSession)}/models/langid-{name}"
    if exists(documents.sparkSession, f"{path}/_SUCCESS"):
        return loaded(documents.sparkSession, path)
    model = fit([t for t, _ in sample], [y for _, y in sample])
    save(documents.sparkSession, model, path)
    return model


def save(spark: SparkSession, model: Model, path: str) -> None:
    """One row an n-gram; the temperature is in a row without one."""
    grams_, rows = [None, *model.weights], [[model.temperature], *(w.tolist() for w in model.weights.values())]
    table = pa.table({"gram": pa.array(grams_, pa.string()), "weights": pa.array(rows, pa.list_(pa.float64()))})
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(path)


def loaded(spark: SparkSession, path: str) -> Model:
    table = spark.read.schema("gram string, weights array<double>").parquet(path).toArrow()  # of the size of the model
    rows = dict(zip(table.column("gram").to_pylist(), table.column("weights").to_pylist(), strict=True))
    temperature = rows.pop(None)[0]
    return Model({g: np.array(w, np.float32) for g, w in rows.items()}, temperature)


class Scorer:
    """Scores of the spellings met so far, one row each; row 0 is what has no letters."""

    def __init__(self, model: Model) -> None:
        self.model, self.words = model, T.Words(self._code)
        self.of_plain: dict[str, int] = {}
        self.table, self.n = np.zeros((4096, len(LANGUAGES)), np.float32), 1

    def _code(self, raw: str) -> int:
        w = plain(raw)
        if not w:
            return T.NOTHING
        k = self.of_plain.get(w)
        if k is None:
            if self.n == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            k = self.of_plain[w] = self.n
            self.table[k] = self.model.word(w)
            self.n += 1
        return k

    def forget(self, limit: int = 1_000_000) -> None:
        """Between batches: lets go of the spellings when there are very many."""
        if self.n > limit:
            self.words = T.Words(self._code)
            self.of_plain, self.n = {}, 1


def stretches(logp: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, language) of the best division of cues into stretches of at least ``SHORTEST`` cues, a change costing ``SWITCH``."""
    n = len(logp)
    if n < 2 * SHORTEST:
        return [(0, n - 1, int(logp.sum(0).argmax()))]
    total = np.vstack([np.zeros(logp.shape[1]), np.cumsum(logp, 0)])
    best = np.full((n + 1, logp.shape[1]), -np.inf)  # of divisions of the first j cues whose last stretch has the language
    come = np.zeros((n + 1, logp.shape[1]), np.int64)
    from_, reach = np.zeros(logp.shape[1], np.int64), np.zeros(logp.shape[1])  # where the last stretch best begins
    for j in range(SHORTEST, n + 1):
        i = j - SHORTEST
        if i >= SHORTEST:
            enter = best[i].max() - SWITCH - total[i]
            better = enter > reach
            reach, from_ = np.where(better, enter, reach), np.where(better, i, from_)
        best[j], come[j] = total[j] + reach, from_
    out, j = [], n
    while j > 0:
        k = int(best[j].argmax())
        out.append((int(come[j, k]), j - 1, k))
        j = int(come[j, k])
    out.reverse()
    merged = [out[0]]
    for a, b, k in out[1:]:
        if k == merged[-1][2]:
            merged[-1] = (merged[-1][0], b, k)
        else:
            merged.append((a, b, k))
    return merged


def _assign(scorer: Scorer, texts: list[str | None], labels: list[str | None]) -> Iterator[tuple[int, int, int, str, float, str]]:
    """(text, first_cue, last_cue, lang, confidence, kind) of one batch; kind is ``single``, ``both`` or ``mixed``."""
    c = T.cues(texts, scorer.words, sounds=True)
    if not len(c.code):
        return
    starts = np.flatnonzero(np.r_[True, (c.line[1:] != c.line[:-1]) | (c.cue[1:] != c.cue[:-1])])
    lines = np.add.reduceat(scorer.table[c.code], starts)
    line_cue, line_doc = c.cue[starts], c.doc[starts]
    cue_starts = np.flatnonzero(np.r_[True, line_cue[1:] != line_cue[:-1]])
    scored = np.add.reduceat(lines, cue_starts)
    n_all = int(c.first_cue[-1] + max(c.n_cues[-1], 1))
    logp = np.zeros((n_all, len(LANGUAGES)), np.float32)
    logp[line_cue[cue_starts]] = np.maximum(_log_softmax(scored), FLOOR)
    worded = np.zeros(n_all, bool)
    worded[line_cue[cue_starts]] = True
    n_cues = np.maximum(c.n_cues, 1)
    by_doc = np.add.reduceat(logp, c.first_cue)
    top = by_doc.argmax(1)
    doc_of = np.repeat(np.arange(len(texts)), n_cues)
    # the largest gain of any run of cues of one text from another language: running sums less their least value so far
    d = (logp - logp[np.arange(n_all), top[doc_of]][:, None]).astype(np.float64)
    d[c.first_cue] -= 1e7  # so that no minimum of an earlier text counts
    sums = np.cumsum(d, 0)
    before = np.vstack([np.zeros(len(LANGUAGES)), sums[:-1]])
    before[c.first_cue] -= 1e7
    gain = np.maximum.reduceat((sums - np.minimum.accumulate(before, 0)).max(1), c.first_cue)
    # lines of two languages in the same cues
    line_p = _log_softmax(lines)
    sure = np.where(line_p.max(1) > np.log(0.7), line_p.argmax(1), -1)
    several = np.flatnonzero(np.r_[cue_starts[1:], len(line_cue)] - cue_starts > 1)
    n_several = np.bincount(line_doc[cue_starts[several]], minlength=len(texts))
    known = np.where(sure >= 0, 1 << np.maximum(sure, 0), 0)
    sets = np.bitwise_or.reduceat(known, cue_starts)
    two = np.array([bin(x).count("1") > 1 for x in range(1 << len(LANGUAGES))])[sets]
    n_two = np.bincount(line_doc[cue_starts], weights=two, minlength=len(texts))
    words_in = np.bincount(doc_of, weights=worded, minlength=len(texts))
    maybe_both = (n_two >= BOTH * np.maximum(n_several, 1)) & (n_two >= 0.4 * words_in) & (n_two >= 3)
    probability = np.exp(logp)

    def sure_of(a: int, b: int, k: int) -> float:
        w = worded[a : b + 1]
        return float(probability[a : b + 1, k][w].mean()) if w.any() else 0.0

    for i in np.flatnonzero(words_in > 0).tolist():
        f, n = int(c.first_cue[i]), int(n_cues[i])
        if maybe_both[i]:
            mine = sets[(line_doc[cue_starts] == i) & two]
            count = Counter(tuple(k for k in range(len(LANGUAGES)) if x >> k & 1) for x in mine.tolist())
            pair, often = count.most_common(1)[0]
            if len(pair) == 2 and often >= BOTH * len(mine):
                ls = line_doc == i
                for k in pair:
                    p = np.exp(line_p[ls, k][sure[ls] == k])
                    yield i, 1, n, LANGUAGES[k], float(p.mean()), "both"
                continue
        if gain[i] > SWITCH:
            parts = stretches(logp[f : f + n].astype(np.float64))
            if len(parts) > 1:
                for a, b, k in parts:
                    yield i, a + 1, b + 1, LANGUAGES[k], sure_of(f + a, f + b, k), "mixed"
                continue
        yield i, 1, n, LANGUAGES[int(top[i])], sure_of(f, f + n - 1, int(top[i])), "single"


RESULT = "doc_id bigint, first_cue bigint, last_cue bigint, lang string, confidence double, kind string, label string"


def assigned(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Language and confidence of each text and of each stretch of a mixed one (``RESULT``).

    Cues count from 1 by their time lines; a text without time lines is one cue. Texts without words (null and empty ones too) have no
    row. ``label`` is the document's label in the notation of ``lang``, null if it has none that is known. Texts aren't shuffled.
    """
    model = model or train(documents)

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in rows:
            for first, texts in T.batches(b.column(1)):
                labels = b.column(2).slice(first, len(texts)).to_pylist()
                got = list(_assign(scorer, texts, labels))
                scorer.forget()
                if got:
                    i, *rest = zip(*got, strict=True)
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([first + k for k in i])), *(pa.array(v, k) for v, k in zip(rest, kinds, strict=True)), pa.array([labels[k] for k in i], pa.string())],
                        names=["doc_id", "first_cue", "last_cue", "lang", "confidence", "kind", "label"],
                    )

    return documents.select(F.col("doc_id").cast("bigint"), "text", label(F.col("lang")).alias("label")).mapInArrow(scan, RESULT)


def corrections(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Of ``assigned``: texts in one language whose label is missing or names another, and all parts of texts in several."""
    return assigned(documents, model).where((F.col("kind") != "single") | ~F.col("label").eqNullSafe(F.col("lang")))
