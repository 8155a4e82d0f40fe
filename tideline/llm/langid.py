"""Language identification by interpolated Kneser-Ney character models.

Words of lower-cased letters, set between blanks, are the model's sentences: a character is predicted from up to four
before it, never across a word's start. Spark counts n-grams of all training texts and derives the Kneser-Ney
probabilities; they are looked up in sorted arrays of n-gram hashes, all languages at once, or where those are too many
for one machine, joined to the corpus's distinct n-grams and words. A text gets the language of the lowest cross-entropy
per character, and is rejected where that lies beyond what texts of its length show that were set aside from training.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import python_ready, rows_of, small_or_shuffled, table, unpacked, without, written

ORDER = 5
#: Characters a language is taken to have besides those seen, for the uniform law under the unigrams.
UNSEEN = 256
#: Most counted n-grams of a model that is sent to the tasks whole, and most languages for each of them on average; a
#: larger one stays in tables. Both hold every n-gram.
MAX_GRAMS = 2_000_000
MANY_LANGS = 8
#: Words whose scores go to the tasks whole when the model stays in tables: the most frequent.
FREQUENT_WORDS = 100_000
#: Rejection: beyond this quantile of the calibration texts of about the same length, and a margin.
QUANTILE, MARGIN = 0.999, 1.5
#: One in so many training texts, drawn by its text, is not counted but calibrates the rejection.
CALIBRATION = 10
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_WORD_LIMIT = 40


def words_of(text: str) -> list[str]:
    """Runs of letters, lower case; very long runs (scripts without blanks) in pieces.

    Numerals such as a half or a circled one are word characters to expressions, but no letters.
    """
    found = _LETTERS.findall(text.lower())
    if not all(map(str.isalpha, found)):
        found = [part for w in found for part in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]
    return [w[i : i + _WORD_LIMIT] for w in found for i in range(0, len(w), _WORD_LIMIT)] if max(map(len, found), default=0) > _WORD_LIMIT else found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of n-grams given as columns of code points, by length and content."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _laid_out(words: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The words between blanks, its code points, and for each place the length of its longest n-gram (0: none)."""
    line = " " + " ".join(words) + " "
    points = _points(line)
    at = np.arange(len(points))
    blank = np.maximum.accumulate(np.where(points == 32, at, 0))
    longest = np.zeros(len(points), np.int64)
    longest[1:] = np.minimum(at[1:] - blank[:-1] + 1, ORDER)
    return line, points, longest


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> lang, gram, n: the longest n-gram at each place, summed up over many texts."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, seen in counts.items():
            words = list(seen)
            if not words:
                continue
            line, points, longest = _laid_out(words)
            ends = np.flatnonzero(longest > 0)
            weights = np.repeat(np.fromiter(seen.values(), np.int64, len(seen)), [len(w) + 1 for w in words])
            for n in range(2, ORDER + 1):
                own = ends[longest[ends] == n]
                if not len(own):
                    continue
                hashes = _fold([points[own - n + 1 + k] for k in range(n)])
                _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
                total = np.bincount(which, weights=weights[longest[ends] == n]).astype(np.int64)
                grams = [line[i - n + 1 : i + 1] for i in own[first].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(total)], names=["lang", "gram", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[lang].update(words_of(text))
        if sum(map(len, counts.values())) > 250_000:
            yield from flush()
    yield from flush()


def gram_counts(train: DataFrame) -> DataFrame:
    """``train(lang, text)`` -> lang, gram, a: how often each longest n-gram occurs in all its texts."""
    python_ready(train.sparkSession)
    rows = train.filter("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(_counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("a"))


def kneser_ney(counts: DataFrame) -> list[DataFrame]:
    """Interpolated probabilities for the n-grams of each order: frames of lang, gram, logp (base 2), backoff (base 2, of
    the context that the gram is without its last character, repeated) for orders 1 to ORDER, bottom up.

    Below the top order a gram counts as often as it has different characters before it; n-grams at a word's start
    have none before them and keep their counts.
    """
    levels = {ORDER: counts.filter(F.length("gram") == ORDER)}
    for n in range(ORDER - 1, 0, -1):
        spread = levels[n + 1].groupBy("lang", F.expr(f"right(gram, {n})").alias("gram")).agg(F.count(F.lit(1)).alias("a"))
        levels[n] = spread.unionByName(counts.filter((F.length("gram") == n) & F.col("gram").startswith(" ")))
    out, lower = [], None
    for n in range(1, ORDER + 1):
        rows = written(levels[n].withColumn("context", F.expr(f"left(gram, {n - 1})")), f"order{n}") if n > 1 else levels[n].withColumn("context", F.lit(""))
        discount = rows.groupBy("lang").agg(
            (F.greatest(F.count_if(F.col("a") == 1), F.lit(1)) / (F.greatest(F.count_if(F.col("a") == 1), F.lit(1)) + 2 * F.count_if(F.col("a") == 2))).alias("d")
        ).select("lang", F.least(F.col("d"), F.lit(0.95)).alias("d"))
        sums = rows.groupBy("lang", "context").agg(F.sum("a").alias("total"), F.count(F.lit(1)).alias("kinds"))
        joined = rows.join(sums, ["lang", "context"]).join(discount, "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        if n == 1:
            below = F.lit(1.0) / (F.col("kinds") + UNSEEN)
        else:
            joined = joined.withColumn("suffix", F.expr(f"right(gram, {n - 1})")).join(lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("low")), ["lang", "suffix"])
            below = F.col("low")
        p = F.greatest(F.col("a") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * below
        lower = written(joined.select("lang", "gram", p.alias("p"), F.col("weight"), F.col("kinds")), f"kn{n}")
        out.append(lower.select("lang", "gram", F.log2("p").alias("logp"), F.log2("weight").alias("backoff"), "kinds"))
    return out


class Model:
    """Sorted hash arrays: for each order the log probabilities of its grams, for each context length the backoffs."""

    def __init__(self, levels: list[pa.Table]):
        self.langs = sorted({x for t in levels for x in t.column("lang").unique().to_pylist()})
        number = {x: i for i, x in enumerate(self.langs)}
        self.grams, self.backoffs = [], []
        self.floor = np.zeros(len(self.langs), np.float32)
        for n, t in enumerate(levels, 1):
            grams, lang = t.column("gram").to_pylist(), np.array([number[x] for x in t.column("lang").to_pylist()], np.int64)
            points = _points("".join(grams)).reshape(-1, n) if grams else np.empty((0, n), np.uint32)
            back = t.column("backoff").to_numpy().astype(np.float32)
            self.grams.append(self._table(_fold([points[:, k] for k in range(n)]), lang, t.column("logp").to_numpy(), np.nan))
            if n > 1:
                self.backoffs.append(self._table(_fold([points[:, k] for k in range(n - 1)]), lang, back, 0.0))
            else:
                kinds = t.column("kinds").to_numpy()
                self.floor[lang] = back - np.log2(kinds + UNSEEN)

    def _table(self, hashes: np.ndarray, lang: np.ndarray, values: np.ndarray, empty: float) -> tuple[np.ndarray, np.ndarray]:
        keys, which = np.unique(hashes, return_inverse=True)
        matrix = np.full((len(keys), len(self.langs)), empty, np.float32)
        matrix[which, lang] = values
        return keys, matrix

    @staticmethod
    def _find(entry: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, empty: float) -> np.ndarray:
        keys, matrix = entry
        if not len(keys):
            return np.full((len(hashes), matrix.shape[1]), empty, np.float32)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        out = matrix[at]
        out[keys[at] != hashes] = empty
        return out

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log2 probability of each word with its closing blank, by language."""
        _, points, longest = _laid_out(words)
        places = np.flatnonzero(longest > 0)
        total = np.zeros((len(places), len(self.langs)), np.float32)
        open_ = np.ones_like(total, bool)
        for n in range(ORDER, 0, -1):
            may = np.flatnonzero((longest[places] >= n) & open_.any(axis=1))
            if not len(may):
                continue
            at = places[may]
            columns = [points[at - n + 1 + k] for k in range(n)]
            p = self._find(self.grams[n - 1], _fold(columns), np.nan)
            still = open_[may]
            hit = still & ~np.isnan(p)
            rest = still & np.isnan(p)
            below = self._find(self.backoffs[n - 2], _fold(columns[:-1]), 0.0) if n > 1 else np.broadcast_to(self.floor, p.shape)
            total[may] += np.where(hit, p, 0) + np.where(rest, below, 0)
            open_[may] = rest
        starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        return np.add.reduceat(total, starts, axis=0)


class Scorer:
    """Scores texts by words, remembering the words it has met."""

    def __init__(self, model: Model, remember: int = 250_000):
        self.model, self.remember = model, remember
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, len(self.model.langs)), np.float32)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, float | None, int]]:
        """(language, score, cross-entropy in bits a character, characters) of each text."""
        split = [words_of(t or "") for t in texts]
        if len(self.known) > self.remember:
            self._forget()
        new = list({w for words in split for w in words} - self.known.keys())
        if new and self.model.langs:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, self.model.word_scores(new)])
        out = []
        for words in split:
            chars = sum(map(len, words)) + len(words)
            if not words or not self.model.langs:
                out.append((UNDETERMINED, 0.0, None, chars))
                continue
            bits = -self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64) / chars
            best = int(bits.argmin())
            score = 1.0 / np.exp2((bits[best] - bits) * min(chars, 64)).sum()
            out.append((self.model.langs[best], float(score), float(bits[best]), chars))
        return out


_SCORERS: dict[str, Scorer | tuple[dict[str, int], np.ndarray]] = {}


def _scored(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[name] = Scorer(shared.value)
        scorer = _SCORERS[name]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            out = [x for i in range(0, len(texts), 512) for x in scorer(texts[i : i + 512])]
            lang, score, bits, chars = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()), pa.array(chars, pa.int64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "bits", "chars"],
            )

    return run


def fit(counts: DataFrame) -> Model:
    """The model of ``counts``, which has to fit the driver."""
    return Model([level.toArrow() for level in kneser_ney(counts)])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> word, n, summed up over many texts."""
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(words_of(text))
        if len(seen) > 250_000:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word -> word, gram: the longest n-gram at each place of the word and at its closing blank."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        for lo in range(0, len(words), 20_000):
            out = [(w, line[max(0, i + 1 - ORDER) : i + 1]) for w in words[lo : lo + 20_000] for line in (f" {w} ",) for i in range(1, len(line))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([g for _, g in out], pa.string())], names=["word", "gram"])


def word_scores(words: DataFrame, levels: list[DataFrame], langs: list[str]) -> DataFrame:
    """``words(word, ...)``, distinct -> word, scores: log2 probability with the closing blank in each of ``langs``, as
    ``Model.word_scores``. Each n-gram of the words is scored once, from the shortest up: by its own probability, or by
    its context's backoff and its suffix."""
    places = written(words.select("word").mapInArrow(_places, "word string, gram string"), "places")
    need = {ORDER: places.filter(F.length("gram") == ORDER).select("gram").distinct()}
    for n in range(ORDER - 1, 0, -1):
        own = places.filter(F.length("gram") == n).select("gram")
        need[n] = own.unionByName(need[n + 1].select(F.expr(f"right(gram, {n})").alias("gram"))).distinct()
    by_lang = lambda value: F.map_from_entries(F.collect_list(F.struct("lang", value)))
    names, lower, scored = F.array(*[F.lit(x) for x in langs]), None, []
    for n, level in enumerate(levels, 1):
        own = level.groupBy("gram").agg(by_lang("logp").alias("own"))
        rows = need[n].join(own, "gram", "left")
        if n == 1:
            floors = {r["lang"]: r["floor"] for r in level.select("lang", (F.col("backoff") - F.log2(F.col("kinds") + UNSEEN)).alias("floor")).distinct().collect()}  # one row a language
            rows = rows.withColumn("low", F.array(*[F.lit(float(floors[x])) for x in langs])).withColumn("back", F.lit(None).cast("map<string,double>"))
        else:
            context = F.expr(f"left(gram, {n - 1})")
            backs = level.select("lang", context.alias("context"), "backoff").distinct().groupBy("context").agg(by_lang("backoff").alias("back"))
            rows = rows.withColumns({"context": context, "suffix": F.expr(f"right(gram, {n - 1})")}).join(backs, "context", "left").join(lower.select(F.col("gram").alias("suffix"), F.col("scores").alias("low")), "suffix")
        value = F.transform(names, lambda x, i: F.coalesce(F.col("own")[x], F.coalesce(F.col("back")[x], F.lit(0.0)) + F.get("low", i)))
        lower = written(rows.select("gram", value.alias("scores")), f"scores{n}")
        scored.append(lower)
    every = reduce(DataFrame.unionByName, scored[1:])
    return places.join(every, "gram").groupBy("word").agg(_summed("scores", len(langs)).alias("scores"))


def _summed(scores: str, n: int) -> Column:
    return F.array(*[F.sum(F.col(scores)[i]) for i in range(n)])


def _partly_scored(shared, name: str, langs: int):
    """(..., text) -> ..., chars, scores of the frequent words together, and the other words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _SCORERS:
            _SCORERS.clear()
            words, rows = shared.value
            _SCORERS[name] = {w: i for i, w in enumerate(words)}, rows
        known, rows = _SCORERS[name]
        for batch in batches:
            chars, scores, rest = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = words_of(text or "")
                chars.append(sum(map(len, words)) + len(words))
                own = [known[w] for w in words if w in known]
                scores.append(rows[own].sum(axis=0) if own else np.zeros(langs))
                rest.append([{"word": w, "n": n} for w, n in Counter(w for w in words if w not in known).items()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(chars, pa.int64()), pa.array([x.tolist() for x in scores], pa.list_(pa.float64())), pa.array(rest, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                names=[*batch.schema.names[:-1], "chars", "scores", "rest"],
            )

    return run


_KEYS = "doc_id long, text_hash long, calibrates boolean, given string"
_SCORED = f"{_KEYS}, lang_pred string, score double, bits double, chars long"


def scored_by_tables(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT_WORDS) -> DataFrame:
    """What ``Scorer`` says of ``rows(doc_id, text_hash, calibrates, given, text)``, with a model of any size: distinct words
    are scored in joins, the ``frequent`` most frequent go to the tasks, and the texts' other words are joined."""
    spark = rows.sparkSession
    levels = kneser_ney(counts)
    langs = sorted(r["lang"] for r in levels[0].select("lang").distinct().collect())
    counted = rows.filter("text is not null").select("text").mapInArrow(_word_counts, "word string, n long")
    words = written(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    scores = written(word_scores(words, levels, langs).join(words, "word"), "word_scores")
    top = scores.orderBy(F.desc("n"), "word").limit(frequent)
    common = top.select("word", "scores").toArrow()
    matrix = common.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(langs))
    shared = spark.sparkContext.broadcast((common.column("word").to_pylist(), matrix))
    fields = f"{_KEYS}, row long, chars long, scores array<double>, rest array<struct<word:string,n:long>>"
    numbered = rows.select("doc_id", "text_hash", "calibrates", "given", F.monotonically_increasing_id().alias("row"), "text")
    partly = written(numbered.mapInArrow(_partly_scored(shared, uuid.uuid4().hex, len(langs)), fields), "partly")
    rest = partly.select("row", F.explode("rest").alias("w")).select("row", "w.word", "w.n").join(scores.select("word", F.col("scores").alias("own")), "word")
    more = rest.groupBy("row").agg(F.array(*[F.sum(F.col("own")[i] * F.col("n")) for i in range(len(langs))]).alias("more"))
    both = partly.join(more, "row", "left")
    total = F.transform("scores", lambda x, i: -(x + F.coalesce(F.get("more", i), F.lit(0.0))) / F.col("chars"))
    bits = both.withColumn("all", F.when(F.col("chars") > 0, total)).withColumn("bits", F.array_min("all"))
    share = F.aggregate("all", F.lit(0.0), lambda a, b: a + F.pow(F.lit(2.0), (F.col("bits") - b) * F.least("chars", F.lit(64))))
    lang = F.get(F.array(*[F.lit(x) for x in langs]), (F.array_position("all", F.col("bits")) - 1).cast("int"))
    return bits.select("doc_id", "text_hash", "calibrates", "given", F.coalesce(lang, F.lit(UNDETERMINED)).alias("lang_pred"), F.coalesce(1.0 / share, F.lit(0.0)).alias("score"), "bits", "chars")


def identify(docs: DataFrame, learn: Column, lang: str = "lang", max_grams: int = MAX_GRAMS) -> DataFrame:
    """Every row of ``docs(doc_id, text, lang, ...)`` as doc_id, text_hash, lang_pred, score, rejected.

    The model learns from rows where ``learn`` holds and text and ``lang`` aren't null: from all n-grams of nine in ten
    texts, while the tenth, which it hasn't seen, says how high a cross-entropy is usual. A prediction sees the text alone.
    Where no text calibrates, nothing is rejected but texts without a letter. lang_pred is ``und`` with score 0 for null texts and texts without a letter, and for
    all where nothing was learned; those are rejected too. Equal texts get equal predictions. A model of more than
    ``max_grams`` n-grams stays in tables, which changes no result but in rounding.
    """
    spark = docs.sparkSession
    aside = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0
    counts = written(gram_counts(docs.filter(learn & ~aside).select(F.col(lang).alias("lang"), "text")), "grams")
    python_ready(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(learn & aside & F.col(lang).isNotNull(), F.lit(False)).alias("calibrates"),
        F.col(lang).cast("string").alias("given"),
        F.col("text").cast("string").alias("text"),
    )
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("langs")).first()
    if size["n"] <= max_grams and size["n"] * size["langs"] <= max_grams * MANY_LANGS:
        shared = spark.sparkContext.broadcast(fit(counts))
        found = rows.mapInArrow(_scored(shared, uuid.uuid4().hex), _SCORED)
    else:
        found = scored_by_tables(rows, counts)
    scored = written(found, "scored")
    length = F.floor(F.log2(F.col("chars").cast("double"))).cast("int")
    right = scored.filter("calibrates and bits is not null and lang_pred = given")
    # At most 63 sizes, so both frames are tiny whatever the corpus.
    usual = right.groupBy(length.alias("size")).agg(F.percentile_approx("bits", QUANTILE, 10_000).alias("usual"))
    overall = right.agg(F.percentile_approx("bits", QUANTILE, 10_000).alias("overall")).first()["overall"]
    limit = F.greatest(F.col("usual"), F.lit(overall).cast("double")) * MARGIN  # greatest() skips nulls
    judged = scored.withColumn("size", length).join(F.broadcast(usual), "size", "left")
    return judged.select("doc_id", "text_hash", "lang_pred", "score", F.coalesce(F.col("bits") > limit, F.col("bits").isNull()).alias("rejected"), "bits")


def keep_identified(docs: DataFrame, learn: Column) -> DataFrame:
    """The rows of ``docs`` that ``identify`` doesn't reject, as they are."""
    lost = small_or_shuffled(identify(docs, learn).filter("rejected").select("doc_id", "text_hash").distinct(), "rejected")
    return unpacked(rows_of(docs, lost, "left_anti"), docs.columns)


def training_rows() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = without(table(spark, sf_dir, "documents"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return identify(docs, training_rows()).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
