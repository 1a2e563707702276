"""Language identification, words first, backing off to shorter and shorter character n-grams.

A word that the model knows scores by its log frequency in every language. An
unseen word is cut into n-grams of the longest size of which the model knows
any, and scores their mean. A text's score is the mean over its words.

Counts are sums over all labelled rows, and every word and n-gram of them is in
the model. Workers hold the words and n-grams above the count at which ``WORDS``
words and ``GRAMS`` n-grams of each size remain; the others stay in a table that
the texts' words are joined with, so memory is bounded and the model is not.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relmod.llm.common import fresh, give_back, kept_in_worker, nullable, stored

#: Runs of letters (and of the few numerals that are neither digits nor letters).
WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: At most so many words, and n-grams of each size, are held in memory; the others are joined.
WORDS, GRAMS = 100_000, 30_000
SIZES = (4, 3, 2, 1)
SMOOTHING = 0.5
#: The words that a score's certainty counts at most: neighbouring words aren't independent.
EVIDENCE = 12
#: Entries that a task gathers before it hands them on.
GATHERED = 200_000
#: Unseen words that a task keeps with their scores.
KEPT_WORDS = 100_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    """The word's n-grams, its ends marked; a short word may have none."""
    word = f"_{word}_"
    return [word[i : i + size] for i in range(len(word) - size + 1)] if size > 1 else list(word[1:-1])


def has_letter(words: list[str]) -> bool:
    return any(w.isalpha() for w in words) or any(c.isalpha() for w in words for c in w)


# ---------------------------------------------------------------- learning


def word_counts(labelled: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, feature, n) over all rows with a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(label, Counter()).update(words_of(t))
                if sum(map(len, seen.values())) > GATHERED:
                    yield _rows(seen)
                    seen = {}
                    give_back()
        yield _rows(seen)

    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    found = rows.mapInArrow(count, "lang string, feature string, n long")
    return found.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def _rows(seen: dict[str, Counter]) -> pa.RecordBatch:
    langs = [label for label, c in seen.items() for _ in c]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array([w for c in seen.values() for w in c], pa.string()),
            pa.array([n for c in seen.values() for n in c.values()], pa.int64()),
        ],
        ["lang", "feature", "n"],
    )


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, feature, n) of the words' n-grams of every size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for label, w, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                c = seen.setdefault(label, Counter())
                for size in SIZES:
                    for g in grams_of(w, size):
                        c[g] += n
            if sum(map(len, seen.values())) > GATHERED:
                yield _rows(seen)
                seen = {}
                give_back()
        yield _rows(seen)

    found = words.select("lang", "feature", "n").mapInArrow(count, "lang string, feature string, n long")
    return found.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def feature_scores(counts: DataFrame, totals: DataFrame, langs: list[str], size: Column) -> DataFrame:
    """(feature, size, total, row): every feature's log frequencies in the order of ``langs``.

    ``totals`` has (lang, size, all): the sum of the counts of a language's features of a size.
    """
    sums = {(r["lang"], r["size"]): r["all"] for r in totals.collect()}
    by_lang = [F.coalesce(F.sum(F.when(F.col("lang") == label, F.col("n"))), F.lit(0)) for label in langs]
    rows = counts.groupBy("feature").agg(F.sum("n").alias("total"), F.array(*by_lang).alias("_n")).withColumn("size", size)
    sizes = sorted({s for _, s in sums})
    of_size = F.create_map(*[x for s in sizes for x in (F.lit(s), F.array(*[F.lit(sums.get((label, s), 0) + 1.0) for label in langs]))])
    row = F.zip_with("_n", of_size[F.col("size")], lambda n, all_of: F.log((n + F.lit(SMOOTHING)) / all_of))
    return rows.select("feature", "size", "total", row.alias("row"))


def most_frequent(scores: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """For each size, the features whose total is above the total at which at most ``most`` remain; and whether these are all.

    The cut is read off a histogram of the totals' logarithms, a few hundred
    rows, not off a sorted list.
    """
    found = scores.withColumn("_step", F.floor(F.log2("total") * 8).cast("int"))
    steps: dict[int, list[tuple[int, int]]] = {}
    for r in found.groupBy("size", "_step").count().collect():
        steps.setdefault(r[0], []).append((r[1], r[2]))
    least, whole = F.lit(1 << 30), True
    for value, counted in steps.items():
        cut, held = 1 << 30, 0
        for step, n in sorted(counted, reverse=True):
            if held + n > most:
                whole = False
                break
            cut, held = step, held + n
        least = F.when(F.col("size") == value, F.lit(cut)).otherwise(least)
    return found.filter(F.col("_step") >= least).select("feature", "row"), whole


@dataclass
class Model:
    """Log frequencies by language, of words and of n-grams of each size; row ``i`` of ``scores`` is feature ``i``'s.

    ``all_words`` and ``all_grams`` are the tables of all features, (feature,
    row), where the model in memory is not the whole one; else None.
    """

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    all_words: DataFrame | None = None
    all_grams: DataFrame | None = None
    _kept: dict[str, int] = field(default_factory=dict)
    _extra: list[np.ndarray] = field(default_factory=list)

    def word_scores(self, word: str) -> np.ndarray | None:
        """Scores of an unseen word; None if the model knows nothing of it."""
        for size in SIZES:
            rows = [r for g in grams_of(word, size) if (r := self.grams.get(g)) is not None]
            if rows:
                return self.scores[rows].mean(axis=0)
        return None

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.langs or not has_letter(words):
            return UNDETERMINED, 0.0
        known, kept = self.words, self._kept
        at = [known.get(w, -1) for w in words]
        rows = np.asarray(at)
        total = self.scores[rows[rows >= 0]].sum(axis=0)
        scored = int((rows >= 0).sum())
        for w, n in Counter([w for w, r in zip(words, at, strict=True) if r < 0]).items():
            if (row := kept.get(w)) is None:
                found = self.word_scores(w)
                row = -1 if found is None else len(self._extra)
                if len(kept) < KEPT_WORDS:
                    kept[w] = row
                    if found is not None:
                        self._extra.append(found)
            else:
                found = None if row < 0 else self._extra[row]
            if found is not None:
                total = total + n * found
                scored += n
        if scored:
            total = total * (min(scored, EVIDENCE) / scored)
        p = np.exp(total - total.max())
        best = int(np.argmax(p))
        return self.langs[best], float(p[best] / p.sum())


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model from the rows of ``labelled`` with a language and a text."""
    words = stored(word_counts(labelled, lang, text), "words")
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {}, np.zeros((0, 1)))
    scores: list[np.ndarray] = []

    def learned(counts: DataFrame, size: Column, most: int, name: str) -> tuple[dict[str, int], DataFrame | None]:
        sums = counts.groupBy("lang", size.alias("size")).agg(F.sum("n").alias("all"))
        every = stored(feature_scores(counts, sums, langs, size), name)
        frequent, whole = most_frequent(every, most)
        held = frequent.toArrow()  # bounded by WORDS and GRAMS
        first = sum(map(len, scores))
        rows = held.column("row").combine_chunks()
        scores.append(np.asarray(rows.flatten(), np.float64).reshape(-1, len(langs)))
        at = {f: first + i for i, f in enumerate(held.column("feature").to_pylist())}
        return at, None if whole else every.select("feature", "row")

    known, all_words = learned(words, F.lit(0), WORDS, "word_scores")
    grams = stored(gram_counts(words), "grams")
    parts, all_grams = learned(grams, F.length("feature"), GRAMS, "gram_scores")
    return Model(langs, known, parts, np.concatenate(scores), all_words, all_grams)


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (the key by default), lang_pred and score.

    The prediction reads the text alone. lang_pred is a learned language, or
    'und' with score 0 where the text is null or has no letter, or where
    nothing was learned. The score is the share of the predicted language among
    all, 0 to 1; of languages that score alike the first by name is taken. Text
    of which no part is known scores all languages alike. An empty table gives
    an empty result; repeated rows are predicted alike.
    """
    if model.all_words is not None or model.all_grams is not None:
        return _predict_joined(df, model, key, text, keep)
    spark = df.sparkSession
    # plain values, bounded by WORDS and GRAMS, so that executors need no copy of this package to read them
    shared = spark.sparkContext.broadcast((model.langs, model.words, model.grams, model.scores))
    call = uuid.uuid4().hex
    keep = [key] if keep is None else [c for c in keep if c not in ("lang_pred", "score")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept_in_worker(call, lambda: Model(*shared.value))
        for batch in batches:
            found = [m.predict(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)
            give_back()

    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(fresh(df, "_text")[0]))
    schema = nullable(df.select(*[F.col(f"`{c}`") for c in keep], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema)
    names = schema.names
    return rows.mapInArrow(score, schema)


def _predict_joined(df: DataFrame, model: Model, key: str, text: str, keep: list[str] | None) -> DataFrame:
    """``predict`` where not all features are in memory: the words that are not are scored by joins.

    A text is known by its hash, so that only hashes, sums and rare words are
    stored, and copies of a text are scored once.
    """
    langs = model.langs
    keep = [key] if keep is None else [c for c in keep if c not in ("lang_pred", "score")]
    hashed, = fresh(df, "_hash")
    texts = _head_scores(df.select(F.md5(F.col(text).cast("binary")).alias("hash"), F.col(text).alias("text")), model)
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "texts")  # shorter than the hash where words are joined
    rare = texts.select("id", F.explode("rare").alias("w")).select("id", "w.word", "w.n")
    scored = stored(_word_rows(rare.select("word").distinct(), model), "rare_words")
    by_lang = [F.sum(F.col("n") * F.col("row")[i]) for i in range(len(langs))]
    sums = rare.join(scored, "word").groupBy("id").agg(F.array(*by_lang).alias("more"), F.sum("n").alias("n_more"))
    n = F.col("n") + F.coalesce("n_more", F.lit(0))
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    weight = F.when(n > 0, F.least(n, F.lit(EVIDENCE)) / n).otherwise(F.lit(1.0))
    total = F.transform(total, lambda x: x * weight)
    best = F.array_max("_total")
    share = F.aggregate("_total", F.lit(0.0), lambda s, x: s + F.exp(x - best))
    label = F.array(*map(F.lit, langs))[(F.array_position("_total", best) - 1).cast("int")]
    said = texts.join(sums, "id", "left").select("hash", total.alias("_total"))
    said = said.select(F.col("hash").alias(hashed), label.alias("lang_pred"), (F.lit(1.0) / share).alias("score"))
    # a null text has no hash; a number of its own keeps such rows from meeting in one task
    own = F.coalesce(F.md5(F.col(text).cast("binary")), F.concat(F.lit("-"), F.monotonically_increasing_id()))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], own.alias(hashed)).join(said, hashed, "left")
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce("lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _head_scores(texts: DataFrame, model: Model) -> DataFrame:
    """(hash, sums, n, rare) of the distinct texts with a letter: their words in memory summed, and the others counted."""
    shared = texts.sparkSession.sparkContext.broadcast((model.words, model.scores[: len(model.words)]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scores = shared.value
        for batch in batches:
            out = []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(t) if t else []
                if not words or not has_letter(words):
                    continue
                at = [known.get(w, -1) for w in words]
                rows = np.asarray(at)
                rows = rows[rows >= 0]
                others = Counter([w for w, r in zip(words, at, strict=True) if r < 0])
                out.append((h, scores[rows].sum(axis=0).tolist(), len(rows), [{"word": w, "n": n} for w, n in others.items()]))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)
            give_back()

    rare = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
    kinds = pa.schema([("hash", pa.string()), ("sums", pa.list_(pa.float64())), ("n", pa.int64()), ("rare", rare)])
    found = texts.mapInArrow(score, "hash string, sums array<double>, n long, rare array<struct<word:string,n:long>>")
    return found.dropDuplicates(["hash"])


def _word_rows(words: DataFrame, model: Model) -> DataFrame:
    """(word, row) of distinct words that memory lacks: a known word's row, else the mean of its longest known n-grams'.

    Words of which nothing is known are left out. A word's n-grams in memory
    are summed by size, longest first, up to a size that has any; the n-grams
    of these sizes that are not in memory are joined with the table of all.
    """
    langs = len(model.langs)
    if model.all_words is None:
        known, unseen = None, words
    else:
        table = model.all_words.withColumnRenamed("feature", "word")
        known, unseen = words.join(table, "word"), words.join(table, "word", "left_anti")
    shared = words.sparkSession.sparkContext.broadcast((model.grams, model.scores))
    whole = model.all_grams is None

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, scores = shared.value
        for batch in batches:
            out = []
            for w in batch.column(0).to_pylist():
                for size in SIZES:
                    cut = grams_of(w, size)
                    rows = [r for g in cut if (r := grams.get(g)) is not None]
                    if rows:
                        out.append((w, size, None, len(rows), scores[rows].sum(axis=0).tolist()))
                    if not whole:
                        out += [(w, size, g, 1, None) for g in cut if g not in grams]
                    if rows:
                        break
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)
            give_back()

    kinds = pa.schema([("word", pa.string()), ("size", pa.int32()), ("gram", pa.string()), ("n", pa.int64()), ("row", pa.list_(pa.float64()))])
    found = unseen.mapInArrow(parts, "word string, size int, gram string, n long, row array<double>")
    if not whole:
        found = stored(found, "parts")
        asked = found.filter(F.col("gram").isNotNull()).drop("row").join(model.all_grams.withColumnRenamed("feature", "gram"), "gram")
        found = found.filter(F.col("gram").isNull()).unionByName(asked)
    means = F.array(*[F.sum(F.col("row")[i]) / F.sum("n") for i in range(langs)])
    backed = found.groupBy("word", "size").agg(means.alias("row")).groupBy("word").agg(F.max_by("row", "size").alias("row"))
    return backed if known is None else known.unionByName(backed)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row's language is kept from learning: crc32 of the key as text, modulo 4, is 2. Null keys are not."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
