"""Language identification: known words first, then ever shorter n-grams.

Trained from labelled texts: per language, relative frequencies of words and of
character n-grams (4 to 1) of padded words. A word of the table scores by its
log frequency in each language; any other word scores by the mean log frequency
of its longest known n-grams, 4 characters first, then 3, 2, 1. Each word's
scores become log posteriors over languages, floored, and a text's are summed.

Bounds: about DOCS_PER_LANG training documents per language, chosen by the hash of
their id (rows of one id go together). Every learned language has tables of its TABLE
most frequent words and n-grams, fewer only beyond MODEL_ROWS / (5 * TABLE) languages;
totals are taken before. The model is what is broadcast, so its size follows the number
of languages, MODEL_ROWS at most, never that of documents.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, held, materialise
from .units import gather

DOCS_PER_LANG = 3_000
TABLE, MODEL_ROWS = 10_000, 2_000_000
LONGEST = 4
FLOOR = -6.0
CELLS = 800_000
SLICE = 4_000_000
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for lang, part in pdf.groupby("lang"):
            words = Counter()
            for text in part["text"]:
                words.update(WORD.findall(text.lower()))
            rows = {(0, w): n for w, n in words.items()}
            for n in range(1, LONGEST + 1):
                c = Counter()
                for w, times in words.items():
                    for g in grams(w, n):
                        c[g] += times
                rows.update({(n, g): times for g, times in c.items()})
            yield pd.DataFrame({"lang": lang, "n": [k[0] for k in rows], "gram": [k[1] for k in rows], "times": list(rows.values())})


class LanguageModel:
    """Words (table 0) and n-grams: per row of a table, the languages that have it and
    by how much its log frequency there exceeds that of an unknown one."""

    def __init__(self, langs: list[str], rows: pd.DataFrame, totals: pd.DataFrame):
        self.langs, at = langs, {x: i for i, x in enumerate(langs)}
        self.token = uuid.uuid4().hex
        self.tables: list[tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for n in range(LONGEST + 1):
            part = rows[rows["n"] == n].sort_values(["gram", "lang"])
            own = totals[totals["n"] == n]
            total = np.ones(len(langs))
            total[[at[x] for x in own["lang"]]] = np.maximum(1, own["times"])
            unknown = np.log(0.1 / total)
            lang = np.array([at[x] for x in part["lang"]], np.int64)
            more = np.log(part["times"].to_numpy(float) / total[lang]) - unknown[lang]
            first = np.flatnonzero(np.r_[True, part["gram"].to_numpy()[1:] != part["gram"].to_numpy()[:-1]]) if len(part) else np.zeros(0, np.int64)
            names = {g: i for i, g in enumerate(part["gram"].to_numpy()[first])}
            self.tables.append((names, np.r_[first, len(part)], lang, more, unknown))

    def _sums(self, n: int, rows: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
        """Sum of the log frequencies of table rows, by the word they belong to."""
        _, first, lang, more, unknown = self.tables[n]
        size = first[rows + 1] - first[rows]
        at = gather(np.arange(len(lang)), first[rows], size)
        cell = np.repeat(of, size) * len(unknown) + lang[at]
        out = np.bincount(cell, weights=more[at], minlength=count * len(unknown)).reshape(count, len(unknown))
        return out + np.bincount(of, minlength=count)[:, None] * unknown[None]

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log posteriors of the languages for each word, floored; zeros for a word
        of which nothing is known. Overlapping n-grams of a word count as two
        independent ones at most."""
        score = np.zeros((len(words), len(self.langs)))
        found = np.array([self.tables[0][0].get(w, -1) for w in words], dtype=np.int64)
        has = np.flatnonzero(found >= 0)
        score[has] = self._sums(0, found[has], np.arange(len(has)), len(has))
        left = np.flatnonzero(found < 0)
        for n in range(LONGEST, 0, -1):
            get = self.tables[n][0].get
            per = [[i for g in grams(words[k], n) if (i := get(g)) is not None] for k in left.tolist()]
            size = np.array([len(x) for x in per], dtype=np.int64)
            some = np.flatnonzero(size)
            if len(some):
                flat = np.array([i for x in per for i in x], dtype=np.int64)
                sums = self._sums(n, flat, np.repeat(np.arange(len(some)), size[some]), len(some))
                score[left[some]] = sums * (np.minimum(2, size[some]) / size[some])[:, None]
                left = left[size == 0]
        top = score - score.max(axis=1, keepdims=True)
        post = np.maximum(top - np.log(np.exp(top).sum(axis=1, keepdims=True)), FLOOR)
        post[left] = 0
        return post.astype(np.float32)


class Known:
    """Scores of the words met so far, at most about CELLS, kept between tasks. Once
    there are more, those met in one slice of texts only go."""

    def __init__(self, model: LanguageModel):
        self.model, self.at, self.vectors, self.met = model, {}, np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int32)

    def learn(self, words: list[list[str]]) -> None:
        """Score the words that are met for the first time."""
        limit = max(1, CELLS // max(1, len(self.model.langs)))
        if len(self.at) > limit:
            keep = np.flatnonzero(self.met > 1)
            keep = keep[np.argsort(-self.met[keep], kind="stable")[: limit // 2]]
            held_words = list(self.at)
            self.at = {held_words[i]: k for k, i in enumerate(keep.tolist())}
            self.vectors, self.met = self.vectors[keep], self.met[keep] // 2
        met = set().union(*words)
        new = list(met.difference(self.at))
        if new:
            first = len(self.at)
            self.vectors = np.concatenate([self.vectors, self.model.word_scores(new)])
            self.met = np.r_[self.met, np.zeros(len(new), np.int32)]
            self.at.update(zip(new, range(first, first + len(new)), strict=True))
        self.met[np.fromiter(map(self.at.__getitem__, met), np.int64, len(met))] += 1


def classify(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; 'und' and 0 without a letter."""
    langs, names, scores = model.langs, [], np.zeros(len(texts))
    if not langs:
        return ["und"] * len(texts), scores
    words = [WORD.findall(t.lower()) if t else [] for t in texts]
    known = held(("language", model.token), lambda: Known(model))
    known.learn(words)
    get = known.at.__getitem__
    for k, own in enumerate(words):
        if not any(any(map(str.isalpha, w)) for w in own):
            names.append("und")
            continue
        at = np.fromiter(map(get, own), np.int64, len(own))
        total = known.vectors[at].sum(axis=0, dtype=np.float64)
        p = np.exp(total - total.max())
        best = int(np.argmax(p))
        names.append(langs[best])
        scores[k] = p[best] / p.sum()
    return names, scores


def train(docs: DataFrame) -> LanguageModel:
    """Learn from rows (doc_id, text, lang) that are not held out and have a text
    and a language. Ids and sources choose rows; they are no inputs."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sizes = materialise(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows")), "language-sizes")  # of known size: texts stay where they are
    part = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) < F.lit(DOCS_PER_LANG * (1 << 20)) / F.col("_rows")
    chosen = usable.join(sizes, "lang").filter(part)
    parts = chosen.select("lang", "text").mapInPandas(_counts, "lang string, n int, gram string, times long")
    counts = materialise(parts.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times")), "language-counts")
    totals = counts.groupBy("lang", "n").agg(F.sum("times").alias("times")).toPandas()
    langs = sorted(set(totals["lang"]))
    each = min(TABLE, MODEL_ROWS // max(1, len(langs) * (LONGEST + 1)))
    best = Window.partitionBy("lang", "n").orderBy(F.desc("times"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= each)
    return LanguageModel(langs, rows.select("lang", "n", "gram", "times").toPandas(), totals)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds lang_pred and score to every row, from the text alone; columns of these
    names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    cols = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*cols).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(cols.index("text")).to_pylist()
            names, scores = [], [np.zeros(0)]
            for lo, hi in by_bytes(texts, SLICE):
                some, score = classify(texts[lo:hi], sent.value)
                names += some
                scores.append(score)
            scores = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores)], names=[*cols, "lang_pred", "score"])

    return docs.select(*cols).mapInArrow(run, schema)


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of (doc_id, text, lang).

    Null texts and texts without a letter are 'und' with score 0, as is every
    text if nothing could be learned; rows may repeat; an empty table gives an
    empty result; of equally likely languages the first by name; other columns are
    ignored."""
    rows = docs.select("doc_id", "text")
    out = identify(rows, train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is identified with at least that score, with their
    columns, whatever their names, as they were.

    Null texts and texts without a letter go, as does every text if no row has a
    language to learn from; a null id, source or lang is no reason to go; repeated rows
    stay or go together; an empty table gives an empty result."""
    cols = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{k}") for k, c in enumerate(cols)])
    out = identify(renamed, train(docs)).filter((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return out.select(*[F.col("text" if c == "text" else f"c{k}").alias(c) for k, c in enumerate(cols)])
