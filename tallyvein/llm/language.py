"""Language identification by mixture inference.

Every language is a distribution over byte trigrams, counted over all texts to learn from. A text is
taken as a mixture of languages; expectation-maximisation estimates the proportions. Starting from one
language, the next is admitted only if it raises the likelihood by more than its penalty, so that the
language set has the best penalised likelihood along the way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyvein.llm.words import _LOWER, text_slices

#: Trigrams are hashed to so many bins; the model's size is this times the number of languages.
BINS = 1 << 15
#: Languages that a model may have: its table goes to every task.
MOST_LANGUAGES = 256
ROUNDS = 6
SMOOTHING = 0.5

_FOLD = np.where((_LOWER >= 97) & (_LOWER <= 122) | (np.arange(256) >= 128), _LOWER, 32).astype(np.uint32)
_LETTER = (_LOWER >= 97) & (_LOWER <= 122)


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys text * BINS + bin of all trigrams; everything but letters counts as a space, also around a text."""
    folded = _FOLD[data]
    # Capital letters of the Latin-1 block, two bytes in UTF-8.
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1 if len(data) > 1 else []
    folded[capital] += 32
    before = np.concatenate(([np.uint32(32)], folded))[:-1] if len(folded) else folded
    after = np.concatenate((folded, [np.uint32(32)]))[1:] if len(folded) else folded
    edges = offsets[:-1][np.diff(offsets) > 0]
    before[edges] = 32
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    after[ends] = 32
    code = (before << np.uint32(16)) | (folded << np.uint32(8)) | after
    bins = (code * np.uint32(2654435761)) >> np.uint32(17)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    # Runs of spaces say nothing.
    take = folded != 32
    return row[take] * BINS + bins[take]


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # bins x languages

    def mixtures(self, keys: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chosen language, its proportion, number of grams) of each text."""
        keys, counts = np.unique(keys, return_counts=True)
        row, bins = keys // BINS, keys % BINS
        counts = counts.astype(np.float32)
        p = self.likelihood[bins]
        starts = np.searchsorted(row, np.arange(texts))
        total = np.bincount(row, counts, minlength=texts)
        filled = np.flatnonzero(total)
        n_languages = len(self.languages)
        best, share = np.zeros(texts, np.int64), np.zeros(texts)
        if not len(filled) or not n_languages:
            return best, share, total
        at = starts[filled]
        place = np.zeros(texts, np.int64)
        place[filled] = np.arange(len(filled))
        row = place[row]

        def likelihood_of(pi: np.ndarray) -> np.ndarray:
            return np.add.reduceat(counts * np.log((p * pi[row]).sum(1)), at)

        def climb(pi: np.ndarray) -> np.ndarray:
            for _ in range(ROUNDS):
                r = p * pi[row]
                r *= (counts / r.sum(1))[:, None]
                pi = np.add.reduceat(r, at, axis=0)
                pi /= pi.sum(1, keepdims=True)
            return pi

        full = climb(np.full((len(filled), n_languages), 1 / n_languages, np.float32))
        singles = np.add.reduceat(counts[:, None] * np.log(p), at, axis=0)
        first = singles.argmax(1)
        chosen = np.zeros((len(filled), n_languages), np.float32)
        chosen[np.arange(len(filled)), first] = 1
        penalty = 0.5 * np.log(total[filled] + 1)
        value, open_ = singles.max(1) - penalty, np.ones(len(filled), bool)
        members = chosen > 0
        for size in range(2, n_languages + 1):
            # The likeliest language outside the set comes next.
            rest = np.where(members, -1, full)
            new = rest.argmax(1)
            trial = members.copy()
            trial[np.arange(len(filled)), new] = True
            trial &= open_[:, None] | members
            if not open_.any():
                break
            pi = climb((trial / trial.sum(1, keepdims=True)).astype(np.float32))
            gained = likelihood_of(pi) - size * penalty
            better = open_ & (gained > value)
            chosen[better], value[better], members[better] = pi[better], gained[better], trial[better]
            open_ = better
            if not open_.any() or size == n_languages:
                break
        pick = chosen.argmax(1)
        best[filled] = pick
        share[filled] = np.minimum(full[np.arange(len(filled)), pick], 1.0)
        return best, share, total


def _counted(batches):
    """One row per language and bin that the task has met, counted over all its texts."""
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column(0).to_pylist()
        for first, data, offsets in text_slices(batch.column(1)):
            own = languages[first : first + len(offsets) - 1]
            keys = _grams(data, offsets)
            names = sorted(set(own))
            number = np.array([names.index(x) for x in own])
            counts = np.bincount(number[keys // BINS] * BINS + keys % BINS, minlength=len(names) * BINS).reshape(-1, BINS)
            for name, row in zip(names, counts):
                tables[name] = tables.get(name, 0) + row
    for name, row in tables.items():
        bins = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(bins), pa.string()), pa.array(bins, pa.int64()), pa.array(row[bins], pa.int64())], ["lang", "bin", "n"]
        )


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", learn: Column | None = None) -> Model:
    """Trigram distributions from all texts with a language that ``learn`` admits."""
    rows = docs.where(F.col(lang_col).isNotNull())
    rows = rows.where(learn) if learn is not None else rows
    texts = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = texts.mapInArrow(_counted, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    tables = counts.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("rows")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(tables) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the table would not fit the tasks")
    likelihood = np.full((BINS, len(tables)), SMOOTHING)
    for i, t in enumerate(tables):
        likelihood[[r.bin for r in t.rows], i] += [r.n for r in t.rows]
    return Model([t.lang for t in tables], (likelihood / likelihood.sum(0)).astype(np.float32))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every row: the main language of its text and its estimated proportion.

    A null text and one without a letter are ``und`` with score 0, as is everything if there was nothing
    to learn from. Of languages that tie the first by name is taken. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            names, scores = [], []
            for first, data, offsets in text_slices(batch.column(1)):
                best, share, total = m.mixtures(_grams(data, offsets), len(offsets) - 1)
                letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
                lettered = letters[offsets[1:]] > letters[offsets[:-1]]
                for t in np.flatnonzero(~lettered & (total > 0)).tolist():
                    lettered[t] = any(map(str.isalpha, batch.column(1)[first + t].as_py() or ""))
                lettered &= (total > 0) & bool(m.languages)
                names += [m.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
                scores += np.where(lettered, share, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"])

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = StructType([columns.schema[0], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return columns.mapInArrow(run, schema)
