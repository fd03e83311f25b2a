"""Toxicity: gradient-boosted trees over lexicon densities and style rates, with isotonic calibration.

The lexicon is learned: words and word beginnings of 4 to 8 bytes that stand in far more toxic than other labelled
texts. It has three parts of its own for fitting: the features of a labelled row use counts of the other two thirds
only, so the trees do not see a row's own words as lexicon. The isotonic curve is fitted on scores of rows that the
scoring trees have not seen. A bounded sample of labelled rows (`labelled.SAMPLE`) is read; of it counts of at
most `UNITS` lexicon candidates and a few numbers for each row reach the driver.

Defined cases: a null text is an empty one; an empty text is scored like any other; repeated rows are scored alike,
and all rows of a labelled id are read for fitting; a null id is scored and never read for fitting; a very long text is read whole; other
columns, also of the same names as results, are ignored; without labels, or with one class only, scores are constant.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import LOWER, Flat, byte_class, covered, firsts, flat_slices, with_owner
from .labelled import SAMPLE, fold_of, training_rows
from .statistics import BANG, LEAD, LETTER, MARK, NOT_SPACE, UPPER
from .trees import Forest, fit_forest, isotonic

THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
PARTS = 3  # of the sample, for lexicons and calibration
UNITS, LEXICON = 20_000, 600
PREFIXES = range(4, 9)
NEAR = 6  # words on either side of a pronoun

#: Second-person pronouns of the corpus languages.
SECOND_PERSON = (
    "you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deiner deinen "
    "ihr euch euer eure tú ti usted ustedes vosotros vosotras vuestro vuestra"
).split()

_WORD = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_DIGIT_OR_MARK = byte_class(lambda b: 48 <= b <= 57 or b in (33, 36, 42, 64))


def _key(word: str) -> int:
    flat = Flat(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))
    return int(flat.hashes(np.array([0]), np.array([len(flat.data)]))[0])


_PRONOUNS = np.sort(np.array([_key(w) for w in SECOND_PERSON], np.uint64))


def _among(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return table[at] == keys if len(table) else np.zeros(len(keys), bool)


def units(lowered: Flat, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Keys of each word and of its beginnings; a beginning no shorter than the word has key 0. Its length is part of a key."""
    out = [lowered.hashes(starts, ends)]
    for size in PREFIXES:
        longer = ends - starts > size
        keys = lowered.hashes(starts, np.minimum(starts + size, ends)) + np.uint64(size)
        out.append(np.where(longer, keys, np.uint64(0)))
    return out


@dataclass(frozen=True)
class Lexicon:
    keys: np.ndarray  # sorted
    weights: np.ndarray  # log ratio of the rates in toxic and other texts

    def words(self, found: list[np.ndarray]) -> np.ndarray:
        """The largest weight of a word's units, 0 if none is in the lexicon."""
        best = np.zeros(len(found[0]))
        for keys in found if len(self.keys) else ():
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            np.maximum(best, np.where(self.keys[at] == keys, self.weights[at], 0), out=best)
        return best


def make_lexicon(keys: np.ndarray, toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> Lexicon:
    """The units that stand out most in toxic texts: at least 3 of them, 4 times the rate, 3 deviations."""
    if not n_toxic or not n_other:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    expected = (toxic + other) * n_toxic / (n_toxic + n_other)
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    deviations = (toxic - expected) / np.sqrt(np.maximum(expected, 0.25))
    good = np.flatnonzero((toxic >= 3) & (ratio > np.log(4)) & (deviations > 3))
    best = good[np.lexsort((keys[good], -deviations[good]))][:LEXICON]
    best = best[np.argsort(keys[best])]
    return Lexicon(keys[best], ratio[best])


def _within(positions: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Words at most NEAR words from one of the positions in the same text."""
    if not len(positions):
        return np.zeros(size, bool)
    low = np.maximum(positions - NEAR, np.searchsorted(owner, owner[positions]))
    high = np.minimum(positions + NEAR + 1, np.searchsorted(owner, owner[positions], "right"))
    return covered(size, low, high - low)


def _runs_of_three(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that hold a letter three times in a row."""
    three = np.zeros(len(data) + 1, np.int64)
    if len(data) > 2:
        three[3:] = (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) & LETTER[data[:-2]] & (data[:-2] < 128)
    sums = np.cumsum(three)
    return sums[ends] - sums[np.minimum(starts + 2, ends)] > 0


def features(flat: Flat, lexicons: list[Lexicon]) -> np.ndarray:
    """lexicons x texts x features."""
    lowered = flat.mapped(LOWER)
    starts, ends, owner = lowered.runs(_WORD)
    found = units(lowered, starts, ends)
    n_words = np.maximum(flat.per_text(owner), 1)
    pronoun = _among(found[0], _PRONOUNS)
    near_pronoun = _within(np.flatnonzero(pronoun), owner, len(starts))
    raw_starts, raw_ends, raw_owner = flat.runs(NOT_SPACE)
    n_raw = np.maximum(flat.per_text(raw_owner), 1)
    sums = {k: np.concatenate([[0], np.cumsum(t[flat.data])]) for k, t in (("u", UPPER), ("l", LETTER), ("d", _DIGIT_OR_MARK))}
    inside = lambda k, a, b: sums[k][b] - sums[k][a]
    upper, letters = inside("u", raw_starts, raw_ends), inside("l", raw_starts, raw_ends)
    lone = letters > 0
    masked = lone & LETTER[flat.data[raw_starts]] & (inside("d", raw_starts, raw_ends) > 0)
    masked &= LETTER[flat.data[raw_ends - 1]]
    by = lambda owners, mask: flat.per_text(owners, mask.astype(float))
    shared = [
        np.log1p(n_words),
        by(owner, pronoun) / n_words,
        flat.count(UPPER) / np.maximum(flat.count(LETTER), 1),
        by(raw_owner, (upper > 1) & (2 * upper > letters)) / n_raw,
        flat.count(BANG) / n_raw,
        flat.count(MARK) / np.maximum(flat.count(LEAD), 1),
        by(raw_owner, masked) / n_raw,
        by(raw_owner, _runs_of_three(lowered.data, raw_starts, raw_ends)) / n_raw,
    ]
    out = []
    for lexicon in lexicons:
        weight = lexicon.words(found)
        hit = weight > 0
        strong = weight > np.log(20)
        top = np.zeros(flat.n)
        np.maximum.at(top, owner, weight)
        kinds, _, _ = firsts(with_owner(found[0][strong], owner[strong]))
        out.append(
            np.stack(
                [
                    by(owner, hit) / n_words,
                    by(owner, weight) / n_words,
                    by(owner, strong) / n_words,
                    np.log1p(by(owner, strong)),
                    flat.per_text(owner[strong][kinds]) / np.sqrt(n_words),
                    top,
                    by(owner, hit & near_pronoun) / n_words,
                    *shared,
                ],
                1,
            )
        )
    return np.stack(out)


WIDTH = 15


def _all_features(texts: pa.Array, lexicons: list[Lexicon]) -> np.ndarray:
    parts = [features(flat, lexicons) for _, _, flat in flat_slices(texts)]
    return np.concatenate(parts, 1) if parts else np.zeros((len(lexicons), 0, WIDTH))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(fold_of(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """unit, part, toxic, other: texts of the batch that hold a unit, each unit once a text; unit 0 counts the texts."""
    for batch in batches:
        label = batch.column("label").to_numpy() > 0
        part = batch.column("part").to_numpy()
        keys, kinds = [np.zeros(len(label), np.uint64)], [2 * part + label]
        for start, end, flat in flat_slices(batch.column("text")):
            lowered = flat.mapped(LOWER)
            starts, ends, owner = lowered.runs(_WORD)
            for found in units(lowered, starts, ends):
                first, _, _ = firsts(with_owner(found, owner))
                first = first[found[first] != 0]
                keys.append(found[first])
                kinds.append((2 * part + label)[start + owner[first]])
        table = np.stack([np.concatenate(keys).view(np.int64), np.concatenate(kinds)], 1)
        distinct, counts = np.unique(table, axis=0, return_counts=True) if len(table) else (table, np.zeros(0, np.int64))
        toxic = distinct[:, 1] % 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(distinct[:, 0].copy()), pa.array((distinct[:, 1] // 2).astype(np.int32)), pa.array(counts * toxic), pa.array(counts * (1 - toxic))],
            names=["unit", "part", "toxic", "other"],
        )


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    forest: Forest
    curve: tuple[np.ndarray, np.ndarray]

    def score(self, texts: pa.Array) -> np.ndarray:
        raw = self.forest.raw(_all_features(texts, [self.lexicon])[0])
        return np.clip(np.interp(raw, *self.curve), 0, 1)


def _lexicons(rows: DataFrame) -> list[Lexicon]:
    """The lexicon of each part, from the other parts' rows, and last the one of all rows."""
    counts = rows.select("text", "label", "part").mapInArrow(_unit_counts, "unit bigint, part int, toxic bigint, other bigint")
    part = lambda c, i: F.sum(F.when(F.col("part") == i, F.col(c)).otherwise(0))
    summed = counts.groupBy("unit").agg(*[part(c, i).alias(f"{c}{i}") for c in ("toxic", "other") for i in range(PARTS)])
    toxic, other = (sum(F.col(f"{c}{i}") for i in range(PARTS)) for c in ("toxic", "other"))
    rank = F.when(F.col("unit") == 0, F.lit(float("inf"))).otherwise(toxic / F.sqrt(toxic + other))
    table = summed.where((F.col("unit") == 0) | (toxic >= 3)).orderBy(rank.desc(), "unit").limit(UNITS).toPandas()
    columns = {c: np.stack([table[f"{c}{i}"].to_numpy(float) for i in range(PARTS)]) for c in ("toxic", "other")}
    keys = table["unit"].to_numpy(np.int64).view(np.uint64)
    total, unit = keys == 0, keys != 0
    out = []
    for i in [*range(PARTS), None]:
        of = [j for j in range(PARTS) if j != i]
        a, b = columns["toxic"][of].sum(0), columns["other"][of].sum(0)
        out.append(make_lexicon(keys[unit], a[unit], b[unit], int(a[total].sum()), int(b[total].sum())))
    return out


def _sample_features(lexicons: list[Lexicon]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            rows = _all_features(batch.column("text"), lexicons[:PARTS])[part, np.arange(len(part))]
            listed = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, WIDTH, dtype=np.int32), rows.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("label"), listed], names=["doc_id", "part", "label", "x"]
            )

    return run


def fit_toxicity(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> ToxicityModel:
    part = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(PARTS)).cast("int")  # equal texts fall in one part
    rows = training_rows(documents, labels, "toxic", held_out(), limit).select(
        F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"), "label", part.alias("part")
    )
    lexicons = _lexicons(rows)
    table = rows.mapInArrow(_sample_features(lexicons), "doc_id string, part int, label double, x array<double>").toPandas()
    table = table.assign(key=[tuple(x) for x in table.x]).sort_values(["doc_id", "key"])
    x = np.stack(table.x.to_numpy()) if len(table) else np.zeros((0, WIDTH))
    y, of = table.label.to_numpy(float), table.part.to_numpy()
    unseen = np.zeros(len(y))
    for i in range(PARTS):
        unseen[of == i] = fit_forest(x[of != i], y[of != i], rounds=60, depth=3).raw(x[of == i])
    return ToxicityModel(lexicons[-1], fit_forest(x, y, rounds=60, depth=3), isotonic(unseen, y))


def _scorer(model: ToxicityModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return score


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents with a column `_score`: the calibrated probability of label 1."""
    plain = documents.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(documents.columns) if c != "text"})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    scored = plain.mapInArrow(_scorer(model), f"{schema}, score double")
    return scored.select(*[scored[a].alias(c) for a, c in zip(plain.columns, documents.columns)], scored["score"].alias("_score"))


def classify_toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    scored = score_toxicity(documents.select("doc_id", "text"), fit_toxicity(documents, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_civil(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    scored = score_toxicity(documents, fit_toxicity(documents, labels))
    return scored.where(F.col("_score") < threshold).drop("_score")
