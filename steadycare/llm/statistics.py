"""Document statistics as a dense matrix, one row a text, from whole texts."""

import numpy as np
import pyarrow as pa

from .flat import LOWER, Flat, byte_class, firsts, flat_slices, ngram_keys, with_owner

SPACE = byte_class(lambda b: b == 32 or 9 <= b <= 13)
NOT_SPACE = ~SPACE
SYMBOL = byte_class(lambda b: chr(b) in "#*$%&|<>")
UPPER = byte_class(lambda b: 65 <= b <= 90)
LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
DIGIT = byte_class(lambda b: 48 <= b <= 57)
MARK = byte_class(lambda b: 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126)
BANG = byte_class(lambda b: chr(b) in "!?")
STOP = byte_class(lambda b: chr(b) in ".!?")
COMMA = byte_class(lambda b: chr(b) in ",;:")
PIPE = byte_class(lambda b: b == 124)
NEWLINE = byte_class(lambda b: b == 10)
NOT_NEWLINE = ~NEWLINE
LEAD = byte_class(lambda b: b & 0xC0 != 0x80)  # one byte of each code point

NAMES = (
    "log_words", "mean_word", "symbols", "upper", "digits", "marks", "bangs", "stops", "commas", "pipes", "lines",
    "not_ascii", "upper_words", "marked_words", "distinct_words", "repeated_trigrams", "duplicate_lines", "top_word",
    "long_words", "one_letter_words",
)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def repeated_words(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which words stand in a window of n words that occurs twice or more in its text, the first one included."""
    grams, at = ngram_keys(keys, owner, n)
    marks = np.zeros(len(keys) + 1, np.int64)
    if len(grams):
        _, inverse, counts = firsts(with_owner(grams, owner[at]))
        at = at[counts[inverse] > 1]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + n, -1)
    return np.cumsum(marks[:-1]) > 0


def lines_of(flat: Flat, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Owners of the lines that hold a word, and whether an earlier line of the text is equal."""
    starts, ends, owner = flat.runs(NOT_NEWLINE)
    if not len(starts):
        return owner, np.zeros(0, bool)
    with_word = np.unique(np.searchsorted(starts, words[0], "right") - 1)
    starts, ends, owner = starts[with_word], ends[with_word], owner[with_word]
    first, _, _ = firsts(with_owner(flat.hashes(starts, ends), owner))
    again = np.ones(len(starts), bool)
    again[first] = False
    return owner, again


def slice_statistics(flat: Flat) -> np.ndarray:
    words = starts, ends, owner = flat.runs(NOT_SPACE)
    lowered = flat.mapped(LOWER)
    keys = lowered.hashes(starts, ends)
    chars, n_words = flat.count(LEAD), flat.per_text(owner)
    lengths = ends - starts
    sums = {name: np.concatenate([[0], np.cumsum(table[flat.data])]) for name, table in (("u", UPPER), ("l", LETTER), ("m", MARK))}
    inside = lambda name: sums[name][ends] - sums[name][starts]
    upper, letters, marks = inside("u"), inside("l"), inside("m")
    first, inverse, counts = firsts(with_owner(keys, owner))
    top = np.zeros(flat.n)
    np.maximum.at(top, owner[first], counts)
    line_owner, again = lines_of(flat, words)
    by = lambda mask: flat.per_text(owner, mask.astype(float))
    text_letters = flat.count(LETTER)
    return np.stack(
        [
            np.log1p(n_words),
            _ratio(by(lengths), n_words),
            _ratio(flat.count(SYMBOL), chars),
            _ratio(flat.count(UPPER), text_letters),
            _ratio(flat.count(DIGIT), chars),
            _ratio(flat.count(MARK), chars),
            _ratio(flat.count(BANG), n_words),
            _ratio(flat.count(STOP), n_words),
            _ratio(flat.count(COMMA), n_words),
            _ratio(flat.count(PIPE), n_words),
            _ratio(flat.count(NEWLINE), n_words),
            _ratio(flat.count(~LEAD), chars),
            _ratio(by((upper > 1) & (2 * upper > letters)), n_words),
            _ratio(by((marks > 1) & (marks < lengths)), n_words),
            _ratio(flat.per_text(owner[first]), n_words),
            _ratio(by(repeated_words(keys, owner, 3)), n_words),
            _ratio(flat.per_text(line_owner, again.astype(float)), flat.per_text(line_owner)),
            _ratio(top, n_words),
            _ratio(by(lengths > 20), n_words),
            _ratio(by(letters == 1), n_words),
        ],
        1,
    )


def statistics(texts: pa.Array) -> np.ndarray:
    """len(texts) x len(NAMES). A null text counts as empty, and an empty text is a row of zeros."""
    parts = [slice_statistics(flat) for _, _, flat in flat_slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
