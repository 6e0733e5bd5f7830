"""String similarity and normalisation (FN-16, FN-17, FN-19, FN-20).

Normalisation is built-in expressions. Spark has no Jaro-Winkler and no
transposition-aware edit distance; these run over whole Arrow columns (``arrow_udf``): all
pairs of a batch with texts of about the same length advance together, one numpy step per
character (or pair of characters), once per different pair of the batch. Where only
similarities from some threshold on matter, pairs that cannot reach it are told from the
letters they share and not measured.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# Ship these helpers with the tasks (by value): executors then need no copy of
# this package on their Python path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass


#: cells that the arrays of one group may hold (pairs x characters, or x characters twice)
CELLS = 1_000_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, one row per text (0 behind its end), and the lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), max(int(sizes.max(initial=0)), 1)), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out, sizes


def _narrowed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same codes in as few bytes as they need."""
    top = max(int(x.max(initial=0)), int(y.max(initial=0)))
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32
    return x.astype(kind), y.astype(kind)


def _by_size(a: list[str], b: list[str], square: bool) -> Iterator[np.ndarray]:
    """Numbers of pairs with texts of about the same length, as many as fit ``CELLS``."""
    longest = np.fromiter((max(len(x), len(y)) for x, y in zip(a, b)), np.int64, len(a))
    order = np.argsort(longest, kind="stable")
    ordered = longest[order]
    at = 0
    while at < len(order):
        # pairs of one group differ in length by a quarter at most, so little is padding
        size = int(ordered[at])
        most = size + size // 4 + 4
        fit = max(1, CELLS // (most + 2) ** (2 if square else 1))
        end = min(at + fit, int(np.searchsorted(ordered, most, "right")))
        yield order[at:end]
        at = end


def _matches_wide(x: np.ndarray, y: np.ndarray, n1: np.ndarray, n2: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaro's matched characters of both texts: each takes the first free equal one in its window."""
    rows = np.arange(len(x))
    place = np.arange(y.shape[1], dtype=np.int32)
    free = place < n2[:, None]
    matched = np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        fits = y == x[:, i, None]
        fits &= free
        fits &= place >= (i - window)[:, None]
        fits &= place <= np.where(i < n1, i + window, -1)[:, None]
        first = fits.argmax(axis=1)
        hit = fits[rows, first]
        matched[:, i] = hit
        free[rows[hit], first[hit]] = False
    return matched, ~free & (place < n2[:, None])


def _ones(n: np.ndarray) -> np.ndarray:
    """Words with their lowest n bits set (n from 0 to 64)."""
    return np.where(n >= 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))


def _matches(x: np.ndarray, y: np.ndarray, n1: np.ndarray, n2: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with the other text's places as the bits of one word, where they fit."""
    if y.shape[1] > 64:
        return _matches_wide(x, y, n1, n2, window)
    words = np.zeros((len(x), 8), np.uint8)
    equal, used = words.view("<u8")[:, 0], -(-y.shape[1] // 8)
    whole = _ones(n2)
    free = whole.copy()
    matched = np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        words[:, :used] = np.packbits(y == x[:, i, None], axis=1, bitorder="little")
        fits = equal & free & _ones(np.minimum(np.where(i < n1, i + window + 1, 0), 64)) & ~_ones(np.maximum(i - window, 0))
        first = fits & (~fits + np.uint64(1))
        free &= ~first
        matched[:, i] = first != 0
    taken = np.unpackbits((whole & ~free).astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little")
    return matched, taken[:, : y.shape[1]].astype(bool)


def _jaro_winkler_group(a: list[str], b: list[str], prefix_weight: float, boost_threshold: float) -> np.ndarray:
    x, n1 = _codes(a)
    y, n2 = _codes(b)
    x, y = _narrowed(x, y)
    matched, taken = _matches(x, y, n1, n2, np.maximum(np.maximum(n1, n2) // 2 - 1, 0))
    m = matched.sum(axis=1)
    width = int(m.max(initial=0))
    # matched characters of both texts in their order
    of_x = np.take_along_axis(x, np.argsort(~matched, axis=1, kind="stable")[:, :width], 1)
    of_y = np.take_along_axis(y, np.argsort(~taken, axis=1, kind="stable")[:, :width], 1)
    half = ((of_x != of_y) & (np.arange(width) < m[:, None])).sum(axis=1) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (m / n1 + m / n2 + (m - half) / m) / 3.0
    jaro = np.where(m == 0, 0.0, jaro)
    start = min(4, x.shape[1], y.shape[1])
    same = (x[:, :start] == y[:, :start]) & (np.arange(start) < np.minimum(n1, n2)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    out = np.where(jaro > boost_threshold, jaro + prefix * prefix_weight * (1.0 - jaro), jaro)
    return np.where([p == q for p, q in zip(a, b)], 1.0, out)


def jaro_winkler_pairs(a: list[str], b: list[str], prefix_weight: float = 0.1, boost_threshold: float = 0.7) -> np.ndarray:
    """Jaro-Winkler similarity of a[i] and b[i] for all i.

    Jaro matches within max(length) // 2 - 1; the bonus for a common prefix (4 characters at
    most) applies above 0.7. One numpy step per character serves all pairs of a group.
    """
    out = np.empty(len(a))
    for at in _by_size(a, b, square=False):
        out[at] = _jaro_winkler_group([a[i] for i in at], [b[i] for i in at], prefix_weight, boost_threshold)
    return out


#: buckets of the letter counts
LETTERS = 64


def _most_similar(a: list[str], b: list[str], prefix_weight: float = 0.1, boost_threshold: float = 0.7) -> np.ndarray:
    """What the Jaro-Winkler similarity of a[i] and b[i] cannot exceed: as if all letters they share
    were matched in order. Letters are counted in buckets, which can only make more of them common."""

    def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        sizes = np.fromiter(map(len, place), np.int64, len(place))
        flat = np.frombuffer("".join(place).encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS
        cells = np.repeat(np.arange(len(place)) * LETTERS, sizes) + flat
        counts = np.bincount(cells, minlength=len(place) * LETTERS).reshape(len(place), LETTERS)
        at = np.fromiter((place[t] for t in texts), np.int64, len(texts))
        return counts.astype(np.uint16 if sizes.max(initial=0) < 1 << 16 else np.int64)[at], sizes[at], _codes([t[:4] for t in place])[0][at]

    (ca, n1, pa_), (cb, n2, pb_) = counted(a), counted(b)
    shared = np.minimum(ca, cb).sum(axis=1, dtype=np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(shared == 0, np.where(n1 + n2 == 0, 1.0, 0.0), (shared / n1 + shared / n2 + 1.0) / 3.0)
    start = min(pa_.shape[1], pb_.shape[1])
    same = (pa_[:, :start] == pb_[:, :start]) & (pa_[:, :start] != 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > boost_threshold, jaro + prefix * prefix_weight * (1.0 - jaro), jaro)


def jaro_winkler_reaching(a: list[str], b: list[str], least: float) -> np.ndarray:
    """Jaro-Winkler similarity of a[i] and b[i] where it may reach ``least``, a bound below ``least`` elsewhere."""
    out = _most_similar(a, b)
    near = np.flatnonzero(out >= least - 1e-9)
    out[near] = jaro_winkler_pairs([a[i] for i in near], [b[i] for i in near])
    return out


def _damerau_group(a: list[str], b: list[str]) -> np.ndarray:
    x, n = _codes(a)
    y, m = _codes(b)
    x, y = _narrowed(x, y)
    rows, width, height = np.arange(len(a)), y.shape[1], x.shape[1]
    big = width + height
    d = np.empty((height + 2, width + 2, len(a)), np.int32)
    d[0], d[:, 0] = big, big
    d[1:, 1] = np.arange(height + 1)[:, None]
    d[1, 1:] = np.arange(width + 1)[:, None]
    last_row = np.zeros((width, len(a)), np.int64)  # last place in a, so far, of each character of b
    for i in range(1, height + 1):
        same = (y == x[:, i - 1, None]).T
        at = np.where(same, np.arange(1, width + 1)[:, None], 0)
        last_col = np.zeros_like(at)  # last place in b, before this one, of a's character
        last_col[1:] = np.maximum.accumulate(at, axis=0)[:-1]
        for j in range(1, width + 1):
            i1, j1 = last_row[j - 1], last_col[j - 1]
            swap = d[i1, j1, rows] + (i - i1 - 1) + 1 + (j - j1 - 1)
            step = np.minimum(d[i, j + 1], d[i + 1, j]) + 1
            d[i + 1, j + 1] = np.minimum(np.minimum(d[i, j] + ~same[j - 1], step), swap)
        last_row = np.where(same, i, last_row)
    return d[n + 1, m + 1, rows]


def damerau_levenshtein_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """Unrestricted Damerau-Levenshtein distance (adjacent transpositions) of a[i] and b[i] for all i."""
    out = np.empty(len(a), np.int64)
    for at in _by_size(a, b, square=True):
        out[at] = _damerau_group([a[i] for i in at], [b[i] for i in at])
    return out


def jaro_winkler(a: str, b: str) -> float:
    return float(jaro_winkler_pairs([a], [b])[0])


def damerau_levenshtein(a: str, b: str) -> int:
    return int(damerau_levenshtein_pairs([a], [b])[0])


def _over_pairs(a: pa.Array, b: pa.Array, kind: pa.DataType, measure) -> pa.Array:
    """``measure`` of the different pairs of a batch, NULL where a side is missing."""
    known = np.flatnonzero(pc.and_(a.is_valid(), b.is_valid()).to_numpy(zero_copy_only=False))
    if not len(known):
        return pa.nulls(len(a), kind)
    x, y = a.take(pa.array(known)).dictionary_encode(), b.take(pa.array(known)).dictionary_encode()
    pairs, at = np.unique(x.indices.to_numpy().astype(np.int64) * len(y.dictionary) + y.indices.to_numpy(), return_inverse=True)
    left, right = x.dictionary.to_pylist(), y.dictionary.to_pylist()
    values = measure([left[i] for i in pairs // len(right)], [right[i] for i in pairs % len(right)])
    out, missing = np.zeros(len(a), values.dtype), np.ones(len(a), bool)
    out[known], missing[known] = values[at], False
    return pa.array(out, kind, mask=missing)


@arrow_udf(T.DoubleType())
def _jw_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return _over_pairs(a, b, pa.float64(), jaro_winkler_pairs)


@cache
def _jw_reaching_udf(least: float):
    @arrow_udf(T.DoubleType())
    def reaching(a: pa.Array, b: pa.Array) -> pa.Array:
        return _over_pairs(a, b, pa.float64(), lambda x, y: jaro_winkler_reaching(x, y, least))

    return reaching


@arrow_udf(T.IntegerType())
def _dl_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return _over_pairs(a, b, pa.int32(), damerau_levenshtein_pairs)


def _accents() -> tuple[str, str]:
    """Latin letters with accents and their base letters, from the Unicode decompositions."""
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    bases = [(c, unicodedata.normalize("NFKD", c)[0]) for c in letters]
    plain = [(c, b) for c, b in bases if b != c and b.isascii()]
    return "".join(c for c, _ in plain), "".join(b for _, b in plain)


_ACCENTED, _PLAIN = _accents()
_MARKS = r"\p{M}+"  # combining marks written on their own
_SIGNS = r"[\p{Punct}&&\p{ASCII}]"
_SPACES = r"(?U)[\s\x1c-\x1f]+"


def v1(c: Column | str) -> Column:
    """FN-16: lower case, accents off, ASCII punctuation and runs of white space to one
    space, ends trimmed. A blank stays as it is, NULL stays NULL."""
    raw = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(F.translate(F.lower(raw), _ACCENTED, _PLAIN), _MARKS, "")
    tidy = F.trim(F.regexp_replace(F.regexp_replace(bare, _SIGNS, " "), _SPACES, " "))
    return F.when(F.regexp_replace(raw, _SPACES, "") == "", raw).otherwise(tidy)


def v2(c: Column | str) -> Column:
    """FN-17: v1 with its words sorted."""
    return F.array_join(F.array_sort(F.split(v1(c), " ")), " ")


def jaro_winkler_col(a: Column, b: Column, least: float = 0.0) -> Column:
    """FN-19: NULL when either side is NULL. Below ``least`` any value below it may stand for the similarity."""
    return _jw_reaching_udf(float(least))(a, b) if least > 0 else _jw_udf(a, b)


def damerau_levenshtein_col(a: Column, b: Column) -> Column:
    """FN-20: NULL when either side is NULL."""
    return _dl_udf(a, b)


def edits_unsettled(a: Column, b: Column, most: int) -> Column:
    """Whether Levenshtein's distance leaves open that the Damerau-Levenshtein distance is ``most`` at most.

    A transposition is two of Levenshtein's edits, so the distance lies between half of
    Levenshtein's and the whole. With twice ``most`` edits every step must be a transposition,
    which keeps the letters.
    """
    plain = F.levenshtein(a, b, 2 * most)
    letters = lambda c: F.sort_array(F.split(c, ""))
    return F.coalesce(F.when(plain <= most, F.lit(False)).when(plain == 2 * most, letters(a) == letters(b)).otherwise(plain > most), F.lit(False))


def edits_within(a: Column, b: Column, most: int, settled: bool = False) -> Column:
    """FN-20: whether the Damerau-Levenshtein distance is ``most`` at most; NULL when either side is NULL.

    Only unsettled pairs are measured, none where all are known to be ``settled``.
    """
    plain = F.levenshtein(a, b, 2 * most)
    short = F.when(plain.isNotNull(), (plain != -1) & (plain <= most))
    if settled:
        return short
    measured = damerau_levenshtein_col(F.when(edits_unsettled(a, b, most), a), b) <= most
    return short | F.coalesce(measured, F.lit(False)) if most else short


NORMALISATIONS = {"v1": v1, "v2": v2}


def normalise_field(field: str, declared: dict[str, str | None]) -> Column:
    """FN-18: apply the normalisation declared for ``field``; refuse a field declared
    without one (a silent pass-through would hide the mistake)."""
    if field not in declared:
        raise KeyError(f"field not declared: {field}")
    kind = declared[field]
    if kind is None:
        raise ValueError(f"field '{field}' is declared without normalisation")
    return NORMALISATIONS[kind](field)
