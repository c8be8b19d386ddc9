"""A linear-chain tagger of names in numpy: averaged structured perceptron, exact Viterbi.

Only capitalised words and name particles may be part of a name; every other token is
outside. So a text falls into runs of such words that don't touch each other, and the best
labels of each run are the best labels of the text.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from corpgraph.functions.people import PARTICLES, ROLE_TERMS, SUFFIXES

Window = tuple[str, list[tuple[int, int]]]
OUT, FIRST, NEXT = range(3)
#: Shapes, endings and words that fewer windows have get no weights of their own.
SEEN = 3
OFFSETS = (-2, -1, 0, 1, 2)
SLOTS = 4
TOGETHER = 1_000_000
#: Words' letters whose shapes a process keeps.
SHAPES = 10_000
TOKEN = re.compile(r"[^\W\d_]\.|[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+|\n|[^\w\s]|_")
_PARTICLES = set(PARTICLES.replace("|", " ").split())
_CLASSES = dict.fromkeys(ROLE_TERMS, "class role") | dict.fromkeys(_PARTICLES, "class particle") | dict.fromkeys(SUFFIXES, "class suffix")


_REPEATED = re.compile(r"(.)\1+")


class _Letters(dict):
    """Shapes of single characters by code, kept as they are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        return self[code]


_LETTERS = _Letters()


@functools.lru_cache(maxsize=SHAPES)
def _shape(letters: str) -> str:
    return "shape " + _REPEATED.sub(r"\1", letters)


def _slots(word: str) -> tuple[str, str, str, str]:
    """Shape, class, ending and the word itself."""
    low = word.lower()
    return _shape(word.translate(_LETTERS)), _CLASSES.get(low.rstrip("."), "class none"), "ending " + low[-3:], "word " + low


LETTER, DIGIT, SPACE, ALONE, JOINT = range(1, 6)
_KIND, _UPPER, _LOWER = np.zeros(0x110000, np.uint8), np.zeros(0x110000, bool), np.zeros(0x110000, np.uint64)
_DOT = ord(".")


def _packed(a, b, c):
    return a | b << np.uint64(21) | c << np.uint64(42)


_PACKED = np.array([_packed(*(np.uint64(ord(c)) for c in p.ljust(3, "\0"))) for p in _PARTICLES if len(p) in (2, 3)], np.uint64)


def _kinds(codes: np.ndarray) -> np.ndarray:
    """What each character is in ``TOKEN``; told once for each that is met."""
    kind = _KIND[codes]
    if not kind.all():
        for code in np.unique(codes[kind == 0]).tolist():
            c = chr(code)
            _UPPER[code], _LOWER[code] = c.isupper(), ord(c.lower()) if len(c.lower()) == 1 else code
            _KIND[code] = JOINT if c in "'’-" else ALONE if c == "\n" else LETTER if re.match(r"[^\W\d_]", c) else DIGIT if re.match(r"\d", c) else SPACE if re.match(r"\s", c) else ALONE
        kind = _KIND[codes]
    return kind


def spans(codes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens: what ``TOKEN`` finds, for a whole text at once."""
    before, after = (lambda x: np.append(False, x[:-1])), (lambda x: np.append(x[1:], False))
    letter, digit = kind == LETTER, kind == DIGIT
    word = letter | ((kind == JOINT) & before(letter) & after(letter))
    first, last = word & ~before(word), word & ~after(word)
    dotted = first & last & after(codes == _DOT)
    dot = before(dotted)
    alone = ((kind == ALONE) | (kind == JOINT)) & ~word
    starts = first | (digit & ~before(digit)) | (alone & ~dot)
    return np.flatnonzero(starts), 1 + np.flatnonzero((last & ~dotted) | (digit & ~after(digit)) | alone)


def _cut(texts: Sequence[str], rows: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(texts, spans, rows of the weights, whether it may be in a name) of each token of all texts, with tokens that are beyond each text (-1) after it.

    Words that stand by no word of a name are not looked up: nothing reads their rows.
    """
    whole, apart = " ".join(texts), max(OFFSETS)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    starts, ends = spans(codes, _kinds(codes))
    of = np.searchsorted(begins, starts, side="right") - 1
    at = np.arange(len(starts)) + apart * of
    able = np.zeros(len(starts) + apart * len(texts), bool)
    size, low = ends - starts, np.append(_LOWER[codes], np.zeros(3, np.uint64))
    third = np.where(size == 3, low[starts + 2], np.uint64(0))
    able[at] = _UPPER[codes[starts]] | (((size == 2) | (size == 3)) & np.isin(_packed(low[starts], low[starts + 1], third), _PACKED))
    read = np.zeros(len(able) + 2 * apart, bool)
    by = np.flatnonzero(able) + apart
    for o in OFFSETS:
        read[by + o] = True
    read = np.flatnonzero(read[apart:-apart][at])
    ids: dict[str, int] = {}
    word = np.array([ids.setdefault(whole[a:b], len(ids)) for a, b in zip(starts[read].tolist(), ends[read].tolist(), strict=True)], np.int64)
    get = rows.get
    table = np.array([[get(a, 1), get(b, 1), get(c, 1), get(d, 1)] for a, b, c, d in map(_slots, ids)], np.int64).reshape(-1, SLOTS)
    features = np.zeros((len(able), SLOTS), np.int64)
    features[at[read]] = table[word]
    named, places = np.full(len(able), -1), np.full((len(able), 2), -1)
    named[at], places[at, 0], places[at, 1] = of, starts - begins[of], ends - begins[of]
    return named, places, features, able


def tokens(text: str, rows: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(spans, rows of the weights, whether it may be in a name) of each token of a text.

    Row 0 stands for what is beyond the text and for words that stand by no word of a name, row 1 for what isn't among ``rows``.
    """
    return tuple(x[: -max(OFFSETS)] for x in _cut([text], rows)[1:])


def vocabulary(texts: Sequence[str]) -> dict[str, int]:
    """Rows of what at least ``SEEN`` texts have."""
    counts = Counter(x for t in texts for x in {x for w in set(TOKEN.findall(t)) for x in _slots(w)})
    return {x: i + 2 for i, x in enumerate(sorted(x for x, n in counts.items() if n >= SEEN))}


def neighbours(features: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(places, offsets, slots): the features of the tokens at these places and of those around them."""
    edge = max(OFFSETS)
    return np.pad(features, ((edge, edge), (0, 0)))[at[:, None] + (edge + np.array(OFFSETS))]


def runs(able: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches in which all tokens may be in a name."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], able.astype(np.int8), [0]))))
    return edges[::2], edges[1::2] - edges[::2]


def best_labels(emitted: np.ndarray, moves: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Viterbi over all runs at once; tokens between them are OUT. A run comes from OUT and leaves to OUT."""
    labels = np.zeros(len(emitted), np.int8)
    if not len(starts):
        return labels
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    back = np.zeros(emitted.shape, np.int8)
    score = moves[OUT] + emitted[first]
    live = [int(np.searchsorted(-size, -j)) for j in range(size[0])]  # runs longer than j
    for j in range(1, size[0]):
        n = live[j]
        step = score[:n, :, None] + moves
        back[first[:n] + j] = step.argmax(1)
        score[:n] = step.max(1) + emitted[first[:n] + j]
    label = (score + moves[:, OUT]).argmax(1)
    for j in range(size[0] - 1, -1, -1):
        n = live[j]
        labels[first[:n] + j] = label[:n]
        label[:n] = back[first[:n] + j, label[:n]]
    return labels


@dataclass
class ChainTagger:
    """Spans of names in a text. Called with an empty text it finds none."""

    weights: np.ndarray  # (offsets, slots, rows, labels)
    moves: np.ndarray  # (from, to)
    rows: dict[str, int]

    def emitted(self, around: np.ndarray) -> np.ndarray:
        out = np.zeros((len(around), 3), np.float32)
        for o in range(len(OFFSETS)):
            for k in range(SLOTS):
                out += self.weights[o, k, around[:, o, k]]
        return out

    def label(self, features: np.ndarray, able: np.ndarray) -> np.ndarray:
        """Only tokens in runs are scored."""
        emitted = np.zeros((len(able), 3), np.float32)
        emitted[able] = self.emitted(neighbours(features, np.flatnonzero(able)))
        return best_labels(emitted, self.moves, *runs(able))

    def __call__(self, text: str) -> list[tuple[int, int]]:
        return self.many([text])[0]

    def many(self, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
        """The spans of each of several texts, labelled together, up to ``TOGETHER`` characters or one text at a time."""
        out: list[list[tuple[int, int]]] = []
        size, part = 0, []
        for t in texts:
            if part and size + len(t) > TOGETHER:
                out += self._tag(part)
                size, part = 0, []
            part.append(t)
            size += len(t)
        return out + (self._tag(part) if part else [])

    def _tag(self, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
        """Texts lie one after the other, with tokens between them that are beyond each text."""
        of, places, features, able = _cut(texts, self.rows)
        labels = self.label(features, able)
        begin = np.flatnonzero(labels == FIRST)
        stops = np.append(np.flatnonzero(labels != NEXT), len(labels))
        ends = stops[np.searchsorted(stops, begin, side="right")] - 1
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for i, a, b in zip(of[begin].tolist(), places[begin, 0].tolist(), places[ends, 1].tolist(), strict=True):
            out[i].append((a, b))
        return out


def gold(spans: np.ndarray, able: np.ndarray, named: Sequence[tuple[int, int]]) -> np.ndarray | None:
    """Labels of the tokens of the named spans; none where a name has a token that can't be in one."""
    labels = np.zeros(len(spans), np.int8)
    for a, b in named:
        at = np.flatnonzero((spans[:, 0] >= a) & (spans[:, 1] <= b))
        if not len(at) or not able[at].all():
            return None
        labels[at] = NEXT
        labels[at[0]] = FIRST
    return labels


def fit(windows: Sequence[Window], passes: int = 6) -> ChainTagger:
    """Averaged perceptron over labelled windows, in their order, until a pass has no error. Windows without a possible labelling are left out."""
    rows = vocabulary([text for text, _ in windows])
    shape = (len(OFFSETS), SLOTS, len(rows) + 2, 3)
    model = ChainTagger(np.zeros(shape, np.float32), np.zeros((3, 3), np.float32), rows)
    model.moves[OUT, NEXT] = -1e9
    summed, summed_moves, turn = np.zeros(shape), np.zeros((3, 3)), 1
    cut = [(f, a, g) for s, f, a, named in ((*tokens(text, rows), named) for text, named in windows) if len(s) and (g := gold(s, a, named)) is not None]
    places = np.arange(len(OFFSETS))[None, :, None], np.arange(SLOTS)[None, None, :]
    for _ in range(passes):
        errors = 0
        for features, able, right in cut:
            got = model.label(features, able)
            wrong = np.flatnonzero(got != right)
            errors += len(wrong)
            if len(wrong):
                around = neighbours(features, wrong)
                for labels, by in ((right, 1), (got, -1)):
                    at = (*places, around, labels[wrong][:, None, None])
                    np.add.at(model.weights, at, by)
                    np.add.at(summed, at, by * turn)
                    steps = np.zeros((3, 3), np.float32)
                    np.add.at(steps, (np.append(OUT, labels), np.append(labels, OUT)), by)
                    model.moves += steps
                    summed_moves += turn * steps
            turn += 1
        if not errors:
            break
    moves = model.moves - (summed_moves / turn).astype(np.float32)
    moves[OUT, NEXT] = -1e9
    return ChainTagger(model.weights - (summed / turn).astype(np.float32), moves, rows)
