"""Language identification word by word: a linear-chain conditional random field over the words of a text.

A word's features are its affixes, its character n-grams, itself, and membership in the lexicons of frequent words that
are learned per language; transitions between the languages of neighbouring words are learned with them. Training runs
are stretches of documents of different languages put one after the other, so the transitions know code-switched text:
of each training document at most ``RUNS`` stretches of ``RUN`` words, and of frequent languages a random part of these.
Forward-backward gives each word's probabilities; a document has the language with the largest sum, and its mean is the
score.

The score compares the learned languages with each other only: transitions pull a long text to one of them whatever it is
written in. ``Support`` tells whether a text is in a learned language at all, by the bits that its words' letters take
in letter models of the languages; what is usual is measured on documents left out of the letter counts. Letters are
counted, and their bits measured, in all training rows whole.

The field's training reads at most ``PER_LANGUAGE`` documents of each language (one row of the smallest hash in each of that many
hash buckets, at most ``TRAINING_CHARS`` characters), scoring reads all texts whole. Equal words of a worker share their feature sums. Documents of a batch go
through the chain together, longest first, so every step is one operation over all that are long enough.

Defined results: a NULL text and a text without a letter are ``und`` with score 0; without training rows every text is;
a row without id is held out; repeated rows have equal results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm._rows import map_texts, slices, text_key, written

FOLDS, TEST_FOLD = 4, 2
PER_LANGUAGE, MAX_LANGUAGES = 200, 200
RUN, RUNS, SEQUENCE = 25, 6, 8  # words of a stretch, stretches of a document, stretches of a training run
BUCKETS = 1 << 15
LEXICON = 200
STEPS, RATE, RIDGE = 40, 0.1, 1e-4
WORDS = re.compile(r"[^\W\d_]+")
HAS_WORD = r"[\p{L}\p{Nl}\p{No}]"  # what ``WORDS`` takes, for Spark
PIECES = re.compile(r"(?<=[\d_])[^\W\d_]+|[^\W\d_]+(?=[\d_])")  # letters in keys, digests, names
MAX_CELLS = 1_600_000  # words times languages that a worker holds sums of
BATCH_WORDS = 150_000  # words that go through the chain together, or one text
BATCH_BYTES = 2_000_000  # of texts that a worker holds as Python strings at once, or one text
TRAINING_CHARS = 200_000  # of a training document
UNKNOWN = "und"
PARTS = 5  # of the training documents; each is measured with the counts of the others
COUNTED_WORDS = 100_000  # different ones that a worker holds
CELLS = 1024  # of a bit; medians of held-out runs are counted by the nearest
ALPHABET = 1 << 16
SMOOTHING = 4.0
RUN_LENGTHS = tuple(1 << i for i in range(9))  # words for which limits are measured
USUAL, MARGIN, LEAST_MARGIN = 0.99, 3.0, 0.5  # quantile of held-out runs, multiple of its distance from the median, bits


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def pieces_of(text: str) -> set[str]:
    """Words that touch a digit or an underscore; they tell nothing of the language."""
    return set(PIECES.findall(text.lower()))


def word_features(word: str) -> list[int]:
    """Hash buckets of affixes, n-grams and the word."""
    bound = f"^{word}$"
    names = [f"w{word}", *(f"p{word[:k]}" for k in (1, 2, 3)), *(f"s{word[-k:]}" for k in (1, 2, 3))]
    names += [bound[i : i + 2] for i in range(len(bound) - 1)] + [bound[i : i + 3] for i in range(len(bound) - 2)]
    return [zlib.crc32(n.encode()) & (BUCKETS - 1) for n in dict.fromkeys(names)]


@dataclass
class Field:
    """Languages, weights per bucket, lexicons with their weights, and log transitions."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    lexicons: list[frozenset[str]] = field(default_factory=list)
    lexicon_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def potentials(self, words: list[str]) -> np.ndarray:
        """Feature sums of words, one row each."""
        lists = [word_features(w) for w in words]
        flat = np.fromiter((i for x in lists for i in x), np.int64)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]]).astype(np.int64)
        out = np.add.reduceat(self.weights[flat], starts, axis=0)
        for k, lexicon in enumerate(self.lexicons):
            out[[w in lexicon for w in words]] += self.lexicon_weights[k]
        return out


def packed_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that puts first words first, then second words, ...; documents longest first.

    Returns the index of each packed word among all words, the rank-ordered documents, and how many documents reach
    each step.
    """
    by_length = np.argsort(-lengths, kind="stable")
    sizes = lengths[by_length]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[by_length]
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(within, kind="stable")
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    return (np.repeat(starts, sizes) + within)[order], by_length, active


def forward_backward(potentials: np.ndarray, active: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals per packed word, the expected transitions, and the logarithm of the sum over all labelings."""
    top = potentials.max(axis=1, keepdims=True)
    local = np.exp(potentials - top)
    moves = np.exp(transitions)
    offsets = np.concatenate([[0], np.cumsum(active)])
    alpha, beta = np.empty_like(local), np.ones_like(local)
    log_sum = float(top.sum())
    for t, n in enumerate(active):
        at = slice(offsets[t], offsets[t] + n)
        a = local[at] if t == 0 else (alpha[offsets[t - 1] : offsets[t - 1] + n] @ moves) * local[at]
        total = a.sum(axis=1, keepdims=True)
        alpha[at] = a / total
        log_sum += float(np.log(total).sum())
    expected = np.zeros_like(moves)
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        nxt, at = slice(offsets[t + 1], offsets[t + 1] + n), slice(offsets[t], offsets[t] + n)
        ahead = local[nxt] * beta[nxt]
        b = ahead @ moves.T
        beta[at] = b / b.sum(axis=1, keepdims=True)
        weight = 1 / ((alpha[at] @ moves) * ahead).sum(axis=1, keepdims=True)
        expected += moves * ((alpha[at] * weight).T @ ahead)
    marginal = alpha * beta
    return marginal / marginal.sum(axis=1, keepdims=True), expected, log_sum


def marginals(potentials: np.ndarray, active: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of the labels of each packed word."""
    local = np.exp(potentials - potentials.max(axis=1, keepdims=True))
    moves = np.exp(transitions - transitions.max()).astype(local.dtype)
    offsets = np.concatenate([[0], np.cumsum(active)]).tolist()
    alpha, beta = np.empty_like(local), np.ones_like(local)
    for t, n in enumerate(active.tolist()):
        at, before = offsets[t], offsets[t - 1]
        a = local[at : at + n] if t == 0 else (alpha[before : before + n] @ moves) * local[at : at + n]
        alpha[at : at + n] = a / a.sum(axis=1, keepdims=True)
    back = np.ascontiguousarray(moves.T)
    for t in range(len(active) - 2, -1, -1):
        n, at, nxt = int(active[t + 1]), offsets[t], offsets[t + 1]
        b = (local[nxt : nxt + n] * beta[nxt : nxt + n]) @ back
        beta[at : at + n] = b / b.sum(axis=1, keepdims=True)
    alpha *= beta
    return alpha / alpha.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], seed: int = 7) -> Field:
    """Learn from texts and their languages by gradient steps on the likelihood of mixed runs."""
    names = sorted(set(languages))
    label = {x: i for i, x in enumerate(names)}
    rng = np.random.default_rng(seed)
    stretches, counts = [], [Counter() for _ in names]
    for text, language in zip(texts, languages, strict=True):
        words = words_of(text)
        counts[label[language]].update(words)
        places = rng.choice(max(1, len(words) // RUN), min(RUNS, max(1, len(words) // RUN)), replace=False)
        stretches += [(words[p * RUN : (p + 1) * RUN], label[language]) for p in places if words[p * RUN : (p + 1) * RUN]]
    if not stretches:
        return Field()
    per_label = Counter(y for _, y in stretches)
    few = min(max(per_label.values()), max(200, 4 * min(per_label.values())))
    picked: list[int] = []
    for y in range(len(names)):  # languages alike in number
        own = [i for i, s in enumerate(stretches) if s[1] == y]
        if own:
            picked += list(rng.choice(own, min(few, len(own)), replace=False))
    rng.shuffle(picked)
    vocabulary: dict[str, int] = {}
    ids, labels, lengths = [], [], []
    for at in range(0, len(picked), SEQUENCE):
        part = [stretches[i] for i in picked[at : at + SEQUENCE]]
        ids += [vocabulary.setdefault(w, len(vocabulary)) for words, _ in part for w in words]
        labels += [y for words, y in part for _ in words]
        lengths.append(sum(len(words) for words, _ in part))
    words, k = list(vocabulary), len(names)
    lexicons = [frozenset(w for w, _ in c.most_common(LEXICON)) for c in counts]
    lists = [word_features(w) + [BUCKETS + j for j, x in enumerate(lexicons) if w in x] for w in words]
    flat = np.fromiter((i for x in lists for i in x), np.int64)
    owner = np.repeat(np.arange(len(words)), [len(x) for x in lists])
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]]).astype(np.int64)
    packed, _, active = packed_order(np.array(lengths))
    word_at, true = np.array(ids)[packed], np.array(labels)[packed]
    wanted = np.zeros((k, k))
    position = np.cumsum([0, *lengths[:-1]])
    inner = np.ones(len(labels), bool)
    inner[position] = False
    y = np.array(labels)
    np.add.at(wanted, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    weights, moves = np.zeros((BUCKETS + k, k)), np.zeros((k, k))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    n = len(labels)
    for step in range(1, STEPS + 1):
        potentials = np.add.reduceat(weights[flat], starts, axis=0)[word_at]
        p, expected, _ = forward_backward(potentials, active, moves)
        p[np.arange(n), true] -= 1
        by_word = np.stack([np.bincount(word_at, p[:, j], len(words)) for j in range(k)], axis=1)
        slope = np.stack([np.bincount(flat, by_word[owner, j], BUCKETS + k) for j in range(k)], axis=1) / n + RIDGE * weights
        for value, grad, m, v in ((weights, slope, state[0], state[1]), (moves, (expected - wanted) / n + RIDGE * moves, state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(names, weights[:BUCKETS].astype(np.float32), lexicons, weights[BUCKETS:].astype(np.float32), moves)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, each with marks at both ends, and the first place of each word."""
    text = "".join([f"^^{w}$" for w in words]).encode("utf-32-le", "surrogatepass")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
    return np.frombuffer(text, np.uint32), np.cumsum(sizes) - sizes


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among the sorted ones, or one past the end."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return np.where(keys[at] == wanted, at, len(keys)) if len(keys) else np.zeros(len(wanted), np.int64)


def letter_runs(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Letters of counted words with the two before them, as ascending numbers of three code points, and how often each occurs."""
    points, starts = _letters(list(words))
    inner = np.ones(len(points), bool)
    inner[starts] = inner[starts + 1] = False
    at = np.flatnonzero(inner)
    points = points.astype(np.int64)
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff([*starts, len(points)]) - 2)
    runs, of = np.unique(points[at - 2] << 42 | points[at - 1] << 21 | points[at], return_inverse=True)
    return runs, np.bincount(of, times, len(runs)).astype(np.int64)


class Letters:
    """Bits of a letter after the two before it, one column per column of counts; unmet letters and sequences fall back.

    ``runs`` are different numbers of ``letter_runs``, ``times`` has a row for each.
    """

    def __init__(self, runs: np.ndarray, times: np.ndarray):
        points = runs >> 42, runs >> 21 & 0x1FFFFF, runs & 0x1FFFFF
        self.alphabet = np.unique(np.concatenate(points))
        self.base = len(self.alphabet) + 1
        a, b, letter = (_find(self.alphabet, x) for x in points)
        self.keys, seen = [], []
        for places in (letter, b * self.base + letter, (a * self.base + b) * self.base + letter):
            keys, of = np.unique(places, return_inverse=True)
            seen.append(np.stack([np.bincount(of, x, len(keys)) for x in times.T], axis=1))
            self.keys.append(keys)
        self.bits, self.back = [], []
        lower = np.full((len(self.keys[0]), times.shape[1]), np.log2(ALPHABET))
        for k in range(3):
            before, of = np.unique(self.keys[k] // self.base if k else np.zeros_like(self.keys[k]), return_inverse=True)
            total = np.stack([np.bincount(of, x, len(before)) for x in seen[k].T], axis=1)
            if k:
                lower = self.bits[k - 1][_find(self.keys[k - 1], self.keys[k] % self.base**k)]
            p = (seen[k] + SMOOTHING * np.exp2(-lower)) / (total[of] + SMOOTHING)
            back = np.log2((total + SMOOTHING) / SMOOTHING)
            # the last row is for what was not met
            last = np.log2(ALPHABET) + back if k == 0 else np.zeros((1, times.shape[1]))
            self.bits.append(np.concatenate([-np.log2(p), last]).astype(np.float32))
            self.back.append((before, np.concatenate([back, np.zeros((1, times.shape[1]))]).astype(np.float32)))

    def _places(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        codes = _find(self.alphabet, points)
        inner = np.ones(len(points), bool)
        inner[starts] = inner[starts + 1] = False
        at = np.flatnonzero(inner)
        return codes[at - 2], codes[at - 1], codes[at], starts - 2 * np.arange(len(starts))

    def per_word(self, words: list[str]) -> np.ndarray:
        """Mean bits of the letters of each word, one row each."""
        step = max(1000, 100_000 // self.bits[0].shape[1])
        return np.concatenate([np.zeros((0, self.bits[0].shape[1]), np.float32), *(self._per_word(words[i : i + step]) for i in range(0, len(words), step))])

    def _per_word(self, words: list[str]) -> np.ndarray:
        a, b, letter, starts = self._places(*_letters(words))
        out = self.bits[0][_find(self.keys[0], letter)]
        for k, key, context in ((1, b * self.base + letter, b), (2, (a * self.base + b) * self.base + letter, a * self.base + b)):
            at = _find(self.keys[k], key)
            before, back = self.back[k]
            out = np.where((at < len(self.keys[k]))[:, None], self.bits[k][at], out + back[_find(before, context)])
        return np.add.reduceat(out, starts, axis=0) / np.diff([*starts, len(letter)])[:, None]


@dataclass
class Support:
    """Letter models of the languages and, per language and run length, the largest median of bits that is usual."""

    letters: Letters
    limits: np.ndarray


def counted_runs(rows: Iterable[tuple[str, int, str]]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """Language, part, letter runs and how often they occur in texts of a language and part; several of a kind are to be summed."""
    counts: dict[tuple[str, int], Counter] = defaultdict(Counter)
    held = 0
    for language, part, text in rows:
        own = counts[language, part]
        held -= len(own)
        own.update(map(re.Match.group, WORDS.finditer(text.lower())))
        held += len(own)
        if held > COUNTED_WORDS:
            yield from ((*kind, *letter_runs(c)) for kind, c in counts.items() if c)
            counts.clear()
            held = 0
    yield from ((*kind, *letter_runs(c)) for kind, c in counts.items() if c)


class HeldOut:
    """How often runs of distinct whole words of a language's texts have which median of bits, by the counts of other parts."""

    def __init__(self, others: Letters):
        self.others = others
        self.medians = [np.zeros(0, np.int64) for _ in RUN_LENGTHS]
        self.empty()

    def empty(self) -> None:
        """Forget the words met; changes no result."""
        self.index: dict[str, int] = {}
        self.bits = np.zeros((0, PARTS), np.float32)

    def add(self, texts: list[str], parts: list[int]) -> None:
        numbers, index = [], self.index
        for text in texts:
            pieces = pieces_of(text)
            words = dict.fromkeys(map(re.Match.group, WORDS.finditer(text.lower())))
            numbers.append(np.array([index.setdefault(w, len(index)) for w in words if w not in pieces], np.int64))
        self.bits = np.concatenate([self.bits, self.others.per_word(list(islice(index, len(self.bits), None))).astype(np.float32)])
        lengths = np.array([len(x) for x in numbers])
        bits = self.bits[np.concatenate(numbers), np.repeat(parts, lengths)]
        within = np.arange(len(bits)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        for k, n in enumerate(RUN_LENGTHS):
            runs = bits[within < np.repeat(lengths // n * n, lengths)].reshape(-1, n)
            more = np.bincount(np.rint(np.median(runs, axis=1) * CELLS).astype(np.int64), minlength=len(self.medians[k]))
            more[: len(self.medians[k])] += self.medians[k]
            self.medians[k] = more


def held_out(others: dict[str, Letters], rows: Iterable[tuple[list[str], list[int], list[str]]]) -> dict[str, HeldOut]:
    """Medians of the languages that are in ``others``, from lists of languages, parts and texts."""
    found = {name: HeldOut(x) for name, x in others.items()}
    for languages, parts, texts in rows:
        for name in found.keys() & set(languages):
            own = [i for i, x in enumerate(languages) if x == name]
            found[name].add([texts[i] for i in own], [parts[i] for i in own])
        if sum(len(x.index) for x in found.values()) > COUNTED_WORDS:
            for x in found.values():
                x.empty()
    return found


def _quantile(times: np.ndarray, share: float) -> float:
    """Quantile of the bits counted by cells, between the two nearest."""
    upto = np.cumsum(times)
    place = share * (upto[-1] - 1)
    low, high = np.searchsorted(upto, [np.floor(place), np.ceil(place)], side="right") / CELLS
    return low + (place - np.floor(place)) * (high - low)


def _support(
    names: list[str], counts: Iterable[tuple[str, int, np.ndarray, np.ndarray]], measure: Callable[[dict[str, Letters]], dict[tuple[str, int], np.ndarray]],
) -> Support | None:
    """``measure`` gives the counted medians per language and place of a run length, for the languages with more than one part."""
    parts: dict[str, list[tuple[int, np.ndarray, np.ndarray]]] = defaultdict(list)
    for name, *part in counts:
        parts[name].append(part)
    if not parts:
        return None
    own, others = {}, {}
    for name, x in parts.items():
        runs, of = np.unique(np.concatenate([r for _, r, _ in x]), return_inverse=True)
        times = np.zeros((len(runs), PARTS), np.int64)
        np.add.at(times, (of, np.repeat([part for part, _, _ in x], [len(r) for _, r, _ in x])), np.concatenate([n for _, _, n in x]))
        own[name] = runs, times.sum(axis=1)
        if times.any(axis=0).sum() > 1:
            others[name] = Letters(runs, own[name][1][:, None] - times)
    found = measure(others)
    limits = []
    for name in names:
        row, last = [], float(ALPHABET)
        for k in range(len(RUN_LENGTHS)):
            medians = found.get((name, k), np.zeros(0))
            if medians.any():
                usual, middle = _quantile(medians, USUAL), _quantile(medians, 0.5)
                last = min(last, usual + max(LEAST_MARGIN, MARGIN * (usual - middle)))
            row.append(last)
        limits.append(row)
    every = np.unique(np.concatenate([runs for runs, _ in own.values()]))
    times = np.zeros((len(every), len(names)), np.int64)
    for name, (runs, n) in own.items():
        times[np.searchsorted(every, runs), names.index(name)] = n
    return Support(Letters(every, times), np.array(limits))


def fit_support(texts: list[str], languages: list[str]) -> Support | None:
    """Letter models of all texts; limits from runs of distinct whole words measured with the counts of the other parts.

    A limit is a high quantile of the held-out runs plus ``MARGIN`` times its distance from their median. A language of a single
    text has nothing to be held out and no limit. None without any words. ``taught_support`` does this to a table.
    """
    names = sorted(set(languages))
    met: Counter = Counter()
    rows = []
    for text, name in zip(texts, languages, strict=True):
        if WORDS.search(text or ""):
            rows.append((name, met[name] % PARTS, text))
            met[name] += 1

    def measure(others: dict[str, Letters]) -> dict[tuple[str, int], np.ndarray]:
        found = held_out(others, [tuple(map(list, zip(*rows, strict=True)))])
        return {(name, k): x for name, h in found.items() for k, x in enumerate(h.medians)}

    return _support(names, counted_runs(rows), measure)


class Labeler:
    """A field with the feature sums of the words it has met, and their bits if there is a ``Support``.

    Words are numbered as soon as a text is cut, so a text is held as an array of numbers, however long it is. The table of
    words is emptied once it is full, when the texts that refer to it are done.
    """

    def __init__(self, model: Field, support: Support | None = None, cells: int | None = None):
        self.model, self.support = model, support
        self.most = max(1, (cells or MAX_CELLS) // max(1, len(model.languages)))
        self._empty()

    def _empty(self) -> None:
        self.index: dict[str, int] = {}
        self.known = 0  # words whose sums are there
        self.has_letter = np.zeros(0, bool)
        self.rows = np.zeros((0, len(self.model.languages)), np.float32)
        self.bits = np.zeros((0, len(self.model.languages)), np.float32)

    def _numbers(self, text: str) -> np.ndarray:
        index = self.index
        return np.fromiter((index.setdefault(m.group(), len(index)) for m in WORDS.finditer(text.lower())), np.int32)

    def _sums(self) -> None:
        """Sums of the words numbered since the last call; tables grow by doubling."""
        new = list(islice(self.index, self.known, None))
        if not new:
            return
        if len(self.index) > len(self.rows):
            more = max(2 * len(self.rows), len(self.index)) - len(self.rows)
            self.rows, self.bits = (np.concatenate([x, np.zeros((more, x.shape[1]), np.float32)]) for x in (self.rows, self.bits))
            self.has_letter = np.concatenate([self.has_letter, np.zeros(more, bool)])
        for at in range(0, len(new), 10_000):
            words, place = new[at : at + 10_000], slice(self.known + at, self.known + at + len(new[at : at + 10_000]))
            self.rows[place] = self.model.potentials(words)
            self.has_letter[place] = [any(map(str.isalpha, w)) for w in words]
            if self.support:
                self.bits[place] = self.support.letters.per_word(words)
        self.known = len(self.index)

    def documents(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether its words are usual ones (always without a ``Support``)."""
        texts = list(texts)
        names, scores, usual = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if not self.model.languages:
            return names, scores, usual
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            numbers = self._numbers(text or "")
            pieces = pieces_of(text or "") if self.support else ()
            held.append((i, numbers, np.fromiter((self.index[w] for w in pieces), np.int32)))
            size += len(numbers)
            full = len(self.index) > self.most
            if size >= BATCH_WORDS or full or i == len(texts) - 1:
                self._sums()
                lettered = [h for h in held if self.has_letter[h[1]].any()]
                if lettered:
                    self._label(lettered, names, scores, usual)
                held, size = [], 0
                if full:
                    self._empty()
        return names, scores, usual

    def _label(self, held: list[tuple[int, np.ndarray, np.ndarray]], names: list[str], scores: np.ndarray, usual: np.ndarray) -> None:
        part = np.array([h[0] for h in held])
        lengths = np.array([len(h[1]) for h in held])
        packed, by_length, active = packed_order(lengths)
        word_at = np.concatenate([h[1] for h in held])[packed]
        p = marginals(self.rows[word_at], active, self.model.transitions)
        rank = np.arange(len(packed)) - np.repeat(np.cumsum(active) - active, active)
        sums = np.stack([np.bincount(rank, p[:, j], len(held)) for j in range(p.shape[1])], axis=1)
        best = sums.argmax(axis=1)
        for r, doc in enumerate(by_length):
            names[part[doc]] = self.model.languages[best[r]]
            scores[part[doc]] = min(1.0, sums[r, best[r]] / lengths[doc])
        if self.support:
            # each word by the languages it is taken to be in, so text switching between learned ones is usual
            bits = np.einsum("ij,ij->i", p, self.bits[word_at])
            del p
            word, at = np.unique(rank * self.known + word_at, return_inverse=True)
            bits = np.bincount(at, bits) / np.bincount(at)
            odd = np.concatenate([r * self.known + held[d][2].astype(np.int64) for r, d in enumerate(by_length)])
            whole = ~np.isin(word, odd)
            whole |= (np.bincount(word // self.known, whole, len(held)) == 0)[word // self.known]  # nothing but pieces
            word, bits = word[whole], bits[whole]
            doc = word // self.known
            bits = bits[np.lexsort((bits, doc))]
            sizes = np.bincount(doc, minlength=len(held))
            starts = np.cumsum(sizes) - sizes
            median = (bits[starts + (sizes - 1) // 2] + bits[starts + sizes // 2]) / 2
            column = np.minimum(np.log2(sizes).astype(int), len(RUN_LENGTHS) - 1)
            share = sums / sums.sum(axis=1, keepdims=True)
            limit = (share * self.support.limits[:, column].T).sum(axis=1)
            usual[part[by_length]] = median <= limit

    def words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, probability) of every word of a text."""
        words = words_of(text)
        if not words or not self.model.languages:
            return [(w, UNKNOWN, 0.0) for w in words]
        if len(self.index) > self.most:
            self._empty()
        places = self._numbers(text)
        self._sums()
        p = marginals(self.rows[places], np.ones(len(words), np.int64), self.model.transitions)
        best = p.argmax(axis=1)
        return [(w, self.model.languages[j], float(p[i, j])) for i, (w, j) in enumerate(zip(words, best, strict=True))]


def fold(doc_id: str, folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def taught(docs: DataFrame, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> DataFrame:
    """Rows outside the test fold that have a language and a text."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != test_fold))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> tuple[list[str], list[str]]:
    """Texts and languages of at most ``per_language`` documents of each language outside the test fold, one row each.

    They come to the driver, so a longer training document is cut to its first ``TRAINING_CHARS`` characters.
    """
    known = taught(docs, folds, test_fold)
    at = F.xxhash64(F.col("doc_id").cast("string"))
    known = known.select("lang", "doc_id", "text", F.pmod(at, F.lit(per_language)).alias("bucket"), at.alias("at"), text_key("text").alias("text_at"))
    row = ["lang", "bucket", "doc_id", "text_at"]
    picked = known.groupBy("lang", "bucket").agg(F.min(F.struct("at", "doc_id", "text_at")).alias("first"))
    ids = written(picked.select("lang", "bucket", "first.doc_id", "first.text_at"), "language-sample")
    if ids.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the sample would not be bounded")
    # rows that repeat a sampled one are one
    rows = known.join(F.broadcast(ids), row).groupBy("lang", "bucket", "doc_id").agg(F.first(F.substring("text", 1, TRAINING_CHARS)).alias("text"))
    rows = rows.toPandas().sort_values(["lang", "doc_id", "text"])
    return rows["text"].to_list(), rows["lang"].to_list()


def taught_support(docs: DataFrame, names: list[str], folds: int = FOLDS, test_fold: int = TEST_FOLD) -> Support | None:
    """``fit_support`` of all rows outside the test fold, whole; ``names`` are their languages in ascending order.

    Equal texts are in one part, so none is measured with its own letters, and a language of two texts has two parts. The
    driver gets sums only: a number per language, part and different run of three letters, and one per language, length
    of a run of words and cell of its medians.
    """
    rows = taught(docs, folds, test_fold).select("lang", "text", text_key("text").alias("at"))
    ends = rows.where(F.col("text").rlike(HAS_WORD)).groupBy("lang").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    part = F.when(F.col("at") == F.col("first"), 0).when(F.col("at") == F.col("last"), 1).otherwise(F.pmod("at", F.lit(PARTS)))
    rows = rows.join(F.broadcast(written(ends, "language-ends")), "lang").select("lang", part.cast("int").alias("part"), "text")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[int], list[str]]]:
        for batch in batches:
            for x in slices(batch, "text", BATCH_BYTES):
                if x.num_rows:
                    yield tuple(c.to_pylist() for c in x.columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, own, runs, n in counted_runs(row for x in lists(batches) for row in zip(*x, strict=True)):
            kind = pa.array([name] * len(runs), pa.string()), pa.array(np.full(len(runs), own, np.int32))
            yield pa.record_batch([*kind, pa.array(runs), pa.array(n)], names=["lang", "part", "run", "n"])

    sums = rows.mapInArrow(count, "lang string, part int, run long, n long").groupBy("lang", "part", "run").agg(F.sum("n").alias("n"))
    counts = [(*kind, x["run"].to_numpy(), x["n"].to_numpy()) for kind, x in sums.toArrow().to_pandas().groupby(["lang", "part"])]

    def measure(others: dict[str, Letters]) -> dict[tuple[str, int], np.ndarray]:
        def count_medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for name, found in held_out(others, lists(batches)).items():
                for k, medians in enumerate(found.medians):
                    cells = np.flatnonzero(medians)
                    kind = pa.array([name] * len(cells), pa.string()), pa.array(np.full(len(cells), k, np.int32))
                    yield pa.record_batch([*kind, pa.array(cells), pa.array(medians[cells])], names=["lang", "length", "cell", "n"])

        found = rows.mapInArrow(count_medians, "lang string, length int, cell long, n long").groupBy("lang", "length", "cell").agg(F.sum("n").alias("n"))
        return {kind: np.bincount(x["cell"], x["n"]) for kind, x in found.toArrow().to_pandas().groupby(["lang", "length"])}

    return _support(names, counts, measure)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS, test_fold: int = TEST_FOLD) -> Field:
    """Fit on the sampled documents."""
    return fit(*sample(docs, per_language, folds, test_fold))


def identified(docs: DataFrame, model: Field, keep: Iterable[str] = ("doc_id",), support: Support | None = None, cells: int | None = None) -> DataFrame:
    """``lang_pred``, ``score`` and ``usual`` (true without a ``support``) of every row beside ``keep``.

    ``cells`` bounds the sums that a worker holds of the words it has met (``MAX_CELLS``); it changes no result.
    """

    def start():
        labeler = Labeler(model, support, cells)

        def label(texts: list) -> list[pa.Array]:
            names, scores, usual = labeler.documents(texts)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(usual, pa.bool_())]

        return label

    return map_texts(docs, keep, "text", start, "lang_pred string, score double, usual boolean", BATCH_BYTES)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = train(docs.select("doc_id", "lang", "text"))
    held_out = F.coalesce(fold("doc_id") == TEST_FOLD, F.lit(True))
    return identified(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
