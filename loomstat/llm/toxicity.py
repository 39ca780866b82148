"""Toxicity: a lexicon trie met by Levenshtein automata, and scores of the words around each hit.

The lexicon is learnt from labelled documents: whole words, and beginnings of words, that are far more frequent in toxic
ones. Both become tries; a word may go on after a beginning. A word is looked up by walking the trie and the word's Levenshtein automaton together: a trie
branch is left as soon as the automaton has no live state there, so misspelled terms are found without listing
spellings. Words that share no piece with a term cannot be in reach and are passed over; words near a term that clean
labelled documents use are no misspellings. Around each hit the words
of a window say whether it is quoted or meant; their weights are learnt from hits in toxic and in clean documents. A
logistic model of what the hits of a document add up to gives its score.

Defined cases: null and empty texts have no hit and get the score of such documents. Without labels of both kinds the
score is the share of label 1, 0.5 without any label. Ids never enter a score.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomstat.llm.common import durable, fold, slices, text_hash, utf8
from loomstat.llm.labelled import labelled_sample

# Least log odds of a term, and least share of the toxic documents that have it; the share bounds the lexicon.
TERM_ODDS, TERM_SHARE, TERM_DOCS = 2.0, 0.002, 5
# Beginnings of words that can be terms; whole words are terms from the least length on.
PREFIXES, LEAST = (4, 5, 6), 3
# Log odds by which a longer beginning must be better than a shorter one.
COVERED = 1.0
# Share of a beginning's documents that one word may account for.
ONE_WORD = 0.7
# Terms shorter than this match exactly only; longer ones may differ by one edit, those from the second length on by
# two. An edit is a sign put in, left out or replaced, or two neighbours in the wrong order.
FUZZY, FAR = 4, 8
# Clean labelled documents that make a word near a term a word of its own.
CLEAN_DOCS = 2
WINDOW = 5
CONTEXT_DOCS = 10
QUOTES = ('"', "'", "“", "”", "«", "»", "„", "‘", "’", "&quot;")
EDGE = ".,;:!?()[]{}<>|#$%&*~^_=+/\\`-" + "".join(q for q in QUOTES if len(q) == 1)
KNOWN_WORDS = 400_000
# Hits that a context word counts as having had before any were seen, at the general share of toxic ones.
CONTEXT_PRIOR = 20
WIDTH = 8
WHOLE, BEGINNING = 0, 1


def bare(word: str) -> str:
    """A word without the signs around it."""
    return word.strip(EDGE)


def words_of(text: bytes | None) -> list[str]:
    return fold(text).decode().split() if text else []


def terms_of(word: str) -> list[tuple[int, str]]:
    found = [(WHOLE, word)] if len(word) >= LEAST else []
    return found + [(BEGINNING, word[:n]) for n in PREFIXES if len(word) >= n]


class Trie:
    """Terms by their signs; ``find`` runs a word's Levenshtein automaton over them.

    With ``swaps`` two neighbours in the wrong order are one edit; with ``prefix`` a word may go on after the term.
    """

    def __init__(self, terms: dict[str, float], distance: int = 1, *, swaps: bool = False, prefix: bool = False):
        self.distance, self.swaps, self.prefix = distance, swaps, prefix
        self.root: dict = {}
        self.pieces: set = set()
        self.cuts: dict[int, set] = {}
        for term, weight in terms.items():
            node = self.root
            for sign in term:
                node = node.setdefault(sign, {})
            node[""] = (term, weight)
            self._add_pieces(term)

    def _add_pieces(self, term: str) -> None:
        """Of ``distance`` + 1 pieces one stays as it is, say number i from 0, with i edits before it and the rest of the
        distance after it at most. Only a swap across a border changes two of them, so the term is also entered with its
        borders swapped."""
        d = self.distance
        borders = [len(term) * i // (d + 1) for i in range(d + 2)]
        forms = {term}
        if self.swaps:
            for at in borders[1:-1]:
                if 0 < at < len(term):
                    forms |= {f[:at - 1] + f[at] + f[at - 1] + f[at + 1:] for f in forms}
        for size in [0] if self.prefix else range(max(0, len(term) - d), len(term) + d + 1):
            cuts = self.cuts.setdefault(size, set())
            for i, (begin, end) in enumerate(zip(borders, borders[1:])):
                for move in range(-min(i, begin), i + 1):
                    if self.prefix or abs(size - len(term) - move) <= d - i:
                        cuts.add((begin + move, end - begin))
                        self.pieces.update((size, begin + move, form[begin:end]) for form in forms)

    def in_reach(self, word: str) -> bool:
        size, pieces = 0 if self.prefix else len(word), self.pieces
        return any((size, at, word[at:at + n]) in pieces for at, n in self.cuts.get(size, ()))

    def find(self, word: str) -> list[tuple[str, float, int]]:
        """``(term, weight, edits)`` of all terms within the distance.

        A state is a trie node, a place in the word and the edits left; with none left only the word's own signs lead on.
        """
        if not self.in_reach(word):
            return []
        size, found = len(word), {}

        def accept(node, left):
            term, weight = node[""]
            edits = self.distance - left
            if edits < found.get(term, (0, self.distance + 1))[1]:
                found[term] = (weight, edits)

        stack, seen = [(self.root, 0, self.distance)], set()
        while stack:
            node, i, left = stack.pop()
            if left:
                if (id(node), i, left) in seen:
                    continue
                seen.add((id(node), i, left))
                for sign, child in node.items():
                    if sign:
                        stack.append((child, i, left - 1))
                        if i < size and sign != word[i]:
                            stack.append((child, i + 1, left - 1))
                if i < size:
                    stack.append((node, i + 1, left - 1))
                    if (child := node.get(word[i])) is not None:
                        stack.append((child, i + 1, left))
                    if self.swaps and i + 1 < size and (child := node.get(word[i + 1], {}).get(word[i])) is not None:
                        stack.append((child, i + 2, left - 1))
            else:
                while i < size and node is not None:
                    if self.prefix and "" in node:
                        accept(node, left)
                    node = node.get(word[i])
                    i += 1
            if (i == size or self.prefix) and node is not None and "" in node:
                accept(node, left)
        return [(term, weight, edits) for term, (weight, edits) in found.items()]


class Matcher:
    """Whole words and beginnings in tries; remembers the words it has looked up."""

    def __init__(self, whole: dict[str, float], beginnings: dict[str, float]):
        self.whole, self.beginnings = whole, beginnings
        self.tries = [
            Trie({t: w for t, w in whole.items() if FUZZY <= len(t) < FAR}, 1, swaps=True),
            Trie({t: w for t, w in whole.items() if len(t) >= FAR}, 2, swaps=True),
        ]
        self.starts = Trie({t: w for t, w in beginnings.items() if len(t) >= FUZZY}, 1, swaps=True, prefix=True)
        self.known: dict[str, tuple | None] = {}

    def beginning(self, word: str) -> tuple[float, int] | None:
        found = [w for n in PREFIXES if (w := self.beginnings.get(word[:n])) is not None and len(word) >= n]
        return (max(found), 2) if found else None

    def _find(self, word: str) -> tuple[float, int] | None:
        weight = self.whole.get(word)
        if weight is not None:
            return weight, 0
        fuzzy = len(word) >= FUZZY - 1
        if fuzzy and (found := [hit for trie in self.tries for hit in trie.find(word)]):
            return max(w for _, w, _ in found), 1
        if (hit := self.beginning(word)) is not None:
            return hit
        if fuzzy and (found := self.starts.find(word)):
            return max(w for _, w, _ in found), 1
        return None

    def find(self, word: str) -> tuple[float, int] | None:
        """``(weight, kind)`` of the best term: kind 0 exact, 1 misspelled, 2 beginning; None if there is none."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        hit = self.known[word] = self._find(word)
        return hit


class Lexicon:
    """The terms of a matcher, less misspellings that are words of their own."""

    def __init__(self, matcher: Matcher, clean: frozenset = frozenset()):
        self.matcher, self.clean = matcher, clean
        self.known: dict[str, tuple | None] = {}

    def look(self, word: str) -> tuple[float, int] | None:
        """As :meth:`Matcher.find`; a clean word is a term itself or has its beginning, but is no misspelling."""
        hit = self.matcher.find(word)
        return self.matcher.beginning(word) if hit is not None and hit[1] == 1 and word in self.clean else hit

    def hits(self, words: list[str]) -> list[tuple[int, float, int]]:
        """``(position, weight, kind)`` of the words that are terms."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        found = {}
        for word in set(words):
            if word in known:
                hit = known[word]
            else:
                hit = known[word] = self.look(bare(word))
            if hit is not None:
                found[word] = hit
        return [(i, *found[w]) for i, w in enumerate(words) if w in found] if found else []


def context_of(words: list[str], position: int) -> list[str]:
    """What stands around a hit: the words of the window, and marks for quotation."""
    around = words[max(0, position - WINDOW):position] + words[position + 1:position + 1 + WINDOW]
    context = ["w:" + bare(w) for w in around if bare(w)]
    hit = words[position]
    opened = any(w.startswith(QUOTES) for w in [*words[max(0, position - WINDOW):position], hit])
    closed = any(w.rstrip(".,;:!?").endswith(QUOTES) for w in [hit, *words[position + 1:position + 1 + WINDOW]])
    if opened and closed:
        context.append("quoted")
    return context


@dataclass
class ToxicityModel:
    """What :func:`fit` has learnt; its size is bounded by the shares that terms and context words must have."""

    whole: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    clean: frozenset = frozenset()  # words near a term that labelled documents have as words of their own
    context: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    key: tuple[str, str] | None = None

    def lexicon(self) -> Lexicon:
        return Lexicon(Matcher(self.whole, self.beginnings), self.clean)

    def keyed(self) -> "ToxicityModel":
        """With names for its terms and its clean words, by which tasks know that they have them already."""
        terms = repr((sorted(self.whole.items()), sorted(self.beginnings.items())))
        digest = lambda text: hashlib.md5(text.encode()).hexdigest()
        return replace(self, key=(digest(terms), digest(repr(sorted(self.clean)))))

    def window_score(self, words: list[str], position: int) -> float:
        """Above 0: the words around speak for abuse, below: for quotation or chance."""
        return sum(self.context.get(c, 0.0) for c in set(context_of(words, position)))

    def features(self, words: list[str], lexicon: Lexicon) -> list[float]:
        """A constant, whether there are hits, their joint and largest strength, the shares of misspellings and of
        beginnings in it, and the best and the mean score of their contexts."""
        hits = lexicon.hits(words)
        if not hits:
            return [1.0, *[0.0] * (WIDTH - 1)]
        context = [max(-6.0, min(6.0, self.window_score(words, i))) for i, _, _ in hits]
        total = sum(weight for _, weight, _ in hits)
        share = [sum(weight for _, weight, kind in hits if kind == k) / total for k in (1, 2)]
        return [
            1.0, 1.0, math.log1p(total), max(weight for _, weight, _ in hits) / 5, *share, max(context),
            sum(context) / len(context),
        ]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))

    def column(self, text: Column | str) -> Column:
        """The score of a text column."""

        model = self if self.key is not None else self.keyed()

        @F.arrow_udf(DoubleType())
        def run(texts: pa.Array) -> pa.Array:
            lexicon = _lexicon(model)
            out = []
            for part in slices([pa.RecordBatch.from_arrays([texts], ["t"])]):
                rows = [model.features(words_of(t), lexicon) for t in utf8(part.column(0))]
                out.append(model.score(np.array(rows, np.float64).reshape(-1, WIDTH)))
            return pa.array(np.concatenate(out) if out else np.zeros(0))

        return run(text)


_MATCHERS: dict[str, Matcher] = {}
_LEXICONS: dict[tuple[str, str], Lexicon] = {}


def _lexicon(model: ToxicityModel) -> Lexicon:
    """One lexicon per model in a worker, and one matcher for all passes of a fit and the scoring after it.

    Each task is sent a model of its own; by its key a worker finds the tries and the words looked up by earlier tasks.
    """
    if model.key is None:
        return model.lexicon()
    if model.key not in _LEXICONS:
        if model.key[0] not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[model.key[0]] = Matcher(model.whole, model.beginnings)
        _LEXICONS.clear()
        _LEXICONS[model.key] = Lexicon(_MATCHERS[model.key[0]], model.clean)
    return _LEXICONS[model.key]


def _count(rows: DataFrame, entries, flush: int = 200_000) -> DataFrame:
    """``kind, entry, toxic, clean``: documents of either label that have an entry; counts are combined in the task."""

    def run(batches):
        counts = {0: Counter(), 1: Counter()}

        def out():
            keys = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.string()),
                    pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64()),
                ],
                ["kind", "entry", "toxic", "clean"],
            )

        for batch in slices(batches):
            for text, label in zip(utf8(batch.column("text")), batch.column("label").to_pylist()):
                counts[label].update(entries(text))
            if len(counts[0]) + len(counts[1]) > flush:
                yield out()
                counts = {0: Counter(), 1: Counter()}
        yield out()

    found = rows.mapInArrow(run, "kind int, entry string, toxic bigint, clean bigint")
    return found.groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _take(model: ToxicityModel, rows: list) -> None:
    """Put terms into the lexicon: all words, a beginning only where no single word makes most of it, a longer beginning
    only where no shorter one in the lexicon speaks for it nearly as well."""
    most: dict[str, int] = {}
    for row in rows:
        if row.kind == WHOLE:
            for n in PREFIXES:
                most[row.entry[:n]] = max(most.get(row.entry[:n], 0), row.toxic)

    def covered(row) -> bool:
        return any(model.beginnings.get(row.entry[:n], 0.0) >= row.odds - COVERED for n in PREFIXES if n < len(row.entry))

    for row in sorted(rows, key=lambda r: (r.kind == WHOLE, len(r.entry), r.entry)):
        if row.kind == WHOLE:
            model.whole[row.entry] = row.odds
        elif most.get(row.entry, 0) < ONE_WORD * row.toxic and not covered(row):
            model.beginnings[row.entry] = row.odds


def _logit(share: float) -> float:
    return math.log(share / (1 - share))


def _one_of_near_copies(labelled: DataFrame, shingle: int = 4) -> DataFrame:
    """``text, label``, one row of those that agree in label and in the least hash of their shingles.

    Without this the words of a document with a thousand near copies would all look toxic, or all clean.
    """

    def run(batches):
        for batch in slices(batches):
            sketches = []
            for text in utf8(batch.column("text")):
                words = fold(text).split() if text else []
                joined = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
                sketches.append(min(map(text_hash, joined)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("label"), pa.array(sketches, pa.int64())], ["text", "label", "sketch"]
            )

    marked = labelled.select("text", "label").mapInArrow(run, "text string, label int, sketch bigint")
    return marked.groupBy("label", "sketch").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "label")


def fit(labelled: DataFrame) -> ToxicityModel:
    """A model of ``label`` from ``text, label``, a bounded number of rows."""
    labelled = durable(_one_of_near_copies(labelled), "toxicity-sample")
    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    model = ToxicityModel()
    if not n_toxic or not n_clean:
        share = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.5
        model.weights[0] = math.log((share + 1e-3) / (1 - share + 1e-3))
        return model

    def terms(text):
        return {t for w in set(words_of(text)) for t in terms_of(bare(w))}

    # A term is in this share of the toxic documents, so there are as many terms as words in a document, over the share.
    support = max(TERM_DOCS, TERM_SHARE * n_toxic)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    strong = _count(labelled, terms).filter((F.col("toxic") >= support) & (odds >= TERM_ODDS))
    _take(model, strong.select("kind", "entry", odds.alias("odds"), "toxic").collect())
    model = model.keyed()

    def near(text):
        known = _lexicon(model)
        return {(WHOLE, w) for w in {bare(w) for w in words_of(text)} if (hit := known.look(w)) is not None and hit[1] == 1}

    # What clean documents use again and again is not a misspelling, unless toxic ones use it far more.
    own = _count(labelled, near).filter((F.col("clean") >= CLEAN_DOCS) & (odds < TERM_ODDS)).select("entry")
    model = replace(model, clean=frozenset(r.entry for r in own.collect())).keyed()

    def contexts(text):
        words = words_of(text)
        return {(0, c) for i, _, _ in _lexicon(model).hits(words) for c in context_of(words, i)}

    around = _count(labelled, contexts).filter(F.col("toxic") + F.col("clean") >= max(CONTEXT_DOCS, TERM_SHARE * n_toxic))
    found = around.collect()
    share = (sum(r.toxic for r in found) + 1) / (sum(r.toxic + r.clean for r in found) + 2)
    for row in found:
        own = (row.toxic + CONTEXT_PRIOR * share) / (row.toxic + row.clean + CONTEXT_PRIOR)
        model.context[row.entry] = _logit(own) - _logit(share)

    def features(batches):
        for batch in slices(batches):
            rows = [model.features(words_of(t), _lexicon(model)) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("label")], ["x", "y"])

    # As many rows as the sample has at most, eight numbers each.
    rows = labelled.mapInArrow(features, "x array<double>, y int").collect()
    model.weights = _logistic(np.array([r.x for r in rows]), np.array([r.y for r in rows], np.float64))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps, halved while they do not help."""
    weights = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + ridge * w @ w / 2

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), gradient)
        size = 1.0
        while size > 1e-4 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return weights


def fit_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", **options) -> ToxicityModel:
    """A model from a bounded sample of the labelled documents that are not held out."""
    return fit(labelled_sample(docs, labels, label, **options))
