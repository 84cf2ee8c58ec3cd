"""Toxicity: a lexicon trie met with Levenshtein automata, and context windows.

The lexicon is learned from labelled texts: words that labelled texts hold far more often than clean ones,
and *stems*, openings shared by several such words.  Texts are cut into words; all words of a block walk the
product of the lexicon trie and the Levenshtein automata at once.  The product is turned into a deterministic
automaton only where words really go.  Each hit is then looked at in a window of words around it: inside
quotation marks or beside a reporting verb it counts as quotation, beside an address ("you") as abuse.
A logistic model over the counts gives the score; its prior weights stand where labels say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import blocks, id_residue, whole

#: Terms known without labels.
SEED_TERMS = ("idiot", "moron", "scum", "stupid", "worthless", "pathetic", "disgusting", "loser")
#: Words beside a quotation, words of address.
REPORTING = ("said", "says", "wrote", "quoted", "called", "quote", "quoting", "reported", "cited")
ADDRESS = ("you", "your", "youre", "u", "ur")

FEATURES = ("exact", "stem", "near", "quoted", "addressed")
#: Intercept, then a weight for each feature; what is fitted is pulled towards these.
PRIOR = (-3.0, 4.0, 4.0, 1.0, -2.0, 1.0)
QUOTES = "\"“”„«»‹›"


@dataclass(frozen=True)
class Fit:
    """Bound of the fit: labelled rows read per class; and what makes a term.

    A term or stem stands in at least ``min_texts`` toxic texts, at ``min_log_odds`` against clean ones; all that do are kept.
    """

    rows_per_class: int = 12_000
    min_texts: int = 5
    min_log_odds: float = 4.0
    stem_lengths: tuple[int, ...] = (4, 5, 6)
    stem_words: int = 4
    window: int = 6
    pull: float = 1.0


@dataclass(frozen=True)
class Model:
    terms: tuple[str, ...]
    stems: tuple[str, ...]
    weights: tuple[float, ...] = PRIOR
    window: int = 6


def allowed_edits(term: str) -> int:
    """Edits up to which a spelling still counts: none for short terms, two for long ones."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Product:
    """Lexicon trie and Levenshtein automata walked together, made deterministic on demand.

    A state is the set of (trie node, edits used); its outcome is 3 for a term itself, 2 for a word that opens with a
    stem, 1 for a misspelt term, 0 for none.
    """

    DEAD, START = 0, 1

    def __init__(self, terms: tuple[str, ...], stems: tuple[str, ...]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]  # edits allowed for the term that ends here
        self.reach: list[int] = [0]  # most edits allowed for any term below
        self.opening: list[bool] = [False]
        for word, stem in [(t, False) for t in terms] + [(s, True) for s in stems]:
            node, edits = 0, 0 if stem else allowed_edits(word)
            self.reach[0] = max(self.reach[0], edits)
            for letter in word:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.ends):
                    self.children.append({})
                    self.ends.append(-1)
                    self.reach.append(0)
                    self.opening.append(False)
                self.reach[node] = max(self.reach[node], edits)
            if stem:
                self.opening[node] = True
            else:
                self.ends[node] = max(self.ends[node], edits)
        letters = sorted({c for kids in self.children for c in kids})
        self.classes = {c: k + 2 for k, c in enumerate(letters)}  # 0: no word, 1: any other letter
        self.letters = ["", ""] + letters
        self.longest = max([len(t) + allowed_edits(t) for t in terms] + [len(s) for s in stems] + [1])
        self.states: dict[frozenset | str, int] = {frozenset(): self.DEAD}
        self.sets: list[frozenset | str] = [frozenset()]
        self.table = np.full((256, len(self.letters)), -1, dtype=np.int32)
        self.outcome = np.zeros(256, dtype=np.int8)
        self.table[self.DEAD] = self.DEAD
        assert self._state(self._closed({(0, 0)})) == self.START

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        """With letters of the term left out; only the least edits of a node matter."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, used = todo.pop()
            if used > self.reach[node] or best.get(node, 99) <= used:
                continue
            best[node] = used
            todo.extend((kid, used + 1) for kid in self.children[node].values())
        return frozenset(best.items())

    def _state(self, items: frozenset | str) -> int:
        if (known := self.states.get(items)) is not None:
            return known
        number = self.states[items] = len(self.sets)
        self.sets.append(items)
        if number == len(self.table):
            self.table = np.vstack([self.table, np.full_like(self.table, -1)])
            self.outcome = np.concatenate([self.outcome, np.zeros_like(self.outcome)])
        if isinstance(items, str):
            self.outcome[number] = 2
            self.table[number] = number
        else:
            ends = [used for node, used in items if self.ends[node] >= used]
            self.outcome[number] = 0 if not ends else 3 if min(ends) == 0 else 1
        return number

    def _follow(self, state: int, letter_class: int) -> int:
        letter, after = self.letters[letter_class], set()
        for node, used in self.sets[state]:
            kids = self.children[node]
            if letter in kids:
                after.add((kids[letter], used))
                if used == 0 and self.opening[kids[letter]]:
                    return self._state("opening")
            after.add((node, used + 1))
            after.update((kid, used + 1) for kid in kids.values())
        return self._state(self._closed(after))

    def step(self, states: np.ndarray, letter_classes: np.ndarray) -> np.ndarray:
        after = self.table[states, letter_classes]
        if (after < 0).any():
            unknown = after < 0
            for state, letter in set(zip(states[unknown].tolist(), letter_classes[unknown].tolist(), strict=True)):
                found = self._follow(state, letter)
                self.table[state, letter] = found
            after = self.table[states, letter_classes]
        return after

    def classify(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The outcome of each word, given as letter classes from ``starts``."""
        states = np.full(len(starts), self.START, dtype=np.int32)
        alive = np.arange(len(starts))
        for k in range(self.longest):
            alive = alive[lengths[alive] > k]
            if not len(alive):
                break
            after = self.step(states[alive], codes[starts[alive] + k])
            states[alive] = after
            alive = alive[(after != self.DEAD)]
        outcome = self.outcome[states]
        too_long = (lengths > self.longest) & (outcome != 2)
        outcome[too_long] = 0
        return outcome


class Scanner:
    """Counts of a model's hits, for blocks of texts."""

    def __init__(self, model: Model):
        self.model, self.product = model, Product(model.terms, model.stems)
        kind = np.zeros(0x110000, dtype=np.int16)
        text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        kind[points] = np.fromiter(map(str.isalpha, text), dtype=np.int16, count=len(text))
        for letter, number in self.product.classes.items():
            kind[ord(letter)] = number
        self.kind = kind
        self.inner = np.zeros(0x110000, dtype=bool)  # stand for letters when between two
        self.inner[[ord(c) for c in "0123456789@$"]] = True
        self.quote = np.zeros(0x110000, dtype=bool)
        self.quote[[ord(c) for c in QUOTES]] = True

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row of counts per text, in the order of ``FEATURES``."""
        out = np.zeros((len(texts), len(FEATURES)))
        lowered = [(t or "").lower() for t in texts]
        # two blanks between texts: no word, and no character between letters, spans two of them
        codes = np.frombuffer(("  ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = self.kind[codes]
        letter = classes > 0
        joint = np.zeros_like(letter)
        joint[1:-1] = self.inner[codes[1:-1]] & letter[:-2] & letter[2:]
        classes[joint] = 1
        word = letter | joint
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        outcome = self.product.classify(classes, starts, ends - starts)
        hits = np.flatnonzero(outcome)
        if not len(hits):
            return out
        first = np.cumsum([0] + [len(t) + 2 for t in lowered])
        owner = np.searchsorted(first, starts[hits], side="right") - 1
        for column, wanted in enumerate((3, 2, 1)):
            np.add.at(out[:, column], owner[outcome[hits] == wanted], 1)
        marks = np.concatenate([[0], np.cumsum(self.quote[codes])])
        for hit, text in zip(hits.tolist(), owner.tolist(), strict=True):
            low = int(np.searchsorted(starts, first[text]))
            high = int(np.searchsorted(starts, first[text + 1]))
            near = range(max(low, hit - self.model.window), min(high, hit + self.model.window + 1))
            begin, end = starts[near[0]], ends[near[-1]]
            base = first[text]
            around = {lowered[text][starts[k] - base : ends[k] - base] for k in near if k != hit}
            before = marks[starts[hit]] - marks[max(begin - 1, base)]
            after = marks[min(end + 1, first[text + 1])] - marks[ends[hit]]
            if (before and after) or not around.isdisjoint(REPORTING):
                out[text, 3] += 1
            elif not around.isdisjoint(ADDRESS):
                out[text, 4] += 1
        return out


def scores(features: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    z = weights[0] + np.log1p(features) @ np.array(weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fitted(features: np.ndarray, toxic: np.ndarray, pull: float, stands_for: tuple[float, float] = (1.0, 1.0)) -> tuple[float, ...]:
    """Logistic weights by Newton steps, drawn to ``PRIOR`` by a normal prior of precision ``pull``.

    A clean and a toxic row count as often as ``stands_for`` says, so a bounded sample keeps the ratio of the classes.
    """
    share = np.where(toxic > 0, stands_for[1], stands_for[0])
    x = np.hstack([np.ones((len(features), 1)), np.log1p(features)])
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - toxic)) + pull * (w - prior)
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w = w - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def _known(labels: DataFrame, label: str, fold: tuple[int, int]) -> DataFrame:
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (id_residue("doc_id", fold[0]) != fold[1]))
        .groupBy("doc_id").agg(F.max(label).alias("toxic"))
    )


def rows_stood_for(labels: DataFrame, fit: Fit, label: str = "toxic", fold: tuple[int, int] = (5, 0)) -> tuple[float, float]:
    """How many labelled rows a row of ``labelled_sample`` stands for, by class: one, unless the class is cut."""
    n = {r["toxic"]: r["n"] for r in _known(labels, label, fold).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = (max(n.get(c, 0) / fit.rows_per_class, 1.0) for c in (0, 1))
    return clean, toxic


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit, label: str = "toxic", fold: tuple[int, int] = (5, 0)) -> DataFrame:
    """``text, toxic``: at most ``rows_per_class`` labelled rows of each class, smallest id hash first.

    Rows of the held-out fold never enter.  Copies of a text count once; labels that contradict each other count as 1.
    """
    known = _known(labels, label, fold)
    order = F.xxhash64(F.col("doc_id"))
    part = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(fit.rows_per_class) for c in (0, 1)]
    chosen = part[0].unionByName(part[1])
    # At most twice rows_per_class rows of two numbers: the bound for the broadcast.
    return docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Lexicon and weights from the bounded labelled sample.

    Without any labelled text of a class the seed terms and prior weights are the model.
    """
    sample = labelled_sample(docs, labels, fit).persist()
    try:
        n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if not n.get(0) or not n.get(1):
            return Model(SEED_TERMS, (), window=fit.window)
        word = F.explode(F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+")))
        words = sample.select(word.alias("word"), "toxic").where("word <> ''").groupBy("word").agg(
            F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("clean")
        )

        def odds(bad: str, clean: str) -> F.Column:
            return F.log((F.col(bad) + 0.5) / (n[1] + 1)) - F.log((F.col(clean) + 0.5) / (n[0] + 1))

        telling = lambda df: df.where((F.col("bad") >= fit.min_texts) & (odds("bad", "clean") >= fit.min_log_odds))
        opening = words.select("*", F.explode(F.array(*[F.lit(k) for k in fit.stem_lengths])).alias("k")).where(F.length("word") > F.col("k"))
        stems = telling(
            opening.groupBy(F.expr("left(word, k)").alias("word")).agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"), F.count_if(F.col("bad") > 0).alias("forms"))
        ).where(F.col("forms") >= fit.stem_words)
        best = lambda df: {r["word"]: r["bad"] for r in df.orderBy(F.desc("bad"), "word").collect()}
        kept_stems = _specific(best(stems))
        openings = set(kept_stems)
        terms = [w for w in best(telling(words)) if not any(w[:k] in openings for k in fit.stem_lengths)]
        model = Model(tuple(dict.fromkeys([*SEED_TERMS, *terms])), tuple(kept_stems), window=fit.window)
        rows = sample.select("text", "toxic").mapInArrow(_counter(model), T.StructType([T.StructField("toxic", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in FEATURES]])).collect()
    finally:
        sample.unpersist()
    data = np.array([[r[f] for f in FEATURES] for r in rows])
    toxic = np.array([r["toxic"] for r in rows], dtype=float)
    return Model(model.terms, model.stems, _fitted(data, toxic, fit.pull, rows_stood_for(labels, fit)), fit.window)


def _specific(stems: dict[str, int], same: float = 0.95) -> list[str]:
    """One stem for each family: the shortest, lengthened while it keeps ``same`` of its texts."""
    kept: list[str] = []
    for stem in sorted(stems, key=lambda s: (len(s), s)):
        if any(stem.startswith(s) or s.startswith(stem) for s in kept):
            continue
        longer = stem
        while more := [s for s in stems if s.startswith(longer) and len(s) > len(longer) and stems[s] >= same * stems[stem]]:
            longer = min(more, key=lambda s: (len(s), s))
        kept.append(longer)
    return kept


def _counter(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for block in blocks(batches, "text"):
            found = scanner.features(block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column("toxic").cast(pa.int64()), *[pa.array(found[:, k]) for k in range(len(FEATURES))]], names=["toxic", *FEATURES]
            )

    return count


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row.

    Null and empty texts get the score of a text without hits; repeated rows and null ids keep a row each; no rows give
    no rows; no other column is read.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for block in blocks(batches, "text"):
            value = scores(scanner.features(block.column("text").to_pylist()), model.weights)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(value)], names=[id_col, "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, T.StructType([rows.schema[0], T.StructField("score", T.DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns; null texts score as empty ones."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model)
        for block in blocks(batches, text_col):
            value = scores(scanner.features(block.column(text_col).to_pylist()), model.weights)
            if (kept := block.filter(pa.array(value < threshold))).num_rows:
                yield kept

    return docs.mapInArrow(keep, docs.schema)


